"""Line plots with error bars of small series, as SVG files made with the standard library."""

from __future__ import annotations

import math
import os
import re
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

WIDTH, HEIGHT, LEFT, BOTTOM, TOP = 640, 400, 70, 50, 40


def ticks(low: float, high: float, about: int = 5) -> list[float]:
    """Round numbers between two values, both ends inside."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    raw = (high - low) / about
    unit = 10 ** math.floor(math.log10(raw))
    step = next(m * unit for m in (1, 2, 5, 10) if m * unit >= raw)
    first = math.floor(low / step)
    return [round(k * step, 12) for k in range(first, math.ceil(high / step) + 1)]


def line_plot(title: str, points: list[tuple[float, float, float | None]], x_label: str = "checkpoint", y_label: str = "value") -> str:
    """(x, y, error) in order of x -> an SVG text: a line through the points and a bar of one error each way where there is one."""
    points = sorted((x, y, e) for x, y, e in points if x is not None and y is not None and math.isfinite(y))
    spread = lambda e: e if e is not None and math.isfinite(e) else 0.0
    xs = [p[0] for p in points] or [0.0]
    ys = ticks(min((y - spread(e) for _, y, e in points), default=0.0), max((y + spread(e) for _, y, e in points), default=1.0))
    x_low, x_high = (min(xs), max(xs)) if min(xs) < max(xs) else (min(xs) - 1, max(xs) + 1)
    at_x = lambda x: LEFT + (WIDTH - LEFT - 20) * (x - x_low) / (x_high - x_low)
    at_y = lambda y: HEIGHT - BOTTOM - (HEIGHT - BOTTOM - TOP) * (y - ys[0]) / (ys[-1] - ys[0])
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{WIDTH}" height="{HEIGHT}" font-family="sans-serif" font-size="12">']
    out.append(f'<rect width="{WIDTH}" height="{HEIGHT}" fill="white"/><text x="{WIDTH / 2}" y="22" text-anchor="middle" font-size="15">{escape(title)}</text>')
    for y in ys:
        out.append(f'<line x1="{LEFT}" x2="{WIDTH - 20}" y1="{at_y(y):.2f}" y2="{at_y(y):.2f}" stroke="#dddddd"/><text x="{LEFT - 8}" y="{at_y(y) + 4:.2f}" text-anchor="end">{y:g}</text>')
    for x in sorted(set(xs))[:: max(1, len(set(xs)) // 12)]:
        out.append(f'<text x="{at_x(x):.2f}" y="{HEIGHT - BOTTOM + 18}" text-anchor="middle">{x:g}</text>')
    out.append(f'<text x="{WIDTH / 2}" y="{HEIGHT - 12}" text-anchor="middle">{escape(x_label)}</text><text x="16" y="{HEIGHT / 2}" text-anchor="middle" transform="rotate(-90 16 {HEIGHT / 2})">{escape(y_label)}</text>')
    out.append(f'<polyline fill="none" stroke="#1f5fa8" stroke-width="2" points="{" ".join(f"{at_x(x):.2f},{at_y(y):.2f}" for x, y, _ in points)}"/>')
    for x, y, e in points:
        if spread(e):
            up, down = at_y(y + e), at_y(y - e)
            out.append(f'<path class="error" stroke="#1f5fa8" d="M{at_x(x):.2f} {up:.2f}V{down:.2f}M{at_x(x) - 4:.2f} {up:.2f}h8M{at_x(x) - 4:.2f} {down:.2f}h8"/>')
        out.append(f'<circle cx="{at_x(x):.2f}" cy="{at_y(y):.2f}" r="3" fill="#1f5fa8"/>')
    return "".join([*out, "</svg>"])


def write_plots(series: DataFrame, folder: str, most: int = 100_000) -> list[str]:
    """One SVG file for each dataset and metric of a checkpoint series (dataset, checkpoint, metric, value, error); more than ``most`` points are refused."""
    rows = series.select("dataset", "metric", "checkpoint", "value", "error").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"plots take {most} points at most")
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault((r.dataset, r.metric), []).append((r.checkpoint, r.value, r.error))
    os.makedirs(folder, exist_ok=True)
    out = []
    for (dataset, metric), points in sorted(groups.items()):
        out.append(os.path.join(folder, re.sub(r"[^A-Za-z0-9._-]", "_", f"{dataset}_{metric}") + ".svg"))
        with open(out[-1], "w", encoding="utf-8") as f:
            f.write(line_plot(f"{dataset}: {metric}", points, y_label=metric))
    return out
