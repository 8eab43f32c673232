import glob
import json
import os
import subprocess
import sys
import threading
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from weir.operators import quality, relational
from weir.operators.metrics import RowCounts, removed_rows
from weir.sources import io, ordered, workbook
from weir.sources.revisions import Revisions, wait_for


@pytest.fixture
def rows(spark):
    return spark.range(90).select(F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"), (F.col("id") * 2).alias("idx"), F.md5(F.col("id").cast("string")).alias("x"))


def test_revisions_are_pinned_and_listed(spark, rows, tmp_path):
    hub = Revisions(spark, f"file://{tmp_path}", "data", "conf")
    with pytest.raises(FileNotFoundError):
        hub.entry()
    one = hub.publish(rows, note="first")
    two = hub.publish(rows.where("idx < 50"))
    assert (one.number, two.number, one.rows, hub.refs()) == (1, 2, {"train": 60, "test": 30}, ["main"])
    assert hub.read().count() == 25 and hub.read(number=1).count() == 90 and hub.read(split="test", number=1).count() == 30
    assert [e.note for e in hub.log()] == ["first", ""]
    hub.tag("v1", number=1)
    hub.publish(rows.limit(3), "main")
    assert hub.read("v1").count() == 90 and hub.refs() == ["main", "v1"] and hub.entry("v1").data == one.data
    for bad in (lambda: hub.tag("v1"), lambda: hub.read("v2"), lambda: hub.read(number=9), lambda: hub.read(split="dev"), lambda: hub.publish(rows, "a/b")):
        with pytest.raises((FileExistsError, FileNotFoundError, ValueError)):
            bad()
    assert sorted(io.read_revisions(spark, f"file://{tmp_path}/data/conf")) == ["main", "v1"]


def test_a_failed_publish_leaves_the_last_revision(spark, rows, tmp_path):
    hub = Revisions(spark, f"file://{tmp_path}", "data")
    hub.publish(rows)
    broken = rows.withColumn("x", F.when(F.col("idx") > 100, F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        hub.publish(broken)
    assert hub.numbers("main") == [1] and hub.read().count() == 90
    assert not [f for f in os.listdir(f"{tmp_path}/data/refs/main") if f.startswith("_")]


def test_two_writers_get_two_numbers(spark, rows, tmp_path):
    hub = Revisions(spark, f"file://{tmp_path}", "data")
    got = []
    ts = [threading.Thread(target=lambda k=k: got.append(hub.publish(rows.limit(k + 1), note=str(k)).number)) for k in range(4)]
    for t in ts:
        t.start()
    for t in ts:
        t.join()
    assert sorted(got) == [1, 2, 3, 4] and sorted(e.note for e in hub.log()) == ["0", "1", "2", "3"]


def test_files_in_order(spark, rows, tmp_path):
    path = f"file://{tmp_path}/o"
    manifest = ordered.write_ordered(rows.repartition(7), path, files=5)
    assert manifest == ordered.read_manifest(spark, path) and sum(m["rows"] for m in manifest) == 90 and len(manifest) >= 5
    for split, want in (("test", [6 * i for i in range(30)]), ("train", [2 * i for i in range(90) if i % 3])):
        names = sorted(glob.glob(f"{tmp_path}/o/split={split}/*.parquet"))
        assert [f"file://{n}" for n in names] == [m["file"].replace("file:/", "file:///").replace("////", "///") for m in manifest if m["split"] == split]
        import pyarrow.parquet as pq

        assert [x for n in names for x in pq.read_table(n, partitioning=None)["idx"].to_pylist()] == want
        assert sorted(r.idx for r in ordered.read_ordered(spark, path, split).collect()) == want
        assert sorted(r.idx for r in ordered.read_ordered(spark, path, split, skip=4, take=9).collect()) == want[4:13]
        assert ordered.read_ordered(spark, path, split, skip=1000).count() == 0
    with pytest.raises(ValueError):
        ordered.read_ordered(spark, path, "dev")
    flat = ordered.write_ordered(rows.drop("split"), f"{path}2", files=3)
    assert [m["first"]["idx"] for m in flat] == sorted(m["first"]["idx"] for m in flat) and len(flat) == 3


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("b/c", 1, "x<&>", 0.5, True), ("a", 2, None, float("nan"), False), ("B:C", 3, " é\x01", 1e-9, None)], "g string, n long, t string, v double, ok boolean")
    assert workbook.write_workbook(df, "g", f"{tmp_path}/w.xlsx") == ["B_C", "a", "b_c_2"]
    z = zipfile.ZipFile(f"{tmp_path}/w.xlsx")
    for n in z.namelist():
        ET.fromstring(z.read(n))
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    assert [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{ns['m']}}}sheet")] == ["B_C", "a", "b_c_2"]
    cells = {c.get("r"): "".join(c.itertext()) for c in ET.fromstring(z.read("xl/worksheets/sheet3.xml")).iter(f"{{{ns['m']}}}c")}
    assert cells == {"A1": "g", "B1": "n", "C1": "t", "D1": "v", "E1": "ok", "A2": "b/c", "B2": "1", "C2": "x<&>", "D2": "0.5", "E2": "1"}
    assert [workbook.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert workbook.write_workbook(df.limit(0), "g", f"{tmp_path}/e.xlsx") == ["empty"]
    with pytest.raises(ValueError):
        workbook.write_workbook(df, "g", f"{tmp_path}/f.xlsx", most=2)
    long = workbook.sheet_names(["x" * 40, "X" * 40, "", None])
    assert len(set(map(str.lower, long))) == 4 and max(map(len, long)) <= 31


def test_snapshot_waits_and_chooses(spark, tmp_path):
    base = tmp_path / "up"
    looks = []

    def sleep(_):
        looks.append(1)
        if len(looks) == 2:
            for n in ("checkpoint-5/model.safetensors", "checkpoint-5/global_step5/a", "checkpoint-5/x.pth", "checkpoint-6/model.safetensors", "checkpoint-5/trainer_state.json", "latest"):
                (base / n).parent.mkdir(parents=True, exist_ok=True)
                (base / n).write_text("x")

    from weir.sources import io as module

    before = module.wait_for
    module.wait_for = lambda look, every, most: wait_for(look, every, most, sleep)
    try:
        got = io.snapshot(spark, f"file://{base}", "checkpoint-5/*", ["checkpoint-5/global_step*", "*.pth", "*trainer_state.json"], every=1)
    finally:
        module.wait_for = before
    assert [g.split("/up/")[1] for g in got] == ["checkpoint-5/model.safetensors"] and len(looks) == 2
    ticks = iter(range(0, 1000, 10))
    with pytest.raises(TimeoutError):
        wait_for(lambda: [], 20, 50, lambda _: None, lambda: next(ticks))
    assert {r.path.split("/up/")[1] for r in io.read_files(spark, f"file://{base}", "checkpoint-[!6]/?odel*").collect()} == {"checkpoint-5/model.safetensors"}


def test_rows_are_counted_while_the_result_is_written(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["gewone zin over het weer en de kat", "het spijt me zeer", "the cat and the dog of it all", "αβγ woorden hier", "gewone zin over het weer en de kat"])], "idx long, text string")
    counts = RowCounts()
    once = relational.dedup_sequential(counts.at(df, "read"), ["text"])
    out = quality.quality_filter(once, ["text"], counts=counts)
    out.write.parquet(f"{tmp_path}/o")
    assert counts.result() == {"read": 5, "rows": 4, "phrases and letters": 2, "language": 1}
    assert counts.lost() == {"rows": 1, "phrases and letters": 2, "language": 1} and "1 removed" in str(counts)
    kept, both = removed_rows(df.mapInPandas(count, df.schema), lambda x: x.where("idx > 1"))
    kept.write.parquet(f"{tmp_path}/k")
    assert both.result() == {"before": 5, "after": 3} and seen.value == 5


def test_workers_elsewhere_can_import_the_library(tmp_path):
    """A query with Python workers, started from another folder and without PYTHONPATH."""
    docs = "/root/testdata/sf0.001"
    if not os.path.isdir(docs):
        pytest.skip("no tables")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import importlib.util, json\n"
        f"s = importlib.util.spec_from_file_location('__spark_entry__', {repo + '/__spark_entry__.py'!r})\n"
        "m = importlib.util.module_from_spec(s); s.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        f"print(json.dumps({{'n': m.queries()['tokenize_left'](spark, {docs!r}).count()}}))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert json.loads(done.stdout.strip().splitlines()[-1])["n"] > 0, done.stderr[-2000:]


def test_plots_have_every_point_and_error(spark, tmp_path):
    from weir.sources import plots

    df = spark.createDataFrame([("d/1", c, "test_f1", 0.1 * c, 0.05 if c % 2 else None) for c in (4, 1, 3, 2)] + [("d/1", 1, "average", 0.5, None), ("d/1", 2, "average", float("nan"), None)], "dataset string, checkpoint int, metric string, value double, error double")
    files = plots.write_plots(df, f"{tmp_path}/p")
    assert [f.rsplit("/", 1)[1] for f in files] == ["d_1_average.svg", "d_1_test_f1.svg"]
    root = ET.fromstring(open(files[1]).read())
    s = "{http://www.w3.org/2000/svg}"
    dots = [(float(c.get("cx")), float(c.get("cy"))) for c in root.iter(f"{s}circle")]
    assert len(dots) == 4 and dots == sorted(dots, key=lambda d: (d[0], -d[1])) and dots[0][1] > dots[-1][1]
    assert sum(p.get("class") == "error" for p in root.iter(f"{s}path")) == 2
    assert len(list(ET.fromstring(open(files[0]).read()).iter(f"{s}circle"))) == 1
    assert plots.ticks(0.0, 1.0) == [0.0, 0.2, 0.4, 0.6, 0.8, 1.0] and plots.ticks(3, 3)[0] <= 2.5
    assert ET.fromstring(plots.line_plot("empty", [])) is not None
    with pytest.raises(ValueError):
        plots.write_plots(df, f"{tmp_path}/q", most=3)


def test_hub_datasets_are_fetched_whole_and_once(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    calls = []

    def fetch(name, revision, folder):
        calls.append((name, revision))
        os.makedirs(f"{folder}/data", exist_ok=True)
        os.makedirs(f"{folder}/conf", exist_ok=True)
        pq.write_table(pa.table({"x": [0]}), f"{folder}/data/train-00000-of-00002.parquet")
        if len(calls) == 1:
            raise OSError("cut off")
        pq.write_table(pa.table({"x": [1, 2]}), f"{folder}/data/train-00001-of-00002.parquet")
        pq.write_table(pa.table({"x": [3]}), f"{folder}/data/test_sft-00000-of-00001.parquet")
        pq.write_table(pa.table({"x": [9]}), f"{folder}/conf/train.parquet")

    read = lambda **how: io.read_hub(spark, "org/name", f"file://{tmp_path}", fetch=fetch, **how)
    with pytest.raises(OSError):
        read()
    assert sorted((r.split, r.x) for r in read(tries=2).collect()) == [("test_sft", 3), ("train", 0), ("train", 1), ("train", 2)]
    assert [r.x for r in read(config="conf").collect()] == [9] and read(splits="test_sft").count() == 1 and len(calls) == 2
    assert read(revision="v2", splits=["train"]).count() == 3 and calls[-1] == ("org/name", "v2")
    for bad in ({"config": "other"}, {"splits": "dev"}):
        with pytest.raises(ValueError):
            read(**bad)


def test_a_processor_of_ones_own(spark, tmp_path):
    from weir.functions import messages as M
    from weir.operators import generate as G

    class Count(G.Processor):
        schema = "n long"
        empty = "not a number"

        def prepare(self, df):
            return df.select("split", F.lit("n").alias("column"), "idx", F.array(M.message("user", F.col("q"))).alias("messages"))

        def value(self):
            return F.col("text_response").try_cast("long")

        def finish(self, df, done):
            return relational.join_columns(df, done.select("split", "idx", "n"))

    df = spark.createDataFrame([("train", 5, "12"), ("train", 1, "x"), ("train", 9, "7"), ("test", 0, "3")], "split string, idx long, q string")
    got = Count().run(df, G.EchoGenerator, f"file://{tmp_path}/l", max_samples=2)
    assert sorted((r.split, r.idx, r.n) for r in got.collect()) == [("test", 0, 3), ("train", 5, 12)]
    failed = G.read_ledger(spark, f"file://{tmp_path}/l/failed", G.ledger_schema("x string")[1]).collect()
    assert [(r.idx, r.error) for r in failed] == [(1, "not a number")]
