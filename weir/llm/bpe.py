"""BPE encoding and decoding with a vocabulary file, long texts by tree concatenation.

Short texts are encoded word by word with a cache.  A text beyond
``piece_chars`` is cut into pieces of that length wherever they end, inside
words too; pieces are encoded in parallel tasks and joined in a binary tree.
A join re-encodes a window around the cut and lets it grow until its tokens
agree with the left side's and with the right side's; then the left tokens
before, the window's tokens between and the right tokens after are what the
whole would give.  A window that has grown over both sides is the whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import free_names

CACHE_WORDS = 300_000
AGREE = 3  # tokens that must be the same on each side of a cut

#: Characters whose normal form, case and class are the same in every Unicode version and whose
#: lower case has as many bytes: Basic Latin, Latin-1 and Latin Extended-A without dotted I.
_PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-įı-ſ]*")
_letters = "".join(chr(i) for i in range(0x180) if unicodedata.category(chr(i))[0] == "L")
_numbers = "".join(chr(i) for i in range(0x180) if unicodedata.category(chr(i))[0] == "N")
_PRETOKEN = re.compile(rf"[{_letters}]+|'(?:s|t|re|ve|m|ll|d)|[{_numbers}]|[^\s{_letters}{_numbers}]+")


def _byte_alphabet() -> dict[int, str]:
    """Bytes as printable characters: those that print stand for themselves, the rest follow from U+0100."""
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


class Codec:
    """One vocabulary file; encodes as the library does without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.model = self.lib.model
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.special_id = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.tokens = [""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.tokens[i] = t
        end = spec["model"].get("end_of_word_suffix") or ""
        self.length = np.array([len(t.removesuffix(end)) for t in self.tokens], dtype=np.int64)
        self.names = np.array(self.tokens, dtype=object)
        self.alphabet = _byte_alphabet()
        self.ids: dict[str, str] = {}
        self.toks: dict[str, str] = {}

    def normal(self, text: str) -> str:
        """The text as the model sees it, without special tokens in it."""
        if _PLAIN.fullmatch(text):
            return text.lower()
        return self.lib.normalizer.normalize_str(text)

    def pretokens(self, normal: str) -> list[str]:
        if _PLAIN.fullmatch(normal):
            return _PRETOKEN.findall(normal)
        return [normal[a:b] for _, (a, b) in self._split(normal)]

    def _split(self, normal: str):
        import regex

        if not hasattr(self, "_any"):
            self._any = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        return ((None, m.span()) for m in self._any.finditer(normal))

    def word_ids(self, pretoken: str) -> list[int]:
        a = self.alphabet
        return [t.id for t in self.model.tokenize("".join([a[b] for b in pretoken.encode()]))]

    def _learn(self, word: str) -> None:
        if len(self.ids) >= CACHE_WORDS:
            self.ids.clear()
            self.toks.clear()
        ids = [i for p in _PRETOKEN.findall(word) for i in self.word_ids(p)]
        self.ids[word] = " ".join(map(str, ids))
        self.toks[word] = " ".join([self.tokens[i] for i in ids])

    def strings(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, their ids and their texts, joined by spaces."""
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            e = self.lib.encode(text, add_special_tokens=False)
            return len(e.ids), " ".join(map(str, e.ids)), " ".join(self.names[e.ids]) if e.ids else ""
        ws = text.lower().split()
        while True:
            try:
                a = " ".join([self.ids[w] for w in ws])
                b = " ".join([self.toks[w] for w in ws])
                break
            except KeyError:
                if len(ws) > CACHE_WORDS // 2:  # more words than the cache may hold: no cache
                    ids = [i for w in ws for p in _PRETOKEN.findall(w) for i in self.word_ids(p)]
                    return len(ids), " ".join(map(str, ids)), " ".join(self.names[ids])
                for w in ws:
                    if w not in self.ids:
                        self._learn(w)
        return a.count(" ") + 1 if a else 0, a, b

    def encode_normal(self, normal: str) -> np.ndarray:
        """Ids of normalised text without special tokens."""
        if _PLAIN.fullmatch(normal):
            out: list[str] = []
            for w in normal.split():
                if len(w) > 64:
                    out.extend(str(i) for p in _PRETOKEN.findall(w) for i in self.word_ids(p))
                    continue
                if w not in self.ids:
                    self._learn(w)
                out.append(self.ids[w])
            joined = " ".join(out)
            return np.array(joined.split(), dtype=np.int32) if joined else np.empty(0, np.int32)
        return np.array([i for p in self.pretokens(normal) for i in self.word_ids(p)], dtype=np.int32)

    def join(self, text: str, cut: int, left: np.ndarray, right: np.ndarray, window: int = 64) -> np.ndarray:
        """Ids of ``text`` from those of text[:cut] and text[cut:].

        Places are counted in bytes that tokens cover, so white space has none.
        """
        if not len(left) or not len(right):  # one side is white space
            return np.concatenate([left, right])
        at = int(self.length[left].sum())
        l_end, r_end = np.cumsum(self.length[left]), at + np.cumsum(self.length[right])
        w = window
        while True:
            a, b = max(0, cut - w), min(len(text), cut + w)
            mid = self.encode_normal(text[a:b])
            if a == 0 and b == len(text):
                return mid
            m_end = at - _covered(text[a:cut]) + np.cumsum(self.length[mid])
            i = 0 if a == 0 else _agreement(left, l_end, mid, m_end, at, before=True)
            j = 0 if b == len(text) else _agreement(right, r_end, mid, m_end, at, before=False)
            if i is not None and j is not None:
                head = left[: i[0]] if a else left[:0]
                tail = right[j[0] :] if b < len(text) else right[:0]
                lo = i[1] if a else 0
                hi = j[1] if b < len(text) else len(mid)
                if lo <= hi:
                    return np.concatenate([head, mid[lo:hi], tail])
            w *= 2

    def tree(self, pieces: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """Joins neighbours in rounds until one is left."""
        while len(pieces) > 1:
            texts, out = [], []
            for k in range(0, len(pieces), 2):
                if k + 1 == len(pieces):
                    texts.append(pieces[k])
                    out.append(ids[k])
                else:
                    texts.append(pieces[k] + pieces[k + 1])
                    out.append(self.join(texts[-1], len(pieces[k]), ids[k], ids[k + 1]))
            pieces, ids = texts, out
        return ids[0] if ids else np.empty(0, np.int32)


def _covered(text: str) -> int:
    """Bytes of a normalised text without its white space."""
    return len("".join(text.split()).encode())


def _agreement(side: np.ndarray, s_end: np.ndarray, mid: np.ndarray, m_end: np.ndarray, at: int, before: bool) -> tuple[int, int] | None:
    """Where AGREE tokens in a row are the same in both, places included: the index behind (before the cut)
    or of the first (after it) of them, in either.  A token that starts with the window or the cut is no witness."""
    _, p, q = np.intersect1d(s_end, m_end, assume_unique=True, return_indices=True)
    same = side[p] == mid[q]
    run = (np.diff(p) == 1) & (np.diff(q) == 1) & same[1:] & same[:-1]
    need = AGREE - 1
    if len(run) < need:
        return None
    full = np.convolve(run, np.ones(need, int))[need - 1 : len(run)] == need
    ks = np.flatnonzero(full)
    if before:
        ks = ks[s_end[p[ks + need]] <= at]
        ks = ks[q[ks] > 0]
        return (int(p[ks[-1] + need]) + 1, int(q[ks[-1] + need]) + 1) if len(ks) else None
    ks = ks[p[ks] > 0]
    ks = ks[q[ks + need] < len(mid) - 1]
    return (int(p[ks[0]]), int(q[ks[0]])) if len(ks) else None


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's own copy; kept for its cache."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _digest(n: int, ids: str, toks: str) -> tuple[int, str, str]:
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(toks.encode()).hexdigest()


def encode(docs: DataFrame, vocab: str, piece_chars: int = 32768, texts: bool = False, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns with n_tokens and the digests of ids and decoded text, or with ``texts`` the ids and the decoded text too.

    A null text is an empty one: no tokens, digests of the empty string.  Equal
    rows give equal rows, so ties do not matter.  Texts beyond ``piece_chars`` characters take the tree.  Columns that are
    not carried may have any names; carried ones may not be named like those that are added (ValueError).
    """
    free_names(carry, ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded", "_row", "_seg", "_k", "_piece", "_ids"))
    schema = docs.select(*carry).schema
    names = list(carry)
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if texts else "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    full = f"{ddl}, {out}"
    out_names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if texts else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32()), pa.string()] if texts else [])]

    def result(n: int, ids: str, toks: str) -> tuple:
        base = _digest(n, ids, toks)
        return (*base, np.array(ids.split(), dtype=np.int32), toks) if texts else base

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for b in batches:
            got = [result(*c.strings(t or "")) for t in b.column("text").to_pylist()]
            cols = [b.column(n) for n in names]
            new = [pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*cols, *new], names=[*names, *out_names])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of long texts; special tokens stand alone, with no text of theirs to join."""
        c, part, row = codec(vocab), TaskContext.get().partitionId(), 0
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):
                row, rows = row + 1, []
                for s, seg in enumerate(c.split_special.split(text)):
                    if seg in c.special_id:
                        rows.append((s, 0, seg))
                        continue
                    seg = c.normal(seg)
                    rows += [(s, k, seg[j : j + piece_chars]) for k, j in enumerate(range(0, len(seg), piece_chars))]
                for lo in range(0, len(rows), 64):
                    some = rows[lo : lo + 64]
                    own = b.slice(i, 1).take(pa.array([0] * len(some)))
                    new = [pa.array([f"{part}-{row}"] * len(some)), *(pa.array([r[k] for r in some], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.string())))]
                    yield pa.RecordBatch.from_arrays([*(own.column(n) for n in names), *new], names=[*names, "_row", "_seg", "_k", "_piece"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for b in batches:
            ids = [(np.array([c.special_id[p]], np.int32) if p in c.special_id else c.encode_normal(p)).tobytes() for p in b.column("_piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], names=[*b.schema.names, "_ids"])

    def whole(t: pa.Table) -> pa.Table:
        c, parts = codec(vocab), {}
        for s, k, piece, ids in sorted(zip(*(t.column(n).to_pylist() for n in ("_seg", "_k", "_piece", "_ids")), strict=True)):
            parts.setdefault(s, []).append((piece, np.frombuffer(ids, np.int32)))
        ids = np.concatenate([c.tree([p for p, _ in parts[s]], [i for _, i in parts[s]]) for s in sorted(parts)])
        got = result(len(ids), " ".join(map(str, ids.tolist())), " ".join(c.names[ids]) if len(ids) else "")
        head = t.select(names).slice(0, 1)
        for n, v, kind in zip(out_names, got, kinds, strict=True):
            head = head.append_column(n, pa.array([v], kind))
        return head

    rows = docs.select(*{**dict.fromkeys(names), "text": None})
    is_long = F.coalesce(F.length("text"), F.lit(0)) > piece_chars
    few = rows.filter(~is_long).mapInArrow(short, full)
    long_ = rows.filter(is_long)
    pieces = long_.mapInArrow(cut, f"{ddl}, _row string, _seg int, _k int, _piece string")
    spread = pieces.repartition(F.col("_row"), F.col("_k")).mapInArrow(leaf, f"{ddl}, _row string, _seg int, _k int, _piece string, _ids binary")
    return few.unionByName(spread.groupBy("_row").applyInArrow(whole, full))


def decode(ids: list[int], vocab: str) -> str:
    """The texts of the tokens, special ones too, joined by spaces: this vocabulary names no decoder."""
    return " ".join(codec(vocab).names[ids]) if len(ids) else ""
