"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters, digits and non-ASCII characters after lower-casing A-Z.
An item's windows are its runs of ``n`` words (one window of all its words if it has
fewer).  Each document's window hashes are looked up in the broadcast set; a found hash
counts only if its words equal the window's words, so results are exact.

Defined cases
-------------
* null or empty text: no words, no hits; null item text: no windows.
* null item_id: its windows still hit, but the id joins no list and no count.
* an empty benchmark: no hits; empty documents: an empty result.
* repeated items and rows: each row is judged alone; an id counts once per document.
* extra columns pass through untouched; working columns start with ``__lf_``.
* ties: equal windows of several items count for each; very long texts are scanned whole, a task
  holding the words of one at a time.

Size: the set is kept as arrays and broadcast only while they take at most ``max_broadcast_bytes``,
counted as built (about four times the text).  A larger benchmark is cut by a hash into parts under the bound;
the documents are scanned once a part, which gives row numbers and hits, and these are joined once.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.llm.hashing import pack_rows, window_hashes, word_hashes
from linkframe.plans.lineage import Scratch

#: Bytes that are no part of a word become spaces; A-Z become a-z.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bits of the table that rules most windows out before the search.
_SIEVE = 22


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class TestSet:
    """Windows of benchmark items, as arrays: by window length the sorted hashes, where in one buffer of words each
    window begins, and the number of its item.  16 bytes a window, the words once, and the ids."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        buffer, ids, found = bytearray(), [], {}
        for item_id, text in items:
            words = words_of(text)
            size = min(n, len(words))
            if not size:
                continue
            starts = np.cumsum([len(buffer), *(len(w) + 1 for w in words[: len(words) - size])])
            h, at, owner = found.setdefault(size, (array("Q"), array("Q"), array("I")))
            h.frombytes(window_hashes(word_hashes(words), size).tobytes())
            at.frombytes(starts.astype(np.uint64).tobytes())
            owner.frombytes(np.full(len(starts), len(ids), np.uint32).tobytes())
            buffer += b" ".join(words) + b"\n"
            ids.append(item_id)
        self.buffer, self.ids = bytes(buffer), pa.array(ids, pa.string())
        self.sorted, self.starts, self.owners = {}, {}, {}
        narrow = np.uint32 if len(buffer) < 1 << 32 else np.uint64
        for size, (h, at, owner) in found.items():
            h = np.frombuffer(h, np.uint64)
            order = np.argsort(h, kind="stable")
            self.sorted[size] = h[order]
            self.starts[size] = np.frombuffer(at, np.uint64).astype(narrow)[order]
            self.owners[size] = np.frombuffer(owner, np.uint32)[order]

    @property
    def nbytes(self) -> int:
        return len(self.buffer) + self.ids.nbytes + sum(a.nbytes for d in (self.sorted, self.starts, self.owners) for a in d.values())

    def items_of(self, size: int, h: int, words: bytes) -> frozenset | None:
        """Ids of the items that hold a window of that hash and those words; None if there is no such window."""
        known, end = self.sorted[size], len(words)
        lo, hi = np.searchsorted(known, h, side="left"), np.searchsorted(known, h, side="right")
        mine = [k for k in range(lo, hi) if self.buffer.startswith(words, at := int(self.starts[size][k])) and self.buffer[at + end] in b" \n"]
        return frozenset(i for k in mine if (i := self.ids[int(self.owners[size][k])].as_py()) is not None) if mine else None

    def sieve(self, size: int) -> np.ndarray:
        out = np.zeros(1 << _SIEVE, bool)
        out[self.sorted[size] >> np.uint64(64 - _SIEVE)] = True
        return out


def _scan(tests: TestSet, texts: list[bytes | None], sieves: dict) -> list[tuple[int, list, set]]:
    """For each text: number of words, hit [start, end) word spans merged, item ids."""
    docs = [words_of(t) for t in texts]
    starts = np.cumsum([0, *map(len, docs)])
    h = np.concatenate([word_hashes(w) for w in docs]) if docs else np.empty(0, np.uint64)
    spans: list[list] = [[] for _ in docs]
    ids: list[set] = [set() for _ in docs]
    for size, known in tests.sorted.items():
        w = window_hashes(h, size)
        if not len(w):
            continue
        at = np.flatnonzero(sieves[size][w >> np.uint64(64 - _SIEVE)])
        if not len(at):
            continue
        pos = np.searchsorted(known, w[at])
        pos[pos == len(known)] = 0
        at = at[known[pos] == w[at]]
        owner = np.searchsorted(starts, at, side="right") - 1
        seen: dict = {}  # of these texts' windows
        for i, d in zip(at.tolist(), owner.tolist(), strict=True):
            lo = i - int(starts[d])
            if lo + size > len(docs[d]):
                continue
            words = b" ".join(docs[d][lo : lo + size])
            if words not in seen:
                seen[words] = tests.items_of(size, w[i], words)
            if seen[words] is not None:
                spans[d].append((lo, lo + size))
                ids[d] |= seen[words]
    return [(len(docs[d]), _merged(spans[d]), ids[d]) for d in range(len(docs))]


def _merged(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_HITS_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def _with_hits(docs: DataFrame, tests, text_col: str, only_hits: bool = False) -> DataFrame:
    """Adds __lf_hits; ``only_hits`` drops rows without any."""
    shape = docs.withColumn("__lf_text", F.col(text_col).cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField("__lf_hits", _HITS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tests.value
        sieves = {size: t.sieve(size) for size in t.sorted}
        for batch in batches:
            texts, hits = batch.column(batch.num_columns - 1), []
            for group in pack_rows(range(len(texts)), lambda i: len(texts[i].as_py() or b"") // 6 + 1, 1_000_000):
                for n, spans, ids in _scan(t, [texts[i].as_py() for i in group], sieves):
                    hits.append({"n_words": n, "spans": [{"lo": a, "hi": b} for a, b in spans], "items": sorted(ids)})
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hits, _HITS_ARROW)], names=[*batch.schema.names[:-1], "__lf_hits"])
            yield out.filter(pa.array([bool(x["spans"]) for x in hits])) if only_hits else out

    return shape.mapInArrow(scan, schema)


def _joined(found: DataFrame) -> DataFrame:
    """(__lf_row, __lf_hits) of what several parts have found in a row."""
    by = found.groupBy("__lf_row").agg(
        F.max("__lf_hits.n_words").alias("n_words"), F.flatten(F.collect_list("__lf_hits.spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("__lf_hits.items"))).alias("items")
    )

    def join(batches):
        for batch in batches:
            rows = batch.select(["n_words", "spans", "items"]).to_pylist()
            hits = [
                {"n_words": r["n_words"], "spans": [{"lo": a, "hi": b} for a, b in _merged([(s["lo"], s["hi"]) for s in r["spans"]])], "items": sorted(r["items"])}
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, _HITS_ARROW)], names=["__lf_row", "__lf_hits"])

    return by.mapInArrow(join, T.StructType([T.StructField("__lf_row", T.LongType()), T.StructField("__lf_hits", _HITS)]))


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 10,
    max_broadcast_bytes: int = 128 << 20,
    carry: list[str] | None = None,
) -> DataFrame:
    """docs (or its columns ``carry``) with ``__lf_hits``: words, hit spans, sorted item ids."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text")
    ).where(F.length("text") > 0).distinct()
    # What a TestSet takes: its words, 16 bytes a window (at most one a word), and ids with their offsets.
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    built = F.octet_length("text") + 16 * words + F.coalesce(F.octet_length("id"), F.lit(0)) + 16
    total = items.agg(F.sum(built)).head()[0] or 0
    parts = max(1, math.ceil(total / max_broadcast_bytes))
    scratch = Scratch(spark, "decontamination")

    def tests(k):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k)
        return spark.sparkContext.broadcast(TestSet([(r["id"], r["text"].encode()) for r in mine.collect()], n))

    if parts == 1:
        return _with_hits(docs if carry is None else docs.select(*dict.fromkeys([*carry, text_col])), tests(0), text_col)
    # Documents are written once, with a number a row; each part gives numbers and hits, the first one of all rows.
    docs = docs if carry is None else docs.select(*dict.fromkeys([*carry, text_col]))
    docs = scratch.cut(docs.withColumn("__lf_row", F.monotonically_increasing_id()), "rows")
    found = []
    for k in range(parts):
        sent = tests(k)
        hits = _with_hits(docs.select("__lf_row", text_col), sent, text_col, only_hits=k > 0).select("__lf_row", "__lf_hits")
        found.append(scratch.cut(hits, f"part{k}"))
        sent.destroy()
    return docs.join(scratch.cut(_joined(reduce(DataFrame.union, found)), "hits"), "__lf_row").drop("__lf_row")


def _without(text: bytes, spans: list) -> bytes:
    """text less the bytes from each span's first word to its last."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, pos = [], 0
    for s in spans:
        out.append(text[pos : at[s["lo"]][0]])
        pos = at[s["hi"] - 1][1]
    return b"".join([*out, text[pos:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """docs with contaminated documents dropped, or (mode ``spans``) with the hit words cut out.

    Columns and their order stay; a document without hits is returned byte for byte.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode {mode!r} is neither documents nor spans")
    found = find_hits(docs, benchmark, text_col=text_col, **options)
    if mode == "documents":
        return found.where(F.size("__lf_hits.spans") == 0).select(*docs.columns)

    at = found.columns.index(text_col)
    schema = docs.select(*(F.col(c).cast("string") if c == text_col else F.col(c) for c in docs.columns)).schema

    def cut(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, hits in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if hits["spans"]:
                    texts[i] = _without(texts[i].encode(), hits["spans"]).decode()
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return found.withColumn(text_col, F.col(text_col).cast("string")).select(*docs.columns, "__lf_hits").mapInArrow(cut, schema)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: words, hit words, items found, digest of their ids, verdict."""
    h = find_hits(docs, benchmark, carry=[id_col], **options)
    n_hit = F.aggregate("__lf_hits.spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    return h.select(
        id_col,
        F.col("__lf_hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__lf_hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.col("__lf_hits.items")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
