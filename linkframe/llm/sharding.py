"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's place on the ring is a hash of its text, refined by a hash of its id, so equal
texts stand together.  Each shard owns ``virtual_nodes`` points; a row belongs to the shard
of the next point clockwise, and where that shard is full to ``(1 + slack)`` of the mean load
it continues clockwise to the next shard with room.  Loads are bytes, so shards come out
nearly equal, and only rows of full shards move.

The ring is filled without bringing rows together.  Rows are summed by ring cell (the first
``CELL_BITS`` bits of the place), at most 2**CELL_BITS sums for the driver.  A cell that one
shard can take whole goes there.  A cell that crosses a shard's limit is opened: its rows
are summed again by the next bits, down to the bits of the id's hash and at last those of a
number that each row gets when the keys are written, so even a third of all rows that are
equal in text and id is divided.  A level opens at most one cell a shard, and an opened cell
gives at most 2**PART_BITS sums.  Rows of over ``slack / 4`` of the mean load are few (at most
4 * shards / slack) and are placed one by one before the cells, the largest first: on small
inputs that may be most rows.  The rows' shards come from joins with those small tables.

Law kept: ``bytes`` - every shard holds at most (1 + slack) times the mean, up to one unit
of the last opened level, so at least (1 - (shards - 1) * slack) of it.

Defined cases
-------------
* null text: size 1 and the checksum of no bytes; null ids hash like an empty id.
* repeated rows and equal texts stand at one place, and share a shard while it has room.
* a row larger than a shard's limit goes to the emptiest shard.
* empty input: an empty result; very long texts count whole and are never cut.
* ties between large rows of one size are settled by the hashes of text and id.
* extra columns are kept, but for those named like the results (size, text_crc32, shard, slot),
  which the results replace; working columns start with ``__lf_``.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.plans.lineage import Scratch

CELL_BITS, PART_BITS = 16, 12
_LEVELS = ("__lf_c1", "__lf_c2", "__lf_c3", "__lf_c4")
#: Maps of more rows than this aren't broadcast by force.
MAX_BROADCAST = 1_000_000
RESULTS = ("size", "text_crc32", "shard", "slot")


class Ring:
    """Places of virtual nodes in [0, 2**CELL_BITS) and the shards' loads."""

    def __init__(self, shards: int, limit: float, virtual_nodes: int):
        points = sorted(
            (int(hashlib.md5(f"shard-{s}-{v}".encode()).hexdigest()[:12], 16) / 16.0**12 * (1 << CELL_BITS), s)
            for s in range(shards)
            for v in range(virtual_nodes)
        )
        self.at, self.owner = [p for p, _ in points], [s for _, s in points]
        self.limit, self.load = limit, [0] * shards
        self.closed: set[int] = set()

    def clockwise(self, cell: float):
        """Shards in the order in which their points follow, each once."""
        i, seen = bisect.bisect_left(self.at, cell), set()
        for k in range(len(self.at)):
            s = self.owner[(i + k) % len(self.at)]
            if s not in seen:
                seen.add(s)
                yield s
                if len(seen) == len(self.load):
                    return

    def fit(self, cell: float, size: int) -> int | None:
        """Puts a whole cell on the first shard clockwise that is open.  One without enough room is
        closed and kept for the parts of this cell; None says that the cell has to be opened."""
        for s in self.clockwise(cell):
            if s in self.closed or self.load[s] >= self.limit:
                continue
            if self.load[s] + size > self.limit:
                self.closed.add(s)
                return None
            self.load[s] += size
            return s
        return None

    def place(self, cell: float, size: int) -> int:
        """The first shard clockwise with room, else the emptiest."""
        for s in self.clockwise(cell):
            if self.load[s] + size <= self.limit:
                break
        else:
            s = min(range(len(self.load)), key=lambda k: (self.load[k], k))
        self.load[s] += size
        return s


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with size, checksum and the four levels of the place; the last one holds only once it is written."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    digest = F.md5(text)
    level = lambda h, i, bits: F.conv(F.substring(h, i, bits // 4), 16, 10).cast("int")
    own = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        "*",
        (F.length(text) + 1).cast("long").alias("__lf_size"),
        F.crc32(text).alias("__lf_crc"),
        level(digest, 1, CELL_BITS).alias("__lf_c1"),
        level(digest, 5, PART_BITS).alias("__lf_c2"),
        level(own, 1, PART_BITS).alias("__lf_c3"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << PART_BITS)).cast("int").alias("__lf_c4"),
        digest.alias("__lf_text"),
        own.alias("__lf_own"),
    )


def _plan(spark: SparkSession, rows: DataFrame, shards: int, slack: float, virtual_nodes: int):
    """Maps from large rows and from opened or whole cells to shards."""
    total = rows.agg(F.sum("__lf_size")).head()[0] or 0
    ring = Ring(shards, (1 + slack) * total / shards, virtual_nodes)
    big = max(1, int(total / shards * slack / 4))
    large = {}
    found = (
        rows.where(F.col("__lf_size") > big)
        .groupBy("__lf_size", "__lf_c1", "__lf_text", "__lf_own", "__lf_c4")
        .agg(F.count("*").alias("n"))
        .collect()  # at most 4 * shards / slack rows exceed big
    )
    for r in sorted(found, key=lambda r: (-r["__lf_size"], r["__lf_text"], r["__lf_own"], r["__lf_c4"])):
        large[(r["__lf_text"], r["__lf_own"], r["__lf_c4"])] = ring.place(r["__lf_c1"], r["__lf_size"] * r["n"])
    small = rows.where(F.col("__lf_size") <= big)
    placed: list[tuple] = []  # (c1, c2 or -1, c3 or -1, c4 or -1, shard)
    todo, last = [()], len(_LEVELS) - 1
    for depth in range(len(_LEVELS)):
        if not todo:
            break
        keys = list(_LEVELS[: depth + 1])
        part = small
        if depth:
            opened = spark.createDataFrame(todo, ", ".join(f"{k} int" for k in keys[:-1]))
            part = small.join(F.broadcast(opened), keys[:-1])
        sums = part.groupBy(*keys).agg(F.sum("__lf_size").alias("size")).collect()  # 2**CELL_BITS, then 2**PART_BITS for each of at most ``shards`` opened cells
        todo = []
        ring.closed = set()
        for *key, size in sorted(map(tuple, sums)):
            s = ring.fit(key[0], size) if depth < last else ring.place(key[0], size)
            if s is None:
                todo.append(tuple(key))
            else:
                placed.append((*key, *[-1] * (last - depth), s))
    return large, placed, big


def assign(
    docs: DataFrame,
    shards: int = 8,
    slack: float = 0.002,
    virtual_nodes: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """docs (or its columns ``carry``) with ``shard``, gapless ``slot`` in its shard, ``size`` and ``text_crc32``."""
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    rows = keyed(docs, id_col, text_col).select(*carry, *(f"__lf_{x}" for x in ("size", "crc", "c1", "c2", "c3", "c4", "text", "own")))
    scratch = Scratch(spark, "sharding")
    rows = scratch.cut(rows, "keys")
    large, placed, big = _plan(spark, rows, shards, slack, virtual_nodes)

    def small(table, n):
        return F.broadcast(table) if n <= MAX_BROADCAST else table

    # The maps are bounded by shards / slack and by the number of cells opened.
    big_map = spark.createDataFrame([(*k, s) for k, s in large.items()], "__lf_text string, __lf_own string, __lf_c4 int, __lf_s0 int")
    out = rows.join(small(big_map, len(large)), ["__lf_text", "__lf_own", "__lf_c4"], "left")
    for depth in range(len(_LEVELS)):
        keys = list(_LEVELS[: depth + 1])
        mine = [(*p[: depth + 1], p[-1]) for p in placed if all(x >= 0 for x in p[: depth + 1]) and all(x < 0 for x in p[depth + 1 : -1])]
        level = spark.createDataFrame(mine, ", ".join(f"{k} int" for k in keys) + f", __lf_s{depth + 1} int")
        out = out.join(small(level, len(mine)), keys, "left")
    by_cell = F.coalesce("__lf_s1", "__lf_s2", "__lf_s3", "__lf_s4")
    out = out.withColumn("__lf_shard", F.when(F.col("__lf_size") > big, F.col("__lf_s0")).otherwise(by_cell))
    done = _with_slots(out.drop("__lf_text", "__lf_own", *_LEVELS), scratch)
    scratch.drop(rows)
    return done.select(
        *carry,
        F.col("__lf_size").alias("size"),
        F.col("__lf_crc").alias("text_crc32"),
        F.col("__lf_shard").alias("shard"),
        F.col("__lf_slot").alias("slot"),
    )


def _with_slots(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Numbers rows 0, 1, ... in each shard: each task numbers its rows of a shard while it writes them, and the counts
    of the tasks before it, one row a task and shard, shift them.  No row is shuffled for it."""
    schema = T.StructType([*rows.schema.fields, T.StructField("__lf_task", T.IntegerType()), T.StructField("__lf_n", T.LongType())])

    def number(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            shards, at, sizes = np.unique(batch["__lf_shard"].to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
            order, n = np.argsort(at, kind="stable"), np.empty(len(at), np.int64)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            n[order] = np.arange(len(at)) - first + np.repeat([seen[s] for s in shards.tolist()], sizes)
            seen.update(dict(zip(shards.tolist(), sizes.tolist(), strict=True)))
            columns = [*batch.columns, pa.array(np.full(len(at), task, np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    rows = scratch.cut(rows.mapInArrow(number, schema), "placed")
    counts = rows.groupBy("__lf_shard", "__lf_task").count()
    before = Window.partitionBy("__lf_shard").orderBy("__lf_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__lf_shard", "__lf_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__lf_off"))
    offsets, n = scratch.measured(offsets, "offsets", n=F.count("*"))  # shards * tasks rows
    offsets = F.broadcast(offsets) if n["n"] <= MAX_BROADCAST else offsets
    return rows.join(offsets, ["__lf_shard", "__lf_task"]).withColumn("__lf_slot", F.col("__lf_off") + F.col("__lf_n"))
