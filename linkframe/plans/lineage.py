"""Lineage cuts in a folder that the whole cluster shares.

Intermediate tables are written as Parquet under ``spark.checkpoint.dir`` and read
again, so a lost executor costs a retry of the tasks it held and nothing more.  The
setting is read from the session; only where it is unset and the master is local (tests,
a laptop) a local default is taken.

The shuffle files of a cut go with it, or those of a query's many cuts would pile up until the
driver happens to collect its garbage.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
import weakref

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, without a trailing slash."""
    path = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        path = f"file://{tempfile.gettempdir()}/linkframe-checkpoints"
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_BATCH_BYTES, _BATCH_ROWS = 4 << 20, 2000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most about 4 MB from now on in this session: an executor holds several buffers of
    a batch's size for each of its tasks, beside its heap.  Smaller limits of the session stay."""
    for key, limit in (("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)):
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if not 0 < now <= limit:
            spark.conf.set(key, str(limit))


def _end(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):
        _delete(spark, root)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark 4.1; others ignore it
_WRITING, _LOCK = weakref.WeakKeyDictionary(), threading.Lock()


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """What this session runs meanwhile deletes its shuffle files when it ends.  Steps may do so at the same time."""
    with _LOCK:
        n, before = _WRITING.get(spark) or (0, spark.conf.get(_CLEANUP, "false"))
        _WRITING[spark] = n + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITING[spark]
            _WRITING[spark] = (n - 1, before) if n > 1 else None
            if n == 1:
                spark.conf.set(_CLEANUP, before)


_OPEN: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _at_exit(spark: SparkSession, root: str) -> None:
    """One exit hook a session deletes all its folders."""
    if spark not in _OPEN:
        _OPEN[spark] = roots = []
        ref = weakref.ref(spark)
        atexit.register(lambda: [_end(s, r) for s in [ref()] if s for r in roots])
    _OPEN[spark].append(root)


def partitions(spark: SparkSession, rows: int, each: int = 1_000_000) -> int:
    """Partitions that so many rows are dealt to: of at most about ``each``, and no fewer than Spark's own, below which it
    would deal both sides of a join anew.  So a task's memory doesn't grow with the rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


class Scratch:
    """A folder of intermediate tables of one query.

    Tables that the returned DataFrame still reads stay until the driver ends;
    ``drop`` removes those that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/linkframe/{name}-{uuid.uuid4().hex}"
        self._n, self._tables = 0, {}
        small_batches(spark)
        _at_exit(spark, self.root)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def cut(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write df and read it back: computed once, lineage ends here."""
        path = self.path(name)
        with shuffles_deleted(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def measured(self, df: DataFrame, name: str = "t", **figures: Column) -> tuple[DataFrame, dict]:
        """cut, and aggregates of df taken while it is written."""
        seen = Observation()
        out = self.cut(df.observe(seen, *(c.alias(k) for k, c in figures.items())), name)
        return out, seen.get

    def buckets(self, size: int, each: int) -> int:
        """Buckets for a size: at least as many as shuffle partitions, below which Spark would shuffle both sides of a join."""
        return max(self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))

    def bucketed(self, df: DataFrame, key: str, buckets: int, parts: list[str] | None = None, deal: bool = True) -> str:
        """The name of a table of df in buckets of ``key``, one file a bucket: joins by the key shuffle only the other
        side.  ``drop_table`` removes it.  Without ``deal`` rows are not shuffled, and each task writes a file a bucket
        that it has rows of: for tables whose tasks have few keys each."""
        name, path = f"linkframe_{uuid.uuid4().hex}", self.path("buckets")
        with shuffles_deleted(self.spark):
            out = (df.repartition(buckets, key) if deal else df).write.option("path", path).option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
            (out.partitionBy(*parts) if parts else out).saveAsTable(name)
        self._tables[name] = path
        return name

    def add_rows(self, name: str, df: DataFrame, key: str, buckets: int, parts: list[str]) -> None:
        """More rows for a table that ``bucketed`` made with these arguments; they lie in its buckets' partitions already."""
        with shuffles_deleted(self.spark):
            out = df.write.mode("append").option("path", self._tables[name]).option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
            out.partitionBy(*parts).saveAsTable(name)

    def drop_table(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(self.spark, self._tables.pop(name))

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            if path := getattr(df, "_scratch_path", None):
                _delete(self.spark, path)

    def drop_path(self, path: str) -> None:
        _delete(self.spark, path)
