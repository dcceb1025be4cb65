"""A growing set of distinct links, crawl by crawl.

Links lie in buckets by a hash of both hosts.  A crawl is added in two steps: buckets that get new links are written
anew, with what they held, to folders of a new generation; then a manifest of that generation appears by one
rename.  It names the folder of every bucket and the crawls that are in.  So a crawl that was added already
changes nothing, an interrupted one leaves the last generation as it was, buckets that a crawl has no links of are not
read, and those it has no new links of are not written.

Any number of readers may hold an older generation; ``tidy`` deletes folders that the newest doesn't name.
Additions to one folder must not overlap.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe import schemas
from linkframe.plans.lineage import Scratch

_MANIFEST = re.compile(r"(\d{8})\.json")


class LinkStore:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p}")
        self._fs = jvm.org.apache.hadoop.fs.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._kind = T.StructType([*schemas.HOST_LINKS.fields, T.StructField("bucket", T.IntegerType())])

    # --- manifests -----------------------------------------------------------------------

    def _generations(self) -> list[int]:
        at = self._path("manifests")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(m[1]) for n in names if (m := _MANIFEST.fullmatch(n)))

    def manifest(self) -> dict:
        """generation, buckets, crawls, and the folder of each bucket that holds links."""
        known = self._generations()
        if not known:
            return {"generation": 0, "buckets": self.buckets, "crawls": [], "folders": {}}
        stream = self._fs.open(self._path(f"manifests/{known[-1]:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, m: dict) -> None:
        part = self._path(f"manifests/{uuid.uuid4().hex}.part")
        out = self._fs.create(part)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        if not self._fs.rename(part, self._path(f"manifests/{m['generation']:08d}.json")):
            raise RuntimeError(f"generation {m['generation']} of {self.folder} exists: two additions at a time")

    # --- links ---------------------------------------------------------------------------

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._kind)
        paths = [f"{self.folder}/{f}" for f in sorted(folders)]
        return self.spark.read.schema(self._kind).option("basePath", f"{self.folder}/links").parquet(*paths)

    def links(self) -> DataFrame:
        """(src_host, dst_host) of all crawls that are in."""
        return self._read(list(self.manifest()["folders"].values())).select("src_host", "dst_host")

    def crawls(self) -> list[str]:
        return self.manifest()["crawls"]

    def prepare(self, crawl: str, links: DataFrame) -> dict | None:
        """Writes the buckets that get new links; the manifest to commit, or None if the crawl is in."""
        m = self.manifest()
        if crawl in m["crawls"]:
            return None
        scratch = Scratch(self.spark, "crawl")
        bucket = F.pmod(F.xxhash64("src_host", "dst_host"), F.lit(m["buckets"])).cast("int")
        all_ = scratch.cut(links.select("src_host", "dst_host").distinct().withColumn("bucket", bucket), "links")
        present = [r["bucket"] for r in all_.select("bucket").distinct().collect()]  # at most the number of buckets
        held = self._read([m["folders"][str(b)] for b in present if str(b) in m["folders"]])
        new = scratch.cut(all_.join(held, ["bucket", "src_host", "dst_host"], "left_anti").select(*all_.columns), "new")
        scratch.drop(all_)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most the number of buckets
        generation = m["generation"] + 1
        folders = dict(m["folders"])
        if touched:
            old = self._read([folders[str(b)] for b in touched if str(b) in folders])
            rows = old.select(*new.columns).unionByName(new)
            out = f"links/generation={generation:08d}-{uuid.uuid4().hex}"
            dealt = rows.repartition(len(touched), "bucket").sortWithinPartitions("bucket", "src_host", "dst_host")
            dealt.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.folder}/{out}")
            folders |= {str(b): f"{out}/bucket={b}" for b in touched}
        scratch.drop(new)
        return {"generation": generation, "buckets": m["buckets"], "crawls": [*m["crawls"], crawl], "folders": folders, "touched": sorted(touched)}

    def add(self, crawl: str, links: DataFrame) -> list[int]:
        """Merges a crawl; the buckets that were written."""
        m = self.prepare(crawl, links)
        if m is None:
            return []
        self._commit(m)
        return m["touched"]

    def tidy(self) -> int:
        """Deletes bucket folders of older generations and of interrupted additions; their number."""
        held, at, gone = set(self.manifest()["folders"].values()), self._path("links"), 0
        for top in self._fs.listStatus(at) if self._fs.exists(at) else []:
            name, left = top.getPath().getName(), 0
            for f in self._fs.listStatus(top.getPath()):
                if f.isDirectory() and f"links/{name}/{f.getPath().getName()}" not in held:
                    gone += self._fs.delete(f.getPath(), True)
                else:
                    left += f.isDirectory()
            if not left:
                self._fs.delete(top.getPath(), True)
        return gone
