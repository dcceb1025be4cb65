"""Host links from pages, and the numbering of hosts and links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkframe import schemas
from linkframe.functions.names import ascii_hosts, is_valid_host, link_host, normalize_host, reverse_host, url_host
from linkframe.functions.suffixes import with_known_tld
from linkframe.operators.enumerate import number, reuse_vertices, vertices

_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def page_hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with ``host``; pages whose URL has none are dropped."""
    return pages.withColumn("host", url_host(F.col(url_col))).where(F.col("host").isNotNull())


def extract_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src_host, dst_host) of every anchor, relative ones leading to the page's own host."""
    link = F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_HREF), F.lit(1)))
    rows = page_hosts(pages, url_col).select("host", link.alias("link"))
    return rows.select(F.col("host").alias("src_host"), link_host(F.col("link"), F.col("host")).alias("dst_host")).where("dst_host IS NOT NULL")


def redirect_links(responses: DataFrame, url_col: str = "url", location_col: str = "location", carry: list[str] | None = None) -> DataFrame:
    """(src_host, dst_host) of redirects, beside the columns to carry."""
    rows = page_hosts(responses, url_col)
    return rows.select(*(carry or []), F.col("host").alias("src_host"), link_host(F.col(location_col), F.col("host")).alias("dst_host")).where("dst_host IS NOT NULL")


def sitemap_links(robots: DataFrame, url_col: str = "url", text_col: str = "text") -> DataFrame:
    """(src_host, dst_host) of the Sitemap lines of robots.txt files."""
    line = F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1)))
    rows = page_hosts(robots, url_col).select("host", line.alias("link"))
    return rows.select(F.col("host").alias("src_host"), link_host(F.col("link"), F.col("host")).alias("dst_host")).where("dst_host IS NOT NULL")


def list_inputs(spark: SparkSession, *folders: str, glob: str = "part-*") -> DataFrame:
    """(path, length) of the files in folders; their contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(list(folders))
    return files.select("path", "length")


def read_links(spark: SparkSession, *paths: str) -> DataFrame:
    """Host links of any number of Parquet inputs."""
    return spark.read.schema(schemas.HOST_LINKS).parquet(*paths)


def valid_links(links: DataFrame, normalize: bool = False, known_tlds: bool = False, suffix_text: str | None = None) -> DataFrame:
    """Links whose two hosts are valid names, normalised first if asked for (non-ASCII labels to their ``xn--`` form);
    with ``known_tlds`` their top-level domains must be those of the suffix list."""
    out = links.select("src_host", "dst_host")
    if normalize:
        out = out.select(normalize_host(F.col("src_host")).alias("src_host"), normalize_host(F.col("dst_host")).alias("dst_host"))
        for c in out.columns:
            out = ascii_hosts(out, c)
    out = out.where(is_valid_host(F.col("src_host")) & is_valid_host(F.col("dst_host")))
    if known_tlds:
        for c in ("src_host", "dst_host"):
            out = with_known_tld(out, c, suffix_text)
    return out


def input_batches(paths: DataFrame, most: int = 64_000, seed: int = 1, path_col: str = "path") -> DataFrame:
    """paths with ``batch``: a seeded random permutation cut every ``most`` paths, so that no batch is larger and all
    but the last are full.  The same seed gives the same batches, whatever the order and partitions of paths."""
    dealt = number(paths, [F.xxhash64(F.lit(seed), path_col), F.col(path_col)], "__lf_place")
    return dealt.withColumn("batch", F.floor(F.col("__lf_place") / most)).drop("__lf_place")


def write_input_jobs(paths: DataFrame, folder: str, most: int = 64_000, seed: int = 1, path_col: str = "path") -> None:
    """One folder a job, folder/batch=k, with its paths in random order: what a job reads as its input list."""
    jobs = input_batches(paths, most, seed, path_col).select(F.col(path_col).alias("value"), "batch")
    dealt = jobs.repartition("batch").sortWithinPartitions("batch", F.xxhash64(F.lit(seed), "value"))
    dealt.write.partitionBy("batch").text(folder)


def read_input_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, path) of all jobs."""
    return spark.read.text(folder).select(F.col("batch").cast("long").alias("batch"), F.col("value").alias("path"))


def union_inputs(*lists: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, lists)


def host_graph(links: DataFrame, known: DataFrame | None = None, reverse: bool = True) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of (src_host, dst_host): reversed names numbered in byte order, distinct edges without loops.

    With ``known`` vertices their ids are used, and a host without one raises an error.
    """
    name = reverse_host if reverse else (lambda c: c)
    rows = links.select(name(F.col("src_host")).alias("s"), name(F.col("dst_host")).alias("d")).distinct()
    names = rows.select(F.col("s").alias("name")).union(rows.select(F.col("d").alias("name")))
    if known is None:
        found = vertices(names)
    else:
        found, unknown = reuse_vertices(names, known)
        if not unknown.isEmpty():
            raise ValueError("some hosts have no id among the known vertices")
    return found, number_links(rows, found, "s", "d")


def number_links(rows: DataFrame, found: DataFrame, s: str | Column, d: str | Column) -> DataFrame:
    """Distinct (src, dst) of links by name, without loops."""
    a, b = found.select(F.col("id").alias("src"), F.col("name").alias(s)), found.select(F.col("id").alias("dst"), F.col("name").alias(d))
    return rows.join(a, s).join(b, d).select("src", "dst").where("src <> dst").distinct()
