"""Registered and private domains by the public suffix list.

The rules come from the copy of the list in Spark's own class path (about ten thousand
rows, so they may be broadcast).  A host meets them by one broadcast join per number of
labels: no shuffle, no user-defined function.

Matching: an exception rule wins; else the rule of most labels, the star of a wildcard
counting as one.  The domain is the suffix and one label more; a host that is itself a suffix,
or whose suffix is unknown, has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkframe.functions.names import first_labels

_LIST = "mozilla/public-suffix-list.txt"
_PRIVATE = "===BEGIN PRIVATE DOMAINS==="


def list_text(spark: SparkSession) -> str:
    jvm = spark._jvm
    stream = jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(_LIST)
    if stream is None:
        raise FileNotFoundError(f"{_LIST} is not on Spark's class path; pass the list's text")
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def parse_rules(text: str, private: bool) -> dict[str, tuple[int, int, int, int]]:
    """Reversed rule without its mark -> (labels, normal, wildcard below it, exception)."""
    out: dict[str, list[int]] = {}
    for line in text.splitlines():
        if _PRIVATE in line and not private:
            break
        rule = line.split()[0] if line.split() else ""
        if not rule or rule.startswith("//"):
            continue
        kind = 2 if rule.startswith("*.") else 3 if rule.startswith("!") else 1
        name = ".".join(reversed(rule.removeprefix("*.").removeprefix("!").lower().split(".")))
        for x in {name, ".".join(p.encode("idna").decode() if not p.isascii() else p for p in name.split("."))}:
            out.setdefault(x, [x.count(".") + 1, 0, 0, 0])[kind] = 1
    return {k: tuple(v) for k, v in out.items()}


def suffix_length(df: DataFrame, rev_name: str, private: bool = False, text: str | None = None) -> DataFrame:
    """df with ``suffix_labels``: the number of labels of the name's public suffix, null if unknown."""
    spark = df.sparkSession
    rules = parse_rules(list_text(spark) if text is None else text, private)
    longest = max((v[0] for v in rules.values()), default=0)
    n = F.size(F.split(F.col(rev_name), r"\."))
    out, normal, wild, exception = df, F.lit(0), F.lit(0), F.lit(0)
    for k in range(1, longest + 1):
        part = [(x, *v[1:]) for x, v in rules.items() if v[0] == k]
        if not part:
            continue
        names = [f"__psl_{c}{k}" for c in ("key", "normal", "wild", "exception")]
        table = spark.createDataFrame(part, f"{names[0]} string, {names[1]} int, {names[2]} int, {names[3]} int")
        key = F.when(n >= k, first_labels(F.col(rev_name), k))
        out = out.join(F.broadcast(table), key == F.col(names[0]), "left").drop(names[0])
        normal = F.greatest(normal, F.when(F.col(names[1]) == 1, k).otherwise(0))
        wild = F.greatest(wild, F.when((F.col(names[2]) == 1) & (n > k), k + 1).otherwise(0))
        exception = F.greatest(exception, F.when(F.col(names[3]) == 1, k - 1).otherwise(0))
    found = F.when(exception > 0, exception).otherwise(F.greatest(normal, wild))
    return out.select(*df.columns, F.when(found > 0, found).alias("suffix_labels"))


def registered_domain(df: DataFrame, rev_name: str, out_col: str = "domain", private: bool = False, text: str | None = None, strict: bool = True) -> DataFrame:
    """df with the reversed registered domain (or private domain) of a reversed host name; null, or the
    name itself if not strict, where there is none."""
    n = F.size(F.split(F.col(rev_name), r"\."))
    found = suffix_length(df, rev_name, private, text)
    domain: Column = F.when(n > F.col("suffix_labels"), first_labels(F.col(rev_name), F.col("suffix_labels") + 1))
    return found.withColumn(out_col, domain if strict else F.coalesce(domain, F.col(rev_name))).drop("suffix_labels")


def is_public_suffix(df: DataFrame, rev_name: str, out_col: str = "is_suffix", private: bool = False, text: str | None = None) -> DataFrame:
    n = F.size(F.split(F.col(rev_name), r"\."))
    return suffix_length(df, rev_name, private, text).withColumn(out_col, F.coalesce(F.col("suffix_labels") == n, F.lit(False))).drop("suffix_labels")


def top_level_domains(spark: SparkSession, text: str | None = None) -> DataFrame:
    """(tld): the last labels of all rules of the list, in ASCII and as written; some thousands at most."""
    rules = parse_rules(list_text(spark) if text is None else text, private=False)
    return spark.createDataFrame([(t,) for t in sorted({r.split(".")[0] for r in rules})], "tld string")


def with_known_tld(df: DataFrame, host_col: str, text: str | None = None) -> DataFrame:
    """Rows whose host ends in a top-level domain of the list."""
    known = top_level_domains(df.sparkSession, text).select(F.col("tld").alias("__lf_tld"))
    return df.join(F.broadcast(known), F.substring_index(host_col, ".", -1) == F.col("__lf_tld"), "left_semi")
