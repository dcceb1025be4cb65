"""Frequencies, degree tables, distributions and graph figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkframe.plans.lineage import Scratch
from linkframe.sources import text


def frequencies(df: DataFrame, key: str) -> DataFrame:
    """(key, cnt), by count downwards, then by key."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "key")


def degree_table(graph) -> DataFrame:
    """(outdegree, indegree, name[, n_hosts]) of every vertex."""
    extra = [c for c in ("n_hosts",) if c in graph.vertices.columns]
    return graph.degrees().join(graph.vertices.select("id", "name", *extra), "id").select("outdegree", "indegree", "name", *extra)


def degree_distribution(degrees: DataFrame, col: str) -> DataFrame:
    """(arcs, nodes): vertices of each degree that occurs."""
    return degrees.groupBy(F.col(col).alias("arcs")).agg(F.count("*").alias("nodes"))


OUTPUTS = ("outdegree-indegree", "top-outdegree", "top-indegree", "outdegree-distribution", "indegree-distribution")


def degree_outputs(graph, path: str, more_than: int = 1000, n: int = 10_000, gzip: bool = True) -> DataFrame:
    """Writes path/outdegree-indegree, path/top-outdegree, path/top-indegree, path/outdegree-distribution and
    path/indegree-distribution, and returns the degree table.  Edges are read once: the table is written as Parquet
    and feeds all five."""
    table = Scratch(graph.spark, "degrees").cut(degree_table(graph), "degrees")
    text.write_table(table, f"{path}/outdegree-indegree", gzip)
    for col in ("outdegree", "indegree"):
        text.write_table(top_by_degree(table, col, more_than, n), f"{path}/top-{col}", gzip)
        text.write_table(degree_distribution(table, col).orderBy("arcs"), f"{path}/{col}-distribution", gzip)
    return table


def _line(cols: list[str]) -> Column:
    return F.concat_ws("\t", *(F.col(c).cast("string") for c in cols))


def top_by_degree(table: DataFrame, col: str, more_than: int = 1000, n: int = 10_000) -> DataFrame:
    """The n rows of the largest degree over a bound; ties by the bytes of the row's text."""
    return table.where(F.col(col) > more_than).orderBy(F.desc(col), _line(table.columns)).limit(n)


def graph_stats(graph) -> DataFrame:
    """One row: nodes, arcs, loops, largest and mean degrees, vertices without out- or in-edges."""
    deg = graph.degrees().agg(
        F.count("*").alias("nodes"),
        F.sum("outdegree").alias("arcs"),
        F.max("outdegree").alias("maxoutdegree"),
        F.max("indegree").alias("maxindegree"),
        F.avg("outdegree").alias("avgoutdegree"),
        F.avg("indegree").alias("avgindegree"),
        F.count_if(F.col("outdegree") == 0).alias("dangling"),
        F.count_if(F.col("indegree") == 0).alias("sources"),
    )
    loops = graph.edges.agg(F.count_if(F.col("src") == F.col("dst")).alias("loops"))
    return deg.withColumn("k", F.lit(0)).join(loops.withColumn("k", F.lit(0)), "k").drop("k")
