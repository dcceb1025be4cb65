"""Dense numbering in sort order, without bringing all rows to one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkframe.plans.lineage import Scratch

#: Rows that one task may number by itself.
SMALL = 200_000


def number(df: DataFrame, order: list, out_col: str = "id", first: int = 0, small: int = SMALL, rows: int | None = None) -> DataFrame:
    """df with ``out_col`` = first, first + 1, ... in the order of the given columns.  df is computed once, by being written
    and counted in one pass; ``rows``, if given, says that it is written already and how many rows it has.

    Few rows are numbered by one window.  Beyond that rows are dealt by ranges of the order;
    each range is numbered by itself and shifted by the sizes of those before.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    scratch = Scratch(df.sparkSession, "number")
    if rows is None:
        df, seen = scratch.measured(df, "rows", n=F.count("*"))
        rows = seen["n"]
    if rows <= small:
        return df.withColumn(out_col, F.row_number().over(Window.orderBy(*order)).cast("long") + (first - 1))
    parts = max(2, math.ceil(rows / small))
    dealt = scratch.cut(df.repartitionByRange(parts, *order).withColumn("__lf_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__lf_range").count()
    before = Window.orderBy("__lf_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    shift = sizes.select("__lf_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__lf_shift"))
    within = F.row_number().over(Window.partitionBy("__lf_range").orderBy(*order))
    return (
        dealt.withColumn("__lf_n", within)
        .join(F.broadcast(shift), "__lf_range")
        .withColumn(out_col, (F.col("__lf_n") + F.col("__lf_shift") + (first - 1)).cast("long"))
        .drop("__lf_range", "__lf_n", "__lf_shift")
    )


def vertices(names: DataFrame, name_col: str = "name", small: int = SMALL) -> DataFrame:
    """(id, name): distinct non-null names numbered from 0 in byte order."""
    distinct = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    return number(distinct, ["name"], small=small).select("id", "name")


def reuse_vertices(names: DataFrame, known: DataFrame, name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """(known vertices of these names, names that have no id)."""
    distinct = names.select(F.col(name_col).alias("name")).distinct()
    return known.join(distinct, "name", "left_semi").select("id", "name"), distinct.join(known, "name", "left_anti")


def out_of_order(df: DataFrame, id_col: str = "id", name_col: str = "name", small: int = SMALL) -> DataFrame:
    """Rows whose name isn't strictly greater than that of the id before (``previous``): none for a valid table.

    Rows are dealt by ranges of ids and compared within each; what stands before the first row of a range is the last row
    of the range before, one row a range.
    """
    scratch = Scratch(df.sparkSession, "order")
    rows, n = scratch.measured(df, "rows", n=F.count("*"))
    parts = max(1, math.ceil(n["n"] / small))
    dealt = scratch.cut(rows.repartitionByRange(parts, id_col).withColumn("__lf_range", F.spark_partition_id()), "ranges")
    order = F.struct(id_col, name_col)
    ends = dealt.groupBy("__lf_range").agg(F.max(order)[name_col].alias("__lf_last"))
    ends = ends.select("__lf_range", F.lag("__lf_last").over(Window.orderBy("__lf_range")).alias("__lf_before"))  # one row a range
    within = F.lag(name_col).over(Window.partitionBy("__lf_range").orderBy(id_col, name_col))
    out = dealt.withColumn("previous", within).join(F.broadcast(ends), "__lf_range")
    out = out.withColumn("previous", F.coalesce("previous", "__lf_before")).drop("__lf_range", "__lf_before")
    return out.where(F.col("previous") >= F.col(name_col))


def page(df: DataFrame, order: list, n: int, offset: int = 0) -> DataFrame:
    """n rows in an order, after the first ``offset``: Spark keeps only that many a partition."""
    return df.orderBy(*order).offset(offset).limit(n)
