"""Weakly and strongly connected components of distributed edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkframe.operators.enumerate import number
from linkframe.plans.lineage import Scratch


def min_reachable(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, comp) of every node of an edge (a, b) that is no loop; comp is the smallest node of its component.

    Large-star and small-star contraction: the edges of each round are written to the shared
    folder, and a round that changes nothing ends it.  Hot centres are joined by shuffle joins
    in which Spark splits large partitions.
    """

    state = {"n": F.count("*"), "hash": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}  # taken while a round is written
    e, before = scratch.measured(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", **state)
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        new, after = scratch.measured(small.where("a <> b").distinct(), "edges", **state)
        scratch.drop(e)
        e = new
        if after == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(e.select("b", "b").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _renumbered(found: DataFrame) -> DataFrame:
    """(id, comp) of (id, root): components numbered from 0 by size, then by smallest member."""
    sizes = found.groupBy("root").agg(F.count("*").alias("size"), F.min("id").alias("least"))
    ids = number(sizes, [F.desc("size"), F.col("least")], "comp")
    return found.join(ids.select("root", "comp"), "root").select("id", "comp")


def weak_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, comp) of every vertex."""
    scratch = Scratch(vertices.sparkSession, "wcc")
    found = min_reachable(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")), scratch)
    all_ = vertices.select("id").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("comp", "id").alias("root"))
    return _renumbered(scratch.cut(all_, "wcc"))


def _ends(e: DataFrame) -> DataFrame:
    """(id, o, to, i, of): out- and in-degrees, and a neighbour on each side, in one pass over edges."""
    both = e.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("to"), F.lit(None).cast("long").alias("of")),
        F.struct(F.col("dst").alias("id"), F.lit(None).cast("long").alias("to"), F.col("src").alias("of")),
    )).alias("x")).select("x.*")
    return both.groupBy("id").agg(F.count("to").alias("o"), F.min("to").alias("to"), F.count("of").alias("i"), F.min("of").alias("of"))


def _without(e: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges that touch none of gone(id)."""
    for side in ("src", "dst"):
        e = e.join(gone.select(F.col("id").alias(side)), side, "left_anti")
    return e.select("src", "dst")


def _bypass(e: DataFrame, scratch: Scratch, salt: int) -> tuple[DataFrame, DataFrame | None, bool]:
    """One round of elimination: (remaining edges, what was bypassed, whether to go on).

    A vertex without out- or in-edges is a component by itself.  One with a single out-edge v -> u is bypassed: its
    in-edges lead to u, which leaves all other vertices as connected as they were; likewise one with a
    single in-edge.  Of neighbours that could go, the one of the larger random key goes, so a chain
    loses about a third of its vertices a round.  The second table, (id, via, other), keeps what
    ``_resolved`` needs to place the bypassed vertices.
    """
    ends, n = scratch.measured(_ends(e).withColumn("key", F.xxhash64("id", F.lit(salt))), "ends", all=F.count("*"), open=F.count_if(F.expr("o < 2 OR i < 2")))
    if not n["open"]:
        scratch.drop(ends)
        return e, None, False
    single = ends.where("o = 0 OR i = 0").select("id")
    could = ends.where("o > 0 AND i > 0 AND (o = 1 OR i = 1)")
    a, b = (could.select(F.col("id").alias(side), F.struct("key", "id").alias(f"key_{side}")) for side in ("src", "dst"))
    lower = F.when(F.col("key_src") < F.col("key_dst"), F.col("src")).otherwise(F.col("dst"))
    losers = e.join(a, "src").join(b, "dst").select(lower.alias("id")).distinct()
    chosen = scratch.cut(could.join(losers, "id", "left_anti"), "chosen")
    forward, backward = chosen.where("o = 1"), chosen.where("o > 1")
    rows = e.join(forward.select(F.col("id").alias("dst"), "to"), "dst").select(F.col("dst").alias("id"), F.col("to").alias("via"), F.col("src").alias("other"), F.lit(True).alias("forward"))
    rows = rows.union(e.join(backward.select(F.col("id").alias("src"), "of"), "src").select(F.col("src").alias("id"), F.col("of").alias("via"), F.col("dst").alias("other"), F.lit(False).alias("forward")))
    passed = scratch.cut(rows, "passed")
    new = passed.where("via <> other").select(F.when(F.col("forward"), F.col("other")).otherwise(F.col("via")).alias("src"), F.when(F.col("forward"), F.col("via")).otherwise(F.col("other")).alias("dst"))
    gone = single.union(chosen.select("id"))
    left = scratch.cut(_without(e, gone).union(_without(new, single)).distinct(), "edges")
    went = gone.count()
    scratch.drop(e, ends, chosen)
    return left, passed, 10 * went >= n["all"]


def _coloured(e: DataFrame, scratch: Scratch, salt: int) -> DataFrame:
    """(id, root) of the components that one colouring finds, at least one.

    Every vertex takes the largest random key that reaches it as its colour; what reaches a colour's own vertex
    within the colour is a component.  All colours do so at once.
    """
    nodes = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct()
    colour = scratch.cut(nodes.select("id", F.struct(F.xxhash64("id", F.lit(salt)).alias("k"), F.col("id").alias("v")).alias("c"), F.lit(True).alias("fresh")), "colour")
    while True:
        sent = e.join(colour.where("fresh").select(F.col("id").alias("src"), "c"), "src").groupBy(F.col("dst").alias("id")).agg(F.max("c").alias("in"))
        step = colour.join(sent, "id", "left").select("id", F.greatest("c", F.coalesce("in", "c")).alias("c"), F.coalesce(F.col("in") > F.col("c"), F.lit(False)).alias("fresh"))
        new, n = scratch.measured(step, "colour", fresh=F.count_if("fresh"))
        scratch.drop(colour)
        colour = new
        if not n["fresh"]:
            break
    a, b = (colour.select(F.col("id").alias(side), F.col("c.v").alias(f"c_{side}")) for side in ("src", "dst"))
    inside = scratch.cut(e.join(a, "src").join(b, "dst").where("c_src = c_dst").select("src", "dst", F.col("c_dst").alias("root")), "inside")
    fronts = [scratch.cut(colour.where("id = c.v").select("id", F.col("id").alias("root")), "front")]
    while True:
        back = inside.join(fronts[-1].select(F.col("id").alias("dst")), "dst", "left_semi").select(F.col("src").alias("id"), "root").distinct()
        seen = e.sparkSession.read.schema(fronts[0].schema).parquet(*(f._scratch_path for f in fronts))
        front, n = scratch.measured(back.join(seen.select("id"), "id", "left_anti"), "front", n=F.count("*"))
        fronts.append(front)
        if not n["n"]:
            break
    found = scratch.cut(seen, "found")
    scratch.drop(colour, inside, *fronts)
    return found


def _resolved(passed: DataFrame, found: DataFrame) -> DataFrame:
    """(id, root) of bypassed vertices: with their only neighbour if one on their other side is in its component."""
    root = lambda c: found.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root"))
    rows = passed.join(root("via"), "via", "left").join(root("other"), "other", "left")
    via, other = F.coalesce("via_root", "via"), F.coalesce("other_root", "other")
    return rows.where(via == other).select("id", via.alias("root")).distinct()


def strong_components(vertices: DataFrame, edges: DataFrame, most_rounds: int = 500, report: list | None = None) -> DataFrame:
    """(id, comp) of every vertex.

    Vertices of a single in- or out-edge are bypassed as long as a tenth of the rest goes, so long chains and rings
    take rounds by the logarithm of their length.  What is left is coloured and found by all colours
    at once, in rounds by its diameter; then both begin again.  ``report`` is given the name of each step.
    """
    spark = vertices.sparkSession
    scratch = Scratch(spark, "scc")
    e = scratch.cut(edges.where("src <> dst").select("src", "dst").distinct(), "edges")
    steps: list[tuple[str, DataFrame]] = []
    for round_ in range(most_rounds):
        e, passed, again = _bypass(e, scratch, round_)
        steps += [("bypass", passed)] if passed is not None else []
        if again:
            continue
        if e.isEmpty():
            break
        found = _coloured(e, scratch, round_)
        steps.append(("colour", found))
        left = scratch.cut(_without(e, found), "edges")
        scratch.drop(e)
        e = left
        if e.isEmpty():
            break
    else:
        raise RuntimeError(f"strong components did not settle in {most_rounds} rounds")
    # Back through the steps: a vertex without a root of its own is a component by itself.
    tables = [scratch.cut(spark.createDataFrame([], "id bigint, root bigint"), "roots")]
    for name, table in reversed(steps):
        if report is not None:
            report.insert(0, name)
        found = spark.read.schema("id bigint, root bigint").parquet(*(t._scratch_path for t in tables))
        tables.append(scratch.cut(_resolved(table, found), "roots") if name == "bypass" else table)
    found = spark.read.schema("id bigint, root bigint").parquet(*(t._scratch_path for t in tables))
    all_ = scratch.cut(vertices.select("id").join(found, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "scc")
    scratch.drop(e, *tables, *(t for _, t in steps))
    return _renumbered(all_)


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("comp").agg(F.count("*").alias("size"))


def size_distribution(components: DataFrame) -> DataFrame:
    """(freq, size, perc): components of each size and the share of all vertices they hold, in percent."""
    sizes = component_sizes(components)
    by_size = sizes.groupBy("size").agg(F.count("*").alias("freq"))
    nodes = F.sum(F.col("size") * F.col("freq")).over(Window.partitionBy())  # one row a size
    return by_size.select("freq", "size", (100.0 * F.col("size") * F.col("freq") / nodes).alias("perc"))
