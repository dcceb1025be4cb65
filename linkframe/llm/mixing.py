"""Mixing sources to target weights by hierarchical budgeting.

The sources form a tree domain - language - source.  A token budget goes down the tree: a
node's budget is shared among its children by weight, no child getting more than its subtree
holds (its tokens times ``max_epochs``); what a child can't use goes to its siblings by weight
again, and only what a whole subtree can't use reaches the siblings of its ancestor.  As every
node is capped by its whole subtree from the start, one pass from the root settles this.

A leaf reads its documents in epochs, each in an order of its own (a hash of seed, epoch and
id), and takes the longest prefix of whole documents within its budget: all of the full
epochs and a prefix of the last one.

Budgets are window sums over the tree's nodes.  A leaf's prefix is found by sums over the
4096 cells of the order and then by the order within the one cell that the budget ends in,
so a leaf with a third of all rows is never sorted by one task.  Documents meet the plan in a
join with one row a leaf and are not shuffled.

Defined cases
-------------
* null domain, language or source: the child named ""; ``source_domain`` puts null into "other".
* very long texts count whole: their tokens are counted in one pass, and a document is taken or left as a whole.
* null text: no tokens; documents without tokens are taken with the prefix they stand in.
* null ids hash like an empty id; repeated rows are rows of their own, at the same place of
  the order: such ties are taken or left together at the end of a prefix.
* a weight of 0 or a child missing from ``weights`` (where it has a default of 0): nothing.
* empty tables, or a budget of 0: an empty result.
* extra columns pass through ``mix``; its one new column, ``epoch``, replaces a like-named one.

The plan (one row a leaf) is broadcast while it has at most ``max_broadcast_leaves`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkframe.plans.lineage import Scratch

LEVELS = ("__lf_domain", "__lf_lang", "__lf_source")
WORD = r"[^\x20\x09-\x0D]+"
_CELL = 3  # hexadecimal digits: 4096 cells


def source_domain(source: Column) -> Column:
    """The domain of a numbered source: its number modulo 4; "other" without a number."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", F.lit("other")).otherwise(F.concat(F.lit("d"), (F.substring(number, -2, 2).cast("int") % 4).cast("string")))


def weight_of(level: int, weights: dict[int, dict[str, float]], default: float = 1.0) -> Column:
    """Weight of a child by its name, of the tree's level 0, 1 or 2."""
    out = F.lit(float(default))
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(LEVELS[level]) == name, F.lit(float(w))).otherwise(out)
    return out


def leaf_columns(domain: Column, lang_col: str, source_col: str, id_col: str) -> list[Column]:
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return [F.col(id_col).alias("__lf_id"), *(name(c).alias(x) for c, x in zip((domain, F.col(lang_col), F.col(source_col)), LEVELS, strict=True))]


def token_table(docs: DataFrame, leaf: list[Column], text_col: str) -> DataFrame:
    """(id, three levels, tokens) of every document."""
    return docs.select(*leaf, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("__lf_tokens"))


def _share(nodes: DataFrame, level: int, weights: dict) -> DataFrame:
    """nodes (levels 0..level, cap, budget of the parent) with ``alloc``: water filling among siblings."""
    parent = list(LEVELS[:level])
    nodes = nodes.withColumn("w", weight_of(level, weights)).where("w > 0 AND cap > 0").withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.partitionBy(*parent).orderBy("ratio", LEVELS[level])
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("full", before + F.col("ratio") * rest <= F.col("budget"))
    every = Window.partitionBy(*parent)
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    rate = (F.col("budget") - used) / open_w
    return nodes.withColumn("alloc", F.when(F.col("full"), F.col("cap")).otherwise(rate * F.col("w"))).drop("w", "ratio", "full", "budget")


def budgets(leaves: DataFrame, budget: float, weights: dict, max_epochs: int) -> DataFrame:
    """leaves (levels, tokens) with ``alloc``, their tokens."""
    leaves = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    positive = leaves
    for level in range(3):  # a subtree holds only what its positive weights let through
        positive = positive.where(weight_of(level, weights) > 0)
    top = positive.groupBy(LEVELS[0]).agg(F.sum("cap").alias("cap"))
    total = Window.partitionBy()
    top = top.withColumn("budget", F.least(F.lit(float(budget)), F.sum("cap").over(total)))
    top = _share(top, 0, weights).select(LEVELS[0], F.col("alloc").alias("budget"))
    mid = positive.groupBy(*LEVELS[:2]).agg(F.sum("cap").alias("cap")).join(top, LEVELS[0])
    mid = _share(mid, 1, weights).select(*LEVELS[:2], F.col("alloc").alias("budget"))
    return _share(positive.join(mid, list(LEVELS[:2])), 2, weights)


def _key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("__lf_id").cast("string"), F.lit(""))).cast("binary"))


def plan(tokens: DataFrame, scratch: Scratch, budget: float | None, budget_share: float, weights: dict, max_epochs: int, seed: int, max_broadcast_leaves: int) -> DataFrame:
    """One row a leaf: full epochs, and the key up to which the next epoch is taken."""
    leaves = scratch.cut(tokens.groupBy(*LEVELS).agg(F.sum("__lf_tokens").alias("tokens")), "leaves")
    if budget is None:
        budget = budget_share * float(leaves.agg(F.sum("tokens")).head()[0] or 0)
    sized = budgets(leaves, budget, weights, max_epochs)
    done = F.least(F.floor(F.col("alloc") / F.col("tokens")), F.lit(max_epochs))
    sized = sized.select(*LEVELS, "tokens", "alloc", done.cast("int").alias("epochs"), (F.col("alloc") - done * F.col("tokens")).alias("left"))
    sized = scratch.cut(sized, "sized")
    small = sized.count() <= max_broadcast_leaves
    hint = F.broadcast if small else (lambda d: d)
    rows = tokens.join(hint(sized.where("left > 0").select(*LEVELS, "epochs", "left")), list(LEVELS)).withColumn("key", _key(seed, F.col("epochs")))
    cells = rows.groupBy(*LEVELS, F.substring("key", 1, _CELL).alias("cell")).agg(F.sum("__lf_tokens").alias("n"), F.first("left").alias("left"))
    to = Window.partitionBy(*LEVELS).orderBy("cell")
    cells = cells.withColumn("before", F.sum("n").over(to) - F.col("n"))
    # The budget ends in the first cell that doesn't fit; there is one, as left < tokens.
    ends = cells.where(F.col("before") + F.col("n") > F.col("left"))
    ends = ends.groupBy(*LEVELS).agg(F.min(F.struct("cell", "before")).alias("x")).select(*LEVELS, "x.cell", "x.before")
    ends = scratch.cut(ends, "ends")
    last = rows.join(hint(ends), list(LEVELS)).where(F.substring("key", 1, _CELL) == F.col("cell"))
    upto = F.sum("__lf_tokens").over(Window.partitionBy(*LEVELS, "cell").orderBy("key"))  # ties together
    last = last.withColumn("sum", F.col("before") + upto).where(F.col("sum") <= F.col("left"))
    last = last.groupBy(*LEVELS).agg(F.max("key").alias("last"))
    out = sized.join(ends.select(*LEVELS, "cell"), list(LEVELS), "left").join(last, list(LEVELS), "left")
    return scratch.cut(out.select(*LEVELS, "alloc", "epochs", F.coalesce("last", "cell").alias("last")), "plan")


def select(tokens: DataFrame, leaf_plan: DataFrame, seed: int, max_broadcast_leaves: int) -> DataFrame:
    """tokens (id, levels and any other columns) once for each epoch that takes the row, with ``__lf_epoch``."""
    small = leaf_plan.count() <= max_broadcast_leaves
    leaf_plan = leaf_plan.select(*LEVELS, *(F.col(c).alias(f"__lf_{c}") for c in ("alloc", "epochs", "last")))
    rows = tokens.join(F.broadcast(leaf_plan) if small else leaf_plan, list(LEVELS))
    partial = F.coalesce(_key(seed, F.col("__lf_epochs")) <= F.col("__lf_last"), F.lit(False))
    n = F.col("__lf_epochs") + partial.cast("int")
    return rows.where(n > 0).withColumn("__lf_epoch", F.explode(F.sequence(F.lit(0), n - 1)))


def mix(
    docs: DataFrame,
    weights: dict[int, dict[str, float]] | None = None,
    budget: float | None = None,
    budget_share: float = 0.6,
    max_epochs: int = 2,
    seed: int = 1,
    domain: Column | None = None,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    report: bool = False,
    max_broadcast_leaves: int = 200_000,
    epoch_col: str = "epoch",
) -> DataFrame:
    """docs with ``epoch_col``, a row for each time a document is taken; or, with ``report``, only
    id, levels, tokens, the leaf's budget and epoch."""
    scratch = Scratch(docs.sparkSession, "mixing")
    domain = source_domain(F.col(source_col)) if domain is None else domain
    leaf = leaf_columns(domain, lang_col, source_col, id_col)
    tokens = scratch.cut(token_table(docs, leaf, text_col), "tokens")
    found = plan(tokens, scratch, budget, budget_share, weights or {}, max_epochs, seed, max_broadcast_leaves)
    if report:
        names = {"__lf_id": id_col, LEVELS[0]: "domain", LEVELS[1]: "lang", LEVELS[2]: "source", "__lf_tokens": "n_tokens", "__lf_alloc": "leaf_budget", "__lf_epoch": epoch_col}
        out = select(tokens, found, seed, max_broadcast_leaves)
        return out.select(*(F.col(k).alias(v) for k, v in names.items()))
    own = [c for c in docs.columns if c != epoch_col]
    return select(docs.select(*own, *leaf), found, seed, max_broadcast_leaves).select(*own, F.col("__lf_epoch").alias(epoch_col))
