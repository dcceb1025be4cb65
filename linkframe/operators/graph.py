"""Queries on one directed graph of (id, name) vertices and (src, dst) edges.

Methods take an id, a name, or a DataFrame of ids.  Unknown names and ids give empty results.  Neighbours come
in id order where a method returns rows for one vertex.

A name is looked up when a method is called (one row), so that edges are filtered by a constant id that reaches the
scan.  Ids are in name order, so names of one prefix are an interval of ids: its bounds are looked up too, and
neighbours are filtered by them in the scan of edges that are sorted by (src, dst).  Where the ids of a
table are not in name order, the prefix itself is checked as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkframe.functions.names import top_level_domain
from linkframe.operators.stats import frequencies
from linkframe.plans.lineage import Scratch, partitions


#: Intervals of ids that top-level domains are looked up by.
BINS = 4096


class Graph:
    def __init__(self, vertices: DataFrame, edges: DataFrame, domains: DataFrame | None = None):
        """domains is what ``domain_intervals`` makes of the vertices, if it is there already."""
        self.vertices, self.edges = vertices, edges
        self.spark: SparkSession = vertices.sparkSession
        self._domains = domains

    # --- storage -----------------------------------------------------------------------

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Graph:
        """A graph from path/vertices, path/edges and path/domains."""
        return cls(*(spark.read.parquet(f"{path}/{t}") for t in ("vertices", "edges", "domains")))

    def save(self, path: str) -> None:
        """Vertices sorted by name and edges by (src, dst), so prefix and id filters skip row groups; intervals of
        top-level domains beside them."""
        self.vertices.orderBy("name").write.option("compression", "zstd").parquet(f"{path}/vertices")
        self.edges.orderBy("src", "dst").write.option("compression", "zstd").parquet(f"{path}/edges")
        domain_intervals(self.spark.read.parquet(f"{path}/vertices")).write.parquet(f"{path}/domains")

    def transposed(self) -> Graph:
        return Graph(self.vertices, self.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))

    def symmetric(self) -> Graph:
        """Each pair of ends is made distinct once, whatever its direction, in partitions that grow with the edges."""
        a, b = F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
        e, seen = Scratch(self.spark, "symmetric").measured(self.edges.select(a, b), "edges", n=F.count("*"))
        pairs = e.repartition(partitions(self.spark, seen["n"]), "a", "b").distinct()
        arc = lambda s, d: F.struct(F.col(s).alias("src"), F.col(d).alias("dst"))
        both = F.when(F.col("a") == F.col("b"), F.array(arc("a", "b"))).otherwise(F.array(arc("a", "b"), arc("b", "a")))
        return Graph(self.vertices, pairs.select(F.explode(both).alias("x")).select("x.*"))

    # --- names and ids -----------------------------------------------------------------

    def ids_of(self, names: DataFrame, name_col: str = "name") -> DataFrame:
        """names with ``id``; unknown names are dropped, duplicates stay."""
        return names.join(self.vertices.select("id", F.col("name").alias("__lf_name")), F.col(name_col) == F.col("__lf_name")).drop("__lf_name")

    def names_of(self, ids: DataFrame, id_col: str = "id") -> DataFrame:
        """ids with ``name``; unknown ids are dropped, duplicates stay."""
        return ids.join(self.vertices.select(F.col("id").alias("__lf_id"), "name"), F.col(id_col) == F.col("__lf_id")).drop("__lf_id")

    def vertex(self, v: int | str) -> DataFrame:
        """The (id, name) row of a vertex, if there is one."""
        return self.vertices.where(F.col("name") == v if isinstance(v, str) else F.col("id") == v).select("id", "name")

    def id_of(self, v: int | str) -> int:
        """The id of a name; -1, which no vertex has, if there is none."""
        if not isinstance(v, str):
            return v
        row = self.vertex(v).head()
        return row["id"] if row else -1

    def _at(self, v: int | str, side: str) -> DataFrame:
        """Edges whose ``side`` is the vertex."""
        return self.edges.where(F.col(side) == self.id_of(v))

    def interval(self, prefix: str) -> tuple[int, int, bool]:
        """(first id, last id, whether all between them are) of the names of a prefix; (0, -1, True) if there are none."""
        found = self.vertices.where(F.col("name").startswith(prefix))
        first, last, n = found.agg(F.min("id"), F.max("id"), F.count("*")).head()
        return (first, last, last - first + 1 == n) if n else (0, -1, True)

    def domains(self) -> DataFrame:
        """(tld, first, last, n): intervals of ids by top-level domain, computed once a graph."""
        if self._domains is None:
            self._domains = Scratch(self.spark, "graph").cut(domain_intervals(self.vertices), "domains")
        return self._domains

    # --- neighbours --------------------------------------------------------------------

    def successors(self, v: int | str, prefix: str | None = None) -> DataFrame:
        """(id, name) of the vertices that v links to, by id."""
        return self._named(self._at(v, "src").select(F.col("dst").alias("id")), prefix)

    def predecessors(self, v: int | str, prefix: str | None = None) -> DataFrame:
        return self._named(self._at(v, "dst").select(F.col("src").alias("id")), prefix)

    def successor_ids(self, v: int | str) -> DataFrame:
        return self._at(v, "src").select(F.col("dst").alias("id")).orderBy("id")

    def predecessor_ids(self, v: int | str) -> DataFrame:
        return self._at(v, "dst").select(F.col("src").alias("id")).orderBy("id")

    def _named(self, ids: DataFrame, prefix: str | None) -> DataFrame:
        names = self.vertices.select("id", "name")
        if prefix is not None:
            first, last, whole = self.interval(prefix)
            ids, names = ids.where(F.col("id").between(first, last)), names.where(F.col("id").between(first, last))
            names = names if whole else names.where(F.col("name").startswith(prefix))
        return ids.join(names, "id").orderBy("id")

    def _top_level_domains(self, ids: DataFrame) -> DataFrame:
        """ids(id) with ``tld``, by the interval that each falls into: no name is read."""
        known, top = self.domains(), F.max("last")
        last, apart = known.agg(top, F.count_if(F.col("last") - F.col("first") + 1 != F.col("n"))).head()
        if apart:  # ids aren't in name order
            return self.names_of(ids).select("id", top_level_domain(F.col("name")).alias("tld"))
        width = max(1, (last or 0) // BINS)
        bins = F.explode(F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width)))
        binned = known.select("tld", "first", "last", bins.alias("__lf_bin"))  # at most BINS rows more than intervals
        rows = ids.withColumn("__lf_bin", F.floor(F.col("id") / width)).join(binned, "__lf_bin")
        return rows.where(F.col("id").between(F.col("first"), F.col("last"))).select("id", "tld")

    def successor_top_level_domains(self, v: int | str) -> DataFrame:
        return self._top_level_domains(self._at(v, "src").select(F.col("dst").alias("id"))).select("tld")

    def predecessor_top_level_domains(self, v: int | str) -> DataFrame:
        return self._top_level_domains(self._at(v, "dst").select(F.col("src").alias("id"))).select("tld")

    def successor_tld_counts(self, v: int | str) -> DataFrame:
        return frequencies(self.successor_top_level_domains(v), "tld")

    def predecessor_tld_counts(self, v: int | str) -> DataFrame:
        return frequencies(self.predecessor_top_level_domains(v), "tld")

    def tld_counts(self, ids: DataFrame, id_col: str = "id") -> DataFrame:
        """(key, cnt) of the top-level domains of any ids, duplicates counted."""
        return frequencies(self._top_level_domains(ids.select(F.col(id_col).alias("id"))), "tld")

    def is_arc(self, pairs: DataFrame) -> DataFrame:
        """pairs(src, dst) with ``is_arc``."""
        asked = pairs.select("src", "dst").distinct()
        known = asked.join(self.edges.select("src", "dst"), ["src", "dst"], "left_semi").withColumn("__lf_known", F.lit(True))
        return pairs.join(known, ["src", "dst"], "left").withColumn("is_arc", F.coalesce("__lf_known", F.lit(False))).drop("__lf_known")

    def has_arc(self, a: int | str, b: int | str) -> bool:
        return not self._at(a, "src").where(F.col("dst") == self.id_of(b)).limit(1).isEmpty()

    # --- degrees -----------------------------------------------------------------------

    def degrees(self) -> DataFrame:
        """(id, outdegree, indegree) of every vertex, zeros included, from one pass over the edges."""
        end = lambda c, o, i: F.struct(F.col(c).alias("id"), F.lit(o).alias("o"), F.lit(i).alias("i"))
        ends = self.edges.select(F.explode(F.array(end("src", 1, 0), end("dst", 0, 1))).alias("x")).select("x.*")
        found = ends.groupBy("id").agg(F.sum("o").alias("outdegree"), F.sum("i").alias("indegree"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
        return self.vertices.select("id").join(found, "id", "left").select("id", zero("outdegree"), zero("indegree"))

    def degrees_of(self, v: int | str) -> DataFrame:
        """(outdegree, indegree) of one vertex, as a row."""
        i = self.id_of(v)
        at = self.edges.where((F.col("src") == i) | (F.col("dst") == i))
        return at.agg(F.count_if(F.col("src") == i).alias("outdegree"), F.count_if(F.col("dst") == i).alias("indegree"))

    def outdegree(self, v: int | str) -> int:
        return self._at(v, "src").count()

    def indegree(self, v: int | str) -> int:
        return self._at(v, "dst").count()

    # --- several vertices at once --------------------------------------------------------

    def shared_successors(self, ids: DataFrame, least: int | None = None, most: int | None = None, id_col: str = "id") -> DataFrame:
        """(id, cnt): vertices that between ``least`` and ``most`` of the given ones link to.

        Vertices given twice count twice.  Without bounds all must link: the intersection;
        1 and the number of vertices give the union, equal bounds an exact overlap.
        """
        return self._shared(ids, least, most, id_col, "src", "dst")

    def shared_predecessors(self, ids: DataFrame, least: int | None = None, most: int | None = None, id_col: str = "id") -> DataFrame:
        return self._shared(ids, least, most, id_col, "dst", "src")

    def _shared(self, ids, least, most, id_col, side, other) -> DataFrame:
        n = ids.count() if least is None or most is None else 0
        counts = merge_count(self.edges.join(ids.select(F.col(id_col).alias(side)), side).select(side, other), other)
        return counts.where(F.col("cnt").between(n if least is None else least, n if most is None else most)).withColumnRenamed("value", "id")

    def successor_intersect(self, v: int | str, ids: DataFrame, id_col: str = "id") -> DataFrame:
        return self.successor_ids(v).join(ids.select(F.col(id_col).alias("id")), "id", "left_semi")

    def predecessor_intersect(self, v: int | str, ids: DataFrame, id_col: str = "id") -> DataFrame:
        return self.predecessor_ids(v).join(ids.select(F.col(id_col).alias("id")), "id", "left_semi")

    def subgraph_metrics(self, ids: DataFrame, id_col: str = "id") -> DataFrame:
        """One row of figures on the vertices given and the edges at them.

        nodes_linked and nodes_linking count every vertex that a member links to or that links
        to a member, members included.
        """
        mine = ids.select(F.col(id_col).alias("id")).distinct()
        n = mine.agg(F.count("*").alias("nodes"))
        a, b = mine.select(F.col("id").alias("src"), F.lit(1).alias("s")), mine.select(F.col("id").alias("dst"), F.lit(1).alias("d"))
        e = self.edges.select("src", "dst").join(a, "src", "left").join(b, "dst", "left").where("s = 1 OR d = 1")
        is_s, is_d = F.col("s").isNotNull(), F.col("d").isNotNull()
        m = e.agg(
            F.count_if(is_s & is_d).alias("arcs"),
            F.count_if(~is_s & is_d).alias("inlinks"),
            F.count_if(is_s & ~is_d).alias("outlinks"),
            F.count_if(is_d).alias("total_inlinks"),
            F.count_if(is_s).alias("total_outlinks"),
            F.count_distinct(F.when(is_s, F.col("dst"))).alias("nodes_linked"),
            F.count_distinct(F.when(is_d, F.col("src"))).alias("nodes_linking"),
        )
        one = n.withColumn("k", F.lit(0)).join(m.withColumn("k", F.lit(0)), "k").drop("k")  # two single rows
        return one.select(
            "nodes", "arcs", (F.col("arcs") / F.col("nodes")).alias("avgdegree"), "inlinks", "outlinks", "total_inlinks", "total_outlinks", "nodes_linked", "nodes_linking"
        )


def domain_intervals(vertices: DataFrame) -> DataFrame:
    """(tld, first, last, n) of (id, name): a name without a dot is an interval of its own, as others may come between
    it and the names under it."""
    dotted = F.instr("name", ".") > 0
    own = F.when(~dotted, F.col("id")).otherwise(F.lit(-1))
    by = vertices.groupBy(top_level_domain(F.col("name")).alias("tld"), own.alias("own"))
    return by.agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).drop("own")


def merge_count(lists: DataFrame, value_col: str) -> DataFrame:
    """(value, cnt): how often each value comes in the lists, repeats counted."""
    return lists.groupBy(F.col(value_col).alias("value")).agg(F.count("*").alias("cnt"))


def merged_values(lists: DataFrame, value_col: str, skip: int = 0) -> DataFrame:
    """merge_count in value order, the first ``skip`` values left out."""
    return merge_count(lists, value_col).orderBy("value").offset(skip)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Values of both lists, duplicates paired one to one."""
    return a.intersectAll(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Values of a that aren't in b, duplicates removed one for one."""
    return a.exceptAll(b)


def merge_links(*links: DataFrame) -> DataFrame:
    """Distinct links of several crawls."""
    return reduce(DataFrame.unionByName, links).distinct()
