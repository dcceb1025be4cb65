"""Queries of the web-graph operators on the test tables, and their SQL.

Graphs (see FIXTURES.md):

* H: page hosts, arcs from the host of page n to the host of page n + 1.
* C: customers; within each nation and market segment an arc from the i-th to the (i / 2)-th, and in
  segment BUILDING one from the first to the last, so components are many and some are strong.
* S: suppliers, P: parts; arcs between two lines of one order, from the lower line number.
  Parts carry made-up reversed names tld.dN.hM, so folding has work to do.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkframe.__main__ import main
from linkframe.functions import names, suffixes
from linkframe.operators import components, fold, preference, rank, ranks, stats
from linkframe.operators import graph as g

from linkframe.operators.enumerate import number, out_of_order, page, reuse_vertices, vertices
from linkframe.operators.explore import Explorer, listing, shortcuts
from linkframe.plans.crawls import LinkStore
from linkframe.plans.lineage import Scratch, partitions
from linkframe.plans.report import Report
from linkframe.plans.workflow import Stopped, Workflow
from linkframe.sources import hostlinks, text, vectors

TLDS = ["com", "org", "net", "de", "fr"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- graphs ---------------------------------------------------------------------------


def page_names(spark, d) -> DataFrame:
    """(page_id, h): reversed host of each page."""
    return hostlinks.page_hosts(table(spark, d, "pages").select("page_id", "url")).select("page_id", names.reverse_host(F.col("host")).alias("h"))


def page_links(spark, d) -> DataFrame:
    p = page_names(spark, d)
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("h").alias("to"))
    return p.join(nxt, "page_id").select(F.col("h").alias("src_host"), F.col("to").alias("dst_host"))


def graph_h(spark, d) -> g.Graph:
    v = vertices(page_names(spark, d), "h")
    return g.Graph(v, hostlinks.number_links(page_links(spark, d).withColumnsRenamed({"src_host": "s", "dst_host": "d"}), v, "s", "d"))


def _line_edges(spark, d, key: str, ids: DataFrame) -> DataFrame:
    """Distinct (src, dst) of two lines of one order, numbered by ids(id, key) before they are paired."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", key)
    parts = partitions(spark, li.count(), 500_000)  # a line makes two pairs or three
    li = li.repartition(parts, key).join(ids, key).select("l_orderkey", "l_linenumber", "id").repartition(parts, "l_orderkey").distinct()
    a = li.select("l_orderkey", F.col("id").alias("src"), F.col("l_linenumber").alias("i"))
    b = li.select("l_orderkey", F.col("id").alias("dst"), F.col("l_linenumber").alias("j"))
    return a.join(b, "l_orderkey").where("i < j AND src <> dst").select("src", "dst").repartition(parts, "src", "dst").distinct()


def part_name() -> F.Column:
    k = F.col("p_partkey")
    tld = F.element_at(F.array(*map(F.lit, TLDS)), (k % len(TLDS) + 1).cast("int"))
    return F.concat(tld, F.lit(".d"), F.floor(k / 10).cast("string"), F.lit(".h"), k.cast("string"))


def graph_p(spark, d) -> g.Graph:
    parts = number(table(spark, d, "part").select("p_partkey", part_name().alias("name")), ["name"])
    return g.Graph(parts.select("id", "name"), _line_edges(spark, d, "l_partkey", parts.select("id", F.col("p_partkey").alias("l_partkey"))))


def graph_c(spark, d) -> g.Graph:
    group = ["c_nationkey", "c_mktsegment"]
    v = number(table(spark, d, "customer").select("c_custkey", *group, F.col("c_name").alias("name")), ["c_custkey"])
    by = Window.partitionBy(*group)
    at = v.select("id", *group, (F.row_number().over(by.orderBy("c_custkey")) - 1).alias("pos"), (F.count("*").over(by) - 1).alias("top"))
    first = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("top") > 0), F.col("top"))
    out = at.select(F.col("id").alias("src"), *group, F.when(F.col("pos") > 0, F.floor(F.col("pos") / 2)).otherwise(first).alias("pos"))
    edges = out.join(at.select(F.col("id").alias("dst"), *group, F.col("pos").cast("long").alias("pos")), [*group, "pos"])
    return g.Graph(v.select("id", "name"), edges.select("src", "dst"))


def graph_s(spark, d) -> g.Graph:
    sup = number(table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name")), ["s_suppkey"])
    return g.Graph(sup.select("id", "name"), _line_edges(spark, d, "l_suppkey", sup.select("id", F.col("s_suppkey").alias("l_suppkey"))))


_HOST = "regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1)"
SQL_H = f"""
hp AS (SELECT page_id, array_to_string(list_reverse(string_split({_HOST}, '.')), '.') AS h FROM pages),
hv AS (SELECT h AS name, row_number() OVER (ORDER BY h) - 1 AS id FROM (SELECT DISTINCT h FROM hp)),
hl AS (SELECT x.page_id, x.h AS src_host, y.h AS dst_host FROM hp x JOIN hp y ON y.page_id = x.page_id + 1),
he AS (SELECT DISTINCT a.id AS src, b.id AS dst FROM hl JOIN hv a ON a.name = src_host JOIN hv b ON b.name = dst_host WHERE a.id <> b.id)"""
_TLD = "CASE p_partkey % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TLDS)) + " END"
SQL_P = f"""
pk AS (SELECT p_partkey, {_TLD} || '.d' || CAST(p_partkey // 10 AS VARCHAR) || '.h' || CAST(p_partkey AS VARCHAR) AS name FROM part),
pv AS (SELECT p_partkey, name, row_number() OVER (ORDER BY name) - 1 AS id FROM pk),
pe AS (SELECT DISTINCT x.id AS src, y.id AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
       JOIN pv x ON x.p_partkey = a.l_partkey JOIN pv y ON y.p_partkey = b.l_partkey WHERE x.id <> y.id)"""
SQL_C = """
cv AS (SELECT c_custkey, c_name AS name, row_number() OVER (ORDER BY c_custkey) - 1 AS id, c_nationkey AS n, c_mktsegment AS m,
       row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) - 1 AS pos,
       count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) - 1 AS top FROM customer),
ce AS (SELECT a.id AS src, b.id AS dst FROM cv a JOIN cv b ON a.n = b.n AND a.m = b.m
       AND b.pos = CASE WHEN a.pos > 0 THEN a.pos // 2 WHEN a.m = 'BUILDING' AND a.top > 0 THEN a.top END)"""
SQL_S = """
sv AS (SELECT s_suppkey, s_name AS name, row_number() OVER (ORDER BY s_suppkey) - 1 AS id FROM supplier),
se AS (SELECT DISTINCT x.id AS src, y.id AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
       JOIN sv x ON x.s_suppkey = a.l_suppkey JOIN sv y ON y.s_suppkey = b.l_suppkey WHERE x.id <> y.id)"""

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


# --- names and numbering ----------------------------------------------------------------


@query("f1_reverse_host", f"WITH {SQL_H} SELECT page_id, h AS rev FROM hp")
def _(spark, d):
    return page_names(spark, d).withColumnRenamed("h", "rev")


_LABELS2 = "array_to_string(list_slice(string_split({0}, '.'), 1, 2), '.')"


@query("f2_registered_domain", f"WITH {SQL_H} SELECT name, array_to_string(list_reverse(list_slice(string_split(name, '.'), 1, 2)), '.') AS domain FROM hv")
def _(spark, d):
    v = graph_h(spark, d).vertices.select("name")
    return suffixes.registered_domain(v, "name").select("name", names.reverse_host(F.col("domain")).alias("domain"))


@query("f3_private_domain", f"WITH {SQL_P} SELECT name, {_LABELS2.format('name')} AS domain FROM pv")
def _(spark, d):
    return suffixes.registered_domain(graph_p(spark, d).vertices.select("name"), "name", private=True)


@query("f4_registered_domain_reversed", f"WITH {SQL_H} SELECT name, {_LABELS2.format('name')} AS domain FROM hv")
def _(spark, d):
    return suffixes.registered_domain(graph_h(spark, d).vertices.select("name"), "name", strict=False)


_NO_WWW = "CASE WHEN starts_with(h, 'www.') AND contains(substr(h, 5), '.') THEN substr(h, 5) ELSE h END"


@query("f5_strip_www", f"SELECT h AS host, {_NO_WWW} AS stripped FROM (SELECT DISTINCT {_HOST} AS h FROM pages)")
def _(spark, d):
    hosts = hostlinks.page_hosts(table(spark, d, "pages").select("url")).select("host").distinct()
    return hosts.select("host", names.strip_www(F.col("host")).alias("stripped"))


@query("f6_top_level_domain", f"WITH {SQL_P} SELECT id, split_part(name, '.', 1) AS tld FROM pv")
def _(spark, d):
    return graph_p(spark, d).vertices.select("id", names.top_level_domain(F.col("name")).alias("tld"))


@query("f7_is_public_suffix", f"WITH {SQL_P} SELECT DISTINCT p AS name, len(string_split(p, '.')) = 1 AS is_suffix FROM (SELECT unnest([split_part(name, '.', 1), {_LABELS2.format('name')}, name]) AS p FROM pv)")
def _(spark, d):
    name = F.col("name")
    some = graph_p(spark, d).vertices.select(F.explode(F.array(names.first_labels(name, 1), names.first_labels(name, 2), name)).alias("name")).distinct()
    return suffixes.is_public_suffix(some, "name")


@query("f9_url_host", f"SELECT page_id, {_HOST} AS host FROM pages")
def _(spark, d):
    return hostlinks.page_hosts(table(spark, d, "pages").select("page_id", "url")).select("page_id", "host")


@query("f12_vertex_text", f"WITH {SQL_H} SELECT id, '#' || id || chr(9) || name AS line FROM hv")
def _(spark, d):
    return graph_h(spark, d).vertices.select("id", names.vertex_text(F.col("id"), F.col("name")).alias("line"))


@query("p7_extract_links", f"""
SELECT src_host, dst_host, count(*) AS n FROM (SELECT {_HOST} AS src_host, {_HOST} AS dst_host,
    unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS link FROM pages)
WHERE NOT starts_with(link, '//') AND NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') GROUP BY ALL""")
def _(spark, d):
    return hostlinks.extract_links(table(spark, d, "pages")).groupBy("src_host", "dst_host").agg(F.count("*").alias("n"))


@query("p8_valid_hosts", f"SELECT DISTINCT h AS host, regexp_full_match(h, '([a-z0-9_]([a-z0-9_-]{{0,61}}[a-z0-9_])?\\.)+[a-z]{{2,63}}') AS valid FROM (SELECT {_HOST} AS h FROM pages)")
def _(spark, d):
    hosts = hostlinks.page_hosts(table(spark, d, "pages").select("url")).select("host").distinct()
    return hosts.select("host", names.is_valid_host(F.col("host")).alias("valid"))


@query("w1_enumerate_hosts", f"WITH {SQL_H} SELECT id, name FROM hv")
def _(spark, d):
    return graph_h(spark, d).vertices


@query("w2_enumerate_by_ranges", f"WITH {SQL_P} SELECT id, name FROM pv")
def _(spark, d):
    return vertices(table(spark, d, "part").select(part_name().alias("name")), small=500)


@query("p9_out_of_order", f"WITH {SQL_P} SELECT count(*) AS n FROM (SELECT name, lag(name) OVER (ORDER BY id) AS p FROM pv) WHERE p >= name")
def _(spark, d):
    return out_of_order(graph_p(spark, d).vertices).agg(F.count("*").alias("n"))


@query("j9_host_graph", f"WITH {SQL_H} SELECT a.name AS src_name, b.name AS dst_name, src, dst FROM he JOIN hv a ON a.id = src JOIN hv b ON b.id = dst")
def _(spark, d):
    v, e = hostlinks.host_graph(page_links(spark, d), reverse=False)
    a, b = v.select(F.col("id").alias("src"), F.col("name").alias("src_name")), v.select(F.col("id").alias("dst"), F.col("name").alias("dst_name"))
    return e.join(a, "src").join(b, "dst")


# --- fold -------------------------------------------------------------------------------

_FOLD = f"""
dom AS (SELECT id AS host_id, {_LABELS2.format('name')} AS domain FROM {{v}}),
dv AS (SELECT domain AS name, count(*) AS n_hosts, row_number() OVER (ORDER BY domain) - 1 AS id FROM dom GROUP BY domain),
dm AS (SELECT host_id, dv.id AS domain_id FROM dom JOIN dv ON dv.name = domain),
de AS (SELECT DISTINCT a.domain_id AS src, b.domain_id AS dst FROM {{e}} JOIN dm a ON a.host_id = src JOIN dm b ON b.host_id = dst WHERE a.domain_id <> b.domain_id)"""


@query("a1_fold_registered", f"WITH {SQL_P}, {_FOLD.format(v='pv', e='pe')} SELECT id, name, n_hosts FROM dv")
def _(spark, d):
    return fold.fold_vertices(graph_p(spark, d).vertices)[0]


@query("a1_fold_private", f"WITH {SQL_P}, {_FOLD.format(v='pv', e='pe')} SELECT id, name, n_hosts FROM dv")
def _(spark, d):
    return fold.fold_vertices(graph_p(spark, d).vertices, "private-domain", multipart_suffixes=True)[0]


@query("a1_fold_no_www", f"""
WITH {SQL_H}, h AS (SELECT DISTINCT array_to_string(list_reverse(string_split({_NO_WWW}, '.')), '.') AS n, h0 FROM (SELECT DISTINCT {_HOST} AS h, {_HOST} AS h0 FROM pages))
SELECT row_number() OVER (ORDER BY n) - 1 AS id, n AS name, count(*) AS n_hosts FROM h GROUP BY n""")
def _(spark, d):
    return fold.fold_vertices(graph_h(spark, d).vertices, "host-without-www")[0]


@query("a2_hosts_per_domain", f"WITH {SQL_H}, {_FOLD.format(v='hv', e='he')} SELECT name, n_hosts FROM dv")
def _(spark, d):
    return fold.fold_vertices(graph_h(spark, d).vertices)[0].select("name", "n_hosts")


@query("j1_fold_edges", f"WITH {SQL_P}, {_FOLD.format(v='pv', e='pe')} SELECT src, dst FROM de")
def _(spark, d):
    p = graph_p(spark, d)
    return fold.fold(p.vertices, p.edges)[1]


# --- degrees and counts -------------------------------------------------------------------

_DEG = """
od AS (SELECT src AS id, count(*) AS outdegree FROM {e} GROUP BY src), idg AS (SELECT dst AS id, count(*) AS indegree FROM {e} GROUP BY dst),
deg AS (SELECT v.id, v.name, coalesce(outdegree, 0) AS outdegree, coalesce(indegree, 0) AS indegree FROM {v} v LEFT JOIN od USING (id) LEFT JOIN idg USING (id))"""
_PD = f"WITH {SQL_P}, {_DEG.format(v='pv', e='pe')}"
_HD = f"WITH {SQL_H}, {_DEG.format(v='hv', e='he')}"


@query("a4_frequencies", f"WITH {SQL_H} SELECT h AS key, count(*) AS cnt FROM hp GROUP BY h")
def _(spark, d):
    return stats.frequencies(page_names(spark, d), "h")


@query("a5_degrees", f"{_PD} SELECT id, outdegree, indegree FROM deg")
def _(spark, d):
    return graph_p(spark, d).degrees()


@query("a6_degree_table", f"{_HD} SELECT outdegree, indegree, name FROM deg")
def _(spark, d):
    return stats.degree_table(graph_h(spark, d))


@query("a7_outdegree_distrib", f"{_PD} SELECT outdegree AS arcs, count(*) AS nodes FROM deg GROUP BY outdegree")
def _(spark, d):
    return stats.degree_distribution(graph_p(spark, d).degrees(), "outdegree")


@query("a7_indegree_distrib", f"{_PD} SELECT indegree AS arcs, count(*) AS nodes FROM deg GROUP BY indegree")
def _(spark, d):
    return stats.degree_distribution(graph_p(spark, d).degrees(), "indegree")


@query("a15_graph_stats", f"""{_HD} SELECT count(*) AS nodes, CAST(sum(outdegree) AS BIGINT) AS arcs, max(outdegree) AS maxoutdegree, max(indegree) AS maxindegree,
avg(outdegree) AS avgoutdegree, avg(indegree) AS avgindegree, count(*) FILTER (outdegree = 0) AS dangling, count(*) FILTER (indegree = 0) AS sources,
(SELECT count(*) FROM he WHERE src = dst) AS loops FROM deg""")
def _(spark, d):
    return stats.graph_stats(graph_h(spark, d))


_TOP = "{0} SELECT outdegree, indegree, name FROM deg WHERE {1} > 20 ORDER BY {1} DESC, concat_ws(chr(9), outdegree, indegree, name) LIMIT 100"


@query("o3_top_outdegree", _TOP.format(_PD, "outdegree"))
def _(spark, d):
    return stats.top_by_degree(stats.degree_table(graph_p(spark, d)), "outdegree", 20, 100)


@query("o3_top_indegree", _TOP.format(_PD, "indegree"))
def _(spark, d):
    return stats.top_by_degree(stats.degree_table(graph_p(spark, d)), "indegree", 20, 100)


# --- exploration --------------------------------------------------------------------------

_P1 = "(SELECT id FROM pv WHERE p_partkey = 1)"


def p1(spark, d) -> tuple[g.Graph, str]:
    """Graph P and the name of part 1."""
    return graph_p(spark, d), "org.d0.h1"


@query("x1_successors", f"WITH {SQL_P} SELECT v.id, v.name FROM pe JOIN pv v ON v.id = dst WHERE src = {_P1}")
def _(spark, d):
    p, v = p1(spark, d)
    return p.successors(v)


@query("x1_predecessors", f"WITH {SQL_P} SELECT v.id, v.name FROM pe JOIN pv v ON v.id = src WHERE dst = {_P1}")
def _(spark, d):
    p, v = p1(spark, d)
    return p.predecessors(v)


@query("x2_successor_ids", f"WITH {SQL_P} SELECT dst AS id FROM pe WHERE src = 3")
def _(spark, d):
    return graph_p(spark, d).successor_ids(3)


@query("x3_successor_prefix", f"WITH {SQL_P} SELECT v.id, v.name FROM pe JOIN pv v ON v.id = dst WHERE src = {_P1} AND starts_with(v.name, 'com.')")
def _(spark, d):
    p, v = p1(spark, d)
    return p.successors(v, prefix="com.")


@query("x4_predecessor_prefix", f"WITH {SQL_P} SELECT v.id, v.name FROM pe JOIN pv v ON v.id = src WHERE dst = {_P1} AND starts_with(v.name, 'de.')")
def _(spark, d):
    p, v = p1(spark, d)
    return p.predecessors(v, prefix="de.")


@query("x10_listing", f"WITH {SQL_P}, r AS (SELECT v.id, v.name, row_number() OVER (ORDER BY v.id) - 1 AS pos FROM pe JOIN pv v ON v.id = dst WHERE src = {_P1}) SELECT CAST(pos AS INTEGER) AS pos, pos || ': #' || id || chr(9) || name AS line FROM r")
def _(spark, d):
    p, v = p1(spark, d)
    return listing(p.successors(v))


_TLDC = "SELECT split_part(v.name, '.', 1) AS key, count(*) AS cnt FROM pe JOIN pv v ON v.id = {0} WHERE {1} = " + _P1 + " GROUP BY 1"


@query("a9_successor_tld_counts", f"WITH {SQL_P} {_TLDC.format('dst', 'src')}")
def _(spark, d):
    p, v = p1(spark, d)
    return p.successor_tld_counts(v)


@query("a9_predecessor_tld_counts", f"WITH {SQL_P} {_TLDC.format('src', 'dst')}")
def _(spark, d):
    p, v = p1(spark, d)
    return p.predecessor_tld_counts(v)


@query("a10_tld_counts", f"WITH {SQL_P} SELECT split_part(v.name, '.', 1) AS key, count(*) AS cnt FROM pe JOIN pv v ON v.id = dst GROUP BY 1")
def _(spark, d):
    p = graph_p(spark, d)
    return p.tld_counts(p.edges.select(F.col("dst").alias("id")))


@query("a11_merge_count", f"WITH {SQL_P} SELECT dst AS value, count(*) AS cnt FROM pe GROUP BY dst")
def _(spark, d):
    return g.merge_count(graph_p(spark, d).edges, "dst")


@query("x14_merged_values", f"WITH {SQL_P} SELECT dst AS value, count(*) AS cnt FROM pe GROUP BY dst ORDER BY value OFFSET 10")
def _(spark, d):
    return g.merged_values(graph_p(spark, d).edges, "dst", skip=10)


def _some(spark, *ids: int) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


_SHARED = "WITH {0} SELECT {1} AS id, count(*) AS cnt FROM (VALUES {2}) AS t(v) JOIN se ON {3} = v GROUP BY {1} HAVING count(*) BETWEEN {4}"


@query("a12_shared_successors_all", _SHARED.format(SQL_S, "dst", "(0), (1), (2)", "src", "3 AND 3"))
def _(spark, d):
    return graph_s(spark, d).shared_successors(_some(spark, 0, 1, 2))


@query("a12_shared_successors_exact2", _SHARED.format(SQL_S, "dst", "(0), (1), (2), (2)", "src", "2 AND 2"))
def _(spark, d):
    return graph_s(spark, d).shared_successors(_some(spark, 0, 1, 2, 2), 2, 2)


@query("a12_shared_predecessors_union", _SHARED.format(SQL_S, "src", "(0), (1), (2)", "dst", "1 AND 3"))
def _(spark, d):
    return graph_s(spark, d).shared_predecessors(_some(spark, 0, 1, 2), 1, 3)


@query("a13_subgraph_metrics", f"""WITH {SQL_P}, m AS (SELECT id FROM pv WHERE id < 40), f AS (SELECT src, dst, src IN (SELECT id FROM m) AS s, dst IN (SELECT id FROM m) AS d FROM pe)
SELECT (SELECT count(*) FROM m) AS nodes, count(*) FILTER (s AND d) AS arcs, count(*) FILTER (s AND d) / (SELECT count(*) FROM m) AS avgdegree,
count(*) FILTER (NOT s AND d) AS inlinks, count(*) FILTER (s AND NOT d) AS outlinks, count(*) FILTER (d) AS total_inlinks, count(*) FILTER (s) AS total_outlinks,
count(DISTINCT dst) FILTER (s) AS nodes_linked, count(DISTINCT src) FILTER (d) AS nodes_linking FROM f""")
def _(spark, d):
    p = graph_p(spark, d)
    return p.subgraph_metrics(p.vertices.where("id < 40").select("id"))


@query("j6_label_to_id", f"WITH {SQL_P} SELECT p_partkey, name, id FROM pv")
def _(spark, d):
    wanted = table(spark, d, "part").select("p_partkey", part_name().alias("name"))
    return graph_p(spark, d).ids_of(wanted)


@query("j7_id_to_label", f"WITH {SQL_P} SELECT src AS id, name, count(*) AS n FROM pe JOIN pv ON pv.id = src GROUP BY ALL")
def _(spark, d):
    p = graph_p(spark, d)
    return p.names_of(p.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"))).select("id", "name", "n")


@query("j8_is_arc", f"WITH {SQL_P}, t AS (SELECT a.id AS src, b.id AS dst FROM pv a JOIN pv b ON b.id = a.id + 7) SELECT t.src, t.dst, pe.src IS NOT NULL AS is_arc FROM t LEFT JOIN pe ON pe.src = t.src AND pe.dst = t.dst")
def _(spark, d):
    p = graph_p(spark, d)
    top = F.max("id").over(Window.partitionBy())
    pairs = p.vertices.select(F.col("id").alias("src"), (F.col("id") + 7).alias("dst"), top.alias("top")).where("dst <= top").drop("top")
    return p.is_arc(pairs)


@query("j10_neighbours_with_names", f"WITH {SQL_S} SELECT src, dst, v.name FROM se JOIN sv v ON v.id = dst")
def _(spark, d):
    s = graph_s(spark, d)
    return s.names_of(s.edges, "dst")


_SUCC = "SELECT dst AS id FROM se WHERE src = {0}"


@query("u1_intersect", f"WITH {SQL_S} {_SUCC.format(1)} INTERSECT ALL {_SUCC.format(2)}")
def _(spark, d):
    s = graph_s(spark, d)
    return g.intersect(s.successor_ids(1), s.successor_ids(2))


@query("u3_difference", f"WITH {SQL_S} ({_SUCC.format(1)} UNION ALL {_SUCC.format(1)}) EXCEPT ALL {_SUCC.format(2)}")
def _(spark, d):
    s = graph_s(spark, d)
    return g.difference(s.successor_ids(1).union(s.successor_ids(1)), s.successor_ids(2))


@query("u4_successor_intersect", f"WITH {SQL_S} {_SUCC.format(1)} AND dst % 3 = 0")
def _(spark, d):
    s = graph_s(spark, d)
    return s.successor_intersect(1, s.vertices.where("id % 3 = 0").select("id"))


@query("u5_predecessor_intersect", f"WITH {SQL_S} SELECT src AS id FROM se WHERE dst = 1 AND src % 3 = 0")
def _(spark, d):
    s = graph_s(spark, d)
    return s.predecessor_intersect(1, s.vertices.where("id % 3 = 0").select("id"))


@query("u7_merge_links", f"WITH {SQL_H} SELECT DISTINCT src_host, dst_host FROM hl")
def _(spark, d):
    return g.merge_links(page_links(spark, d), page_links(spark, d).select("src_host", "dst_host"))


@query("g2_transpose", f"WITH {SQL_P} SELECT dst AS src, src AS dst FROM pe")
def _(spark, d):
    return graph_p(spark, d).transposed().edges


@query("g3_symmetrize", f"WITH {SQL_P} SELECT src, dst FROM pe UNION SELECT dst, src FROM pe")
def _(spark, d):
    return graph_p(spark, d).symmetric().edges


# --- algorithms -----------------------------------------------------------------------------

_BFS = """
RECURSIVE {h}, bfs(x, y, d) AS (SELECT id, id, 0 FROM {v} UNION SELECT x, dst, d + 1 FROM bfs JOIN {e} ON src = y WHERE d < 60),
dist AS (SELECT x, y, min(d) AS d FROM bfs GROUP BY x, y)"""
_HC = "hc AS (SELECT hv.id, CAST(coalesce(sum(1.0 / d), 0) AS FLOAT) AS hc FROM hv LEFT JOIN dist ON y = hv.id AND d > 0 GROUP BY hv.id)"


@query("g4_harmonic", f"WITH {_BFS.format(h=SQL_H, e='he', v='hv')}, {_HC} SELECT id, round(CAST(hc AS DOUBLE), 4) AS hc FROM hc")
def _(spark, d):
    h = graph_h(spark, d)
    return rank.harmonic_exact(h.vertices, h.edges).select("id", F.round(F.col("hc").cast("double"), 4).alias("hc"))


#: Three standard errors of a ball's size, with sketches of 4096 registers.
HLL_ERROR = 3 * 1.04 / 64


@query("g4_harmonic_hll", f"WITH {_BFS.format(h=SQL_C, e='ce', v='cv')}, hc AS (SELECT cv.id, coalesce(sum(1.0 / d), 0) AS hc FROM cv LEFT JOIN dist ON y = cv.id AND d > 0 GROUP BY cv.id) SELECT id, round(CAST(hc AS DOUBLE), 4) AS exact, TRUE AS within FROM hc")
def _(spark, d):
    """The sketched values against the exact ones: within their error."""
    c = graph_c(spark, d)
    exact = rank.harmonic_exact(c.vertices, c.edges)
    near = rank.harmonic_sketched(c.vertices, c.edges).select("id", F.col("hc").alias("near"))
    bound = HLL_ERROR * F.greatest(F.col("hc"), F.lit(1.0))
    return exact.join(near, "id").select("id", F.round(F.col("hc").cast("double"), 4).alias("exact"), (F.abs(F.col("near") - F.col("hc")) <= bound).alias("within"))


@query("w3_harmonic_rank", f"WITH {_BFS.format(h=SQL_C, e='ce', v='cv')}, hc AS (SELECT cv.id, round(coalesce(sum(1.0::DOUBLE / d), 0), 4) AS hc FROM cv LEFT JOIN dist ON y = cv.id AND d > 0 GROUP BY cv.id) SELECT id, hc, row_number() OVER (ORDER BY hc DESC, id) AS pos FROM hc")
def _(spark, d):
    c = graph_c(spark, d)
    return ranks.position(rank.harmonic_exact(c.vertices, c.edges).select("id", F.round(F.col("hc").cast("double"), 4).alias("hc")), "hc", "pos")


def pagerank_sql(v: str, e: str, pref: str, rounds: int) -> str:
    out = f"""nn AS (SELECT count(*) AS n FROM {v}), dg AS (SELECT src, count(*) AS deg FROM {e} GROUP BY src),
base AS (SELECT {v}.id, {pref} AS v, deg FROM {v} LEFT JOIN dg ON dg.src = {v}.id), r0 AS (SELECT id, v AS pr FROM base)"""
    for k in range(rounds):
        out += f""",
r{k + 1} AS MATERIALIZED (SELECT base.id, 0.85 * (coalesce(s, 0) + (SELECT coalesce(sum(pr), 0) FROM r{k} JOIN base b USING (id) WHERE b.deg IS NULL) * base.v) + 0.15 * base.v AS pr
  FROM base LEFT JOIN (SELECT dst, sum(pr / deg) AS s FROM {e} JOIN dg USING (src) JOIN r{k} ON r{k}.id = src GROUP BY dst) t ON t.dst = base.id)"""
    return out


_UNIFORM = "1.0 / (SELECT n FROM nn)"
#: Rounds of the SQL: by far more than graph P needs for the tolerance.
ITERATIONS, TOLERANCE = 30, 1e-10


@query("g5_pagerank", f"WITH {SQL_P}, {pagerank_sql('pv', 'pe', _UNIFORM, ITERATIONS)} SELECT id, round(pr, 9) AS pr FROM r{ITERATIONS}")
def _(spark, d):
    p = graph_p(spark, d)
    return rank.pagerank(p.vertices, p.edges, tolerance=TOLERANCE).select("id", F.round("pr", 9).alias("pr"))


_PREFERRED = "CASE WHEN pv.id % 10 = 0 THEN 1.0 / (SELECT count(*) FROM pv WHERE id % 10 = 0) ELSE 0 END"


@query("g6_personalized_pagerank", f"WITH {SQL_P}, {pagerank_sql('pv', 'pe', _PREFERRED, ITERATIONS)} SELECT id, round(pr, 9) AS pr FROM r{ITERATIONS}")
def _(spark, d):
    p = graph_p(spark, d)
    pref = preference.preference_vector(p.vertices, p.vertices.where("id % 10 = 0").select("name"))
    preference.check_stochastic(pref)
    return rank.pagerank(p.vertices, p.edges, tolerance=TOLERANCE, preference=pref).select("id", F.round("pr", 9).alias("pr"))


_WCC = f"""WITH {_BFS.format(h=SQL_C + ", both_ways AS (SELECT src, dst FROM ce UNION SELECT dst, src FROM ce)", e='both_ways', v='cv')},
root AS (SELECT x AS id, min(y) AS root FROM dist GROUP BY x)"""
_SCC = f"""WITH {_BFS.format(h=SQL_C, e='ce', v='cv')},
root AS (SELECT a.x AS id, min(a.y) AS root FROM dist a JOIN dist b ON a.x = b.y AND a.y = b.x GROUP BY a.x)"""
_RENUMBER = """, cs AS (SELECT root, count(*) AS size FROM root GROUP BY root), cn AS (SELECT root, size, row_number() OVER (ORDER BY size DESC, root) - 1 AS comp FROM cs)"""


@query("g7_wcc", f"{_WCC}{_RENUMBER} SELECT id, comp FROM root JOIN cn USING (root)")
def _(spark, d):
    c = graph_c(spark, d)
    return components.weak_components(c.vertices, c.edges)


@query("g8_scc", f"{_SCC}{_RENUMBER} SELECT id, comp FROM root JOIN cn USING (root)")
def _(spark, d):
    c = graph_c(spark, d)
    return components.strong_components(c.vertices, c.edges)


@query("a8_component_distrib", f"{_WCC}{_RENUMBER} SELECT count(*) AS freq, size, round(100.0 * size * count(*) / (SELECT count(*) FROM cv), 6) AS perc FROM cs GROUP BY size")
def _(spark, d):
    c = graph_c(spark, d)
    found = components.size_distribution(components.weak_components(c.vertices, c.edges))
    return found.withColumn("perc", F.round("perc", 6))


# --- ranks ------------------------------------------------------------------------------------


def _degrees(spark, graph: g.Graph) -> DataFrame:
    """Degrees, computed once for all that is made of them."""
    return Scratch(spark, "catalog").cut(graph.degrees(), "degrees")


def _of_degrees(deg: DataFrame) -> tuple[DataFrame, DataFrame]:
    return deg.select("id", (F.col("indegree") / 8).cast("float").alias("hc")), deg.select("id", (F.col("outdegree") / 64).alias("pr"))


def _scores(spark, d) -> tuple[g.Graph, DataFrame, DataFrame]:
    """Graph P with degree-based scores that stand for centralities: many ties, exact in any engine."""
    p = graph_p(spark, d)
    return p, *_of_degrees(_degrees(spark, p))


_SC = f"{_PD}, hcp AS (SELECT id, row_number() OVER (ORDER BY indegree DESC, id) AS p FROM deg), prp AS (SELECT id, row_number() OVER (ORDER BY outdegree DESC, id) AS p FROM deg)"


@query("w3_hc_rank", f"{_SC} SELECT deg.id, CAST(indegree / 8 AS FLOAT) AS hc, p AS pos FROM deg JOIN hcp USING (id)")
def _(spark, d):
    return ranks.position(_scores(spark, d)[1], "hc", "pos")


@query("w4_pr_rank", f"{_SC} SELECT deg.id, outdegree / 64 AS pr, p AS pos FROM deg JOIN prp USING (id)")
def _(spark, d):
    return ranks.position(_scores(spark, d)[2], "pr", "pos")


@query("j2_join_ranks", f"{_SC} SELECT hcp.p AS harmonicc_pos, CAST(indegree / 8 AS FLOAT) AS harmonicc_val, prp.p AS pr_pos, outdegree / 64 AS pr_val, name AS host_rev FROM deg JOIN hcp USING (id) JOIN prp USING (id)")
def _(spark, d):
    p, hc, pr = _scores(spark, d)
    return ranks.join_ranks(p.vertices, hc, pr)


@query("j5_outer_join_ranks", f"""{_SC}, a AS (SELECT p AS harmonicc_pos, CAST(indegree / 8 AS FLOAT) AS harmonicc_val, name FROM deg JOIN hcp USING (id) WHERE indegree >= outdegree),
b AS (SELECT p AS pr_pos, outdegree / 64 AS pr_val, name FROM deg JOIN prp USING (id) WHERE indegree <= outdegree)
SELECT coalesce(CAST(harmonicc_pos AS VARCHAR), '---') AS harmonicc_pos, coalesce(CAST(pr_pos AS VARCHAR), '---') AS pr_pos, coalesce(a.name, b.name) AS host_rev FROM a FULL JOIN b ON a.name = b.name""")
def _(spark, d):
    p = graph_p(spark, d)
    deg = _degrees(spark, p)
    hc, pr = _of_degrees(deg)
    a = ranks.position(hc.withColumnRenamed("hc", "harmonicc_val"), "harmonicc_val", "harmonicc_pos").join(p.vertices, "id")
    b = ranks.position(pr.withColumnRenamed("pr", "pr_val"), "pr_val", "pr_pos").join(p.vertices, "id")
    left = a.join(deg.where("indegree >= outdegree").select("id"), "id", "left_semi").drop("id")
    right = b.join(deg.where("indegree <= outdegree").select("id"), "id", "left_semi").drop("id")
    return ranks.rank_text(ranks.outer_join_ranks(left.union(left), right)).select("harmonicc_pos", "pr_pos", "host_rev")


@query("j4_preference_vector", f"WITH {SQL_P}, k AS (SELECT count(*) AS n FROM pv WHERE p_partkey % 11 = 0) SELECT id, CASE WHEN p_partkey % 11 = 0 THEN 1.0 / n ELSE 0 END AS pref FROM pv, k")
def _(spark, d):
    p = graph_p(spark, d)
    wanted = table(spark, d, "part").where("p_partkey % 11 = 0").select(part_name().alias("name"))
    odd = spark.createDataFrame([("zz.unknown",)], "name string")
    out = preference.preference_vector(p.vertices, wanted.union(wanted).union(odd))
    preference.check_stochastic(out)
    return out


@query("k10_component_lines", f"{_WCC}{_RENUMBER} SELECT count(*) AS freq, size, printf('%9.6f%%', 100.0 * size * count(*) / (SELECT count(*) FROM cv)) AS perc FROM cs GROUP BY size")
def _(spark, d):
    c = graph_c(spark, d)
    return text.component_lines(components.size_distribution(components.weak_components(c.vertices, c.edges)))


# --- round trips through files, and the rest of the explorer --------------------------------------


def _file(spark, name: str) -> str:
    return Scratch(spark, "catalog").path(name)


@query("s1_k1_vertices_file", f"WITH {SQL_P} SELECT id, name FROM pv")
def _(spark, d):
    path = _file(spark, "vertices")
    text.write_vertices(graph_p(spark, d).vertices, path)
    return text.read_vertices(spark, path, partitions=4)


@query("s2_k2_edges_file", f"WITH {SQL_P} SELECT src, dst FROM pe")
def _(spark, d):
    path, edges = _file(spark, "edges"), graph_p(spark, d).edges
    text.write_edges(edges.union(edges), path)
    return text.read_edges(spark, path)


@query("s4_keyed_lines", f"WITH {SQL_P} SELECT id, name || chr(9) || p_partkey AS rest FROM pv")
def _(spark, d):
    path = _file(spark, "lines")
    part = number(table(spark, d, "part").select("p_partkey", part_name().alias("name")), ["name"])
    text.write_strings(part.select(F.concat_ws("\t", "id", "name", "p_partkey").alias("value")).union(part.select(F.lit("no key"))), path)
    return text.read_keyed_lines(spark, path)


@query("s6_malformed_lines", f"WITH {SQL_P} SELECT name AS value FROM pv")
def _(spark, d):
    path, p = _file(spark, "lines"), graph_p(spark, d)
    text.write_strings(p.vertices.select(F.concat_ws("\t", "id", "name").alias("value")).union(p.vertices.select("name")), path)
    return text.malformed_lines(spark, path)


@query("s10_k8_graph_files", f"WITH {SQL_P} SELECT src, name, dst FROM pe JOIN pv ON pv.id = src")
def _(spark, d):
    path = _file(spark, "graph")
    graph_p(spark, d).save(path)
    found = g.Graph.load(spark, path)
    return found.names_of(found.edges, "src").select("src", "name", "dst")


@query("s11_k5_vertex_list", f"WITH {SQL_P} SELECT id, name FROM pv JOIN (SELECT DISTINCT dst FROM pe) ON dst = id")
def _(spark, d):
    path, p = _file(spark, "names"), graph_p(spark, d)
    text.write_names(p, p.edges.select(F.col("dst").alias("id")).distinct(), path)
    return text.load_vertices(p, path).select("id", "name")


@query("s12_k6_names_file", f"WITH {SQL_H} SELECT h AS name FROM hp")
def _(spark, d):
    path = _file(spark, "names")
    text.write_strings(page_names(spark, d).select(F.concat(F.lit(" "), "h").alias("value")).union(spark.createDataFrame([("  ",)], "value string")), path)
    return text.read_names(spark, path)


@query("k3_ranks_file", f"{_SC} SELECT CAST(hcp.p AS VARCHAR) AS harmonicc_pos, CAST(prp.p AS VARCHAR) AS pr_pos, name AS host_rev FROM deg JOIN hcp USING (id) JOIN prp USING (id) UNION ALL SELECT '#harmonicc_pos', '#pr_pos', '#host_rev'")
def _(spark, d):
    path, (p, hc, pr) = _file(spark, "ranks"), _scores(spark, d)
    text.write_ranks(ranks.join_ranks(p.vertices, hc, pr).select("harmonicc_pos", "pr_pos", "host_rev"), path)
    cols = F.split("value", "\t")
    return spark.read.text([f"{path}/header", f"{path}/rows"]).select(*(cols[i].alias(c) for i, c in enumerate(("harmonicc_pos", "pr_pos", "host_rev"))))


@query("k7_counts_file", f"WITH {SQL_P} SELECT CAST(count(*) AS VARCHAR) || chr(9) || split_part(name, '.', 1) AS value FROM pv GROUP BY split_part(name, '.', 1)")
def _(spark, d):
    path, p = _file(spark, "counts"), graph_p(spark, d)
    text.write_counts(p.tld_counts(p.vertices.select("id")), path)
    return spark.read.text(path)


@query("k12_stats_lines", f"{_PD}, x AS (SELECT count(*) AS nodes, CAST(sum(outdegree) AS BIGINT) AS arcs, max(outdegree) AS o, max(indegree) AS i FROM deg) SELECT unnest(['nodes=' || nodes, 'arcs=' || arcs, 'maxoutdegree=' || o, 'maxindegree=' || i]) AS value FROM x")
def _(spark, d):
    path = _file(spark, "stats")
    text.write_strings(text.stats_lines(stats.graph_stats(graph_p(spark, d)).select("nodes", "arcs", "maxoutdegree", "maxindegree")), path)
    return spark.read.text(path)


@query("s16_reuse_vertices", f"WITH {SQL_P} SELECT id, name FROM pv UNION ALL SELECT NULL, split_part(name, '.', 1) FROM pv GROUP BY ALL")
def _(spark, d):
    p = graph_p(spark, d)
    some = p.vertices.select("name").union(p.vertices.select(names.top_level_domain(F.col("name")).alias("name")))
    known, new = reuse_vertices(some, p.vertices)
    return known.union(new.select(F.lit(None).cast("long").alias("id"), "name"))


@query("r10_fold", f"""WITH {SQL_P}, dv AS (SELECT DISTINCT split_part(name, '.', 1) || '.' || split_part(name, '.', 2) AS name FROM pv),
dn AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS id FROM dv), m AS (SELECT pv.id AS host, dn.id AS id FROM pv JOIN dn ON dn.name = split_part(pv.name, '.', 1) || '.' || split_part(pv.name, '.', 2))
SELECT DISTINCT a.id AS src, b.id AS dst FROM pe JOIN m a ON a.host = src JOIN m b ON b.host = dst WHERE a.id <> b.id""")
def _(spark, d):
    p = graph_p(spark, d)
    return fold.fold(p.vertices, p.edges)[1]


#: A made-up rule list: a wildcard with an exception, a rule of two labels, and a private one.
RULES = """// ===BEGIN ICANN DOMAINS===
com
net
org
*.de
!d2.de
fr
d3.fr
// ===END ICANN DOMAINS===
// ===BEGIN PRIVATE DOMAINS===
d4.com
// ===END PRIVATE DOMAINS===
"""
_L = "string_split(name, '.')"
_RULED = f"""WITH {SQL_P}, r AS (SELECT name, {_L} AS l, CASE WHEN {_L}[1] = 'de' AND {_L}[2] = 'd2' THEN 1 WHEN {_L}[1] = 'de' THEN 2
WHEN {_L}[1] = 'fr' AND {_L}[2] = 'd3' THEN 2 {{0}} ELSE 1 END AS k FROM pv)
SELECT name, array_to_string(list_slice(l, 1, k + 1), '.') AS domain FROM r"""


@query("f2_rules", _RULED.format(""))
def _(spark, d):
    return suffixes.registered_domain(graph_p(spark, d).vertices.select("name"), "name", text=RULES)


@query("f3_private_rules", _RULED.format(f"WHEN {_L}[1] = 'com' AND {_L}[2] = 'd4' THEN 2"))
def _(spark, d):
    return suffixes.registered_domain(graph_p(spark, d).vertices.select("name"), "name", private=True, text=RULES)


@query("f10_absolute_links", f"SELECT page_id, {_HOST} AS host FROM pages UNION ALL SELECT page_id, 'own.example' FROM pages UNION ALL SELECT page_id, 'other.example' FROM pages")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    links = pages.select("page_id", F.explode(F.array("url", F.lit("/a/b?c#d"), F.lit("//Other.example:80/x"))).alias("link"))
    return links.select("page_id", names.link_host(F.col("link"), F.lit("own.example")).alias("host"))


@query("a14_degrees_of_one", f"WITH {SQL_P}, a AS (SELECT id FROM pv WHERE name = '{{0}}') SELECT (SELECT count(*) FROM pe JOIN a ON id = src) AS outdegree, (SELECT count(*) FROM pe JOIN a ON id = dst) AS indegree".format("org.d0.h1"))
def _(spark, d):
    return graph_p(spark, d).degrees_of("org.d0.h1")


@query("x5_tld_stream", f"WITH {SQL_P} SELECT split_part(v.name, '.', 1) AS tld FROM pe JOIN pv a ON a.id = src JOIN pv v ON v.id = dst WHERE a.name = 'org.d0.h1'")
def _(spark, d):
    return graph_p(spark, d).successor_top_level_domains("org.d0.h1")


@query("x6_x9_explorer", f"WITH {SQL_P}, a AS (SELECT id, name FROM pv WHERE name = 'org.d0.h1') SELECT '#' || id || chr(9) || name AS pwn, (SELECT count(*) FROM pe WHERE src = a.id) AS n_ls, (SELECT count(*) FROM pe WHERE dst = a.id) AS n_sl FROM a")
def _(spark, d):
    e = Explorer(graph_p(spark, d))
    here = e.cn("org.d0.h1")
    at = e.graph.vertices.where(F.col("id") == here.id).select(F.lit(0).alias("k"), names.vertex_text(F.col("id"), F.col("name")).alias("pwn"))
    n_ls, n_sl = (x.agg(F.count("*").alias(n)).withColumn("k", F.lit(0)) for x, n in ((e.ls(), "n_ls"), (e.sl(), "n_sl")))
    return at.join(n_ls, "k").join(n_sl, "k").drop("k")  # three single rows


@query("x11_predecessor_listing", f"WITH {SQL_P}, p AS (SELECT v.id, v.name FROM pe JOIN pv a ON a.id = dst JOIN pv v ON v.id = src WHERE a.name = 'org.d0.h1'), n AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM p) SELECT pos, pos || ': #' || id || chr(9) || name AS line FROM n")
def _(spark, d):
    return Explorer(graph_p(spark, d)).sl("org.d0.h1")


# --- vectors, single files, reports, crawls --------------------------------------------------------


def _vector(spark, d, kind: str, value: F.Column) -> DataFrame:
    """A vector of graph P written as a binary file and read back."""
    path = _file(spark, "vector")
    deg = graph_p(spark, d).degrees().select("id", value.alias("value"))
    vectors.write_vector(deg, path, kind, "value")
    return vectors.read_vector(spark, path, kind, "value")


@query("s7_float_vector", f"{_PD} SELECT id, CAST(indegree / 8 AS FLOAT) AS value FROM deg")
def _(spark, d):
    return _vector(spark, d, "float", F.col("indegree") / 8)


@query("s8_double_vector", f"{_PD} SELECT id, outdegree / 64 AS value FROM deg")
def _(spark, d):
    return _vector(spark, d, "double", F.col("outdegree") / 64)


@query("s9_int_vector_text", f"{_PD} SELECT CAST(id AS INTEGER) AS pos, CAST(outdegree AS VARCHAR) AS line FROM deg")
def _(spark, d):
    path = _file(spark, "numbers") + ".gz"
    text.write_one(vectors.vector_text(_vector(spark, d, "int", F.col("outdegree")), "value"), path)
    return _numbered(spark, path)


def _numbered(spark, path: str) -> DataFrame:
    """(pos, line) of one file: its order as well as its lines, which are streamed.  A gzip file is read in one piece, so
    its rows are numbered as they come; of others the lines before each piece are counted first."""
    rows = spark.read.text(path, lineSep="\n").select(F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("piece"))
    if path.endswith(".gz"):
        return rows.select(F.col("at").cast("int").alias("pos"), "line")
    pieces = rows.groupBy("piece").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("piece")) - F.col("n")  # one row a piece
    shift = pieces.select("piece", (before - F.col("first")).alias("shift"))
    return rows.join(F.broadcast(shift), "piece").select((F.col("at") + F.col("shift")).cast("int").alias("pos"), "line")


@query("k4_preference_file", f"WITH {SQL_P}, k AS (SELECT count(*) AS n FROM pv WHERE id % 9 = 0) SELECT id, CASE WHEN id % 9 = 0 THEN 1.0 / n ELSE 0 END AS pref FROM pv, k")
def _(spark, d):
    path, p = _file(spark, "preference"), graph_p(spark, d)
    vectors.write_vector(preference.preference_vector(p.vertices, p.vertices.where("id % 9 = 0").select("name")), path, "double", "pref")
    return vectors.read_vector(spark, path, "double", "pref")


@query("s5_vertices_with_more_columns", f"WITH {SQL_P} SELECT id, name FROM pv")
def _(spark, d):
    path = _file(spark, "vertices")
    text.write_strings(graph_p(spark, d).vertices.select(F.concat_ws("\t", "id", "name", F.lit("more"), F.lit("fields")).alias("value")), path)
    return text.read_vertices(spark, path)


@query("o1_k9_edges_in_one_file", f"WITH {SQL_P} SELECT CAST(row_number() OVER (ORDER BY src, dst) - 1 AS INTEGER) AS pos, src || chr(9) || dst AS line FROM pe")
def _(spark, d):
    path = _file(spark, "edges") + ".gz"
    text.write_edges(graph_p(spark, d).edges, path, one=True)
    return _numbered(spark, path)


@query("o2_k3_ranks_in_one_file", f"""{_SC}, r AS (SELECT hcp.p AS pos, hcp.p || chr(9) || prp.p || chr(9) || name AS line FROM deg JOIN hcp USING (id) JOIN prp USING (id)
UNION ALL SELECT 0, '#harmonicc_pos' || chr(9) || '#pr_pos' || chr(9) || '#host_rev') SELECT CAST(pos AS INTEGER) AS pos, line FROM r""")
def _(spark, d):
    path, (p, hc, pr) = _file(spark, "ranks") + ".gz", _scores(spark, d)
    text.write_ranks(ranks.join_ranks(p.vertices, hc, pr).select("harmonicc_pos", "pr_pos", "host_rev"), path, one=True)
    return _numbered(spark, path)


@query("o4_o5_counts_in_order", f"WITH {SQL_P}, c AS (SELECT split_part(v.name, '.', 1) AS key, count(*) AS cnt FROM pe JOIN pv v ON v.id = dst GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY cnt DESC, key) - 1 AS INTEGER) AS pos, key || chr(9) || cnt AS line FROM c")
def _(spark, d):
    path, p = _file(spark, "counts"), graph_p(spark, d)
    text.write_one(p.tld_counts(p.edges.select(F.col("dst").alias("id"))), path, gzip=False)
    return _numbered(spark, path)


@query("o6_page_of_vertices", f"WITH {SQL_P} SELECT id, name FROM pv ORDER BY name DESC LIMIT 25 OFFSET 40")
def _(spark, d):
    return page(graph_p(spark, d).vertices, [F.desc("name")], 25, 40)


@query("k11_degree_outputs", f"""{_PD}, t AS (SELECT outdegree AS o, indegree AS i, outdegree || chr(9) || indegree || chr(9) || name AS line FROM deg),
top_o AS (SELECT line FROM t WHERE o > 20 ORDER BY o DESC, line LIMIT 100), top_i AS (SELECT line FROM t WHERE i > 20 ORDER BY i DESC, line LIMIT 100)
SELECT 'outdegree-indegree' AS output, line FROM t UNION ALL SELECT 'top-outdegree', line FROM top_o UNION ALL SELECT 'top-indegree', line FROM top_i
UNION ALL SELECT 'outdegree-distribution', o || chr(9) || count(*) FROM t GROUP BY o UNION ALL SELECT 'indegree-distribution', i || chr(9) || count(*) FROM t GROUP BY i""")
def _(spark, d):
    path = _file(spark, "degrees")
    stats.degree_outputs(graph_p(spark, d), path, 20, 100)
    out = [spark.read.text(f"{path}/{n}/rows").select(F.lit(n).alias("output"), F.col("value").alias("line")) for n in stats.OUTPUTS]
    return reduce(DataFrame.union, out)


@query("r11_fold_report", f"""WITH {SQL_P}, {_FOLD.format(v='pv', e='pe')}, m AS (SELECT a.domain_id AS s, b.domain_id AS t FROM pe JOIN dm a ON a.host_id = src JOIN dm b ON b.host_id = dst)
SELECT 'out_edges.written' AS figure, (SELECT count(*) FROM de) AS value UNION ALL SELECT 'mapped.edges', (SELECT count(*) FROM m) UNION ALL SELECT 'mapped.loops', (SELECT count(*) FROM m WHERE s = t)
UNION ALL SELECT 'host_edges.read', (SELECT count(*) FROM pe) UNION ALL SELECT 'hosts.read', (SELECT count(*) FROM pv) UNION ALL SELECT 'hosts.without_domain', 0""")
def _(spark, d):
    report, p = Report(), graph_p(spark, d)
    _, edges = fold.fold(p.vertices, p.edges, report=report)
    text.write_edges(edges, _file(spark, "edges"), report=report)
    figures = [(k, int(v)) for k, v in report.figures().items()]
    return spark.createDataFrame(figures, "figure string, value long")


_ODD = """CASE p_partkey % 6 WHEN 0 THEN 'N' || p_partkey || '.B' || chr(252) || 'cher.DE.' WHEN 1 THEN 'n' || p_partkey || '.xn--p1ai' WHEN 2 THEN 'n' || p_partkey || '.nosuchtld'
WHEN 3 THEN '10.0.0.' || p_partkey % 250 WHEN 4 THEN 'n' || p_partkey || '.example.Org' ELSE 'n' || p_partkey || '..com' END"""


@query("p8_known_tlds", """WITH known(tld) AS (VALUES ('com'), ('org'), ('net'), ('de'), ('fr'), ('xn--p1ai')),
h AS (SELECT CASE p_partkey % 6 WHEN 0 THEN 'n' || p_partkey || '.xn--bcher-kva.de' WHEN 1 THEN 'n' || p_partkey || '.xn--p1ai' WHEN 2 THEN 'n' || p_partkey || '.nosuchtld'
WHEN 3 THEN '10.0.0.' || p_partkey % 250 WHEN 4 THEN 'n' || p_partkey || '.example.org' ELSE 'n' || p_partkey || '..com' END AS host FROM part)
SELECT host AS src_host, 'example.com' AS dst_host FROM h JOIN known ON tld = split_part(host, '.', len(string_split(host, '.'))) WHERE NOT contains(host, '..')""")
def _(spark, d):
    odd = table(spark, d, "part").select(F.expr(_ODD.replace("chr(252)", "char(252)")).alias("src_host"), F.lit("Example.com").alias("dst_host"))
    return hostlinks.valid_links(odd, normalize=True, known_tlds=True)


@query("p7_redirect_links", f"WITH {SQL_H} SELECT x.page_id, a.host AS src_host, CASE WHEN x.page_id % 2 = 0 THEN b.host ELSE a.host END AS dst_host FROM pages x JOIN (SELECT page_id, {_HOST} AS host FROM pages) a USING (page_id) JOIN (SELECT page_id - 1 AS page_id, {_HOST} AS host FROM pages) b USING (page_id)")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    nxt = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("to"))
    moved = pages.join(nxt, "page_id").select("page_id", "url", F.when(F.col("page_id") % 2 == 0, F.col("to")).otherwise(F.lit("/elsewhere?x=//y.z")).alias("location"))
    return hostlinks.redirect_links(moved, carry=["page_id"])


@query("p7_sitemap_links", f"WITH {SQL_H} SELECT a.host AS src_host, b.host AS dst_host, count(*) AS n FROM (SELECT page_id, {_HOST} AS host FROM pages) a JOIN (SELECT page_id - 1 AS page_id, {_HOST} AS host FROM pages) b USING (page_id) GROUP BY ALL")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    nxt = pages.select((F.col("page_id") - 1).alias("page_id"), F.concat(F.lit("User-agent: *\nDisallow: /\nSiteMap:  "), F.col("url"), F.lit("\n")).alias("text"))
    return hostlinks.sitemap_links(pages.join(nxt, "page_id")).groupBy("src_host", "dst_host").agg(F.count("*").alias("n"))


@query("s13_s14_o8_input_jobs", """WITH n AS (SELECT 2 * count(*) AS n FROM pages), b AS (SELECT unnest(range(0, (n + 63) // 64)) AS batch, n FROM n)
SELECT batch, least(64, n - 64 * batch) AS paths, n AS all_paths FROM b""")
def _(spark, d):
    pages = table(spark, d, "pages")
    lists = [pages.select(F.concat("url", F.lit(f"#{k}-"), "page_id").alias("path")) for k in (1, 2)]
    folder = _file(spark, "jobs")
    hostlinks.write_input_jobs(hostlinks.union_inputs(*lists), folder, most=64)
    jobs = hostlinks.read_input_jobs(spark, folder)
    sizes = jobs.groupBy("batch").agg(F.count("*").alias("paths"))
    return sizes.join(jobs.agg(F.count_distinct("path").alias("all_paths")).withColumn("k", F.lit(0)), F.col("k") == 0).drop("k")


@query("s15_links_of_many_inputs", f"WITH {SQL_H} SELECT src_host, dst_host, count(*) AS n FROM hl GROUP BY ALL")
def _(spark, d):
    """Links in several inputs, listed, dealt to jobs of two files at most, and read job by job."""
    folder = _file(spark, "inputs")
    page_links(spark, d).repartition(5).write.parquet(folder)
    jobs = hostlinks.input_batches(hostlinks.list_inputs(spark, folder), most=2)
    of = jobs.groupBy("batch").agg(F.collect_list("path").alias("paths")).orderBy("batch").collect()  # the input list of each job
    links = [hostlinks.read_links(spark, *r["paths"]) for r in of]
    return hostlinks.union_inputs(*links).groupBy("src_host", "dst_host").agg(F.count("*").alias("n"))


@query("s15_r1_incremental_crawls", f"WITH {SQL_H} SELECT DISTINCT src_host, dst_host, 3 AS crawls FROM hl")
def _(spark, d):
    """Three crawls, of which one is added twice, one was interrupted before, and one brings nothing new."""
    links = page_links(spark, d).join(page_names(spark, d).select(F.col("h").alias("src_host")).distinct(), "src_host")
    odd = F.pmod(F.xxhash64("src_host"), F.lit(2)) == 1
    store = LinkStore(spark, _file(spark, "links"), buckets=16)
    store.add("a", links.where(odd))
    store.add("a", links)
    store.prepare("b", links.where(~odd))
    for name, rows in (("b", links.where(~odd)), ("c", links)):
        store.add(name, rows)
    store.tidy()
    return store.links().withColumn("crawls", F.lit(len(store.crawls())))


@query("u7_merge_crawls", f"WITH {SQL_H} SELECT src_host, dst_host FROM hl UNION SELECT dst_host, src_host FROM hl")
def _(spark, d):
    a = page_links(spark, d)
    return g.merge_links(a, a.select(F.col("dst_host").alias("src_host"), F.col("src_host").alias("dst_host")))


@query("x12_shortcuts", f"WITH {SQL_P}, r AS (SELECT v.id, v.name, row_number() OVER (ORDER BY v.id) - 1 AS pos FROM pe JOIN pv v ON v.id = dst WHERE src = 7) SELECT CAST(pos AS INTEGER) AS pos, pos || ': #' || id || chr(9) || name AS line FROM r")
def _(spark, d):
    names_ = shortcuts(Explorer(graph_p(spark, d)))
    names_["cn"](7)
    return names_["ls"]()


def _run_cli(spark, *args: str) -> None:
    if (code := main(list(args), spark)) != 0:
        raise RuntimeError(f"{args[0]} ended with {code}")


def _graph_files(spark, d) -> tuple[str, str]:
    e, p = _file(spark, "e") + ".gz", graph_p(spark, d)
    text.write_edges(p.edges, e, one=True)
    return _vertex_file(spark, p), e


def _vertex_file(spark, graph: g.Graph) -> str:
    v = _file(spark, "v") + ".gz"
    text.write_vertices(graph.vertices, v, one=True)
    return v


@query("r5_fold_command", f"WITH {SQL_P}, {_FOLD.format(v='pv', e='pe')} SELECT name, n_hosts, n_edges FROM dv LEFT JOIN (SELECT src, count(*) AS n_edges FROM de GROUP BY src) ON src = id")
def _(spark, d):
    (v, e), out = _graph_files(spark, d), [_file(spark, n) + ".gz" for n in ("dv", "de")]
    _run_cli(spark, "fold", "--count", "--one-file", v, e, *out)
    edges = text.read_edges(spark, out[1]).groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n_edges"))
    return text.read_vertices(spark, out[0], counts=True).join(edges, "id", "left").select("name", "n_hosts", "n_edges")


@query("r6_ranks_command", f"{_SC}, r AS (SELECT hcp.p AS pos, hcp.p || chr(9) || CAST(indegree / 8 AS FLOAT) || chr(9) || prp.p || chr(9) || name AS line FROM deg JOIN hcp USING (id) JOIN prp USING (id)) SELECT CAST(pos AS INTEGER) AS pos, line FROM r")
def _(spark, d):
    p, hc, pr = _scores(spark, d)
    v = _vertex_file(spark, p)
    paths = [_file(spark, n) for n in ("hc", "pr", "ranks.gz")]
    vectors.write_vector(hc, paths[0], "float", "hc")
    vectors.write_vector(pr, paths[1], "double", "pr")
    _run_cli(spark, "ranks", "--one-file", v, *paths)
    cols = F.split("line", "\t")
    return _numbered(spark, paths[2]).where("pos > 0").select("pos", F.concat_ws("\t", cols[0], cols[1], cols[2], cols[4]).alias("line"))


@query("r1_r14_workflow", f"WITH {SQL_P} SELECT 'hosts' AS step, TRUE AS done, count(*) AS n FROM pv UNION ALL SELECT 'links', TRUE, count(*) FROM pe UNION ALL SELECT 'later', FALSE, 0")
def _(spark, d):
    """Steps in the background, a second run that makes none of them anew, and a stop file before the last."""
    folder, p = _file(spark, "flow"), graph_p(spark, d)
    flow = Workflow(spark, folder)
    flow.background("hosts", lambda: p.vertices)
    flow.background("links", lambda: p.edges)
    flow.wait()
    again = Workflow(spark, folder, stop_file=f"{folder}/stop")
    made = {n: again.step(n, lambda: spark.range(-1, 0).where("id / 0 > 0")) for n in ("hosts", "links")}
    text.write_strings(spark.range(0).select(F.lit("").alias("value")), f"{folder}/stop")
    with contextlib.suppress(Stopped):
        made["later"] = again.step("later", lambda: p.vertices)
    done = again.status("hosts", "links", "later")
    rows = [made.get(n, spark.range(0)).agg(F.count("*").alias("n")).select(F.lit(n).alias("step"), F.lit(x).alias("done"), "n") for n, x in done.items()]
    return reduce(DataFrame.union, rows)


@query("p14_graph_names", """WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN '-' || p_partkey WHEN 2 THEN 'graph_' || p_partkey || '-v1.0' ELSE p_brand END AS name FROM part)
SELECT name, name <> '' AND translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._-', '') = '' AND NOT contains('._-', left(name, 1)) AS valid, count(*) AS n FROM n GROUP BY ALL""")
def _(spark, d):
    k = F.col("p_partkey")
    made = F.when(k % 4 == 0, F.col("p_name")).when(k % 4 == 1, F.concat(F.lit("-"), k)).when(k % 4 == 2, F.concat(F.lit("graph_"), k, F.lit("-v1.0"))).otherwise(F.col("p_brand"))
    return table(spark, d, "part").select(made.alias("name")).groupBy("name", names.is_graph_name(F.col("name")).alias("valid")).agg(F.count("*").alias("n"))


@query("r12_exit_codes", """SELECT * FROM (VALUES ('fold', 0), ('no such level', 1), ('no known name', 1), ('values that sum to 1', 0), ('values that do not', 2), ('no such file', 1)) AS t("case", code)
WHERE (SELECT count(*) FROM part) > 0""")
def _(spark, d):
    (v, e), wanted, odd = _graph_files(spark, d), _file(spark, "names"), _file(spark, "odd")
    some = graph_p(spark, d).vertices.where("id % 5 = 1")
    text.write_strings(some.select(F.col("name").alias("value")), wanted)
    text.write_strings(some.select(F.concat(F.lit("no."), "name").alias("value")), odd)
    n = some.count()
    out = lambda: _file(spark, "out")
    runs = {
        "fold": ["fold", v, e, out(), out()], "no such level": ["fold", "--aggregation-level", "planet", v, e, out(), out()], "no known name": ["preference", v, odd, out()],
        "values that sum to 1": ["preference", "--value", str(1 / n), v, wanted, out()], "values that do not": ["preference", "--value", str(2 / n), v, wanted, out()],
        "no such file": ["preference", v + ".none", wanted, out()],
    }
    return spark.createDataFrame([(k, main(a, spark)) for k, a in runs.items()], "case string, code int")


@query("r7_preference_command", f"WITH {SQL_P}, k AS (SELECT count(*) AS n FROM pv WHERE id % 5 = 1) SELECT id, CASE WHEN id % 5 = 1 THEN 1.0 / n ELSE 0 END AS pref FROM pv, k")
def _(spark, d):
    p, wanted, out = graph_p(spark, d), _file(spark, "names"), _file(spark, "pref")
    v = _vertex_file(spark, p)
    text.write_strings(p.vertices.where("id % 5 = 1").select(F.col("name").alias("value")), wanted)
    _run_cli(spark, "preference", "--binary", v, wanted, out)
    return vectors.read_vector(spark, out, "double", "pref")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: registered domains over the page hosts, with their hosts and in-links."""
    h = graph_h(spark, sf_dir)
    domains, mapping = fold.fold_vertices(h.vertices)
    inlinks = fold.fold_edges(h.edges, mapping).groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("indegree"))
    return domains.join(inlinks, "id", "left").select("id", "name", "n_hosts", F.coalesce("indegree", F.lit(0).cast("long")).alias("indegree"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: partial(_run, f) for k, f in Q.items()}


def _run(f, spark: SparkSession, sf_dir: str) -> DataFrame:
    return f(spark, sf_dir)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
