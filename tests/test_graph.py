"""Graph queries, exploration, statistics and algorithms on small graphs."""

import math

import pytest

from linkframe.operators import components, graph, preference, rank, ranks, stats
from linkframe.operators.explore import Explorer, listing

NAMES = ["com.a", "com.b", "community", "de.c", "org.d", "org.e", "org.f"]
EDGES = [(0, 3), (0, 4), (1, 3), (1, 5), (2, 3), (2, 4), (2, 6), (5, 2)]


@pytest.fixture(scope="module")
def g(spark):
    return graph.Graph(
        spark.createDataFrame(list(enumerate(NAMES)), "id bigint, name string").cache(), spark.createDataFrame(EDGES, "src bigint, dst bigint").cache()
    )


def some(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def test_neighbours(g, rows):
    assert rows(g.successors("com.a")) == rows(g.successors(0)) == [(3, "de.c"), (4, "org.d")]
    assert rows(g.predecessors(3, prefix="com.")) == [(0, "com.a"), (1, "com.b")]
    assert rows(g.successors("unknown")) == rows(g.successors(99)) == []
    assert [tuple(r) for r in g.predecessor_tld_counts(3).collect()] == [("com", 2), ("community", 1)]
    assert [tuple(r) for r in g.successor_tld_counts(2).collect()] == [("org", 2), ("de", 1)]
    assert g.has_arc("com.a", "de.c") and g.has_arc(5, 2) and not g.has_arc(2, 5) and not g.has_arc("x", "de.c")
    assert (g.outdegree("community"), g.indegree(3), g.outdegree(-1)) == (3, 3, 0)


def test_shared(g, spark, rows):
    three = some(spark, 0, 1, 2)
    assert rows(g.shared_successors(three)) == [(3, 3)]
    assert {r[0] for r in rows(g.shared_successors(three, 1, 3))} == {3, 4, 5, 6}
    assert rows(g.shared_successors(three, 2, 2)) == [(4, 2)]
    assert rows(g.shared_successors(some(spark, 1, 1), 2, 2)) == [(3, 2), (5, 2)]
    assert rows(g.shared_predecessors(some(spark, 3, 4))) == [(0, 2), (2, 2)]
    assert rows(g.successor_intersect(2, some(spark, 3, 5, 6))) == [(3,), (6,)]
    assert rows(g.predecessor_intersect(3, some(spark, 1, 6))) == [(1,)]


@pytest.mark.parametrize("lists", [[[0, 1]], [[0], [1]], [[1], [0], []], [[1, 1], [0, 0], [], [0], [0, 1]]])
def test_merge_count(spark, lists):
    flat = [(i, v) for i, x in enumerate(lists) for v in x]
    df = spark.createDataFrame(flat, "list_id int, value int")
    got = [tuple(r) for r in graph.merged_values(df, "value").collect()]
    assert [v for v, _ in got] == [0, 1] and sum(n for _, n in got) == len(flat)
    for skip in range(4):
        assert graph.merged_values(df, "value", skip).count() == max(0, 2 - skip)


def test_set_operations(spark, rows):
    a, b = some(spark, 1, 1, 2, 3), some(spark, 1, 3, 3)
    assert rows(graph.intersect(a, b)) == [(1,), (3,)]
    assert rows(graph.difference(a, b)) == [(1,), (2,)]


def test_subgraph_metrics(g, spark):
    m = g.subgraph_metrics(some(spark, 2, 3, 3, 5)).head().asDict()
    assert m == {
        "nodes": 3, "arcs": 2, "avgdegree": 2 / 3, "inlinks": 3, "outlinks": 2, "total_inlinks": 5, "total_outlinks": 4, "nodes_linked": 4, "nodes_linking": 4,
    }


def test_degrees(g, rows):
    assert rows(g.degrees())[0] == (0, 2, 0) and len(rows(g.degrees())) == 7
    assert rows(stats.degree_distribution(g.degrees(), "outdegree")) == [(0, 3), (1, 1), (2, 2), (3, 1)]
    top = stats.top_by_degree(stats.degree_table(g), "indegree", more_than=0, n=3).collect()
    assert [r["name"] for r in top] == ["de.c", "org.d", "org.f"]  # ties by the text of the row
    s = stats.graph_stats(g).head()
    assert (s["nodes"], s["arcs"], s["loops"], s["dangling"], s["maxindegree"]) == (7, 8, 0, 3, 3)


def test_explorer(g):
    x = Explorer(g)
    with pytest.raises(LookupError):
        x.pwn()
    assert x.cn("org.zzz") is None
    x.cn("community")
    assert x.pwn() == "#2\tcommunity" and x.vertex.outdegree() == 3
    assert [r["line"] for r in x.ls().orderBy("pos").collect()] == ["0: #3\tde.c", "1: #4\torg.d", "2: #6\torg.f"]
    assert x.sl("de.c").count() == 3 and listing(x.vertex.predecessors()).count() == 1


def test_load_and_save(g, spark, tmp_path, rows):
    g.save(str(tmp_path / "g"))
    again = graph.Graph.load(spark, str(tmp_path / "g"))
    assert rows(again.edges) == sorted(EDGES) and rows(again.transposed().successors(3)) == rows(g.predecessors(3))
    assert again.symmetric().edges.count() == 2 * len(EDGES)


CYCLES = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (4, 3), (5, 4), (6, 6), (7, 8), (8, 7), (8, 9)]


def test_components(spark):
    v = spark.createDataFrame([(i, f"n{i}") for i in range(11)], "id bigint, name string")
    e = spark.createDataFrame(CYCLES, "src bigint, dst bigint")
    weak = {r["id"]: r["comp"] for r in components.weak_components(v, e).collect()}
    assert weak == {**dict.fromkeys(range(6), 0), **dict.fromkeys((7, 8, 9), 1), 6: 2, 10: 3}
    strong = {r["id"]: r["comp"] for r in components.strong_components(v, e).collect()}
    groups = {}
    for i, c in strong.items():
        groups.setdefault(c, set()).add(i)
    assert groups == {0: {0, 1, 2}, 1: {3, 4}, 2: {7, 8}, 3: {5}, 4: {6}, 5: {9}, 6: {10}}
    dist = {r["size"]: (r["freq"], r["perc"]) for r in components.size_distribution(components.strong_components(v, e)).collect()}
    assert dist[1][0] == 4 and math.isclose(sum(p for _, p in dist.values()), 100)


def test_components_of_a_long_path(spark):
    e = spark.range(199).selectExpr("id AS src", "id + 1 AS dst")
    v = spark.range(200).selectExpr("id", "cast(id AS string) AS name")
    assert components.component_sizes(components.weak_components(v, e)).collect()[0]["size"] == 200


def test_harmonic(spark):
    v = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "id bigint, name string")
    e = spark.createDataFrame([(0, 1), (1, 2), (3, 2), (2, 2)], "src bigint, dst bigint")
    exact = {r["id"]: r["hc"] for r in rank.harmonic_exact(v, e).collect()}
    assert exact == {0: 0.0, 1: 1.0, 2: 2.5, 3: 0.0, 4: 0.0}
    near = {r["id"]: r["hc"] for r in rank.harmonic_sketched(v, e).collect()}
    assert all(abs(near[i] - exact[i]) < 0.1 for i in exact)


def test_pagerank(spark):
    v = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "id bigint, name string")
    pairs = [(0, 1), (1, 2), (2, 0), (2, 3)]
    got = {r["id"]: r["pr"] for r in rank.pagerank(v, spark.createDataFrame(pairs, "src bigint, dst bigint"), tolerance=1e-8).collect()}
    p, deg = [0.25] * 4, [1, 1, 2, 0]
    for _ in range(200):
        p = [0.15 / 4 + 0.85 * (sum(p[a] / deg[a] for a, b in pairs if b == i) + p[3] / 4) for i in range(4)]
    assert math.isclose(sum(got.values()), 1, abs_tol=1e-9) and all(abs(got[i] - p[i]) < 1e-6 for i in got)


def test_ranks(spark, rows):
    v = spark.createDataFrame([(0, "a", "x"), (1, "b", "y"), (2, "c", "z")], "id bigint, name string, more string")
    hc = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0)], "id bigint, hc double")
    pr = spark.createDataFrame([(0, 0.5), (1, 0.2), (2, 0.3)], "id bigint, pr double")
    assert rows(ranks.join_ranks(v, hc, pr)) == [(1, 2.0, 3, 0.2, "b", "y"), (2, 2.0, 2, 0.3, "c", "z"), (3, 1.0, 1, 0.5, "a", "x")]
    with pytest.raises(ValueError):
        ranks.join_ranks(v, hc.where("id < 2"), pr)
    with pytest.raises(ValueError):
        ranks.position(spark.createDataFrame([(0, float("nan"))], "id bigint, hc double"), "hc", "p")
    a = spark.createDataFrame([(1, 3.0, "n"), (2, 2.0, "n"), (3, 1.0, "m")], "harmonicc_pos bigint, harmonicc_val double, name string")
    b = spark.createDataFrame([(1, 3.0, "k"), (2, 2.0, "n")], "pr_pos bigint, pr_val double, name string")
    assert rows(ranks.rank_text(ranks.outer_join_ranks(a, b))) == [("---", "---", "1", "3.0", "k"), ("1", "3.0", "2", "2.0", "n"), ("3", "1.0", "---", "---", "m")]


def test_preference(spark, rows):
    v = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id bigint, name string")
    some_names = spark.createDataFrame([("c",), ("a",), ("c",), ("zz",)], "name string")
    out = preference.preference_vector(v, some_names)
    assert rows(out) == [(0, 0.5), (1, 0.0), (2, 0.5)]
    preference.check_stochastic(out)
    fixed = preference.preference_vector(v, some_names, value=3)
    assert rows(fixed)[0] == (0, 3.0)
    with pytest.raises(ValueError):
        preference.check_stochastic(fixed)
    with pytest.raises(ValueError):
        preference.preference_vector(v, some_names.where("name = 'zz'"))
