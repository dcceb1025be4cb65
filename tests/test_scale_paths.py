"""Plans, files and states that the queries alone don't show."""

import gzip
import math
import random

import numpy as np
import pytest

from linkframe.__main__ import main
from linkframe.operators import components, fold, graph, rank, stats
from linkframe.operators import enumerate as enumeration
from linkframe.plans.crawls import LinkStore
from linkframe.plans.lineage import Scratch
from linkframe.plans.report import Report
from linkframe.sources import hostlinks, text, vectors


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- vectors ---------------------------------------------------------------------------------


def test_vector_ranges_and_offsets(spark, tmp_path):
    values = np.random.default_rng(1).normal(size=10_007)
    (tmp_path / "v").write_bytes(values.astype(">f8").tobytes())
    df = vectors.read_vector(spark, str(tmp_path / "v"), "double", "x", range_bytes=8 * 999)
    assert df.rdd.getNumPartitions() == 11
    back = df.orderBy("id").toPandas()
    assert list(back["id"]) == list(range(10_007)) and np.array_equal(back["x"], values)
    # In any order and partitioning, with ids missing and values at the end.
    some = df.where("id % 3 <> 1").repartition(5, "x")
    vectors.write_vector(some, f"file://{tmp_path}/out", "double", "x", size=10_010)
    got = np.fromfile(tmp_path / "out", ">f8")
    want = np.append(np.where(np.arange(10_007) % 3 == 1, 0, values), [0, 0, 0])
    assert np.array_equal(got, want) and not list(tmp_path.glob("*.part"))


def test_vector_errors(spark, tmp_path):
    (tmp_path / "v").write_bytes(b"12345")
    with pytest.raises(Exception, match="no float values"):
        vectors.read_vector(spark, str(tmp_path / "v"), "float", "x").count()
    with pytest.raises(Exception, match="random access"):
        vectors.write_vector(spark.range(1).selectExpr("id", "1.0 AS x"), "s3://b/k", "float", "x")
    nulls = spark.createDataFrame([(0, None)], "id long, x double")
    with pytest.raises(Exception, match="null"):
        vectors.write_vector(nulls, str(tmp_path / "n"), "double", "x")
    assert not (tmp_path / "n").exists()
    vectors.write_vector(nulls.where("id > 0"), str(tmp_path / "e"), "int", "x")
    assert vectors.read_vector(spark, str(tmp_path / "e"), "int", "x").count() == 0


# --- components ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed,n,m", [(1, 60, 110), (2, 12, 60)])
def test_strong_components_against_reach(spark, seed, n, m):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n - 8, n - 1)] + [(n - 1, n - 8)]
    reach = []
    for v in range(n):
        seen, todo = {v}, [v]
        while todo:
            x = todo.pop()
            new = {b for a, b in edges if a == x} - seen
            seen |= new
            todo += new
        reach.append(seen)
    want = {frozenset(y for y in reach[x] if x in reach[y]) for x in range(n)}
    groups = {}
    for r in components.strong_components(spark.range(n), spark.createDataFrame(edges, "src long, dst long")).collect():
        groups.setdefault(r["comp"], set()).add(r["id"])
    assert set(map(frozenset, groups.values())) == want


def test_long_ring_settles_early(spark):
    n, steps = 10_000, []
    ring = spark.range(n).selectExpr("id AS src", f"(id + 1) % {n} AS dst")
    found = components.strong_components(spark.range(n), ring, report=steps)
    assert [r["size"] for r in components.component_sizes(found).collect()] == [n]
    assert len(steps) < 60


# --- ranks -----------------------------------------------------------------------------------


def test_pagerank_shuffles_no_edges(spark):
    scratch = Scratch(spark, "t")
    links = spark.range(1000).selectExpr("id AS src", "id * 7 % 1000 AS dst", "1L AS deg")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    table = scratch.bucketed(links, "src", scratch.buckets(1000, 1000))
    ranks = scratch.cut(spark.range(1000).selectExpr("id", "0.001D AS x"), "ranks")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text_ = plan(rank.inflow(spark.table(table), ranks))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    below_join = text_[text_.index("Join") :]
    scan = next(x for x in below_join.splitlines() if "deg#" in x and "FileScan" in x)
    assert "Bucketed: true" in scan
    assert below_join.count("Exchange") == 1 and "Exchange hashpartitioning(src" in below_join  # the ranks
    scratch.drop_table(table)


def sparse(n, seed):
    rnd = random.Random(seed)
    return sorted({(i, rnd.randrange(max(0, i - 9), min(n, i + 9))) for i in range(n) for _ in range(2)} - {(i, i) for i in range(n)})


def test_pagerank_blocks(spark):
    n = 120
    edges = [(a, b) for a, b in sparse(n, 4) if a % 11]  # some without out-edges
    v, e = spark.range(n), spark.createDataFrame(edges, "src long, dst long")
    pref = [(i, 0.25) for i in (3, 40, 77, 110)]
    out, deg = [[] for _ in range(n)], [0] * n
    for a, b in edges:
        out[a].append(b)
        deg[a] += 1
    want, power = dict(pref), 0
    want = [want.get(i, 0.0) for i in range(n)]
    start = list(want)
    while True:
        lost, new = sum(p for p, k in zip(want, deg, strict=True) if not k), [0.0] * n
        for a in range(n):
            for b in out[a]:
                new[b] += want[a] / deg[a]
        new = [0.85 * (x + lost * s) + 0.15 * s for x, s in zip(new, start, strict=True)]
        power += 1
        if sum(abs(x - y) for x, y in zip(new, want, strict=True)) <= 1e-7:
            break
        want = new
    rounds = []
    got = rank.pagerank(v, e, tolerance=1e-7, preference=spark.createDataFrame(pref, "id long, pref double"), blocks=4, report=rounds)
    got = {r["id"]: r["pr"] for r in got.collect()}
    assert all(abs(got[i] - new[i]) < 1e-6 for i in range(n)) and math.isclose(sum(got.values()), 1, abs_tol=1e-12)
    assert len(rounds) < power
    with pytest.raises(RuntimeError):
        rank.pagerank(v, e, tolerance=1e-12, most_iterations=2)


def test_systolic_rounds(spark):
    n, fronts = 20, []
    e = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(n, 0), (n + 1, 0)], "src long, dst long")
    got = {r["id"]: r["hc"] for r in rank.harmonic_sketched(spark.range(n + 2), e, report=fronts).collect()}
    exact = {r["id"]: r["hc"] for r in rank.harmonic_exact(spark.range(n + 2), e).collect()}
    assert all(abs(got[i] - exact[i]) <= 3 * 1.04 / 64 * max(1, exact[i]) for i in exact)
    assert fronts == sorted(fronts, reverse=True) and fronts[-1] == 0 and fronts[10] < n
    with pytest.raises(RuntimeError):
        rank.harmonic_exact(spark.range(n), e, most_levels=5)


# --- graph queries ---------------------------------------------------------------------------


def names_graph(spark, tmp_path):
    names = sorted(["com", "com-x.y", *(f"com.d{i:03d}" for i in range(200)), *(f"de.d{i:03d}.h" for i in range(90)), "org", "x"])
    v = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    e = [(a, (a * 31 + k * 17) % len(names)) for a in range(len(names)) for k in range(40)]
    graph.Graph(v, spark.createDataFrame(sorted(set(e)), "src long, dst long")).save(str(tmp_path / "g"))
    return names, set(e), graph.Graph.load(spark, str(tmp_path / "g"))


def test_intervals(spark, tmp_path, rows):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    names, edges, g = names_graph(spark, tmp_path)
    first, last, whole = g.interval("com.")
    assert whole and [names[first], names[last]] == ["com.d000", "com.d199"] and g.interval("none") == (0, -1, True)
    found = g.successors("de.d005.h", prefix="com.")
    v = names.index("de.d005.h")
    assert rows(found) == sorted(((b, names[b]) for a, b in edges if a == v and names[b].startswith("com.")), key=repr)
    text_ = plan(g.successors("de.d005.h", prefix="com."))
    scan = next(x for x in text_.splitlines() if "FileScan" in x and "src#" in x)
    assert f"EqualTo(src,{v})" in scan and f"GreaterThanOrEqual(dst,{first})" in scan and f"LessThanOrEqual(dst,{last})" in scan
    scan = next(x for x in text_.splitlines() if "FileScan" in x and "name#" in x)
    assert f"GreaterThanOrEqual(id,{first})" in scan
    counts = g.successor_tld_counts("de.d005.h")
    assert "name#" not in plan(counts)
    want = {}
    for a, b in edges:
        if a == v:
            t = names[b].split(".")[0]
            want[t] = want.get(t, 0) + 1
    assert {r["key"]: r["cnt"] for r in counts.collect()} == want
    assert g.successors("no such name").count() == 0 and g.has_arc("com", names[31]) == ((names.index("com"), 31) in edges)


def test_ids_out_of_name_order(spark, rows):
    v = spark.createDataFrame([(i, f"{t}.n{i}") for i, t in enumerate(["b", "a", "b", "a", "c"])], "id long, name string")
    g = graph.Graph(v, spark.createDataFrame([(0, i) for i in range(5)], "src long, dst long"))
    assert rows(g.successors(0, prefix="b.")) == [(0, "b.n0"), (2, "b.n2")]
    assert rows(g.successor_tld_counts(0)) == [("a", 2), ("b", 2), ("c", 1)]


def test_out_of_order(spark, rows):
    good = [(i, f"n{i:04d}") for i in range(500)]
    bad = [(i, "n0100" if i in (200, 201) else n) for i, n in good]
    found = enumeration.out_of_order(spark.createDataFrame(bad, "id long, name string").repartition(3), small=37)
    assert rows(found) == [(200, "n0100", "n0199"), (201, "n0100", "n0100")]
    assert enumeration.out_of_order(spark.createDataFrame(good, "id long, name string"), small=37).count() == 0
    assert rows(enumeration.page(spark.range(50), ["id"], 3, 10)) == [(10,), (11,), (12,)]


# --- files and reports -------------------------------------------------------------------------


def test_one_file(spark, tmp_path, capsys):
    df = spark.range(1000).selectExpr("999 - id AS id", "concat('n', id) AS name")
    for zipped in (True, False):
        path = str(tmp_path / f"one-{zipped}")
        text.write_ranks(df.repartition(7), path, gzip=zipped, one=True)
        data = (gzip.open if zipped else open)(path, "rb").read().decode()
        assert data == "#id\t#name\n" + "".join(f"{i}\tn{999 - i}\n" for i in range(1000))
    text.write_edges(spark.createDataFrame([(2, 1), (0, 5), (2, 1)], "src long, dst long"), str(tmp_path / "e"), gzip=False, one=True)
    assert (tmp_path / "e").read_text() == "0\t5\n2\t1\n"
    text.write_ranks(df.where("id < 2"), "-", one=True)
    assert capsys.readouterr().out == "#id\t#name\n0\tn999\n1\tn998\n"


def test_report_of_a_fold(spark, tmp_path, capsys):
    (tmp_path / "v").write_text("0\tcom.a\n1\tcom.a.x\n2\torg.b\n3\tcom\nbroken\n")
    (tmp_path / "e").write_text("0\t1\n1\t2\n3\t2\n0\t2\nx\t1\n")
    out = [str(tmp_path / x) for x in ("dv", "de")]
    assert main(["fold", "--one-file", "--report", str(tmp_path / "v"), str(tmp_path / "e"), *out], spark) == 0
    lines = dict(x.split("=", 1) for x in capsys.readouterr().err.splitlines() if "=" in x)
    want = {"vertices.lines": 5, "vertices.malformed": 1, "edges.lines": 5, "edges.malformed": 1, "hosts.read": 4, "hosts.without_domain": 1}
    want |= {"host_edges.read": 4, "mapped.edges": 3, "mapped.loops": 1, "out_edges.written": 1, "out_vertices.written": 2}
    assert {k: int(lines[k]) for k in want} == want and lines["level"] == "registered-domain"
    with gzip.open(tmp_path / "de", "rt") as f:
        assert f.read() == "0\t1\n"


def test_report_of_ranks(spark):
    from linkframe.operators import ranks

    report = Report(kind="test")
    v = spark.createDataFrame([(0, "a"), (1, "b")], "id long, name string")
    found = ranks.join_ranks(v, v.selectExpr("id", "1.0F AS hc"), v.selectExpr("id", "0.5D AS pr"), report=report)
    found.collect()
    assert report.figures() == {"harmonic.read": 2, "pagerank.read": 2, "vertices.read": 2} and report.lines()[0] == "kind=test"
    report = Report()
    a, b = fold.fold(v, spark.createDataFrame([(0, 1)], "src long, dst long"), "host-without-www", report=report)
    a.collect(), b.collect()
    assert report.figures()["mapped.edges"] == 1 and report.settings == {"level": "host-without-www"}


def test_degree_outputs(spark, tmp_path):
    v = spark.createDataFrame([(i, f"n{i}") for i in range(6)], "id long, name string")
    edges = [(0, i) for i in range(1, 6)] + [(1, 2), (3, 2)]
    g = graph.Graph(v, spark.createDataFrame(edges, "src long, dst long"))
    assert plan(g.degrees()).count("Scan ExistingRDD[src") == 1
    stats.degree_outputs(g, str(tmp_path), more_than=1, n=5, gzip=False)
    read = lambda n: [r[0] for r in spark.read.text(str(tmp_path / n / "rows")).collect()]
    assert sorted(read("outdegree-indegree")) == ["0\t1\tn4", "0\t1\tn5", "0\t3\tn2", "1\t1\tn1", "1\t1\tn3", "5\t0\tn0"]
    assert read("top-outdegree") == ["5\t0\tn0"] and read("top-indegree") == ["0\t3\tn2"]
    assert read("outdegree-distribution") == ["0\t3", "1\t2", "5\t1"] and read("indegree-distribution") == ["0\t1", "1\t4", "3\t1"]


# --- links -------------------------------------------------------------------------------------


def test_known_tlds_and_ascii(spark, rows):
    hosts = ["Bücher.DE.", "bücher.de", "a.xn--p1ai", "a.рф", "a.nosuchtld", "10.0.0.1", "ok.org", "a..b.com", "ü" * 70 + ".de", None]
    links = spark.createDataFrame([(h, "x.com") for h in hosts], "src_host string, dst_host string")
    got = hostlinks.valid_links(links, normalize=True, known_tlds=True)
    assert rows(got) == sorted([("xn--bcher-kva.de", "x.com")] * 2 + [("a.xn--p1ai", "x.com")] * 2 + [("ok.org", "x.com")])
    assert hostlinks.valid_links(links.where("src_host = 'a.nosuchtld'")).count() == 1


def test_crawls(spark, tmp_path, rows):
    link = lambda ks: spark.createDataFrame([(f"h{k}.a", f"h{k * 7}.b") for k in ks], "src_host string, dst_host string")
    store = LinkStore(spark, f"file://{tmp_path}/links", buckets=8)
    assert store.links().count() == 0 and store.tidy() == 0
    assert len(store.add("one", link([*range(40), 3, 3]))) == 8
    assert store.add("one", link(range(100))) == []  # a rerun changes nothing
    before = store.manifest()
    assert store.add("two", link([40, 1, 2])) == [next(b for b in range(8) if store.manifest()["folders"][str(b)] != before["folders"][str(b)])]
    assert sum(store.manifest()["folders"][k] != f for k, f in before["folders"].items()) == 1
    store.prepare("three", link(range(30, 60)))  # interrupted before its commit
    again = LinkStore(spark, f"file://{tmp_path}/links")
    assert again.crawls() == ["one", "two"] and again.links().count() == 41
    assert again.add("three", link(range(30, 60))) and rows(again.links()) == rows(link(range(60)))
    assert again.add("four", link(range(5))) == [] and again.crawls()[-1] == "four"
    assert again.tidy() > 0 and rows(again.links()) == rows(link(range(60)))


def test_input_jobs(spark, tmp_path):
    paths = spark.range(1000).selectExpr("concat('s3://b/', id) AS path")
    hostlinks.write_input_jobs(paths, str(tmp_path / "jobs"), most=300)
    sizes = [r["count"] for r in hostlinks.read_input_jobs(spark, str(tmp_path / "jobs")).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [300, 300, 300, 100]
    first = [r[0] for r in spark.read.text(str(tmp_path / "jobs/batch=0")).collect()]
    assert len(set(first)) == 300 and first != sorted(first)


def test_preference_cli(spark, tmp_path, capfdbinary):
    (tmp_path / "v").write_text("0\tcom.a\n1\tcom.b\n2\torg.b\n")
    (tmp_path / "n").write_text("org.b\ncom.a\n")
    args = [str(tmp_path / x) for x in ("v", "n", "p")]
    assert main(["preference", "--binary", *args], spark) == 0
    assert list(np.fromfile(tmp_path / "p", ">f8")) == [0.5, 0, 0.5]
    assert main(["preference", *args[:2], "-"], spark) == 0
    assert list(np.frombuffer(capfdbinary.readouterr().out, ">f8")) == [0.5, 0, 0.5]
    args[2] += "2"
    assert main(["preference", "--value", "0.4", *args], spark) == 2 and not (tmp_path / "p2").exists()
    assert main(["preference", "--value", "0.5", *args], spark) == 0 and spark.read.parquet(args[2]).count() == 3
