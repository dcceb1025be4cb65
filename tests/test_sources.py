"""Readers, sinks, vectors, links, workflow and stream."""

import gzip
import struct

import pytest

from linkframe.operators import components, graph
from linkframe.plans.crawls import LinkStore
from linkframe.plans.workflow import Stopped, Workflow, check_name, partition_counts, rank_graph
from linkframe.sources import hostlinks, text, vectors
from linkframe.streaming import links as stream


def test_text_tables(spark, tmp_path, rows):
    with gzip.open(tmp_path / "v.gz", "wt") as f:
        f.write('0\tcom.a\n1\tcom."b\nbroken\nx\ty\n')
    assert rows(text.read_vertices(spark, str(tmp_path / "v.gz"))) == [(0, "com.a"), (1, 'com."b')]
    assert text.malformed_lines(spark, str(tmp_path / "v.gz")).count() == 2
    (tmp_path / "k").write_text("0\ta\tmore\tfields\nbad\n")
    assert rows(text.read_keyed_lines(spark, str(tmp_path / "k"))) == [(0, "a\tmore\tfields")]
    e = spark.createDataFrame([(2, 1), (0, 1), (2, 1)], "src bigint, dst bigint")
    text.write_edges(e, str(tmp_path / "e"))
    assert rows(text.read_edges(spark, str(tmp_path / "e"), partitions=2)) == [(0, 1), (2, 1)]
    v = spark.createDataFrame([(1, "b", 3), (0, "a", 2)], "id bigint, name string, n_hosts bigint")
    text.write_vertices(v, str(tmp_path / "w"), gzip=False)
    assert rows(text.read_vertices(spark, str(tmp_path / "w"), counts=True)) == [(0, "a", 2), (1, "b", 3)]
    text.write_ranks(v.select("id", "name"), str(tmp_path / "r"), gzip=False)
    assert rows(spark.read.text(str(tmp_path / "r/header"))) == [("#id\t#name",)]


def test_lists(spark, tmp_path, rows):
    g = graph.Graph(spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, name string"), spark.createDataFrame([(0, 1)], "src bigint, dst bigint"))
    (tmp_path / "l").write_text("b\nzz\na\nb\n")
    got = text.load_vertices(g, str(tmp_path / "l")).collect()
    assert [r["id"] for r in got] == [1, 0, 1]
    text.write_names(g, spark.createDataFrame([(1,), (5,)], "id bigint"), str(tmp_path / "n"))
    assert rows(text.read_names(spark, str(tmp_path / "n"))) == [("b",)]
    text.write_counts(spark.createDataFrame([("k", 3)], "key string, cnt bigint"), str(tmp_path / "c"))
    assert rows(spark.read.text(str(tmp_path / "c"))) == [("3\tk",)]
    text.write_strings(spark.createDataFrame([("s",)], "value string"), str(tmp_path / "s"))
    d = spark.createDataFrame([(1, 2, 50.0)], "freq bigint, size bigint, perc double")
    assert rows(text.component_lines(d)) == [(1, 2, "50.000000%")]
    assert rows(text.stats_lines(d.select("freq", "size"))) == [("freq=1",), ("size=2",)]


@pytest.mark.parametrize("kind", ["float", "double", "int"])
def test_vectors(spark, tmp_path, kind):
    code = {"float": ">f", "double": ">d", "int": ">i"}[kind]
    values = [3, 0, -2, 7, 5]
    (tmp_path / "in").write_bytes(b"".join(struct.pack(code, v) for v in values))
    df = vectors.read_vector(spark, str(tmp_path / "in"), kind, "x")
    assert [r["x"] for r in df.orderBy("id").collect()] == values
    vectors.write_vector(df, str(tmp_path / "out"), kind, "x")
    assert (tmp_path / "out").read_bytes() == (tmp_path / "in").read_bytes()
    assert vectors.vector_text(df, "x").count() == 5


def test_host_links(spark, rows):
    html = '<a href="/x">1</a><A class=k HREF=\'https://B.org/\'>2</A><a href="mailto:q@z">3</a><a name=x>4</a>'
    pages = spark.createDataFrame([("http://www.a.com/p", html), ("nonsense", html), ("http://c.net", None)], "url string, html string")
    links = hostlinks.extract_links(pages)
    assert rows(links) == [("www.a.com", "b.org"), ("www.a.com", "www.a.com")]
    v, e = hostlinks.host_graph(links)
    assert rows(v) == [(0, "com.a.www"), (1, "org.b")] and rows(e) == [(0, 1)]
    with pytest.raises(ValueError):
        hostlinks.host_graph(links, known=v.where("id = 0"))
    robots = spark.createDataFrame([("http://a.com/robots.txt", "User-agent: *\nSitemap: https://s.org/m.xml\n")], "url string, text string")
    assert rows(hostlinks.sitemap_links(robots)) == [("a.com", "s.org")]
    moved = spark.createDataFrame([("http://a.com/", "//d.de/")], "url string, location string")
    assert rows(hostlinks.redirect_links(moved)) == [("a.com", "d.de")]
    odd = spark.createDataFrame([("A.com.", "b.org"), ("-x.com", "b.org"), ("1.2.3.4", "b.org")], "src_host string, dst_host string")
    assert rows(hostlinks.valid_links(odd, normalize=True)) == [("a.com", "b.org")]
    paths = hostlinks.union_inputs(*[spark.createDataFrame([(f"p{k}{i}",) for i in range(50)], "path string") for k in "ab"])
    dealt = hostlinks.input_batches(paths, most=30)
    assert rows(dealt.groupBy("batch").count()) == [(0, 30), (1, 30), (2, 30), (3, 10)] and dealt.select("path").distinct().count() == 100
    assert rows(dealt) == rows(hostlinks.input_batches(paths.repartition(7), most=30)) != rows(hostlinks.input_batches(paths, most=30, seed=2))


def test_workflow(spark, tmp_path):
    flow, calls = Workflow(spark, str(tmp_path / "w"), stop_file=str(tmp_path / "stop")), []

    def make():
        calls.append(1)
        return spark.range(3)

    assert flow.step("a", make).count() == flow.step("a", make).count() == 3 and len(calls) == 1
    flow.background("b", make)
    assert [d.count() for d in flow.wait()] == [3] and flow.status("a", "b", "c") == {"a": True, "b": True, "c": False}
    (tmp_path / "stop").write_text("")
    with pytest.raises(Stopped):
        flow.step("d", make)
    with pytest.raises(ValueError):
        Workflow(spark, "a b")
    with pytest.raises(ValueError):
        check_name("-x")
    assert partition_counts() == {"output": 32, "edges": 48, "vertices": 16}


def test_rank_graph(spark, tmp_path):
    g = graph.Graph(
        spark.createDataFrame([(i, f"n{i}") for i in range(4)], "id bigint, name string"),
        spark.createDataFrame([(0, 1), (1, 0), (1, 2)], "src bigint, dst bigint"),
    )
    out = rank_graph(Workflow(spark, str(tmp_path / "w")), g, exact_harmonic=True)
    assert out["ranks"].count() == 4 and out["stats"].head()["arcs"] == 3
    assert components.component_sizes(out["scc"]).count() == 3


def test_stream(spark, tmp_path, rows):
    pages = spark.createDataFrame([("http://a.com/", "<a href='http://b.org/'>x</a>")], "url string, html string")
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    for _ in range(2):
        pages.write.mode("append").parquet(src)
        stream.stream_links(spark, src, pages.schema, out, state).awaitTermination(120)
    assert rows(stream.read_stream_links(spark, out)) == [("a.com", "b.org")]
    assert LinkStore(spark, out).crawls() == ["batch-0", "batch-1"]
