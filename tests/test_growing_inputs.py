"""Tasks hold no more when tables grow: partitions follow the rows, and nothing is computed, shuffled or written twice."""

import gzip
import os
import re

import pytest

from linkframe import catalog
from linkframe.operators import fold, rank
from linkframe.operators import graph as g
from linkframe.plans.lineage import Scratch, partitions
from linkframe.sources import text

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def seven(monkeypatch):
    for module in (catalog, fold, g):
        monkeypatch.setattr(module, "partitions", lambda *_: 7)


def some(spark):
    v = spark.createDataFrame([(i, f"com.d{i // 3}.h{i}") for i in range(30)], "id bigint, name string")
    return g.Graph(v, spark.createDataFrame([(i, i * 7 % 30) for i in range(30)] * 2, "src bigint, dst bigint"))


def test_partitions(spark):
    assert [partitions(spark, n, 10) for n in (0, 40, 41, 1000)] == [4, 4, 5, 100]


@pytest.mark.parametrize("name", ["plain", "small.gz"])
def test_lines_are_streamed(spark, tmp_path, name):
    lines, path = [f"{i} \r x{i}" for i in range(5000)], str(tmp_path / name)
    halves = ["".join(x + "\n" for x in lines[a:b]).encode() for a, b in ((0, 2000), (2000, 5000))]
    with open(path, "wb") as f:
        f.write(b"".join(map(gzip.compress, halves) if name.endswith("gz") else halves))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9999")
    try:
        found = catalog._numbered(spark, path)
        assert "Generate" not in plan(found)  # no row holds the file
        assert [tuple(r) for r in found.orderBy("pos").collect()] == list(enumerate(lines))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_edges_of_lines(spark, seven):
    assert catalog.graph_p(spark, SF).edges.rdd.getNumPartitions() == 7
    assert catalog.graph_s(spark, SF).edges.rdd.getNumPartitions() == 7


def test_symmetric(spark, rows, seven):
    e = some(spark)
    both = e.symmetric().edges
    assert both.rdd.getNumPartitions() == 7
    assert rows(both) == rows(e.edges.union(e.transposed().edges).distinct())


def test_folded_edges(spark, seven):
    e = some(spark)
    assert fold.fold(e.vertices, e.edges)[1].rdd.getNumPartitions() == 7


def test_edges_in_ranges(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(text, "RANGE_ROWS", 10)
    e = some(spark).edges
    text.write_edges(e, str(tmp_path / "e"), gzip=False)
    parts = sorted(x for x in os.listdir(tmp_path / "e") if x.startswith("part-"))
    assert len(parts) > 4
    found = [tuple(map(int, x.split("\t"))) for p in parts for x in (tmp_path / "e" / p).read_text().splitlines()]
    assert found == sorted(rows(e.distinct()))


def test_found_pairs_are_not_shuffled_again(spark, monkeypatch):
    seen, add_rows = [], Scratch.add_rows
    monkeypatch.setattr(Scratch, "add_rows", lambda self, name, df, *a: (seen.append(plan(df)), add_rows(self, name, df, *a))[1])
    v = spark.range(40)
    rank.harmonic_exact(v, v.selectExpr("id AS src", "(id + 1) % 40 AS dst").where("src % 8 <> 7")).collect()
    assert len(seen) == 8
    assert not any(re.search(r"hashpartitioning\(x[^)]*\), ENSURE", x) for x in seen)


def test_edges_once(spark, monkeypatch):
    """Ranks take the degrees once, and commands that read no edges don't have them written."""
    calls, degrees = [], g.Graph.degrees
    monkeypatch.setattr(g.Graph, "degrees", lambda self: (calls.append(1), degrees(self))[1])
    catalog.Q["j5_outer_join_ranks"](spark, SF)
    assert len(calls) == 1
    monkeypatch.setattr(text, "write_edges", None)
    assert catalog.Q["r6_ranks_command"](spark, SF).count() == catalog.Q["r7_preference_command"](spark, SF).count() == 200
    assert len(calls) == 2
