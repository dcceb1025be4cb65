"""Folding: host arrays and the domains they fold to."""

import pytest
from pyspark.sql import functions as F

from linkframe.functions import names, suffixes
from linkframe.operators import fold
from linkframe.operators.enumerate import number, out_of_order, reuse_vertices, vertices

HYPHENS = [
    "ac.e-bike", "ac.e-bikes", "ac.e-com", "ac.e.subdomain", "ac.eagle", "ac.gov", "ac.gov.ascension", "ac.gov.ascension-island",
    "ac.gov.ascension.mail", "ac.gov.conservation-ascension-island", "ac.gov.postoffice",
]
HYPHEN_DOMAINS = [
    ("ac.e", 1), ("ac.e-bike", 1), ("ac.e-bikes", 1), ("ac.e-com", 1), ("ac.eagle", 1), ("ac.gov.ascension", 2), ("ac.gov.ascension-island", 1),
    ("ac.gov.conservation-ascension-island", 1), ("ac.gov.postoffice", 1),
]
HORDALAND = ["no.hordaland", "no.hordaland-teater", "no.hordaland.os", "no.hordaland.os.bibliotek", "no.hordaland.oygarden", "no.hordalandfolkemusikklag"]
HEDMARK = ["no.hedland", "no.hedmark-folkemusikklag", "no.hedmark-trafikk", "no.hedmark.m", "no.hedmark.os.www", "no.hedmark.www", "no.hedmarktrafikk"]
HIRO = [
    "name.hiro", "name.hiropo", "name.his.forgot.adam", "name.his.forgot.ben", "name.his.forgot.never", "name.his.prz", "name.hista.tac",
    "name.history", "name.history.0.aba", "name.hit",
]
CASES = {
    "simple": (["com.example", "com.example.www,", "com.example.xyz,", "org.example"], {}, [("com.example", 3), ("org.example", 1)]),
    "hyphens": (HYPHENS, {}, HYPHEN_DOMAINS),
    "multipart": (HYPHENS, {"multipart_suffixes": True}, sorted([*HYPHEN_DOMAINS, ("ac.gov", 1)])),
    "split blocks": (HORDALAND, {}, [("no.hordaland", 2), ("no.hordaland-teater", 1), ("no.hordaland.os.bibliotek", 1), ("no.hordalandfolkemusikklag", 1)]),
    "sorted": (
        HEDMARK,
        {},
        [("no.hedland", 1), ("no.hedmark", 2), ("no.hedmark-folkemusikklag", 1), ("no.hedmark-trafikk", 1), ("no.hedmark.os.www", 1), ("no.hedmarktrafikk", 1)],
    ),
    "private": (
        HIRO,
        {"level": "private-domain", "multipart_suffixes": True},
        [
            ("name.hiro", 1), ("name.hiropo", 1), ("name.his", 1), ("name.his.forgot.adam", 1), ("name.his.forgot.ben", 1), ("name.his.forgot.never", 1),
            ("name.hista", 1), ("name.history", 2), ("name.hit", 1),
        ],
    ),
    "no www": (
        ["name.hiro", "name.hiro.adam", "name.hiro.www", "name.his.forgot.ben.www", "name.his.forgot.never", "name.his.prz.www", "name.his.www", "name.hit.www"],
        {"level": "host-without-www", "multipart_suffixes": True},
        [("name.hiro", 2), ("name.hiro.adam", 1), ("name.his", 1), ("name.his.forgot.ben", 1), ("name.his.forgot.never", 1), ("name.his.prz", 1), ("name.hit", 1)],
    ),
    "www.com": (["com.www"], {"level": "host-without-www"}, [("com.www", 1)]),
}


def host_table(spark, hosts):
    return spark.createDataFrame(list(enumerate(hosts)), "id bigint, name string")


@pytest.mark.parametrize("case", CASES)
def test_golden(spark, case):
    hosts, options, expected = CASES[case]
    domains, mapping = fold.fold_vertices(host_table(spark, hosts), **options)
    got = [tuple(r) for r in domains.orderBy("id").collect()]
    assert got == [(i, *x) for i, x in enumerate(sorted(expected))]
    assert out_of_order(domains).count() == 0
    assert mapping.count() == sum(n for _, n in expected)


def test_edges(spark, rows):
    hosts = host_table(spark, ["com.a", "com.a.x", "com.b", "no.hordaland.os", "org.c"])
    edges = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (2, 3), (3, 4), (4, 0), (4, 99)], "src bigint, dst bigint")
    domains, folded = fold.fold(hosts, edges)
    assert rows(domains) == [(0, "com.a", 2), (1, "com.b", 1), (2, "org.c", 1)]
    assert rows(folded) == [(0, 1), (2, 0)]  # no loop, no edge of a suffix or of an unknown host, no repeat


def test_levels_and_strict_suffixes(spark, rows):
    hosts = host_table(spark, ["ac.gov", "com", "zz.unknown-tld"])
    with pytest.raises(ValueError):
        fold.host_domains(hosts, "nonsense")
    assert rows(fold.host_domains(hosts, multipart_suffixes=True).select("name", "domain")) == [(n, n) for n in ("ac.gov", "com", "zz.unknown-tld")]
    strict = fold.host_domains(hosts, multipart_suffixes=True, strict_suffix_only=True)
    assert strict.where("domain IS NULL").select("name").head()[0] == "com"


def test_suffix_rules(spark):
    text = "// c\ncom\n*.ck\n!www.ck\nco.uk\nuk\n// ===BEGIN PRIVATE DOMAINS===\nblog.com\n"
    df = spark.createDataFrame([(x,) for x in ("ck", "ck.a", "ck.a.b", "ck.www", "ck.www.x", "uk.co", "uk.co.a.b", "uk.a", "com.blog.me", "zz.a")], "n string")
    icann = {r["n"]: r["domain"] for r in suffixes.registered_domain(df, "n", text=text).collect()}
    assert icann == {
        "ck": None, "ck.a": None, "ck.a.b": "ck.a.b", "ck.www": "ck.www", "ck.www.x": "ck.www", "uk.co": None, "uk.co.a.b": "uk.co.a", "uk.a": "uk.a",
        "com.blog.me": "com.blog", "zz.a": None,
    }
    private = {r["n"]: r["domain"] for r in suffixes.registered_domain(df, "n", private=True, text=text).collect()}
    assert private["com.blog.me"] == "com.blog.me"
    assert suffixes.is_public_suffix(df, "n", text=text).where("is_suffix").count() == 2


def test_names(spark):
    df = spark.createDataFrame([("a.b.",), ("a..b",), (".a",), ("www.com",), ("www.a.com",), (None,)], "h string")
    got = df.select(names.reverse_host(F.col("h")), names.strip_www(F.col("h")), names.top_level_domain(F.col("h"))).collect()
    assert [r[0] for r in got] == ["b.a", "b..a", "a.", "com.www", "com.a.www", None]
    assert [r[1] for r in got][3:] == ["www.com", "a.com", None]
    links = spark.createDataFrame([("/x",), ("//B.org/y",), ("HTTPS://c.net:8/z",), ("mailto:a@b",), ("x.html",)], "l string")
    assert [r[0] for r in links.select(names.link_host(F.col("l"), F.lit("a.com"))).collect()] == ["a.com", "b.org", "c.net", None, "a.com"]


def test_number_by_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("t"))
    by_range = {r["k"]: r["n"] for r in number(df, [F.desc("t"), "k"], "n", first=1, small=90).collect()}
    by_window = {r["k"]: r["n"] for r in number(df, [F.desc("t"), "k"], "n", first=1).collect()}
    assert by_range == by_window and sorted(by_range.values()) == list(range(1, 1001))


def test_vertices(spark, rows):
    v = vertices(spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a-",), ("a.",)], "name string"))
    assert rows(v) == [(0, "a"), (1, "a-"), (2, "a."), (3, "b")]
    known, unknown = reuse_vertices(spark.createDataFrame([("a",), ("z",)], "name string"), v)
    assert rows(known) == [(0, "a")] and rows(unknown) == [("z",)]
    assert out_of_order(spark.createDataFrame([(0, "b"), (1, "a")], "id bigint, name string")).count() == 1
