"""Archives, vectors and pages: round trips, brute force and defined cases."""

import gzip
import io
import random

import numpy as np
import pytest

from linkframe.llm import arc_to_warc as aw
from linkframe.llm import html_content as hc
from linkframe.llm import topk_search
from linkframe.plans.lineage import Scratch

# --- archives -----------------------------------------------------------------------------

BIG = "<html>" + "x\r\n\r\n\n" * 300 + "é</html>"


def test_arc_round_trip():
    records = [("http://a.com/x", "1.2.3.4", "20050102030405", "text/html", 200, b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\nhttp://b.c 1.1.1.1 20000101000000 text/html 5\nxx"), ("dns:a.com", "1.1.1.1", "2005", "text/dns", 1, b"")]
    for version in (1, 2):
        data = aw.arc_image("f.arc", records, version)
        for image in (data, gzip.compress(data)):
            got = list(aw.parse_arc(image))
            assert [(r["url"], r["ip"], r["date"], r["mime"], r["block"]) for r in got] == [(*x[:4], x[5]) for x in records]
            assert all(data[r["offset"] :].startswith(r["url"].encode()) for r in got)
        cut = list(aw.parse_arc(data[:-20].rstrip(b"\n"))) if version == 1 else []
        assert all(isinstance(r["truncated"], bool) for r in cut)
    broken = aw.arc_image("f", records[:1]) + b"garbage line\n" + aw.arc_image("g", records[:1], 2)
    assert len(list(aw.parse_arc(broken))) == 2
    assert list(aw.parse_arc(b"")) == [] and list(aw.parse_arc(b"no newline")) == []
    assert list(aw.parse_arc(aw.arc_image("f", records[:1])[:-30]))[0]["truncated"]


def test_synthesised_fields():
    assert aw.warc_date("20050102030405") == "2005-01-02T03:04:05Z" and aw.warc_date("2005") == "2005-01-01T00:00:00Z"
    assert aw.warc_date("99999999999999") == aw.warc_date("") == "1970-01-01T00:00:00Z" or aw.warc_date("").startswith("0000") is False
    assert aw.safe_url("http://a/b c\n") == "http://a/b%20c%0A" and aw.safe_url(None) == "urn:x-unknown"
    assert aw.record_id("a", 1, "u") == aw.record_id("a", 1, "u") != aw.record_id("a", 2, "u")
    assert aw.http_parts(b"HTTP/1.0 200\n\nx") == (b"HTTP/1.0 200\n\n", b"x") and aw.http_parts(b"plain") == (b"", b"plain")


@pytest.mark.parametrize("way", ["records", "images"])
def test_pages_round_trip(spark, tmp_path, monkeypatch, way):
    html = [None, "", "small", "small", BIG, BIG, BIG, "y" * 1000, "y" * 1000, "z" * 999, "z" * 999, "WARC/1.1\r\n\r\n" * 200]
    pages = spark.createDataFrame([(i, f"http://h/{i} q" if i else None, t, "x") for i, t in enumerate(html)], "page_id bigint, url string, html string, payload string")
    scratch = Scratch(spark, "test")
    path = str(tmp_path / "warc")
    images = scratch.cut(aw.pages_to_arc(pages.repartition(3), image_bytes=2000), "images")
    if way == "records":
        aw.write_warc(aw.convert(aw.arc_records(images)), path)
    else:
        monkeypatch.setattr(aw, "BUCKET_BYTES", 500)
        aw.write_images(images, path, scratch)
    got = {r["seq"]: r for r in aw.read_warc(spark, path).collect()}
    import hashlib

    assert len(got) == len(html)
    for i, t in enumerate(html):
        data, r = (t or "").encode(), got[i]
        last = max(k for k, x in enumerate(html) if (x or "") == (t or ""))
        kind = "revisit" if len(data) >= 1000 and i != last else "response"
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(data), hashlib.sha1(data).hexdigest(), kind, last if kind == "revisit" else None)
        assert r["intact"] and r["warc_date"].endswith("Z")
    for f in (tmp_path / "warc").glob("part-*"):
        records = list(aw.parse_warc(io.BytesIO(gzip.decompress(f.read_bytes()))))
        assert records[0][0]["warc-type"] == "warcinfo"


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert aw.archive_pages(none).count() == 0
    same = spark.createDataFrame([(None, None, "q" * 2000), (3, "u", "q" * 2000), (3, "u", "q" * 2000)], "page_id bigint, url string, html string")
    got = sorted((r["seq"] is None, r["record_type"], r["refers_to"]) for r in aw.archive_pages(same).collect())
    assert got == [(False, "response", None), (False, "revisit", 3), (True, "revisit", 3)]


# --- exact search ---------------------------------------------------------------------------


def brute(vectors, k=5):
    x = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in vectors if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q, v in x.items():
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in x.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(4)]
    vectors = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(700)]
    vectors[100] = (100, [float("nan")] * 16)
    vectors[150] = (150, None)
    vectors[151] = (151, [1.0, None] * 8)
    vectors[152] = (152, [])
    for i in range(300, 420):
        vectors[i] = (i, centres[0])  # many equal vectors: ties
    for i in (200, 201, 202):
        vectors[i] = (i, [1.0, -2.0])
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id bigint, embedding array<double>, score string")
    got = topk_search.top_k(df, lambda i: i % 50 == 0, candidate_block=100, query_block=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors)
    assert topk_search.top_k(df.limit(0), lambda i: i % 50 == 0).count() == 0
    large = spark.createDataFrame([(0, [1e9]), (50, [1e9])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk_search.top_k(large, lambda i: i % 50 == 0).collect()


# --- pages ------------------------------------------------------------------------------------

P = "A sentence of some length that belongs to the article, with several clauses in it. " * 3


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (None, ""),
        ("", ""),
        ("<!-- only --><script>var a='<p>x</p>'</script>", ""),
        (f"<nav><a href=/>Home</a></nav><article><h1>T &amp; U</h1><p><b>{P}<br><p>short</p><p>a\n  b&nbsp;c</article><footer>&copy; x</footer>", f"T & U\n\n{P.strip()}\n\nshort\n\na b c"),
        (f"<header>Site</header><main><p>{P}</p></main><aside>{P}</aside>", P.strip()),
        (f"<div class=site-header>Name</div><article><div class=entry-header><h1>Head</h1></div><p>{P}</p></article>", f"Head\n\n{P.strip()}"),
        (f"<article><header><h1>Head</h1></header><p>{P}</p><div class='ad-box ads'>{P}</div><form><p>{P}</p></form><section class=comments><p>{P}</p></section></article>", f"Head\n\n{P.strip()}"),
        (f"<body><ul class=menu><li><a>x</a><li><a>y</a></ul><h1>Head</h1><p>{P}</p><p>{P}</p><div id=cookie-notice>{P}</div><div>a<i>b</i><u>c</u></div></body>", f"Head\n\n{P.strip()}\n\n{P.strip()}"),
        (f"<article><p>{P}</p></article><article><p>{P}</p><p role=alert>no</p></article>", f"{P.strip()}\n\n{P.strip()}"),
        (f"<article><p>{P}</p></div></span></article></article>tail", P.strip()),
        ("plain text only", "plain text only"),
    ],
)
def test_main_text(html, expected):
    assert hc.main_text(html) == expected


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", f"<article><p>{P * 3000}</p></article>"), (2, None, None), (2, None, None)], "page_id bigint, text string, html string")
    got = sorted((r["page_id"], len(r["text"]), r["n_chars"]) for r in hc.extract(pages).collect())
    n = len((P * 3000).strip())
    assert got == [(1, n, n), (2, 0, 0), (2, 0, 0)] and hc.extract(pages.limit(0)).count() == 0


def test_smoothing_and_threshold():
    x = np.array([1.0, 1, 1, 50, 60, 2, 55, 1, 1])
    s = hc.smoothed(x, 1.0)
    assert len(s) == len(x) and 1 < hc.threshold(s) < 55 and s[4] > s[0]
    assert hc.threshold(np.array([])) == 0 and hc.threshold(np.ones(4)) == 0


def test_set_of_windows_takes_little():
    """Its size as built and as sent stays under eight bytes a byte of text, items of the same words included."""
    import pickle
    import random

    from linkframe.llm import decontamination as dc

    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    items = [(f"item-{i}", " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60))).encode()) for i in range(12_000)]
    items += [(f"copy-{i}", t) for i, (_, t) in enumerate(items[:500])]
    size, tests = sum(len(t) for _, t in items), dc.TestSet(items, 10)
    assert size > 2_000_000 and tests.nbytes < 8 * size and len(pickle.dumps(tests)) < 8 * size
    for i in (0, 7, 499):
        w = dc.words_of(items[i][1])
        k = min(10, len(w))
        h = dc.window_hashes(dc.word_hashes(w), k)[-1]
        assert tests.items_of(k, h, b" ".join(w[-k:])) == {f"item-{i}", f"copy-{i}"}
        assert tests.items_of(k, h, b" ".join([*w[-k:-1], w[-1] + b"x"])) is None and tests.items_of(k, h, b" ".join(w[-k:])[:-1]) is None


def test_no_payload_is_shuffled(spark):
    """Images stay in their buckets while what they refer to is joined."""
    from pyspark.sql import functions as F

    scratch = Scratch(spark, "test")
    images = scratch.cut(aw.pages_to_arc(spark.range(200).selectExpr("id AS page_id", "'u' AS url", "repeat('x', 2000 + id % 3) AS html"), image_bytes=20_000), "images")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    table = scratch.bucketed(images, "archive", scratch.buckets(1, 1), deal=False)
    of = aw.revisits(aw.record_keys(spark.table(table))).groupBy("archive").agg(F.collect_list("offset").alias("targets"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table(table).join(of, "archive", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    left = plan[plan.index("Join") :].split(":- ", 1)[1].split("+- Sort", 2)[0]
    assert "Exchange" not in left.split("+- *", 1)[0] and "Bucketed: true" in plan
    scratch.drop_table(table)
