"""Winnowing against a literal reading of it."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from linkframe.llm import fingerprint as fp


def literal(text, k=16, w=32):
    """[(pos, hash)] of a text, window by window."""
    data = (text or "").encode()
    if data and len(data) < k:
        data = data.ljust(k, b"\0")
    grams = [data[i : i + k] for i in range(len(data) - k + 1)]
    hashed = [zlib.crc32(g) for g in grams]
    out = set()
    for i in range(max(1, len(grams) - w + 1) if grams else 0):
        span = range(i, min(i + w, len(grams)))
        out.add(min(span, key=lambda j: (hashed[j], -j)))
    return [(p, int(hashlib.md5(grams[p]).hexdigest()[:15], 16)) for p in sorted(out)]


def texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé ß\n𝄞") for _ in range(rnd.randint(1, 9)))
    some = [" ".join(word() for _ in range(n)) for n in (1, 3, 6, 8, 20, 90, 300)]
    edge = ["x" * n for n in (1, 15, 16, 17, 46, 47, 48, 511, 512, 513, 558, 559, 1024 + 46, 1600)]
    return [None, "", "a", *some, *edge, "ab" * 700, "long text " * 5000]


def test_against_windows(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, w in ((16, 32), (4, 8), (1, 1)):
        got = {r["doc_id"]: [tuple(e) for e in r["f"]] for r in df.select("doc_id", fp.fingerprint(F.col("text"), k, w).alias("f")).collect()}
        assert got == {i: literal(t, k, w) for i, t in rows}


def test_guarantee(spark):
    """A run of k + w - 1 characters in two texts leaves a hash in both; the positions tell where."""
    rnd = random.Random(7)
    noise = lambda n: "".join(rnd.choice("klmnopqrst ") for _ in range(n))
    run = noise(47)
    a, b = noise(800) + run + noise(77), noise(123) + run + noise(900)
    x, y = literal(a), literal(b)
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    found = {r["doc_id"]: {(p["hash"], p["pos"]) for p in r["fingerprint"]} for r in fp.add_fingerprints(df).collect()}
    assert found[1] == {(h, p) for p, h in x} and found[2] == {(h, p) for p, h in y}
    shared = {h for h, _ in found[1]} & {h for h, _ in found[2]}
    assert shared and all(800 <= p <= 800 + 31 for h, p in found[1] if h in shared)
    assert fp.postings(df).count() == len(x) + len(y)


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        sets = [{h for _, h in literal(t)} for t in (text, edited, nxt)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        show = lambda t: ",".join(f"{p}:{h:X}" for p, h in literal(t))
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), show(text), show(edited), *near)
    return out


def test_edited_pairs(spark, monkeypatch):
    rows = [(i * 3 - 20, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pos": F.lit(1), "hash": F.lit("x"), "__lf_range2": F.lit(0)})
    want = expected(rows)
    for size in (fp.RANGE_BYTES, 2000):
        monkeypatch.setattr(fp, "RANGE_BYTES", size)
        got = {r[0]: tuple(r[1:]) for r in fp.edited_pairs(df).collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k][:4] == v[:4] and all(abs(p - q) < 1e-12 for p, q in zip(got[k][4:], v[4:], strict=True))


def test_odd_tables(spark):
    one = spark.createDataFrame([(5, "only one document, which comes after itself")], "doc_id long, text string")
    r = fp.edited_pairs(one).head()
    assert r["near_next"] == 1.0 and r["n_chars"] == 43
    assert fp.edited_pairs(one.where("doc_id < 0")).count() == 0
    odd = spark.createDataFrame([(None, "a"), (None, None), (1, "b"), (1, "b"), (1, "c" * 40)], "doc_id long, text string")
    assert fp.edited_pairs(odd).count() == 5
