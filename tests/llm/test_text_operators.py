"""Operators on texts against brute force, and their defined cases."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkframe.llm import decontamination as dc
from linkframe.llm import license_scan, mixing, quality, sharding, signature_join, toxicity

from . import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, first=1):
    return spark.createDataFrame([(first + i, t, "en", f"src{i % 5}", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


# --- decontamination --------------------------------------------------------------------


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(4)
    items = [(i, prose(rng, n)) for i, n in enumerate([30, 12, 10, 4, 1, 0])] + [(9, None), (1, "Zwölf Wörter, über «allem»; 1 2 3 4 5 6 7 8!")]
    texts = [None, "", "...", prose(rng, 50), items[0][1], "x " + items[1][1].upper().replace(" ", ",  ") + " y", items[3][1], items[7][1] + " " + items[7][1]]
    texts += [prose(rng, 40) + " " + items[k][1] + " " + prose(rng, 5) for k in range(5)] + [items[0][1][:60], " ".join(items[0][1].split()[3:16])]
    texts += [prose(rng, 3000)]
    return items, texts


@pytest.mark.parametrize("bound", [1 << 20, 400])
def test_decontamination_report(spark, leaks, bound):
    items, texts = leaks
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in dc.report(docs, bench, max_broadcast_bytes=bound).collect()}
    assert got == brute.decontaminated([(i + 1, t) for i, t in enumerate(texts)], items)


def test_decontaminate_modes(spark, leaks, rows):
    items, texts = leaks
    docs = docs_of(spark, texts).withColumn("spans", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute.decontaminated([(i + 1, t) for i, t in enumerate(texts)], items)
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, x in expected.items() if not x[4]}
    cut = {r["doc_id"]: r["text"] for r in dc.decontaminate(docs, bench, mode="spans").collect()}
    assert len(cut) == len(texts)
    for i, t in enumerate(texts, 1):
        assert cut[i] == t if not expected[i][4] else len(dc.words_of(cut[i].encode())) == expected[i][0] - expected[i][1]
    with pytest.raises(ValueError):
        dc.decontaminate(docs, bench, mode="x")
    assert rows(dc.report(docs.limit(0), bench)) == []
    assert dc.report(docs, bench.limit(0)).where("contaminated").count() == 0


# --- near duplicates ------------------------------------------------------------------------


def brute_classes(texts, k=5, percent=75):
    def shingles(t):
        w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i + 1: (len(s), find(i) + 1) for i, s in enumerate(sets)}


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(8)
    texts = [None, "", " \t\n", "One two", "one  TWO", "one two three", "a b c d e", "a b c d e"]
    shared = prose(rng, 40)
    for _ in range(40):
        texts.append(prose(rng, rng.randrange(20, 80)) + " " + shared)
    for size in (30, 90, 200):
        base = prose(rng, size).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + size // 40)):
                w[rng.randrange(size)] = f"x{rng.randrange(9)}"
            texts.append(" ".join(w))
    chain = prose(rng, 100, 10**6).split()
    for i in range(12):  # neighbours are linked, the ends are not
        texts.append(" ".join(chain[3 * i :] + [f"t{j}" for j in range(3 * i)]))
    texts.append(prose(rng, 6000))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [4_000_000, 1500])
def test_signature_join(spark, copies, block):
    found = signature_join.classes(docs_of(spark, copies).repartition(3), block_shingles=block, bucket_postings=2000, max_broadcast=0 if block == 1500 else 500)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute_classes(copies)


def test_signature_join_through_a_null_id(spark):
    """A-N and N-B link, A-B doesn't: the chain holds whatever N's id is."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    a, n, b = (" ".join(words[i : i + 50]) for i in (0, 4, 8))
    sets = [set(signature_join.shingle_set(x.encode()).tolist()) for x in (a, n, b)]
    jaccard = lambda x, y: len(x & y) / len(x | y)
    assert jaccard(sets[0], sets[1]) > 0.75 < jaccard(sets[1], sets[2]) and jaccard(sets[0], sets[2]) < 0.75
    for middle in (3, None):
        rows = [(1, a), (2, b), (middle, n), (middle, n), (None, None), (None, "other words that link with nothing at all")]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        found = [(r["doc_id"], r["n_shingles"] > 36, r["component_id"]) for r in signature_join.classes(docs).collect()]
        assert sorted(found, key=repr) == sorted([(1, True, 1), (2, True, 1), (middle, True, 1), (middle, True, 1), (None, False, None), (None, False, None)], key=repr)


def test_deduplicate(spark, copies):
    docs = docs_of(spark, copies).withColumn("n_shingles", F.lit("x"))
    kept = signature_join.deduplicate(docs)
    expected = {i for i, (_, c) in brute_classes(copies).items() if i == c}
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    twice = signature_join.deduplicate(docs.union(docs))
    assert sorted(r["doc_id"] for r in twice.collect()) == sorted(expected)
    assert signature_join.deduplicate(docs.limit(0)).count() == 0


def test_tree_prunes_nothing_it_must_not():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 62, rng.integers(1, 300)).astype(np.uint64)) for _ in range(60)]
    sets = [np.unique(np.append(b[: len(b) - k], rng.integers(0, 1 << 62, k).astype(np.uint64))) for b in base for k in range(0, min(4, len(b)))]
    links = signature_join.tree_links(signature_join.SignatureTree(sets))
    half = len(sets) // 2
    cross = signature_join.tree_links(signature_join.SignatureTree(sets[:half]), signature_join.SignatureTree(sets[half:]))

    def classes(links, pairs):
        root = list(range(len(sets)))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
        return {frozenset(i for i, r in enumerate(root) if r == x) for x in set(root)}

    every = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    assert classes(None, links) == classes(None, every)
    assert classes(None, cross) == classes(None, [(i, j) for i, j in every if (i < half) != (j < half)])


# --- licenses -------------------------------------------------------------------------------


def test_license_scan(spark, rows):
    rng = random.Random(2)
    t = license_scan.TEMPLATES
    long_text = prose(rng, 4000) + " " + t["mit-permission"].upper() + " " + prose(rng, 1500)
    texts = [
        None, "", "license", t["mit-notice"] + ".", prose(rng, 30) + "\n" + t["apache-2.0-notice"] + "; " + prose(rng, 7), long_text,
        "under the license of a software permission", t["bsd-redistribution"].replace("binary", "object"), t["mit-notice"] + " x " + t["mit-notice"],
    ]
    docs = docs_of(spark, texts)
    got = rows(license_scan.scan(docs))
    assert [(i, k) for i, k, _ in got] == [(4, "mit-notice"), (5, "apache-2.0-notice"), (6, "mit-permission"), (8, "bsd-redistribution"), (9, "mit-notice")]
    assert [c for *_, c in got if c < 1] == [c for i, _, c in got if i == 8]
    assert rows(license_scan.scan(docs.union(docs), max_broadcast_rows=0)) == got
    assert rows(license_scan.scan(docs, templates={"x": "two words", "y": None})) == rows(license_scan.scan(docs.limit(0))) == []


def brute_licenses(text, containment=0.8):
    """Every run of as many words as a template has, as sets of shingles."""
    words, out = license_scan.template_words(text or ""), {}
    sh = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    for name, template in license_scan.TEMPLATES.items():
        w, p = license_scan.template_words(template), license_scan.template_words(license_scan.IDENTITY.get(name, ""))
        known, must = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}, {tuple(p[i : i + 3]) for i in range(len(p) - 2)}
        assert must <= known
        runs = [set(sh[i : i + len(w) - 2]) for i in range(max(1, len(sh) - len(w) + 3))]
        shares = [len(known & r) / len(known) for r in runs if must <= r]
        if shares and max(shares) >= containment:
            out[name] = max(shares)
    return out


def test_licenses_match_brute_force(spark, rows):
    rng = random.Random(8)
    texts = [None, ""]
    for template in license_scan.TEMPLATES.values():
        w = template.split()
        for edits in (0, 1, 2, max(1, len(w) // 20)):
            v = list(w)
            for _ in range(edits):
                v[rng.randrange(len(v))] = "changed"
            texts.append(" ".join([prose(rng, rng.randrange(60)), *v, prose(rng, rng.randrange(60))]))
    texts.append(" . ".join(license_scan.TEMPLATES.values()) * 3)
    want = sorted((i + 1, k, round(c, 9)) for i, t in enumerate(texts) for k, c in brute_licenses(t).items())
    got = sorted((r[0], r[1], round(r[2], 9)) for r in rows(license_scan.scan(docs_of(spark, texts))))
    assert got == want


def test_license_versions_are_told_apart(spark, rows):
    t = license_scan.TEMPLATES
    texts = [
        t["gpl-2.0-notice"], t["gpl-3.0-notice"].replace("3", "4"), t["mpl-2.0-header"].replace("2.0", "1.1"), t["lgpl-redistribute"],
        t["cc-by-sa-4.0-notice"], t["cc-by-4.0-notice"].replace("4.0", "3.0"),
    ]
    got = [(i, k) for i, k, _ in rows(license_scan.scan(docs_of(spark, texts)))]
    assert got == [(1, "gpl-2.0-notice"), (4, "lgpl-redistribute"), (5, "cc-by-sa-4.0-notice")]


def test_anchors_cover_every_match():
    for share in (0.5, 0.8, 1.0):
        words = set(license_scan.anchors(license_scan.TEMPLATES, share))
        for text in license_scan.TEMPLATES.values():
            w = license_scan.template_words(text)
            shingles = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
            assert sum(not words & set(s) for s in shingles) < math.ceil(share * len(shingles))
        identity = license_scan.IDENTITY
        words = set(license_scan.anchors(license_scan.TEMPLATES, share, identity))
        assert all(words & set(license_scan.template_words(x)) for x in identity.values())


# --- mixing -----------------------------------------------------------------------------------


def brute_fill(children, budget):
    """Water filling: children {name: (weight, cap)}."""
    out, todo = {}, dict(children)
    while todo:
        total = sum(w for w, _ in todo.values())
        full = [k for k, (w, cap) in todo.items() if cap <= budget * w / total + 1e-9]
        if not full:
            return out | {k: budget * w / total for k, (w, _) in todo.items()}
        for k in full:
            out[k] = todo.pop(k)[1]
            budget -= out[k]
    return out


@pytest.mark.parametrize(("share", "epochs"), [(0.5, 1), (0.9, 2), (3.0, 3), (5.0, 2)])
def test_mixing(spark, share, epochs):
    rng = random.Random(6)
    data = [(i, prose(rng, rng.randrange(0, 60)), rng.choice(["en", "de", None]), rng.choice(["src0"] * 6 + ["src1", "src2", "src9", "x", None]), 0) for i in range(300)]
    docs = spark.createDataFrame(data, SCHEMA)
    weights = {0: {"d0": 3, "d2": 0.5}, 1: {"en": 2}}
    got = [tuple(r) for r in mixing.mix(docs, weights, budget_share=share, max_epochs=epochs, report=True).collect()]
    tree = {}
    for _, text, lang, source, _ in data:
        m = re.search("([0-9]+)$", source or "")
        d = f"d{int(m[1]) % 4}" if m else "other"
        leaf = tree.setdefault(d, {}).setdefault(lang or "", {})
        leaf[source or ""] = leaf.get(source or "", 0) + len(text.split())
    total = sum(n for a in tree.values() for b in a.values() for n in b.values())
    cap = lambda x: epochs * x if isinstance(x, int) else sum(map(cap, x.values()))
    w0, w1 = (lambda d: {"d0": 3, "d2": 0.5}.get(d, 1)), (lambda x: {"en": 2}.get(x, 1))
    top = brute_fill({d: (w0(d), cap(x)) for d, x in tree.items()}, min(share * total, cap(tree)))
    used = {}
    for _, d, lang, s, n, b, e in got:
        used.setdefault((d, lang, s), [b, 0])[1] += n
        assert 0 <= e < epochs
    for d, b0 in top.items():
        for lang, b1 in brute_fill({k: (w1(k), cap(x)) for k, x in tree[d].items()}, b0).items():
            for s, b2 in brute_fill({k: (1, cap(x)) for k, x in tree[d][lang].items()}, b1).items():
                if (d, lang, s) in used:
                    assert abs(used[(d, lang, s)][0] - b2) < 1e-6 * max(1, b2)
                    assert b2 - 60 <= used[(d, lang, s)][1] <= b2 + 1e-6
    assert len({(g[0], g[6]) for g in got}) == len(got)


def test_mixing_keeps_columns(spark):
    docs = docs_of(spark, ["a b c", None, "d", "a b c"]).withColumn("tokens", F.lit(1)).withColumn("epoch", F.lit("x"))
    out = mixing.mix(docs, budget_share=10.0, max_epochs=2)
    assert sorted(out.columns) == sorted(docs.columns) and out.where("text IS NOT NULL").count() == 6
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs, budget=0).count() == 0
    assert mixing.mix(docs, {0: {"d0": 0, "d1": 0, "d2": 0, "d3": 0}}).count() == 0


# --- sharding -----------------------------------------------------------------------------------


def test_sharding(spark, rows):
    rng = random.Random(1)
    texts = [None, ""] + [prose(rng, rng.randrange(1, 40)) for _ in range(900)] + ["hot text"] * 500 + ["ü" * 3000] * 3
    docs = docs_of(spark, texts).withColumn("shard", F.lit("old"))
    out = sharding.assign(docs, shards=8)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    load = [0] * 8
    slots = [[] for _ in range(8)]
    for i, t in enumerate(texts, 1):
        r, data = got[i], (t or "").encode()
        assert (r["size"], r["text_crc32"], r["text"]) == (len(data) + 1, zlib.crc32(data), t)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean = sum(load) / 8
    assert max(load) <= 1.002 * mean + 20 and min(load) >= 0.98 * mean
    again = {r["doc_id"]: r["shard"] for r in sharding.assign(docs.repartition(5), shards=8, carry=["doc_id"]).collect()}
    assert again == {i: r["shard"] for i, r in got.items()}
    assert sharding.assign(docs.limit(0)).count() == 0
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, shards=9, carry=["doc_id"]).collect()}
    assert sum(grown[i] != again[i] for i in grown) < 0.5 * len(grown)


def test_sharding_splits_a_hot_text(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('t', id) ELSE 'one text' END AS text")
    out = sharding.assign(docs, shards=4, carry=["doc_id"]).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    n = [r["n"] for r in out]
    assert len(n) == 4 and max(n) - min(n) <= 0.02 * sum(n)


@pytest.mark.parametrize(("size", "copies"), [(50, 1000), (900, 400)])
def test_sharding_divides_equal_rows(spark, size, copies):
    """Rows without an id that are equal in every column keep the law, be they small or large."""
    rows = [(None, "x" * size)] * copies + [(i, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = sharding.assign(docs, shards=8).collect()
    load, slots = [0] * 8, [[] for _ in range(8)]
    for r in out:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(out) == copies + 100 and max(load) - min(load) <= 2 * (size + 1) + 0.01 * sum(load) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_sharding_against_a_ring_by_rows(spark):
    """With limits that nobody reaches, every row goes to the next point clockwise; with bounds, no shard with
    room clockwise before the chosen one is skipped but those that a cell has closed."""
    rng = random.Random(9)
    docs = docs_of(spark, [prose(rng, rng.randrange(1, 30)) for _ in range(400)])
    loose = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, shards=5, slack=50.0).collect()}
    ring = sharding.Ring(5, 1e18, 64)
    places = {r["doc_id"]: r["__lf_c1"] for r in sharding.keyed(docs, "doc_id", "text").collect()}
    assert loose == {i: next(iter(ring.clockwise(c))) for i, c in places.items()}
    tight = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, shards=5, slack=0.3).collect()}
    assert sum(tight[i] == loose[i] for i in tight) > 0.5 * len(tight)  # only rows of full shards moved


# --- classifiers ------------------------------------------------------------------------------------

VILE = ["nastyword", "grubling"]
NOISY = {"nastyword": ["n4styw0rd", "n.a.s.t.y.w.o.r.d", "naaastyword", "n a s t y w o r d", "NASTYWORD!!"], "grubling": ["gru8l1ng", "grub-ling", "g r u b l i n g"]}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    syl = ["ba", "ne", "tor", "lin", "sa", "wor", "ding", "ast", "gru", "ma"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(900):
        w = [word() for _ in range(rng.randrange(20, 60))]
        vile, junk = i % 5 == 0, i % 4 == 1
        if junk:
            w = w[:10] + [w[0]] * 20 if i % 8 == 1 else [x.upper() + "!!" for x in w]
        if vile:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(VILE))
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(not junk), int(vile)))
    clean = [" ".join(word() for _ in range(30)) for _ in range(8)]
    hidden = [c + " " + x for c in clean for xs in NOISY.values() for x in xs]
    for i, t in enumerate([*clean, *hidden, None, "", "  "], 2000):
        rows.append((i, t, "en", "s", 0))
    labels += [(1, None, None), (5, 1, 1), (None, 1, 1), (77777, 0, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), len(clean), len(hidden)


def test_toxicity(spark, labelled):
    docs, labels, n_clean, n_hidden = labelled
    model, scorer = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model, scorer, carry=["doc_id"]).collect()}
    right = sum((got[i] >= 0.5) == (i % 5 == 0) for i in range(900))
    assert right >= 890
    assert all(got[2000 + i] < 0.5 for i in range(n_clean))
    assert sum(got[2000 + n_clean + i] >= 0.5 for i in range(n_hidden)) >= 0.9 * n_hidden
    assert all(0 <= p <= 1 for p in got.values()) and got[2000 + n_clean + n_hidden] < 0.5
    kept = toxicity.drop_toxic(docs.withColumn("toxicity", F.lit("x")), labels)
    assert kept.count() == sum(p < 0.5 for p in got.values()) and "toxicity" in kept.columns
    restored = toxicity.score(docs.where("doc_id >= 2008"), model, scorer, carry=["doc_id"], restored=True).collect()
    assert sum(any(v in (r["restored"] or "").split() for v in VILE) for r in restored) >= 0.9 * n_hidden


def test_held_out_labels_are_not_learned(spark, labelled):
    docs, labels, *_ = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x)[1] for x in (labels, flipped))
    assert a.weights == b.weights and a.coef == pytest.approx(b.coef)
    ids = [r["doc_id"] for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_triples_do_not_depend_on_blocks():
    rng = random.Random(1)
    texts = [prose(rng, 50), "", None, "é à ß中文", prose(rng, 300)]
    whole = toxicity.triple_counts(texts)
    assert (whole == toxicity.triple_counts(texts, block=64)).all() and (whole == sum(toxicity.triple_counts([t]) for t in texts)).all()


def test_degenerate_labels(spark, labelled):
    docs, labels, *_ = labelled
    few = docs.where("doc_id < 20")
    for y, p in ((0, 0.0), (1, 1.0)):
        model, scorer = toxicity.train(few, labels.where(F.col("toxic") == y))
        assert all(abs(r["toxicity"] - p) < 1e-9 for r in toxicity.score(few, model, scorer).collect())
        vectors, net = quality.train(few, labels.where(F.col("quality") == y))
        assert {r["quality_score"] for r in quality.score(few, vectors, net).collect()} == {p}
    vectors, net = quality.train(few.limit(0), labels.limit(0))
    assert quality.score(few.limit(0), vectors, net).count() == 0 and {r["quality_score"] for r in quality.score(few, vectors, net).collect()} == {0.5}


def test_quality(spark, labelled):
    docs, labels, *_ = labelled
    vectors, net = quality.train(docs, labels)
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(docs.withColumn("quality_score", F.lit("x")), vectors, net).collect()}
    right = sum((got[i] >= 0.3) == (i % 4 != 1) for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0)
    assert right >= 0.97 * sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(900))
    assert all(0 <= p <= 1 for p in got.values())
    assert (quality.word_vectors(docs.repartition(7)) == vectors).all()


def test_license_scan_with_clashing_columns(spark, rows):
    text = "text before it. " + next(iter(license_scan.TEMPLATES.values())) + " and text after it"
    plain = spark.createDataFrame([(1, text), (2, "nothing here"), (None, text), (3, None), (4, "")], "doc_id long, text string")
    odd = plain.withColumns({c: F.lit("x") for c in ("license", "containment", "words", "shingle", "i", "w", "n")})
    got = rows(license_scan.scan(odd))
    assert got == rows(license_scan.scan(plain)) and {r[0] for r in got} == {1, None}


def test_long_texts_of_the_toxicity_model():
    """A text of over a block of characters restores like its pieces."""
    model = toxicity.CharModel(toxicity.triple_counts(["you are a stupid moron and a fool in the green valley"] * 50))
    part = "you are a stup1d m0r0n in the gr33n valley and f-o-o-l "
    long = part * (1_200_000 // len(part))
    assert len(long) > toxicity.BLOCK
    restorer = toxicity.Restorer(model)
    one, many = restorer.counts(part), restorer.counts(long)
    assert many == {w: n * (len(long) // len(part)) for w, n in one.items()} and many["stupid"] and many["moron"]
