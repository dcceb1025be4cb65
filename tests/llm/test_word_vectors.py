"""Random indexing against a literal count, and pooling against loops."""

import random

import numpy as np

from linkframe.llm import quality as q

MARKS = ["", ",", ".", "!!", "###"]


def texts_of(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["THE", "x_1", "Ärger", "42"]
    one = lambda k: " ".join(rng.choice(words) + rng.choice(MARKS) for _ in range(k))
    return [None, "", " \n ", "one", "so so so. so. end", *(one(rng.randint(1, 120)) for _ in range(n)), one(9000)]


def words_with_repeats(text):
    import re

    w = re.findall(r"\w+|[^\w\s]+", text)
    mark = [not x.isalnum() for x in w]
    out = []
    for i, x in enumerate(w):
        again = not mark[i] and (i > 0 and w[i - 1] == x or i > 1 and mark[i - 1] and w[i - 2] == x)
        out.append("\0repeat" if again else x)
    return out


def literal(texts):
    """{word: context vector} by counting pairs of words."""
    out = {}
    for t in texts:
        w = words_with_repeats(t or "")
        for i, x in enumerate(w):
            mine = out.setdefault(x, np.zeros(q.WIDTH, int))
            for j in range(max(0, i - q.REACH), min(len(w), i + q.REACH + 1)):
                mine += q.index_vectors(q.hashes_of([w[j]]))[0]
    return out


def tables_of(texts, limit):
    words, table = q.Words(indexed=True, memory=50), q.ContextSums()
    for group in q.grouped(texts, limit):
        table.add(words.numbers(group.flat), words, group.own())
    return table.sums


def test_context_vectors_are_literal_counts():
    texts = texts_of(40, 5)
    want = np.zeros((2, q.ROWS, q.HALF), int)
    for word, v in literal(texts).items():
        a, b = q.rows_of(q.hashes_of([word]))[0]
        want[0, a] += v[: q.HALF]
        want[1, b] += v[q.HALF :]
    for limit in (1, 300, 1 << 18):
        assert (tables_of(texts, limit) == want).all(), limit


def test_pieces_are_one_text(monkeypatch):
    """Windows, repeats and segments go on over the ends of blocks and pieces."""
    texts = [*texts_of(5, 9), " ".join(["so", "so", "!!", "so", "then", "x"] * 200)]
    v = np.random.default_rng(2).integers(-127, 128, (2, q.ROWS, q.HALF)).astype(np.int8)
    whole, pooled = tables_of(texts, 1 << 18), q.pooled(texts, q.Words(), v)
    for block, piece in ((50, 32), (777, 64), (90, 96)):
        monkeypatch.setattr(q, "BLOCK", block)
        monkeypatch.setattr(q, "PIECE", piece)
        for limit in (1, 500):
            assert (tables_of(texts, limit) == whole).all()
        assert np.allclose(q.pooled(texts, q.Words(memory=30), v), pooled, atol=1e-6)


def test_a_text_of_over_a_million_characters():
    text = " ".join(texts_of(1, 3)[-1] for _ in range(40))
    assert len(text) > 1_200_000
    v = np.random.default_rng(3).integers(-127, 128, (2, q.ROWS, q.HALF)).astype(np.int8)
    w = words_with_repeats(text)
    known = {x: q.vector_of(x, v) for x in set(w)}
    x = np.array([known[y] for y in w])
    cuts = list(range(0, len(w), q.SEGMENT))
    if len(w) - cuts[-1] < q.SEGMENT // 2:
        cuts.pop()
    means = np.add.reduceat(x, cuts, axis=0) / np.diff([*cuts, len(w)])[:, None]
    assert np.allclose(q.pooled([text], q.Words(), v)[0], np.concatenate([x.mean(axis=0), means.max(axis=0), means.min(axis=0)]), atol=1e-5)


def test_tree_of_tables(spark, monkeypatch):
    texts = texts_of(60, 8)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(8)
    want = q.word_vectors(docs)
    monkeypatch.setattr(q, "FAN", 2)  # eight tables: three levels
    assert (q.word_vectors(docs) == want).all()


def test_tables_of_a_corpus(spark):
    texts = texts_of(40, 6)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    sums = tables_of(texts, 1 << 18).astype(np.int64)
    length = np.linalg.norm(sums, axis=2, keepdims=True)
    want = np.rint(127 * sums / np.where(length, length, 1))
    assert (q.word_vectors(docs.repartition(5)) == want).all()
    assert not q.word_vectors(docs.limit(0)).any()


def test_words_have_vectors_of_their_own():
    words = [f"w{i}" for i in range(100_000)]
    rows = q.rows_of(q.hashes_of(words))
    assert len(np.unique(rows, axis=0)) == len(words)
    index = q.index_vectors(q.hashes_of(words))
    assert len(np.unique(index, axis=0)) > 0.999 * len(words) and abs(index.mean()) < 0.01


def test_pooling_by_loops():
    texts = texts_of(20, 7)
    v = np.random.default_rng(1).integers(-127, 128, (2, q.ROWS, q.HALF)).astype(np.int8)
    got = q.pooled(texts, q.Words(memory=30), v)
    for text, row in zip(texts, got, strict=True):
        w = words_with_repeats(text or "")
        if not w:
            assert not row.any()
            continue
        x = np.array([q.vector_of(y, v) for y in w])
        cuts = list(range(0, len(w), q.SEGMENT))
        if len(cuts) > 1 and len(w) - cuts[-1] < q.SEGMENT // 2:
            cuts.pop()
        means = np.array([s.mean(axis=0) for s in np.split(x, cuts[1:])])
        assert np.allclose(row, np.concatenate([x.mean(axis=0), means.max(axis=0), means.min(axis=0)]), atol=1e-5)
