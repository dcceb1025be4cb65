"""Quality scores from random-indexing word vectors and a small network.

1. Words: runs of letters and digits, and runs of other characters that aren't white space, as
   written.  A word that directly repeats the one before it, or the one before a mark, is the
   word "repeat".
2. Word vectors: every word has a sparse index vector of ``NONZERO`` entries +1 and -1 (they add up
   where they meet), drawn from its hash.  Its context vector is the sum of the index vectors in
   its windows of ``REACH`` words to either side (itself included) over all documents.  Sums are
   integers: the result doesn't depend on how the input is cut.  The two halves of a context vector are kept in two tables of
   ``ROWS`` rows, each by a hash of its own: different words share a vector only where both
   hashes meet (one pair in ROWS**2), half a vector more often.  The tables have a fixed size on
   any corpus; what they sum up grows with it.
3. Pooling: the mean of a document's word vectors, and the largest and smallest component
   means over its segments of ``SEGMENT`` words, so a spoilt part of a long text shows.
4. Network: two numpy layers (tanh, then logistic) trained with Adam on at most
   ``max_labelled`` labelled rows; a fifth of these is kept from training and sets the
   temperature that divides the logit.

Defined cases
-------------
* null and empty texts pool to zeros and get the network's score for that.
* labels that are null or neither 0 nor 1, and labels of unknown documents, are ignored;
  repeated labels of one id count once (the largest).
* no usable labels: every score is 0.5; one class only: every score is that class.
* empty tables: an empty result; without documents all vectors are zero.
* ties: equal texts, and so repeated rows, get equal scores.
* extra columns pass through ``score`` untouched unless they are named like its result.
* very long texts are read whole, ``BLOCK`` characters and ``PIECE`` words at a time; windows, repeats and
  segments go on over the ends of pieces, so a text of any length is pooled by one rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.llm.hashing import mix64
from linkframe.llm.toxicity import blocks_of, labelled_sample, let_go
from linkframe.plans.lineage import small_batches

ROWS, WIDTH, NONZERO, REACH, SEGMENT = 1 << 18, 64, 8, 2, 32
HALF = WIDTH // 2
#: Rows of a table travel in parts, each summed by one task.
PARTS, PART_ROWS = 512, 2 * ROWS // 512
BLOCK = 1 << 19
#: Words of a piece of a long text, a multiple of SEGMENT.
PIECE = 1 << 17
_WORD = re.compile(r"\w+|[^\w\s]+")
_GAP = [None] * REACH


def hashes_of(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count=len(words))


def rows_of(h: np.ndarray) -> np.ndarray:
    """Rows in the two tables of words by their hashes, from bits apart."""
    return np.stack([h % np.uint64(ROWS), (h >> np.uint64(32)) % np.uint64(ROWS)], axis=1).astype(np.int32)


def index_vectors(h: np.ndarray) -> np.ndarray:
    """Index vectors of words by their hashes: NONZERO places, the first half +1, the others -1."""
    out, h, every = np.zeros((len(h), WIDTH), np.int8), mix64(h), np.arange(len(h))
    for k in range(NONZERO):
        out[every, (h >> np.uint64(6 * k)) % np.uint64(WIDTH)] += 1 if 2 * k < NONZERO else -1
    return out


class Words(dict):
    """Words to consecutive numbers from 1 on, with each number's rows in the two tables and, if asked for, its
    index vector.  Number 0 is the word "repeat", None a gap (-1).  It starts anew once it holds ``memory`` words."""

    def __init__(self, indexed: bool = False, memory: int = 150_000):
        self.memory, self.indexed = memory, indexed
        self._start(memory)

    def _start(self, room: int) -> None:
        self.clear()
        self[None] = -1
        self.used, repeat = 1, hashes_of(["\0repeat"])
        self.rows = np.zeros((room, 2), np.int32)
        self.wordy = np.zeros(room + 1, bool)  # the last one, that of a gap, stays False
        self.index = np.zeros((room if self.indexed else 0, WIDTH), np.int8)
        self.rows[0] = rows_of(repeat)[0]
        if self.indexed:
            self.index[0] = index_vectors(repeat)[0]

    def _learn(self, new: list[str]) -> None:
        start, end = self.used, self.used + len(new)
        if end > len(self.rows):
            more = max(end, 2 * len(self.rows)) - len(self.rows)
            self.rows = np.concatenate([self.rows, np.zeros((more, 2), np.int32)])
            self.wordy = np.concatenate([self.wordy, np.zeros(more, bool)])
            if self.indexed:
                self.index = np.concatenate([self.index, np.zeros((more, WIDTH), np.int8)])
        h = hashes_of(new)
        self.update(zip(new, range(start, end), strict=True))
        self.rows[start:end] = rows_of(h)
        self.wordy[start:end] = np.fromiter(map(str.isalnum, new), bool, count=len(new))
        if self.indexed:
            self.index[start:end] = index_vectors(h)
        self.used = end

    def numbers(self, flat: list[str | None]) -> np.ndarray:
        """Numbers of words with gaps (None) between texts; they hold until the next call."""
        distinct = set(flat)
        if self.used > self.memory:
            self._start(self.memory)
        self._learn(list(distinct.difference(self)))
        n = np.fromiter(map(self.__getitem__, flat), np.int32, count=len(flat))
        wordy, again = self.wordy[n], np.zeros(len(n), bool)
        again[1:] = wordy[1:] & (n[1:] == n[:-1])
        again[2:] |= wordy[2:] & ~wordy[1:-1] & (n[1:-1] >= 0) & (n[2:] == n[:-2])
        n[again] = 0
        return n


class Group:
    """Words in a row, with gaps after each piece of a text.  A piece is its words and, where the text goes on before or
    after it, the words there that its windows and repeats reach; only its own count."""

    def __init__(self):
        self.flat: list = []
        self.starts, self.ends, self.owners = [], [], []

    def add(self, before: list, own: list, after: list, owner: int) -> None:
        self.starts.append(len(self.flat) + len(before))
        self.flat += before
        self.flat += own
        self.ends.append(len(self.flat))
        self.flat += after
        self.flat += _GAP
        self.owners.append(owner)

    def own(self) -> np.ndarray:
        """Which places are words of a piece itself."""
        edges = np.zeros(len(self.flat) + 1, np.int8)
        edges[self.starts] = 1
        np.add.at(edges, self.ends, -1)
        return np.cumsum(edges[:-1]).astype(bool)


def grouped(texts, limit: int = 1 << 18) -> Iterator[Group]:
    """Words of about ``limit`` or more.  A text of over PIECE words goes in pieces of PIECE, a whole number of segments;
    the last one has SEGMENT words at least, so segments are those of the whole text."""
    group = Group()
    for i, text in enumerate(texts):
        before, held = [], []
        for part in blocks_of(text or "", BLOCK):
            held += _WORD.findall(part)
            while len(held) >= PIECE + SEGMENT:
                group.add(before, held[:PIECE], held[PIECE : PIECE + REACH], i)
                before, held = held[PIECE - REACH - 2 : PIECE], held[PIECE:]
                if len(group.flat) > limit:
                    yield group
                    group = Group()
        if held:
            group.add(before, held, [], i)
        if len(group.flat) > limit:
            yield group
            group = Group()
    if group.flat:
        yield group


def _sorted_by(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts numbers below 2**32, by two passes of 16 bits, and the starts of equal ones in it."""
    order = np.argsort((n & 0xFFFF).astype(np.uint16), kind="stable")
    order = order[np.argsort((n >> 16).astype(np.uint16)[order], kind="stable")]
    n = n[order]
    return order, np.flatnonzero(np.append(True, n[1:] != n[:-1]))


def run_sums(x: np.ndarray, cuts: np.ndarray, bias: int) -> np.ndarray:
    """Sums of the rows of x (bytes, WIDTH wide) from each cut to the next.  Four columns are added at once, as
    16-bit lanes of a word: values must lie within ``bias`` of 0, and runs be short enough for 16 bits."""
    lanes = (x + np.int16(bias)).astype(np.uint16).view(np.uint64)
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint16).astype(np.int32)
    return sums - np.diff(np.append(cuts, len(x)))[:, None].astype(np.int32) * np.int32(bias)


class ContextSums:
    """The two tables of context sums, dense: 2 * ROWS * HALF integers."""

    def __init__(self):
        self.sums = np.zeros((2, ROWS, HALF), np.int32)

    def add(self, n: np.ndarray, words: Words, own: np.ndarray) -> None:
        """Adds the windows of the ``own`` ones of consecutive words; after each text n has REACH gaps (-1)."""
        rows = words.index[n]
        rows[n < 0] = 0
        near = rows.copy()
        for d in range(1, REACH + 1):
            near[d:] += rows[:-d]
            near[:-d] += rows[d:]
        kept = np.flatnonzero(own)
        order, cuts = _sorted_by(n[kept])
        order = kept[order]
        most = (2 * REACH + 1) * NONZERO // 2
        cuts = np.union1d(cuts, np.arange(0, len(order), 0xFFFF // (2 * most + 1)))  # no lane overflows
        sums = run_sums(near[order], cuts, most)
        at = words.rows[n[order[cuts]]]
        for half in (0, 1):
            order, cuts = _sorted_by(at[:, half])
            nth = np.arange(len(order)) - np.repeat(cuts, np.diff(np.append(cuts, len(order))))
            for k in range(nth.max() + 1):  # rows that several words share, one word at a time
                i = order[nth == k]
                self.sums[half, at[i, half]] += sums[i, half * HALF : (half + 1) * HALF]


_PARTS_SCHEMA = pa.schema([("task", pa.int32()), ("part", pa.int32()), ("small", pa.bool_()), ("rows", pa.binary()), ("sums", pa.binary())])
_PARTS_DDL = "task int, part int, small boolean, rows binary, sums binary"
#: Text bytes that one task counts before it hands its tables on; tables that one task adds up; parts of a table it has.
TASK_BYTES, FAN, TASK_PARTS = 512 << 20, 32, 16


def _part_rows(task: int, i: int, part: np.ndarray) -> pa.RecordBatch | None:
    """Rows of a part that aren't zero, those of small numbers as bytes."""
    most, out = np.abs(part).max(axis=1), []
    for small, at in ((True, np.flatnonzero((most > 0) & (most < 128))), (False, np.flatnonzero(most >= 128))):
        if len(at):
            out.append((task, i, small, at.astype(np.uint16).tobytes(), part[at].astype(np.int8 if small else np.int64).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PARTS_SCHEMA, strict=True)], schema=_PARTS_SCHEMA) if out else None


def _added(batches) -> dict:
    """{(task, part): sums} of parts of tables."""
    total: dict = {}
    for batch in batches:
        for task, part, small, rows, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            mine = total.setdefault((task, part), np.zeros((PART_ROWS, HALF), np.int64))
            mine[np.frombuffer(rows, np.uint16)] += np.frombuffer(sums, np.int8 if small else np.int64).reshape(-1, HALF)
    return total


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(part, rows, vectors) of the tables' rows that aren't zero: unit vectors times 127, as bytes.

    A task counts TASK_BYTES of text, whose tables are at most 64 MB (128 if its sums are large).  Tables are added up as a
    tree, FAN of them to one a level, so no task reads more than FAN * TASK_PARTS parts of at most 256 KB at any scale.
    """

    def count(batches):
        words, table = Words(indexed=True), ContextSums()
        for batch in batches:
            for group in grouped(t.as_py() for t in batch.column(0)):
                table.add(words.numbers(group.flat), words, group.own())
        task = TaskContext.get().partitionId()
        for i, part in enumerate(table.sums.reshape(PARTS, PART_ROWS, HALF)):
            if (rows := _part_rows(task, i, part)) is not None:
                yield rows
        del words, table
        let_go()

    def join(batches):
        for (task, part), sums in _added(batches).items():
            if (rows := _part_rows(task, part, sums)) is not None:
                yield rows

    def finish(batches):
        for (_, part), sums in sorted(_added(batches).items()):
            length = np.linalg.norm(sums, axis=1)
            at = np.flatnonzero(length)
            unit = np.rint(127 * sums[at] / length[at, None]).astype(np.int8)
            cols = [pa.array([part], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([unit.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "rows", "vectors"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    tables = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    sums = texts.coalesce(tables).mapInArrow(count, _PARTS_DDL)
    while tables > FAN:
        tables = -(-tables // FAN)
        sums = sums.withColumn("task", F.floor(F.col("task") / FAN).cast("int"))
        sums = sums.repartition(tables * PARTS // TASK_PARTS, "task", "part").mapInArrow(join, _PARTS_DDL)
    return sums.withColumn("task", F.lit(0)).repartition(PARTS // TASK_PARTS, "part").mapInArrow(finish, "part int, rows binary, vectors binary")


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The two tables (2, ROWS, HALF) of all documents' words, as bytes: 16 MB on any corpus."""
    found = context_sums(docs, text_col).toArrow()
    out = np.zeros((PARTS, PART_ROWS, HALF), np.int8)
    for part, rows, vectors in zip(*(c.to_pylist() for c in found.columns), strict=True):
        out[part, np.frombuffer(rows, np.uint16)] = np.frombuffer(vectors, np.int8).reshape(-1, HALF)
    return out.reshape(2, ROWS, HALF)


def vector_of(word: str, vectors: np.ndarray) -> np.ndarray:
    a, b = rows_of(hashes_of([word]))[0]
    return np.concatenate([vectors[0, a], vectors[1, b]]).astype(float) / 127


def pooled(texts: list[str | None], words: Words, vectors: np.ndarray) -> np.ndarray:
    """A row a text: mean, and largest and smallest means over segments, 3 * WIDTH values."""
    total, count = np.zeros((len(texts), WIDTH)), np.zeros(len(texts))
    most, least = np.full((len(texts), WIDTH), -np.inf), np.full((len(texts), WIDTH), np.inf)
    for group in grouped(texts):
        starts, ends, owners = group.starts, group.ends, group.owners
        n = words.numbers(group.flat)  # before its rows: they may move
        rows = words.rows[n]
        v = np.concatenate([vectors[0, rows[:, 0]], vectors[1, rows[:, 1]]], axis=1)
        cuts, sizes, first = [], [], []
        for a, b in zip(starts, ends, strict=True):
            n = max(1, (b - a + SEGMENT // 2) // SEGMENT)  # a last segment of under half the length joins the one before
            first.append(len(cuts))
            cuts += range(a, a + n * SEGMENT, SEGMENT)
            sizes += [SEGMENT] * (n - 1) + [b - a - (n - 1) * SEGMENT]
        v[~group.own()] = 0
        sums = run_sums(v, np.array(cuts), 127)
        means = sums / np.array(sizes)[:, None]
        np.add.at(total, owners, np.add.reduceat(sums, first, axis=0))
        np.add.at(count, owners, np.subtract(ends, starts))
        np.maximum.at(most, owners, np.maximum.reduceat(means, first, axis=0))
        np.minimum.at(least, owners, np.minimum.reduceat(means, first, axis=0))
    out = np.concatenate([total / np.maximum(count, 1)[:, None], most, least], axis=1) / 127
    out[count == 0] = 0
    return out.astype(np.float32)


class Network:
    """Input scaled, one tanh layer, one logistic output with a temperature."""

    def __init__(self, width: int, hidden: int = 24, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.w1, self.b1 = rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden)
        self.w2, self.b2 = rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)
        self.temperature = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 3e-3, decay: float = 1e-4, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-4
        z = (x - self.mean) / self.scale
        params = [self.w1, self.b1, self.w2, self.b2]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(z))
            lr = rate * (1 - epoch / epochs)
            for i in range(0, len(z), batch):
                at = order[i : i + batch]
                h = np.tanh(z[at] @ self.w1 + self.b1)
                p = 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2[0], -30, 30)))
                g = (p - y[at]) / len(at)
                back = g[:, None] * self.w2 * (1 - h * h)
                grads = [z[at].T @ back + decay * self.w1, back.sum(axis=0), h.T @ g + decay * self.w2, np.array([g.sum()])]
                step += 1
                for p_, g_, m_, v_ in zip(params, grads, m, v, strict=True):
                    m_ += 0.1 * (g_ - m_)
                    v_ += 0.001 * (g_ * g_ - v_)
                    p_ -= lr * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of the least log loss on rows not trained on."""
        z = self.logit(x)

        def loss(t):
            p = 1 / (1 + np.exp(-np.clip(z / t, -30, 30)))
            return -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))

        self.temperature = float(min(np.exp(np.linspace(-1.5, 2.5, 81)), key=loss))


class Constant:
    def __init__(self, p: float):
        self.p = p

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = 20_000,
) -> tuple[np.ndarray, Network | Constant]:
    """The word vectors of all documents, and the network fitted on labelled ones."""
    spark = docs.sparkSession
    small_batches(spark)
    vectors = word_vectors(docs, text_col)
    sample = labelled_sample(labels, id_col, label_col, max_labelled).collect()  # at most max_labelled small rows
    shared = spark.sparkContext.broadcast(vectors)
    ids = T.StructType([T.StructField("__lf_id", docs.schema[id_col].dataType), T.StructField("y", T.IntegerType())])
    sample_ids = spark.createDataFrame([(r["__lf_id"], r["__lf_y"]) for r in sample], ids)
    mine = docs.select(F.col(id_col).alias("__lf_id"), F.col(text_col).cast("string").alias("__lf_text")).join(F.broadcast(sample_ids), "__lf_id")

    def pool(batches):
        words = Words()
        for batch in batches:
            x = pooled(batch.column(1).to_pylist(), words, shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in x], pa.binary())], names=["y", "x"])
        del words
        let_go()

    found = mine.select("y", "__lf_text").mapInArrow(pool, "y int, x binary").toArrow()  # at most one row a sampled document
    shared.destroy()
    rows = sorted(zip(found.column("x").to_pylist(), found.column("y").to_pylist(), strict=True))
    y = np.array([r[1] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return vectors, Constant(0.5 if not len(y) else float(y[0]))
    x = np.array([np.frombuffer(r[0], np.float32) for r in rows], float)
    kept = np.random.default_rng(11).random(len(y)) < 0.2
    if kept.all() or len(set(y[~kept])) < 2 or len(set(y[kept])) < 2:
        kept[:] = False
    net = Network(x.shape[1])
    net.fit(x[~kept], y[~kept])
    if kept.any():
        net.calibrate(x[kept], y[kept])
    return vectors, net


def score(docs: DataFrame, vectors: np.ndarray, net: Network | Constant, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """docs (or its columns ``carry``) with ``quality_score``."""
    spark = docs.sparkSession
    small_batches(spark)
    carry = [c for c in (docs.columns if carry is None else carry) if c != "quality_score"]
    src = docs.select(*carry, F.col(text_col).cast("string").alias("__lf_text"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("quality_score", T.DoubleType())])
    shared, kept = spark.sparkContext.broadcast(vectors), spark.sparkContext.broadcast(net)

    def run(batches):
        words = Words()
        for batch in batches:
            x = pooled(batch.column(batch.num_columns - 1).to_pylist(), words, shared.value)
            p = kept.value.probability(x.astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p, pa.float64())], names=[*batch.schema.names[:-1], "quality_score"])
        del words
        let_go()

    return src.mapInArrow(run, schema)
