"""Toxicity scores behind a noisy-channel deobfuscator.

1. Language model: counts of character triples over all words of all documents, in an
   alphabet of at most 64 symbols (a-z, letters with marks, other letters, word border), so
   the table has at most 64**3 entries whatever the corpus.
2. Channel: a suspicious token (leetspeak, separators between letters, stretched letters, or
   a run of single letters) becomes a lattice whose edges read one or more characters and
   write a letter or nothing, each at a price.  Viterbi over states (last two symbols)
   returns the restored word that the model and the channel together find likeliest.  A token
   with a single path through its lattice is its own restoration and isn't decoded.  A mark may also
   end a word, at a price, so a phrase joined by marks gives its words, whatever its length; in
   a run of single letters a word may end after any letter.
3. Score: features of the restored text are its words and their beginnings.  Those that come
   significantly oftener in toxic than in clean labelled documents (log-likelihood ratio) are
   the lexicon; a small logistic regression on what a document holds of it gives the score.

Labels come from at most ``max_labelled`` rows, those with the smallest hash of their id;
held-out rows are never among them.  Counts of the language model cover every document.

Defined cases
-------------
* null and empty texts: no features; their score is the model's base value, which is under 0.5
  whenever fewer than half of the labelled documents are toxic.
* labels that are null or neither 0 nor 1, and labels of unknown documents, are ignored;
  repeated labels of one id count once (the largest).
* no usable labels, or one class only: every score is 0.0 (no toxic label) or 1.0.
* extra columns pass through ``score`` untouched unless they are named like its results.
* empty tables: an empty result; without documents or labels the scorer is that of no usable labels.
* ties between restorations go to the one that sorts first; repeated rows get equal scores.
* very long texts are read whole, ``BLOCK`` characters at a time; time and memory of a token grow
  with its length, whatever that is.
"""

from __future__ import annotations

import ctypes
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe.plans.lineage import Scratch

# --- alphabet ----------------------------------------------------------------------------

#: 0 is the word border, 1-26 a-z, then letters with marks, the last one every other letter.
_MARKED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + _MARKED
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
OTHER = len(LETTERS) + 1
SIGMA = 64
assert OTHER < SIGMA

# What a character may stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c", "{": "c", "*": "aeiou", "#": "",
}
SEPARATORS = frozenset(" ._-*~·•'`´^/\\,:;=+|")
#: Prices of the channel, as negative natural logarithms.
COST_LEET, COST_DROP_SEPARATOR, COST_DROP_REPEAT, COST_KEEP_ODD, COST_SPLIT = 0.7, 0.3, 0.4, 9.0, 3.0

_TABLE = np.zeros(0x3000, np.uint8)


def _fill_table() -> None:
    for cp in range(len(_TABLE)):
        c = chr(cp).lower()
        if len(c) == 1 and c in CODE:
            _TABLE[cp] = CODE[c]
        elif chr(cp).isalpha():
            _TABLE[cp] = OTHER


_fill_table()


def symbols(text: str) -> np.ndarray:
    """Codes of a text's characters; all that is no letter is a border."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < len(_TABLE), _TABLE[np.minimum(cp, len(_TABLE) - 1)], OTHER).astype(np.int32)


def triple_counts(texts, out: np.ndarray | None = None, block: int = 1 << 20) -> np.ndarray:
    """Counts of symbol triples of texts with borders around each, joined to blocks of about a million characters."""
    out = np.zeros(SIGMA**3, np.int64) if out is None else out

    def add(held):
        joined = "  ".join(["", *held, ""])
        for i in range(2, len(joined), block):  # a block begins with the two symbols its first triple reaches back to
            s = symbols(joined[i - 2 : i + block])
            np.add(out, np.bincount(s[:-2] * SIGMA**2 + s[1:-1] * SIGMA + s[2:], minlength=SIGMA**3), out=out)

    held, size = [], 0
    for t in texts:
        if t:
            held.append(t)
            size += len(t)
            if size >= block:
                add(held)
                held, size = [], 0
    if held:
        add(held)
    return out


class CharModel:
    """Interpolated triple model; cost[a, b, c] = -ln P(c | a, b)."""

    def __init__(self, counts: np.ndarray):
        n3 = counts.reshape(SIGMA, SIGMA, SIGMA).astype(float)
        n3[:, 0, :] = n3[:, 0, :].sum(axis=0)  # what begins a word doesn't depend on the word before
        n3[:, 0, 0] = 0  # runs of borders say nothing
        n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
        p1 = (n1 + 0.5) / (n1.sum() + 0.5 * SIGMA)
        p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
        p3 = (n3 + 10 * p2) / (n3.sum(axis=2, keepdims=True) + 10)
        self.cost = -np.log(p3).astype(np.float32)
        self.table = self.cost.tolist()

    def word_cost(self, word: str) -> float:
        a, b, total = 0, 0, 0.0
        for c in [*(CODE.get(x, OTHER) for x in word), 0]:
            total += self.table[a][b][c]
            a, b = b, c
        return total


# --- lattice and Viterbi --------------------------------------------------------------------


def lattice(token: str, split: bool = False) -> list[list[tuple[int, str, float]]]:
    """Edges (end, output, price) from each position of a lower-case token; with ``split`` a blank for marks that may end a word."""
    n = len(token)
    edges: list[list] = [[] for _ in range(n)]
    run = 0
    for i, c in enumerate(token):
        letter = c.isalpha()
        if run <= i:
            while run < n and token[run] == c:
                run += 1
        if letter:
            edges[i].append((i + 1, c, 0.0))
        for out in LEET.get(c, ""):
            edges[i].append((i + 1, out, COST_LEET))
        if run - i >= 2 and (letter or c in LEET):  # the whole rest of a run as one or two letters
            for out in c if letter else LEET[c]:
                read = 0.0 if letter else COST_LEET * (run - i)
                edges[i].append((run, out, COST_DROP_REPEAT + read))
                if run - i >= 3:
                    edges[i].append((run, out + out, COST_DROP_REPEAT * 1.5 + read))
        if not letter:
            edges[i].append((i + 1, "", COST_DROP_SEPARATOR if c in SEPARATORS or c in LEET and not LEET[c] else COST_KEEP_ODD))
            if split and not c.isalnum():
                edges[i].append((i + 1, " ", COST_SPLIT))
    return edges


def decode(token: str, model: CharModel, split: bool = False, anywhere: bool = False) -> tuple[str, float]:
    """The likeliest word behind a token, or words with blanks between, and its cost; time and memory grow with
    its length.  Words end at marks with ``split``, after any character with ``anywhere``."""
    edges, table = lattice(token, split), model.table
    split = split or anywhere
    best: list = [{} for _ in range(len(token) + 1)]
    best[0][(0, 0)] = (0.0, None)  # the output is a chain of its pieces, the last one first
    for i, out_edges in enumerate(edges):
        if anywhere and i and (ended := [(cost + table[a][b][0] + COST_SPLIT, word) for (a, b), (cost, word) in best[i].items() if b]):
            cost = min(x[0] for x in ended)
            if cost < best[i].get((0, 0), (math.inf,))[0]:
                best[i][(0, 0)] = (cost, (next(w for c, w in ended if c == cost), " "))
        for (a, b), (cost, word) in best[i].items():
            for end, out, price in out_edges:
                if out == " ":
                    x, y = 0, 0
                    total = cost + (price + table[a][b][0] if b else COST_DROP_SEPARATOR)
                else:
                    x, y, total = a, b, cost + price
                    for c in out:
                        k = CODE.get(c, OTHER)
                        total += table[x][y][k]
                        x, y = y, k
                old = best[end].get((x, y))
                if old is None or total < old[0]:
                    best[end][(x, y)] = (total, (word, out) if out and (out != " " or b) else word)
        best[i] = None
    ends = [(cost + (0.0 if split and not b else table[a][b][0]), word) for (a, b), (cost, word) in best[-1].items()]
    cost = min(x[0] for x in ends)
    return min(_chained(word) for total, word in ends if total == cost).strip(), cost


def _chained(word: tuple | None) -> str:
    out = []
    while word:
        word, piece = word
        out.append(piece)
    return "".join(reversed(out))


_EDGE = "\"'()[]{}<>.,;:!?…«»„“”‘’%&#*$|-_ "
_REPEAT = re.compile(r"(.)\1\1|(\w)\2(\w)\3")
_PLAIN = re.compile(r"[^\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


#: Three or more tokens in a row of at most three characters: what may be a word in single letters.
_SHORT_RUN = re.compile(r"\s\S{1,3}(?!\S)(?:\s+\S{1,3}(?!\S)){2,}")
_ODD_START = frozenset("$!|(<{+")
_KNOWN = 200_000
_SPACE = re.compile(r"\s")
BLOCK = 1 << 20


def blocks_of(text: str, size: int = BLOCK) -> Iterator[str]:
    """Pieces of about ``size`` characters; each ends at white space, so no token is cut."""
    start = 0
    while start < len(text):
        end = len(text)
        if start + size < end and (m := _SPACE.search(text, start + size)):
            end = m.end()
        yield text[start:end]
        start = end


class Restorer:
    """Tokens to restored words.  What it has decoded is kept while that is at most ``memory`` characters, and
    up to ``_KNOWN`` words that are written plainly; both only save time."""

    def __init__(self, model: CharModel, memory: int = 4 << 20):
        self.model, self.memory, self.held, self.seen, self.plain = model, memory, 0, {}, set()

    def token(self, raw: str) -> str:
        """Restored word of a white-space token, "" if it holds none; words with blanks between if it is a phrase."""
        word = self.seen.get(raw)
        if word is None:
            word = self._restore(raw)
            self.held += len(raw) + len(word) + 40
            if self.held > self.memory:
                self.seen.clear()
                self.held = len(raw) + len(word) + 40
            self.seen[raw] = word
        return word

    def _is_plain(self, core: str) -> bool:
        """Letters only, nothing stretched or doubled again and again."""
        if core in self.plain:
            return True
        if not core.isalpha() or _REPEAT.search(core):
            return False
        if len(self.plain) >= _KNOWN:
            self.plain.clear()
        self.plain.add(core)
        return True

    def _restore(self, raw: str) -> str:
        low = raw.lower()
        core = low.strip(_EDGE)
        if self._is_plain(core) and low[:1] not in _ODD_START:
            return core
        letters = len(_LETTER.findall(low))
        if not letters and not any(c in LEET for c in core):
            return ""
        left = low.lstrip("\"'[]>.,;:?…«»„“”‘’%&# ").rstrip("\"')]}>.,;:?…«»„“”‘’%&# ")
        found = {decode(x, self.model, split=True) for x in {core, left, left.rstrip("!*$|-_")} if x}
        words = (min(found, key=lambda x: (x[1], x[0]))[0] if found else core).split()
        if len(words) > 1:  # a phrase: its parts count as they are written, too
            words += [w for w in dict.fromkeys(_PLAIN.findall(core)) if len(w) > 2 and w not in words]
        return " ".join(words)

    def text(self, text: str) -> list[str]:
        """Restored words in order, then those of the runs of single letters."""
        return [*(w for part in blocks_of(text) for r in part.split() for w in self.token(r).split(" ")), *self._spaced(text)]

    def counts(self, text: str) -> Counter:
        """How often each restored word comes in a text."""
        raw: Counter = Counter()
        for part in blocks_of(text):
            raw.update(part.lower().split())
        out: dict = {}
        plain, get = self.plain, out.get
        for r, n in raw.items():
            core = r.strip(_EDGE)
            if (core in plain or self._is_plain(core)) and r[0] not in _ODD_START:
                out[core] = get(core, 0) + n
                continue
            for w in self.token(r).split(" "):
                out[w] = get(w, 0) + n
        out = Counter(out)
        out.update(self._spaced(text))
        return out

    def _spaced(self, text: str) -> Iterator[str]:
        """Words of the runs of at least three single letters."""
        for m in _SHORT_RUN.finditer(" " + text):
            letters: list[str] = []
            for raw in [*m[0].split(), ""]:
                if len(raw) == 1 or raw and len(raw.strip(_EDGE)) == 1:
                    letters.append(raw.lower().strip(_EDGE) or raw.lower())
                    continue
                if len(letters) > 2:
                    yield from self._joined("".join(letters))
                letters = []

    def _joined(self, letters: str) -> list[str]:
        """Words of a run of letters: those of its likeliest cut, and the run as one word."""
        found = dict.fromkeys([*decode(letters, self.model, anywhere=True)[0].split(), decode(letters, self.model)[0]])
        return [w for w in found if len(w) > 2]


_TRIM: list = []


def let_go() -> None:
    """Returns a finished task's memory to the system; Python workers live on and are reused."""
    if not _TRIM:
        try:
            _TRIM.append(ctypes.CDLL(None).malloc_trim)
        except (OSError, AttributeError):  # no glibc
            _TRIM.append(lambda _: 0)
    pa.default_memory_pool().release_unused()
    _TRIM[0](0)


# --- features and model --------------------------------------------------------------------

PREFIXES = (4, 5, 6)


def keys_of(word: str) -> list[str]:
    """A word (of at least three letters) and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)] if len(word) > 2 else []


def features(words: Counter) -> Counter:
    """How often each feature comes in a document's words."""
    out: Counter = Counter()
    for w, n in words.items():
        for k in keys_of(w):
            out[k] += n
    return out


class Scorer:
    """Lexicon of features with their log odds by document and by word, and the logistic regression on top."""

    def __init__(self, weights: dict[str, tuple[float, float]], rate: float = 0.0, base: float = 0.0, coef: tuple = (0.0,) * 4):
        self.weights, self.rate, self.base, self.coef = weights, rate, base, coef
        self.starts = frozenset(k[:3] for k in weights)

    def evidence(self, words: Counter) -> tuple[float, float, float, float]:
        """Of a document's words: largest weight, damped sum, damped share of hits, and the log likelihood
        ratio of as many hits (repeats damped) in so many words, squashed."""
        most, total, hits, ratio, known, starts = 0.0, 0.0, 0, 0.0, self.weights, self.starts
        for w in words:
            if w[:3] in starts and (found := [known[k] for k in keys_of(w) if k in known]):
                n, best = words[w], max(found)
                most, total, hits = max(most, best[0]), total + best[0], hits + n
                ratio += (1 + math.log(n)) * best[1]
        n = words.total()
        return most, math.log1p(total), math.sqrt(hits / max(20, n)), 2 * math.tanh((ratio - n * self.rate) / 8)

    def probability(self, words: Counter) -> float:
        z = self.base + sum(c * x for c, x in zip(self.coef, self.evidence(words), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def lexicon(counts, n_toxic: int, n_clean: int, w_toxic: int, w_clean: int, least: int = 3, significance: float = 30.0) -> tuple[dict, float]:
    """Features that speak for toxicity, from counts (feature, toxic and clean documents, toxic and clean hits):
    their log odds by document and by word, and how many more hits a word of a toxic document gives."""
    out, rate = {}, 0.0
    for f, a, b, c, d in counts:
        if a < least:
            continue
        pa_, pb = (a + 0.5) / (n_toxic + 1), (b + 0.5) / (n_clean + 1)
        if pa_ <= 2 * pb:
            continue
        n, both = n_toxic + n_clean, a + b
        g = 2 * (_xlog(a, both * n_toxic / n) + _xlog(b, both * n_clean / n))
        g += 2 * (_xlog(n_toxic - a, (n - both) * n_toxic / n) + _xlog(n_clean - b, (n - both) * n_clean / n))
        if g >= significance:
            ra, rb = (c + 0.5) / (w_toxic + 1), (d + 0.5) / (w_clean + 1)
            out[f] = (math.log(pa_ / pb), math.log(ra / rb))
            rate += max(0.0, ra - rb) * (f[-1] == "$")
    return out, rate


def _xlog(x: float, expected: float) -> float:
    return x * math.log(x / expected) if x > 0 and expected > 0 else 0.0


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Newton steps of a ridge logistic regression with an unpenalised base."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w, r = np.zeros(a.shape[1]), np.diag([0.0] + [ridge * len(x)] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + r
        step = np.linalg.solve(h + 1e-9 * np.eye(len(h)), a.T @ (p - y) + r @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def held_out(id_col) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """The language model of all documents: tasks send their non-zero counts, at most 64**3 each."""

    def count(batches):
        out = np.zeros(SIGMA**3, np.int64)
        for batch in batches:
            triple_counts((t.as_py() for t in batch.column(0)), out)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out[at], pa.int64())], names=["k", "n"])
        let_go()

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIGMA**3, np.int64)
    counts[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    return CharModel(counts)


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """(id, y) of at most max_labelled labelled ids that aren't held out, by the smallest hash."""
    rows = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one = rows.groupBy(F.col(id_col).alias("__lf_id")).agg(F.max(label_col).cast("int").alias("__lf_y"))
    return one.orderBy(F.xxhash64("__lf_id"), "__lf_id").limit(max_labelled)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = 20_000,
) -> tuple[CharModel, Scorer]:
    """The language model of all documents, and the scorer fitted on labelled ones, which are decoded once."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    model = char_model(docs, text_col)
    sample = labelled_sample(labels, id_col, label_col, max_labelled).collect()  # at most max_labelled small rows
    n1 = sum(r["__lf_y"] for r in sample)
    if not 0 < n1 < len(sample):
        return model, Scorer({}, base=30.0 if n1 else -30.0)
    shared = spark.sparkContext.broadcast(model.cost)
    ids = T.StructType([T.StructField("__lf_id", docs.schema[id_col].dataType), T.StructField("y", T.IntegerType())])
    sample_ids = spark.createDataFrame([(r["__lf_id"], r["__lf_y"]) for r in sample], ids)
    mine = docs.select(F.col(id_col).alias("__lf_id"), F.col(text_col).cast("string").alias("__lf_text")).join(F.broadcast(sample_ids), "__lf_id")

    def decoded(batches):
        restore = Restorer(_model_of(shared.value))
        for batch in batches:
            counts = [restore.counts(t.as_py() or "") for t in batch.column(1)]
            cols = [batch.column(0), pa.array(["\n".join(c) for c in counts]), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["y", "words", "n"])
        del restore
        let_go()

    def words_in(batch):
        """(label, word counts) of a batch of decoded documents; a word holds no line break."""
        for y, words, n in zip(*batch.columns, strict=True):
            yield y.as_py(), Counter(dict(zip(words.as_py().split("\n"), n.as_py(), strict=True)) if len(n) else {})

    rows = scratch.cut(mine.select("y", "__lf_text").mapInArrow(decoded, "y int, words string, n array<long>"), "decoded")
    shared.destroy()
    names = ["clean", "toxic", "clean_hits", "toxic_hits"]

    def count(batches):
        """Sums of each feature and, as feature "", of documents and words."""

        def flush(sums):
            if sums:
                cols = [pa.array(c, pa.int64()) for c in zip(*sums.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), *cols], names=["f", *names])

        seen: dict = {}
        for batch in batches:
            for y, words in words_in(batch):
                for f, n in [("", words.total()), *features(words).items()]:
                    sums = seen.setdefault(f, [0, 0, 0, 0])
                    sums[y] += 1
                    sums[y + 2] += n
                if len(seen) > 100_000:
                    yield from flush(seen)
                    seen = {}
        yield from flush(seen)
        del seen
        let_go()

    sums = rows.mapInArrow(count, "f string, " + ", ".join(f"{x} long" for x in names)).groupBy("f").agg(*(F.sum(x).alias(x) for x in names))
    sums = scratch.cut(sums, "features")
    n = sums.where("f = ''").head()
    if n is None or not n["clean"] or not n["toxic"]:
        return model, Scorer({}, base=30.0 if n and n["toxic"] else -30.0)
    # Only features that speak for toxicity by a likelihood ratio reach the driver; the labelled sample bounds them.
    found = (tuple(r) for r in speaking(sums.where("f <> ''"), n["toxic"], n["clean"]).select("f", "toxic", "clean", "toxic_hits", "clean_hits").sort("f").collect())
    scorer = Scorer(*lexicon(found, n["toxic"], n["clean"], n["toxic_hits"], n["clean_hits"]))
    draft = spark.sparkContext.broadcast(scorer)

    def weigh(batches):
        for batch in batches:
            if out := [(y, *draft.value.evidence(words)) for y, words in words_in(batch)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*out, strict=True)], names=["y", "a", "b", "c", "d"])

    seen = rows.mapInArrow(weigh, "y double, a double, b double, c double, d double").toArrow()  # at most a row a sampled document
    seen = np.array(sorted(zip(*(c.to_pylist() for c in seen.columns), strict=True)))
    draft.destroy()
    scratch.drop(rows, sums)
    scorer.base, scorer.coef = fit_logistic(seen[:, 1:], seen[:, 0])
    return model, scorer


def speaking(sums: DataFrame, n_toxic: int, n_clean: int, least: int = 3, significance: float = 30.0) -> DataFrame:
    """The rows that ``lexicon`` takes, chosen before they reach the driver (a little more generously, for rounding)."""
    a, b, n1, n0 = F.col("toxic"), F.col("clean"), F.lit(float(n_toxic)), F.lit(float(n_clean))
    both, n = a + b, n_toxic + n_clean

    def part(x, expected):
        return F.when((x > 0) & (expected > 0), x * F.log(x / expected)).otherwise(F.lit(0.0))

    g = 2 * (part(a, both * n1 / n) + part(b, both * n0 / n) + part(n1 - a, (n - both) * n1 / n) + part(n0 - b, (n - both) * n0 / n))
    return sums.where((a >= least) & ((a + 0.5) / (n1 + 1) > 1.999 * (b + 0.5) / (n0 + 1)) & (g >= significance - 0.001))


def _model_of(cost: np.ndarray) -> CharModel:
    """The model of costs that came by broadcast."""
    m = CharModel.__new__(CharModel)
    m.cost, m.table = cost, cost.tolist()
    return m


def score(
    docs: DataFrame, model: CharModel, scorer: Scorer, text_col: str = "text", carry: list[str] | None = None, restored: bool = False, score_col: str = "toxicity"
) -> DataFrame:
    """docs (or its columns ``carry``) with the score, and the restored words if asked for."""
    spark = docs.sparkSession
    new = [score_col, *["restored"] * restored]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in new]
    src = docs.select(*carry, F.col(text_col).cast("string").alias("__lf_text"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField(score_col, T.DoubleType()), *[T.StructField("restored", T.StringType())] * restored])
    shared, kept = spark.sparkContext.broadcast(model.cost), spark.sparkContext.broadcast(scorer)

    def run(batches):
        restore, s = Restorer(_model_of(shared.value)), kept.value
        for batch in batches:
            p, texts = [], []
            for t in batch.column(batch.num_columns - 1):
                text = t.as_py() or ""
                p.append(s.probability(restore.counts(text)))
                if restored:
                    texts.append(" ".join(w for w in restore.text(text) if w))
            cols = [*batch.columns[:-1], pa.array(p, pa.float64()), *([pa.array(texts, pa.string())] if restored else [])]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], *new])
        del restore
        let_go()

    return src.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """docs without those that score at or over the threshold; columns stay, whatever their names."""
    model, scorer = train(docs, labels, **options)
    return score(docs, model, scorer, score_col="__lf_toxicity").where(F.col("__lf_toxicity") < threshold).select(*docs.columns)
