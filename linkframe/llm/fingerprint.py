"""Document fingerprints by winnowing, with DataFrame functions alone.

A text's k-grams are the runs of k bytes of its UTF-8 form.  Their hash is the CRC-32, a polynomial hash over
GF(2) such as rolling hashes are.  Of each window of w neighbouring k-grams the one of the smallest hash is
kept, the rightmost of equal ones, with its position.  Two texts that share a run of ``k + w - 1`` bytes
therefore keep a k-gram of it in common; a run shorter than k never counts.  The CRC only decides which k-grams
stay; those that do are known by 60 bits of their MD5.

How it runs: a text is cut into pieces of PIECE window starts, each with the bytes that its last window
reaches into.  The minima of all windows of a piece come by doubling (those of 2m k-grams from two of m), as
array functions within the row, so memory beside the text is that of a piece and of what is kept (2 / (w + 1)
of the positions).  Nothing is shuffled for a fingerprint.

Defined cases: a null or empty text has an empty fingerprint; one shorter than k bytes is padded with NUL to a
single k-gram; one of fewer than w k-grams is one window.  Equal texts have equal fingerprints, repeated rows
stay repeated.  Texts of any length are read whole.  Columns of the input stay, whatever their names; empty
tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkframe.plans.lineage import Scratch

#: Window starts a piece; a piece and its overlap have fewer than 2**SHIFT bytes.
PIECE, SHIFT = 512, 12
#: Text bytes that a range of neighbouring documents should have.
RANGE_BYTES = 16 << 20
_ALL = 1 << 30


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _bytes(text: Column, k: int) -> Column:
    """The text's bytes, padded to k of them if there are any."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    short = (F.octet_length(text) > 0) & (F.octet_length(text) < k)
    return F.when(short, F.substring(F.concat(data, F.lit(bytes(k))), 1, k)).otherwise(data)


def _kept(data: Column, at: Column, windows: Column, k: int, w: int) -> Column:
    """What the windows of a piece keep: data from its first k-gram, the text's position ``at``, on."""
    grams = F.sequence(F.lit(1), F.octet_length(data) - F.lit(k - 1))
    # The smallest hash, then the largest position.
    least = F.transform(grams, lambda i: F.shiftleft(F.crc32(F.substring(data, i, F.lit(k))), SHIFT) - i)
    m = 1
    while m < w:  # entries beyond the end are null, which least() passes over
        least = _let(least, (lambda m: lambda x: F.zip_with(x, F.slice(x, m + 1, _ALL), lambda a, b: F.least(a, b)))(m))
        m *= 2

    def named(x: Column) -> Column:
        i = F.pmod(-x, F.lit(1 << SHIFT)).cast("int")
        name = F.conv(F.substring(F.md5(F.substring(data, i, F.lit(k))), 1, 15), 16, 10)
        return F.struct((at + i - 1).cast("int").alias("pos"), name.cast("long").alias("hash"))

    return F.transform(F.array_distinct(F.slice(least, 1, windows)), named)


def _pieces(text: Column, k: int, w: int, first: Column | int = 0) -> Column:
    """What each piece of the text keeps, from piece ``first`` on."""
    reach, first = k + w - 2, F.lit(first) if isinstance(first, int) else first

    def of(data: Column) -> Column:
        size = F.octet_length(data)
        windows = F.greatest(F.lit(1), size - F.lit(reach))
        last = F.floor((windows - 1) / F.lit(PIECE)).cast("int")

        def piece(i: Column) -> Column:
            at = i * F.lit(PIECE)
            return _let(F.substring(data, at + 1, F.lit(PIECE + reach)), lambda x: _kept(x, at, F.least(F.lit(PIECE), windows - at), k, w))

        return F.when((size > 0) & (first <= last), F.transform(F.sequence(first, last), piece)).otherwise(F.array())

    return _let(_bytes(text, k), of)


def _joined(pieces: Column) -> Column:
    """One fingerprint of the pieces; a piece's first window may keep what the last one before it kept."""
    return _let(F.flatten(pieces), lambda x: F.filter(x, lambda e, i: (i == 0) | (e["pos"] != F.get(x, i - 1)["pos"])))


def _checked(k: int, w: int) -> None:
    if not 1 <= k <= 256 or not 1 <= w <= 256 or w & (w - 1):
        raise ValueError("k must be from 1 to 256, and w one of 1, 2, 4, ... 256")


def fingerprint(text: Column, k: int = 16, w: int = 32) -> Column:
    """The fingerprint of a text: array of (pos, hash), by position in bytes."""
    _checked(k, w)
    return _joined(_pieces(text, k, w))


def add_fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint", k: int = 16, w: int = 32) -> DataFrame:
    """docs with their fingerprints."""
    return docs.withColumn(out_col, fingerprint(F.col(text_col), k, w))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 16, w: int = 32) -> DataFrame:
    """(id, pos, hash) rows: what an index of fingerprints holds."""
    rows = docs.select(id_col, F.explode(fingerprint(F.col(text_col), k, w)).alias("__lf_e"))
    return rows.select(id_col, F.col("__lf_e.pos").alias("pos"), F.col("__lf_e.hash").alias("hash"))


def hashes(found: Column) -> Column:
    return F.transform(found, lambda e: e["hash"])


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes of two fingerprints by all of both; 1 for two empty ones."""
    x, y = hashes(a), hashes(b)
    total = F.size(F.array_union(x, y))
    return F.when(total == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / total)


def as_text(found: Column) -> Column:
    """pos:hash entries, the hash in hexadecimal."""
    return F.array_join(F.transform(found, lambda e: F.concat(e["pos"].cast("string"), F.lit(":"), F.hex(e["hash"]))), ",")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """(rows of (id, text) beside those after which they come, columns of the group): the order is by id
    downwards, null ids last, equal ids by a hash of the text.

    Rows are dealt by ranges of that order and written once.  A range also gets the first row of the next
    one (the last range that of the first), marked by ``__lf_guest``, so that each row finds its next one
    in its own range.  No range is larger than the data allow: the text's hash deals out equal ids.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "fingerprint")
    rows = docs.select(F.col(id_col).alias("__lf_id"), F.coalesce(text_col, F.lit("")).alias("__lf_text"))
    size = rows.agg(F.sum(F.octet_length("__lf_text"))).head()[0] or 0
    parts = max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / RANGE_BYTES))
    rows = rows.select("*", F.col("__lf_id").isNull().alias("__lf_none"), F.bitwise_not("__lf_id").alias("__lf_down"), F.xxhash64("__lf_text").alias("__lf_tie"))
    key = ["__lf_none", "__lf_down", "__lf_tie"]
    rows = scratch.cut(rows.repartitionByRange(parts, *key).withColumn("__lf_range", F.spark_partition_id()), "ranges")
    first = rows.groupBy("__lf_range").agg(F.min_by(F.struct("__lf_id", "__lf_text", *key), F.struct(*key)).alias("f"))
    ranges = rows.select("__lf_range").distinct()  # one row a range
    before = F.lag("__lf_range").over(Window.orderBy("__lf_range"))
    ranges = ranges.select("__lf_range", F.coalesce(before, F.max("__lf_range").over(Window.partitionBy())).alias("__lf_host"))
    guests = first.join(ranges, "__lf_range").select("f.*", F.col("__lf_host").alias("__lf_range"), F.lit(True).alias("__lf_guest"))
    both = rows.withColumn("__lf_guest", F.lit(False)).unionByName(guests)
    # A task a range: what follows takes far longer than the exchange, so small ranges aren't put together.
    return both.repartitionByRange(parts, "__lf_range"), ["__lf_guest", *key]


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 16, w: int = 32) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): each text, the text whose
    last half is taken from the beginning of the next document, and how much their fingerprints have in common."""
    _checked(k, w)
    both, order = with_next(docs, id_col, text_col)
    follow = Window.partitionBy("__lf_range").orderBy(*order)
    n = F.length("__lf_text")
    half = F.floor(n / 2).cast("int")
    own = F.substring(F.col("__lf_text"), F.lit(1), n - half)
    edited = F.concat(own, F.substring(F.coalesce(F.lead("__lf_text").over(follow), F.lit("")), F.lit(1), half))
    kept = ["__lf_id", "__lf_range", *order]
    # Pieces that end, with their reach, in the half that stays are the same in both texts.
    same = F.greatest(F.lit(0), F.floor((F.octet_length(own) - F.lit(k + w - 2)) / F.lit(PIECE)).cast("int"))
    two = both.select(*kept, n.cast("long").alias("n_chars"), "__lf_text", edited.alias("__lf_edited"), same.alias("__lf_same"))
    two = two.select(*kept, "n_chars", F.sha2("__lf_edited", 256).alias("edited_sha256"), "__lf_edited", "__lf_same", _pieces(F.col("__lf_text"), k, w).alias("__lf_pieces"))
    rest = F.concat(F.slice("__lf_pieces", F.lit(1), F.col("__lf_same")), _pieces(F.col("__lf_edited"), k, w, F.col("__lf_same")))
    made = two.select(*kept, "n_chars", "edited_sha256", _joined(F.col("__lf_pieces")).alias("__lf_own"), _joined(rest).alias("__lf_other"))
    seen = made.withColumn("__lf_next", F.lead("__lf_own").over(follow)).where("NOT __lf_guest")
    return seen.select(
        F.col("__lf_id").alias(id_col), "n_chars", "edited_sha256", as_text(F.col("__lf_own")).alias("fingerprint"), as_text(F.col("__lf_other")).alias("edited_fingerprint"),
        likeness(F.col("__lf_own"), F.col("__lf_other")).alias("near_edited"), likeness(F.col("__lf_own"), F.col("__lf_next")).alias("near_next"),
    )
