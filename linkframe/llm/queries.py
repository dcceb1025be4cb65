"""Queries and SQL of the pipeline operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkframe.llm import arc_to_warc, decontamination, fingerprint, html_content, impact_index, license_scan, mixing, quality, sharding, signature_join, spelling, topk_search, toxicity

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc.archive_pages(table(spark, sf_dir, "pages")).select(
        F.col("seq").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM (SELECT page_id, CAST(octet_length(CAST(encode(coalesce(html, '')) AS BLOB)) AS BIGINT) AS payload_bytes,
             sha1(coalesce(html, '')) AS payload_digest,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
      FROM pages)
"""


MIX_WEIGHTS = {0: {"d0": 4, "d1": 2}, 1: {"en": 4, "de": 2, "fr": 2}}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, budget_share=0.6, max_epochs=2, seed=1, report=True)
    return out.withColumn("leaf_budget", F.round("leaf_budget", 3))


def _fill(name: str, source: str, parent: list[str], child: str, weight: str) -> str:
    """Water filling of source (parent columns, child, cap, budget) as CTEs name_r and name."""
    by, cols = f"PARTITION BY {', '.join(parent)}" if parent else "", ", ".join([*parent, child])
    return f"""
{name}_w AS (SELECT *, {weight} AS w, cap / {weight} AS ratio FROM {source} WHERE cap > 0),
{name}_r AS (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY ratio, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    + ratio * sum(w) OVER ({by} ORDER BY ratio, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= budget AS is_full FROM {name}_w),
{name} AS (SELECT {cols}, cap, CASE WHEN is_full THEN cap ELSE w * (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0))
                    / sum(CASE WHEN NOT is_full THEN w END) OVER ({by}) END AS alloc FROM {name}_r)"""


OP2_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other'
            ELSE 'd' || CAST(CAST(right(regexp_extract(source, '([0-9]+)$', 1), 2) AS INTEGER) % 4 AS VARCHAR) END AS domain,
       CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, CAST(sum(n_tokens) AS DOUBLE) * 2 AS cap FROM t GROUP BY ALL),
l1 AS (SELECT domain, sum(cap) AS cap, (SELECT 0.6 * sum(n_tokens) FROM t) AS budget FROM leaf GROUP BY domain),
{_fill("f1", "l1", [], "domain", "CASE domain WHEN 'd0' THEN 4.0 WHEN 'd1' THEN 2.0 ELSE 1.0 END")},
l2 AS (SELECT domain, lang, sum(leaf.cap) AS cap, any_value(alloc) AS budget FROM leaf JOIN f1 USING (domain) GROUP BY domain, lang),
{_fill("f2", "l2", ["domain"], "lang", "CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END")},
l3 AS (SELECT domain, lang, source, leaf.cap, alloc AS budget FROM leaf JOIN f2 USING (domain, lang)),
{_fill("f3", "l3", ["domain", "lang"], "source", "1.0")},
p AS (SELECT f3.*, tokens, CAST(least(floor(alloc / tokens), 2) AS INTEGER) AS epochs, alloc - least(floor(alloc / tokens), 2) * tokens AS rest
      FROM f3 JOIN leaf USING (domain, lang, source)),
k AS (SELECT t.*, p.alloc, p.epochs, p.rest, sum(n_tokens) OVER (PARTITION BY t.domain, t.lang, t.source
             ORDER BY md5('1-' || epochs || '-' || doc_id)) AS upto FROM t JOIN p USING (domain, lang, source)),
n AS (SELECT *, epochs + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END AS times FROM k)
SELECT doc_id, domain, lang, source, n_tokens, round(alloc, 3) AS leaf_budget, CAST(unnest(range(0, times)) AS INTEGER) AS epoch FROM n
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, scorer, carry=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(50)) == 0, k=5, scale=256.0)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op5_bounded_load_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents"), shards=8, carry=["doc_id"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vectors, net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, vectors, net, carry=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.classes(table(spark, sf_dir, "documents"), k=5, percent=75)


OP7_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, list_slice(w, i, i + least(5, len(w)) - 1) AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM docs d LEFT JOIN n USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""


def op8_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


_W9 = "regexp_extract_all(" + LOWER.format("text") + ", '[a-z0-9]+')"
_T9 = ", ".join(
    "({}, {}, {})".format(*("'" + x.replace("'", "''") + "'" for x in (k, v, license_scan.IDENTITY.get(k, "")))) for k, v in license_scan.TEMPLATES.items()
)
_P9 = _W9.replace("text", "part")
OP9_SQL = f"""
WITH t AS (SELECT license, {_W9} AS w, {_P9} AS p FROM (VALUES {_T9}) AS v(license, text, part)),
ps AS (SELECT DISTINCT license, array_to_string(list_slice(p, i, i + 2), ' ') AS s
       FROM (SELECT *, unnest(range(1, len(p) - 1)) AS i FROM t)),
ts AS (SELECT DISTINCT license, len(w) AS m, array_to_string(list_slice(w, i, i + 2), ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM t)),
known AS (SELECT license, count(*) AS n, count(ps.s) AS must FROM ts LEFT JOIN ps USING (license, s) GROUP BY license),
ds AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT doc_id, {_W9} AS w FROM documents WHERE text IS NOT NULL))),
hit AS (SELECT doc_id, license, m, i, s, ps.s AS part FROM ds JOIN ts USING (s) LEFT JOIN ps USING (license, s)),
run AS (SELECT a.doc_id, a.license, a.i, count(DISTINCT b.s) AS c, count(DISTINCT b.part) AS held
        FROM hit a JOIN hit b ON a.doc_id = b.doc_id AND a.license = b.license AND b.i BETWEEN a.i AND a.i + a.m - 3 GROUP BY 1, 2, 3)
SELECT doc_id, license, max(c / n) AS containment FROM run JOIN known USING (license) WHERE c / n >= 0.8 AND held = must GROUP BY 1, 2
"""


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_W10 = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_W10} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win, least(10, len(w)) AS size
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_W10} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, i, size, list_slice(w, i, i + size - 1) AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT d.doc_id, d.i, d.size, iw.item_id FROM dw d JOIN iw ON iw.size = d.size AND iw.win = d.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS l
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(table(spark, sf_dir, "documents"), k=16, w=32)


_ZERO = zlib.crc32(bytes(16))
#: What byte b at place j of a 16-gram adds (XOR) to the CRC-32 of 16 NULs.
_TABLES = [[zlib.crc32(bytes(j) + bytes((b,)) + bytes(15 - j)) ^ _ZERO for b in range(256)] for j in range(16)]
_CRC = str(_ZERO)
for _j, _t in enumerate(_TABLES):
    _CRC = f"xor({_CRC}, list_extract({_t}::BIGINT[], lead(b, {_j}, 0) OVER o + 1))"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS after,
           coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id FROM documents WINDOW o AS (ORDER BY doc_id DESC)),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(after, 1, n // 2) AS edited FROM d),
t AS (SELECT doc_id, kind, CASE WHEN t = '' THEN '' ELSE rpad(hex(t), CAST(greatest(32, length(hex(t))) AS INTEGER), '0') END AS t
      FROM (SELECT doc_id, 0 AS kind, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e)),
c AS (SELECT doc_id, kind, length(t) // 2 AS n, CAST('0x' || unnest(regexp_extract_all(t, '..')) AS BIGINT) AS b, unnest(range(0, length(t) // 2)) AS pos FROM t WHERE t <> ''),
g AS (SELECT doc_id, kind, n, pos, {_CRC} AS h FROM c WINDOW o AS (PARTITION BY doc_id, kind ORDER BY pos)),
m AS (SELECT doc_id, kind, n, pos, min(CAST(h AS HUGEINT) * 4294967296 + (4294967295 - pos)) OVER (PARTITION BY doc_id, kind ORDER BY pos ROWS BETWEEN CURRENT ROW AND 31 FOLLOWING) AS least
      FROM g WHERE pos <= n - 16),
k AS (SELECT DISTINCT doc_id, kind, 4294967295 - least % 4294967296 AS pos FROM m WHERE pos < greatest(1, n - 46)),
x AS (SELECT doc_id, kind, pos, upper(ltrim(substr(md5(unhex(substr(t, CAST(2 * pos + 1 AS BIGINT), 32))), 1, 15), '0')) AS hash FROM k JOIN t USING (doc_id, kind)),
f AS (SELECT doc_id, kind, string_agg(pos || ':' || hash, ',' ORDER BY pos) AS f, list(DISTINCT hash) AS s FROM x GROUP BY doc_id, kind)
SELECT e.doc_id, n AS n_chars, sha256(edited) AS edited_sha256, coalesce(a.f, '') AS fingerprint, coalesce(b.f, '') AS edited_fingerprint,
       CASE WHEN a.s IS NULL AND b.s IS NULL THEN 1.0::DOUBLE WHEN a.s IS NULL OR b.s IS NULL THEN 0.0
            ELSE len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) END AS near_edited,
       CASE WHEN a.s IS NULL AND c.s IS NULL THEN 1.0::DOUBLE WHEN a.s IS NULL OR c.s IS NULL THEN 0.0
            ELSE len(list_intersect(a.s, c.s)) / (len(a.s) + len(c.s) - len(list_intersect(a.s, c.s))) END AS near_next
FROM e LEFT JOIN f a ON a.doc_id = e.doc_id AND a.kind = 0 LEFT JOIN f b ON b.doc_id = e.doc_id AND b.kind = 1
LEFT JOIN f c ON c.doc_id = e.next_id AND c.kind = 0
"""


def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = impact_index.build(table(spark, sf_dir, "documents"))
    return impact_index.search(index, table(spark, sf_dir, "benchmark"), k=20)


_W12 = "regexp_extract_all(" + LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_W12}) AS term FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM len),
df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, docs),
m AS (SELECT doc_id, 75 + (25 * n * docs) // total AS m FROM len, c),
q AS (SELECT item_id, unnest({_W12}) AS term FROM benchmark WHERE text IS NOT NULL),
qc AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM qc JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-z\u00C0-\u00FF]+')) AS run
         FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
h AS (SELECT run, n, length(run) AS size, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id || ':' || run, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8))) AS h FROM runs, tab),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n
          FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word FROM h)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
          UNION SELECT word, short FROM cut WHERE short IN (SELECT word FROM words)
          UNION SELECT short, word FROM cut WHERE short IN (SELECT word FROM words)),
best AS (SELECT p.word, count(*) AS n_near, arg_min(w.word, (-w.n, w.word)) AS near, max(w.n) AS near_n FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root FROM forms UNION ALL SELECT w.word, f.form FROM way w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.root FROM way w JOIN forms f ON f.word = w.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_arc_to_warc": op1_arc_to_warc,
        "op2_mixing": op2_mixing,
        "op3_toxicity": op3_toxicity,
        "op4_topk_search": op4_topk_search,
        "op5_bounded_load_sharding": op5_bounded_load_sharding,
        "op6_quality": op6_quality,
        "op7_signature_join": op7_signature_join,
        "op8_html_content": op8_html_content,
        "op9_license_scan": op9_license_scan,
        "op10_benchmark_decontamination": op10_benchmark_decontamination,
        "op11_winnowing": op11_winnowing,
        "op12_impact_search": op12_impact_search,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_arc_to_warc": OP1_SQL,
        "op2_mixing": OP2_SQL,
        "op4_topk_search": OP4_SQL,
        "op7_signature_join": OP7_SQL,
        "op9_license_scan": OP9_SQL,
        "op10_benchmark_decontamination": OP10_SQL,
        "op11_winnowing": OP11_SQL,
        "op12_impact_search": OP12_SQL,
        "op13_spelling_variants": OP13_SQL,
    }
