"""Queries of periodic runs, hard negatives and licenses."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.licenses import GRAM, NOTICES, PHRASES, WORD, find_licenses
from millrace.llm.negatives import mine_negatives
from millrace.llm.periodic import find_runs
from millrace.llm.registry import query

_SPLIT = r"[^\x20\x09-\x0D]+"


def with_planted_period(text: Column, doc_id: Column) -> Column:
    """The text whose words from one on repeat a stretch of it, in the tenth of all ids that a
    checksum chooses; the others, and rows without an id, as they are."""
    chosen = F.crc32(doc_id.cast("string"))
    g = F.floor(chosen / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        period = F.slice(words, a + 1, p)
        tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    def of_words(words: Column) -> Column:
        return F.when(F.size(words) > 0, planted(words)).otherwise(text)

    changed = F.transform(F.array(F.regexp_extract_all(text, F.lit(_SPLIT), F.lit(0))), of_words)[0]
    return F.when((chosen % 10 == 0) & text.isNotNull(), changed).otherwise(text)


_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""

RUNS_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPLIT}') AS words, {_CRC} AS h FROM documents),
c AS (SELECT *, len(words) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN [words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)]
    ELSE words END AS words FROM p),
x AS (SELECT r, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
m AS (
  SELECT a.r, a.i, b.i - a.i AS q FROM x a JOIN x b ON a.r = b.r AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
g AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
s AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM s WHERE NOT EXISTS (
    FROM s t WHERE t.r = s.r AND t.q < s.q AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / q DESC, start, q) = 1),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM x ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


@query("op11_periodic_runs", RUNS_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", with_planted_period(F.col("text"), F.col("doc_id")).alias("text")))

    def better(best: Column, run: Column) -> Column:
        higher = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(higher, run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id AND len(a.e) = len(b.e)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other NULLS LAST) AS nth FROM s WHERE same QUALIFY nth <= 5)
SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.nth ORDER BY n.score DESC, n.other NULLS LAST) AS INTEGER) AS rank
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vec_id, label = table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("label")
    moved = rows.withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine_negatives(moved, vec_id % 100 == 0)


_TEMPLATES = ", ".join(f"({n}, '{t.label}', {t.exact}, {t.percent}, '{t.text}')" for n, t in enumerate([*PHRASES, *NOTICES]))
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}')"

LICENSES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
t AS (
  SELECT template, label, exact, percent, words, len(words) AS size, least({GRAM}, len(words)) AS k,
    CASE WHEN exact THEN 0 ELSE greatest(1, len(words) // 8) END AS width
  FROM (SELECT *, {_WORDS} AS words FROM (VALUES {_TEMPLATES}) AS v(template, label, exact, percent, text))),
tg AS (SELECT * EXCLUDE (words), array_to_string(words[t_at + 1:t_at + k], ' ') AS gram FROM (SELECT *, unnest(range(size - k + 1)) AS t_at FROM t)),
dg AS (
  SELECT r, k, pos, array_to_string(words[pos + 1:pos + k], ' ') AS gram
  FROM (SELECT r, words, k, unnest(range(len(words) - k + 1)) AS pos FROM d, (SELECT DISTINCT k FROM t))),
h AS (SELECT r, pos, tg.* FROM dg JOIN tg ON dg.k = tg.k AND dg.gram = tg.gram),
b AS (
  SELECT *, unnest(CASE WHEN width = 0 THEN [pos - t_at] ELSE [CAST(floor((pos - t_at) / width) AS BIGINT), CAST(floor((pos - t_at) / width) AS BIGINT) - 1] END)
    AS bucket FROM h),
c AS (
  SELECT r, template, label, exact, bucket, min(pos) AS starts, max(pos) + any_value(k) AS ends, count(DISTINCT word) AS covered, any_value(size) AS size
  FROM (SELECT *, unnest(range(t_at, t_at + k)) AS word FROM b) GROUP BY r, template, label, exact, percent, bucket
  HAVING CASE WHEN exact THEN count(DISTINCT word) = any_value(size) ELSE 100 * count(DISTINCT word) >= percent * any_value(size) END),
m AS (
  SELECT * FROM c WHERE exact OR NOT EXISTS (
    FROM c o WHERE o.r = c.r AND NOT o.exact AND o.starts < c.ends AND c.starts < o.ends
      AND (o.covered > c.covered OR (o.covered = c.covered AND (o.template < c.template OR (o.template = c.template AND o.bucket < c.bucket)))))),
s AS (
  SELECT r, count(*) FILTER (exact) AS n_base, min(starts) FILTER (exact) AS first_word, max(starts) FILTER (exact) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(covered / size) AS score
  FROM m GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN s USING (r)
"""


@query("op13_license_scan", LICENSES_SQL)
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = [*PHRASES, *NOTICES]
    found = find_licenses(table(spark, sf_dir, "documents"), templates)
    base = F.filter("matches", lambda m: m["exact"])
    starts = F.transform(base, lambda m: m["from"].cast("long"))
    names = F.array(*[F.lit(t.label) for t in templates])

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: F.get(names, m["template"])))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )
