"""Queries of the operators on texts: near copies and benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.decontaminate import find_contamination
from millrace.llm.near_copies import near_copies
from millrace.llm.registry import query

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(c.least, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id
"""


@query("op6_near_copies", NEAR_SQL)
def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(words[i:i + 9], ' ') AS phrase
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size),
hits AS (
  SELECT doc_id, i, p.size, item FROM places p JOIN windows w ON w.size = p.size AND w.phrase = array_to_string(p.words[p.i:p.i + p.size - 1], ' ')),
hit_words AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_decontaminate", LEAKS_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["until"] - s["from"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
