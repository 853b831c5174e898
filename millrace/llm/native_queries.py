"""Queries of the operators that use DataFrame functions only: mixing, URL rules, secrets."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, secrets
from millrace.llm.common import save, table
from millrace.llm.registry import query
from millrace.llm.url_filter import judge_urls

MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, coalesce('=' || source, '') AS key, source_size, CAST(2 AS DOUBLE) * source_size AS cap,
    CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM s),
l AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(cap, coalesce(weight *
    (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, key LIMIT 1), cap)) AS target FROM l),
m AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * (CASE WHEN middle <= target THEN 1 ELSE 0 END + CASE WHEN source_size + middle <= target THEN 1 ELSE 0 END) AS taken
FROM m
"""


def mix_rows(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """What the mix needs of documents: id, source key, source, words and place."""
    return docs.select(
        "doc_id", mixing.source_key(F.col("source")).alias("key"), "source", mixing.words(F.col("text")).alias("size"),
        mixing.place(F.col("doc_id"), seed).alias("at"),
    )


@query("op7_mix_sources", MIX_SQL)
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = save(mix_rows(table(spark, sf_dir, "documents")), "mix-rows")
    plan = mixing.mix_sources(rows).plan(rows.drop("source"), F.col("key"), F.col("at"))
    return plan.select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("size") * F.size("mix_shards")).alias("taken"),
    )


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_HOST = rf"translate(regexp_extract({{0}}, '(?s)^.*?://([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_PATH = r"regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_NODE = f"CASE WHEN instr({{0}}, '://') > 0 THEN {_HOST} || {_PATH} || regexp_extract({{0}}, '(?s)^.*?://[^?#]*(\\?[^#]*)', 1) END"
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

URL_SQL = f"""
WITH RECURSIVE p AS (
  SELECT page_id, url, nullif(regexp_extract(html, '(?is)<link\\b[^>]*\\brel="?canonical\\b[^>]*?\\bhref="([^"]+)"', 1), '') AS link FROM pages),
u AS (SELECT DISTINCT url FROM p UNION SELECT DISTINCT link FROM p WHERE link IS NOT NULL),
n AS (
  SELECT url, coalesce({_HOST.format("url")}, '') AS host, coalesce({_PATH.format("url")}, '') AS path, {_NODE.format("url")} AS node FROM u),
rules AS (SELECT * FROM (VALUES {_RULES}) AS v(verdict, rule_host, rule_path)),
j AS (
  SELECT n.*, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS own
  FROM n LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL),
e AS (SELECT DISTINCT {_NODE.format("url")} AS a, {_NODE.format("link")} AS b FROM p WHERE link IS NOT NULL),
both_ways AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
passed AS (SELECT r.a AS node, min(j.own) AS verdict FROM reach r JOIN j ON j.node = r.b GROUP BY r.a)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule, coalesce(j.own, passed.verdict, 'allow') AS verdict
FROM p LEFT JOIN j ON p.url = j.url LEFT JOIN passed ON passed.node = j.node
"""


@query("op8_url_filter", URL_SQL)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )
