"""Secret scans: patterns that stand alone, and weak parts that count only beside their complement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import save

#: The base kinds in the order in which equal starts are listed, with their patterns (fixed values).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: What follows "AKIA" or a hex digit is one run, so a lower bound on the run drops the short matches.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")
#: Weak parts: a 40-character key that says nothing alone, and the endpoint and identifier it may belong to.
WEAK = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]{0,39}[0-9+/])(?=[A-Za-z0-9+/]{0,39}[A-Za-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?i:https?|s3|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@/-]+"
IDENTIFIER = (
    r"""(?<![A-Za-z0-9_])(?i:client_?id|user_?name|user|login|access_?key_?id)["']?\x20*[:=]\x20*["']?(?!AKIA)[A-Za-z0-9._@+-]{3,}"""
    r"|(?<![A-Z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{16,}"
)
#: Code points around a part within which its complement has to begin.
SCOPE = 400

_SPANS = "array<struct<from:bigint,until:bigint,text:string>>"


def spans(text: Column, pattern: str) -> Column:
    """``(from, until, text)`` of a pattern's leftmost matches, in code points, as native expressions.

    The pieces between the matches and the matches themselves, in turn, make up the text; their
    lengths give the places. Texts without a match are only searched once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(between.alias("gap"), found.alias("hit"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        until = begin + F.length(pair["hit"])
        one = F.struct(begin.cast("long").alias("from"), until.cast("long").alias("until"), pair["hit"].alias("text"))
        return F.struct(until.cast("long").alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    walked = F.aggregate(F.slice(pairs, 1, F.size(found)), start, step, lambda s: s["out"])
    return F.when(F.regexp(text, F.lit(pattern)), walked).otherwise(F.array().cast(_SPANS))


def listed(parts: Column) -> Column:
    """``kind:from:until`` by start, then by the order of kinds, comma-joined; parts: (from, nth, until, kind)."""
    return F.array_join(
        F.transform(F.array_sort(parts), lambda p: F.concat_ws(":", p["kind"], p["from"].cast("string"), p["until"].cast("string"))), ","
    )


def _named(found: Column, nth: int, kind: str) -> Column:
    return F.transform(
        found, lambda s: F.struct(s["from"].alias("from"), F.lit(nth).alias("nth"), s["until"].alias("until"), F.lit(kind).alias("kind"))
    )


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: ``key``, ``base`` and ``spans``, arrays of ``(from, nth, until, kind)``, ends exclusive.

    Base kinds are reported wherever they match. Weak parts are reported only beside their complement,
    which has to begin within ``scope`` code points: a weak ``key`` (40 base64 characters) beside an
    identifier (``access`` or a weak one) or an endpoint; a weak ``identifier`` (a named client, user or
    key id, or a temporary access identifier) and an ``endpoint`` beside a secret (``assign`` or a weak
    key). Parts are interval-joined by text and scope cell: complements are spread over the cells that
    their scope touches, the weak parts look into their own cell by semi-joins, so no pairs are made,
    however many parts a text holds.

    Every text with a weak part, a secret and something that goes with a secret enters the joins, keyed
    by a digest of the text, one for each different text; the wide scan is written once and holds no
    text. Null texts are empty texts and have no spans. Repeated rows and ids give a row each. Other
    columns are left out; very long texts are searched whole.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    assign = F.filter(
        spans(F.col("body"), ASSIGN), lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 1)) >= 6
    )
    scans = [("access", ACCESS), ("hex", HEX), ("key", WEAK), ("endpoint", ENDPOINT), ("identifier", IDENTIFIER)]
    rows = rows.select(
        "key", "body", _named(assign, 0, "assign").alias("assign"),
        *[_named(spans(F.col("body"), pattern), nth, kind).alias(kind if kind != "key" else "weak") for nth, (kind, pattern) in enumerate(scans, 1)],
    )

    def found(*columns: str) -> Column:
        return sum((F.size(c) for c in columns), F.lit(0)) > 0

    paired = found("weak", "endpoint", "identifier") & found("assign", "weak") & found("access", "identifier", "endpoint")
    # The others get a key of their own, so that they are spread where rows meet their linked spans.
    digest = F.when(paired, F.md5("body")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id()))
    scanned = save(rows.select("*", digest.alias("digest"), paired.alias("paired")).drop("body"), "secrets")

    parts = ("assign", "access", "weak", "endpoint", "identifier")
    texts = scanned.where("paired").groupBy("digest").agg(*[F.any_value(c).alias(c) for c in parts])

    def rows_of(column: str) -> DataFrame:
        return texts.select("digest", F.explode(column).alias("part")).select(
            "digest", "part", F.col("part.from").alias("at"), F.expr(f"part.from div {scope}").alias("cell")
        )

    def in_scope(column: str) -> DataFrame:
        near = F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1))
        return rows_of(column).select("digest", F.col("at").alias("other"), near.alias("cell"))

    def beside(parts: DataFrame, others: DataFrame) -> DataFrame:
        a, b = parts.alias("a"), others.alias("b")
        near = F.abs(F.col("a.at") - F.col("b.other")) <= scope
        return a.join(b, (F.col("a.digest") == F.col("b.digest")) & (F.col("a.cell") == F.col("b.cell")) & near, "left_semi")

    secrets = in_scope("assign").union(in_scope("weak"))
    owners = in_scope("access").union(in_scope("identifier")).union(in_scope("endpoint"))
    weak = beside(rows_of("weak"), owners).union(beside(rows_of("endpoint").union(rows_of("identifier")), secrets))
    linked = weak.groupBy("digest").agg(F.collect_list("part").alias("linked"))
    base = F.concat("assign", "access", "hex")
    everything = F.when(F.col("linked").isNull(), base).otherwise(F.concat(base, "linked"))
    return scanned.join(linked, "digest", "left").select(
        F.col("key").alias(key), F.col("assign"), F.col("access"), F.col("hex"), base.alias("base"), everything.alias("spans")
    )
