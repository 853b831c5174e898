"""URL rules that reach aliases: redirects and canonical links make URLs equivalent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, save
from millrace.llm.components import components

#: A rule: its verdict (allow or block), host and path.
Rule = tuple[str, str, str]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL without scheme and fragment; null if there is no ``://``."""
    query = F.coalesce(F.regexp_extract(url, _URL, 3), F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), query))


def _without_dots(path: Column) -> Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array(F.lit("")),
        lambda done, part: F.when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done))
        .when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    return F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def _resolved(href: Column, url: Column) -> Column:
    """The absolute URL that a reference on a page means; null for other schemes, and if the page has no host."""
    path, folder = path_of(url), F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    own, rest = F.regexp_extract(href, r"(?s)^([^?#]*)", 1), F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    named = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
    base = F.when(F.instr(url, "://") > 0, F.concat(F.lit("http://"), host_of(url)))
    query = F.when(href.startswith("#"), F.regexp_extract(url, _URL, 3)).otherwise(F.lit(""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(F.lit("http:"), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(own == "", F.concat(base, path, query, rest))
        .otherwise(F.concat(base, _without_dots(named), rest))
    )


def link_targets(html: Column, url: Column) -> Column:
    """The absolute URLs that a page's canonical links and meta refreshes name, each once."""
    none = F.array().cast("array<string>")
    named = F.when(F.instr(F.lower(html), "canonical") > 0, F.regexp_extract_all(html, F.lit(_LINK), F.lit(1)))
    moved = F.when(F.instr(F.lower(html), "http-equiv") > 0, F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(1)))
    hrefs = F.concat(F.coalesce(named, none), F.coalesce(moved, none))
    found = F.transform(hrefs, lambda href: _resolved(F.regexp_replace(href, r"(?i)&(amp|#0*38|#x0*26);", "&"), url))
    return F.array_distinct(F.filter(found, lambda u: u.isNotNull()))


def _rules_by_host(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Of each host the rules that fit it, whatever the path: an equi-join on its suffixes."""
    spark = hosts.sparkSession
    rows = [(host, path, host + path, verdict, len(host + path), int(verdict == "allow")) for verdict, host, path in rules]
    known = spark.createDataFrame(rows, "suffix string, rule_path string, rule string, verdict string, size int, allows int")
    labels = F.split("host", r"\.")
    suffix = F.explode(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    fits = hosts.select("host", suffix.alias("suffix")).join(known, "suffix")
    return fits.groupBy("host").agg(F.collect_list(F.struct("size", "allows", "rule", "verdict", "rule_path")).alias("rules"))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url: str = "url", html: str | None = "html",
    key: str = "page_id", default: str = "allow",
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the URL's path starts with the rule's path; the
    longest rule (host and path) wins, allow before block among equal ones. A URL without a rule
    follows its aliases: URLs joined by redirects (``redirects``: columns ``source``, ``target``)
    or by a page's canonical links and meta refreshes, all of them, are equivalent, through any number of steps. An
    alias that a rule allows allows it, else an alias that a rule blocks blocks it, else the
    default holds. A URL's own rule always holds.

    Nulls, empty texts and URLs without ``://`` have empty host and path, no rule and no aliases,
    so they get the default. Repeated rows are judged alike, one row each. Other columns of the
    pages are left out, whatever their names. Empty tables give no rows.
    """
    # The page's text is read once; all later steps work on URLs only.
    targets = link_targets(F.col(html), F.col(url)) if html else F.array().cast("array<string>")
    slim = save(
        pages.select(F.col(key).alias("page"), F.col(url).alias("url"), targets.alias("targets")).select(
            "page", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"), "targets",
        ),
        "pages",
    )
    links = slim.select("node", F.explode("targets").alias("target"))
    nodes = slim.where("node is not null").select("node", "host", "path").union(
        links.select(node_of(F.col("target")), host_of(F.col("target")), path_of(F.col("target")))
    )
    edges = links.select(F.col("node").alias("a"), node_of(F.col("target")).alias("b"))
    if redirects is not None:
        ends = redirects.select(F.col("source").alias("source"), F.col("target").alias("target"))
        for end in ("source", "target"):
            nodes = nodes.union(ends.select(node_of(F.col(end)), host_of(F.col(end)), path_of(F.col(end))).where(f"{end} is not null"))
        edges = edges.union(ends.select(node_of(F.col("source")), node_of(F.col("target"))))
    nodes = nodes.where("node is not null").distinct()

    by_host = save(_rules_by_host(nodes.select("host").distinct(), rules), "rules")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    judged = nodes.join(by_host, "host", "left").select("node", F.array_max(fitting).alias("best"))
    judged = save(judged.select("node", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")), "nodes")

    groups = save(components(edges.where("a is not null and b is not null")), "groups")
    members = groups.join(judged.where("verdict is not null"), "node").groupBy("component")
    decided = members.agg(F.min("verdict").alias("passed"))  # "allow" sorts before "block"
    aliases = groups.join(decided, "component").select("node", "passed")
    verdicts = judged.join(aliases, "node", "left").select("node", "rule", "verdict", "passed")
    return (
        slim.join(verdicts, "node", "left")
        .select(
            F.col("page").alias(key), "host", "path", "rule", F.coalesce("verdict", "passed", F.lit(default)).alias("verdict")
        )
    )
