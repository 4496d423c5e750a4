"""URL rules with redirect equivalence.

URLs that redirect to each other, or name each other in a canonical link, are aliases: the connected components over those
edges are found by distributed joins (:mod:`components`). A page is judged by the longest rule that fits its own URL. A
page without a rule takes a block from any alias that is blocked, unless an alias is explicitly allowed: an explicit allow
takes precedence over a block that comes through an alias, never over the page's own rule.

Rules and edges are tables of any size; Spark broadcasts them only below its own size threshold.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.functions.markup import html_unescape
from passagemill.llm.components import connected_components
from passagemill.llm.shared import store

RULE_SCHEMA = "action string, host string, path string"
_AUTHORITY_AND_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A link tag whose rel has canonical among its words, quoted or alone.
_CANONICAL = r"""(?is)^<link\b.*\brel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical(?=[\s/>]))"""
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _part(url: Column, pattern: str, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(_part(url, _AUTHORITY_AND_PATH, 1), ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return _part(url, _AUTHORITY_AND_PATH, 2)


def url_node(url: Column) -> Column:
    """The resource that a URL names: scheme and host in lower case, no fragment, ``/`` for an empty path. Null without ``://``."""
    scheme = F.lower(_part(url, r"(?s)^(.*?)://", 1))
    path = url_path(url)
    query = _part(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    whole = F.concat(scheme, F.lit("://"), url_host(url), F.when(path == "", "/").otherwise(path), query)
    return F.when(F.contains(url, F.lit("://")), whole)


def resolve(base: Column, href: Column) -> Column:
    """An absolute URL for ``href`` found on the page ``base``; null for an empty one."""
    scheme = _part(base, r"(?s)^(.*?)://", 1)
    origin = F.concat(scheme, F.lit("://"), url_host(base))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    return (
        F.when(href == "", None)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?") | href.startswith("#"), F.concat(origin, url_path(base), href))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), href))
    )


def html_edges(pages: DataFrame) -> DataFrame:
    """(a, b): each page's node and the target of its canonical links and refresh redirects. Needs url and html.

    Tags may span lines, canonical may stand anywhere in rel, and entities in href and content are decoded.
    """
    telling = pages.where(F.col("html").rlike("(?i)canonical|http-equiv") & F.contains("url", F.lit("://")))
    tag = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag")
    quotes = F.lit("\"'")
    canonical = F.col("tag").rlike(_CANONICAL)
    refresh = F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b""")
    tags = telling.select("url", tag).select("url", "tag", canonical.alias("canonical"), refresh.alias("refresh"))
    href = F.btrim(F.regexp_extract("tag", r"(?i)\bhref" + _VALUE, 1), quotes)
    content = F.btrim(F.regexp_extract("tag", r"(?i)\bcontent" + _VALUE, 1), quotes)
    # a generator between the steps keeps each expression from being repeated inside the next
    step = lambda rows, column: rows.select("url", F.explode(F.array(column)).alias("target"))
    value = F.when(F.col("canonical"), href).otherwise(content).alias("value")
    told = tags.where("canonical OR refresh").select("url", "canonical", F.explode(F.array(value)).alias("value"))
    decoded = F.when(F.contains("value", F.lit("&")), html_unescape(F.col("value"))).otherwise(F.col("value"))
    told = told.select("url", "canonical", F.explode(F.array(decoded)).alias("value"))
    address = F.btrim(F.regexp_extract("value", r"(?is)url\s*=\s*(.*)$", 1), F.lit("\"' \t\r\n\f"))
    found = step(told, F.btrim(F.when(F.col("canonical"), F.col("value")).otherwise(address), F.lit(" \t\r\n\f")))
    found = step(found, resolve(F.col("url"), F.col("target")))
    found = step(found, url_node(F.col("target")))
    return found.select(url_node(F.col("url")).alias("a"), F.col("target").alias("b"))


def longest_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, action, rule of the distinct ``places`` (host, path) that a rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest wins; of equally long ones that
    with the longer host, then allow. A place meets only the rule paths of its hosts' lengths, one candidate for each length.
    """
    lengths = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set(F.length("path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = places.select("host", "path", F.explode(suffix).alias("rule_host")).join(lengths, "rule_host")
    by_length = by_host.select("host", "path", "rule_host", F.explode("lengths").alias("n")).where("n <= length(path)")
    candidates = by_length.select("host", "path", "rule_host", F.expr("substring(path, 1, n)").alias("rule_path"))
    own = rules.select("action", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")), F.length("rule_host"), F.col("action") == "allow",
        F.concat("rule_host", "rule_path").alias("rule"), "action",
    )
    best = candidates.join(own, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.action", "best.rule")


def judge_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and component (null without aliases) for each row of ``pages`` (page_id, url, html).

    ``rules``: action (``allow`` or ``block``), host, path (starting with ``/``). ``redirects``: from_url, to_url, beside the
    edges found in the html. Null URLs, and those without ``://``, have an empty host and path, no rule and no alias: they are
    allowed. A null html has no edges. Repeated rows stay repeated. No pages: no rows.
    """
    url = F.col("url")
    own = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), url_node(url).alias("node"))
    edges = html_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(url_node(F.col("from_url")), url_node(F.col("to_url"))))
    aliases = connected_components(edges)
    placed = aliases.select("node", "component", url_host(F.col("node")).alias("host"), url_path(F.col("node")).alias("path"))
    ruled = placed.join(longest_rules(placed.select("host", "path").distinct(), rules), ["host", "path"])
    told = ruled.groupBy("component").agg(
        F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked")
    )
    through = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow").alias("through")
    heard = store(aliases.join(told, "component", "left").select("node", "component", through), "aliases")
    fits = longest_rules(own.select("host", "path").distinct(), rules)
    judged = own.join(fits, ["host", "path"], "left").join(heard, "node", "left")
    verdict = F.coalesce("action", "through", F.lit("allow")).alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "component")
