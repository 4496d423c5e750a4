"""Site-relative line frequency: a line that is on too large a share of a host's pages is boilerplate.

Lines are counted once per page and combined per (host, line) before the shuffle, so a hot host or line is many partial
sums. A boilerplate line is on more than ``ratio`` of its host's pages, so a host has at most (mean lines per page) / ratio
of them; only that short list meets the pages again. Page totals and lists are stored before they are joined: so Spark knows
their sizes and broadcasts them if they are small, else both sides of the join are plain shuffles, which it splits where a
host is hot (with an aggregate between shuffle and join it could not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import store

RATIO = 0.3
MIN_PAGES = 3
WS = " \t\n\x0b\f\r"
# Fixed value: the elements that HTML shows on lines of their own.
BLOCK = (
    "address|article|aside|blockquote|body|br|button|caption|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|"
    "form|h1|h2|h3|h4|h5|h6|head|header|hr|html|legend|li|main|menu|nav|ol|option|p|pre|section|select|summary|table|tbody|"
    "td|textarea|tfoot|th|thead|title|tr|ul"
)
_UNSEEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def html_lines(html: Column) -> Column:
    """The visible lines of a page, stripped, without empty ones; null: none. Entities stay as they are."""
    seen = F.regexp_replace(F.coalesce(html, F.lit("")), _UNSEEN, "")
    broken = F.regexp_replace(seen, rf"(?i)</?(?:{BLOCK})\b[^>]*>", "\n")
    text = F.regexp_replace(broken, "<[^>]*>", "")
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WS)))
    return F.filter(lines, lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """site, line_hashes: of each site that has any, the lines on more than ``ratio`` of its pages and at least ``min_pages``.

    Needs site and lines (array). A line counts once per page; its identity is its 64-bit hash. Pages without a site form none.
    ``line_hashes`` has a slot for each of the site's lines, and each line lies in the slot of its hash modulo their number: a line
    is looked up in one slot, however many lines a site has.
    """
    hashes = F.explode(F.array_distinct(F.transform("lines", lambda line: F.xxhash64(line)))).alias("line_hash")
    known = pages.where("site IS NOT NULL")
    containing = known.select("site", hashes).groupBy("site", "line_hash").agg(F.count("*").alias("n_containing"))
    total = known.groupBy("site").agg(F.count("*").alias("n_site"))
    common = containing.where(F.col("n_containing") >= min_pages).join(store(total, "site_pages"), "site")
    common = common.where(F.col("n_containing") / F.col("n_site") > ratio)
    common = store(common.select("site", "line_hash"), "site_common")
    sizes = common.groupBy("site").agg(F.count("*").alias("n_slots"))
    slots = sizes.select("site", F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1)).alias("slot"))
    filed = common.join(sizes, "site").select("site", F.pmod("line_hash", F.col("n_slots")).alias("slot"), "line_hash")
    filled = slots.join(filed, ["site", "slot"], "left").groupBy("site", "slot").agg(F.collect_list("line_hash").alias("line_hashes"))
    in_order = F.sort_array(F.collect_list(F.struct("slot", "line_hashes")))
    return filled.groupBy("site").agg(in_order.getField("line_hashes").alias("line_hashes"))


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, site, lines, kept_lines (in order, without the site's boilerplate) for each row of ``pages``.

    Needs page_id, site and lines, whatever else there is. Null lines count as none; pages without a site keep all lines.
    Repeated rows count as pages of their own and stay repeated. Empty input: no rows.
    """
    own = pages.select("page_id", "site", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))
    judged = own.join(store(boilerplate(own, ratio, min_pages), "site_boilerplate"), "site", "left")
    slot = lambda line: F.get("line_hashes", F.pmod(F.xxhash64(line), F.size("line_hashes")).cast("int"))
    kept = F.filter("lines", lambda line: ~F.array_contains(slot(line), F.xxhash64(line)))
    kept = F.when(F.col("line_hashes").isNull(), F.col("lines")).otherwise(kept)
    return judged.select("page_id", "site", "lines", kept.alias("kept_lines"))
