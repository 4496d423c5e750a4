import random
from collections import Counter

from pyspark.sql import functions as F

from passagemill.llm.site_lines import drop_boilerplate, html_lines


def sample():
    rng = random.Random(13)
    pages = []
    for i in range(200):
        site = rng.choice(["hot", "hot", "hot", "b", "c", "rare", None])
        lines = [rng.choice(["menu", "cookie", f"text {rng.randrange(400)}", f"text {i}"]) for _ in range(rng.randrange(0, 9))]
        pages.append((i, site, lines))
    return pages + [(500, "hot", None), (501, "one", ["menu", "menu", "menu", "menu"]), (502, "hot", []), (None, "b", ["menu", "x"]), pages[0], pages[0]]


def test_kept_lines_equal_plain_statement(spark):
    pages = sample()
    total = Counter(s for _, s, _ in pages)
    containing = Counter((s, line) for _, s, lines in pages for line in set(lines or []))
    drop = {(s, x) for (s, x), n in containing.items() if s is not None and n >= 3 and n / total[s] > 0.3}
    assert drop
    want = [(i, s, lines or [], [x for x in lines or [] if (s, x) not in drop]) for i, s, lines in pages]
    table = spark.createDataFrame([(*p, 1, "k") for p in pages], "page_id long, site string, lines array<string>, line_hash long, kept_lines string").repartition(4)
    got = [tuple(r) for r in drop_boilerplate(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_lines_of_html(spark):
    cases = {
        None: [],
        "": [],
        "<p>a <b>b</b> c<br>d<p> \t <li>e</li>": ["a b c", "d", "e"],
        "<script>var t='<p>no</p>';</script><STYLE>p{}</STYLE>x<!-- <p>y -->z": ["xz"],
        "<nav><ul><li><a href='/x'>One</a></li><li>Two</li></ul></nav>text\nmore &amp; more": ["One", "Two", "text", "more &amp; more"],
        "a < b": ["a < b"],
    }
    rows = spark.createDataFrame([(h,) for h in cases], "html string")
    assert [r[0] for r in rows.select(html_lines(rows.html)).collect()] == list(cases.values())


def test_empty_table(spark):
    assert drop_boilerplate(spark.createDataFrame([], "page_id long, site string, lines array<string>")).collect() == []


def test_long_lists_of_common_lines(spark):
    """Four pages of 30,000 lines that they share, each with one line of its own, and a text line of a megabyte."""
    shared = F.transform(F.sequence(F.lit(1), F.lit(30000)), lambda i: F.concat(F.lit("line "), i.cast("string")))
    own = F.array(F.concat(F.lit("own "), F.col("id").cast("string")), F.repeat(F.col("id").cast("string"), F.lit(1 << 20)))
    pages = spark.range(4).select(F.col("id").alias("page_id"), F.lit("hot").alias("site"), F.concat(shared, own, shared).alias("lines"))
    kept = drop_boilerplate(pages).select("page_id", F.transform("kept_lines", lambda x: F.left(x, F.lit(5)))).orderBy("page_id")
    assert [tuple(r) for r in kept.collect()] == [(i, [f"own {i}", str(i) * 5]) for i in range(4)]
