import random

import duckdb

from passagemill.llm import url_filter as U
from passagemill.llm.queries import ORACLE, QUERIES

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "org", "/fr/x"), ("block", "a.org", "/p")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host) :]
    for mark in "?#":
        path = path.split(mark, 1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(url):
    host, path = split(url)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "allow"), default=None)


def node(url):
    if url is None or "://" not in url:
        return None
    host, path = split(url)
    rest = url.split("#")[0]
    return url.split("://")[0].lower() + "://" + host + (path or "/") + ("?" + rest.split("?", 1)[1] if "?" in rest else "")


def judge(pages, redirects):
    """By plain search; pages: (page_id, url, target of a canonical link or None)."""
    links = {}
    for a, b in [(u, t) for _, u, t in pages if t] + redirects:
        a, b = node(a), node(b)
        if a and b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    rows = []
    for page_id, url, _ in pages:
        seen, todo = set(), [node(url)]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += links.get(n, ())
        actions = {(rule_of(n) or (None,))[0] for n in seen if n}
        own = rule_of(url)
        through = "block" if "block" in actions and "allow" not in actions else "allow"
        if node(url) not in links:
            through = "allow"
        rows.append((page_id, *split(url), own and own[1] + own[2], own[0] if own else through))
    return sorted(rows, key=str)


def test_verdicts_equal_plain_search(spark):
    rng = random.Random(9)
    hosts = ["a.org", "b.org", "sub.example.net", "EXAMPLE.com", "q.info", "r.info", "s.info", "x.net", "net", "anet", "org"]
    urls = [f"http{rng.choice(['', 's'])}://{h}{p}{t}" for h in hosts for p in ("", "/", "/en/1", "/de/2", "/fr/3", "/fr/x", "/p", "/é") for t in ("", "?q=a/b", "#f")]
    urls += ["nothing", "", None, "://", "x://", "http://h?x://y/z", "HTTP://B.ORG/fr/3"]
    pages = [(i, u, rng.choice(urls) if rng.random() < 0.3 and u else None) for i, u in enumerate(urls)] + [(3, urls[3], None), (None, urls[5], None)]
    pages = [(i, u, t if t and "://" in t else None) for i, u, t in pages]
    redirects = [(rng.choice(urls), rng.choice(urls)) for _ in range(40)]
    html = lambda t: t and f"<html><head><LINK class='c' rel=\"canonical\" HREF='{t}'></head>"
    table = spark.createDataFrame([(i, u, html(t), "h") for i, u, t in pages], "page_id long, url string, html string, host string")
    rules, moved = spark.createDataFrame(RULES, U.RULE_SCHEMA), spark.createDataFrame(redirects, "from_url string, to_url string")
    found = U.judge_pages(table, rules, moved).collect()
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found], key=str) == judge(pages, redirects)


def test_links_found_in_html(spark):
    base = "http://h.org/d/p.html?x=1"
    cases = {
        "<link rel=canonical href=q.html>": "http://h.org/d/q.html",
        "<link href='/q' rel='canonical'>": "http://h.org/q",
        '<link rel="canonical" href="//Other.org">': "http://other.org/",
        '<META http-equiv="refresh" content="5; URL=https://h.org/z?y#f">': "https://h.org/z?y",
        '<link rel="canonical" href="?y">': "http://h.org/d/p.html?y",
        '<link rel="stylesheet" href="/s.css">': None,
        '<link rel="canonical" href="">': None,
        "<p>canonical</p>": None,
    }
    rows = spark.createDataFrame([(base, h) for h in cases], "url string, html string")
    want = [t for t in cases.values() if t]
    assert sorted(r.b for r in U.html_edges(rows).where("b IS NOT NULL").collect()) == sorted(want)


def test_block_reaches_aliases_unless_one_is_allowed(spark):
    pages = spark.createDataFrame(
        [(1, "http://q.info/1", '<link rel="canonical" href="http://x.net/">'), (2, "http://r.info/2", '<link rel="canonical" href="http://q.info/1">'),
         (3, "http://s.info/3", '<link rel="canonical" href="http://y.net/">'), (4, "http://b.org/fr/", '<link rel="canonical" href="http://s.info/3">')],
        "page_id long, url string, html string",
    )
    found = {r.page_id: r.verdict for r in U.judge_pages(pages, spark.createDataFrame(RULES, U.RULE_SCHEMA)).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge_pages(none, spark.createDataFrame([], U.RULE_SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "http://x.net/", None)], "page_id long, url string, html string")
    assert U.judge_pages(one, spark.createDataFrame([], U.RULE_SCHEMA)).first().verdict == "allow"


def test_links_over_lines_with_more_words_or_entities(spark):
    cases = {
        "<link\n  rel='canonical'\n  href='/a'\n>": "http://h.org/a",
        '<meta\n http-equiv="refresh"\n content="0;\n url=/b">': "http://h.org/b",
        '<link rel="shortlink canonical" href="/c">': "http://h.org/c",
        "<link href='https://x.org/?a=1&amp;b=2' rel=canonical>": "https://x.org/?a=1&b=2",
        '<meta http-equiv=refresh content="0;url=&#39;/d?x&amp;y&#39;">': "http://h.org/d?x&y",
        '<link rel="notcanonical" href="/e">': None,
    }
    rows = spark.createDataFrame([("http://h.org/p", h) for h in cases], "url string, html string")
    assert sorted(r.b for r in U.html_edges(rows).collect()) == sorted(t for t in cases.values() if t)


def test_query_with_aliases_equals_sql(spark, tmp_path):
    """The registered query and its SQL on pages whose aliases decide: chains, allow before block, tags written in many ways."""
    link = lambda rel, href: f"<html><head><link\n rel={rel}\r\n href={href}></head>"
    pages = [
        (1, "http://a.info/1", link("'alternate canonical'", "'http://b.info/2'")),  # a chain to a blocked host
        (2, "http://b.info/2", link('"canonical"', '"//shop.net/3"')),
        (3, "http://shop.net/3", None),
        (4, "http://c.info/", '<META HTTP-EQUIV=Refresh CONTENT="0; URL=http://x.net/?a=1&amp;b=2">'),  # by a reference in the address
        (5, "http://x.net/?a=1&b=2#top", ""),
        (6, "http://d.info/p/q", link("canonical", "../r") + link('"canonical stylesheet"', "'http://y.org/fr/'")),  # allowed by an alias
        (7, "http://d.info/p/../r", link("canonical", "'http://y.net/'")),
        (8, "http://e.info/", link("'notcanonical'", "'http://z.net/'") + link("canonicals", "http://z.net/")),  # no aliases
        (9, "http://e.info", "<link rel='canonical' href=' '><link rel=canonical><meta http-equiv='refresh' content='5'>"),
        (10, "http://example.com/de/x", link("canonical", "http://y.org/fr/")),  # its own rule comes first
        (11, "HTTP://G.info/a?b", link("canonical", "'?c'")),
        (12, "http://g.info/a?c", link("canonical", "&quot;")),
        (13, "http://h.info/", '<meta name=x content=y http-equiv="refresh"\n content="1;\turl=\'http://net/\' ">'),
        (None, None, link("canonical", "http://net/")),
        (3, "http://shop.net/3", None),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = con.execute(ORACLE["op7_redirect_equivalence"])
    columns = [d[0] for d in cursor.description]
    found = [tuple(r) for r in QUERIES["op7_redirect_equivalence"](spark, str(tmp_path)).select(*columns).collect()]
    assert sorted(found, key=str) == sorted(cursor.fetchall(), key=str)
    verdict = {r[columns.index("page_id")]: r[columns.index("verdict")] for r in found}
    assert {i for i, v in verdict.items() if v == "block"} == {1, 2, 3, 4, 5, 10}
    assert sum(r[columns.index("component")] is not None for r in found) >= 10
