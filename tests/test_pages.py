"""Markup, sitemap and judgement functions, attempts and sinks."""

import time
from datetime import datetime, timezone

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sitetext import HIGH_VALUE_KEYWORDS, LOW_VALUE_KEYWORDS, Options
from sitetext.config import ATTEMPTS_SCHEMA, SITEMAP_NAMESPACE
from sitetext.functions.html import anchor_links, extract_text, unescape
from sitetext.functions.judgement import gated_text, render_reason
from sitetext.functions.sitemaps import (
    is_markup,
    is_sitemap_index,
    robots_sitemaps,
    sitemap_locs,
)
from sitetext.functions.urls import clean_reference
from sitetext.operators.attempts import fold_attempts, next_attempts
from sitetext.operators.joins import lookup
from sitetext.operators.ranking import cap_links, site_link_rows, top_links
from sitetext.plans.staging import Staging
from sitetext.sources import sinks
from sitetext.sources.tables import captured_attempts, pending, shard, union_shards

NS = f'xmlns="{SITEMAP_NAMESPACE}"'


def one(spark, function, value):
    return spark.createDataFrame([(value,)], "x string").select(F.expr(function("x"))).first()[0]


def many(spark, function, inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "n int, x string")
    got = dict(rows.select("n", F.expr(function("x"))).collect())
    return [got[n] for n in range(len(inputs))]


def test_options():
    assert "about" in HIGH_VALUE_KEYWORDS and "careers" in LOW_VALUE_KEYWORDS
    assert (Options().max_subpages, Options().retry_mode, Options().js_fallback) == (8, "full", True)
    assert Options(high_value_keywords=["technology"]).high_value_keywords == ("technology",)
    assert Options(retry_mode="other").attempt_budget == 5
    for bad in ({"persist_raw_html": True}, {"max_subpages": 0}, {"low_value_keywords": "blog"}):
        with pytest.raises(ValueError):
            Options(**bad)


ARTICLE = """<html><body>
<aside>Tide table</aside>
<article>
  <h2>Pilot boats</h2>
  <p>Nine crews share the berth behind the old crane. A watch lasts twelve hours.</p>
  <p>In fog they wait for the second bell.</p>
</article>
<nav><ul><li><a href="/quay">Quay</a></li></ul></nav>
</body></html>"""


def test_extract_text(spark):
    cases = {
        ARTICLE: "Pilot boats\n"
        "Nine crews share the berth behind the old crane. A watch lasts twelve hours.\n"
        "In fog they wait for the second bell.",
        "<html><body><script>window.location='/';</script></body></html>": "",
        "": "",
        "plain": "plain",
        "<p>a &lt;b&gt; &amp;amp; &#8217;&#x1F600; &nope; &#0; &#xD800; R&D</p>": "a <b> &amp; ’😀 &nope; &#0; &#xD800; R&D",
        "<title>t</title><p>a<!-- <p>no</p> -->b</p><style>p{}</style>\n\n<footer>f</footer>": "ab",
        "<body>x<main>one<br>two</main>y<main>three</main>z</body>": "one\ntwo\ny\nthree",
        "<article>first</article><p>between</p><article>last</article><p>after</p>": "first\nbetween\nlast",
        "<p>cut off <b>here<script>var a = '<p>never</p>'": "cut off here",
        "<div>a&nbsp;&nbsp; b\t\r\n c</div><div>  </div><div>d</div>": "a b c\nd",
        "<header>h</header><p>1 < 2 and 3 > 2</p>": "h\n1 < 2 and 3 > 2",
        "<p title='a > b' onclick=\"if(a<b){}\">kept</p><a x='<p>no'>too</a>": "kept\ntoo",
        "<p title=don't>it's</p><p a==\"x>y\" b>z": "it's\nz",
        "<nav>a<nav>b</nav>c</nav><p>d</p><aside><aside><nav>e</nav></aside>f</aside>": "d",
        "<article>Teaser</article><p>" + "long text " * 50 + "</p>": "Teaser\n" + ("long text " * 50).strip(),
        "<p>&Oslash;&scaron;&#150;&#x80;&#129;</p>": "Øš–€\x81",
    }
    assert dict(zip(cases, many(spark, extract_text, list(cases)))) == cases
    assert one(spark, extract_text, None) == ""


def test_long_pages_do_not_fail(spark):
    """Repeated openings without an end cost neither the stack nor quadratic time."""
    parts = ("<nav ", "<nav>", "<script ", "<a href=\"", "<!--", "<article>x", "<b x='", "&#", "<p>word ",
             "<a x='>\" ", "<a b=\"", "<a b=' c=\"", "<a b c ", "<nav><aside>", "</nav>")
    pages = [part * 60_000 for part in parts] + [f"<a href='x{' ' * 1_000_000}y'>z</a>"]
    assert len(many(spark, lambda x: f"""length({extract_text(x)}) + size({anchor_links(x, "'https://x.com'")})""", pages)) == 16


def test_blanks_cost_linear_time(spark):
    """One hostile body doesn't hold up a task."""
    blanks = " \t" * 500_000
    started = time.perf_counter()
    assert one(spark, clean_reference, f"{blanks}a{blanks}b{blanks}")[0] == "a"
    body = f"<urlset {NS}><url><loc>{blanks}https://e.com/a{blanks}</loc></url></urlset>{blanks}"
    assert one(spark, sitemap_locs, body) == ["https://e.com/a"]
    assert one(spark, robots_sitemaps, f"Sitemap:{blanks}https://e.com/s{blanks}\n{blanks}") == ["https://e.com/s"]
    assert time.perf_counter() - started < 6


HOMEPAGE = """<html><body><p>Harbour office</p>
  <ul><li><a href="/tides">Tides</a></li><li><a href="https://harbour.test/fees?y=2">Fees</a></li></ul>
  <a href="https://weather.test/north">Weather</a> <a href="tel:+1555">Call</a> <a href="map.png">Map</a>
</body></html>"""


def test_anchor_links(spark):
    cases = {
        HOMEPAGE: ["https://example.com/tides", "https://harbour.test/fees?y=2", "https://weather.test/north",
                   "https://example.com/map.png"],
        "": [],
        "<A CLASS=x\nHREF = ' rel?a=1&amp;b=2 '>x</A><a data-href='/no' href=/unquoted>y</a>":
            ["https://example.com/rel?a=1&b=2", "https://example.com/unquoted"],
        "<!-- <a href='/no'> --><script>'<a href=\"/no\">'</script><nav><a href='/nav'></nav><abbr href='/no'>":
            ["https://example.com/nav"],
        "<head><base href='/b/'></head><a href='x'><a href='../y'>": ["https://example.com/b/x", "https://example.com/y"],
        "<a href=''><a href='#t'><a href='?q'>": ["https://example.com", "https://example.com#t", "https://example.com?q"],
        "<a href='http://['><a href='http://[::1]/a'>": ["http://[::1]/a"],
        "<a title='a > b' href='/real'>t</a><a onclick=\"if(a<b){}\" href=\"/z\">u</a>":
            ["https://example.com/real", "https://example.com/z"],
        "<a title='see href=/fake' data-x=1 href=/real><a title=\"q\"href='/next'><a title=don't href=/t>":
            ["https://example.com/real", "https://example.com/next", "https://example.com/t"],
        "<a href='/a' href='/b'><a name=x><a\nhref=/c/>": ["https://example.com/a", "https://example.com/c/"],
    }
    got = many(spark, lambda x: anchor_links(x, "'https://example.com'"), list(cases))
    assert dict(zip(cases, got)) == cases


def test_sitemaps(spark):
    url, entry = "<url><loc>https://e.com/{}</loc></url>", "<sitemap><loc>https://e.com/{}</loc></sitemap>"
    cases = [
        (f'<?xml version="1.0" encoding="UTF-8"?>\n<urlset {NS}>\n{url.format(1)}\n{url.format(2)}</urlset>\n', [1, 2], False),
        (f"<sitemapindex {NS}>{entry.format('a.xml')}</sitemapindex>", ["a.xml"], True),
        (f"<SitemapIndex>{entry.format('a.xml')}</SitemapIndex>", [], True),
        (f"<urlset {NS}><url><loc>\n https://e.com/1?a&amp;b </loc><lastmod>x</lastmod></url></urlset>", ["1?a&b"], False),
        (f"<s:urlset xmlns:s='{SITEMAP_NAMESPACE}'><s:url><s:loc>https://e.com/1</s:loc></s:url></s:urlset>", [1], False),
        (f"<!-- c --><urlset {NS}>{url.format(1)}</urlset><!-- c -->", [1], False),
        (f'<urlset {NS} xmlns:image="urn:i"><url><loc>https://e.com/1</loc><image:loc>i</image:loc>'
         "<image:image><image:loc>j</image:loc></image:image></url></urlset>", [1], False),
        (f"<urlset {NS}><url><loc>https://e.com/1</loc><image:loc>unbound</image:loc></url></urlset>", [], False),
        (f"<urlset {NS}><url><loc>https://e.com/1</loc><loc>https://e.com/2</loc></url></urlset>", [1, 2], False),
        (f"<urlset {NS}>{'<a>' * 20_000}{'</a>' * 20_000}{url.format(1)}</urlset>", [], False),
        (f"<urlset {NS}>{url.format(1)}{entry.format('b')}<g><url><loc>https://e.com/3</loc></url></g></urlset>", [1, "b", 3], False),
        (f"<feed {NS}><loc>https://e.com/1</loc></feed>", [1], False),
        (f"<urlset {NS}><url><loc><![CDATA[https://e.com/1?a&b]]></loc><n><![CDATA[<x:loc>no</x:loc>]]></n></url></urlset>", ["1?a&b"], False),
        (f'<urlset {NS} xmlns:image = "urn:i"><url><loc>https://e.com/1</loc><image:loc>i</image:loc></url></urlset>', [1], False),
        (f"<urlset {NS}><!-- {url.format(2)} --><url><loc/><loc>https://e.com/1</loc></url></urlset>", [1], False),
        (f"<urlset>{url.format(1)}</urlset>", [], False),
        (f'<urlset xmlns="urn:other">{url.format(1)}</urlset>', [], False),
        (f"<urlset {NS}>{url.format(1)}", [], False),
        (f"<urlset {NS}>{url.format(1)}</urlset>tail", [], False),
        (f' <?xml version="1.0"?><urlset {NS}>{url.format(1)}</urlset>', [], False),
        (f"<urlset {NS}><url><loc>https://e.com/a&b</loc></url></urlset>", [], False),
        (f"<sitemapindex {NS}>", [], False),
        ("garbage", [], False), ("not xml at all", [], False), ("", [], False), (None, [], False),
    ]
    bodies = [c[0] for c in cases]
    assert many(spark, sitemap_locs, bodies) == [[f"https://e.com/{x}" for x in c[1]] for c in cases]
    assert many(spark, is_sitemap_index, bodies) == [c[2] for c in cases]
    assert many(spark, is_markup, ["<a", "\n <a", "a<", "", None]) == [True, True, False, False, False]


def test_robots_sitemaps(spark):
    body = "User-agent: *\r\nSITEMAP:  https://a/s.xml \n Sitemap: no\nsitemap:https://b/x:1\rSitemap:https://c"
    assert many(spark, robots_sitemaps, [body, "", None]) == [["https://a/s.xml", "https://b/x:1", "https://c"], [], []]


def test_judgement(spark):
    rows = [(s, "x" * n, e) for s in (0, 200, 403, 404, 429, 500, 503) for n in (0, 199, 200) for e in (True, False)]
    frame = spark.createDataFrame(rows, "s int, t string, e boolean")
    for r in frame.selectExpr("*", f"{render_reason('s', 't')} AS r", f"{gated_text('t', 'e', ('captcha',))} AS g").collect():
        assert r.r == ("blocked" if r.s in (0, 403, 429, 503) else "thin_text" if len(r.t) < 200 else None)
        assert r.g == ("" if r.e and len(r.t) < 200 else r.t)
    for escalated in ("true", "false"):
        got = one(spark, lambda x: gated_text(f"concat({x}, ' CAPTCHA')", escalated, ("captcha",)), "x" * 300)
        assert (got == "") is (escalated == "true")


def log(spark, cases):
    now = datetime(2026, 1, 1, tzinfo=timezone.utc)
    rows = [(url, n, s, f"{url}{n}" if s else "", now) for url, statuses in cases.items() for n, s in enumerate(statuses)]
    return spark.createDataFrame(rows, ATTEMPTS_SCHEMA)


LOGS = {"ok": [200], "gone": [404, 200], "late": [403, 200], "never": [403] * 5, "error": [0], "odd": [503, 0, 500, 200],
        "six": [429] * 5 + [200]}


@pytest.mark.parametrize("mode,expected", [
    ("none", {"ok": (200, 0), "gone": (404, 0), "late": (403, 0), "never": (403, 0), "error": (0, 0), "odd": (503, 0), "six": (429, 0)}),
    ("minimal", {"ok": (200, 0), "gone": (404, 0), "late": (200, 1), "never": (403, 1), "error": (0, 0), "odd": (0, 1), "six": (429, 1)}),
    ("full", {"ok": (200, 0), "gone": (404, 0), "late": (200, 1), "never": (403, 4), "error": (0, 0), "odd": (500, 2), "six": (429, 4)}),
])
def test_fold_attempts(spark, mode, expected):
    rows = fold_attempts(log(spark, LOGS), Options(retry_mode=mode)).collect()
    assert {r.page_url: (r.status, r.retries_used) for r in rows} == expected
    assert all(r.html == (f"{r.page_url}{r.retries_used}" if r.status else "") for r in rows)


@pytest.mark.parametrize("mode,expected", [
    ("none", {}), ("minimal", {"error": (1, 0.0)}), ("full", {"error": (1, 1.0)}),
])
def test_next_attempts(spark, mode, expected):
    rows = next_attempts(log(spark, LOGS), Options(retry_mode=mode)).collect()
    assert {r.page_url: (r.attempt, r.delay_s) for r in rows} == expected


def test_next_attempts_waits_longer_each_time(spark):
    cases = {str(n): [403] * n for n in range(1, 6)}
    rows = next_attempts(log(spark, cases), Options()).collect()
    assert {r.page_url: r.delay_s for r in rows} == {"1": 1.0, "2": 2.0, "3": 4.0, "4": 8.0}


def test_latest_copy_of_an_attempt_counts(spark):
    rows = [("u", 0, 200, f"v{n}", datetime(2026, 1, n, tzinfo=timezone.utc)) for n in (2, 3, 1)]
    folded = fold_attempts(spark.createDataFrame(rows, ATTEMPTS_SCHEMA), Options())
    assert [r.html for r in folded.collect()] == ["v3"]


def test_captured_attempts(spark):
    row = [("u", "<p>", datetime(2026, 1, 1))]
    frame = spark.createDataFrame(row, "page_url string, html string, fetched_at timestamp")
    got = captured_attempts(frame).first()
    assert (got.attempt, got.status) == (0, 200)
    assert captured_attempts(frame.withColumn("status", F.lit(404))).first().status == 404


def test_link_rows(spark):
    paths = ["careers", "about", "a.pdf", "about", "en/about", "pricing", "blog"]
    rows = spark.createDataFrame(
        [(c, f"https://{c}.com/{p}", n) for c in ("x", "y") for n, p in enumerate(paths)], "c string, u string, n int")
    kept = site_link_rows(rows, "c", "u", "n", "concat(c, '.com')")
    assert kept.count() == 10
    best = top_links(kept, "c", "u", "n", ("about",), ("careers", "blog"), limit=4)
    got = sorted((r.c, r["rank"], r.u.split(".com/")[1]) for r in best.collect())
    assert [g[2] for g in got if g[0] == "x"] == ["about", "en/about", "pricing", "careers"]
    assert cap_links(rows, "c", ["n"], 2).count() == 4


def test_skewed_links_match_brute_force(spark):
    """One company holds most rows; the ranking keeps the same rows as sorting them all."""
    urls = [(0 if n % 3 else n, f"https://x.com/{'about' if n % 7 == 0 else 'p'}/{n}", n) for n in range(3000)]
    rows = spark.createDataFrame(urls, "c int, u string, n int").repartition(8)
    got = {(r.c, r["rank"]): r.u for r in top_links(rows, "c", "u", "n", ("about",), (), 5).collect()}
    groups = {}
    for c, u, n in urls:
        groups.setdefault(c, []).append((-2 if "about" in u else 0, u.count("/") - 2, n, u))
    expected = {(c, i + 1): k[3] for c, g in groups.items() for i, k in enumerate(sorted(g)[:5])}
    assert got == expected


def test_lookup_of_a_hot_key_matches_a_plain_join(spark):
    left = spark.range(4000).selectExpr(
        "id AS company_key", "if(id % 3 = 0, 'hot', if(id % 50 = 1, NULL, concat('k', id % 700))) AS key")
    right = spark.range(0, 700, 2).selectExpr("concat('k', id) AS key", "id AS value").unionByName(
        spark.sql("SELECT 'hot' AS key, -1L AS value"))
    plain = left.join(right, "key", "left")
    split = lookup(left, right, ["key"], "company_key", 4000, hot_rows=100)
    assert sorted(split.columns) == sorted(plain.columns)
    assert sorted(map(str, split.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    # The hot key's rows do not meet in one task.
    tasks = split.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 1334


def test_pending_and_shards(spark):
    companies = spark.createDataFrame([(n, f"{n}.com") for n in range(10)] + [(None, "n.com")], "cid int, u string")
    done = spark.createDataFrame([("3",), ("3",), ("4",)], "id string")
    assert sorted(r.u for r in pending(companies, done, "cid").collect()) == sorted(
        ["0.com", "1.com", "2.com", "5.com", "6.com", "7.com", "8.com", "9.com", "n.com"])
    shards = [shard(companies, 3, n, "u") for n in range(3)]
    assert sorted(r.u for r in union_shards(shards).collect()) == sorted(r.u for r in companies.collect())


class FakeWriter:
    """Stands in for a frame and its writer; fails with the given errors first."""

    def __init__(self, errors):
        self.errors, self.calls = list(errors), []
        self.write = self

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def _end(self, kind, target):
        self.calls.append((kind, target))
        if self.errors:
            raise RuntimeError(self.errors.pop(0))

    def save(self, target):
        self._end("save", target)

    def saveAsTable(self, target):
        self._end("table", target)


def writes(frame):
    return [c for c in frame.calls if c[0] in ("save", "table")]


def test_append_dispatch_and_retries():
    waits = []
    frame = FakeWriter([])
    sinks.append(frame, "/data/results", sleep=waits.append)
    sinks.append(frame, "catalog.schema.results", "delta", sleep=waits.append)
    assert writes(frame) == [("save", "/data/results"), ("table", "catalog.schema.results")]
    assert ("format", "delta") in frame.calls and ("mode", "append") in frame.calls and not waits

    frame = FakeWriter([sinks.CONFLICT])
    sinks.append(frame, "/t", sleep=waits.append)
    assert len(writes(frame)) == 2 and 1.0 <= waits[0] <= 1.5

    frame = FakeWriter([sinks.CONFLICT] * 3)
    with pytest.raises(RuntimeError, match=sinks.CONFLICT):
        sinks.append(frame, "/t", sleep=waits.append)
    assert len(writes(frame)) == 3

    frame = FakeWriter(["some other error"])
    with pytest.raises(RuntimeError, match="some other error"):
        sinks.append(frame, "/t", sleep=waits.append)
    assert len(writes(frame)) == 1


def test_with_schema(spark):
    frame = spark.createDataFrame([(1, "a", True)], "b int, a string, extra boolean")
    assert sinks.with_schema(frame, "a string, b bigint").schema.simpleString() == "struct<a:string,b:bigint>"
    with pytest.raises(Exception, match="(?i)cast|upcast|invalid"):
        sinks.with_schema(frame, "a string, b boolean")


def test_staging_reads_back_what_it_wrote(spark):
    frame = spark.range(5).select("id", F.array(F.col("id")).alias("l"))
    staging = Staging(spark)
    assert sorted(staging.stage(frame, "t").collect()) == sorted(frame.collect())
    assert staging.folder.startswith(spark.conf.get("spark.checkpoint.dir", "/"))
    staging.remove()
    assert not Path(staging.folder).exists()


def test_unnumbered_attempts_count_as_first(spark):
    rows = [("u", None, 200, "x", None)]
    folded = fold_attempts(spark.createDataFrame(rows, ATTEMPTS_SCHEMA), Options()).collect()
    assert [(r.status, r.retries_used) for r in folded] == [(200, 0)]


def test_only_numbers_are_read_as_numbers(spark):
    """Reading them is most of the cost of a reference, and most references are named."""
    sql = unescape("x")
    assert "startswith(" in sql[: sql.index("conv(")]
    given = ["&amp;#233;", "&#233;&#xE9;&#XE9;", "&#128;&#0;&#55296;", "&nope;&;&&lt;", "&#;&#x;&# 1;", "#233;", "&quot", None]
    assert many(spark, unescape, given) == [
        "&#233;", "ééé", "€&#0;&#55296;", "&nope;&;&<", "&#;&#x;&# 1;", "#233;", "&quot", None,
    ]
