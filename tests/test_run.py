"""End-to-end runs over small captured sites. Sites of the same options share one run."""

from datetime import datetime, timedelta, timezone

import pytest

from sitetext import Options, run_companies
from sitetext.config import ATTEMPTS_SCHEMA, RENDERS_SCHEMA, SITEMAP_NAMESPACE
from sitetext.operators import joins

HOME = """<html><head><title>Slate roofs</title></head><body>
  <p>Roofs of slate and copper, laid by hand.</p>
  <a href="/about">Who</a> <a href="/products">Tiles</a> <a href="/careers">Work here</a>
</body></html>"""
ABOUT = """<html><body><main><h3>Three generations</h3>
<p>The yard in the valley opened with two ladders
and one horse; the ladders are still in use.</p></main></body></html>"""
LONG = "<html><body><p>" + "plain words " * 40 + "</p>{}</body></html>"
T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def captured(spark, rows):
    """Rows of (url, status, html) or (url, attempt, status, html)."""
    full = []
    for n, row in enumerate(rows):
        url, attempt, status, html = row if len(row) == 4 else (row[0], 0, *row[1:])
        full.append((url, attempt, status, html, T0 + timedelta(seconds=n)))
    return spark.createDataFrame(full, ATTEMPTS_SCHEMA)


def sitemap(*urls, root="urlset", entry="url"):
    locs = "".join(f"<{entry}><loc>{u}</loc></{entry}>" for u in urls)
    return f'<{root} xmlns="{SITEMAP_NAMESPACE}">{locs}</{root}>'


def site(host, documents, home=LONG.format('<a href="/anchor">a</a>')):
    """Captures of a site: its homepage and (path, status, body) documents."""
    return [(f"https://{host}", 200, home)] + [
        (f"https://{host}{d[0]}", *d[1:]) for d in documents
    ]


def robots_case(host, first):
    """A site whose first sitemap is unusable, with two sitemaps named in its robots file."""
    return site(host, first + [
        ("/robots.txt", 200, f"User-agent: *\nsitemap: https://{host}/r2.xml\r\nSITEMAP: https://o.{host}/r.xml"),
        ("/r2.xml", 200, sitemap(f"https://{host}/r2")),
    ]) + [(f"https://o.{host}/r.xml", 200, sitemap(f"https://{host}/r1"))]


CHILDREN = [f"https://index.com/c{n}.xml" for n in range(5)]
CAPPED = ["https://o.com/x"] * 150 + ["https://cap.com/a"] * 49 + ["https://cap.com/b", "https://cap.com/c"]
PLAIN_SITES = {
    "example.com": [("https://example.com", 200, HOME), ("https://example.com/about", 200, ABOUT)],
    "blocked.com": [("https://blocked.com", n, 403, "") for n in range(5)],
    "first.com": site("first.com", [
        ("/sitemap.xml", 200, "\n" + sitemap("https://first.com/s", "https://www.first.com", "https://first.com/#t")),
        ("/robots.txt", 200, "Sitemap: https://first.com/r.xml"),
        ("/r.xml", 200, sitemap("https://first.com/r")),
    ]),
    "r1.com": robots_case("r1.com", []),
    "r2.com": robots_case("r2.com", [("/sitemap.xml", 404, sitemap("https://r2.com/s"))]),
    "r3.com": robots_case("r3.com", [("/sitemap.xml", 200, "<urlset>")]),
    "r4.com": robots_case("r4.com", [("/sitemap.xml", 200, "no")]),
    "r5.com": robots_case("r5.com", [("/sitemap.xml", 0, 503, ""), ("/sitemap.xml", 1, 200, sitemap("https://r5.com/s"))]),
    "r6.com": robots_case("r6.com", [
        ("/sitemap.xml", 200, sitemap("https://r6.com/gone.xml", root="sitemapindex", entry="sitemap")),
    ]),
    "dead.com": site("dead.com", [("/robots.txt", 200, "Sitemap: https://dead.com/r.xml")]),
    "foreign.com": site("foreign.com", [("/sitemap.xml", 200, sitemap("https://o.com/s"))]),
    "index.com": site("index.com", [
        ("/sitemap.xml", 200, sitemap(*CHILDREN, root="sitemapindex", entry="sitemap")),
    ]) + [(c, 503 if n == 0 else 200, sitemap(f"https://index.com/p{n}")) for n, c in enumerate(CHILDREN)],
    "cap.com": site("cap.com", [("/sitemap.xml", 200, sitemap(*CAPPED))]),
}
SHARED = [
    ("https://shared.com/sitemap.xml", 200, sitemap("https://shared.com/a", "https://shared.com/b")),
    ("https://shared.com/a", 200, LONG.format("")), ("https://shared.com/b", 200, LONG.format("")),
]
COPIES = [("copy", "example.com"), ("copy", "example.com"), ("none", None), ("blank", "  "), (None, "unseen.com")]


@pytest.fixture(scope="module")
def plain(spark):
    """A run without rendering."""
    companies = [(h, f"https://{h}/") for h in PLAIN_SITES] + COPIES
    companies += [("shared1", "shared.com/a"), ("shared2", "shared.com/b/"), ("shared3", "shared.com/c")]
    attempts = [row for rows in PLAIN_SITES.values() for row in rows] + SHARED
    return run_companies(
        spark.createDataFrame(companies, "cid string, site string"), "cid", "site",
        captured(spark, attempts),
        options=Options(js_fallback=False, max_subpages=4, max_raw_links=200, max_child_sitemaps=3),
    )


@pytest.fixture(scope="module")
def plain_rows(plain):
    return plain.results.collect()


def row_of(rows, id_):
    found = [r for r in rows if r.id == id_]
    assert len(found) == 1
    return found[0]


def subpages(rows, id_):
    return [p.url.replace(f"https://{id_}", "") for p in row_of(rows, id_).pages[1:]]


def test_result_of_a_partly_captured_site(plain_rows, plain):
    row = row_of(plain_rows, "example.com")
    assert row.url == "https://example.com" and row.status == "partial"
    assert row.combined_text.startswith("[Page name: home]\nRoofs of slate")
    assert "\n\n[Page name: about]\nThree generations\nThe yard in the valley" in row.combined_text
    assert [(p.page_name, p.status, p.text_len > 0) for p in row.pages] == [
        ("home", 200, True), ("about", 200, True), ("products", 0, False), ("careers", 0, False),
    ]
    assert row.error == "No content from https://example.com/products"
    assert (row.num_pages_tried, row.num_pages_ok, row.retries_used) == (4, 2, 0)
    assert row.total_time_s == 1.0 and row.escalated_to_js is False
    log = row_of(plain.log.collect(), "example.com")
    assert (log.subpages_tried, log.subpages_ok, log.status, log.error) == (4, 2, "partial", row.error)
    assert log.ts == row.ts


def test_everything_blocked(plain_rows):
    row = row_of(plain_rows, "blocked.com")
    assert (row.status, row.combined_text, row.retries_used) == ("failed", "", 4)
    assert row.error == "Homepage blocked or empty: HTTP 403"


def test_one_row_per_input_row(plain_rows, plain):
    got = sorted(
        (r.id or "", r.url or "", r.status, r.error or "", r.num_pages_tried, len(r.pages))
        for r in plain_rows if r.id in ("copy", "none", "blank", None)
    )
    copy = ("copy", "https://example.com", "partial", "No content from https://example.com/products", 4, 4)
    assert got == [
        ("", "https://unseen.com", "failed", "Homepage blocked or empty: HTTP 0", 1, 1),
        ("blank", "  ", "failed", "missing url", 0, 0),
        copy, copy,
        ("none", "", "failed", "missing url", 0, 0),
    ]
    assert plain.log.count() == len(plain_rows)


def test_sitemap_comes_before_robots_and_anchors(plain_rows):
    # Only addresses that normalize to the homepage itself are left out.
    assert [p.url for p in row_of(plain_rows, "first.com").pages[1:]] == [
        "https://www.first.com", "https://first.com/s",
    ]


@pytest.mark.parametrize("host", ["r1.com", "r2.com", "r3.com", "r4.com", "r5.com", "r6.com"])
def test_robots_when_sitemap_is_unusable(plain_rows, host):
    assert subpages(plain_rows, host) == ["/r2", "/r1"]


def test_anchors_when_robots_leads_nowhere(plain_rows):
    assert subpages(plain_rows, "dead.com") == ["/anchor"]


def test_foreign_sitemap_hides_anchors(plain_rows):
    assert subpages(plain_rows, "foreign.com") == []


def test_sitemap_index_reads_three_children(plain_rows):
    assert subpages(plain_rows, "index.com") == ["/p1", "/p2"]


def test_cap_comes_before_filter_and_dedupe(plain_rows):
    assert subpages(plain_rows, "cap.com") == ["/a", "/b"]


def test_companies_share_a_site_and_its_pages(plain_rows):
    got = {n: [(p.url[-2:], p.page_name) for p in row_of(plain_rows, f"shared{n}").pages] for n in (1, 2, 3)}
    a, b = ("/a", "a"), ("/b", "b")
    assert got == {1: [("/a", "home"), b], 2: [("/b", "home"), a], 3: [("/c", "home"), a, b]}


def test_hot_keys_change_nothing(spark, plain, plain_rows, monkeypatch):
    """The same run with every shared site, homepage and page split over tasks."""
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    companies = plain.companies.selectExpr("id AS cid", "url AS site")
    run = run_companies(companies, "cid", "site", plain.attempts, None, plain.options, plain.started)

    def comparable(rows):
        return sorted(str(r) for r in rows)

    assert comparable(run.results.collect()) == comparable(plain_rows)
    assert comparable(run.log.collect()) == comparable(plain.log.collect())
    assert comparable(run.raw.collect()) == comparable(plain.raw.collect())


def test_without_limits_all_links_and_children_are_read(spark):
    hosts = ("index.com", "cap.com")
    attempts = [row for h in hosts for row in PLAIN_SITES[h]]
    run = run_companies(
        spark.createDataFrame([(h, h) for h in hosts], "id string, url string"), "id", "url",
        captured(spark, attempts), options=Options(js_fallback=False),
    )
    rows = run.results.collect()
    assert subpages(rows, "index.com") == ["/p1", "/p2", "/p3", "/p4"]
    assert subpages(rows, "cap.com") == ["/a", "/b", "/c"]


def test_best_links_are_exact_for_every_homepage(spark):
    """Many links of one normal form, which are the homepage of one of two companies."""
    same = [f"https://one.com/about#{n}" for n in range(40)]
    others = [f"https://one.com/p{n}" for n in range(9)]
    found = {}
    for limit in (2, 4, 6):
        run = run_companies(
            spark.createDataFrame([("a", "one.com/about"), ("b", "one.com")], "id string, url string"), "id", "url",
            captured(spark, [("https://one.com/sitemap.xml", 200, sitemap(*same, *others))]),
            options=Options(js_fallback=False, max_subpages=limit),
        )
        for r in run.results.collect():
            found[r.id, limit] = [p.url for p in r.pages[1:]]
    for limit in (2, 4, 6):
        assert found["a", limit] == others[: limit - 1]
        assert found["b", limit] == same[: limit - 1]


ANCHOR = LONG.format("<a href=/t>t</a>")
MANY_LINKS = "".join(f'<a href="/p{n}">x</a>' for n in range(300)) + '<a href="/about">x</a>'
RENDER_SITES = {
    "ok.com": ([(0, 403, ANCHOR)], LONG.format("")),
    "short.com": ([(0, 403, ANCHOR)], "<p>short</p>"),
    "challenge.com": ([(0, 403, ANCHOR)], LONG.format("<p>Just a Moment</p>")),
    "waiting.com": ([(0, 403, ANCHOR)], None),
    "thin.com": ([(0, 200, HOME)], None),
    "links.com": ([(0, 200, LONG.format(""))], LONG.format("<p>Access denied</p>" + MANY_LINKS)),
    "nolinks.com": ([(0, 200, LONG.format(""))], None),
    "retried.com": ([(0, 403, "no"), (1, 200, ANCHOR)], None),
    "unseen.com": ([], LONG.format("")),
}


@pytest.fixture(scope="module")
def rendered(spark):
    """A run with rendering, two pages per company and two attempts per page."""
    attempts = [(f"https://{h}", *a) for h, (log, _) in RENDER_SITES.items() for a in log]
    attempts += [("https://links.com/about", 0, 200, LONG.format("")), ("https://retried.com/t", 0, 200, "<p>thin</p>")]
    renders = [(f"https://{h}", body) for h, (_, body) in RENDER_SITES.items() if body]
    renders += [("https://retried.com/t", "<p>t2</p>"), ("https://ok.com", "<p>older, shorter</p>")]
    return run_companies(
        spark.createDataFrame([(h, h) for h in RENDER_SITES], "id string, url string"), "id", "url",
        captured(spark, attempts), spark.createDataFrame(renders, RENDERS_SCHEMA),
        Options(max_subpages=2, retry_mode="minimal"),
    )


@pytest.fixture(scope="module")
def rendered_rows(rendered):
    return rendered.results.collect()


@pytest.mark.parametrize("host,ok", [("ok.com", 1), ("short.com", 0), ("challenge.com", 0), ("waiting.com", 0)])
def test_blocked_homepage_is_rendered(rendered_rows, host, ok):
    row = row_of(rendered_rows, host)
    assert row.escalated_to_js and row.pages[0].status == 403
    assert (row.num_pages_ok, row.num_pages_tried) == (ok, 1)  # the blocked body's links are not used


def test_thin_homepage_loses_its_own_text(rendered_rows):
    row = row_of(rendered_rows, "thin.com")
    assert (row.combined_text, row.num_pages_tried, row.status) == ("", 1, "failed")


def test_homepage_without_links_is_rendered_for_links_only(rendered_rows):
    row = row_of(rendered_rows, "links.com")
    assert row.pages[0].escalated_to_js and "denied" not in row.combined_text
    # Rendered links have no cap of 200, so the keyword page at place 301 is found.
    assert row.pages[1].url == "https://links.com/about" and not row.pages[1].escalated_to_js
    assert row.status == "ok" and row.error is None


def test_uncaptured_page_with_a_rendering(rendered_rows):
    row = row_of(rendered_rows, "unseen.com")
    assert (row.status, row.pages[0].status, row.escalated_to_js) == ("ok", 0, True)


def test_render_queue(rendered):
    assert {(r.page_url, r.reason) for r in rendered.render_queue.collect()} == {
        ("https://waiting.com", "blocked"),
        ("https://thin.com", "thin_text"),
        ("https://nolinks.com", "no_links"),
    }


def test_raw_pages(rendered):
    got = {r.page_url: (r.id, r.url, r.html, r.escalated_to_js) for r in rendered.raw.collect()}
    assert got["https://retried.com"] == ("retried.com", "https://retried.com", ANCHOR, False)
    assert got["https://retried.com/t"] == ("retried.com", "https://retried.com", "<p>t2</p>", True)
    assert got["https://ok.com"][2:] == (LONG.format(""), True)
    assert got["https://waiting.com"][2:] == ("", True)
    assert got["https://links.com"][2:] == (RENDER_SITES["links.com"][1], True)
    assert len(got) == len(RENDER_SITES) + 2


def test_empty_input(spark):
    run = run_companies(
        spark.createDataFrame([], "id string, url string"), "id", "url", captured(spark, [])
    )
    assert run.results.collect() == []
    assert len(run.results.columns) == 12


def test_write_all_targets(spark, tmp_path):
    out, log = f"{tmp_path}/results", f"{tmp_path}/log"
    options = Options(js_fallback=False, output_path=out, log_path=log, persist_raw_html=True)
    run = run_companies(
        spark.createDataFrame([(42, "x.com")], "id int, url string"), "id", "url",
        captured(spark, [("https://x.com", 200, HOME)]), None, options,
    )
    run.write()
    run.write()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["42", "42"]
    assert spark.read.parquet(log).count() == 2
    assert spark.read.parquet(out + "_raw").count() == 8


def test_resume_fills_each_target(spark, tmp_path, monkeypatch):
    """A failure between two targets; the run is repeated and every target is whole."""
    out, log = f"{tmp_path}/results", f"{tmp_path}/log"
    options = Options(js_fallback=False, max_subpages=1, output_path=out, log_path=log, persist_raw_html=True)
    companies = spark.createDataFrame([(n, f"x{n}.com") for n in range(3)], "id int, url string")
    attempts = captured(spark, [(f"https://x{n}.com", 200, HOME) for n in range(3)])
    run = run_companies(companies.where("id < 2"), "id", "url", attempts, None, options)

    def fails(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(type(run), "log", property(fails))
    with pytest.raises(RuntimeError, match="lost"):
        run.write(resume=True)
    monkeypatch.undo()
    assert spark.read.parquet(out + "_raw").count() == 2
    run = run_companies(companies, "id", "url", attempts, None, options)
    run.write(resume=True)
    run.write(resume=True)
    for target in (out, log, out + "_raw"):
        assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["0", "1", "2"]
    run.close()
