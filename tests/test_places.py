"""Markup read by its place, and lines that pages of a host share."""

import pytest
from pyspark.sql import functions as F

from sitetext import Options, run_companies
from sitetext.config import ATTEMPTS_SCHEMA
from sitetext.operators.boilerplate import repeated_blocks, without_boilerplate
from sitetext.operators.pages import page_digests, render_queue
from sitetext.plans.records import RecordStore
from sitetext.sources.places import read_at, with_places
from sitetext.sources.tables import captured_attempts, read_captures
from test_run import LONG, captured


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cap") / "odd name=1 é")
    rows = spark.range(3000).selectExpr(
        "id", "if(id % 7 = 0, NULL, concat('<p>', repeat(CAST(id AS string), 1 + id % 50), '</p>')) AS html"
    )
    rows.repartition(3).write.option("parquet.block.size", 20_000).option(
        "parquet.page.row.count.limit", 50
    ).parquet(path)
    return with_places(spark.read.parquet(path))


def test_rows_are_read_from_their_places(spark, stored):
    wanted = stored.where("id % 3 = 0").select("id", "place")
    more = wanted.union(wanted.where("id < 600")).union(
        wanted.where("id < 5").selectExpr("-1L AS id", "if(true, NULL, place) AS place")
    )
    expected = more.join(stored.selectExpr("id", "html"), "id", "left")
    order = lambda df: sorted(map(str, df.select("id", "html").collect()))
    assert order(read_at(more)) == order(expected)
    assert read_at(wanted.where("id < 0")).count() == 0


def test_no_exchange_lies_below_markup(spark, stored):
    plan = read_at(stored.select("id", "place"))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :].split("\n", 1)[1]
    assert "html" not in below


@pytest.mark.parametrize("rendered", [False, True])
def test_a_run_by_places_equals_one_without(spark, tmp_path, rendered):
    page = LONG.format('<a href="/a">a</a><a href="/b">b</a>')
    rows = [("https://x.com", n, 403, "") for n in range(2)] + [("https://x.com", 2, 200, page)]
    rows += [("https://x.com/a", 200, page.replace("plain", "other")), ("https://x.com/b", 503, "no")]
    captured(spark, rows).repartition(2).write.parquet(f"{tmp_path}/attempts")
    shown = [("https://x.com/b", page), ("https://x.com/b", page + page.replace("plain", "longer"))]
    spark.createDataFrame(shown, "page_url string, html string").write.parquet(f"{tmp_path}/renders")
    companies = spark.createDataFrame([("1", "x.com"), ("2", "x.com"), ("3", "gone.com")], "id string, url string")

    def tables(places):
        attempts = read_captures(spark, f"{tmp_path}/attempts", places=places)
        renders = read_captures(spark, f"{tmp_path}/renders", places=places) if rendered else None
        run = run_companies(companies, "id", "url", attempts, renders, Options(max_subpages=3))
        results = sorted(map(str, run.results.drop("ts").collect()))
        return results, sorted(map(str, run.raw.collect()))

    assert tables(True) == tables(False)


def test_places_of_plain_captures(spark, tmp_path):
    rows = [("https://x.com", "<p>x</p>")]
    spark.createDataFrame(rows, "page_url string, html string").withColumn(
        "fetched_at", F.current_timestamp()
    ).write.parquet(f"{tmp_path}/c")
    attempts = captured_attempts(read_captures(spark, f"{tmp_path}/c", places=True))
    assert read_at(attempts.drop("html")).first().html == "<p>x</p>"


# Lines that pages of a host share

PAGES = [
    *((f"https://www.h.com/{n}", f"Menu\nText {n}\n\nFooter {n % 2}\nMenu") for n in range(6)),
    ("https://h.com/6", "Menu only here"), ("https://h.com/0", "Menu"), ("https://other.com/", "Menu\nText 0"),
    ("https://other.com/1", None), ("https://other.com/2", ""), (None, "Menu"),
    # One page twice: its lines count once.
    ("https://two.com/a", "Same\nline"), ("https://two.com/a", "Same\nline"), ("https://two.com/b", "Same"),
    *((f"https://hot.com/{n}", f"Hot\n{n}") for n in range(400)),
]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lines_of_a_host_are_dropped(spark, broadcast_bytes):
    pages = spark.createDataFrame(
        [(u, t, "x", "y") for u, t in PAGES], "page_url string, text string, host string, block string"
    ).repartition(4)
    repeated = repeated_blocks(pages, min_pages=3).cache()
    found = without_boilerplate(pages, repeated, broadcast_bytes=broadcast_bytes)
    assert found.columns == [*pages.columns, "n_dropped"] or set(found.columns) == {*pages.columns, "n_dropped"}
    want = []
    for url, text in PAGES:
        lines = (text or "").split("\n")
        host = (url or "").split("//")[-1].split("/")[0].removeprefix("www.")
        gone = {"h.com": {"Menu", "Footer 0", "Footer 1"}, "hot.com": {"Hot"}}.get(host, set())
        kept = [x for x in lines if x not in gone]
        want.append((url, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    got = [(r.page_url, r.text, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_run_without_boilerplate(spark):
    page = "<html><body><p>{0}</p><p>" + "plain words " * 40 + "</p><a href='/{1}'>a</a></body></html>"
    rows = [(f"https://x.com{p}", 200, page.format(f"own {p}", n)) for n, p in enumerate(["", "/0", "/1"])]
    companies = spark.createDataFrame([("1", "x.com")], "id string, url string")
    text = {
        n: run_companies(
            companies, "id", "url", captured(spark, rows), options=Options(boilerplate_pages=n)
        ).results.first().combined_text
        for n in (None, 2)
    }
    assert "plain words" in text[None] and "plain words" not in text[2] and "own" in text[2]
    with pytest.raises(ValueError):
        Options(boilerplate_pages=1)


SHARED = "https://x.com/a"


def shared_address(spark, folder):
    """Files of attempts of four pages with one address, and of renderings of the odd ones."""
    rows = [
        (n, SHARED, 0, status, LONG.format(word), None)
        for n, status, word in ((1, 403, "a"), (2, 200, "b"), (3, 404, "c"), (4, 403, "d"))
    ]
    spark.createDataFrame(rows, f"page_id int, {ATTEMPTS_SCHEMA}").write.parquet(f"{folder}/log")
    attempts = spark.read.parquet(f"{folder}/log")
    attempts.where("page_id % 2 = 1").select("page_id", "page_url", "html").write.parquet(f"{folder}/shown")
    return attempts, spark.read.parquet(f"{folder}/shown")


SHARED_RECORDS = [
    (1, SHARED, 403, "blocked", True), (2, SHARED, 200, None, True),
    (3, SHARED, 404, None, True), (4, SHARED, 403, "blocked", False),
]


def records(digests):
    return sorted((r.page_id, r.page_url, r.status, r.reason, r.text_len > 0) for r in digests.collect())


@pytest.mark.parametrize("places", [False, True])
def test_pages_with_one_address_keep_a_record_each(spark, tmp_path, places):
    attempts, renders = shared_address(spark, tmp_path)
    if places:
        attempts, renders = with_places(attempts), with_places(renders)
    assert records(page_digests(attempts, renders, Options(), keys=("page_id", "page_url"))) == SHARED_RECORDS
    # Told apart by the address alone, they are one page.
    assert page_digests(attempts, renders, Options()).count() == 1


def test_captures_with_one_address_keep_a_record_each(spark):
    captures = spark.createDataFrame(
        [(1, SHARED, LONG.format("first")), (2, SHARED, LONG.format("second"))], "page_id int, page_url string, html string"
    ).withColumn("fetched_at", F.expr("timestamp_seconds(page_id)"))
    keys = ("page_id", "page_url")
    found = page_digests(captured_attempts(captures, keys), None, Options(js_fallback=False), keys=keys)
    got = sorted((r.page_id, r.text.split()[-1]) for r in found.collect())
    assert got == [(1, "first"), (2, "second")]
    assert page_digests(captured_attempts(captures), None, Options(js_fallback=False)).count() == 1


def test_a_store_keeps_pages_with_one_address_apart(spark, tmp_path):
    shared_address(spark, tmp_path)
    store = RecordStore(spark, f"{tmp_path}/store", Options(), keys=("page_id", "page_url"))
    store.add(f"{tmp_path}/shown", renders=True)
    store.add(f"{tmp_path}/log")
    assert records(store.digests()) == SHARED_RECORDS


def test_lines_of_pages_with_one_address_count_for_each(spark):
    pages = spark.createDataFrame(
        [(1, SHARED, "Menu\none"), (2, SHARED, "Menu\nMenu\ntwo"), (2, SHARED, "Menu")], "page_id int, page_url string, text string"
    )
    assert repeated_blocks(pages, min_pages=2).count() == 0
    repeated = repeated_blocks(pages, min_pages=2, page="page_id").cache()
    assert [r.n_pages for r in repeated.collect()] == [2]
    got = sorted((r.page_id, r.text, r.n_dropped) for r in without_boilerplate(pages, repeated).collect())
    assert got == [(1, "one", 1), (2, "", 1), (2, "two", 2)]


def test_pages_with_one_address_wait_for_a_rendering_each(spark):
    judged = spark.createDataFrame(
        [(1, SHARED, "blocked"), (2, SHARED, "blocked"), (2, SHARED, "blocked"), (3, SHARED, "blocked"), (4, SHARED, None)],
        "page_id int, page_url string, reason string",
    )
    renders = spark.createDataFrame([(3, SHARED, "x")], "page_id int, page_url string, html string")
    queue = render_queue(judged, renders, keys=("page_id", "page_url"))
    assert sorted(map(tuple, queue.collect())) == [(1, SHARED, "blocked"), (2, SHARED, "blocked")]
    assert render_queue(judged, renders).count() == 0
