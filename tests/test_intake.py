"""Keys, shards, faults of captures, commits, and records that grow."""

import pytest
from pyspark.sql import Observation, functions as F

from sitetext import Options, read_committed, run_companies
from sitetext.config import ATTEMPTS_SCHEMA
from sitetext.functions.html import dense_text
from sitetext.operators.pages import page_digests
from sitetext.operators.rejects import FAULTS, rejected_captures
from sitetext.plans.records import RecordStore
from sitetext.sources import commits
from sitetext.sources.tables import balanced_shards, company_rows, with_company_key
from test_run import LONG, captured

ODD = [("1", "x.com"), ("1", "x.com"), ("1", "x.com"), ("1", "https://x.com"), (None, "x.com"), (None, None), ("", ""), ("1:", "x"), ("1", ":x")]


def test_keys_do_not_depend_on_the_split(spark):
    given = spark.createDataFrame(ODD * 3, "id string, url string")
    keys = [
        sorted(map(str, with_company_key(company_rows(given.repartition(n), "id", "url")).collect()))
        for n in (1, 5)
    ]
    assert keys[0] == keys[1]
    assert len({k.rsplit("company_key=", 1)[1] for k in keys[0]}) == len(ODD) * 3


def test_very_many_copies_get_a_key_each(spark):
    given = spark.range(25_001).selectExpr("'a' AS id", "'a.com' AS url", "'a.com' AS home")
    keyed = with_company_key(given)
    assert keyed.agg(F.count_distinct("company_key")).first()[0] == 25_001


@pytest.mark.parametrize("weight", ["1 + id % 97", "if(id = 5, 100000, 1)", "0", "NULL", "id"])
def test_balanced_shards(spark, weight):
    rows = spark.range(5000).selectExpr("id", f"CAST({weight} AS bigint) AS bytes", "'x' AS shard_name")
    found = balanced_shards(rows.repartition(3), "id", "bytes", 8)
    assert found.columns == ["id", "bytes", "shard_name", "shard"]
    sums = found.groupBy("shard").agg(F.sum(F.coalesce("bytes", F.lit(0))).alias("s"), F.count("*").alias("n")).collect()
    assert {r.shard for r in sums} <= set(range(8)) and sum(r.n for r in sums) == 5000
    total, widest = (rows.agg(F.expr(f"coalesce({f}(bytes), 0)")).first()[0] for f in ("sum", "max"))
    if total:
        assert max(r.s for r in sums) <= total / 8 + widest
    else:
        assert {r.n for r in sums} == {625}
    assert balanced_shards(rows.where("id < 0"), "id", "bytes", 8).count() == 0


FAULTY = [
    (" ", 0, 200, "<p>x</p>", "no_address"), (None, None, None, None, "no_address"), ("a", -1, 200, "<p>", "bad_attempt"),
    ("b", 0, 42, "x", "bad_status"), ("c", 0, 200, None, "no_markup"), ("d", 0, 200, " \n\t" * 10, "no_markup"),
    ("e", 0, 404, "", ""), ("f", 0, 200, "<SCRIPT >x", "unclosed"), ("g", 0, 200, "<!-- a --> <!-- b", "unclosed"),
    ("h", 0, 200, "<script></script><style>p{}</style><!-- -->", ""), ("i", 0, 200, "<sitemapindex >", "broken_xml"),
    ("j", 0, 200, "<sitemapindex></sitemapindex>", ""), ("k", 3, None, "no answer", ""), ("", -2, 7, " ", "no_address,bad_attempt,bad_status"),
    ("l", 0, 200, "<script>" * 30_000, "unclosed"), ("m", 0, 200, "<div>" * 100_000 + "x", ""),
]


def test_faults_of_captures(spark):
    attempts = spark.createDataFrame([(*r[:4], None) for r in FAULTY], ATTEMPTS_SCHEMA)
    seen = Observation("faults")
    rows = rejected_captures(attempts, seen).collect()
    expected = [(r[0], r[4]) for r in FAULTY if r[4]]
    assert sorted(((r.page_url, ",".join(r.faults)) for r in rows), key=str) == sorted(expected, key=str)
    assert {r.page_url for r in rows if r.fatal} == {" ", None, "a", "b", ""}
    counts = seen.get
    assert (counts["rows"], counts["rejected"]) == (len(FAULTY), len(expected))
    for name in FAULTS:
        assert counts[name] == sum(name in e[1].split(",") for e in expected)
    # The fatal ones take no part; none of the others makes a run fail.
    assert {r.page_url for r in page_digests(attempts, None, Options()).collect()} == set("cdefghijklm")


def test_markup_is_computed_once_for_all_faults(spark):
    """Not again in a filter below, there even once for each test that reads it."""
    attempts = spark.createDataFrame([(*r[:4], None) for r in FAULTY], ATTEMPTS_SCHEMA).withColumn(
        "html", F.expr("concat(html, 'spoilt', page_url)")
    )
    plan = rejected_captures(attempts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("spoilt") == 1


@pytest.mark.parametrize("html,expected", [
    (None, ""), ("", ""), ("<p>Short.</p>", "Short."),
    ("<ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul>", ""),
    ("<h2>Title</h2><p>" + "word " * 20 + "</p><p>far</p><p>away</p>", "Title\n" + ("word " * 20).strip() + "\nfar"),
    ("<p>" + "word " * 20 + "<a>linked</a> end.</p>", "word " * 20 + "linked end."),
    ("<a href=x><p>" + "card " * 30 + "</p><p>" + "more " * 30 + "</p></a>", ""),
    ("<p>" + "text " * 20 + "</p><a href=x>" + "<p>never closed</p>" * 3, ("text " * 20).strip()),
    ("<p>" + "private marks " * 9 + "</p>", ("private marks " * 9).strip()),
])
def test_dense_text(spark, html, expected):
    frame = spark.createDataFrame([(html,)], "html string")
    assert frame.select(F.expr(dense_text("html"))).first()[0] == expected


def test_a_failed_commit_shows_nowhere(spark, tmp_path, monkeypatch):
    page = LONG.format('<a href="/a">a</a>')
    attempts = captured(spark, [("https://x.com", 200, page), ("https://y.com", 200, page)])
    options = Options(
        output_path=f"{tmp_path}/out", log_path=f"{tmp_path}/log", persist_raw_html=True, max_subpages=1
    )

    def run(*hosts):
        companies = spark.createDataFrame([(h, f"{h}.com") for h in hosts], "id string, url string")
        return run_companies(companies, "id", "url", attempts, options=options)

    def seen():
        return [
            sorted((r.id, r.run_id) for r in read_committed(spark, options, t).collect())
            for t in ("results", "log", "raw")
        ]

    assert seen() == [[], [], []]
    first = run("x")
    calls = []
    real = commits.append
    monkeypatch.setattr(commits, "append", lambda *a: calls.append(a) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        first.commit("r1")
    assert calls and seen() == [[], [], []]
    monkeypatch.setattr(commits, "append", real)
    assert first.commit("r1") and not first.commit("r1")
    assert seen() == [[("x", "r1")]] * 3
    assert run("y", "x").commit("r2")
    assert seen() == [[("x", "r1"), ("x", "r2"), ("y", "r2")]] * 3
    for bad in ("", "a/b", "x=1"):
        with pytest.raises(ValueError):
            first.commit(bad)
    with pytest.raises(ValueError):
        commits.commit({"name": attempts}, f"{tmp_path}/runs", "r")


def test_records_read_only_what_is_new(spark, tmp_path):
    page = LONG.format('<a href="/a">a</a>')
    days = [
        [("https://x.com", 0, 403, "no"), ("https://y.com", 0, 200, page), (None, 0, 200, "x")],
        [("https://x.com", 1, 200, page), ("https://y.com", 0, 200, page), ("https://y.com", 0, 200, page + "new")],
        [("https://x.com", 0, 200, page.replace("plain", "early"))],
    ]
    log, folder, options = f"{tmp_path}/a log é", f"{tmp_path}/store", Options()
    store = RecordStore(spark, folder, options)
    contents = []
    for n, rows in enumerate(days):
        captured(spark, rows).coalesce(1).withColumn(
            "fetched_at", F.expr(f"fetched_at + INTERVAL {n} DAYS")
        ).write.mode("append").parquet(log)
        assert store.add(log) == 1
        assert store.add(log) == 0
        contents.append(spark.read.parquet(f"{folder}/contents").count())
        expected = page_digests(spark.read.parquet(log), None, options)
        columns = [c for c in expected.columns if c not in ("content", "render_content")]
        got = store.digests()
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))
    # The page that came again unchanged was not read again.
    assert contents == [2, 4, 5]
