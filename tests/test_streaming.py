"""A stream of companies, run batch by batch."""

import pytest

from sitetext import Options
from sitetext.operators.attempts import fold_attempts
from sitetext.streaming.attempts import due_attempts, fold_attempts_stream
from sitetext.streaming.microbatch import start_runs
from test_run import HOME, captured


def test_stream_of_companies(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    attempts = captured(spark, [("https://x.com", 200, HOME), ("https://y.com", 200, HOME)])
    options = Options(js_fallback=False, max_subpages=1, output_path=out)

    def run_all():
        stream = spark.readStream.schema("id string, url string").json(source)
        start_runs(stream, "id", "url", lambda batch: (attempts, None), options, f"{tmp_path}/cp").awaitTermination()
        return sorted((r.id, r.url, r.status) for r in spark.read.parquet(out).collect())

    def arrive(*rows):
        spark.createDataFrame(list(rows), "id string, url string").write.mode("append").json(source)

    arrive(("x", "x.com"))
    assert run_all() == [("x", "https://x.com", "ok")]
    arrive(("y", "y.com"), ("x", "x.com"))  # x is done already
    assert run_all() == [("x", "https://x.com", "ok"), ("y", "https://y.com", "ok")]


def test_stream_needs_a_target(spark):
    with pytest.raises(ValueError, match="output_path"):
        start_runs(spark.range(1), "id", "id", lambda batch: (None, None), Options(), "/tmp/none")


ARRIVALS = [
    # (page, attempt, status, html, second): attempts of a page come in any order and in any batch.
    [("a", 1, 403, "no", 1), ("b", 0, 200, "b0", 2), ("c", 2, 503, "c2", 3), ("d", 0, 404, "gone", 4)],
    [("a", 2, 200, "a2", 20), ("b", 0, 200, "b0 again", 30), ("c", 0, 403, "c0", 5), ("b", 3, 200, "late", 31)],
    [("a", 0, 200, "a0", 6), ("c", 1, 0, None, 7), ("a", 9, 200, "beyond", 40), (None, 0, 200, "x", 41)],
]


def test_folded_stream_equals_the_batch_fold(spark, tmp_path):
    source = f"{tmp_path}/log"
    schema = "page_url string, attempt int, status int, html string, s int"
    options = Options()
    updates = []

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        rows = stream.selectExpr("* EXCEPT (s)", "timestamp_seconds(1700000000 + s) AS fetched_at")
        folded = fold_attempts_stream(rows, options, lateness="10 minutes")
        (
            folded.writeStream.outputMode("update")
            .option("checkpointLocation", f"{tmp_path}/cp")
            .foreachBatch(lambda batch, n: updates.extend(batch.collect()))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    for rows in ARRIVALS:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    all_rows = spark.createDataFrame([r for rows in ARRIVALS for r in rows], schema).selectExpr(
        "* EXCEPT (s)", "timestamp_seconds(1700000000 + s) AS fetched_at"
    )
    expected = {
        r.page_url: (r.status, r.html, r.retries_used)
        for r in fold_attempts(all_rows, options).collect()
        if r.page_url
    }
    latest = {r.page_url: (r.status, r.html, r.retries_used) for r in updates}
    assert latest == expected
    assert not any(r.final for r in updates)
    due = due_attempts(spark.createDataFrame(updates, "page_url string, status int, retries_used int, html string, final boolean"), options)
    assert {(r.page_url, r.attempt, r.delay_s) for r in due.collect()} == {("a", 2, 2.0), ("c", 3, 4.0)}
    # Long after, the pages are closed, and what comes for them behind the watermark is dropped.
    for rows in ([("z", 0, 200, "z", 9000)], [("a", 0, 404, "too late", 8), ("y", 0, 200, "y", 9001)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    closed = {r.page_url: (r.status, r.html, r.retries_used) for r in updates if r.final}
    assert closed == expected
    assert {r.page_url: r.html for r in updates if not r.final} | {"z": "z", "y": "y"} == {
        r.page_url: r.html for r in updates if not r.final
    }
