"""Folding an ordered log of fetch attempts into one outcome per page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import expr

from sitetext.config import Options
from sitetext.functions.judgement import is_blocked
from sitetext.functions.sql import Sql

_AFTER_ANY_ATTEMPT = 1_000_000
# Captures without a time count as the oldest.
CAPTURED_AT = "coalesce(unix_micros(fetched_at), 0)"


def attempt_rank(content: Sql) -> Sql:
    """Sort key under which the terminal attempt of a page comes first.

    The first attempt that is not blocked ends the page (a 404 included); if all are blocked,
    the last one counts. Among copies of one attempt the latest capture counts, and among those
    the hash of the content decides, so that a task run again picks the same one.
    """
    order = f"if({is_blocked('status')}, {_AFTER_ANY_ATTEMPT} - attempt, attempt)"
    return f"struct({order} AS position, -{CAPTURED_AT} AS age, {content} AS content)"


def times_by_attempt(options: Options) -> list[Column]:
    """Aggregates for `first_and_last`: capture times of the attempts up to each number."""

    def upto(function: str) -> Column:
        times = ", ".join(
            f"{function}(if(attempt <= {n}, fetched_at, NULL))" for n in range(options.attempt_budget)
        )
        return expr(f"array({times})").alias(f"_{function}_times")

    return [upto("min"), upto("max")]


def first_and_last(terminal: Sql) -> tuple[Sql, Sql]:
    """Times of the first and last capture of a page up to its terminal attempt; later attempts
    don't count."""
    number = f"CAST({terminal} AS int)"
    return (
        f"get(_min_times, {number}) AS first_fetched",
        f"get(_max_times, {number}) AS last_fetched",
    )


def within_budget(attempts: DataFrame, options: Options) -> DataFrame:
    """Attempts the retry mode allows. A missing number is read as the first attempt, a missing
    status as no response."""
    numbered = attempts.withColumn("attempt", expr("coalesce(attempt, 0)"))
    return numbered.where(f"attempt < {options.attempt_budget}").withColumn(
        "status", expr("coalesce(status, 0)")
    )


def fold_attempts(
    attempts: DataFrame,
    options: Options,
    keys: Sequence[str] = ("page_url",),
    payload: Sequence[str] = ("html",),
) -> DataFrame:
    """One row per page: keys, status, payload of the terminal attempt, retries_used.

    One shuffle on the keys. Each task first keeps its own best attempt per page, so a page
    with very many rows sends one row per task.
    """
    outcome = ", ".join(("status", "attempt AS retries_used", *payload))
    rank = attempt_rank(f"xxhash64({', '.join(('status', *payload))})")
    return (
        within_budget(attempts, options)
        .groupBy(*keys)
        .agg(expr(f"min_by(struct({outcome}), {rank})").alias("o"))
        .select(*keys, "o.status", *[f"o.{c}" for c in payload], "o.retries_used")
    )


def next_attempts(
    attempts: DataFrame, options: Options, keys: Sequence[str] = ("page_url",)
) -> DataFrame:
    """Pages to try again: the number of the next attempt and the seconds to wait before it."""
    delays = ", ".join(f"{d}D" for d in options.retry_delays)
    return (
        fold_attempts(attempts, options, keys, payload=())
        .where(f"{is_blocked('status')} AND retries_used + 1 < {options.attempt_budget}")
        .selectExpr(
            *keys,
            "status",
            "retries_used + 1 AS attempt",
            f"array({delays})[retries_used + 1] AS delay_s",
        )
    )
