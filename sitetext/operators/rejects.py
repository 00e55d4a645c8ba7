"""Captured rows that can't be used as they are, with the reasons, beside the run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.functions import expr

from sitetext.functions.sitemaps import is_broken_sitemap
from sitetext.functions.sql import Sql, bind


def _never_closed(html: Sql, opening: str, closing: str) -> Sql:
    """True if the last `opening` has no `closing` after it; one look from the end of the page,
    which costs much more than one from its start, so only pages with an `opening` are given it."""
    return (
        f"(contains({html}, '{opening}') "
        f"AND contains(substring_index({html}, '{closing}', -1), '{opening}'))"
    )


def _unclosed(html: Sql) -> Sql:
    tests = (("<!--", "-->"), ("<script", "</script"), ("<style", "</style"))
    found = bind(
        f"lower({html})", lambda page: " OR ".join(_never_closed(page, *t) for t in tests)
    )
    return f"contains({html}, '<') AND {found}"


#: Reasons in the order they are listed in, with their conditions on a captured row. The rows of
#: the first three take no part in a run; those of the others do, with what can be read of them.
FAULTS: dict[str, Sql] = {
    "no_address": "trim(coalesce(page_url, '')) = ''",
    "bad_attempt": "attempt < 0",
    "bad_status": "status <> 0 AND status NOT BETWEEN 100 AND 599",
    "no_markup": "status = 200 AND NOT rlike(coalesce(html, ''), '[^ \\\\t-\\\\r]')",
    "unclosed": _unclosed("html"),
    "broken_xml": is_broken_sitemap("html"),
}
FATAL = ("no_address", "bad_attempt", "bad_status")


def usable(attempts: DataFrame) -> DataFrame:
    """The rows that take part in a run; needs no markup."""
    return attempts.where(" AND ".join(f"NOT coalesce({FAULTS[f]}, false)" for f in FATAL))


def rejected_captures(attempts: DataFrame, observation: Observation | None = None) -> DataFrame:
    """page_url, attempt, status, fetched_at, chars (of html), faults and fatal of the rows with faults.

    One scan, without a shuffle, and no row makes it fail. An `observation` counts in the same pass
    all rows (rows), those with a fault (rejected), and those of each reason, by its name. Counts
    are taken without one too: they keep the filter on the faults above the column, which would
    else be computed twice, and markup that is itself computed once for each of its uses.
    """
    found = [f"if(coalesce({test}, false), '{name}', NULL)" for name, test in FAULTS.items()]
    rows = attempts.select(
        "page_url", "attempt", "status", "fetched_at",
        expr("coalesce(length(html), 0)").alias("chars"),
        expr(f"array_compact(array({', '.join(found)}))").alias("faults"),
    )
    rows = rows.observe(
        "faults" if observation is None else observation,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("faults") > 0).alias("rejected"),
        *(F.count_if(F.array_contains("faults", name)).alias(name) for name in FAULTS),
    )
    fatal = ", ".join(f"'{f}'" for f in FATAL)
    return rows.where("size(faults) > 0").withColumn(
        "fatal", expr(f"arrays_overlap(faults, array({fatal}))")
    )
