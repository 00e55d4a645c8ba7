"""Companies that arrive as a stream: each micro-batch is one run, appended to the targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sitetext.config import Options
from sitetext.plans.companies import run_companies
from sitetext.sources.sinks import existing
from sitetext.sources.tables import pending

Captures = Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]


def start_runs(
    companies: DataFrame,
    id_col: str,
    url_col: str,
    captures: Captures,
    options: Options,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Run every micro-batch of a stream of companies and append its results.

    `captures` gives the attempts and renders for the companies of a batch. Ids that are in the
    results already are skipped. Results are written last, and every target skips the ids that it
    has, so a batch that is run again after a failure adds what is missing and nothing twice. The
    staged tables of a batch are removed when it is written.
    """
    if not options.output_path:
        raise ValueError("a stream of companies needs output_path")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        done = existing(batch.sparkSession, options.output_path, options.file_format)
        todo = batch if done is None else pending(batch, done, id_col)
        attempts, renders = captures(todo)
        run = run_companies(todo, id_col, url_col, attempts, renders, options)
        run.write(resume=True)
        run.close()

    return (
        companies.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
