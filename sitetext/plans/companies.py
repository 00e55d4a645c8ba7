"""The whole run: companies and captured pages in, results, log and raw pages out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitetext.config import LOG_SCHEMA, RAW_SCHEMA, RESULTS_SCHEMA, Options
from sitetext.operators.boilerplate import repeated_blocks, without_boilerplate
from sitetext.operators.discovery import discover, select_pages, site_documents
from sitetext.operators.pages import page_digests, render_queue
from sitetext.operators.rejects import rejected_captures
from sitetext.operators.rollup import (
    company_pages,
    log_rows,
    raw_rows,
    result_rows,
    roll_up,
    tally,
)
from sitetext.plans.staging import Staging
from sitetext.sources.commits import commit, committed
from sitetext.sources.sinks import append, append_new, with_schema
from sitetext.sources.tables import company_rows, with_company_key


@dataclass(frozen=True)
class Run:
    """A run whose page records and page selection are staged; its tables are lazy.

    Staged are the keyed companies, the page records (the one pass over html) and the pages
    selected per company. Results and log start from there and read only their own columns, so
    writing the log does not read any text.
    """

    options: Options
    staging: Staging
    companies: DataFrame
    digests: DataFrame
    selected: DataFrame
    attempts: DataFrame
    renders: DataFrame | None
    started: datetime

    @property
    def _ts(self) -> Column:
        return F.timestamp_micros(F.lit(int(self.started.timestamp() * 1_000_000)))

    @cached_property
    def _rows(self) -> int:
        """Number of selected pages; a look at the file footers of the staged table."""
        return self.selected.count()

    @cached_property
    def pages(self) -> DataFrame:
        """Selected pages with their outcome and text, one row per company and page."""
        return company_pages(self.selected, self.digests, self.options, self._rows)

    @cached_property
    def results(self) -> DataFrame:
        rows = result_rows(self.companies, roll_up(self.pages), self._ts)
        return with_schema(rows, RESULTS_SCHEMA)

    @cached_property
    def log(self) -> DataFrame:
        rows = log_rows(self.companies, tally(self.pages), self._ts)
        return with_schema(rows, LOG_SCHEMA)

    @cached_property
    def raw(self) -> DataFrame:
        rows = raw_rows(
            self.companies, self.pages, self.attempts, self.renders, self.options,
            self._rows,
        )
        return with_schema(rows, RAW_SCHEMA)

    @cached_property
    def render_queue(self) -> DataFrame:
        """Pages of this run that wait for a rendering."""
        return render_queue(self.pages, self.renders)

    @cached_property
    def rejects(self) -> DataFrame:
        """Captured rows with faults and the reasons; reads all markup once more."""
        return rejected_captures(self.attempts)

    def write(self, resume: bool = False) -> None:
        """Append raw pages, log and results, in this order, to the targets that are set.

        Results come last: an id among them has its rows in the other targets. With `resume`,
        ids that a target has already are left out there.
        """
        options, put = self.options, append_new if resume else append
        if options.raw_path:
            put(self.raw, options.raw_path, options.file_format)
        if options.log_path:
            put(self.log, options.log_path, options.file_format)
        if options.output_path:
            put(self.results, options.output_path, options.file_format)

    def commit(self, run_id: str) -> bool:
        """Write all targets that are set so that readers of `read_committed` see all or none.

        A run id that is committed already writes nothing and gives False; one whose try failed is
        written anew.
        """
        options = self.options
        if not options.output_path:
            raise ValueError("a commit needs output_path")
        targets = {options.raw_path: "raw", options.log_path: "log", options.output_path: "results"}
        frames = {target: getattr(self, name) for target, name in targets.items() if target}
        return commit(frames, options.runs_path, run_id, options.file_format)

    def close(self) -> None:
        """Remove the staged tables; the tables of the run can't be read any more."""
        self.staging.remove()


def read_committed(spark: SparkSession, options: Options, table: str) -> DataFrame:
    """Rows of all committed runs in `results`, `log` or `raw`, with their run_id."""
    target, ddl = {
        "results": (options.output_path, RESULTS_SCHEMA),
        "log": (options.log_path, LOG_SCHEMA),
        "raw": (options.raw_path, RAW_SCHEMA),
    }[table]
    return committed(spark, target, options.runs_path, ddl, options.file_format)


def run_companies(
    companies: DataFrame,
    id_col: str,
    url_col: str,
    attempts: DataFrame,
    renders: DataFrame | None = None,
    options: Options = Options(),
    started: datetime | None = None,
) -> Run:
    """Read, judge and assemble the pages of each company.

    `attempts` is the fetch log with captured markup (see ATTEMPTS_SCHEMA), `renders` the pages
    rendered so far (RENDERS_SCHEMA). One row per input company comes out, copies included.
    """
    staging = Staging(companies.sparkSession)
    keyed = staging.stage(
        with_company_key(company_rows(companies, id_col, url_col)), "companies"
    )
    digests = staging.stage(page_digests(attempts, renders, options), "digests")
    if options.boilerplate_pages is not None:
        repeated = staging.stage(repeated_blocks(digests, options.boilerplate_pages), "repeated")
        cleaned = without_boilerplate(digests, repeated).drop("n_dropped")
        digests = staging.stage(cleaned.withColumn("text_len", F.length("text")), "cleaned")
    documents = staging.stage(site_documents(digests), "documents")
    located = keyed.where("home IS NOT NULL").select("company_key", "home")
    selected = staging.stage(
        select_pages(
            discover(located, digests, documents, options, keyed.count(), staging), options
        ),
        "selected",
    )
    return Run(
        options=options,
        staging=staging,
        companies=keyed,
        digests=digests,
        selected=selected,
        attempts=attempts,
        renders=renders,
        started=started or datetime.now(timezone.utc),
    )
