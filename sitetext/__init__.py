"""Captured web pages to one clean text record per company, on Spark."""

from sitetext.config import HIGH_VALUE_KEYWORDS, LOW_VALUE_KEYWORDS, Options
from sitetext.plans.companies import Run, read_committed, run_companies

__all__ = ["HIGH_VALUE_KEYWORDS", "LOW_VALUE_KEYWORDS", "Options", "Run", "read_committed", "run_companies"]
