"""Fixed values and run options."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# These must equal the published behaviour for results to agree.

BINARY_EXTENSIONS = (
    "pdf", "jpg", "jpeg", "png", "gif", "svg", "webp",
    "zip", "tar", "gz", "doc", "docx", "xls", "xlsx",
    "ppt", "pptx", "css", "js", "xml", "json", "ico",
)

BLOCKING_STATUSES = (403, 429, 503)
NO_RESPONSE = 0
NOT_FOUND = 404

CHALLENGE_PHRASES = (
    "just a moment", "access denied", "attention required",
    "checking your browser", "captcha", "robot verification",
)

SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"

MIN_TEXT_LENGTH = 200

# Messages and the heading of a page in the combined text.
MISSING_URL = "missing url"
EMPTY_HOMEPAGE = "Homepage blocked or empty: HTTP "
EMPTY_PAGE = "No content from "
BLOCK_TITLE = "[Page name: "

HIGH_VALUE_KEYWORDS = (
    "about", "about-us", "company", "who-we-are", "what-we-do",
    "mission", "vision", "team", "products", "product", "services",
    "solutions", "technology", "platform", "industries", "customers",
    "case-studies",
)
LOW_VALUE_KEYWORDS = (
    "careers", "jobs", "press", "blog", "news", "events", "contact",
    "legal", "privacy", "terms", "cookie", "login", "signin", "signup", "cart",
)

# Seconds to wait before attempt 0, 1, 2, ... in each retry mode; the length is
# the attempt budget.
RETRY_DELAYS = {
    "none": (0.0,),
    "minimal": (0.0, 0.0),
    "full": (0.0, 1.0, 2.0, 4.0, 8.0),
}

RESULTS_SCHEMA = (
    "id string, url string, combined_text string, num_pages_tried int, num_pages_ok int, "
    "pages array<struct<url:string,page_name:string,status:int,text_len:int,escalated_to_js:boolean>>, "
    "escalated_to_js boolean, retries_used int, status string, error string, "
    "total_time_s double, ts timestamp"
)
LOG_SCHEMA = (
    "id string, url string, ts timestamp, status string, subpages_tried int, subpages_ok int, "
    "escalated_to_js boolean, retries_used int, total_time_s double, error string"
)
RAW_SCHEMA = (
    "id string, url string, page_url string, html string, "
    "fetched_at timestamp, escalated_to_js boolean"
)

# --- Input schemas that take the place of live fetching ---------------------

ATTEMPTS_SCHEMA = "page_url string, attempt int, status int, html string, fetched_at timestamp"
RENDERS_SCHEMA = "page_url string, html string"


@dataclass(frozen=True)
class Options:
    """Options of one run. Everything here becomes a literal in the plan.

    `max_raw_links` keeps the first so many links that a site's source gives, before any filter,
    and `max_child_sitemaps` reads the first so many children of a sitemap index; None, the
    default, takes all. `boilerplate_pages` drops lines that so many pages of a host share from the
    texts of pages, after they are judged; None, the default, keeps them.
    """

    max_subpages: int = 8
    max_raw_links: int | None = None
    max_child_sitemaps: int | None = None
    boilerplate_pages: int | None = None
    high_value_keywords: tuple[str, ...] = HIGH_VALUE_KEYWORDS
    low_value_keywords: tuple[str, ...] = LOW_VALUE_KEYWORDS
    retry_mode: str = "full"
    js_fallback: bool = True
    challenge_phrases: tuple[str, ...] = CHALLENGE_PHRASES
    output_path: str | None = None
    log_path: str | None = None
    persist_raw_html: bool = False
    file_format: str = "parquet"

    def __post_init__(self) -> None:
        if self.persist_raw_html and not self.output_path:
            raise ValueError("raw pages have no target: persist_raw_html needs output_path")
        if self.max_subpages < 1:
            raise ValueError("max_subpages counts the homepage and must be at least 1")
        if any(n is not None and n < 0 for n in (self.max_raw_links, self.max_child_sitemaps)):
            raise ValueError("max_raw_links and max_child_sitemaps must not be negative")
        if self.boilerplate_pages is not None and self.boilerplate_pages < 2:
            raise ValueError("boilerplate_pages must be at least 2")
        for name in ("high_value_keywords", "low_value_keywords", "challenge_phrases"):
            words = getattr(self, name)
            if isinstance(words, str):
                raise ValueError(f"{name} must be a sequence of strings, not one string")
            object.__setattr__(self, name, tuple(words))

    @property
    def retry_delays(self) -> tuple[float, ...]:
        """Delays of the retry mode; an unknown mode counts as full."""
        return RETRY_DELAYS.get(self.retry_mode, RETRY_DELAYS["full"])

    @property
    def attempt_budget(self) -> int:
        return len(self.retry_delays)

    @property
    def raw_path(self) -> str | None:
        """Target of the raw page table, or None when raw pages are not kept."""
        return f"{self.output_path}_raw" if self.persist_raw_html else None

    @property
    def runs_path(self) -> str:
        """Manifests of committed runs."""
        return f"{self.output_path}_runs"
