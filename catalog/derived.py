"""Input tables of the pipeline, derived by Spark from the given `pages` and `documents`.

Every page row becomes captured input, so all of this grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitetext.config import SITEMAP_NAMESPACE
from sitetext.functions.html import anchor_hrefs, extract_text, visible_markup
from sitetext.functions.judgement import gated_text, is_blocked, render_reason
from sitetext.functions.sql import Sql, each, quoted
from sitetext.functions.urls import site_root, url_host, url_slug
from sitetext.sources.places import has_places
from sitetext.sources.tables import read_captures

HIGH = ("the", "en")
LOW = ("de", "html")
CHALLENGE = ("gegen", "leur")
# What tells pages apart: in large tables several have one address.
PAGE = ("page_id", "page_url")
# Numbers of pages that are one company where all pages of a host are gathered.
CHUNK = 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, folder: str, places: bool = False) -> DataFrame:
    """The pages as the file is split; `catalog.partitions` deals them out, as the bench does,
    whose file is one row group. With `places` they stay where they are, to be read from there."""
    partitions = None if places else spark.conf.get("catalog.partitions", None)
    return read_captures(
        spark, f"{folder}/pages.parquet", places=places,
        partitions=int(partitions) if partitions else None,
    )


def status_of(number: Sql) -> Sql:
    """HTTP status that a page of this number was answered with."""
    return (
        f"CASE {number} % 10 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 0 "
        "WHEN 4 THEN 503 ELSE 200 END"
    )


def at_second(second: Sql) -> Sql:
    """Capture time, counted from a fixed start."""
    return f"timestamp_seconds(1700000000 + {second})"


def page_attempts(source: DataFrame) -> DataFrame:
    """Fetch log of each page: a blocked answer is repeated, then even pages succeed.

    Columns page_id, page_url, attempt, status, html, fetched_at, and place if pages have one.
    """
    blocked = is_blocked("first")
    place = ["place"] if has_places(source) else []
    return (
        source.selectExpr(
            "page_id", "url AS page_url", "html", f"{status_of('page_id')} AS first", *place
        )
        .withColumn("repeats", F.expr(f"if({blocked}, CAST(page_id % 5 AS int), 0)"))
        .withColumn("last", F.expr(f"repeats + if({blocked} AND page_id % 2 = 0, 1, 0)"))
        .selectExpr("*", "explode(sequence(0, last)) AS attempt")
        .selectExpr(
            "page_id",
            "page_url",
            "attempt",
            "if(attempt > repeats, 200, first) AS status",
            "html",
            f"{at_second('page_id + attempt')} AS fetched_at",
            *place,
        )
    )


def page_renders(source: DataFrame) -> DataFrame:
    """Renderings of every fourth page: page_id, page_url, html, and place if pages have one."""
    place = ["place"] if has_places(source) else []
    return source.where("page_id % 4 = 0").selectExpr("page_id", "url AS page_url", "html", *place)


def judged_pages(source: DataFrame) -> DataFrame:
    """Each page judged on its first answer, with the rendering every fourth page has."""
    text = "if(escalated_to_js, if(page_id % 4 = 0, own_text, ''), own_text)"
    return (
        source.selectExpr(
            "page_id", "url", f"{status_of('page_id')} AS status", f"{extract_text('html')} AS own_text",
            f"xxhash64({status_of('page_id')}, html) AS content",
            "if(page_id % 4 = 0, xxhash64(html), NULL) AS render_content",
            *(["place"] if has_places(source) else []),
        )
        .withColumn("reason", F.expr(render_reason("status", "own_text")))
        .withColumn("escalated_to_js", F.expr("reason IS NOT NULL"))
        .withColumn("text", F.expr(gated_text(text, "escalated_to_js", CHALLENGE)))
    )


def host_pages(source: DataFrame) -> DataFrame:
    """Judged pages as pages of one company per host, the smallest page_id its homepage.

    Homepages are found on narrow rows and joined by page_id, so no host gathers its text.
    """
    host = f"{url_host('url')} AS company_key"
    homes = source.selectExpr(host, "page_id").groupBy("company_key").agg(
        F.min("page_id").alias("home_id")
    )
    marked = judged_pages(source).selectExpr("*", host).join(
        homes.select("home_id"), F.col("page_id") == F.col("home_id"), "left"
    )
    return marked.selectExpr(
        "company_key",
        "if(home_id IS NOT NULL, 0, page_id + 1) AS ord",
        "page_id",
        "url AS page_url",
        f"if(home_id IS NOT NULL, 'home', {url_slug('url')}) AS page_name",
        "status",
        "CAST(page_id % 3 AS int) AS retries_used",
        "text",
        "length(text) AS text_len",
        "reason",
        "escalated_to_js",
        f"{at_second('page_id')} AS first_fetched",
        f"{at_second('page_id + 5')} AS last_fetched",
        "if(escalated_to_js, render_content, content) AS content",
        *(["if(escalated_to_js AND page_id % 4 > 0, NULL, place) AS place"] if has_places(source) else []),
    )


def host_chunks(source: DataFrame) -> DataFrame:
    """All host pages, as companies of at most CHUNK pages: a host's pages by page_id."""
    key = f"concat(company_key, '/', page_id DIV {CHUNK})"
    return host_pages(source).withColumn("company_key", F.expr(key))


def host_companies(source: DataFrame) -> DataFrame:
    """One company per host: company_key, id, url, home."""
    hosts = source.selectExpr(f"{url_host('url')} AS company_key").distinct()
    home = "concat('https://', company_key)"
    return hosts.selectExpr("company_key", "company_key AS id", f"{home} AS url", f"{home} AS home")


def document_pages(documents: DataFrame) -> DataFrame:
    """Documents as pages of one company per source; a page under 200 characters is empty."""
    return documents.selectExpr(
        "source AS company_key",
        "doc_id AS ord",
        "concat('https://', source, '/', doc_id) AS page_url",
        f"{status_of('doc_id')} AS status",
        "CAST(doc_id % 5 AS int) AS retries_used",
        "if(n_chars >= 200, n_chars, 0) AS text_len",
        f"{is_blocked(status_of('doc_id'))} AS escalated_to_js",
        f"{at_second('doc_id')} AS first_fetched",
        f"{at_second('doc_id')} AS last_fetched",
    )


# --- Sites: each page is the homepage of a site of its own ------------------


def _sitemap(locs: Sql, root: str = "urlset", entry: str = "url") -> Sql:
    entries = each(locs, lambda u: f"concat('<{entry}><loc>', {u}, '</loc></{entry}>')")
    opening = quoted(f'<?xml version="1.0"?>\n<{root} xmlns="{SITEMAP_NAMESPACE}">')
    return rf"concat({opening}, array_join({entries}, '\n'), '</{root}>')"


def sites(source: DataFrame) -> DataFrame:
    """page_id, home, root, links: a page as the homepage of host `p<page_id>.<host>`.

    `links` are the page's anchors as addresses of the site, each once.
    """
    own = "concat(split_part(url, '://', 1), '://p', page_id, '.', split_part(url, '://', 2))"
    written = each(anchor_hrefs(visible_markup("html")), lambda h: f"trim(BOTH '\"' FROM {h})")
    hrefs = f"array_distinct({written})"
    return (
        source.selectExpr(
            "page_id", "html", f"regexp_replace({own}, '/?(#.*)?$', '') AS home", f"{hrefs} AS hrefs"
        )
        .withColumn("root", F.expr(site_root("home")))
        .selectExpr("page_id", "home", "root", "html", "transform(hrefs, h -> concat(root, h)) AS links")
    )


def site_documents(located: DataFrame) -> DataFrame:
    """Sitemap and robots captures, by page_id % 4.

    0: none. 1: a sitemap of all links, last first. 2: a robots file with a sitemap for the
    links at even places and one for the others. 3: a sitemap index of children of two links.
    Columns page_id, address, body.
    """

    def document(name: str, body: Sql) -> Sql:
        return f"named_struct('address', concat(root, '{name}'), 'body', {body})"

    child = (
        "named_struct('address', concat(root, '/map-', n, '.xml'), "
        f"'body', {_sitemap('slice(links, n * 2 + 1, 2)')})"
    )
    children = f"transform(sequence(0, CAST(ceil(size(links) / 2) AS int) - 1), n -> {child})"
    robots = (
        r"concat('User-agent: *\r\nSitemap: ', root, '/even.xml\r\nDisallow: /x\nSITEMAP:  ', "
        r"root, '/odd.xml  \n Sitemap: ', root, '/indented.xml')"
    )
    index = _sitemap("transform(children, c -> c.address)", "sitemapindex", "sitemap")
    even, odd = (_sitemap(f"filter(links, (u, i) -> i % 2 = {rest})") for rest in (0, 1))
    documents = (
        f"CASE page_id % 4 WHEN 1 THEN array({document('/sitemap.xml', _sitemap('reverse(links)'))}) "
        f"WHEN 2 THEN array({document('/robots.txt', robots)}, {document('/even.xml', even)}, "
        f"{document('/odd.xml', odd)}) "
        f"WHEN 3 THEN concat(array({document('/sitemap.xml', index)}), children) END"
    )
    return (
        located.where("size(links) > 0")
        .selectExpr("page_id", "root", "links", f"{children} AS children")
        .selectExpr("page_id", f"explode({documents}) AS d")
        .select("page_id", "d.address", "d.body")
    )


def site_subpages(located: DataFrame) -> DataFrame:
    """page_id, pos, page_url, html: the n-th link answers with the page's n-th paragraph.

    A subpage holds that one paragraph only; whole pages are read as homepages.
    """
    paragraphs = "regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)"
    return (
        located.selectExpr("page_id", "links", f"{paragraphs} AS paragraphs")
        .selectExpr("page_id", "paragraphs", "posexplode(links) AS (pos, page_url)")
        .where("pos < size(paragraphs)")
        .selectExpr(
            "page_id",
            "pos",
            "page_url",
            "concat('<html><body><p>', paragraphs[pos], '</p></body></html>') AS html",
        )
    )


def site_companies(located: DataFrame) -> DataFrame:
    """id, url; even pages leave the scheme out where it is the default one."""
    return located.selectExpr(
        "page_id AS id", "if(page_id % 2 = 0, regexp_replace(home, '^https://', ''), home) AS url"
    )


def site_attempts(located: DataFrame) -> DataFrame:
    """Fetch log of all sites: homepages, subpages, sitemaps and robots files."""
    homes = located.selectExpr("page_id", "home AS url", "html")
    subpages = (
        site_subpages(located)
        .selectExpr("page_url", "html", "pos", "page_id + pos AS n")
        .withColumn("first", F.expr(status_of("n")))
        .withColumn(
            "answers",
            F.expr(f"if({is_blocked('first')} AND pos % 2 = 0, array(first, 200), array(first))"),
        )
        .selectExpr("page_url", "html", "n", "posexplode(answers) AS (attempt, status)")
        .selectExpr(
            "page_url", "attempt", "status", "html", f"{at_second('n + attempt')} AS fetched_at"
        )
    )
    documents = site_documents(located).selectExpr(
        "address AS page_url", "0 AS attempt", "200 AS status", "body AS html",
        f"{at_second('page_id')} AS fetched_at",
    )
    return page_attempts(homes).drop("page_id").unionByName(subpages).unionByName(documents)


def site_renders(located: DataFrame) -> DataFrame:
    """Renderings of every fourth homepage and every third subpage."""
    homes = located.where("page_id % 4 = 0").selectExpr("home AS page_url", "html")
    subpages = site_subpages(located).where("(page_id + pos) % 3 = 0")
    return homes.unionByName(subpages.select("page_url", "html"))
