"""Finding the subpages of each company: sitemap, robots file, anchors, in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import expr

from sitetext.config import Options
from sitetext.functions.html import absolute_links, base_address
from sitetext.functions.links import (
    first_entries,
    is_site_page,
    link_entries,
    ranked_links,
    site_links,
)
from sitetext.functions.sql import Sql, head
from sitetext.functions.urls import (
    bare_host,
    base_parts,
    normalize_url,
    path_depth,
    robots_address,
    score_path,
    site_root,
    sitemap_address,
    url_path,
)
from sitetext.operators.joins import lookup
from sitetext.operators.ranking import cap_links
from sitetext.plans.staging import Staging


def site_documents(digests: DataFrame) -> DataFrame:
    """Usable sitemaps and robots files among the captured addresses: few rows, so stage them."""
    return digests.where("size(locs) > 0 OR size(robots) > 0").selectExpr(
        "page_url AS address", "locs", "is_index", "is_markup", "robots"
    )


def sitemap_link_rows(
    sites: DataFrame, documents: DataFrame, options: Options, rows: int
) -> DataFrame:
    """Raw links of each site (column root) from its sitemaps: root, pos, ord, link.

    Per site and not per company: companies on one site share the work. The site's own sitemap
    comes first, or its children if it is an index, and else the sitemaps that the robots file
    names; the first of these that gives any link is taken alone. `rows` is the number of sites.
    Very many sites may name one sitemap.
    """
    sitemaps = documents.where("size(locs) > 0")
    main = sitemaps.where("is_markup").selectExpr("address AS main_address", "locs", "is_index")
    robots = documents.where("size(robots) > 0").selectExpr("address AS robots_address", "robots")
    looked_up = sites.join(
        main, expr(f"{sitemap_address('root')} = main_address"), "left"
    ).join(robots, expr(f"{robots_address('root')} = robots_address"), "left")

    children = f"if(is_index, {head('locs', options.max_child_sitemaps)}, NULL)"
    sources = f"array(struct(0 AS source, {children} AS addresses), struct(1 AS source, robots AS addresses))"
    listed = (
        looked_up.where("locs IS NULL OR is_index")
        .selectExpr("root", f"explode({sources}) AS s")
        .selectExpr("root", "s.source", "posexplode(s.addresses) AS (pos, address)")
    )
    named = lookup(listed, sitemaps.select("address", "locs"), ["address"], "root", rows)
    plain = looked_up.where("locs IS NOT NULL AND NOT is_index")
    found = plain.selectExpr("root", "0 AS source", "0 AS pos", "locs").unionByName(
        named.where("locs IS NOT NULL").select("root", "source", "pos", "locs")
    )
    first = found.groupBy("root").agg(F.min("source").alias("source"))
    links = found.join(first, ["root", "source"]).selectExpr(
        "root", "pos", "posexplode(locs) AS (ord, link)"
    )
    if options.max_raw_links is None:
        return links
    return cap_links(links, "root", ["pos", "ord"], options.max_raw_links)


def site_candidates(links: DataFrame, options: Options) -> DataFrame:
    """The links of each site that a company may take: root and site_links, best first.

    A company takes the best `max_subpages - 1` links whose normal form is not its homepage. So
    more links than that of one normal form are never taken, and of the others only the best
    twice as many: at most so many of them are the homepage of one company. Both limits cut in
    the tasks before the shuffle, and a site's row stays small however many links it has. A site
    all of whose links are foreign has an empty list.
    """
    wanted = options.max_subpages - 1
    path = url_path("link")
    scored = (
        links.groupBy("root", "link")
        .agg(expr("min(struct(pos, ord)) AS place"))
        .withColumn("valid", expr(is_site_page("link", bare_host("root"))))
        .withColumn(
            "key",
            expr(
                f"struct(NOT valid AS foreign, -{score_path(path, options.high_value_keywords, options.low_value_keywords)} "
                f"AS score, {path_depth(path)} AS depth, place, link)"
            ),
        )
        .selectExpr("root", "link", "valid", "key", f"if(valid, {normalize_url('link')}, '') AS normal")
    )
    of_normal = Window.partitionBy("root", "normal").orderBy("key")
    of_root = Window.partitionBy("root").orderBy("key")
    entry = "struct(key, named_struct('url', link, 'normal', nullif(normal, link)) AS entry)"
    return (
        scored.withColumn("_n", F.row_number().over(of_normal))
        .where(f"_n <= {max(wanted, 1)}")
        .withColumn("_n", F.row_number().over(of_root))
        .where(f"_n <= {max(2 * wanted, 1)}")
        .groupBy("root")
        .agg(expr(f"array_sort(collect_list(if(valid, {entry}, NULL))) AS best"))
        .selectExpr("root", "transform(best, b -> b.entry) AS site_links")
    )


def _ranked_entries(links: Sql, host: Sql, options: Options) -> Sql:
    """Pages of the site among raw links, best first, with their normal forms."""
    ranked = ranked_links(
        site_links(links, host), options.high_value_keywords, options.low_value_keywords
    )
    return link_entries(ranked)


def homepage_links(homes: DataFrame, digests: DataFrame, options: Options) -> DataFrame:
    """Ranked links in the anchors of homepages (column home): links, unused_links, escalated.

    Once per address, however many companies have it as their homepage. The work is in the links
    and not in the bytes, so the rows are dealt over all shuffle partitions. Links of a rendering
    are looked at only where the homepage itself has none.
    """
    records = digests.selectExpr("page_url AS home", "anchors", "unused_anchors", "escalated")
    parts = int(homes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchors = homes.distinct().join(records, "home").repartition(parts, "home")
    host = bare_host("home")

    def entries(used: str, limit: int | None) -> Sql:
        return _ranked_entries(head(absolute_links(f"{used}.hrefs", f"{used}_parts"), limit), host, options)

    def with_base(frame: DataFrame, used: str) -> DataFrame:
        return frame.withColumn(f"{used}_base", expr(base_address(f"{used}.base", "home"))).withColumn(
            f"{used}_parts", expr(base_parts(f"{used}_base"))
        )

    own = with_base(anchors, "anchors").withColumn(
        "links", expr(entries("anchors", options.max_raw_links))
    )
    # Links of a homepage that is rendered only for them are not capped.
    needed = "coalesce(size(links), 0) = 0 AND unused_anchors IS NOT NULL"
    return (
        with_base(own, "unused_anchors")
        .withColumn("unused_links", expr(f"if({needed}, {entries('unused_anchors', None)}, NULL)"))
        .select("home", "escalated", "links", "unused_links")
    )


def discover(
    companies: DataFrame,
    digests: DataFrame,
    documents: DataFrame,
    options: Options,
    rows: int,
    staging: Staging,
) -> DataFrame:
    """Ranked candidates of each company (columns company_key, home), homepage not yet excluded.

    Filtering, ranking and normal forms are worked out once per site or homepage; a company's
    own row costs a comparison per link.

    `documents` are the `site_documents` of the digests, `rows` the number of companies. Adds
    candidates, and no_links: the homepage had to be rendered to get them. A source counts as
    empty before filtering, so a sitemap of foreign links still hides the anchors.
    """
    rendering = "true" if options.js_fallback else "false"
    located = companies.withColumn("root", expr(site_root("home")))
    links = sitemap_link_rows(located.select("root").distinct(), documents, options, rows)
    sites = site_candidates(links, options)
    on_sites = staging.stage(lookup(located, sites, ["root"], "company_key", rows), "on_sites")
    open_homes = on_sites.where("site_links IS NULL OR size(site_links) = 0").select("home")
    empty = "size(coalesce(site_links, links, array())) = 0"
    homepages = homepage_links(open_homes, digests, options)
    return (
        lookup(on_sites, homepages, ["home"], "company_key", rows, counted=located)
        .withColumn(
            "no_links", expr(f"{rendering} AND {empty} AND NOT coalesce(escalated, {rendering})")
        )
        .selectExpr(
            "company_key",
            "home",
            "no_links",
            "coalesce(if(no_links, unused_links, coalesce(site_links, links)), array()) AS candidates",
        )
    )


def select_pages(discovered: DataFrame, options: Options) -> DataFrame:
    """Pages of each company in order: the homepage, ord 0, then its best subpages."""
    best = first_entries("candidates", "home", options.max_subpages - 1)
    return discovered.selectExpr(
        "company_key", "no_links", f"posexplode(concat(array(home), {best})) AS (ord, page_url)"
    )
