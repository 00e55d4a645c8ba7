"""ANSI SQL for the registered queries, in DuckDB's dialect, written apart from the library.

The library's patterns are not used here: text, links and outcomes are computed by rules of
their own that hold for the given tables.
"""

from __future__ import annotations

CHALLENGE = ("gegen", "leur")

# --- Pieces -------------------------------------------------------------------


def _text(html: str) -> str:
    """Prose of a page: hidden and boilerplate elements out, blocks to lines, tags out."""
    x = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style"):
        x = f"regexp_replace({x}, '(?is)<{tag}[^>]*>.*?</{tag}>', '', 'g')"
    for tag in ("title", "nav", "footer"):
        x = f"regexp_replace({x}, '(?is)<{tag}[^>]*>.*?</{tag}>', chr(10), 'g')"
    x = f"coalesce(nullif(regexp_extract({x}, '(?is)<article[^>]*>(.*)</article>', 1), ''), {x})"
    x = f"replace({x}, chr(10), ' ')"
    x = f"regexp_replace({x}, '(?i)</?(p|br|h1|div|li|ul|body|html|head|article)( [^>]*)?/?>', chr(10), 'g')"
    x = f"regexp_replace({x}, '<[a-zA-Z!/][^<>]*>', '', 'g')"
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    x = f"regexp_replace({x}, '[ \\t\\r\\f]+', ' ', 'g')"
    x = f"regexp_replace({x}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({x}, ' ' || chr(10))"


def _host(url: str) -> str:
    return f"split_part(split_part(split_part(split_part({url}, '://', 2), '/', 1), '?', 1), '#', 1)"


def _bare(url: str) -> str:
    return f"regexp_replace({_host(url)}, '^www[.]', '')"


def _root(url: str) -> str:
    return f"(split_part({url}, '://', 1) || '://' || {_host(url)})"


def _path(url: str) -> str:
    return f"regexp_replace(regexp_replace({url}, '^[a-z]+://[^/?#]*', ''), '[?#].*$', '')"


def _normal(url: str) -> str:
    """Normal form of a page address of the tables: all have a scheme and a path."""
    no_fragment = f"split_part({url}, '#', 1)"
    query = f"regexp_extract({no_fragment}, '[?].*$', 0)"
    return f"(rtrim(split_part({no_fragment}, '?', 1), '/') || {query})"


def _slug(url: str) -> str:
    return f"coalesce(nullif(list_extract(string_split(rtrim({_path(url)}, '/'), '/'), -1), ''), 'home')"


def _score(path: str) -> str:
    p = f"lower({path})"
    return (
        f"(CASE WHEN contains({p}, 'the') OR contains({p}, 'en') THEN 2 "
        f"WHEN contains({p}, 'de') OR contains({p}, 'html') THEN -1 ELSE 0 END)"
    )


def _depth(path: str) -> str:
    return f"(length({path}) - length(replace({path}, '/', '')))::INTEGER"


def _status(number: str) -> str:
    return (
        f"(CASE {number} % 10 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 429 "
        f"WHEN 3 THEN 0 WHEN 4 THEN 503 ELSE 200 END)"
    )


def _blocked(status: str) -> str:
    return f"({status} IN (0, 403, 429, 503))"


def _challenged(text: str) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{w}')" for w in CHALLENGE) + ")"


def _gate(text: str) -> str:
    return f"CASE WHEN length({text}) < 200 OR {_challenged(text)} THEN '' ELSE {text} END"


# Anchors of all pages: page_id, url, pos, href.
_HREFS = """hrefs AS (
  SELECT page_id, url, unnest(range(len(l)))::INTEGER AS pos, unnest(l) AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)
)"""
_ANCHORS = f"""{_HREFS},
anchors AS (SELECT page_id, url, pos, {_root('url')} || href AS link FROM hrefs)"""
# Links of each page as a homepage, itself left out: page_id, link, pos.
_CANDIDATES = f"""{_ANCHORS},
candidates AS (
  SELECT page_id, link, min(pos) AS pos FROM anchors
  WHERE {_normal('link')} <> {_normal('url')} GROUP BY page_id, link
)"""
_JUDGED = f"""own AS (
  SELECT page_id, url, {_status('page_id')} AS status, {_text('html')} AS own_text FROM pages
),
reasoned AS (
  SELECT *, CASE WHEN {_blocked('status')} THEN 'blocked' WHEN length(own_text) < 200 THEN 'thin_text' END AS reason
  FROM own
),
judged AS (
  SELECT *, reason IS NOT NULL AS escalated_to_js,
    CASE WHEN reason IS NULL THEN own_text WHEN page_id % 4 <> 0 THEN '' ELSE {_gate('own_text')} END AS text
  FROM reasoned
)"""
_HOST_PAGES = f"""{_JUDGED},
homes AS (SELECT {_host('url')} AS company_key, min(page_id) AS home_id FROM pages GROUP BY 1),
host_pages AS (
  SELECT company_key, CASE WHEN page_id = home_id THEN 0 ELSE page_id + 1 END AS ord, page_id,
    url AS page_url, CASE WHEN page_id = home_id THEN 'home' ELSE {_slug('url')} END AS page_name,
    status, page_id % 3 AS retries_used, text, length(text)::INTEGER AS text_len, reason, escalated_to_js
  FROM judged JOIN homes ON {_host('url')} = company_key
),
errors AS (
  SELECT *, CASE WHEN text <> '' THEN NULL
      WHEN ord = 0 THEN 'Homepage blocked or empty: HTTP ' || status
      ELSE 'No content from ' || page_url END AS message
  FROM host_pages
),
tallied AS (
  SELECT company_key, count(*)::INTEGER AS num_pages_tried,
    (count(*) FILTER (WHERE text <> ''))::INTEGER AS num_pages_ok,
    bool_or(escalated_to_js) AS escalated_to_js, sum(retries_used)::INTEGER AS retries_used,
    CASE WHEN count(*) FILTER (WHERE text <> '') = 0 THEN 'failed'
      WHEN count(*) FILTER (WHERE text <> '') < count(*) THEN 'partial' ELSE 'ok' END AS status,
    (max(page_id) + 5 - min(page_id))::DOUBLE AS total_time_s,
    arg_min(message, ord) FILTER (WHERE message IS NOT NULL) AS error
  FROM errors GROUP BY company_key
)"""
_HOST_CHUNKS = f"""{_HOST_PAGES},
picked AS (SELECT * REPLACE (company_key || '/' || page_id // 40 AS company_key) FROM host_pages)"""
_ATTEMPTS = f"""firsts AS (
  SELECT page_id, url, html, {_status('page_id')} AS first,
    CASE WHEN {_blocked(_status('page_id'))} THEN page_id % 5 ELSE 0 END AS repeats
  FROM pages
),
attempts AS (
  SELECT page_id, url, html, attempt, CASE WHEN attempt > repeats THEN 200 ELSE first END AS status
  FROM (
    SELECT *, unnest(range(repeats + 1 + CASE WHEN {_blocked('first')} AND page_id % 2 = 0 THEN 1 ELSE 0 END))::INTEGER
      AS attempt
    FROM firsts
  )
)"""


def _folded(budget: int, rows: str = "attempts") -> str:
    """Terminal attempt of each page: page_id, url, html, attempt, status."""
    return f"""SELECT * FROM {rows} WHERE attempt < {budget}
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY
      CASE WHEN {_blocked('status')} THEN 1000 - attempt ELSE attempt END) = 1"""


_MODES = (("none", 1), ("minimal", 2), ("full", 5))

# Sites made of the pages: page p is the homepage of host p<page_id>.<host>.
_SITES = f"""site AS (
  SELECT page_id, html, scheme || '://' || host AS root,
    rtrim(scheme || '://' || host || rest, '/') AS home,
    regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs,
    regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS paragraphs
  FROM (
    SELECT page_id, html, split_part(url, '://', 1) AS scheme,
      'p' || page_id || '.' || {_host('url')} AS host,
      substr(split_part(split_part(url, '://', 2), '#', 1), length({_host('url')}) + 1) AS rest
    FROM pages
  )
),
linked AS (
  SELECT page_id, root, home, paragraphs, html, href,
    row_number() OVER (PARTITION BY page_id ORDER BY first_pos) - 1 AS pos
  FROM (
    SELECT any_value(s.root) AS root, any_value(s.home) AS home, any_value(s.paragraphs) AS paragraphs,
      any_value(s.html) AS html, s.page_id, s.href, min(s.n) AS first_pos
    FROM (SELECT *, unnest(range(len(hrefs))) AS n, unnest(hrefs) AS href FROM site) s
    GROUP BY s.page_id, s.href
  )
),
links AS (
  SELECT page_id, pos, root || href AS link, root, home,
    CASE WHEN pos < len(paragraphs) THEN '<html><body><p>' || paragraphs[pos + 1] || '</p></body></html>' END AS html
  FROM linked
)"""
# Place of each link in its site's discovery order; null if discovery does not reach it.
_PLACE = """CASE page_id % 4
    WHEN 1 THEN -pos
    WHEN 2 THEN (pos % 2) * 1000000 + pos
    ELSE pos END"""

# The run over these sites, up to one row per page: see the steps below.
_RUN = f"""{_SITES},
home_log AS (
  SELECT page_id, attempt, status FROM (
    SELECT *, unnest(range(repeats + 1 + CASE WHEN {_blocked('first')} AND page_id % 2 = 0 THEN 1 ELSE 0 END)) AS attempt,
      CASE WHEN attempt > repeats THEN 200 ELSE first END AS status
    FROM (SELECT page_id, {_status('page_id')} AS first,
        CASE WHEN {_blocked(_status('page_id'))} THEN page_id % 5 ELSE 0 END AS repeats FROM pages)
  )
  WHERE attempt < 5
),
home_outcome AS (
  SELECT page_id,
    arg_min(status, CASE WHEN {_blocked('status')} THEN 1000 - attempt ELSE attempt END) AS status,
    arg_min(attempt, CASE WHEN {_blocked('status')} THEN 1000 - attempt ELSE attempt END) AS retries_used,
    page_id + max(attempt) AS last_second
  FROM home_log GROUP BY page_id
),
home_page AS (
  SELECT site.page_id, 0 AS ord, site.home AS url, 'home' AS page_name, o.status, o.retries_used,
    site.html, {_text('site.html')} AS own_text, page_id % 4 = 0 AS rendered, page_id AS first_second, o.last_second
  FROM site JOIN home_outcome o USING (page_id)
),
sub_page AS (
  SELECT page_id, pos, link, html, n,
    CASE WHEN html IS NULL THEN 0 WHEN {_blocked('answer')} AND pos % 2 = 0 THEN 200 ELSE answer END AS status,
    CASE WHEN html IS NOT NULL AND {_blocked('answer')} AND pos % 2 = 0 THEN 1 ELSE 0 END AS retries_used
  FROM (SELECT *, page_id + pos AS n, {_status('(page_id + pos)')} AS answer FROM links)
),
home_escalated AS (
  SELECT page_id, {_blocked('status')} OR length(own_text) < 200 AS escalated FROM home_page
),
reached AS (
  SELECT l.*, {_PLACE.replace('page_id', 'l.page_id').replace('pos', 'l.pos')} AS place
  -- Homepages that depend on their anchors have a rendering in case they need one.
  FROM links l
),
ranked AS (
  SELECT page_id, link, pos, row_number() OVER (
      PARTITION BY page_id ORDER BY {_score(_path('link'))} DESC, {_depth(_path('link'))}, place) AS ord
  FROM reached WHERE place IS NOT NULL AND {_normal('link')} <> home
  QUALIFY ord <= 3
),
all_pages AS (
  SELECT page_id, ord, url, page_name, status, retries_used, html, own_text, rendered, first_second, last_second
  FROM home_page
  UNION ALL
  SELECT s.page_id, r.ord, s.link, {_slug('s.link')}, s.status, s.retries_used, s.html,
    CASE WHEN s.html IS NULL THEN '' ELSE {_text('s.html')} END,
    s.html IS NOT NULL AND s.n % 3 = 0,
    CASE WHEN s.html IS NOT NULL THEN s.n END, CASE WHEN s.html IS NOT NULL THEN s.n + s.extra END
  FROM ranked r
  JOIN (SELECT *, CASE WHEN {_blocked(_status('n'))} AND pos % 2 = 0 THEN 1 ELSE 0 END AS extra FROM sub_page) s
    ON s.page_id = r.page_id AND s.pos = r.pos
),
run_reasons AS (
  SELECT *, CASE WHEN {_blocked('status')} THEN 'blocked' WHEN length(own_text) < 200 THEN 'thin_text'
      WHEN ord = 0 AND page_id NOT IN (SELECT page_id FROM reached WHERE place IS NOT NULL) THEN 'no_links' END AS reason
  FROM all_pages
),
run_pages AS (
  SELECT *, reason IS NOT NULL AS escalated_to_js,
    CASE WHEN reason IS NULL OR reason = 'no_links' THEN own_text
      WHEN NOT rendered THEN '' ELSE {_gate('own_text')} END AS text
  FROM run_reasons
)"""

ORACLES = {
    "normalize_urls": f"""
SELECT page_id,
  CASE page_id % 4 WHEN 1 THEN split_part(url, '://', 2)
    WHEN 2 THEN upper(split_part(url, '://', 1)) || '://' || split_part(url, '://', 2)
    WHEN 3 THEN split_part(url, '#', 1) || '#a/b?c' ELSE url END AS given,
  CASE page_id % 4 WHEN 1 THEN 'https://' || split_part({_normal('url')}, '://', 2)
    ELSE {_normal('url')} END AS normalized
FROM pages""",
    "url_slugs": f"SELECT page_id, {_slug('url')} AS slug, 'home' AS root_slug FROM pages",
    "url_parts": f"""
SELECT page_id, split_part(url, '://', 1) AS scheme, {_host('url')} AS host, {_bare('url')} AS bare_host,
  {_path('url')} AS path, split_part(split_part(split_part(url, '#', 1), '?', 2), '#', 1) AS query,
  split_part(url, '#', 2) AS fragment
FROM pages""",
    "site_addresses": f"""
SELECT {_root('url')} AS root, {_root('url')} || '/sitemap.xml' AS sitemap,
  {_root('url')} || '/robots.txt' AS robots, count(*) AS n_pages
FROM pages GROUP BY 1, 2, 3""",
    "anchor_links": f"WITH {_ANCHORS} SELECT page_id, pos, link FROM anchors",
    "anchor_links_quoted": f"WITH {_ANCHORS} SELECT page_id, pos, link FROM anchors",
    "quoted_text": f"SELECT page_id, {_text('html')} AS text FROM pages",
    "resolved_links": f"""
WITH {_HREFS}, based AS (
  SELECT page_id, pos, href, substr(href, 2) AS word, {_root('url')} AS root, {_normal('url')} AS base FROM hrefs
), folders AS (
  SELECT *, regexp_replace({_path('base')}, '[^/]*$', '') AS folder,
    regexp_replace(regexp_replace({_path('base')}, '[^/]*$', ''), '[^/]+/$', '') AS above
  FROM based
)
SELECT page_id, pos,
  CASE pos % 7 WHEN 0 THEN href WHEN 1 THEN word WHEN 2 THEN './a/../' || word WHEN 3 THEN '../../' || word || '/.'
    WHEN 4 THEN '?q=' || word WHEN 5 THEN '//other.example/' || word ELSE '#' || word END AS ref,
  CASE pos % 7 WHEN 0 THEN root || href WHEN 1 THEN root || folder || word WHEN 2 THEN root || folder || word
    WHEN 3 THEN root || regexp_replace(above, '[^/]+/$', '') || word || '/'
    WHEN 4 THEN split_part(base, '?', 1) || '?q=' || word
    WHEN 5 THEN split_part(root, '://', 1) || '://other.example/' || word
    ELSE base || '#' || word END AS link
FROM folders""",
    "filtered_links": f"""
WITH {_HREFS}, made AS (
  SELECT page_id, pos, CASE pos % 6 WHEN 1 THEN 'http://www.' || {_bare('url')} || href
      WHEN 5 THEN {_root('url')} || '/copy' ELSE {_root('url')} || href END AS link
  FROM hrefs WHERE pos % 6 IN (0, 1, 5)
)
SELECT page_id, link, min(pos) AS pos FROM made GROUP BY page_id, link""",
    "scored_links": f"""
WITH {_ANCHORS}
SELECT page_id, pos, CASE WHEN pos % 5 = 3 THEN link || '.PDF' ELSE link END AS link,
  {_score(_path('link'))} AS score, {_depth(_path('link'))} AS depth, pos % 5 = 3 AS is_file
FROM anchors""",
    "candidate_links": f"""
WITH {_CANDIDATES}
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INTEGER AS pos, link FROM candidates""",
    "ranked_links": f"""
WITH {_CANDIDATES}
SELECT page_id, (row_number() OVER w - 1)::INTEGER AS pos, link FROM candidates
WINDOW w AS (PARTITION BY page_id ORDER BY {_score(_path('link'))} DESC, {_depth(_path('link'))}, pos)
QUALIFY row_number() OVER w <= 3""",
    "host_top_pages": f"""
SELECT {_host('url')} AS host, (row_number() OVER w)::INTEGER AS rank, page_id, url,
  {_score(_path('url'))} AS score, {_depth(_path('url'))} AS depth
FROM pages
WINDOW w AS (PARTITION BY {_host('url')} ORDER BY {_score(_path('url'))} DESC, {_depth(_path('url'))}, page_id)
QUALIFY row_number() OVER w <= 7""",
    "sitemap_roundtrip": f"""
WITH {_SITES}, listed AS (
  SELECT page_id, root || CASE page_id % 4 WHEN 1 THEN '/sitemap.xml'
      WHEN 2 THEN CASE WHEN pos % 2 = 0 THEN '/even.xml' ELSE '/odd.xml' END
      ELSE '/map-' || (pos // 2) || '.xml' END AS address, false AS is_index,
    row_number() OVER (PARTITION BY page_id, CASE page_id % 4 WHEN 1 THEN 0 WHEN 2 THEN pos % 2 ELSE pos // 2 END
      ORDER BY CASE WHEN page_id % 4 = 1 THEN -pos ELSE pos END) - 1 AS pos, link
  FROM links WHERE page_id % 4 <> 0
  UNION ALL
  SELECT DISTINCT page_id, root || '/sitemap.xml', true, pos // 2, root || '/map-' || (pos // 2) || '.xml'
  FROM links WHERE page_id % 4 = 3
  UNION ALL
  SELECT page_id, root || '/robots.txt', false, 0, root || '/even.xml' FROM links WHERE page_id % 4 = 2 AND pos = 0
  UNION ALL
  SELECT page_id, root || '/robots.txt', false, 1, root || '/odd.xml' FROM links WHERE page_id % 4 = 2 AND pos = 0
)
SELECT page_id, address, is_index, pos::INTEGER AS pos, link FROM listed""",
    "sitemap_index_first3": f"""
WITH {_SITES}
SELECT page_id, (pos // 2)::INTEGER AS child_pos, (pos % 2)::INTEGER AS pos, link
FROM links WHERE page_id % 4 = 3 AND pos < 6""",
    "sitemap_variants": """
SELECT page_id, n::INTEGER AS pos, 'https://' || page_id || '.example/' || n || '?a=1&b=2' AS link
FROM (SELECT page_id, unnest(range(page_id % 7 + 1)) AS n FROM pages)""",
    "robots_sitemaps": f"""
WITH {_SITES}
SELECT page_id, (pos % 2)::INTEGER AS line, (pos // 2)::INTEGER AS pos, link FROM links WHERE page_id % 4 = 2""",
    # Here no page is rendered, so a blocked or thin homepage has no anchors.
    "discovery_precedence": f"""
WITH {_RUN}, found AS (
  SELECT l.page_id, link, {_PLACE} AS place
  FROM links l JOIN home_escalated h ON h.page_id = l.page_id AND (l.page_id % 4 <> 0 OR NOT h.escalated)
)
SELECT page_id, false AS no_links,
  (row_number() OVER (PARTITION BY page_id ORDER BY {_score(_path('link'))} DESC, {_depth(_path('link'))}, place) - 1)::INTEGER AS pos, link
FROM found WHERE place IS NOT NULL""".replace("CASE page_id % 4", "CASE l.page_id % 4"),
    "discovery_cap": f"""
WITH {_ANCHORS}
SELECT 'site' || page_id % 4 || '.example' AS host, page_id, pos, link FROM anchors
QUALIFY row_number() OVER (PARTITION BY page_id % 4 ORDER BY page_id, pos) <= 200""",
    "fold_attempts": f"WITH {_ATTEMPTS}, "
    + ", ".join(f"by_{mode} AS ({_folded(budget)})" for mode, budget in _MODES)
    + " UNION ALL ".join(
        f" SELECT page_id, url AS page_url, status, length(html)::INTEGER AS size, attempt AS retries_used, "
        f"'{mode}' AS mode FROM by_{mode}"
        for mode, _ in _MODES
    ),
    "next_attempts": f"WITH {_ATTEMPTS}, seen AS (SELECT * FROM attempts WHERE attempt < 2), "
    + ", ".join(f"by_{mode} AS ({_folded(budget, 'seen')})" for mode, budget in _MODES)
    + " UNION ALL ".join(
        f" SELECT page_id, status, attempt + 1 AS attempt, ([{delays}])[attempt + 2]::DOUBLE AS delay_s, "
        f"'{mode}' AS mode FROM by_{mode} WHERE {_blocked('status')} AND attempt + 1 < {budget}"
        for (mode, budget), delays in zip(_MODES, ("0", "0, 0", "0, 1, 2, 4, 8"))
    ),
    "extract_text": f"SELECT page_id, {_text('html')} AS text FROM pages",
    "page_quality": f"""
WITH {_JUDGED}
SELECT status, {_blocked('status')} AS blocked, coalesce(reason, 'none') AS reason, count(*) AS n_pages,
  count(*) FILTER (WHERE text <> '') AS n_ok, sum(length(text))::BIGINT AS n_chars
FROM judged GROUP BY 1, 2, 3""",
    "render_queue": f"""
WITH {_JUDGED}
SELECT url AS page_url, reason FROM judged WHERE reason IS NOT NULL AND page_id % 4 <> 0""",
    "rendered_pages": f"WITH {_JUDGED} SELECT page_id, status, escalated_to_js, text FROM judged",
    "page_digests": f"""
WITH {_ATTEMPTS}, outcome AS ({_folded(5)}), texts AS (
  SELECT page_id, url, status, attempt, {_text('html')} AS own_text,
    len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_anchors
  FROM outcome
), reasons AS (
  SELECT *, CASE WHEN {_blocked('status')} THEN 'blocked' WHEN length(own_text) < 200 THEN 'thin_text' END AS reason
  FROM texts
)
SELECT url AS page_url, status, attempt AS retries_used, reason IS NOT NULL AS escalated,
  coalesce(reason, 'none') AS reason,
  length(CASE WHEN reason IS NULL THEN own_text WHEN page_id % 4 <> 0 THEN '' ELSE {_gate('own_text')} END)::INTEGER AS text_len,
  (CASE WHEN reason IS NOT NULL AND page_id % 4 <> 0 THEN 0 ELSE n_anchors END)::INTEGER AS n_links
FROM reasons""",
    "captured_pages": f"""
SELECT url AS page_url, 200 AS status, 0 AS retries_used, false AS escalated, {_text('html')} AS text FROM pages""",
    "company_rollup": f"WITH {_HOST_PAGES} SELECT * EXCLUDE (error) FROM tallied",
    "first_error": f"WITH {_HOST_PAGES} SELECT company_key, error FROM tallied WHERE error IS NOT NULL",
    "company_log": f"""
WITH {_HOST_PAGES}
SELECT company_key AS id, 'https://' || company_key AS url, status, num_pages_tried AS subpages_tried,
  num_pages_ok AS subpages_ok, escalated_to_js, retries_used, total_time_s, error FROM tallied""",
    "combined_text": f"""
WITH {_HOST_CHUNKS}
SELECT company_key, (count(*) FILTER (WHERE text <> ''))::INTEGER AS num_pages_ok,
  coalesce(string_agg('[Page name: ' || page_name || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY ord)
    FILTER (WHERE text <> ''), '') AS combined_text
FROM picked GROUP BY company_key""",
    "pages_array": f"""
WITH {_HOST_CHUNKS}
SELECT company_key, (row_number() OVER (PARTITION BY company_key ORDER BY ord) - 1)::INTEGER AS pos,
  page_url AS url, page_name, status, text_len, escalated_to_js FROM picked""",
    "document_rollup": f"""
WITH d AS (
  SELECT *, n_chars >= 200 AS ok, {_status('doc_id')} AS http,
    CASE WHEN n_chars >= 200 THEN NULL WHEN doc_id = 0 THEN 'Homepage blocked or empty: HTTP ' || {_status('doc_id')}
      ELSE 'No content from https://' || source || '/' || doc_id END AS message
  FROM documents
)
SELECT source AS company_key, count(*)::INTEGER AS num_pages_tried, (count(*) FILTER (WHERE ok))::INTEGER AS num_pages_ok,
  bool_or({_blocked('http')}) AS escalated_to_js, sum(doc_id % 5)::INTEGER AS retries_used,
  CASE WHEN count(*) FILTER (WHERE ok) = 0 THEN 'failed' WHEN count(*) FILTER (WHERE ok) < count(*) THEN 'partial'
    ELSE 'ok' END AS status,
  arg_min(message, doc_id) FILTER (WHERE message IS NOT NULL) AS error,
  (max(doc_id) - min(doc_id))::DOUBLE AS total_time_s
FROM d GROUP BY source""",
    "raw_pages": f"""
WITH {_JUDGED}, kept AS (
  SELECT {_host('url')} AS id, url, escalated_to_js,
    CASE WHEN escalated_to_js AND page_id % 4 <> 0 THEN '' ELSE html END AS html
  FROM judged JOIN (SELECT page_id, html FROM pages) USING (page_id)
)
SELECT id, 'https://' || id AS url, url AS page_url, md5(html) AS html_md5, length(html)::INTEGER AS html_len,
  escalated_to_js FROM kept""",
    "pending_companies": f"""
SELECT id, 'https://' || id AS url
FROM (SELECT {_host('url')} AS id, min(page_id) AS first FROM pages GROUP BY 1) WHERE first % 2 = 1""",
    "shard_union": f"SELECT page_id::VARCHAR AS id, url, {_normal('url')} AS home FROM pages",
    "write_read_results": f"""
WITH {_HOST_PAGES}
SELECT company_key AS id, 'https://' || company_key AS url, status, num_pages_tried AS subpages_tried,
  num_pages_ok AS subpages_ok, retries_used FROM tallied""",
    "company_results": f"""
WITH {_RUN}, run_errors AS (
  SELECT *, CASE WHEN text <> '' THEN NULL WHEN ord = 0 THEN 'Homepage blocked or empty: HTTP ' || status
      ELSE 'No content from ' || url END AS message
  FROM run_pages
)
SELECT page_id::VARCHAR AS id, arg_min(url, ord) AS url,
  coalesce(string_agg('[Page name: ' || page_name || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY ord)
    FILTER (WHERE text <> ''), '') AS combined_text,
  count(*)::INTEGER AS num_pages_tried, (count(*) FILTER (WHERE text <> ''))::INTEGER AS num_pages_ok,
  string_agg(url || '|' || page_name || '|' || status || '|' || length(text) || '|' || escalated_to_js, chr(10) ORDER BY ord) AS pages,
  bool_or(escalated_to_js) AS escalated_to_js, sum(retries_used)::INTEGER AS retries_used,
  CASE WHEN count(*) FILTER (WHERE text <> '') = 0 THEN 'failed'
    WHEN count(*) FILTER (WHERE text <> '') < count(*) THEN 'partial' ELSE 'ok' END AS status,
  arg_min(message, ord) FILTER (WHERE message IS NOT NULL) AS error,
  (max(last_second) - min(first_second))::DOUBLE AS total_time_s
FROM run_errors GROUP BY page_id""",
    "company_render_queue": f"""
WITH {_RUN}
SELECT url AS page_url, reason FROM run_pages WHERE reason IS NOT NULL AND NOT rendered""",
    "link_less_homepages": f"""
SELECT 'https://h' || page_id || '.example' AS page_url,
  CASE WHEN length({_text('html')}) < 200 THEN 'thin_text' ELSE 'no_links' END AS reason
FROM pages WHERE length({_text('html')}) < 200 OR page_id % 2 = 0 OR NOT contains(html, '<a href')""",
    "hot_site_pages": f"""
SELECT k.page_id, k.key, length({_text('p.html')})::INTEGER AS text_len
FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 1 ELSE page_id END AS key FROM pages) k
LEFT JOIN pages p ON p.page_id = k.key""",
    "company_raw_pages": f"""
WITH {_RUN}
SELECT r.page_id::VARCHAR AS id, h.url, r.url AS page_url,
  md5(CASE WHEN r.escalated_to_js AND NOT r.rendered THEN '' ELSE coalesce(r.html, '') END) AS html_md5,
  (1700000000 + r.last_second)::BIGINT AS second, r.escalated_to_js
FROM run_pages r JOIN home_page h ON h.page_id = r.page_id""",
}
ORACLES["page_digests_unplaced"] = ORACLES["page_digests"]
ORACLES["raw_pages_unplaced"] = ORACLES["raw_pages"]
ORACLES["host_boilerplate"] = f"""
WITH t AS (
  SELECT page_id, {_bare('url')} AS host, {_text("replace(html, '</article>', '<p>Notice of ' || " + _bare('url')
    + " || '</p><p>Part ' || page_id % 7 || '</p></article>')")} AS text
  FROM pages
), l AS (
  SELECT page_id, host, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM t
), r AS (
  SELECT host, line, true AS repeated FROM l WHERE line <> '' GROUP BY host, line HAVING count(DISTINCT page_id) >= 3
)
SELECT page_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE repeated IS NULL), '') AS text,
  count(repeated)::INTEGER AS n_dropped
FROM l LEFT JOIN r USING (host, line) GROUP BY page_id"""
_WITH_TAIL = (
    "replace(html, '</article>', '<ul><li><a href=/1>Link ' || page_id || '</a></li><li><a href=/2>All of the others"
    "</a>, next</li></ul><a href=/3><div>First half of a card</div><div>and its second half of ' || "
    "repeat('card ', 20) || '</div></a><div>by the <b>card</b></div><p>' || repeat('a long end ', "
    "(page_id % 12)::INTEGER) || '<a href=/4>with a link</a></p><p>The <a href=/5> end</a> .</p></article>')"
)
_WITH_MARKS = f"replace(regexp_replace({_WITH_TAIL}, '<a [^>]*>', '⟦', 'g'), '</a>', '⟧')"
ORACLES["dense_text"] = f"""
WITH t AS (SELECT page_id, {_text(_WITH_MARKS)} AS text FROM pages), l AS (
  SELECT page_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM t
), s AS (
  SELECT *, coalesce(sum(len(string_split(line, '⟦')) - len(string_split(line, '⟧')))
    OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM l
), w AS (
  SELECT page_id, i, trim(regexp_replace(translate(line, '⟦⟧', ''), ' {{2,}}', ' ', 'g')) AS plain,
    length(translate(line, '⟦⟧', '')) AS n,
    coalesce(length(array_to_string(regexp_extract_all(CASE WHEN open > 0 THEN '⟦' ELSE '' END || line, '⟦([^⟧]*)', 1), '')), 0) AS links
  FROM s
), c AS (
  SELECT *, 2 * links <= n AS is_prose, 2 * links <= n AND n >= 80 AS is_long FROM w WHERE plain <> ''
), k AS (
  SELECT *, is_prose AND (is_long OR NOT bool_or(is_long) OVER (PARTITION BY page_id)
    OR coalesce(lag(is_long) OVER (PARTITION BY page_id ORDER BY i), false)
    OR coalesce(lead(is_long) OVER (PARTITION BY page_id ORDER BY i), false)) AS kept
  FROM c
)
SELECT t.page_id, coalesce(string_agg(plain, chr(10) ORDER BY i) FILTER (WHERE kept), '') AS text
FROM t LEFT JOIN k ON k.page_id = t.page_id GROUP BY t.page_id"""
ORACLES["stable_keys"] = f"""
WITH g AS (
  SELECT CASE WHEN page_id % 3 = 0 THEN 'same' ELSE (page_id % 50)::VARCHAR END AS id,
    CASE WHEN page_id % 3 = 0 THEN 'x.example' ELSE {_host('url')} END AS url
  FROM pages
)
SELECT id, url, md5(length(id) || ':' || id || '/=' || url) || '-' || (row_number() OVER (PARTITION BY id, url) - 1)
  AS company_key FROM g"""
ORACLES["balanced_shards"] = """
SELECT 8::BIGINT AS n_shards, count(*) AS n_pages, sum(strlen(html))::BIGINT AS n_bytes, true AS balanced FROM pages"""
ORACLES["rejected_pages"] = """
WITH f AS (
  SELECT CASE WHEN page_id % 9 > 0 THEN url WHEN page_id % 2 > 0 THEN '  ' END AS page_url,
    (CASE page_id % 9 WHEN 1 THEN -1 ELSE 0 END)::INTEGER AS attempt,
    (CASE WHEN page_id % 9 = 2 THEN 999 WHEN page_id % 9 = 8 AND page_id % 2 = 0 THEN 404 ELSE 200 END)::INTEGER AS status,
    1700000000 + page_id AS second,
    CASE page_id % 9 WHEN 0 THEN 'no_address' WHEN 1 THEN 'bad_attempt' WHEN 2 THEN 'bad_status' WHEN 3 THEN 'no_markup'
      WHEN 4 THEN 'unclosed' WHEN 5 THEN 'unclosed' WHEN 6 THEN 'broken_xml'
      WHEN 8 THEN CASE WHEN page_id % 2 > 0 THEN 'no_markup' END END AS faults,
    page_id % 9 < 3 AS fatal
  FROM pages
)
SELECT * FROM f WHERE faults IS NOT NULL"""
ORACLES["attempt_times"] = f"""
WITH {_ATTEMPTS}, a AS (
  SELECT page_id, url, attempt, status, page_id + attempt AS second FROM attempts WHERE attempt < 5
  UNION ALL SELECT page_id, url, 4, 404, page_id + 9000 FROM pages WHERE page_id % 3 = 1
), t AS (
  SELECT url, coalesce(min(attempt) FILTER (WHERE NOT {_blocked('status')}), max(attempt)) AS terminal FROM a GROUP BY url
)
SELECT url AS page_url, terminal::INTEGER AS retries_used, 1700000000 + min(second) AS first,
  1700000000 + max(second) AS last
FROM a JOIN t USING (url) WHERE attempt <= terminal GROUP BY url, terminal"""
ORACLES["checked_options"] = """
SELECT page_id, CASE WHEN page_id % 7 IN (0, 2) THEN 'taken' ELSE 'refused' END AS answer FROM pages"""
ORACLES["incremental_records"] = ORACLES["page_digests"]
ORACLES["grouped_commit"] = f"""
WITH {_HOST_PAGES}
SELECT target, company_key AS id, status, num_pages_tried AS subpages_tried
FROM tallied, (SELECT unnest(['raw', 'log', 'results']) AS target)"""
