"""The same results in DuckDB SQL over the benchmark tables, written independently."""

from __future__ import annotations

_TEXT = "array_to_string({0}, ', ') AS {0}"
_DATES = "array_to_string(list_transform({0}, lambda x: strftime(x, '%Y-%m-%d %H:%M:%S')), ', ')"

# --- version table ----------------------------------------------------------
V = """
ordered AS (
  SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt
  FROM orders),
raw AS (
  SELECT 'c' || o_custkey AS id_hash, o_orderpriority AS title,
    '<h3>' || o_orderpriority || '</h3><p>Status <strong>' || o_orderstatus || '</strong></p>'
      AS description,
    CASE WHEN o_totalprice > 250000 THEN '<ul><li>A</li><li>' || o_orderstatus || '</li></ul>' END
      AS more_info,
    CASE WHEN o_totalprice > 100000 THEN o_orderstatus END AS legal_basis,
    [o_orderstatus] AS funding_type,
    CASE WHEN o_totalprice > 30000
         THEN string_split(replace(o_orderpriority, '-', ' '), ' ') END AS funding_area,
    CASE WHEN o_totalprice > 200000 THEN ['Nord', o_orderpriority] ELSE ['Süd'] END
      AS funding_location,
    CASE WHEN o_orderstatus = 'P' THEN ['Unternehmen', 'Hochschule'] END AS eligible_applicants,
    CASE WHEN o_orderstatus <> 'O' THEN 'Ministerium ' || o_orderstatus END AS funding_body,
    o_orderdate AS on_website_from,
    CASE WHEN nxt IS NOT NULL THEN nxt
         WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 9 DAY END AS on_website_to
  FROM ordered
  UNION ALL
  SELECT 's' || s_suppkey, s_name, '<p>' || s_name || '</p>', NULL, NULL, NULL::VARCHAR[],
    ['Versorgung'], NULL::VARCHAR[], NULL::VARCHAR[], NULL, TIMESTAMP '1995-01-01',
    NULL::TIMESTAMP
  FROM supplier),
v AS (
  SELECT *, 'programm-' || id_hash AS id_url,
    'https://www.example.org/FDB/Content/DE/Foerderprogramm/' || id_hash || '.html' AS url,
    sha256(CAST(json_object(
      'description', description, 'eligible_applicants', eligible_applicants,
      'funding_area', funding_area, 'funding_body', funding_body,
      'funding_location', funding_location, 'funding_type', funding_type,
      'legal_basis', legal_basis, 'more_info', more_info, 'title', title) AS VARCHAR)) AS checksum,
    CAST(date_diff('day', DATE '1970-01-01', CAST(on_website_from AS DATE)) AS BIGINT) AS load_id
  FROM raw)
"""
_SCALARS = ("title", "description", "more_info", "legal_basis", "funding_body", "id_url", "url",
            "checksum")
_LISTS = ("funding_type", "funding_area", "funding_location", "eligible_applicants")
_RECORD = (*_SCALARS, *_LISTS)


def _consolidated(fill: str = "coalesce(n.{0}, o.{0}) AS {0}", keep: str = "WHERE rn = 1") -> str:
    return V + """,
ended AS (
  SELECT *, row_number() OVER (PARTITION BY id_hash
      ORDER BY on_website_to DESC, on_website_from DESC, checksum DESC) AS rn,
    max(on_website_to) OVER (PARTITION BY id_hash) AS last_updated
  FROM v WHERE on_website_to IS NOT NULL),
o AS (SELECT * FROM ended """ + keep + """),
hist AS (
  SELECT id_hash, list(on_website_to ORDER BY on_website_to) AS dates
  FROM v WHERE on_website_to IS NOT NULL GROUP BY id_hash),
n AS (SELECT * FROM v WHERE on_website_to IS NULL),
born AS (SELECT id_hash, min(on_website_from) AS first_seen FROM v GROUP BY id_hash),
cur AS (
  SELECT coalesce(n.id_hash, o.id_hash) AS id_hash, """ + ", ".join(
        fill.format(c) for c in _RECORD) + """,
    hist.dates AS previous_update_dates, o.last_updated,
    coalesce(o.on_website_from, n.on_website_from) AS on_website_from,
    n.id_hash IS NULL AS deleted, born.first_seen
  FROM n FULL JOIN o ON n.id_hash = o.id_hash
  LEFT JOIN hist ON hist.id_hash = o.id_hash
  JOIN born ON born.id_hash = coalesce(n.id_hash, o.id_hash))
"""


CUR = _consolidated()
_CUR_COLUMNS = (
    "id_hash, " + ", ".join(_SCALARS) + ", " + ", ".join(_TEXT.format(c) for c in _LISTS)
    + ", " + _DATES.format("previous_update_dates") + " AS previous_update_dates"
    + ", last_updated, on_website_from, deleted, first_seen"
)
_V_COLUMNS = (
    "id_hash, " + ", ".join(_SCALARS) + ", " + ", ".join(_TEXT.format(c) for c in _LISTS)
    + ", on_website_from, on_website_to, load_id"
)
_MIN_COLUMNS = (
    "id_hash, deleted, on_website_from, url, title, description, more_info, legal_basis, "
    + ", ".join(_TEXT.format(c) for c in _LISTS) + ", funding_body"
)


def _on_v(select: str) -> str:
    return f"WITH {V} {select}"


def _on_cur(select: str) -> str:
    return f"WITH {CUR} {select}"


# --- user states ------------------------------------------------------------

def _states(every: str) -> str:
    return f"""
s AS (
  SELECT CAST(user_id AS VARCHAR) AS id_hash, date_trunc('{every}', ts)::TIMESTAMP AS run_at,
    event_type AS title, sha256('{{"title":"' || event_type || '"}}') AS checksum
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('{every}', ts)
                             ORDER BY ts DESC, event_id DESC) = 1)
"""


def _versions_of(states: str) -> str:
    return f"""
runs AS (
  SELECT run_at, row_number() OVER (ORDER BY run_at) AS i,
    lead(run_at) OVER (ORDER BY run_at) AS next_run
  FROM (SELECT DISTINCT run_at FROM {states})),
numbered AS (
  SELECT t.*, runs.i, runs.i - row_number() OVER (
    PARTITION BY id_hash, checksum ORDER BY runs.i) AS island
  FROM {states} t JOIN runs USING (run_at)),
spans AS (
  SELECT id_hash, title, checksum, island, min(run_at) AS on_website_from, max(run_at) AS last_run,
    min(i) AS load_id
  FROM numbered GROUP BY ALL)
SELECT id_hash, title, checksum, on_website_from, next_run AS on_website_to, load_id
FROM spans JOIN runs ON runs.run_at = spans.last_run
"""


def _replay(every: str) -> str:
    return f"WITH {_states(every)}, {_versions_of('s')}"


def _merge(absent: str) -> str:
    """The last day into the history of all days before: kept, retired and opened rows.

    ``absent`` says which absent rows end.
    """
    return f"""
WITH {_states('day')},
d AS (SELECT max(run_at) AS last, count(DISTINCT run_at) AS days FROM s),
b AS (SELECT s.* FROM s, d WHERE run_at = last),
e AS (SELECT s.* FROM s, d WHERE run_at < last),
a AS (SELECT * FROM (WITH {_versions_of('e')}) WHERE on_website_to IS NULL)
SELECT a.id_hash, a.title, a.checksum, a.on_website_from,
  CASE WHEN b.id_hash IS NULL AND {absent} OR b.checksum <> a.checksum
       THEN (SELECT last FROM d) END AS on_website_to, a.load_id
FROM a LEFT JOIN b ON a.id_hash = b.id_hash
UNION ALL
SELECT b.id_hash, b.title, b.checksum, b.run_at, NULL, (SELECT days FROM d)
FROM b LEFT JOIN a ON a.id_hash = b.id_hash AND a.checksum = b.checksum
WHERE a.id_hash IS NULL
"""


# --- links ------------------------------------------------------------------
NAV = """
nav AS (
  SELECT page_id AS page_no, url AS page_url,
    regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs FROM pages),
link AS (
  SELECT page_no, page_url, CAST(unnest(range(len(hrefs))) AS INTEGER) AS pos,
    unnest(hrefs) AS href FROM nav),
r AS (
  SELECT page_no, page_url, pos, lower(regexp_extract(page_url, '^(https?://[^/?#]+)', 1))
    || replace(replace(url_encode(href), '%2F', '/'), '%2C', ',') AS url FROM link)
"""
CARDS = """
card AS (
  SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_no,
    CAST(row_number() OVER (PARTITION BY floor(p_partkey / 10) ORDER BY p_partkey) AS INTEGER)
      AS card_no,
    CASE WHEN p_type <> 'ECONOMY' THEN 'https://www.example.org/FDB/Content/DE/Foerderprogramm/'
      || replace(p_name, ' ', '-') || '.html' END AS url,
    p_brand = 'Brand#7' AS no_text
  FROM part),
r AS (
  SELECT page_no, 'https://www.example.org/Suche.html?page=' || page_no AS page_url, url,
    CAST(row_number() OVER (PARTITION BY page_no ORDER BY card_no) - 1 AS INTEGER) AS pos
  FROM card WHERE url IS NOT NULL)
"""
FIRST = """
SELECT url, page_no, pos, n AS occurrences FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_no, pos) AS rn,
    count(*) OVER (PARTITION BY url) AS n FROM r) WHERE rn = 1
"""

LATER = """
SELECT url, page_no, pos, original_page_no, original_page_url FROM (
  SELECT *, row_number() OVER w AS rn, first_value(page_no) OVER w AS original_page_no,
    first_value(page_url) OVER w AS original_page_url
  FROM r WINDOW w AS (PARTITION BY url ORDER BY page_no, pos)) WHERE rn > 1"""
TOTALS = f"""
, f AS ({FIRST}),
per_page AS (
  SELECT page_no, count(*) AS cards, (SELECT count(*) FROM f WHERE f.page_no = card.page_no)
    AS new_urls FROM card GROUP BY page_no)
SELECT page_no, cards, new_urls, CAST(sum(cards) OVER (ORDER BY page_no) AS BIGINT) AS total_cards,
  CAST(sum(new_urls) OVER (ORDER BY page_no) AS BIGINT) AS total_urls FROM per_page"""

# --- detail pages -----------------------------------------------------------
D = """
doc AS (
  SELECT doc_id AS page_id, lang, source, n_chars, CAST(doc_id AS VARCHAR) AS num,
    lang = 'es' AND source = 'src0' AS bare, lang IN ('en', 'fr') AS tabbed,
    '<p>' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
                     chr(10), '</p><p>') || '</p>' AS paragraphs,
    'https://www.example.org/FDB/Content/DE/' || CASE WHEN lang = 'es' THEN 'Archiv/'
      ELSE 'Foerderprogramm/' || source || '/' END || 'Doc-' || doc_id || '.html' AS url
  FROM documents),
x AS (
  SELECT *,
    CASE WHEN n_chars >= 50 THEN 'Programm ' || num || ' (' || source || ' & ' || lang || ')' END
      AS title,
    CASE WHEN bare THEN NULL
         WHEN tabbed THEN '<article class="content--tab-text">' || paragraphs || '</article>'
         ELSE '<div class="content"> <div class="rich--text">' || paragraphs || '</div> </div>' END
      AS description,
    CASE WHEN tabbed AND NOT bare THEN '<article class="content--tab-text"><ul><li>Quelle '
      || source || '<li>Zeichen ' || n_chars || '</ul></article>' END AS more_info,
    CASE WHEN bare THEN NULL WHEN lang = 'de' THEN 'Gesetz ' || source
         WHEN lang = 'en' THEN '<article class="content--tab-text"><h3>Recht</h3><p>' || source
           || '</p></article>' END AS legal_basis,
    CASE WHEN NOT bare THEN 'Darlehen, ' || lang END AS funding_type,
    CASE WHEN NOT bare THEN 'Text, Bereich & ' || source || ', ' || lang END AS funding_area,
    CASE WHEN NOT bare AND lang <> 'fr' THEN 'bundesweit' END AS funding_location,
    CAST(NULL AS VARCHAR) AS eligible_applicants,
    CASE WHEN lang = 'es' THEN 'doc-' || num ELSE lower(source) || '-doc-' || num END AS id_url
  FROM doc)
"""
_ARTICLE = "regexp_extract(html, '(?s)<article>.*</article>')"
_TITLE = (
    "trim(replace(replace(regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1), '&quot;', '\"'),"
    " '&amp;', '&'))"
)
_PAGE_SLUG = ("lower(replace(replace(regexp_extract(url, '://(.*)$', 1), '/', '-'), '.html', ''))")


def _on_x(select: str) -> str:
    return f"WITH {D} {select}"


# --- analytics --------------------------------------------------------------

def _counts(column: str) -> str:
    return _on_cur(f"SELECT {column}, count(*) AS count FROM "
                   f"(SELECT unnest({column}) AS {column} FROM cur) GROUP BY 1")


def _shares(name: str, source: str, share: str) -> str:
    return f"""
{name} AS (
  SELECT category, count(*) / (SELECT count(*) FROM {source}) * 100 AS {share}
  FROM (SELECT unnest(list_distinct(funding_area)) AS category FROM {source}) GROUP BY 1)
"""


def _compare(condition: str) -> str:
    return f"""
WITH {CUR},
rec AS (SELECT * FROM cur WHERE {condition}
        AND on_website_from > TIMESTAMP '2001-08-15' - INTERVAL 30 DAY),
{_shares('ra', 'rec', 'recent_share')}, {_shares('rb', 'cur', 'total_share')}
SELECT category, recent_share, coalesce(total_share, 0) AS total_share
FROM ra LEFT JOIN rb USING (category)
"""


WEEKS = CUR + """,
w AS (SELECT *, date_trunc('week', on_website_from)::TIMESTAMP AS week_start_date FROM cur
      WHERE on_website_from <> (SELECT min(on_website_from) FROM cur))
"""
_SERIES = """
SELECT week_start_date, count(*) FILTER (WHERE NOT deleted) AS added_count,
  count(*) FILTER (WHERE deleted) AS deleted_count FROM w GROUP BY 1
"""
_PROFILED = ("id_hash", *_RECORD, "previous_update_dates", "last_updated", "on_website_from",
             "deleted", "first_seen")
_LICENSE = (
    "chr(10) || 'Inhalte von foerderdatenbank.de sind individuell lizensiert durch das "
    "Bundesministerium für Wirtschaft und Klimaschutz unter CC BY-ND 3.0 DE. ' || chr(10) || "
    "'Der hier zur Verfügung gestellte Datensatz gibt die Informationen zu jedem einzelnen "
    "Förderprogramms in einem maschinenlesbaren Format wider. ' || chr(10) || "
    "'Lizenzinformationen zu jedem einzenlnen Förderprogramm inkl. URL können der "
    "Datensatz-Spalte license_info sowie der Datei LICENSE-DATA entnommen werden.' || chr(10)"
)

ORACLES: dict[str, str] = {
    "s1_seed_urls": "SELECT DISTINCT trim(url) AS url FROM pages WHERE trim(url) <> ''",
    "s2_page_source": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages",
    "s3_replace_table": _on_v(f"SELECT {_V_COLUMNS} FROM v"),
    "s4_history_store": _replay("week"),
    "s4_compacted_store": _replay("week"),
    "h3_replay_into_store": _replay("week"),
    "s4_partial_store": f"""
WITH {_states('week')},
runs AS (SELECT run_at, row_number() OVER (ORDER BY run_at) AS load_id FROM (SELECT DISTINCT run_at FROM s)),
c AS (
  SELECT * FROM (SELECT *, lag(checksum) OVER (PARTITION BY id_hash ORDER BY run_at) AS before FROM s)
  WHERE before IS DISTINCT FROM checksum)
SELECT id_hash, title, checksum, run_at AS on_website_from,
  lead(run_at) OVER (PARTITION BY id_hash ORDER BY run_at) AS on_website_to, load_id
FROM c JOIN runs USING (run_at)""",
    "h11_repaired_store": f"""
WITH v AS ({_replay("week")})
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY id_hash, checksum ORDER BY load_id DESC) = 1""",
    "i3_new_watched_field": f"""
WITH {_states('week')},
n AS (SELECT run_at, row_number() OVER (ORDER BY run_at) AS week FROM (SELECT DISTINCT run_at FROM s)),
t AS (
  SELECT id_hash, run_at, title || CASE WHEN week >= 3 AND id_hash::BIGINT % 2 = 0 THEN '+even' ELSE '' END AS title,
    title || CASE WHEN week >= 3 AND id_hash::BIGINT % 2 = 0 THEN '+even' ELSE '' END AS checksum
  FROM s JOIN n USING (run_at))
SELECT id_hash, string_split(title, '+')[1] AS title, CASE WHEN title LIKE '%+even' THEN 'even' END AS extra,
  on_website_from, on_website_to, 2 * load_id AS load_id
FROM ({_versions_of('t').replace('runs AS (', 'WITH runs AS (', 1)})""",
    "s5_read_versions": _on_v("SELECT id_hash, title, on_website_from, on_website_to FROM v "
                              "WHERE on_website_to IS NOT NULL"),
    "s6_full_parquet": _on_cur(f"SELECT {_CUR_COLUMNS} FROM cur"),
    "s7_min_parquet": _on_cur(f"SELECT {_MIN_COLUMNS} FROM cur"),
    "s8_min_csv": _on_cur(f"SELECT {_MIN_COLUMNS} FROM cur"),
    "s9_read_published": _on_cur("SELECT id_hash, last_updated FROM cur WHERE deleted"),
    "s10_sql_over_history": _on_v(
        "SELECT id_hash, count(*) FILTER (WHERE on_website_to IS NULL) AS active_versions, "
        "max(on_website_to) AS last_updated FROM v GROUP BY id_hash"),
    "l1_links": f"WITH {NAV} SELECT page_no, pos, href FROM link",
    "l2_canonical_links": f"WITH {NAV} SELECT page_no, pos, url FROM r",
    "l3_first_seen": f"WITH {NAV} {FIRST}",
    "l3_first_seen_cards": f"WITH {CARDS} {FIRST}",
    "l3_streamed_first_seen": f"WITH {CARDS} {FIRST}",
    "l4_streamed_duplicates": f"WITH {CARDS} {LATER}",
    "l7_streamed_totals": f"WITH {CARDS} {TOTALS}",
    "l9_pages_of_links": f"""
SELECT f.url, f.page_no, p.page_id FROM (WITH {CARDS} {FIRST}) f JOIN (
  SELECT 'https://www.example.org/FDB/Content/DE/Foerderprogramm/' || replace(p_name, ' ', '-') || '.html' AS url, min(p_partkey) AS page_id
  FROM part WHERE p_brand <> 'Brand#3' GROUP BY 1) p USING (url)""",
    "l9_links_without_page": f"""
SELECT f.url, f.page_no FROM (WITH {CARDS} {FIRST}) f WHERE f.url NOT IN (
  SELECT 'https://www.example.org/FDB/Content/DE/Foerderprogramm/' || replace(p_name, ' ', '-') || '.html' FROM part WHERE p_brand <> 'Brand#3')""",
    "l9_text_of_links": """
WITH p AS (SELECT page_id, html, regexp_replace(url, '#.*$', '') AS url FROM pages),
f AS (SELECT url, min(page_id) AS page_no FROM p WHERE page_id % 2 = 0 GROUP BY url)
SELECT url, page_no, page_id, sha1(html) AS html_sha1 FROM f JOIN p USING (url)""",
    "l4_duplicate_links": f"WITH {CARDS} {LATER}",
    "l5_listing_quality": f"""
WITH {NAV} SELECT page_no, CAST(len(hrefs) AS INTEGER) AS cards,
  CASE WHEN len(hrefs) = 0 THEN 'none' WHEN len(hrefs) <> 10 THEN 'unexpected' ELSE 'ok' END
    AS status FROM nav""",
    "l6_incomplete_cards": f"""
WITH {CARDS} SELECT page_no, card_no, url IS NULL AS missing_link, no_text AS missing_text
FROM card WHERE url IS NULL OR no_text""",
    "l7_discovery_totals": f"WITH {CARDS} {TOTALS}",
    "l8_next_pages": f"""
WITH {CARDS} SELECT page_no, CASE WHEN page_no < (SELECT max(page_no) FROM card)
  THEN '?page=' || (page_no + 1) END AS next_href FROM (SELECT DISTINCT page_no FROM card)""",
    "x1_titles": f"SELECT page_id, {_TITLE} AS title FROM pages WHERE {_TITLE} <> ''",
    "x2_untitled_pages": _on_x(
        "SELECT page_id, 'no title' AS reason FROM x WHERE title IS NULL"),
    "x3_tabs": _on_x("SELECT page_id, description, more_info FROM x WHERE title IS NOT NULL"),
    "x4_content_block": f"SELECT page_id, {_ARTICLE} AS description FROM pages",
    "x5_labels": _on_x("""
SELECT page_id,
  CASE WHEN bare OR NOT tabbed THEN '' WHEN lang = 'en' THEN 'description, more_info, ?, legal_basis'
       ELSE 'description, more_info, ?' END AS tab_fields,
  CASE WHEN bare THEN '' ELSE 'funding_type, funding_area'
    || CASE WHEN lang <> 'fr' THEN ', funding_location' ELSE '' END
    || ', eligible_applicants, ?, funding_type'
    || CASE WHEN lang = 'de' THEN ', legal_basis' ELSE '' END
    || ', funding_body, contact_info, further_links' END AS entry_fields
FROM x"""),
    "x6_repeated_labels": _on_x("SELECT page_id, funding_type FROM x"),
    "x7_list_fields": _on_x("SELECT page_id, funding_type, funding_area, funding_location, "
                            "eligible_applicants FROM x"),
    "x8_funding_body": _on_x("SELECT page_id, CASE WHEN NOT bare THEN 'Ministerium ' || source END "
                             "AS funding_body FROM x"),
    "x9_further_links": _on_x("""
SELECT page_id, CASE WHEN NOT bare THEN 'https://' || source || '.example.org/a?b=1&c=' || num
  || ', https://www.foerderdatenbank.de/FDB/' || num || '.html' END AS further_links FROM x"""),
    "x10_institution": _on_x("""
SELECT page_id, CASE WHEN NOT bare THEN 'Projekthaus ' || source END
  AS contact_info_institution FROM x"""),
    "x11_address": _on_x("""
SELECT page_id, CASE WHEN NOT bare THEN 'Gasse ' || num END AS contact_info_street,
  CASE WHEN NOT bare THEN '10115 Ort-' || lang END AS contact_info_city FROM x"""),
    "x12_fax_phone": _on_x("""
SELECT page_id, CASE WHEN NOT bare AND lang = 'de' THEN '0309 ' || num END AS contact_info_fax,
  CASE WHEN NOT bare THEN '030 ' || num END AS contact_info_phone FROM x"""),
    "x13_email_website": _on_x("""
SELECT page_id, CASE WHEN NOT bare THEN source || '@example.org' END AS contact_info_email,
  CASE WHEN NOT bare THEN 'https://' || source || '.example.org/' END AS contact_info_website
FROM x"""),
    "x14_other_labels": _on_x("SELECT page_id, legal_basis FROM x"),
    "x15_page_issues": _on_x("""
SELECT page_id, 'no title' AS reason FROM x WHERE title IS NULL
UNION ALL SELECT page_id, 'no content' FROM x WHERE bare
UNION ALL SELECT page_id, 'no data' FROM x WHERE bare AND title IS NOT NULL
UNION ALL SELECT page_id, 'unknown tab' FROM x WHERE tabbed"""),
    "x15_issues_of_a_run": _on_x("""
SELECT page_id, 'no title' AS reason FROM x WHERE title IS NULL
UNION ALL SELECT page_id, 'no content' FROM x WHERE bare
UNION ALL SELECT page_id, 'no data' FROM x WHERE bare AND title IS NOT NULL
UNION ALL SELECT page_id, 'unknown tab' FROM x WHERE tabbed"""),
    "x15_counts_of_runs": _on_x("""
SELECT run, count(*) AS pages, count(*) FILTER (WHERE title IS NULL) AS untitled,
  count(*) FILTER (WHERE bare AND title IS NOT NULL) AS empty,
  count(*) FILTER (WHERE title IS NOT NULL AND description IS NULL) AS rejected, 0::BIGINT AS repeated,
  CASE run WHEN 0 THEN count(*) FILTER (WHERE title IS NOT NULL AND description IS NOT NULL) ELSE 0 END AS opened,
  0::BIGINT AS closed
FROM x, (SELECT unnest([0::BIGINT, 1]) AS run) GROUP BY run"""),
    "s9_newest_publication": _on_x("""
SELECT md5(id_url) AS id_hash, title, description, false AS deleted,
  CASE WHEN page_id % 2 = 0 THEN TIMESTAMP '2025-06-19 02:00:00' ELSE TIMESTAMP '2025-06-20 02:00:00' END AS on_website_from
FROM x WHERE title IS NOT NULL AND description IS NOT NULL"""),
    "l2_unresolved_links": f"WITH {NAV} SELECT page_no, pos, 'http://[' || href AS href FROM link WHERE page_no % 3 = 0",
    "i1_slugs": f"SELECT page_id, {_PAGE_SLUG} AS id_url FROM pages",
    "i2_keys": _on_x("SELECT page_id, url, id_url, md5(id_url) AS id_hash FROM x"),
    "i3_checksums": """
SELECT doc_id, sha256(CAST(json_object('lang', lang, 'source', source, 'text', text) AS VARCHAR))
  AS checksum FROM documents""",
    "i4_license_lines": """
SELECT o_orderkey, chr(10) || o_orderpriority || ' von Bundesministerium für Wirtschaft und '
  || 'Klimaschutz, lizensiert unter CC BY-ND 3.0 DE '
  || '(https://creativecommons.org/licenses/by-nd/3.0/de/deed.de), zuletzt abgerufen am '
  || strftime(o_orderdate, '%Y-%m-%d') || ' unter https://www.example.org/' || o_orderkey
  || chr(10) AS license_info FROM orders""",
    "i5_valid_records": _on_x("""
SELECT md5(id_url) AS id_hash, id_url, title, description FROM x
WHERE title IS NOT NULL AND description IS NOT NULL"""),
    "i5_rejected_records": _on_x("""
SELECT page_id, concat_ws(', ', CASE WHEN title IS NULL THEN 'title: missing' END,
  CASE WHEN description IS NULL THEN 'description: missing' END,
  CASE WHEN title IS NULL THEN 'license_info: missing' END) AS problems FROM x
WHERE title IS NULL OR description IS NULL"""),
    "i6_repeated_keys": _on_v(
        "SELECT id_hash, count(*) AS rows FROM v GROUP BY id_hash HAVING count(*) > 1"),
    "i6_unique_or_fail": _on_cur("SELECT id_hash, deleted FROM cur"),
    "h1_merge_complete": _merge("true"),
    "h2_merge_partial": _merge("false"),
    "h2_merge_partial_by_title": _merge("a.title IN (SELECT title FROM b)"),
    "h3_replay": _replay("day"),
    "h4_retired_aggregate": _on_v(
        "SELECT id_hash, " + _DATES.format("list(on_website_to ORDER BY on_website_to)")
        + " AS previous_update_dates, max(on_website_to) AS last_updated "
        "FROM v WHERE on_website_to IS NOT NULL GROUP BY id_hash"),
    "h4_update_log": _on_v(
        "SELECT id_hash, on_website_to AS updated_at, count(*) AS versions FROM v "
        "WHERE on_website_to IS NOT NULL GROUP BY ALL"),
    "h5_active_slice": _on_v(
        "SELECT id_hash, " + ", ".join(_SCALARS) + ", "
        + ", ".join(_TEXT.format(c) for c in _LISTS)
        + ", on_website_from FROM v WHERE on_website_to IS NULL"),
    "h8_consolidated": _on_cur(f"SELECT {_CUR_COLUMNS} FROM cur"),
    "h8_consolidated_parts": _on_cur(f"SELECT {_CUR_COLUMNS} FROM cur"),
    "h8_consolidated_ties": (
        f"WITH {_consolidated(keep='WHERE on_website_to = last_updated')} "
        f"SELECT {_CUR_COLUMNS} FROM cur"),
    "h8_consolidated_no_carry": (
        "WITH " + _consolidated("CASE WHEN n.id_hash IS NULL THEN o.{0} ELSE n.{0} END AS {0}")
        + f" SELECT {_CUR_COLUMNS} FROM cur"),
    "h6_latest_retired": _on_cur(
        "SELECT id_hash, " + _DATES.format("hist.dates") + " AS previous_update_dates, "
        "last_updated, on_website_from, " + ", ".join(_SCALARS) + ", "
        + ", ".join(_TEXT.format(c) for c in _LISTS) + " FROM o JOIN hist USING (id_hash)"),
    "h6_latest_retired_ties": (
        f"WITH {_consolidated(keep='WHERE on_website_to = last_updated')} "
        "SELECT id_hash, " + _DATES.format("hist.dates") + " AS previous_update_dates, "
        "last_updated, on_website_from, " + ", ".join(_SCALARS) + ", "
        + ", ".join(_TEXT.format(c) for c in _LISTS) + " FROM o JOIN hist USING (id_hash)"),
    "h7_deleted_keys": _on_v("""
SELECT DISTINCT id_hash FROM v WHERE on_website_to IS NOT NULL AND id_hash NOT IN
  (SELECT id_hash FROM v WHERE on_website_to IS NULL)"""),
    "h9_changed_and_active": _on_v("""
SELECT id_hash FROM v WHERE on_website_to IS NOT NULL
INTERSECT SELECT id_hash FROM v WHERE on_website_to IS NULL"""),
    "h10_duplicate_versions": _on_v(
        "SELECT id_hash, checksum, count(*) AS versions, max(load_id) AS max_load_id FROM v "
        "GROUP BY id_hash, checksum HAVING count(*) > 1"),
    "h11_drop_duplicates": _on_v(f"""
SELECT {_V_COLUMNS} FROM v QUALIFY row_number() OVER (PARTITION BY id_hash, checksum
  ORDER BY load_id DESC, on_website_from DESC, on_website_to DESC NULLS FIRST) = 1"""),
    "h12_history_lengths": _on_v("SELECT id_hash, count(*) AS list_length FROM v "
                                 "WHERE on_website_to IS NOT NULL GROUP BY id_hash"),
    "h12_changed_once": _on_v("SELECT id_hash FROM v WHERE on_website_to IS NOT NULL "
                              "GROUP BY id_hash HAVING count(*) = 1"),
    "h13_invariants": _on_cur("""
SELECT 'active row without start date' AS rule,
  count(*) FILTER (WHERE NOT deleted AND on_website_from IS NULL) AS violations FROM cur
UNION ALL SELECT 'deleted row without start date',
  count(*) FILTER (WHERE deleted AND on_website_from IS NULL) FROM cur
UNION ALL SELECT 'row without key', count(*) FILTER (WHERE id_hash IS NULL) FROM cur
UNION ALL SELECT 'row without id_url', count(*) FILTER (WHERE id_url IS NULL) FROM cur
UNION ALL SELECT 'active row updated before its start',
  count(*) FILTER (WHERE NOT deleted AND last_updated < on_website_from) FROM cur"""),
    "h14_reconcile": _on_cur("""
SELECT count(*) FILTER (WHERE NOT deleted) AS active,
  (SELECT count(*) FROM customer) AS expected,
  abs(count(*) FILTER (WHERE NOT deleted) - (SELECT count(*) FROM customer)) <= 2 AS agrees
FROM cur"""),
    "h15_dead_links": _on_cur("""
SELECT id_hash, url, last_updated FROM cur LEFT JOIN (
  SELECT 'c' || o_custkey AS key, max(o_totalprice) > 300000 AS ok FROM orders GROUP BY o_custkey
) ON key = id_hash WHERE NOT deleted AND NOT coalesce(ok, false)"""),
    "p1_min_table": _on_cur(f"SELECT {_MIN_COLUMNS} FROM cur"),
    "p2_markdown": _on_cur("""
SELECT id_hash,
  regexp_replace(regexp_replace(description, '<h3>(.*)</h3><p>Status <strong>(.)</strong></p>',
    '### \\1' || chr(10) || chr(10) || 'Status **\\2**'), '</?p>', '', 'g') AS description,
  regexp_replace(more_info, '<ul><li>A</li><li>(.)</li></ul>', '* A' || chr(10) || '* \\1')
    AS more_info
FROM cur"""),
    "p3_flat_lists": _on_v(
        "SELECT id_hash, on_website_from, "
        + ", ".join(_TEXT.format(c) for c in _LISTS if c != "funding_type") + " FROM v"),
    "p4_license": _on_cur(f"SELECT id_hash, {_LICENSE} AS license_text FROM cur"),
    "a1_area_counts": _counts("funding_area"),
    "a1_location_counts": _counts("funding_location"),
    "a1_applicant_counts": _counts("eligible_applicants"),
    "a1_type_counts": _counts("funding_type"),
    "a2_area_shares": f"WITH {CUR}, {_shares('sh', 'cur', 'share')} SELECT * FROM sh",
    "a3_recently_deleted": _compare("deleted"),
    "a3_recently_added": _compare("NOT deleted"),
    "a4_freshness": _on_cur("SELECT coalesce(max(last_updated), max(on_website_from)) "
                            "AS most_recent_update FROM cur"),
    "a5_active_programs": _on_cur("SELECT id_hash, title FROM cur WHERE NOT deleted"),
    "a5_active_count": _on_cur("SELECT count(*) AS active FROM cur WHERE NOT deleted"),
    "a6_profile": _on_cur(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE max(typeof({c})) WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'VARCHAR[]' THEN 'array<string>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
        "WHEN 'TIMESTAMP[]' THEN 'array<timestamp_ntz>' WHEN 'BOOLEAN' THEN 'boolean' END AS type, "
        "count(*) AS row_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM cur" for c in _PROFILED)),
    "a7_weeks": _on_cur(
        "SELECT id_hash, date_trunc('week', on_website_from)::TIMESTAMP AS week_start_date "
        "FROM cur"),
    "a8_without_first_load": f"WITH {WEEKS} SELECT id_hash, on_website_from FROM w",
    "a9_weekly_added": f"WITH {WEEKS} SELECT week_start_date, count(*) AS added_count FROM w "
                       "WHERE NOT deleted GROUP BY 1",
    "a10_weekly_deleted": f"WITH {WEEKS} SELECT week_start_date, count(*) AS deleted_count FROM w "
                          "WHERE deleted GROUP BY 1",
    "a10_weekly_deleted_by_update": _on_cur("""
SELECT date_trunc('week', last_updated)::TIMESTAMP AS week_start_date, count(*) AS deleted_count
FROM cur WHERE deleted AND last_updated <> (SELECT min(last_updated) FROM cur) GROUP BY 1"""),
    "a11_weekly_series": f"WITH {WEEKS} {_SERIES}",
    "a12_series_if_history": f"WITH {WEEKS}, s AS ({_SERIES}) SELECT * FROM s WHERE "
                             "(SELECT count(last_updated) FROM cur) > 0",
    "a13_recent": _on_cur("SELECT id_hash, on_website_from, deleted FROM cur WHERE "
                          "on_website_from > TIMESTAMP '2001-08-15' - INTERVAL 30 DAY"),
    "a14_first_rows": _on_cur("SELECT id_hash, title FROM cur ORDER BY id_hash LIMIT 5"),
    "a14_row_at": _on_cur("SELECT id_hash, array_to_string(funding_type, ', ') AS funding_type "
                          "FROM cur ORDER BY id_hash LIMIT 1 OFFSET 999"),
    "a15_distinct_titles": _on_cur("SELECT DISTINCT title FROM cur"),
    "a15_null_among_starts": _on_cur(
        "SELECT count(*) FILTER (WHERE on_website_from IS NULL) > 0 AS has_null FROM cur"),
    "a16_pick_deleted": _on_cur("SELECT id_hash, deleted FROM cur WHERE deleted "
                                "ORDER BY md5('0:' || id_hash), id_hash LIMIT 1"),
    "t1_streamed_pages": f"""
SELECT DISTINCT md5({_PAGE_SLUG}) AS id_hash, {_PAGE_SLUG} AS id_url FROM pages
WHERE {_TITLE} <> ''""",
    "u1_markdown_of_articles": """
SELECT doc_id AS page_id, CASE doc_id % 8
  WHEN 0 THEN lang || ' ' || source || chr(10) || repeat('=', length(lang || ' ' || source)) || chr(10) || chr(10) || n_chars
  WHEN 1 THEN '### ' || lang || chr(10) || chr(10) || source || '  ' || chr(10) || n_chars
  WHEN 2 THEN '* ' || lang || chr(10) || '* ' || source
  WHEN 3 THEN '3. ' || lang || chr(10) || '4. ' || source
  WHEN 4 THEN '| ' || lang || ' | ' || source || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_chars || ' | x |'
  WHEN 5 THEN lang || chr(10) || chr(10) || '```' || chr(10) || source || chr(10) || '  ' || n_chars || chr(10) || '```'
  WHEN 6 THEN '[' || source || '](https://x.example/' || n_chars || ') **' || lang || '** ~~old~~'
  ELSE '> ' || lang || '  ' || chr(10) || '> ' || source END AS markdown
FROM documents""",
    "s2_page_files": r"""
SELECT page_id, CASE page_id % 3 WHEN 1 THEN 'cp1252' ELSE 'utf-8' END AS charset, CASE page_id % 3
  WHEN 0 THEN sha1(rtrim(html, chr(10)))
  WHEN 1 THEN sha1(rtrim('<meta charset="ISO-8859-1">ü' || regexp_replace(html, '[^\x00-\x7F]', '', 'g'), chr(10)))
  ELSE 'not text in its character set' END AS found
FROM pages""",
    "u2_two_layouts": f"""
SELECT -1 - page_id AS page_id, 'detail' AS layout, title, funding_type, funding_area,
  CASE WHEN NOT bare THEN '10115 Ort-' || lang END AS city FROM (WITH {D} SELECT * FROM x)
UNION ALL SELECT page_id, 'article', nullif({_TITLE}, ''), NULL, NULL, NULL FROM pages WHERE html LIKE '%<article>%'""",
    "u2_rules_for_ads": r"""
SELECT page_id, nullif(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), '') AS title FROM pages""",
}
