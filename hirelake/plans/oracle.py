"""SQL for DuckDB that gives the same rows as the registered queries, written independently of them."""

from __future__ import annotations

from hirelake.plans.queries import (
    CALENDAR_OF_REPORT,
    DIMENSION_LOADED_UNTIL,
    POSTED_ANCHOR,
    SNAPSHOT_DAY,
    SNAPSHOT_DAY_WITHOUT_ADS,
)
from hirelake.schemas import CLEAN_JOBS
from hirelake.sources.fixtures import LANGUAGE_MARKERS, NAMED_TOOLS, PROSE_TOOLS


def squeezed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[\s\x0B\x1C-\x1F\x85\p{{Z}}]+', ' ', 'g'))"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def tools(text: str) -> str:
    """Tools in a squeezed text as a list. Each separator is doubled, so neighbours share none."""
    doubled = rf"' ' || regexp_replace({text}, '([^\p{{L}}\p{{N}}_])', '\1\1', 'g') || ' '"
    terms = "|".join(t.replace(" ", "  ") for t in sorted(PROSE_TOOLS, key=len, reverse=True))
    found = rf"regexp_extract_all({doubled}, '[^\p{{L}}\p{{N}}_]((?i:{terms}))[^\p{{L}}\p{{N}}_]', 1)"
    return f"list_transform({found}, lambda t: replace(t, '  ', ' '))"


POSTINGS = f"""
postings AS (
  SELECT o_orderkey AS id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS title, c_name AS company,
         n_name || ', ' || r_name AS location, o_orderpriority AS employment_type,
         CAST(o_orderdate AS DATE) AS date_posted, CAST(NULL AS VARCHAR) AS job_description,
         o_orderdate AS metadata_lastupdated, CAST(NULL AS VARCHAR) AS metadata_application_link,
         'orders' AS metadata_source, n_name, r_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

CLEAN = f"""{POSTINGS},
roled AS (
  SELECT *, CASE title WHEN 'Furniture' THEN 'Data Scientist' WHEN 'Building' THEN 'Data Analyst'
              WHEN 'Machinery' THEN 'Machine Learning Engineer' WHEN 'Automobile' THEN 'Data Engineer'
              ELSE 'Other' END AS role
  FROM postings
),
clean AS (
  SELECT id, title, md5(role) AS role_key, role, md5(company) AS company_key, company,
         md5(location) AS location_key, location, r_name AS country, n_name AS city,
         md5(employment_type) AS employment_type_key, employment_type, date_posted,
         {squeezed("text")} AS job_description,
         array_to_string({tools(squeezed("text"))}, ', ') AS toolset_list,
         metadata_lastupdated, metadata_application_link, metadata_source
  FROM roled LEFT JOIN documents ON doc_id = id
)"""

CANDIDATES = f"""{CLEAN},
candidates AS (
  SELECT id, date_posted AS date_posted_fk, role_key AS role_fk, company_key AS company_fk,
         employment_type_key AS employment_type_fk, location_key AS location_fk, toolset_list,
         metadata_lastupdated AS last_updated,
         CAST(date_diff('day', date_posted, CAST(metadata_lastupdated AS DATE)) AS INTEGER) AS days_opened
  FROM clean
)"""

FACT_KEYS = "date_posted_fk, role_fk, company_fk, employment_type_fk, location_fk"

FACT = f"""{CANDIDATES},
fact AS (
  SELECT {FACT_KEYS}, toolset_list, days_opened, last_updated FROM candidates
  QUALIFY row_number() OVER (PARTITION BY {FACT_KEYS} ORDER BY last_updated DESC, id DESC) = 1
)"""

# The same without the descriptions, for queries that do not show the tools.
CLEAN_BARE = CLEAN.replace(squeezed("text"), "CAST(NULL AS VARCHAR)").replace(
    "FROM roled LEFT JOIN documents ON doc_id = id", "FROM roled"
)
CANDIDATES_BARE = CANDIDATES.replace(CLEAN, CLEAN_BARE)
FACT_BARE = FACT.replace(CLEAN, CLEAN_BARE)


def unescaped(text: str) -> str:
    """The entities that occur in the pages."""
    for entity, character in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{character}')"
    return text


PAGES = f"""
page_postings AS (
  SELECT page_id AS id, {unescaped("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS title,
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS company,
         upper(regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1)) AS lang_code,
         url AS metadata_application_link,
         company || ' ' || lang_code AS location
  FROM pages
)"""

PAGES_PLACED = f"""{PAGES},
page_places AS (
  SELECT *, CASE lang_code WHEN 'DE' THEN 'Germany' WHEN 'ES' THEN 'Spain' WHEN 'FR' THEN 'France'
              ELSE 'Not Defined' END AS country, 'Not Defined' AS city
  FROM page_postings
)"""


def page_text(html: str) -> str:
    inline = "|".join(
        "a abbr b bdi bdo cite code em font i kbd mark q s small span strong sub sup u var wbr".split()
    )
    for pattern, by in (
        (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " "),
        (r"(?is)<head\b.*?</head\s*>", " "),
        (rf"(?i)</?(?:{inline})(?:[\s/][^>]*)?/?>", ""),
        ("<[^>]*>", " "),
    ):
        html = f"regexp_replace({html}, '{pattern}', '{by}', 'g')"
    return squeezed(unescaped(html))


DESCRIPTIONS = f"""
descriptions AS (
  SELECT doc_id AS id, {squeezed("text")} AS job_description, lang, source FROM documents
)"""

NON_WORD, WORD = r"[^\p{L}\p{N}_]", r"[\p{L}\p{N}_]"

CHUNKS = rf"""{DESCRIPTIONS},
pieces(id, pos, chunk, rest) AS (
  SELECT id, -1, '', job_description FROM descriptions
  UNION ALL
  SELECT id, pos + 1, piece, substr(rest, length(piece) + 1)
  FROM (
    SELECT id, pos, rest,
           CASE WHEN following <> '' AND regexp_matches(ending, '{WORD}') <> regexp_matches(following, '{WORD}')
                  THEN head
                WHEN following <> '' AND regexp_matches(ending, '{WORD}')
                  THEN regexp_replace(head, '{WORD}+$', '')
                ELSE regexp_replace(head, '{NON_WORD}+$', '') END AS piece
    FROM (SELECT id, pos, rest, substr(rest, 1, 3000) AS head, substr(rest, 3001, 1) AS following,
                 right(substr(rest, 1, 3000), 1) AS ending FROM pieces WHERE rest <> '')
  )
  WHERE piece <> ''
)"""

SCORES = f"""{DESCRIPTIONS},
worded AS (
  SELECT id, lang, regexp_extract_all(lower(job_description), '\\p{{L}}+') AS words FROM descriptions
),
counted AS (
  SELECT id, lang, {", ".join(
      f"len(list_filter(words, lambda w: w IN ({quoted(markers)}))) AS {label}_n"
      for label, markers in LANGUAGE_MARKERS.items())}
  FROM worded
),
scored AS (
  SELECT id, lang, greatest(en_n, de_n, fr_n, es_n) AS score,
         CASE score WHEN en_n THEN 'en' WHEN de_n THEN 'de' WHEN fr_n THEN 'fr' ELSE 'es' END AS category
  FROM counted
)"""

PRF = """
  round(CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0 END, 6) AS f1"""


def spans(name: str, terms) -> str:
    """Hits of one word, unless a hit of two words covers them. No two hits of two words overlap."""
    singles = [t for t in terms if " " not in t]
    pairs = [t for t in terms if " " in t] or ["-"]
    return f"""
{name}_hits AS (
  SELECT id, start, word IN ({quoted(singles)}) AS one, coalesce(pair IN ({quoted(pairs)}), false) AS two,
         word, pair, coalesce(lag(pair) OVER (PARTITION BY id ORDER BY start) IN ({quoted(pairs)}), false) AS covered
  FROM (SELECT id, start, word, word || ' ' || lead(word) OVER (PARTITION BY id ORDER BY start) AS pair FROM places)
),
{name} AS (
  SELECT id, start, CASE WHEN two THEN 2 ELSE 1 END AS n_words, CASE WHEN two THEN pair ELSE word END AS term
  FROM {name}_hits WHERE two OR (one AND NOT covered)
)"""


def calendar(first: str, last: str) -> str:
    return f"""
  SELECT CAST(d AS DATE) AS date_iso_format_pk, CAST(d AS TIMESTAMP) AS date,
         CAST(year(d) AS INTEGER) AS num_year, CAST(month(d) AS INTEGER) AS num_month_in_year,
         CAST(day(d) AS INTEGER) AS num_day_in_month, CAST(isodow(d) AS INTEGER) AS num_day_in_week,
         strftime(d, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday_us,
         monthname(d) AS name_month_en, dayname(d) AS name_day_en
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"""


CALENDAR_OF_ORDERS = calendar(
    "(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)"
)
CALENDAR_OF_THE_REPORT = calendar(*[f"TIMESTAMP '{day}'" for day in CALENDAR_OF_REPORT])

RAW_COLUMNS = """id, title, company, location, employment_type, date_posted, job_description,
  metadata_lastupdated, metadata_application_link, metadata_source"""


def dim(key: str, label: str) -> str:
    return f"WITH {CLEAN_BARE} SELECT {key}_key AS {key}_pk, min({label}) AS {label} FROM clean GROUP BY ALL"


def snapshot(day: str) -> str:
    return f"""SELECT DATE '{day}' AS snap_date, count(*) AS open_ads FROM fact
               WHERE CAST(last_updated AS DATE) = DATE '{day}'"""


def null_count(table: str, source: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
               count(*) - count({column}) AS n_null, count(*) AS n_rows FROM {source}"""


def overflow(column: str, limit: int) -> str:
    return f"""SELECT 'clean_jobs' AS table_name, '{column}' AS column_name, {limit} AS max_allowed,
               count(*) FILTER (length({column}) > {limit}) AS n_over,
               CAST(max(length({column})) AS INTEGER) AS longest FROM clean"""


def pk_report(table: str, source: str, columns: str) -> str:
    shown = " || ' | ' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns.split(", "))
    has_null = " OR ".join(f"{c} IS NULL" for c in columns.split(", "))
    return f"""SELECT '{table}' AS table_name, {shown} AS key_text,
               CASE WHEN {has_null} THEN 'null key' ELSE 'duplicate key' END AS reason, count(*) AS n_rows
               FROM {source} GROUP BY {columns} HAVING count(*) > 1 OR {has_null}"""


def collisions(length: int) -> str:
    return f"""SELECT 'company' AS key_name, {length} AS key_len, left(md5(company), {length}) AS short_key,
               count(DISTINCT company) AS n_labels, min(company) AS first_label, max(company) AS last_label
               FROM postings GROUP BY short_key HAVING count(DISTINCT company) > 1"""


def orphans(fk: str, known: str) -> str:
    return f"""SELECT '{fk}' AS fk_name, CAST({fk} AS VARCHAR) AS fk_value, count(*) AS n_rows FROM fact
               WHERE {fk} IS NOT NULL AND {fk} NOT IN ({known}) GROUP BY ALL"""


ORACLE_SQL: dict[str, str] = {
    "scan_postings": f"WITH {POSTINGS} SELECT {RAW_COLUMNS} FROM postings",
    "extract_page_fields": f"WITH {PAGES} SELECT * FROM page_postings",
    "extract_page_text": f"""
        SELECT page_id, {page_text("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS description,
               {page_text("html")} AS page_text FROM pages""",
    "every_second_row": f"""WITH {PAGES} SELECT id, company, metadata_application_link FROM page_postings
        QUALIFY row_number() OVER (PARTITION BY company ORDER BY id) % 2 = 1""",
    "take_first_nonempty": """
        SELECT page_id AS id,
               coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''),
                        nullif(regexp_extract(url, '#(.*)$', 1), ''),
                        nullif(upper(regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1)), '')) AS first_value
        FROM pages""",
    "null_to_none": f"""WITH {PAGES}
        SELECT id, coalesce(title, 'None') AS title,
               CASE WHEN regexp_matches(metadata_application_link, '[?&]ref=[^&#]')
                    THEN regexp_extract(metadata_application_link, '[?&]ref=([^&#]*)', 1) ELSE 'None' END AS ref
        FROM page_postings""",
    "landing_reload": f"""WITH {PAGES}
        SELECT row_number() OVER (ORDER BY id) + (SELECT count(*) FROM pages) AS id, title, company, location,
               metadata_application_link FROM page_postings""",
    "landing_dedup_first_wins": f"""WITH {POSTINGS} SELECT {RAW_COLUMNS} FROM postings
        QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY id) = 1""",
    "insert_if_absent": f"""WITH {POSTINGS}
        SELECT {RAW_COLUMNS} FROM postings p
        WHERE id % 2 = 1 AND NOT EXISTS (
          SELECT 1 FROM postings s WHERE s.id % 2 = 0 AND s.title = p.title AND s.company = p.company
                                     AND s.location = p.location)
        QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY id) = 1""",
    "incremental_index": f"""WITH {POSTINGS}
        SELECT id, title, company, row_number() OVER (ORDER BY id) AS row_index FROM postings""",
    "surrogate_keys": f"""WITH {CLEAN_BARE}
        SELECT id, left(role_key, 3) AS role_key, left(company_key, 5) AS company_key,
               left(location_key, 5) AS location_key, left(employment_type_key, 3) AS employment_type_key
        FROM clean""",
    "squeeze_whitespace": f"SELECT doc_id, {squeezed('text')} AS squeezed FROM documents",
    "fold_accents": "SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS folded FROM documents",
    "parse_posted_date": f"""
        WITH posted AS (
          SELECT event_id, event_type, ts, props, CAST(trunc(value) AS INTEGER) % 40 AS k,
                 CAST(TIMESTAMP '{POSTED_ANCHOR}' AS DATE) AS today FROM events)
        SELECT event_id,
               'Posted ' || CASE event_type WHEN 'click' THEN k || ' days ago' WHEN 'view' THEN k || ' weeks ago'
                 WHEN 'signup' THEN k || ' months ago' WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d')
                 ELSE props END AS posted,
               CASE event_type WHEN 'click' THEN today - k WHEN 'view' THEN today - 7 * k
                 WHEN 'signup' THEN CAST(today - to_months(k) AS DATE) WHEN 'purchase' THEN CAST(ts AS DATE)
                 ELSE DATE '9999-12-30' END AS date_posted
        FROM posted""",
    "posted_date_by_language": f"""
        WITH posted AS (
          SELECT event_id, event_type, ts, props, CAST(trunc(value) AS INTEGER) % 40 AS k,
                 CAST(TIMESTAMP '{POSTED_ANCHOR}' AS DATE) AS today FROM events)
        SELECT event_id,
               CASE event_type WHEN 'click' THEN 'Veröffentlicht vor ' || k || ' Tagen'
                 WHEN 'view' THEN 'Publié il y a ' || k || ' semaines et 1 jour'
                 WHEN 'signup' THEN 'Publicado hace ' || k || ' meses'
                 WHEN 'purchase' THEN 'Publié le ' || day(ts) || ' ' || (['janvier', 'février', 'mars', 'avril', 'mai',
                   'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'])[month(ts)] || ' ' || year(ts)
                 ELSE 'Publicado ' || props END AS posted,
               CASE event_type WHEN 'click' THEN today - k WHEN 'view' THEN today - 7 * k - 1
                 WHEN 'signup' THEN CAST(today - to_months(k) AS DATE) WHEN 'purchase' THEN CAST(ts AS DATE)
                 ELSE DATE '9999-12-30' END AS date_posted
        FROM posted""",
    "truncate_minute": "SELECT event_id, date_trunc('minute', ts) AS minute FROM events",
    "chunk_text": f"""WITH RECURSIVE {CHUNKS}
        SELECT id, CAST(pos AS INTEGER) AS pos, chunk FROM pieces WHERE pos >= 0""",
    "rejoin_chunks": f"""WITH {DESCRIPTIONS}
        SELECT id, regexp_replace(job_description, '{NON_WORD}+$', '') AS text FROM descriptions
        WHERE regexp_matches(job_description, '{WORD}')""",
    "argmax_category": f"WITH {SCORES} SELECT id, category, score FROM scored",
    "role_from_title": f"WITH {CLEAN_BARE} SELECT id, title, role FROM clean",
    "list_of_tools": f"""WITH {DESCRIPTIONS}
        SELECT id, array_to_string({tools("job_description")}, ', ') AS toolset_list FROM descriptions""",
    "geo_attributes": f"""WITH {POSTINGS}, {PAGES_PLACED}
        SELECT 'orders' AS origin, id, location, r_name AS country, n_name AS city FROM postings
        UNION ALL SELECT 'pages', id, location, country, city FROM page_places""",
    "clean_postings": f"WITH {CLEAN} SELECT * FROM clean",
    "date_dim": CALENDAR_OF_ORDERS,
    "role_dim": dim("role", "role"),
    "employment_type_dim": dim("employment_type", "employment_type"),
    "company_dim": dim("company", "company"),
    "location_dim": f"""WITH {CLEAN_BARE}
        SELECT location_key AS location_pk, country, city FROM clean
        QUALIFY row_number() OVER (PARTITION BY location_key ORDER BY country, city) = 1""",
    "fact_load": f"WITH {FACT} SELECT * FROM fact",
    "scd1_upsert": f"""WITH {CANDIDATES_BARE}
        SELECT {FACT_KEYS}, toolset_list, days_opened, last_updated FROM candidates
        QUALIFY row_number() OVER (PARTITION BY {FACT_KEYS} ORDER BY id % 2 DESC, last_updated DESC, id DESC) = 1""",
    "lookup_update": f"WITH {CLEAN_BARE} SELECT id, role, role_key FROM clean",
    "daily_snapshot": f"""WITH {FACT_BARE}
        {snapshot(SNAPSHOT_DAY)} UNION ALL {snapshot(SNAPSHOT_DAY_WITHOUT_ADS)}""",
    "snapshot_history": f"""WITH {FACT_BARE}
        SELECT CAST(last_updated AS DATE) AS snap_date, count(*) AS open_ads FROM fact GROUP BY ALL""",
    "days_opened": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date_posted, max(l_shipdate) AS last_updated,
               CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(max(l_shipdate) AS DATE)) AS INTEGER) AS days_opened
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate""",
    "star_rollup": f"""WITH {FACT_BARE}
        SELECT role, country, num_year, num_month_in_year, name_month_en,
               count(*) AS n_ads, count(DISTINCT company_fk) AS n_companies
        FROM fact
        JOIN ({CALENDAR_OF_ORDERS}) ON date_posted_fk = date_iso_format_pk
        JOIN (SELECT DISTINCT role_key, role FROM clean) ON role_fk = role_key
        JOIN (SELECT DISTINCT location_key, country FROM clean) ON location_fk = location_key
        GROUP BY ALL""",
    "trend_by_role_month": f"""WITH {CLEAN_BARE}
        SELECT grain, CAST(date_trunc(grain, date_posted) AS DATE) AS period_start, role, count(*) AS n_ads
        FROM clean, (VALUES ('day'), ('week'), ('month')) AS g(grain) GROUP BY ALL""",
    "top_skills_per_role": f"""WITH {CLEAN},
        named AS (SELECT role, unnest({tools("job_description")}) AS spelled FROM clean),
        spellings AS (SELECT lower(spelled) AS folded, min(encode(spelled)) AS skill FROM named GROUP BY ALL),
        counted AS (
          SELECT role, decode(skill) AS skill, count(*) AS n_mentions
          FROM named JOIN spellings ON lower(spelled) = folded GROUP BY ALL)
        SELECT role, skill, n_mentions,
               CAST(row_number() OVER (PARTITION BY role ORDER BY n_mentions DESC, skill) AS INTEGER) AS place
        FROM counted QUALIFY place <= 5""",
    "postings_by_location": f"""WITH {CLEAN_BARE}
        SELECT country, city, CAST(2 - grouping(city) - grouping(country) AS INTEGER) AS level, count(*) AS n_ads
        FROM clean GROUP BY ROLLUP (country, city)""",
    "top_hiring_companies": f"""WITH {POSTINGS}
        SELECT company, count(*) AS n_ads, max(metadata_lastupdated) AS last_seen FROM postings
        GROUP BY company ORDER BY n_ads DESC, company LIMIT 20""",
    "dq_pk_violations": f"""WITH {CANDIDATES_BARE}
        {pk_report("raw_jobs", "postings", "title, company, location")}
        UNION ALL {pk_report("fact_less_table", "candidates", FACT_KEYS)}""",
    "dq_unique_label": f"""WITH {CLEAN_BARE}, {PAGES_PLACED}
        SELECT 'company_dim' AS table_name, company AS label, count(DISTINCT company_key) AS n_keys
        FROM clean GROUP BY company HAVING count(DISTINCT company_key) > 1
        UNION ALL
        SELECT 'location_dim', country || ' | ' || city, count(DISTINCT md5(location))
        FROM page_places GROUP BY country, city HAVING count(DISTINCT md5(location)) > 1""",
    "dq_fk_orphans": f"""WITH {FACT_BARE}
        {orphans("date_posted_fk", f"SELECT date_iso_format_pk FROM ({CALENDAR_OF_THE_REPORT})")}
        UNION ALL {orphans("company_fk", f"SELECT company_key FROM clean WHERE date_posted <= DATE '{DIMENSION_LOADED_UNTIL}'")}
        UNION ALL {orphans("role_fk", "SELECT role_key FROM clean")}
        UNION ALL {orphans("employment_type_fk", "SELECT employment_type_key FROM clean")}
        UNION ALL {orphans("location_fk", "SELECT location_key FROM clean")}""",
    "dq_varchar_overflow": f"WITH {CLEAN} "
    + " UNION ALL ".join(overflow(c, n) for c, n in CLEAN_JOBS.limits.items()),
    "dq_not_null": f"WITH {CLEAN}, calendar AS ({CALENDAR_OF_ORDERS}) "
    + " UNION ALL ".join(
        [null_count("clean_jobs", "clean", c) for c in CLEAN_JOBS.column_names]
        + [
            null_count("date_dim", "calendar", c)
            for c in ("num_day_in_month", "num_day_in_week", "is_holiday_us", "name_month_en", "name_day_en")
        ]
    ),
    "dq_key_collisions": f"WITH {POSTINGS} {collisions(5)} UNION ALL {collisions(3)}",
    "dq_date_coverage": f"""WITH {FACT_BARE}
        SELECT date_posted_fk, count(*) AS n_rows FROM fact
        WHERE date_posted_fk NOT BETWEEN DATE '{CALENDAR_OF_REPORT[0]}' AND DATE '{CALENDAR_OF_REPORT[1]}'
        GROUP BY ALL""",
    "hash_split": """
        SELECT doc_id, lang, CAST(CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8) AS BIGINT) % 5 AS INTEGER) AS bucket,
               CASE bucket WHEN 0 THEN 'dev' ELSE 'train' END AS split FROM documents""",
    "eval_macro_f1": f"""WITH {SCORES},
        labelled AS (
          SELECT label, count(*) FILTER (lang = label AND category = label) AS tp,
                 count(*) FILTER (lang <> label AND category = label) AS fp,
                 count(*) FILTER (lang = label AND category <> label) AS fn
          FROM scored, (VALUES {", ".join(f"('{x}')" for x in LANGUAGE_MARKERS)}) AS l(label) GROUP BY label),
        scores AS (SELECT *, {PRF} FROM labelled)
        SELECT * FROM scores
        UNION ALL SELECT 'macro', CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT),
                         round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM scores""",
    "tagger_agreement": rf"""WITH {DESCRIPTIONS},
        worded AS (SELECT id, regexp_extract_all(lower(job_description), '[\p{{L}}\p{{N}}_+#]+') AS words FROM descriptions),
        places AS (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS start FROM worded),
        {spans("gold", PROSE_TOOLS)}, {spans("predicted", PROSE_TOOLS)},
        marked AS (
          SELECT coalesce(g.term, p.term) AS term, g.id IS NOT NULL AS in_gold, p.id IS NOT NULL AS in_predicted
          FROM gold g FULL JOIN predicted p
          ON g.id = p.id AND g.start = p.start AND g.n_words = p.n_words AND g.term = p.term),
        counted AS (
          SELECT CASE WHEN grouping(term) = 1 THEN 'ALL' ELSE term END AS term,
                 count(*) FILTER (in_gold AND in_predicted) AS tp, count(*) FILTER (NOT in_gold) AS fp,
                 count(*) FILTER (NOT in_predicted) AS fn
          FROM marked GROUP BY ROLLUP (marked.term))
        SELECT *, {PRF} FROM counted""",
    "train_text_classifier": rf"""WITH {DESCRIPTIONS},
        worded AS (
          SELECT id, lang, regexp_extract_all(lower(job_description), '[\p{{L}}\p{{N}}_]+') AS words,
                 CAST('0x' || left(md5(CAST(id AS VARCHAR)), 8) AS BIGINT) % 5 = 0 AS dev FROM descriptions),
        train AS (SELECT lang AS label, unnest(words) AS word FROM worded WHERE NOT dev),
        counts AS (SELECT label, word, ln(count(*) + 1) AS weight FROM train GROUP BY ALL),
        documents AS (
          SELECT lang AS label, ln((count(*) + 1) / (sum(count(*)) OVER () + count(*) OVER ())) AS prior
          FROM worded WHERE NOT dev GROUP BY lang),
        labels AS (
          SELECT d.label, prior, ln(count(word) + (SELECT count(DISTINCT word) FROM train)) AS cost
          FROM documents d LEFT JOIN train t ON d.label = t.label GROUP BY ALL),
        known AS (
          SELECT id, word, count(*) AS n FROM (SELECT id, unnest(words) AS word FROM worded WHERE dev)
          WHERE word IN (SELECT word FROM train) GROUP BY ALL),
        sums AS (SELECT id, label, sum(n * weight) AS weight FROM known JOIN counts USING (word) GROUP BY ALL),
        sizes AS (SELECT id, sum(n) AS n FROM known GROUP BY id)
        SELECT id, lang, label AS predicted
        FROM worded CROSS JOIN labels LEFT JOIN sums USING (id, label) LEFT JOIN sizes USING (id)
        WHERE dev
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY
          round(prior - coalesce(sizes.n, 0) * cost + coalesce(sums.weight, 0), 6) DESC, label) = 1""",
    "landing_raw_jobs": f"""
        WITH articles AS (
          SELECT page_id, url, split_part(split_part(html, '<article>', 2), '</article>', 1) AS article FROM pages),
        parts AS (
          SELECT *, split_part(split_part(article, '<h1>', 2), '<', 1) AS heading,
                 CASE WHEN contains(article, '<a ')
                      THEN split_part(substr(split_part(article, '<a ', 2), strpos(split_part(article, '<a ', 2), '>') + 1), '<', 1)
                      ELSE '' END AS link,
                 coalesce(split_part(list_filter(string_split(article, '<p>')[2:], lambda p: p <> '' AND p[1] <> '<')[1], '<', 1), '') AS lead
          FROM articles),
        named AS (
          SELECT page_id, url, {", ".join(
              f"coalesce(nullif({squeezed(unescaped(part))}, ''), 'None') AS {name}"
              for part, name in (("heading", "title"), ("link", "company"), ("lead", "location")))},
                 coalesce(nullif({page_text("article")}, ''), 'None') AS job_description
          FROM parts)
        SELECT row_number() OVER (ORDER BY page_id) AS id, title, company, location, 'None' AS employment_type,
               DATE '9999-12-30' AS date_posted, job_description,
               date_trunc('minute', TIMESTAMP '{POSTED_ANCHOR}') AS metadata_lastupdated,
               url AS metadata_application_link, 'pages' AS metadata_source
        FROM (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY page_id) = 1)""",
    "stream_landing_dedup": f"""WITH {POSTINGS} SELECT {RAW_COLUMNS} FROM postings
        QUALIFY row_number() OVER (PARTITION BY title, company, location ORDER BY id) = 1""",
    "stream_scd1_upsert": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_daily_count": """
        SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY ALL""",
}


def learnt(terms) -> str:
    """Tags learnt from the documents outside bucket 0 and the best tags of those inside it."""
    singles, pairs = [t for t in terms if " " not in t], [t for t in terms if " " in t]
    steps = ", ".join(
        f"max(w) FILTER (before = '{b}' AND tag = '{t}') AS {b.lower()}{t.lower()}" for b in "SOBI" for t in "OBI"
    )
    step = lambda t: f"greatest(p.o + o{t}, p.b + b{t}, p.i + i{t}) + n.e{t}"
    way = lambda t: (
        f"CASE WHEN p.o + o{t} >= p.b + b{t} AND p.o + o{t} >= p.i + i{t} THEN p.po"
        f" WHEN p.b + b{t} >= p.i + i{t} THEN p.pb ELSE p.pi END || '{t.upper()}'"
    )
    start = lambda t: f"CASE WHEN n.first THEN s{t} ELSE o{t} END + n.e{t}"
    return rf"""{DESCRIPTIONS},
cut AS (
  SELECT id, regexp_extract_all(job_description, '[\p{{L}}\p{{N}}_+#]+[^\s\p{{L}}\p{{N}}_+#]*') AS raw,
         CAST('0x' || left(md5(CAST(id AS VARCHAR)), 8) AS BIGINT) % 5 = 0 AS dev FROM descriptions),
tokens AS (
  SELECT id, dev, pos, raw[pos + 1] AS sign, regexp_extract(raw[pos + 1], '^[\p{{L}}\p{{N}}_+#]+') AS named,
         pos = 0 OR regexp_matches(raw[pos], '[.!?]') AS first
  FROM (SELECT *, unnest(range(len(raw))) AS pos FROM cut)),
gold_places AS (
  SELECT *, named IN ({quoted(singles)}) AS one,
         coalesce(sign || ' ' || lead(named) OVER (PARTITION BY id ORDER BY pos) IN ({quoted(pairs)}), false) AS two,
         named || ' ' || lead(named) OVER (PARTITION BY id ORDER BY pos) AS pair FROM tokens),
gold AS (
  SELECT id, dev, pos AS start, CASE WHEN two THEN 2 ELSE 1 END AS n_words,
         lower(CASE WHEN two THEN pair ELSE named END) AS term
  FROM gold_places WHERE two OR one),
gold_words AS (
  SELECT id, start + k AS pos, string_split(term, ' ')[k + 1] AS word, CASE k WHEN 0 THEN 'B' ELSE 'I' END AS tag
  FROM (SELECT *, unnest(range(n_words)) AS k FROM gold WHERE NOT dev)),
entity AS (SELECT DISTINCT word FROM gold_words),
seen AS (
  SELECT t.id, dev, pos, lower(named) AS word, first, coalesce(tag, 'O') AS tag,
         coalesce(NOT lead(first) OVER (PARTITION BY t.id ORDER BY pos), false) AS goes_on,
         lower(named) IN (SELECT word FROM entity) AS hit
  FROM tokens t LEFT JOIN gold_words g USING (id, pos)),
moves AS (
  SELECT CASE WHEN first THEN 'S' ELSE lag(tag) OVER (PARTITION BY id ORDER BY pos) END AS before, tag FROM seen WHERE NOT dev),
grid AS (SELECT * FROM (VALUES ('S'), ('O'), ('B'), ('I')) a(before), (VALUES ('O'), ('B'), ('I')) b(tag)),
moved AS (SELECT before, tag, count(m.tag) AS n FROM grid LEFT JOIN moves m USING (before, tag) GROUP BY ALL),
model AS (SELECT {steps} FROM (SELECT *, ln((n + 1) / (sum(n) OVER (PARTITION BY before) + 3)) AS w FROM moved)),
sizes AS (
  SELECT count(*) FILTER (tag = 'O') AS n_o, count(*) FILTER (tag = 'B') AS n_b, count(*) FILTER (tag = 'I') AS n_i,
         (SELECT count(*) FROM entity) AS n FROM seen WHERE NOT dev),
emissions AS (
  SELECT word, ln((count(*) FILTER (tag = 'O') + 1) / (any_value(n_o) + any_value(n) + 1)) AS eo,
         ln((count(*) FILTER (tag = 'B') + 1) / (any_value(n_b) + any_value(n) + 1)) AS eb,
         ln((count(*) FILTER (tag = 'I') + 1) / (any_value(n_i) + any_value(n) + 1)) AS ei
  FROM seen, sizes WHERE NOT dev AND hit GROUP BY word),
places_seen AS (
  SELECT *, first OR lag(pos) OVER (PARTITION BY id ORDER BY pos) IS DISTINCT FROM pos - 1 AS begins
  FROM seen JOIN emissions USING (word) WHERE dev),
parts AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pos) AS part FROM places_seen),
numbered AS (
  SELECT *, row_number() OVER p AS k, lead(pos) OVER p IS NULL AS final FROM parts
  WINDOW p AS (PARTITION BY id, part ORDER BY pos)),
ways AS (
  SELECT id, part, k, {", ".join(f"{start(t)} AS {t}, '{t.upper()}' AS p{t}" for t in "obi")}
  FROM numbered n, model WHERE k = 1
  UNION ALL
  SELECT n.id, n.part, n.k, {", ".join(f"{step(t)}, {way(t)}" for t in "obi")}
  FROM ways p JOIN numbered n ON n.id = p.id AND n.part = p.part AND n.k = p.k + 1, model),
closed AS (
  SELECT w.*, o + CASE WHEN goes_on THEN oo ELSE 0 END AS fo, b + CASE WHEN goes_on THEN bo ELSE 0 END AS fb,
         i + CASE WHEN goes_on THEN io ELSE 0 END AS fi
  FROM ways w JOIN numbered n USING (id, part, k), model WHERE final),
tagged AS (
  SELECT id, part, CASE WHEN fo >= fb AND fo >= fi THEN po WHEN fb >= fi THEN pb ELSE pi END AS tags FROM closed),
stretches AS (SELECT id, part, min(pos) AS pos, list(word ORDER BY pos) AS words FROM numbered GROUP BY ALL),
predicted AS (
  SELECT id, CAST(pos + j - 1 AS INTEGER) AS start, CAST(len(regexp_extract(tags[j + 1:], '^I*')) + 1 AS INTEGER) AS n_words,
         array_to_string(words[j : j + len(regexp_extract(tags[j + 1:], '^I*'))], ' ') AS term
  FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS j FROM tagged JOIN stretches USING (id, part))
  WHERE tags[j] = 'B' OR (tags[j] = 'I' AND (j = 1 OR tags[j - 1] = 'O')))"""


ORACLE_SQL |= {
    "learned_entities": f"WITH RECURSIVE {learnt(NAMED_TOOLS)} SELECT id, start, n_words, term FROM predicted",
    "eval_entity_prf": f"""WITH RECURSIVE {learnt(NAMED_TOOLS)},
        marked AS (
          SELECT coalesce(g.term, p.term) AS term, g.id IS NOT NULL AS in_gold, p.id IS NOT NULL AS in_predicted
          FROM (SELECT * FROM gold WHERE dev) g FULL JOIN predicted p
          ON g.id = p.id AND g.start = p.start AND g.n_words = p.n_words AND g.term = p.term),
        counted AS (
          SELECT CASE WHEN grouping(term) = 1 THEN 'ALL' ELSE term END AS term,
                 count(*) FILTER (in_gold AND in_predicted) AS tp, count(*) FILTER (NOT in_gold) AS fp,
                 count(*) FILTER (NOT in_predicted) AS fn
          FROM marked GROUP BY ROLLUP (marked.term))
        SELECT *, {PRF} FROM counted""",
    "training_batches": rf"""WITH {DESCRIPTIONS},
        sized AS (
          SELECT id, CAST(len(regexp_extract_all(job_description, '[\p{{L}}\p{{N}}_]+')) AS BIGINT) AS n_words,
                 md5('0:0:' || CAST(id AS VARCHAR)) AS key FROM descriptions),
        placed AS (
          SELECT id, n_words, CAST(coalesce(sum(n_words) OVER (
            ORDER BY key, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS words_before FROM sized),
        growth AS (SELECT ceil(ln(10.0) / ln(1.001)) AS steps, 100 * (pow(1.001, steps) - 1) / 0.001 AS grown)
        SELECT id, n_words, words_before, CAST(CASE
                 WHEN words_before < grown THEN floor(ln(1 + words_before * 0.001 / 100) / ln(1.001) + 1e-9)
                 ELSE steps + floor((words_before - grown) / 1000 + 1e-9) END AS BIGINT) AS batch
        FROM placed, growth""",
}
ORACLE_SQL["versioned_reload"] = ORACLE_SQL["landing_reload"]
ORACLE_SQL["incremental_snapshots"] = ORACLE_SQL["snapshot_history"]
ORACLE_SQL["versioned_upsert"] = ORACLE_SQL["scd1_upsert"]
ORACLE_SQL["stream_change_capture"] = """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1 AND event_id % 10 <> 3"""
UNKNOWN_KEYS = {
    "date_posted_fk": f"SELECT date_iso_format_pk FROM ({CALENDAR_OF_THE_REPORT})",
    "role_fk": "SELECT role_key FROM clean WHERE role_key IS NOT NULL",
    "company_fk": f"SELECT company_key FROM clean WHERE company_key IS NOT NULL AND date_posted <= DATE '{DIMENSION_LOADED_UNTIL}'",
    "employment_type_fk": "SELECT employment_type_key FROM clean WHERE employment_type_key IS NOT NULL",
    "location_fk": "SELECT location_key FROM clean WHERE location_key IS NOT NULL",
}
ORACLE_SQL["enforced_fact_load"] = f"""WITH {CANDIDATES_BARE},
    reasoned AS (
      SELECT [{", ".join(f"CASE WHEN {fk} IS NULL THEN 'null key: {fk}' END" for fk in UNKNOWN_KEYS)},
              {", ".join(f"CASE WHEN {fk} NOT IN ({keys}) THEN 'no such key: {fk}' END" for fk, keys in UNKNOWN_KEYS.items())},
              CASE WHEN {" AND ".join(f"{fk} IS NOT NULL" for fk in UNKNOWN_KEYS)}
                    AND row_number() OVER (PARTITION BY {FACT_KEYS} ORDER BY last_updated DESC, id DESC) > 1
                   THEN 'duplicate key' END] AS reasons FROM candidates),
    listed AS (SELECT list_filter(reasons, lambda r: r IS NOT NULL) AS reasons FROM reasoned)
    SELECT reason, count(*) AS n_rows FROM (SELECT unnest(reasons) AS reason FROM listed) GROUP BY reason
    UNION ALL SELECT 'incoming', count(*) FROM listed
    UNION ALL SELECT 'accepted', count(*) FROM listed WHERE len(reasons) = 0"""
ORACLE_SQL["eval_training_score"] = f"""
    SELECT CAST(CAST(0.5 * e.f1 AS DECIMAL(18,7)) + CAST(0.5 * m.f1 AS DECIMAL(18,7)) AS DECIMAL(18,7)) AS score
    FROM ({ORACLE_SQL["eval_entity_prf"]}) e, ({ORACLE_SQL["eval_macro_f1"]}) m
    WHERE e.term = 'ALL' AND m.label = 'macro'"""
