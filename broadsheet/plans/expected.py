"""What the registered queries must return, as SQL for another engine.

The SQL works on the numbers and dates that the articles were spelled from and
parses none of their texts, so it checks the cleaning independently.  The match
of each spelled company name is worked out here with the standard library.
"""

from __future__ import annotations

from difflib import get_close_matches

from broadsheet.functions.categories import CATEGORY_MAP
from broadsheet.plans.order_articles import COMPANY_NAMES, NAME_FORMS, RAW_CATEGORIES, YEARS_AHEAD, spelled_name
from broadsheet.plans.queries import FLAT_EXPORT, QUERY_ID, QUERY_TEXT
from broadsheet.schema import OUTPUT_COLUMNS
from broadsheet.sources.companies import COMPANIES


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _match(name: str) -> tuple[str | None, str | None]:
    if name in COMPANY_NAMES:
        return name, "exact"
    folded = {k.lower(): k for k in COMPANY_NAMES}
    if name.lower() in folded:
        return folded[name.lower()], "ignoring case"
    close = get_close_matches(name, COMPANY_NAMES, n=1, cutoff=0.75)
    return (close[0], "similar") if close else (None, None)


def _name_rows() -> str:
    rows = []
    for i in range(len(COMPANY_NAMES)):
        for form in range(NAME_FORMS):
            name = spelled_name(i, form)
            key, kind = _match(name)
            rows.append(f"({i}, {form}, {_text(name)}, {_text(key)}, {_text(kind)})")
    return ", ".join(rows)


def _company_rows() -> str:
    return ", ".join(
        f"({_text(key)}, {founded}, {_text(place)}, {staff}, {_text(industry)}, {str(public).upper()}, {_text(ticker)})"
        for key, founded, place, staff, industry, public, ticker in COMPANIES
    )


_LABELS = ", ".join(_text(CATEGORY_MAP.get(c, "Unknown")) for c in RAW_CATEGORIES)
_RAW = ", ".join(_text(c) for c in RAW_CATEGORIES)

_BASE = f"""
names(ci, form, name, company_key, match_kind) AS (VALUES {_name_rows()}),
companies(company_key, founded_year, headquarters, employee_count, industry, is_public, stock_ticker)
    AS (VALUES {_company_rows()}),
base AS (
    SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS n, o_custkey, o_orderpriority,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL {YEARS_AHEAD} YEAR AS DATE) AS d,
           CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_orderkey // 3) % {len(COMPANY_NAMES)} END AS INTEGER) AS ci,
           CAST((o_orderkey // 63) % {NAME_FORMS} AS INTEGER) AS form,
           o_orderkey % 10 AS rv, (o_orderkey // 10) % 9 AS dv
    FROM orders),
amounts AS (
    SELECT *, CAST(n AS DOUBLE) AS x,
           CASE WHEN dv = 7 AND k % 4 = 0 THEN NULL
                WHEN dv = 3 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d))
                ELSE d END AS pd
    FROM base),
truth AS (
    SELECT a.k, a.n, a.o_custkey, a.o_orderpriority, nm.name AS company_name, nm.company_key, a.pd,
           CASE WHEN k % 97 = 0 THEN 'ART ' || k || '!!' ELSE 'ART' || k END AS article_id,
           CASE WHEN k % 89 = 0 THEN '   ' ELSE 'Market "brief" ' || k END AS title,
           CASE WHEN k % 71 = 0 THEN '' ELSE 'Deal, priority' || chr(10) || o_orderpriority END AS summary,
           CASE WHEN k % 83 = 0 THEN 'ftp' ELSE 'https' END || '://news.example.com/a/' || k AS url,
           CASE WHEN k % 79 = 0 THEN NULL WHEN k % 5 = 0 THEN '' ELSE 'Writer ' || (o_custkey % 100) END AS author,
           CAST(k % 900 + 100 AS VARCHAR) AS word_count,
           coalesce(strftime(pd, '%Y-%m-%d'), 'N/A') AS published_date,
           CAST(year(pd) AS INTEGER) AS pub_year, CAST(quarter(pd) AS INTEGER) AS pub_quarter,
           CAST(month(pd) AS INTEGER) AS pub_month,
           [{_LABELS}][(k // 5) % {len(RAW_CATEGORIES)} + 1] AS category,
           CAST(round_even(CASE rv
               WHEN 0 THEN x
               WHEN 1 THEN x * 1.27::DOUBLE
               WHEN 2 THEN (x * 1000) * 1.10::DOUBLE
               WHEN 3 THEN x * 1000
               WHEN 4 THEN (x * 100) * (1::DOUBLE / 150)
               WHEN 5 THEN (x * 1000 + (x + 10) * 1000) / 2
               WHEN 6 THEN ((x + 0.5) * 1000000) * 1.10::DOUBLE
               WHEN 7 THEN 0
               WHEN 8 THEN (x + x + 3) / 2
               ELSE (x * 1000000) * 1.27::DOUBLE END, 0) AS BIGINT) AS revenue_usd,
           k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0 OR k % 79 = 0 OR k % 71 = 0 AS bad_raw,
           pd IS NULL AS bad_date
    FROM amounts a JOIN names nm ON nm.ci = a.ci AND nm.form = a.form),
enriched AS (
    SELECT t.*, c.company_key IS NOT NULL AS metadata_matched,
           CAST(c.founded_year AS INTEGER) AS meta_founded_year, c.headquarters AS meta_headquarters,
           CAST(c.employee_count AS INTEGER) AS meta_employee_count, c.industry AS meta_industry,
           c.is_public AS meta_is_public, c.stock_ticker AS meta_stock_ticker,
           CAST(CASE WHEN t.pub_year >= c.founded_year THEN t.pub_year - c.founded_year END AS INTEGER) AS company_age,
           CASE WHEN c.employee_count IS NULL THEN 'Unknown' WHEN c.employee_count < 10000 THEN 'Small'
                WHEN c.employee_count <= 30000 THEN 'Medium' ELSE 'Large' END AS company_size_category
    FROM truth t LEFT JOIN companies c USING (company_key)
    WHERE NOT bad_raw AND NOT bad_date),
vectors AS (SELECT 'ART' || vec_id AS article_id, CAST(embedding AS DOUBLE[]) AS e, embedding, label FROM embeddings)
"""

_RELEVANT = "(category IN ('AI_ML', 'Data_Analytics') OR coalesce(meta_industry IN ('AI/ML', 'Data Analytics'), FALSE))"
_EXPORTED = "(category = 'AI_ML' OR meta_industry = 'AI/ML') AND pub_year BETWEEN 2022 AND 2024 AND revenue_usd >= 50000000"
_COS = "list_cosine_similarity({a}, {b})"


def _with(query: str) -> str:
    return f"WITH {_BASE} {query}"


def _columns(prefix: str = "") -> str:
    return ", ".join(prefix + c for c in OUTPUT_COLUMNS)


def _ranked(rows: str, queries: str) -> str:
    """Pairs of two tables with the rank of the target for the query."""
    return f"""
    SELECT q.article_id, t.article_id AS neighbour, {_COS.format(a='q.e', b='t.e')} AS score,
           row_number() OVER (PARTITION BY q.article_id
               ORDER BY {_COS.format(a='q.e', b='t.e')} DESC, t.article_id) AS rank
    FROM {queries} q JOIN {rows} t ON q.article_id <> t.article_id"""


def _nearest(where: str, k: int, columns: str = "", rows: str = "vectors") -> str:
    return f"""
    SELECT t.article_id, round({_COS.format(a='t.e', b='q.e')}, 6) AS score {columns}
    FROM {rows} t, (SELECT e FROM {rows} WHERE article_id = '{QUERY_ID}') q
    WHERE {where} ORDER BY {_COS.format(a='t.e', b='q.e')} DESC, t.article_id LIMIT {k}"""


_FLAT = {
    "industry": "meta_industry",
    "founded_year": "meta_founded_year",
    "headquarters": "meta_headquarters",
    "employee_count": "meta_employee_count",
    "is_public": "meta_is_public",
    "stock_ticker": "meta_stock_ticker",
}
_FLAT_SQL = ", ".join(f"s.{_FLAT.get(c, c)} AS {c}" for c in FLAT_EXPORT)

_FAULTS = """
    SELECT article_id, 'raw' AS stage, 'article_id' AS field, 'unexpected characters' AS rule FROM truth WHERE k % 97 = 0
    UNION ALL SELECT article_id, 'raw', 'title', 'empty' FROM truth WHERE k % 89 = 0
    UNION ALL SELECT article_id, 'raw', 'url', 'no http scheme' FROM truth WHERE k % 83 = 0
    UNION ALL SELECT article_id, 'raw', 'author', 'missing' FROM truth WHERE k % 79 = 0
    UNION ALL SELECT article_id, 'raw', 'summary', 'empty' FROM truth WHERE k % 71 = 0
    UNION ALL SELECT article_id, 'clean', 'published_date', 'not an ISO date' FROM truth WHERE NOT bad_raw AND bad_date
"""

_WORDS = r"list_filter(string_split_regex(lower(t), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"


def _embedded(source: str, extra: str = "") -> str:
    """Tables ``space`` of (article_id, e) for the texts t of ``source``; ``extra`` is a text that is not counted."""
    texts = f"SELECT article_id, t, true AS counted FROM ({source})"
    if extra:
        texts += f" UNION ALL SELECT 'QUERY', {_text(extra)}, false"
    return f"""
    texts AS ({texts}),
    places AS (SELECT article_id, counted, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 384 AS p
               FROM (SELECT article_id, counted, unnest({_WORDS}) AS w FROM texts)),
    grid AS (SELECT p, ln(((SELECT count(*) FROM texts WHERE counted) + 1.0) / (coalesce(n, 0) + 1.0)) AS idf
             FROM (SELECT unnest(range(384)) AS p)
             LEFT JOIN (SELECT p, count(DISTINCT article_id) AS n FROM places WHERE counted GROUP BY p) USING (p)),
    weighted AS (SELECT article_id, p, count(*) * any_value(idf) AS x FROM places JOIN grid USING (p) GROUP BY article_id, p),
    norms AS (SELECT article_id, sqrt(sum(x * x)) AS norm FROM weighted GROUP BY article_id),
    space AS (SELECT texts.article_id, list(CAST(CASE WHEN norm > 0 THEN coalesce(x, 0) / norm ELSE 0 END AS DOUBLE) ORDER BY p) AS e
              FROM texts CROSS JOIN grid LEFT JOIN weighted USING (article_id, p) LEFT JOIN norms USING (article_id) GROUP BY texts.article_id)"""


def _cosine(a: str, b: str) -> str:
    """Cosine of unit vectors as ranked: rounded to twelve decimals."""
    return f"round(list_dot_product({a}, {b}), 12)"


_FOLD = "round(list_dot_product({e}, list_transform(range(1, 385), lambda i: CAST(i AS DOUBLE))), 4)"
_DOC_TEXTS = "SELECT 'DOC' || doc_id AS article_id, coalesce(source, '') || '. ' || coalesce(text, '') AS t FROM documents"
_NEWS_TEXTS = "SELECT article_id, coalesce(title, '') || '. ' || coalesce(summary, '') AS t FROM enriched"


def _top3(queries: str) -> str:
    return f"""
    SELECT article_id, string_agg(id, ',' ORDER BY rank) AS top_similar_articles FROM (
        SELECT article_id, id, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, id) AS rank FROM (
            SELECT q.article_id, s.article_id AS id, {_cosine('q.e', 's.e')} AS score
            FROM (SELECT * FROM space WHERE {queries}) q JOIN space s ON q.article_id <> s.article_id))
    WHERE rank <= 3 GROUP BY article_id"""


_SPOILED = """
    spoiled AS (SELECT article_id, CAST(regexp_extract(article_id, '([0-9]+)', 1) AS BIGINT) AS k, metadata_matched FROM enriched)
    SELECT article_id, 'enriched' AS stage, 'company_age' AS field, 'above 300' AS rule FROM spoiled WHERE k % 13 = 0
    UNION ALL SELECT article_id, 'enriched', 'metadata_matched', 'not a flag' FROM spoiled WHERE k % 17 = 0
    UNION ALL SELECT article_id, 'enriched', 'meta_employee_count', 'not a whole number' FROM spoiled WHERE k % 19 = 0
    UNION ALL SELECT article_id, 'enriched', '<row>', 'matched without founding year' FROM spoiled
    WHERE k % 23 = 0 AND metadata_matched AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0"""

EXPECTED = {
    "clean_revenue": _with("SELECT article_id, revenue_usd FROM truth"),
    "clean_dates": _with("SELECT article_id, published_date, pub_year, pub_quarter, pub_month FROM truth"),
    "clean_category": _with("SELECT article_id, category FROM truth"),
    "validate_counts": _with(
        f"""SELECT count(*) AS rows_read, count(*) FILTER (WHERE bad_raw) AS failed_raw, count(*) FILTER (WHERE NOT bad_raw) AS rows_after_raw,
        count(*) FILTER (WHERE NOT bad_raw AND bad_date) AS failed_clean, CAST(0 AS BIGINT) AS revenue_errors,
        (SELECT count(*) FILTER (WHERE metadata_matched) FROM enriched) AS matched,
        (SELECT count(*) FILTER (WHERE NOT metadata_matched) FROM enriched) AS unmatched,
        (SELECT count(*) FILTER (WHERE {_RELEVANT}) FROM enriched) AS retained,
        CAST(0 AS BIGINT) AS failed_enriched,
        (SELECT count(*) FILTER (WHERE {_RELEVANT}) FROM enriched) AS exported FROM truth"""
    ),
    "validate_rejects": _with(_FAULTS),
    "validate_enriched": _with("," + _SPOILED),
    "missing_columns": _with(
        """SELECT * FROM (VALUES ('raw', 'author'), ('raw', 'url')) f(stage, field), (SELECT count(*) AS rows FROM truth)
        UNION ALL SELECT * FROM (VALUES ('clean', 'pub_year')) f(stage, field), (SELECT count(*) AS rows FROM enriched)"""
    ),
    "resolve_company": _with(
        """SELECT nm.name, count(*) AS rows, nm.company_key, nm.match_kind
        FROM base b JOIN names nm ON nm.ci = b.ci AND nm.form = b.form GROUP BY nm.name, nm.company_key, nm.match_kind"""
    ),
    "resolve_company_large": """
        WITH letters AS (SELECT c_custkey AS k, translate(md5(CAST(c_custkey AS VARCHAR)), '0123456789abcdef', 'aeioubdfgklmnrst') AS x FROM customer),
        named AS (SELECT k, upper(x[1:1]) || x[2:7] || ' ' || upper(x[8:8]) || x[9:15] AS n FROM letters)
        SELECT CASE k % 4 WHEN 0 THEN n WHEN 1 THEN upper(n) WHEN 2 THEN n[1:3] || n[5:] ELSE 'Zzxq' || k || 'wvyjh' END AS name,
               CAST(1 AS BIGINT) AS rows, CASE WHEN k % 4 < 3 THEN n END AS company_key,
               CASE k % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'ignoring case' WHEN 2 THEN 'similar' END AS match_kind
        FROM named""",
    "attach_both_forms": _with(
        """SELECT nm.name AS company_name, c.company_key IS NOT NULL AS metadata_matched, CAST(c.founded_year AS INTEGER) AS meta_founded_year,
        c.stock_ticker AS meta_stock_ticker, f.form, count(*) AS articles
        FROM base b JOIN names nm ON nm.ci = b.ci AND nm.form = b.form LEFT JOIN companies c USING (company_key),
        (VALUES ('broadcast'), ('shuffle')) f(form) GROUP BY ALL"""
    ),
    "enrichment_rejects": _with(
        f"SELECT article_id, 'kept' AS stage, '' AS rule FROM enriched UNION ALL SELECT article_id, stage, rule FROM ({_FAULTS})"
    ),
    "enrich_articles": _with(f"SELECT {_columns()} FROM enriched"),
    "relevance_filter": _with(f"SELECT article_id, category, meta_industry FROM enriched WHERE {_RELEVANT}"),
    "profile_category": _with(f"SELECT category, count(*) AS articles FROM enriched WHERE {_RELEVANT} GROUP BY category"),
    "profile_size": _with(
        f"SELECT company_size_category, count(*) AS articles FROM enriched WHERE {_RELEVANT} GROUP BY company_size_category"
    ),
    "table_count": _with("SELECT count(*) AS count FROM enriched"),
    "export_filtered": _with(f"SELECT {_FLAT_SQL} FROM enriched s WHERE {_EXPORTED}"),
    "knn_by_id": _with(_nearest("TRUE", 5)),
    "knn_hydrated": _with(_nearest("TRUE", 10, ", 'Note ' || t.article_id AS title, t.label AS label")),
    "hybrid_search": _with(_nearest("t.label BETWEEN 3 AND 6", 5)),
    "top3_neighbours": _with(
        f"""SELECT article_id, CAST(rank AS INTEGER) AS rank, neighbour, round(score, 6) AS score
        FROM ({_ranked('vectors', 'vectors')}) WHERE rank <= 3"""
    ),
    "top3_neighbours_blocked": _with(
        f"""SELECT article_id, string_agg(neighbour, ',' ORDER BY rank) AS top_similar_articles
        FROM ({_ranked('vectors', 'vectors')}) WHERE rank <= 3 GROUP BY article_id"""
    ),
    "sql_report": _with(
        """SELECT category, company_size_category, count(*) AS articles,
        CAST(sum(revenue_usd) AS BIGINT) AS revenue_usd, count(v.e) AS with_vector,
        CAST(rank() OVER (PARTITION BY category ORDER BY count(*) DESC, company_size_category) AS INTEGER) AS size_rank
        FROM enriched LEFT JOIN vectors v USING (article_id)
        WHERE pub_year >= 2019 GROUP BY category, company_size_category"""
    ),
    "embed_documents": f"""
        WITH {_embedded(_DOC_TEXTS)}
        SELECT doc_id, md5(coalesce(source, '') || '. ' || coalesce(text, '')) AS text_hash,
               CAST(len(e) AS INTEGER) AS dimensions, round(sqrt(list_dot_product(e, e)), 6) AS norm, {_FOLD.format(e='e')} AS vector
        FROM documents d JOIN space ON space.article_id = 'DOC' || doc_id""",
    "document_neighbours": f"WITH {_embedded(_DOC_TEXTS)} {_top3('true')}",
    "search_by_text": f"""
        WITH {_embedded(_DOC_TEXTS, QUERY_TEXT)}
        SELECT s.article_id, round({_cosine('q.e', 's.e')}, 6) AS score
        FROM space s, (SELECT e FROM space WHERE article_id = 'QUERY') q WHERE s.article_id <> 'QUERY'
        ORDER BY {_cosine('q.e', 's.e')} DESC, s.article_id LIMIT 10""",
    "top3_repeated_ids": f"""
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        twice AS (SELECT vec_id * 2 AS r, 'S' || (vec_id // 2) AS id, e FROM e UNION ALL SELECT vec_id * 2 + 1, 'T' || (vec_id // 2), e FROM e),
        near AS (SELECT q.r, q.id, t.id || ':' || t.r AS hit, row_number() OVER (PARTITION BY q.r
                     ORDER BY round({_COS.format(a='q.e', b='t.e')}, 12) DESC, t.id, t.r) AS rank
                 FROM twice q JOIN twice t ON q.r <> t.r)
        SELECT r AS row_id, id AS article_id, form, string_agg(hit, ',' ORDER BY rank) AS neighbours
        FROM near, (VALUES ('small'), ('blocked')) f(form) WHERE rank <= 3 GROUP BY r, id, form""",
    "csv_roundtrip": _with(
        f"""SELECT article_id, title, t.company_name,
        CASE dv WHEN 0 THEN strftime(b.d, '%Y-%m-%d') WHEN 1 THEN strftime(b.d, '%Y-%m-%dT00:00:00Z')
            WHEN 2 THEN strftime(b.d, '%m/%d/%Y') WHEN 3 THEN strftime(b.d, '%d/%m/%Y')
            WHEN 4 THEN strftime(b.d, '%d-%m-%Y') WHEN 5 THEN strftime(b.d, '%-d %b %Y')
            WHEN 6 THEN strftime(b.d, '%B %-d, %Y') WHEN 8 THEN strftime(b.d, '%b %-d, %Y')
            ELSE CASE WHEN b.k % 4 = 0 THEN 'N/A' ELSE strftime(b.d, '%d %B %Y') END END AS published_date,
        CASE b.k % 3 WHEN 0 THEN c WHEN 1 THEN upper(c) ELSE chr(9) || c || '  ' END AS category,
        summary, url, coalesce(author, '') AS author,
        CASE b.rv WHEN 0 THEN '$' || format('{{:,}}', b.n) WHEN 1 THEN '£' || b.n WHEN 2 THEN '€' || b.n || 'K'
            WHEN 3 THEN b.n || 'K usd' WHEN 4 THEN '¥' || format('{{:,}}', b.n * 100)
            WHEN 5 THEN '$' || b.n || 'K - $' || (b.n + 10) || 'K' WHEN 6 THEN b.n || '.5 million EUR'
            WHEN 7 THEN ['Not disclosed', 'N/A', '--', ''][(b.k // 10) % 4 + 1]
            WHEN 8 THEN 'GBP ' || b.n || ' to ' || (b.n + 3) ELSE b.n || 'M GBP' END AS revenue,
        word_count
        FROM truth t JOIN (SELECT *, [{_RAW}][(k // 5) % {len(RAW_CATEGORIES)} + 1] AS c FROM base) b USING (k)"""
    ),
    "export_json_arrays": _with(
        f"""SELECT article_id, CAST(len(v.e) AS INTEGER) AS dimensions, round(list_sum(v.e), 6) AS total,
        '["' || string_agg(neighbour, '","' ORDER BY rank) || '"]' AS top_similar_articles
        FROM ({_ranked('vectors', 'vectors')}) r JOIN vectors v USING (article_id)
        WHERE rank <= 3 GROUP BY article_id, v.e"""
    ),
    "company_dimension": """
        SELECT s_name AS company_key, CAST((CASE WHEN s_suppkey % 10 = 0 THEN 1900 ELSE 1950 END) + s_suppkey % 70 AS INTEGER) AS founded_year,
               'City, ' || s_nationkey AS headquarters,
               CAST(floor(abs(s_acctbal) * 10) AS INTEGER) AS employee_count,
               'Industry ' || (s_suppkey % 5) AS industry, s_suppkey % 2 = 0 AS is_public,
               CASE WHEN s_suppkey % 3 <> 0 THEN 'T' || s_suppkey END AS stock_ticker
        FROM supplier""",
    "load_replace": _with(
        """SELECT pub_year, metadata_matched, count(*) AS articles, CAST(sum(revenue_usd) AS BIGINT) AS revenue_usd,
        CAST(sum(company_age) AS BIGINT) AS ages, count(v.e) AS with_vector
        FROM enriched LEFT JOIN vectors v USING (article_id) GROUP BY pub_year, metadata_matched"""
    ),
    # Empty texts come back from CSV as null, and a missing author as empty
    # text, which is then no fault.
    "full_enrichment": _with(
        f"""SELECT {_columns().replace('author', "nullif(author, '') AS author")} FROM (
            SELECT t.*, c.company_key IS NOT NULL AS metadata_matched,
                CAST(c.founded_year AS INTEGER) AS meta_founded_year, c.headquarters AS meta_headquarters,
                CAST(c.employee_count AS INTEGER) AS meta_employee_count, c.industry AS meta_industry,
                c.is_public AS meta_is_public, c.stock_ticker AS meta_stock_ticker,
                CAST(CASE WHEN t.pub_year >= c.founded_year THEN t.pub_year - c.founded_year END AS INTEGER) AS company_age,
                CASE WHEN c.employee_count IS NULL THEN 'Unknown' WHEN c.employee_count < 10000 THEN 'Small'
                     WHEN c.employee_count <= 30000 THEN 'Medium' ELSE 'Large' END AS company_size_category
            FROM truth t LEFT JOIN companies c USING (company_key)
            WHERE NOT (k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0 OR k % 71 = 0) AND NOT bad_date)
        WHERE {_RELEVANT}"""
    ),
    "similarity_rows": _with(
        f""", corpus AS (SELECT en.*, v.e FROM enriched en LEFT JOIN vectors v USING (article_id)),
        kept AS (SELECT * FROM corpus WHERE {_EXPORTED}),
        near AS (SELECT article_id, string_agg(neighbour, ',' ORDER BY rank) AS ids
                 FROM ({_ranked('(SELECT * FROM corpus WHERE e IS NOT NULL)', '(SELECT * FROM kept WHERE e IS NOT NULL)')})
                 WHERE rank <= 3 GROUP BY article_id)
        SELECT {_FLAT_SQL}, CAST(coalesce(len(s.e), 0) AS INTEGER) AS dimensions, near.ids AS top_similar_articles
        FROM kept s LEFT JOIN near USING (article_id)"""
    ),
    "similarity_job": _with(
        f""", {_embedded(_NEWS_TEXTS)},
        near AS ({_top3(f"article_id IN (SELECT article_id FROM enriched WHERE {_EXPORTED})")})
        SELECT article_id, coalesce(meta_industry, '') AS industry, revenue_usd, CAST(len(e) AS INTEGER) AS dimensions,
               {_FOLD.format(e='e')} AS vector, top_similar_articles
        FROM enriched JOIN space USING (article_id) JOIN near USING (article_id) WHERE {_EXPORTED}"""
    ),
    "search_session": _with(
        f""", corpus AS (SELECT en.*, v.e FROM enriched en LEFT JOIN vectors v USING (article_id))
        {_nearest(
            't.e IS NOT NULL AND t.pub_year BETWEEN 2018 AND 2022 AND t.revenue_usd >= 100000',
            5,
            ', t.company_name AS company_name, t.category AS category, t.pub_year AS pub_year, t.revenue_usd AS revenue_usd',
            'corpus',
        )}"""
    ),
}

EXPECTED["csv_split_roundtrip"] = EXPECTED["csv_roundtrip"]
