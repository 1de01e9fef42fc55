"""The same results in SQL over the supplied tables."""

from __future__ import annotations

from checks.queries import (
    BATCH_FROM,
    FIRST_YEAR,
    GAZETTEER,
    LATER_FROM,
    LEXICON,
    TABLE_UNTIL,
)
from newsloom.functions.stopwords import ENGLISH
from newsloom.operators.sentiment import POLARITY


def _text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _rows(pairs: dict) -> str:
    return ", ".join(
        f"({_text(k)}, {v if isinstance(v, float) else _text(v)})" for k, v in pairs.items()
    )


STOP = ", ".join(_text(w) for w in ENGLISH)

SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _squeeze(column: str) -> str:
    return f"trim(regexp_replace({column}, '{SPACE}+', ' ', 'g'))"


def _strip(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


WORDS = f"""
    SELECT doc_id AS id, lang, word FROM (
        SELECT doc_id, lang, unnest(string_split(lower(text), ' ')) AS word FROM documents
    ) WHERE word NOT IN ({STOP})
"""

LANG_COUNTS = f"SELECT lang, word, count(*) AS count FROM ({WORDS}) GROUP BY lang, word"

SHARES = """
    SELECT source AS source_name, min(string_split(url, '/')[3]) AS url,
           count(d.doc_id) / (SELECT count(*) FROM documents x LEFT JOIN pages y ON x.doc_id = y.page_id)
               AS reliability_score
    FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id GROUP BY source
"""

SCORED = f"""
    WITH sizes AS (SELECT lang, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang),
    shares AS ({SHARES})
    SELECT d.doc_id AS article_id, d.source AS source_name, d.lang AS topic_id,
           CAST(l.quality AS DOUBLE) AS sentiment_score,
           round(0.5 * coalesce(s.reliability_score, 0) + 0.3 * l.quality + 0.2 * ln(1 + n), 6) AS importance_score
    FROM documents d LEFT JOIN labels l USING (doc_id)
    LEFT JOIN shares s ON s.source_name = d.source
    LEFT JOIN sizes z ON z.lang = d.lang
"""

_OUTER = r"""^[.,;:!?()\[\]{}"''|]+|[.,;:!?()\[\]{}"''|]+$"""

# Runs of up to three words, the longest length in the gazetteer used here.
ENTITIES = f"""
    WITH texts AS (
        SELECT doc_id AS id, string_split({_squeeze("lower(text)")}, ' ') AS t FROM documents
    ),
    tokens AS (
        SELECT id, unnest(generate_series(1, len(t))) AS pos,
               regexp_replace(unnest(t), '{_OUTER}', '', 'g') AS w0
        FROM texts
    ),
    runs AS (
        SELECT id, pos, w0, lead(w0, 1) OVER w AS w1, lead(w0, 2) OVER w AS w2
        FROM tokens WINDOW w AS (PARTITION BY id ORDER BY pos)
    ),
    prefixes AS (
        SELECT id, pos, 1 AS size, w0 AS surface FROM runs
        UNION ALL SELECT id, pos, 2, w0 || ' ' || w1 FROM runs WHERE w1 IS NOT NULL
        UNION ALL SELECT id, pos, 3, w0 || ' ' || w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
    ),
    names(surface, label) AS (VALUES {_rows(GAZETTEER)}),
    found AS (
        SELECT id, pos, size, surface, label FROM prefixes JOIN names USING (surface)
        UNION ALL
        SELECT id, pos, 1, w0, CASE
            WHEN regexp_matches(w0, '^[$€£][0-9][0-9.,]*[kmb]?$') THEN 'MONEY'
            WHEN regexp_matches(w0, '^[0-9]+([.,][0-9]+)?%$') THEN 'PERCENT'
            WHEN regexp_matches(w0, '^((19|20)[0-9]{{2}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}})$')
                THEN 'DATE' END AS form
        FROM runs WHERE form IS NOT NULL
    ),
    outer_found AS (
        SELECT * FROM found f WHERE NOT EXISTS (
            SELECT 1 FROM found o WHERE o.id = f.id AND o.pos <= f.pos
            AND o.pos + o.size >= f.pos + f.size AND o.size > f.size
        )
    )
"""

TEXT_ENTITIES = f"""
    {ENTITIES}
    SELECT d.doc_id AS id,
           '[' || coalesce(string_agg(surface || ' (' || label || ')', ', ' ORDER BY pos, size DESC), '') || ']' AS entities
    FROM documents d LEFT JOIN outer_found f ON f.id = d.doc_id GROUP BY d.doc_id
"""


def _sentiment(lexicon: dict, tokens: str) -> str:
    return f"""
        WITH lexicon(token, polarity) AS (VALUES {_rows(lexicon)}),
        tokens AS (
            SELECT doc_id, regexp_replace(token, '{_OUTER}', '', 'g') AS token
            FROM (SELECT doc_id, unnest({tokens}) AS token FROM documents)
        ),
        means AS (
            SELECT doc_id, sum(CAST(polarity AS DECIMAL(9, 6))) / CAST(count(*) AS DOUBLE) AS score
            FROM tokens JOIN lexicon USING (token) GROUP BY doc_id
        )
        SELECT d.doc_id AS id, score, CAST(coalesce(score, 0) AS FLOAT) AS sentiment_score
        FROM documents d LEFT JOIN means m ON m.doc_id = d.doc_id
    """


CLEAN_TEXT = "lower(trim(regexp_replace(text, '\\n', ' ', 'g')))"


def _profile(period: str, url: str) -> str:
    return f"""
        SELECT c_name AS name, '{url}' AS url,
               round(count(o_orderkey) / (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE {period}), 8)
                   AS reliability_score
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE {period} GROUP BY c_name
    """


EARLY = f"o_orderdate < TIMESTAMP '{FIRST_YEAR}'"
LATE = f"o_orderdate >= TIMESTAMP '{LATER_FROM}'"

SOURCES = f"""
    WITH first AS ({_profile(EARLY, "first")}),
    later AS ({_profile(LATE, "later")}),
    numbered AS (SELECT row_number() OVER (ORDER BY name) AS source_id, * FROM first),
    new AS (SELECT * FROM later WHERE name NOT IN (SELECT name FROM first)),
    dim AS (
        SELECT source_id, n.name, n.url,
               CASE WHEN l.name IS NULL THEN n.reliability_score ELSE l.reliability_score END AS reliability_score
        FROM numbered n LEFT JOIN later l ON l.name = n.name
        UNION ALL
        SELECT (SELECT max(source_id) FROM numbered) + row_number() OVER (ORDER BY name), name, url, reliability_score
        FROM new
    )
"""


def _order_facts(period: str, step: int) -> str:
    return f"""
        SELECT o_orderkey AS article_id, o_custkey + {step} AS source_id,
               CAST(o_orderpriority[1] AS INTEGER) AS topic_id, CAST(o_orderdate AS DATE) AS published_at,
               o_totalprice + {step} AS sentiment_score,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * {step + 1} END AS importance_score
        FROM orders WHERE {period}
    """


def _shipped(period: str, category: str) -> str:
    return f"""
        SELECT p_partkey AS topic_id, p_name AS name, {category} AS category
        FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE {period})
    """


STAR = f"""
    {SOURCES}
    SELECT o_orderkey AS article_id, source_id, CAST(o_orderpriority[1] AS INTEGER) AS topic_id,
           CAST(o_orderdate AS DATE) AS published_at, o_totalprice AS sentiment_score,
           CASE WHEN {LATE} THEN 1.0::DOUBLE ELSE o_totalprice / 1000 END AS importance_score,
           strftime(o_orderdate, '%Y-%m') AS month, c_name AS source_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN dim ON dim.name = c_name
"""

LEFT3 = """
    SELECT event_id AS article_id, source AS source_name, quality AS topic_id,
           CAST(ts AS DATE) AS published_at, CAST(label AS FLOAT) AS sentiment_score
    FROM events e LEFT JOIN documents d ON d.doc_id = event_id
    LEFT JOIN labels l ON l.doc_id = event_id LEFT JOIN embeddings ON vec_id = event_id
"""

ORACLES = {
    "src_csv_roundtrip": """
        SELECT doc_id, chr(9) || text || ' "x", y' || chr(13) || chr(10) || '\\ z' || chr(13) || ' ' AS text, lang, source, n_chars
        FROM documents
    """,
    "src_csv_split": """
        SELECT doc_id, text || ' "",' || chr(10) || chr(10) || '"x"' || chr(13) || chr(10) || ',y' || chr(10) || text AS text,
               lang, source, n_chars
        FROM documents
    """,
    "csv_single_file": "SELECT source, count(*) AS count, 1 AS files FROM documents GROUP BY source",
    "src_parquet_count": "SELECT count(*) AS n FROM documents",
    "page_ingest": f"""
        SELECT doc_id AS id, replace(replace({_strip("source")}, chr(10), ' '), chr(13), ' ') AS title,
               '' AS url, '' AS image_url, {_strip("source")} AS news_site,
               replace({_squeeze("text")}, '"', '''') AS summary, false AS featured,
               '[{{"n":' || n_chars || '}}]' AS launches, '[]' AS events
        FROM documents
    """,
    "json_props": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS props_text
        FROM events
    """,
    "page_window": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100",
    "since_date": "SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
    "sink_partitioned": "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events",
    "clean_docs": f"""
        SELECT doc_id AS id, {CLEAN_TEXT} AS summary, CAST(ts AS DATE) AS published_at, CAST(ts AS DATE) AS updated_at
        FROM documents LEFT JOIN events ON doc_id = event_id
    """,
    "normalize_text": f"SELECT doc_id, replace({_squeeze('text')}, '\"', '''') AS summary FROM documents",
    "ingest_normalize": f"""
        SELECT page_id AS id, replace(replace({_strip("html")}, chr(10), ' '), chr(13), ' ') AS title,
               {_strip("url")} AS url, '' AS image_url, '' AS news_site,
               replace({_squeeze("html")}, '"', '''') AS summary, '' AS published_at, '' AS updated_at,
               false AS featured, '[]' AS launches, '[]' AS events
        FROM pages
    """,
    "url_host": "SELECT page_id, string_split(url, '/')[3] AS host FROM pages",
    "to_date_cast": """
        SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) AS day_of_text, CAST(ts AS DATE) AS day_of_prefix
        FROM events
    """,
    "union_doc_types": """
        SELECT CASE WHEN CAST(o_orderpriority[1] AS INTEGER) <= 2 THEN 'articles'
                    WHEN CAST(o_orderpriority[1] AS INTEGER) = 3 THEN 'reports' ELSE 'blogs' END AS doc_type,
               o_orderkey, o_orderpriority
        FROM orders
    """,
    "dedupe_by_key": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                ORDER BY ts DESC NULLS LAST, event_id, value, props) AS copy FROM events
        ) WHERE copy = 1
    """,
    "word_counts": f"SELECT word AS filtered_words, count(*) AS count FROM ({WORDS}) GROUP BY word",
    "tfidf_terms": f"""
        WITH tf AS (SELECT id, word AS term, count(*) AS tf FROM ({WORDS}) GROUP BY id, word),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
        SELECT id, term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf
        FROM tf JOIN df USING (term)
    """,
    "topic_word_counts": LANG_COUNTS,
    "topic_category": f"""
        SELECT lang, substring(word, 1, 255) AS category FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, word) AS rank FROM ({LANG_COUNTS})
        ) WHERE rank = 1
    """,
    "topic_labels": f"""
        SELECT lang, substring(string_agg(word, ', ' ORDER BY count DESC, word), 1, 255) AS name,
               substring(arg_min(word, rank), 1, 255) AS category
        FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, word) AS rank FROM ({LANG_COUNTS})
        ) GROUP BY lang
    """,
    "sentiment_lexicon": f"""
        SELECT id, round(sentiment_score, 4) AS sentiment_score,
               CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM ({_sentiment(LEXICON, "string_split(lower(text), ' ')")})
    """,
    "topics_kmeans_rows": "SELECT doc_id AS id, true AS valid FROM documents",
    "cluster_labels_agree": "SELECT true AS agree, true AS few",
    "article_cluster_rows": "SELECT source AS title, text AS summary, true AS valid FROM documents",
    "sentiment_scorer": """
        WITH scored AS (
            SELECT doc_id AS id,
                   CAST((length(text) - length(replace(text, '?', ''))) / greatest(length(text), 1) - 0.001 AS FLOAT) AS score
            FROM documents
        )
        SELECT id, round(score, 5) AS sentiment_score,
               CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM scored
    """,
    "entities_gazetteer": f"""
        {ENTITIES}
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos, size DESC) - 1 AS INTEGER) AS place,
               surface AS text, label
        FROM outer_found
    """,
    "entities_text": TEXT_ENTITIES,
    "publication_trend": "SELECT CAST(ts AS DATE) AS published_at, count(*) AS count FROM events GROUP BY 1",
    "site_counts": "SELECT source, count(*) AS count FROM documents GROUP BY source",
    "doc_sources": "SELECT doc_id AS id, source AS source_name FROM documents",
    "source_reliability": f"""
        SELECT source_name, url, round(reliability_score, 6) AS reliability_score FROM ({SHARES})
    """,
    "merge_left3": LEFT3,
    "merge_bucketed": LEFT3,
    "importance": SCORED,
    "attach_entities": f"""
        SELECT s.*, e.id, e.entities FROM ({SCORED}) s LEFT JOIN ({TEXT_ENTITIES}) e ON e.id = s.article_id
    """,
    "monthly_trends": """
        SELECT month, topic, article_count, rank() OVER (PARTITION BY month ORDER BY article_count DESC) AS rank
        FROM (
            SELECT date_trunc('month', o_orderdate) AS month, c_mktsegment AS topic, count(*) AS article_count
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
        )
    """,
    "influential_sources": """
        SELECT source_name, total_articles, round(avg_importance, 4) AS avg_importance,
               rank() OVER (ORDER BY total_articles DESC, avg_importance DESC NULLS FIRST) AS rank
        FROM (
            SELECT s_name AS source_name, count(l_orderkey) AS total_articles, avg(l_extendedprice) AS avg_importance
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name
        )
    """,
    "upsert_sources": f"{SOURCES} SELECT source_id, name, url, reliability_score FROM dim",
    "insert_ignore_topics": f"""
        WITH first AS ({_shipped(f"l_shipdate < TIMESTAMP '{FIRST_YEAR}'", "p_brand")}),
        later AS ({_shipped(f"l_shipdate >= TIMESTAMP '{LATER_FROM}'", "p_type")})
        SELECT * FROM first
        UNION ALL SELECT * FROM later WHERE topic_id NOT IN (SELECT topic_id FROM first)
    """,
    "upsert_facts": f"""
        WITH present AS ({_order_facts(f"o_orderdate < TIMESTAMP '{TABLE_UNTIL}'", 0)}),
        batch AS ({_order_facts(f"o_orderdate >= TIMESTAMP '{BATCH_FROM}'", 1)})
        SELECT article_id, published_at, coalesce(p.source_id, b.source_id) AS source_id,
               coalesce(p.topic_id, b.topic_id) AS topic_id,
               CASE WHEN b.source_id IS NULL THEN p.sentiment_score ELSE b.sentiment_score END AS sentiment_score,
               CASE WHEN b.source_id IS NULL THEN p.importance_score ELSE b.importance_score END AS importance_score
        FROM present p FULL JOIN batch b USING (article_id, published_at)
    """,
    "fact_resolved": """
        SELECT o_orderkey AS article_id, c_custkey AS source_id, CAST(o_orderpriority[1] AS INTEGER) AS topic_id,
               CAST(o_orderdate AS DATE) AS published_at, o_totalprice AS sentiment_score,
               o_totalprice / 1000 AS importance_score
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
    """,
    "star_load": STAR,
    "star_load_buckets": STAR,
    "star_sums": f"""
        SELECT month, source_id, topic_id, count(*) AS rows, count(article_id) AS articles,
               round(sum(importance_score), 3) AS score_sum, count(importance_score) AS scores
        FROM ({STAR}) WHERE topic_id <> 5 GROUP BY month, source_id, topic_id
    """,
    "star_trends": f"""
        SELECT month, topic, article_count, rank() OVER (PARTITION BY month ORDER BY article_count DESC) AS rank
        FROM (
            SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority AS topic, count(*) AS article_count
            FROM orders WHERE o_orderkey IN (SELECT article_id FROM ({STAR})) GROUP BY 1, 2
        )
    """,
    "entities_tagger": """
        SELECT id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS place, unnest(found) AS text, 'NUMBER' AS label
        FROM (SELECT doc_id AS id, regexp_extract_all(text, '[0-9]{4,}') AS found FROM documents)
    """,
    "hashed_terms": """
        SELECT doc_id, CAST(n AS INTEGER) AS tokens, n AS hashed FROM (
            SELECT doc_id, len(string_split_regex(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', ''), '[ \\t\\n\\x0B\\f\\r]'))
                AS n
            FROM documents
        )
    """,
    "analyze_in_memory": """
        WITH records AS (SELECT DISTINCT source, lang FROM documents)
        SELECT word AS filtered_words, count(*) AS count FROM (
            SELECT source AS word FROM records UNION ALL SELECT lang FROM records UNION ALL SELECT 'item' FROM records
        ) GROUP BY word
    """,
    "raw_sink": "SELECT doc_id AS id, source AS title, nullif(text, '') AS summary FROM documents",
    "empty_inputs": """
        SELECT unnest(['clustered', 'labels', 'articles', 'words', 'entities', 'sentiment', 'sources']) AS operator, 0 AS n
    """,
    "fk_violations": """
        SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """,
    "key_violations": """
        SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY user_id, event_type HAVING count(*) > 1
    """,
    "null_violations": """
        SELECT doc_id, source, url FROM documents LEFT JOIN pages ON doc_id = page_id WHERE source IS NULL OR url IS NULL
    """,
    "range_violations": """
        SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT (l_discount BETWEEN 0.02 AND 0.05)
    """,
    "cascade_delete": """
        SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)
    """,
    "daily_run": f"""
        SELECT d.doc_id AS article_id, d.doc_id AS id, d.source AS source_name, true AS topic_known,
               CAST(ts AS DATE) AS published_at, round(s.sentiment_score, 4) AS sentiment_score,
               round(0.5 * coalesce(r.reliability_score, 0) + 0.3 * s.sentiment_score, 4) AS other_importance, e.entities
        FROM documents d LEFT JOIN ({SHARES}) r ON r.source_name = d.source LEFT JOIN events ON event_id = d.doc_id
        JOIN ({_sentiment(POLARITY, f"string_split({CLEAN_TEXT}, ' ')")}) s ON s.id = d.doc_id
        JOIN ({TEXT_ENTITIES}) e ON e.id = d.doc_id
    """,
    "incremental_load": f"""
        SELECT doc_id AS id, source AS title, {CLEAN_TEXT} AS summary, CAST(ts AS DATE) AS published_at
        FROM documents LEFT JOIN events ON event_id = doc_id
    """,
    "stream_first_arrivals": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL '1 hour', ts)
                ORDER BY ts, event_id) AS place FROM events
        ) WHERE place = 1
    """,
    "stream_first_in_window": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL '1 hour', ts)
                ORDER BY ts, event_id) AS place FROM events
        ) WHERE place = 1
        AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '2 days'
    """,
    "stream_once": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "month_partition_counts": "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1",
}
