"""Registry of the named queries exposed through ``__spark_entry__``.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with an optional
DuckDB statement computing the same result from the same parquet tables.  All queries
read whole tables; parameters (dictionary, ``as_of``, limits) are fixed values below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import entities as ent
from tidewatch.operators import trends
from tidewatch.plans import sql_text as S
from tidewatch.sources import bindings as B
from tidewatch.sources.config import entities_from_pairs

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- fixed values: demo dictionary and query parameters ---------------------------------
# Words that occur in the four corpus languages, one multi-word keyword, one keyword
# repeated inside an entity, non-ASCII keywords, keywords with punctuation, and an entity
# name used twice (the later entity wins where it has a hit).
DEMO_ENTITIES = entities_from_pairs([
    ("Function", ["the", "and", "of", "le", "des", "für", "la", "the"]),
    ("Phrase", ["of the", "de la", "the the"]),
    ("Accent", ["é", "ü", "ñ"]),
    ("Contact", ["mail2", "example.com", "by-nc", ".com"]),
    ("Url", ["http"]),
    ("Phrase", ["und", "der die"]),
])
TREND_DAYS = 7
TREND_LIMIT = 10
# -------------------------------------------------------------------------------------------

AS_OF = B.AS_OF
A = S.ARTICLES_CTE


# ---------------------------------------------------------------------------------------------
# Dictionary entity matching
# ---------------------------------------------------------------------------------------------

@register("entity_hits", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)}
SELECT link, entity, entity_ord, keyword, keyword_ord FROM hits""")
def q_entity_hits(spark, sf):
    return ent.entity_hits(B.document_articles(spark, sf), DEMO_ENTITIES)


@register("entity_hits_join", ORACLE["entity_hits"])
def q_entity_hits_join(spark, sf):
    """Same result through the join form used for dictionaries too large to inline."""
    return ent.entity_hits(B.document_articles(spark, sf), DEMO_ENTITIES, mode="join")


@register("entity_match", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)},
per_entity AS (
  SELECT link, entity, min(entity_ord) AS eo,
         string_agg(keyword, '|' ORDER BY keyword_ord) AS keywords
  FROM hits GROUP BY link, entity)
SELECT a.link, p.entity, p.keywords
FROM articles a LEFT JOIN per_entity p ON a.link = p.link""")
def q_entity_match(spark, sf):
    m = ent.entity_match(B.document_articles(spark, sf), DEMO_ENTITIES)
    return m.select("link", F.explode_outer("matched_entities").alias("entity", "kw")).select(
        "link", "entity", F.array_join("kw", "|").alias("keywords"))


@register("entity_flags", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)}
SELECT CAST(count(*) AS BIGINT) AS collected,
       CAST(count(*) FILTER (WHERE link IN (SELECT link FROM hits)) AS BIGINT) AS matched
FROM articles""")
def q_entity_flags(spark, sf):
    m = ent.entity_flags(ent.entity_match(B.document_articles(spark, sf), DEMO_ENTITIES))
    return m.agg(F.count(F.lit(1)).cast("bigint").alias("collected"),
                 F.count_if("matched").cast("bigint").alias("matched"))


@register("top_trends", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)}
SELECT h.entity, CAST(count(*) AS BIGINT) AS hits
FROM hits h JOIN articles a ON a.link = h.link
WHERE a.collected_at >= {S.cutoff(TREND_DAYS)}
GROUP BY h.entity ORDER BY hits DESC, h.entity LIMIT {TREND_LIMIT}""")
def q_top_trends(spark, sf):
    m = ent.entity_match(B.document_articles(spark, sf), DEMO_ENTITIES)
    return trends.top_trends(m, AS_OF, TREND_DAYS, TREND_LIMIT)


@register("entity_counts", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)}
SELECT entity, CAST(count(*) AS BIGINT) AS hits FROM hits GROUP BY entity""")
def q_entity_counts(spark, sf):
    hits = ent.entity_hits(B.document_articles(spark, sf), DEMO_ENTITIES)
    return trends.entity_totals_from_hits(hits)


# ---------------------------------------------------------------------------------------------
# Relational core: windows, filters, validation, URL helpers, dedup
# ---------------------------------------------------------------------------------------------
from tidewatch.functions import entities_json as EJ  # noqa: E402
from tidewatch.functions import text as TX  # noqa: E402
from tidewatch.operators import dedup, quality, recent, validate  # noqa: E402

# --- fixed values: query parameters --------------------------------------------------------
RECENT_CATEGORY = "en"
RECENT_DAYS = 29
RECENT_LIMIT = 200
UPDATES_DAYS = 7
UPDATES_LIMIT = 20
FRESH_DAYS = 10
COLLECTED_DAYS = 3
ALLOWED_LANGS = {"en", "fr", "de"}
DATE_CHECK_AS_OF = B.dt.datetime(2024, 1, 25)
NULL_CONDITIONS = {"published": "published IS NULL",
                   "summary": "summary IS NULL OR summary = ''",
                   "short_title": "length(title) < 20"}
# -------------------------------------------------------------------------------------------
P = S.PAGES_CTE

RECENT_COLS = ["title", "link", "summary", "published", "source", "category", "collected_at",
               "effective_time"]


@register("recent_articles", f"""
WITH {A}
SELECT title, link, coalesce(summary, '') AS summary, published, source, category, collected_at,
       coalesce(published, collected_at) AS effective_time
FROM articles
WHERE category = {S.q(RECENT_CATEGORY)} AND coalesce(published, collected_at) >= {S.cutoff(RECENT_DAYS)}
ORDER BY effective_time DESC, link LIMIT {RECENT_LIMIT}""")
def q_recent_articles(spark, sf):
    return recent.recent_articles(B.document_articles(spark, sf), RECENT_CATEGORY, AS_OF,
                                  RECENT_DAYS, RECENT_LIMIT).select(*RECENT_COLS)


@register("recent_updates", f"""
WITH {A}
SELECT title, source, link, collected_at FROM articles
WHERE collected_at >= {S.cutoff(UPDATES_DAYS)}
ORDER BY collected_at DESC, link LIMIT {UPDATES_LIMIT}""")
def q_recent_updates(spark, sf):
    return recent.recent_updates(B.document_articles(spark, sf), AS_OF, UPDATES_DAYS, UPDATES_LIMIT)


@register("freshness_gate", f"""
WITH {A}
SELECT link, published FROM articles
WHERE published IS NULL OR published >= {S.cutoff(FRESH_DAYS)}""")
def q_freshness_gate(spark, sf):
    return recent.freshness_gate(B.document_articles(spark, sf), AS_OF, FRESH_DAYS).select(
        "link", "published")


@register("freshness_gate_events", f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE ts IS NULL OR ts >= {S.cutoff(FRESH_DAYS)}""")
def q_freshness_gate_events(spark, sf):
    return recent.freshness_gate(B.read_table(spark, sf, "events"), AS_OF, FRESH_DAYS, col="ts")


@register("collected_since", f"""
WITH {A}
SELECT link, collected_at FROM articles WHERE collected_at >= {S.cutoff(COLLECTED_DAYS)}""")
def q_collected_since(spark, sf):
    return recent.collected_since(B.document_articles(spark, sf), AS_OF, COLLECTED_DAYS).select(
        "link", "collected_at")


# defects planted in page articles, by page_id mod 10: blank title, bad link, no summary, no
# source, no category, no title, no link; the other three tenths stay valid
FAULTY = f"""{P}, faulty AS (
SELECT page_id, CASE page_id % 10 WHEN 1 THEN '  ' WHEN 6 THEN NULL ELSE title END AS title,
       CASE page_id % 10 WHEN 2 THEN 'no scheme ' || CAST(page_id AS VARCHAR) WHEN 7 THEN NULL ELSE link END AS link,
       CASE page_id % 10 WHEN 3 THEN NULL ELSE summary END AS summary,
       CASE page_id % 10 WHEN 4 THEN NULL ELSE source END AS source,
       CASE page_id % 10 WHEN 5 THEN '' ELSE category END AS category FROM page_articles)"""


def faulty_articles(spark, sf):
    i = F.col("page_id") % 10
    return B.page_articles(spark, sf).select(
        "page_id", F.when(i == 1, "  ").when(i != 6, F.col("title")).alias("title"),
        F.when(i == 2, F.concat(F.lit("no scheme "), F.col("page_id").cast("string"))).when(i != 7, F.col("link")).alias("link"),
        F.when(i != 3, F.col("summary")).alias("summary"), F.when(i != 4, F.col("source")).alias("source"),
        F.when(i == 5, "").otherwise(F.col("category")).alias("category"))


@register("validate_articles", f"""
WITH {FAULTY}, v AS (SELECT page_id, {S.validation_errors()} AS errs FROM faulty)
SELECT page_id, len(errs) = 0 AS is_valid, array_to_string(errs, ', ') AS errors FROM v""")
def q_validate_articles(spark, sf):
    v = validate.validate_articles(faulty_articles(spark, sf))
    return v.select("page_id", "is_valid", F.array_join("errors", ", ").alias("errors"))


@register("validate_documents", f"""
WITH {A}, v AS (SELECT link, {S.validation_errors()} AS errs FROM articles)
SELECT link, len(errs) = 0 AS is_valid, array_to_string(errs, ', ') AS errors FROM v""")
def q_validate_documents(spark, sf):
    v = validate.validate_articles(B.document_articles(spark, sf))
    return v.select("link", "is_valid", F.array_join("errors", ", ").alias("errors"))


@register("split_valid_invalid", f"""
WITH {FAULTY}, v AS (SELECT page_id, link, {S.validation_errors()} AS errs FROM faulty)
SELECT CASE WHEN len(errs) = 0 THEN page_id END AS page_id,
       CASE WHEN len(errs) > 0 THEN coalesce(link, 'None') || ': ' || array_to_string(errs, ', ') END AS error FROM v""")
def q_split_valid_invalid(spark, sf):
    """Both sides in one table: ids of the valid rows, errors of the invalid ones."""
    valid, invalid = validate.split_valid_invalid(validate.validate_articles(faulty_articles(spark, sf)))
    return valid.select("page_id", F.lit(None).cast("string").alias("error")).unionByName(
        invalid.select(F.lit(None).cast("long").alias("page_id"), "error"))


# what becomes of a page's URL, by page_id mod 6: as it is, no scheme, no host, broken
# brackets, an address in brackets, none
@register("valid_url", f"""
WITH u AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^[a-z]+://', '')
                  WHEN 2 THEN regexp_replace(url, '://[^/]*', ':///') WHEN 3 THEN replace(url, '://', '://[')
                  WHEN 4 THEN regexp_replace(url, '://[^/]*', '://[::1]:80') END AS url FROM pages)
SELECT page_id, url, page_id % 6 IN (0, 4) AS valid FROM u""")
def q_valid_url(spark, sf):
    url, i = F.col("url"), F.col("page_id") % 6
    changed = (F.when(i == 0, url).when(i == 1, F.regexp_replace(url, "^[a-z]+://", ""))
               .when(i == 2, F.regexp_replace(url, "://[^/]*", ":///")).when(i == 3, F.replace(url, F.lit("://"), F.lit("://[")))
               .when(i == 4, F.regexp_replace(url, "://[^/]*", "://[::1]:80")))
    return B.read_table(spark, sf, "pages").select("page_id", changed.alias("url")).withColumn(
        "valid", TX.valid_url(F.col("url")))


@register("url_parts", f"""
SELECT page_id, {S.url_netloc('url')} AS netloc, {S.url_path('url')} AS path,
       coalesce(nullif(lower({S.url_netloc('url')}), ''), 'unknown') AS host
FROM pages""")
def q_url_parts(spark, sf):
    p = B.read_table(spark, sf, "pages")
    return p.select("page_id", TX.url_netloc(F.col("url")).alias("netloc"),
                    TX.url_path(F.col("url")).alias("path"),
                    TX.host_of(F.col("url"), F.lit("unknown")).alias("host"))


@register("normalize_title", f"""
WITH {P}
SELECT page_id, title, {S.normalize_title('title')} AS norm_title FROM page_articles""")
def q_normalize_title(spark, sf):
    return B.page_articles(spark, sf).select("page_id", "title",
                                             TX.normalize_title(F.col("title")).alias("norm_title"))


@register("dedup_links", """
SELECT l_orderkey AS link, l_suppkey AS source_ord, l_linenumber AS item_ord, l_partkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_linenumber, l_partkey, l_quantity) AS rn
      FROM lineitem) WHERE rn = 1""")
def q_dedup_links(spark, sf):
    li = B.read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("link"), F.col("l_suppkey").alias("source_ord"),
        F.col("l_linenumber").alias("item_ord"), "l_partkey", "l_quantity")
    return dedup.dedup_links(li)


@register("raw_log_dedup", """
WITH batch AS (SELECT l_orderkey AS link, l_suppkey AS source_ord, l_linenumber AS item_ord, l_partkey
               FROM lineitem),
fresh AS (SELECT * FROM batch WHERE link NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
SELECT link, source_ord, item_ord, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY source_ord, item_ord, l_partkey) AS rn FROM fresh)
WHERE rn = 1""")
def q_raw_log_dedup(spark, sf):
    batch = B.read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("link"), F.col("l_suppkey").alias("source_ord"),
        F.col("l_linenumber").alias("item_ord"), "l_partkey")
    logged = B.read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("link"))
    return dedup.raw_log_dedup(batch, logged)


# ---------------------------------------------------------------------------------------------
# Quality checks
# ---------------------------------------------------------------------------------------------

@register("total_records", "SELECT CAST(count(*) AS BIGINT) AS total FROM documents")
def q_total_records(spark, sf):
    return quality.total_records(B.read_table(spark, sf, "documents"))


def _missing_sql():
    parts = [f"SELECT {S.q(f)} AS field, CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS missing, "
             f"CAST(count(*) AS BIGINT) AS total, "
             f"round(count(*) FILTER (WHERE {c}) * 100.0 / count(*), 1) AS pct FROM articles"
             for f, c in NULL_CONDITIONS.items()]
    return f"WITH {A}\n" + "\nUNION ALL\n".join(parts)


@register("missing_fields", _missing_sql())
def q_missing_fields(spark, sf):
    return quality.missing_fields(B.document_articles(spark, sf), NULL_CONDITIONS)


@register("duplicate_urls", """
SELECT l_orderkey AS url_value, CAST(count(*) AS BIGINT) AS cnt FROM lineitem
GROUP BY l_orderkey HAVING count(*) > 1 ORDER BY cnt DESC, url_value LIMIT 10""")
def q_duplicate_urls(spark, sf):
    return quality.duplicate_urls(B.read_table(spark, sf, "lineitem"), "l_orderkey", 10)


@register("text_lengths", f"""
WITH {A}
SELECT 'title' AS "column", avg(length(title)) AS avg_len, CAST(min(length(title)) AS BIGINT) AS min_len,
       CAST(max(length(title)) AS BIGINT) AS max_len FROM articles
UNION ALL
SELECT 'summary', avg(length(summary)), CAST(min(length(summary)) AS BIGINT),
       CAST(max(length(summary)) AS BIGINT) FROM articles""")
def q_text_lengths(spark, sf):
    return quality.text_lengths(B.document_articles(spark, sf), ["title", "summary"])


@register("language_distribution", f"""
SELECT lang AS language_value, CAST(count(*) AS BIGINT) AS cnt,
       coalesce(lang IS NOT NULL AND lang NOT IN ({", ".join(S.q(x) for x in sorted(ALLOWED_LANGS))}), false) AS invalid
FROM documents GROUP BY lang""")
def q_language_distribution(spark, sf):
    return quality.language_distribution(B.read_table(spark, sf, "documents"), "lang", ALLOWED_LANGS)


@register("allowed_language", f"""
SELECT doc_id, lang FROM documents
WHERE lang IS NOT NULL AND lang NOT IN ({", ".join(S.q(x) for x in sorted(ALLOWED_LANGS))})""")
def q_allowed_language(spark, sf):
    return quality.allowed_language(B.read_table(spark, sf, "documents"), "lang", ALLOWED_LANGS).select(
        "doc_id", "lang")


@register("date_range_check", f"""
SELECT min(ts) AS oldest, max(ts) AS newest,
       CAST(count(*) FILTER (WHERE ts > {S.ts(DATE_CHECK_AS_OF)}) AS BIGINT) AS future
FROM events""")
def q_date_range_check(spark, sf):
    return quality.date_range_check(B.read_table(spark, sf, "events"), "ts", DATE_CHECK_AS_OF)


def _quality_report_sql():
    langs = ", ".join(S.q(x) for x in sorted(ALLOWED_LANGS))
    scal = [f"SELECT 'total_records' AS \"check\", '*' AS field, CAST(count(*) AS DOUBLE) AS value FROM articles"]
    for f, c in NULL_CONDITIONS.items():
        scal.append(f"SELECT 'missing', {S.q(f)}, CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) FROM articles")
    for col in ("title", "summary"):
        scal.append(f"SELECT 'avg_len', '{col}', avg(length({col})) FROM articles")
        scal.append(f"SELECT 'min_len', '{col}', CAST(min(length({col})) AS DOUBLE) FROM articles")
        scal.append(f"SELECT 'max_len', '{col}', CAST(max(length({col})) AS DOUBLE) FROM articles")
    scal.append("SELECT 'oldest', 'published', epoch(min(published)) FROM articles")
    scal.append("SELECT 'newest', 'published', epoch(max(published)) FROM articles")
    scal.append(f"SELECT 'future', 'published', CAST(count(*) FILTER (WHERE published > {S.ts(DATE_CHECK_AS_OF)}) AS DOUBLE) FROM articles")
    scal.append("SELECT 'language', coalesce(category, 'NULL'), CAST(count(*) AS DOUBLE) FROM articles GROUP BY category")
    scal.append("SELECT 'duplicate_url', coalesce(CAST(url_value AS VARCHAR), 'NULL'), CAST(cnt AS DOUBLE) FROM ("
                "SELECT source AS url_value, count(*) AS cnt FROM articles GROUP BY source HAVING count(*) > 1 "
                "ORDER BY cnt DESC, url_value NULLS LAST LIMIT 10)")
    _ = langs
    return f"WITH {A}\n" + "\nUNION ALL\n".join(scal)


@register("quality_report", _quality_report_sql())
def q_quality_report(spark, sf):
    return quality.quality_report(
        B.document_articles(spark, sf), null_conditions=NULL_CONDITIONS,
        text_columns=["title", "summary"], language_column="category",
        allowed_languages=ALLOWED_LANGS, url_column="source", date_column="published",
        as_of=DATE_CHECK_AS_OF, dup_limit=10)


# ---------------------------------------------------------------------------------------------
# Entity JSON at the storage edge
# ---------------------------------------------------------------------------------------------

@register("decode_entities", f"""
WITH {A},
{S.hits_ctes(DEMO_ENTITIES)}
SELECT link, entity, string_agg(keyword, '|' ORDER BY keyword_ord) AS keywords
FROM hits GROUP BY link, entity""")
def q_decode_entities(spark, sf):
    """Round trip: match -> JSON text (as stored) -> tolerant decode -> long form."""
    m = ent.entity_match(B.document_articles(spark, sf), DEMO_ENTITIES)
    stored = m.select("link", EJ.encode_entities(F.col("matched_entities")).alias("entities_json"))
    dec = stored.select("link", TX.explode_rows(EJ.decode_entities(F.col("entities_json")))
                        .alias("entity", "kw")).filter(F.col("entity").isNotNull())
    return dec.select("link", "entity", F.array_join("kw", "|").alias("keywords"))


@register("decode_props", """
SELECT event_id,
       CAST(len(list_filter(json_keys(props), lambda k: json_type(props, '$."' || k || '"') = 'ARRAY')) AS INTEGER) AS n_lists
FROM events""")
def q_decode_props(spark, sf):
    ev = B.read_table(spark, sf, "events")
    return ev.select("event_id", F.size(EJ.decode_entities(F.col("props"))).alias("n_lists"))


# ---------------------------------------------------------------------------------------------
# Full-text search
# ---------------------------------------------------------------------------------------------
from tidewatch.functions import nlq  # noqa: E402
from tidewatch.operators import search as FTS  # noqa: E402
from tidewatch.plans import search_plan  # noqa: E402

# --- fixed values: search parameters -------------------------------------------------------
BM25_QUERY = "que el"
BM25_COMMON_QUERY = "the and"
BM25_LIMIT = 20
PHRASE = "de la"
PREFIX = "ouen"
MATCH_ALL = "the of"
SEARCH_QUERY = "last 20 days top 7 que el"
# -------------------------------------------------------------------------------------------


def search_docs(spark, sf, spread_rows: bool = True):
    """Search corpus bound from documents: (link, title, body).  A full postings build
    partitions by link itself, so it skips the round-robin spread."""
    arts = B.articles_from_documents(B.read_table(spark, sf, "documents", spread_rows=spread_rows))
    return arts.select("link", "title", F.col("summary").alias("body"))


_INDEXES: dict[tuple, str] = {}


def index_path(spark, sf):
    """Folder of the search index over ``documents``: written once per application and state of
    the table (its files and their times), in the shared folder, and read by every search query."""
    files = B.read_table(spark, sf, "documents").inputFiles()
    state = tuple(sorted((f, STORE.modified(spark, f)) for f in files))
    where = (spark.sparkContext.applicationId, sf, state)
    if where not in _INDEXES:
        path = _result_path(spark, "search-index")
        FTS.write_index(search_docs(spark, sf, spread_rows=False), path)
        _INDEXES[where] = path
    return _INDEXES[where]


def stored_index(spark, sf):
    """(postings, documents, statistics) of the stored search index."""
    path = index_path(spark, sf)
    return (*FTS.read_index(spark, path), FTS.read_stats(spark, path))


def _tok_sql():
    fold = "lower(strip_accents(coalesce({}, '')))"
    pat = r"'[\p{L}\p{N}\p{Co}]+'"
    return (f"tok AS (SELECT link, regexp_extract_all({fold.format('title')}, {pat}) AS tt, "
            f"regexp_extract_all({fold.format('summary')}, {pat}) AS bt FROM articles)")


def _bm25_ctes(terms):
    fs = ", ".join(f"len(list_filter(tt, lambda x: x = {S.q(t)})) + len(list_filter(bt, lambda x: x = {S.q(t)})) AS f{i}"
                   for i, t in enumerate(terms))
    ns = ", ".join(f"count(*) FILTER (WHERE f{i} > 0) AS n{i}" for i in range(len(terms)))
    idf = ", ".join(f"CASE WHEN ln((n - n{i} + 0.5) / (n{i} + 0.5)) <= 0 THEN 1e-6 "
                    f"ELSE ln((n - n{i} + 0.5) / (n{i} + 0.5)) END AS i{i}" for i in range(len(terms)))
    score = " + ".join(f"i{i} * f{i} * 2.2 / (f{i} + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))"
                       for i in range(len(terms)))
    cond = " AND ".join(f"f{i} > 0" for i in range(len(terms)))
    return f"""{A},
{_tok_sql()},
d AS (SELECT link, len(tt) + len(bt) AS dl, {fs} FROM tok),
st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avgdl, {ns} FROM d),
idf AS (SELECT n, avgdl, {idf} FROM st),
sc AS (SELECT d.link, -({score}) AS rank FROM d, idf WHERE {cond})"""


def _bm25_sql(terms, limit):
    return f"""WITH {_bm25_ctes(terms)}
SELECT link, round(rank, 6) AS rank FROM sc ORDER BY sc.rank, link LIMIT {limit}"""


def _bm25_spark(spark, sf, query, limit):
    postings, _, stats = stored_index(spark, sf)
    blocks = FTS.read_blocks(spark, index_path(spark, sf))
    top, _ = FTS.bm25_topk_blocks(postings, blocks, stats, FTS.query_terms(query), limit, buckets=FTS.DEFAULT_BUCKETS)
    return top.select("link", F.round("rank", 6).alias("rank"))


@register("bm25_scan", _bm25_sql(FTS.query_terms(BM25_QUERY), BM25_LIMIT))
def q_bm25_scan(spark, sf):
    """Same ranking straight from the texts, for a corpus without an index."""
    top = FTS.bm25_scan(search_docs(spark, sf), FTS.query_terms(BM25_QUERY), BM25_LIMIT)
    return top.select("link", F.round("rank", 6).alias("rank"))


@register("bm25_topk_postings", _bm25_sql(FTS.query_terms(BM25_QUERY), BM25_LIMIT))
def q_bm25_topk_postings(spark, sf):
    """Same ranking through postings of the query's terms, built for the query."""
    docs = search_docs(spark, sf)
    terms = FTS.query_terms(BM25_QUERY)
    top = FTS.bm25_topk(FTS.fts_postings(docs, terms=terms), FTS.doc_stats(docs), terms, BM25_LIMIT)
    return top.select("link", F.round("rank", 6).alias("rank"))


@register("bm25_topk", _bm25_sql(FTS.query_terms(BM25_QUERY), BM25_LIMIT))
def q_bm25_topk(spark, sf):
    return _bm25_spark(spark, sf, BM25_QUERY, BM25_LIMIT)


@register("bm25_topk_common", _bm25_sql(FTS.query_terms(BM25_COMMON_QUERY), BM25_LIMIT))
def q_bm25_topk_common(spark, sf):
    """Terms present in most documents: exercises the idf floor."""
    return _bm25_spark(spark, sf, BM25_COMMON_QUERY, BM25_LIMIT)


@register("fts_match_all", f"""WITH {A},
{_tok_sql()}
SELECT link FROM tok WHERE {" AND ".join(f"list_contains(tt || bt, {S.q(t)})" for t in FTS.query_terms(MATCH_ALL))}""")
def q_fts_match_all(spark, sf):
    return FTS.fts_match_all(stored_index(spark, sf)[0], FTS.query_terms(MATCH_ALL), buckets=FTS.DEFAULT_BUCKETS)


@register("fts_any", f"""WITH {A},
{_tok_sql()}
SELECT link FROM tok WHERE {" OR ".join(f"list_contains(tt || bt, {S.q(t)})" for t in FTS.query_terms(BM25_QUERY))}""")
def q_fts_any(spark, sf):
    return FTS.fts_any(stored_index(spark, sf)[0], FTS.query_terms(BM25_QUERY), buckets=FTS.DEFAULT_BUCKETS)


@register("fts_prefix", f"""WITH {A},
{_tok_sql()}
SELECT link FROM tok WHERE len(list_filter(tt || bt, lambda x: starts_with(x, {S.q(PREFIX)}))) > 0""")
def q_fts_prefix(spark, sf):
    return FTS.fts_prefix(stored_index(spark, sf)[0], PREFIX, lexicon=FTS.read_lexicon(spark, index_path(spark, sf)))


@register("fts_phrase", f"""WITH {A},
{_tok_sql()}
SELECT link FROM tok
WHERE ' ' || array_to_string(tt, ' ') || ' ' LIKE {S.q('% ' + PHRASE + ' %')}
   OR ' ' || array_to_string(bt, ' ') || ' ' LIKE {S.q('% ' + PHRASE + ' %')}""")
def q_fts_phrase(spark, sf):
    return FTS.fts_phrase(stored_index(spark, sf)[0], FTS.query_terms(PHRASE), buckets=FTS.DEFAULT_BUCKETS)


@register("fts_postings", f"""WITH {A},
{_tok_sql()},
toks AS (SELECT link, unnest(tt || bt) AS term FROM tok)
SELECT term, CAST(count(DISTINCT link) AS BIGINT) AS doc_freq, CAST(count(*) AS BIGINT) AS total_tf
FROM toks GROUP BY term""")
def q_fts_postings(spark, sf):
    post = stored_index(spark, sf)[0]
    return FTS.term_counts(post)


_SP = nlq.parse_query(SEARCH_QUERY)


@register("search", f"""WITH {_bm25_ctes(FTS.query_terms(_SP.search_text))},
top AS (SELECT link, rank FROM sc ORDER BY rank, link LIMIT {_SP.limit})
SELECT t.link, a.title, round(t.rank, 6) AS rank FROM top t JOIN articles a ON a.link = t.link
WHERE a.collected_at >= {S.cutoff(_SP.days)}""")
def q_search(spark, sf):
    arts = B.document_articles(spark, sf)
    postings, docs, stats = stored_index(spark, sf)
    res = search_plan.search_documents(docs, arts, SEARCH_QUERY, AS_OF, 20, postings, stats, FTS.DEFAULT_BUCKETS,
                                       blocks=FTS.read_blocks(spark, index_path(spark, sf)))
    return res.select("link", "title", F.round("rank", 6).alias("rank"))


@register("snippet")
def q_snippet(spark, sf):
    """Search results with snippets (own window rule; checked by tests, not by SQL)."""
    arts = B.document_articles(spark, sf)
    postings, docs, stats = stored_index(spark, sf)
    res = search_plan.search_documents(docs, arts, BM25_QUERY, AS_OF, 20, postings, stats, FTS.DEFAULT_BUCKETS,
                                       with_snippets=True)
    return res.select("link", "title", F.round("rank", 6).alias("rank"), "snippet")


@register("filter_links_by_days", f"""WITH {A},
{_tok_sql()},
hits AS (SELECT link FROM tok WHERE {" OR ".join(f"list_contains(tt || bt, {S.q(t)})" for t in FTS.query_terms(BM25_QUERY))})
SELECT h.link FROM hits h WHERE h.link IN (SELECT link FROM articles WHERE collected_at >= {S.cutoff(COLLECTED_DAYS)})""")
def q_filter_links_by_days(spark, sf):
    hits = FTS.fts_any(stored_index(spark, sf)[0], FTS.query_terms(BM25_QUERY), buckets=FTS.DEFAULT_BUCKETS)
    recent_links = recent.collected_since(B.document_articles(spark, sf), AS_OF, COLLECTED_DAYS)
    return hits.join(recent_links.select("link"), "link", "left_semi")


# --- fixed values: phrases planted in user turns, by conv_id mod 5 ----------------------------
PLANTED = {0: ("", " last 3 weeks top 5"), 1: ("최근 10일 ", " last 2 days"), 2: ("7개 ", " TOP 4 LAST 1 Month"),
           3: ("blast 3 days ", " top12"), 4: ("", "")}
PLANTED_DAYS = {0: 21, 1: 10, 2: 30}
PLANTED_LIMIT = {0: 5, 2: 7}
PLANTED_REST = {0: ("", ""), 1: ("", " last 2 days"), 2: ("", " TOP 4"), 3: ("blast 3 days ", " top12"), 4: ("", "")}
# -------------------------------------------------------------------------------------------


def _by_conv(values: dict, k: int | None = None) -> str:
    pick = {i: (v if k is None else v[k]) for i, v in values.items()}
    return "CASE conv_id % 5 " + " ".join(
        f"WHEN {i} THEN {S.q(v) if isinstance(v, str) else v}" for i, v in pick.items()) + " END"


@register("nl_parse", f"""
SELECT conv_id, turn, {S.collapse(f"{_by_conv(PLANTED_REST, 0)} || text || {_by_conv(PLANTED_REST, 1)}")} AS search_text,
       CAST({_by_conv(PLANTED_DAYS)} AS BIGINT) AS days, CAST({_by_conv(PLANTED_LIMIT)} AS BIGINT) AS "limit"
FROM conversations WHERE role = 'user'""")
def q_nl_parse(spark, sf):
    """Parse every user turn of the conversation log, with planted phrases, as a search query."""
    conv = B.read_table(spark, sf, "conversations").filter(F.col("role") == "user")
    text = F.concat(F.expr(_by_conv(PLANTED, 0)), F.col("text"), F.expr(_by_conv(PLANTED, 1)))
    return conv.select("conv_id", "turn", nlq.nl_parse(text).alias("p")).select(
        "conv_id", "turn", "p.search_text", "p.days", "p.limit")


# ---------------------------------------------------------------------------------------------
# Near duplicates
# ---------------------------------------------------------------------------------------------
from tidewatch.operators import similarity as SIM  # noqa: E402


@register("duplicate_groups", f"""WITH {P},
g AS (SELECT link, {S.url_netloc('link')} AS netloc, {S.url_path('link')} AS path,
             {S.normalize_title('title')} AS norm_title FROM page_articles)
SELECT link, netloc, path, norm_title,
       min(link) OVER (PARTITION BY netloc, path, norm_title) AS representative,
       CAST(count(*) OVER (PARTITION BY netloc, path, norm_title) AS BIGINT) AS group_size
FROM g""")
def q_duplicate_groups(spark, sf):
    return SIM.duplicate_groups(B.page_articles(spark, sf))


@register("duplicate_pairs")
def q_duplicate_pairs(spark, sf):
    """Near-duplicate page pairs (exactness checked against all-pairs difflib in tests)."""
    return SIM.duplicate_pairs(B.page_articles(spark, sf))


# variants of a page's URL, by page_id mod 4: same path, other host, far path, near path
FAR_TAIL, NEAR_TAIL = "/" + "z" * 40, "~"


@register("similar_url", f"""
WITH p AS (SELECT page_id, url AS u1, {S.url_netloc("url")} AS host, {S.url_path("url")} AS path,
                  regexp_replace(url, '[?#].*$', '') AS plain FROM pages)
SELECT page_id, u1, CASE page_id % 4 WHEN 0 THEN u1 || '?from=list' WHEN 1 THEN replace(u1, '://', '://mirror.')
                                     WHEN 2 THEN plain || '{FAR_TAIL}' ELSE plain || '{NEAR_TAIL}' END AS u2,
       CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN false
            WHEN 2 THEN 2.0 * length(path) / (2 * length(path) + {len(FAR_TAIL)}) >= {SIM.URL_THRESHOLD}
            ELSE 2.0 * length(path) / (2 * length(path) + {len(NEAR_TAIL)}) >= {SIM.URL_THRESHOLD} END AS similar_url
FROM p""")
def q_similar_url(spark, sf):
    """Pages paired with a variant of their own URL: URL similarity flag."""
    url, i = F.col("url"), F.col("page_id") % 4
    plain = F.regexp_replace(url, "[?#].*$", "")
    variant = (F.when(i == 0, F.concat(url, F.lit("?from=list"))).when(i == 1, F.replace(url, F.lit("://"), F.lit("://mirror.")))
               .when(i == 2, F.concat(plain, F.lit(FAR_TAIL))).otherwise(F.concat(plain, F.lit(NEAR_TAIL))))
    pages = B.read_table(spark, sf, "pages").select("page_id", url.alias("u1"), variant.alias("u2"))
    return SIM.similar_url_pairs(pages, "u1", "u2")


TITLE_TAIL = " 0_0"  # no title ends so


@register("title_ratio", f"""WITH {P}, t AS (SELECT page_id, length({S.normalize_title("title")}) AS n FROM page_articles)
SELECT page_id, round(2.0 * n / (2 * n + {len(TITLE_TAIL)}), 6) AS ratio FROM t""")
def q_title_ratio(spark, sf):
    """Ratio between each page title and the title with a few characters more (the statement holds
    for titles below 196 characters, from which difflib leaves out frequent characters)."""
    t = B.page_articles(spark, sf).select("page_id", TX.normalize_title(F.col("title")).alias("t1"))
    t = t.withColumn("t2", F.concat("t1", F.lit(TITLE_TAIL)))
    return t.select("page_id", F.round(SIM.seq_ratio("t1", "t2"), 6).alias("ratio"))


# every page twice on one host under a title that is its own: a digest, and the digest with a tail
HOT_HOST, HOT_TAIL = "https://hot.example/article/number-", " copy"


@register("duplicate_pairs_hot_host", f"""
WITH p AS (SELECT '{HOT_HOST}' || page_id AS link FROM pages)
SELECT link AS link_a, link || '-2' AS link_b, round(2.0 * 32 / (2 * 32 + {len(HOT_TAIL)}), 6) AS title_ratio FROM p""")
def q_duplicate_pairs_hot_host(spark, sf):
    """Near-duplicate pairs where all articles share one host: unrelated titles and one near copy of each."""
    link = F.concat(F.lit(HOT_HOST), F.col("page_id").cast("string"))
    own = F.md5(link.cast("binary"))
    pages = B.read_table(spark, sf, "pages").select(link.alias("link"), own.alias("title"))
    copies = pages.select(F.concat("link", F.lit("-2")).alias("link"), F.concat("title", F.lit(HOT_TAIL)).alias("title"))
    return SIM.duplicate_pairs(pages.unionByName(copies))


# ---------------------------------------------------------------------------------------------
# Storage: merge by link, retention, raw log records, search-document upsert
# ---------------------------------------------------------------------------------------------
from tidewatch.functions.entities_json import EMPTY_MAP  # noqa: E402
from tidewatch.sinks import raw_log as RAW  # noqa: E402
from tidewatch.sinks import store as STORE  # noqa: E402

# --- fixed values: storage parameters ------------------------------------------------------
RECOLLECT_AT = B.dt.datetime(2024, 2, 1, 6, 0, 0)
RETAIN_DAYS = 20
LOGGED_AT = B.dt.datetime(2024, 2, 1, 6, 0, 0)
# -------------------------------------------------------------------------------------------

MERGE_COLS = ["category", "source", "title", "link", "summary", "published", "collected_at"]


def _recollection_batch(spark, sf):
    """A re-crawl of every document (titles prefixed, German dates lost), Spanish rows seen
    twice (a draft first), and every page seen twice (second copy from a mirror)."""
    empty = F.create_map().cast(EMPTY_MAP).alias("matched_entities")

    def copy(title, source, published, ord_):
        return F.struct(title.alias("title"), source.alias("source"), published.alias("published"), F.lit(ord_).alias("batch_ord"))

    title, source, published = F.col("title"), F.col("source"), F.col("published")
    lost = F.when(F.col("category") == "de", F.lit(None).cast("timestamp_ntz")).otherwise(published)
    again, draft = copy(F.concat(F.lit("re: "), title), source, lost, 1), copy(F.lit("draft"), source, published, 0)
    mirror = copy(F.concat(title, F.lit(" (mirror)")), F.concat(F.lit("mirror:"), source), published, 1)
    copies = ((B.document_articles(spark, sf), F.when(F.col("category") == "es", F.array(again, draft)).otherwise(F.array(again))),
              (B.page_articles(spark, sf), F.array(copy(title, source, published, 0), mirror)))
    # each table is read, and each page's text found, once
    seen = [rows.select("category", "link", "summary", TX.explode_rows(c).alias("c")).select(
        "category", "c.source", "c.title", "link", "summary", "c.published", empty, "c.batch_ord") for rows, c in copies]
    return seen[0].unionByName(seen[1])


_BATCH_SQL = f"""cur AS (SELECT category, source, title, link, summary, published, collected_at FROM articles),
batch AS (
  SELECT category, source, 're: ' || title AS title, link, summary,
         CASE WHEN category = 'de' THEN NULL ELSE published END AS published, 1 AS ord FROM articles
  UNION ALL SELECT category, source, 'draft', link, summary, published, 0 FROM articles WHERE category = 'es'
  UNION ALL SELECT category, source, title, link, summary, published, 0 FROM page_articles
  UNION ALL SELECT category, 'mirror:' || source, title || ' (mirror)', link, summary, published, 1 FROM page_articles),
ranked AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY ord) AS rf,
                     row_number() OVER (PARTITION BY link ORDER BY ord DESC) AS rl FROM batch),
b AS (SELECT f.link, f.category, f.source, l.title, l.summary, l.published
      FROM ranked f JOIN ranked l ON f.link = l.link AND f.rf = 1 AND l.rl = 1)"""


@register("upsert_articles", f"""WITH {A}, {P},
{_BATCH_SQL}
SELECT coalesce(c.category, b.category) AS category, coalesce(c.source, b.source) AS source,
       CASE WHEN b.link IS NOT NULL THEN b.title ELSE c.title END AS title,
       coalesce(c.link, b.link) AS link,
       CASE WHEN b.link IS NOT NULL THEN b.summary ELSE c.summary END AS summary,
       CASE WHEN b.link IS NOT NULL THEN b.published ELSE c.published END AS published,
       CASE WHEN b.link IS NOT NULL THEN {S.ts(RECOLLECT_AT)} ELSE c.collected_at END AS collected_at
FROM cur c FULL OUTER JOIN b ON c.link = b.link""")
def q_upsert_articles(spark, sf):
    cur = B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP))
    merged = STORE.merge_articles(cur, _recollection_batch(spark, sf), RECOLLECT_AT)
    return merged.select(*MERGE_COLS)


@register("upsert_articles_broadcast", ORACLE["upsert_articles"])
def q_upsert_articles_broadcast(spark, sf):
    """Same merge as the table's own upsert plans it: the batch is broadcast only if its
    measured rows and bytes are within the limits."""
    cur = B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP))
    batch = _recollection_batch(spark, sf)
    merged = STORE.merge_articles(cur, batch, RECOLLECT_AT, broadcast_batch=STORE.measure_batch(batch).small)
    return merged.select(*MERGE_COLS)


@register("upsert_articles_stored", ORACLE["upsert_articles"])
def q_upsert_articles_stored(spark, sf):
    """The same batch merged into a stored table; the rows of its second version."""
    root = _result_path(spark, "upserted")
    STORE.create_table(B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP)), root)
    STORE.upsert_articles(spark, root, _recollection_batch(spark, sf), RECOLLECT_AT)
    return STORE.read_articles(spark, root).select(*MERGE_COLS)


@register("snapshot_articles", f"""WITH {A}, v AS (
  SELECT 'snapshot' AS kind, link, title FROM articles
  UNION ALL SELECT 'newest', link, 're: ' || title FROM articles)
SELECT kind, link, title FROM v""")
def q_snapshot_articles(spark, sf):
    """A snapshot read after every row was replaced and the version it was taken of was dropped."""
    root, snap = _result_path(spark, "snapped"), _result_path(spark, "snapshots")
    arts = B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP))
    STORE.create_table(arts, root)
    path = STORE.snapshot_articles(spark, root, snap, LOGGED_AT.date())
    again = arts.withColumn("title", F.concat(F.lit("re: "), F.col("title"))).withColumn("batch_ord", F.lit(0))
    STORE.upsert_articles(spark, root, again, RECOLLECT_AT)
    STORE.prune_versions(spark, root, keep=1)
    parts = (("snapshot", STORE.read_snapshot(spark, path)), ("newest", STORE.read_articles(spark, root)))
    frames = [f.select(F.lit(kind).alias("kind"), "link", "title") for kind, f in parts]
    return frames[0].unionByName(frames[1])


@register("assert_not_null", f"""WITH {FAULTY}
SELECT category, source, title, link, category + source + title + link > 0 AS rejected FROM (
  SELECT CAST(count(*) FILTER (WHERE category IS NULL) AS BIGINT) AS category,
         CAST(count(*) FILTER (WHERE source IS NULL) AS BIGINT) AS source,
         CAST(count(*) FILTER (WHERE title IS NULL) AS BIGINT) AS title,
         CAST(count(*) FILTER (WHERE link IS NULL) AS BIGINT) AS link FROM faulty)""")
def q_assert_not_null(spark, sf):
    """The operator's counts on rows with planted NULLs, and whether it rejects them."""
    rows = faulty_articles(spark, sf)
    counts = validate.null_counts(rows, list(STORE.NOT_NULL))
    try:
        validate.assert_not_null(rows, list(STORE.NOT_NULL))
        rejected = False
    except ValueError:
        rejected = True
    return counts.withColumn("rejected", F.lit(rejected))


@register("retain_articles", f"""WITH {A}
SELECT link, coalesce(published, collected_at) AS effective_time FROM articles
WHERE coalesce(published, collected_at) >= {S.cutoff(RETAIN_DAYS)}""")
def q_retain_articles(spark, sf):
    """Documents written as a table; retention writes the next version; its rows."""
    root = _result_path(spark, "retained")
    arts = B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP))
    STORE.create_table(arts, root)
    STORE.retain_articles(spark, root, AS_OF, RETAIN_DAYS)
    return STORE.read_articles(spark, root).select("link", "effective_time")


@register("expired_rows", f"""WITH {A}
SELECT link, coalesce(published, collected_at) AS effective_time FROM articles
WHERE coalesce(published, collected_at) < {S.cutoff(RETAIN_DAYS)}""")
def q_expired_rows(spark, sf):
    exp = STORE.expired_rows(B.document_articles(spark, sf), AS_OF, RETAIN_DAYS)
    return exp.select("link", B.effective_time(F.col("published"), F.col("collected_at")).alias("effective_time"))


@register("raw_log", f"""WITH {A},
runs AS (SELECT link, source FROM articles UNION SELECT link, 'mirror/' || source FROM articles WHERE doc_id % 2 = 0)
SELECT regexp_replace(source, '[/\\\\]', '_', 'g') AS source_safe, source, link, '{LOGGED_AT.date()}' AS log_date FROM runs""")
def q_raw_log(spark, sf):
    """Every document logged twice in one run, and half of them by a mirror source: one record
    per source and link is left in the log."""
    where = _result_path(spark, "raw-log")
    arts = B.document_articles(spark, sf)
    RAW.write_raw_log(spark, arts, where, LOGGED_AT, run_id="r1")
    mirror = arts.filter(F.col("doc_id") % 2 == 0).withColumn("source", F.concat(F.lit("mirror/"), F.col("source")))
    RAW.write_raw_log(spark, arts.unionByName(mirror), where, LOGGED_AT, run_id="r1")
    return RAW.read_raw_log(spark, where).select(
        "source_safe", "source", "link", F.col("log_date").cast("string").alias("log_date"))


@register("storage_policy", f"""WITH {A},
days AS (SELECT doc_id, DATE '{LOGGED_AT.date()}' - CAST(doc_id % 3 AS INTEGER) * 10 AS log_date FROM articles)
SELECT 'raw' AS kind, CAST(log_date AS VARCHAR) AS at, CAST(count(*) AS BIGINT) AS n FROM days
WHERE log_date >= DATE '{LOGGED_AT.date()}' - 15 GROUP BY log_date
UNION ALL SELECT 'snapshot', '{LOGGED_AT.date()}', CAST(count(*) AS BIGINT) FROM articles
UNION ALL SELECT 'removed', 'raw', 1""")
def q_storage_policy(spark, sf):
    """Raw logs of three days and a table: the policy takes a snapshot and drops the oldest day."""
    raw, root, snap = (_result_path(spark, n) for n in ("policy-raw", "policy-table", "policy-snapshot"))
    arts = B.document_articles(spark, sf).withColumn("matched_entities", F.create_map().cast(EMPTY_MAP))
    for k in range(3):
        RAW.write_raw_log(spark, arts.filter(F.col("doc_id") % 3 == k), raw, LOGGED_AT - B.dt.timedelta(days=10 * k))
    STORE.create_table(arts, root)
    done = STORE.storage_policy(spark, root=root, raw_dir=raw, snapshot_root=snap, keep_raw_days=15,
                                today=LOGGED_AT.date(), snapshot=True)
    logged = RAW.read_raw_log(spark, raw).groupBy(F.lit("raw").alias("kind"), F.col("log_date").cast("string").alias("at"))
    kept = STORE.read_snapshot(spark, done["snapshot_path"]).groupBy(
        F.lit("snapshot").alias("kind"), F.lit(done["snapshot_path"].rpartition("=")[2]).alias("at"))
    counts = [g.agg(F.count(F.lit(1)).cast("bigint").alias("n")) for g in (logged, kept)]
    removed = spark.createDataFrame([("removed", "raw", done["raw_removed"])], "kind string, at string, n long")
    return counts[0].unionByName(counts[1]).unionByName(removed)


@register("raw_records", f"""WITH {A}
SELECT title, link, summary, strftime(published, '%Y-%m-%dT%H:%M:%S') AS published, source, category,
       {S.q(LOGGED_AT.isoformat())} AS logged_at, {S.q(LOGGED_AT.date().isoformat())} AS log_date,
       regexp_replace(source, '[/\\\\]', '_', 'g') AS source_safe
FROM articles""")
def q_raw_records(spark, sf):
    return RAW.raw_records(B.document_articles(spark, sf), LOGGED_AT).drop("matched_entities")


@register("upsert_documents", f"""WITH {A}, {P},
docs AS (SELECT link, title, summary AS body FROM articles),
incoming AS (SELECT link, title, summary AS body FROM page_articles
             UNION ALL SELECT link, 're: ' || title, summary FROM articles WHERE category = 'fr')
SELECT link, title, body FROM docs WHERE link NOT IN (SELECT link FROM incoming)
UNION ALL SELECT link, title, body FROM incoming""")
def q_upsert_documents(spark, sf):
    docs = search_docs(spark, sf)
    pages = B.page_articles(spark, sf).select("link", "title", F.col("summary").alias("body"))
    fr = (B.document_articles(spark, sf).filter(F.col("category") == "fr")
          .select("link", F.concat(F.lit("re: "), F.col("title")).alias("title"), F.col("summary").alias("body")))
    from tidewatch.operators.index_upkeep import upsert_documents
    return upsert_documents(docs, pages.unionByName(fr))


@register("maintain_postings", f"""WITH {A}, {P},
docs AS (SELECT link, title, summary FROM articles WHERE link NOT IN (SELECT link FROM articles WHERE category = 'fr')
         UNION ALL SELECT link, 're: ' || title, summary FROM articles WHERE category = 'fr'
         UNION ALL SELECT link, title, summary FROM page_articles),
tok AS (SELECT link, regexp_extract_all(lower(strip_accents(coalesce(title, ''))), '[\\p{{L}}\\p{{N}}\\p{{Co}}]+') AS tt,
               regexp_extract_all(lower(strip_accents(coalesce(summary, ''))), '[\\p{{L}}\\p{{N}}\\p{{Co}}]+') AS bt FROM docs),
toks AS (SELECT link, unnest(tt || bt) AS term FROM tok)
SELECT term, CAST(count(DISTINCT link) AS BIGINT) AS doc_freq, CAST(count(*) AS BIGINT) AS total_tf
FROM toks GROUP BY term""")
def q_maintain_postings(spark, sf):
    from tidewatch.operators.index_upkeep import maintain_postings
    docs = search_docs(spark, sf, spread_rows=False)
    postings = FTS.fts_postings(docs)
    pages = B.page_articles(spark, sf).select("link", "title", F.col("summary").alias("body"))
    fr = (B.document_articles(spark, sf).filter(F.col("category") == "fr")
          .select("link", F.concat(F.lit("re: "), F.col("title")).alias("title"), F.col("summary").alias("body")))
    new_post = maintain_postings(postings, pages.unionByName(fr))
    return FTS.term_counts(new_post)


@register("index_segments", ORACLE["maintain_postings"])
def q_index_segments(spark, sf):
    """The same batches written as segments of a stored index; the terms of its live postings."""
    from tidewatch.operators import index_upkeep
    root = _result_path(spark, "segments")
    pages = B.page_articles(spark, sf).select("link", "title", F.col("summary").alias("body"))
    fr = (B.document_articles(spark, sf).filter(F.col("category") == "fr")
          .select("link", F.concat(F.lit("re: "), F.col("title")).alias("title"), F.col("summary").alias("body")))
    for batch in (search_docs(spark, sf, spread_rows=False), pages, fr):
        index = index_upkeep.update_index(spark, root, batch)
    live = index_upkeep.read_segments(spark, index)[0]
    return FTS.term_counts(live)


# ---------------------------------------------------------------------------------------------
# Report rollups
# ---------------------------------------------------------------------------------------------
from tidewatch.operators import rollups as R  # noqa: E402

# --- fixed values: rollup parameters -------------------------------------------------------
SUMMARY_CATEGORY = "en"
SUMMARY_SEARCH = "phrase"
SUMMARY_KEEP_DAYS = 10
SUMMARY_TODAY = B.dt.date(2024, 1, 31)
HEALTH_OK_MIN_DELAY = 2.0
HEALTH_DISABLE_AFTER = 3
SUPPORTED_TYPES = ("rss", "met_museum", "aic", "smithsonian")
# -------------------------------------------------------------------------------------------


def matched_articles(spark, sf):
    return ent.entity_match(B.document_articles(spark, sf), DEMO_ENTITIES)


def summaries(spark, sf):
    return R.daily_summary(matched_articles(spark, sf))


H = S.hits_ctes(DEMO_ENTITIES)
_SUMMARY_CTES = f"""{A},
{H},
art AS (SELECT a.link, strftime(a.collected_at, '%Y-%m-%d') AS date, a.category, a.source,
               a.link IN (SELECT link FROM hits) AS matched FROM articles a),
base AS (SELECT date, category, CAST(count(*) AS BIGINT) AS article_count,
                CAST(count(DISTINCT source) AS BIGINT) AS source_count,
                CAST(count(*) FILTER (WHERE matched) AS BIGINT) AS matched_count FROM art GROUP BY date, category),
src AS (SELECT date, category, string_agg(source || ':' || CAST(n AS VARCHAR), '|' ORDER BY source) AS sources
        FROM (SELECT date, category, source, count(*) AS n FROM art GROUP BY date, category, source)
        GROUP BY date, category),
ent_c AS (SELECT art.date, art.category, h.entity, count(*) AS c FROM hits h JOIN art ON art.link = h.link
          GROUP BY art.date, art.category, h.entity),
ent AS (SELECT date, category, string_agg(entity || ':' || CAST(c AS VARCHAR), '|' ORDER BY c DESC, entity) AS top_entities,
               list(entity ORDER BY c DESC, entity) AS names
        FROM ent_c GROUP BY date, category),
summ AS (SELECT b.date, b.category, b.article_count, b.source_count, b.matched_count,
                coalesce(e.top_entities, '') AS top_entities, s.sources, coalesce(e.names, []) AS names
         FROM base b JOIN src s USING (date, category) LEFT JOIN ent e USING (date, category))"""


@register("daily_summary", f"""WITH {_SUMMARY_CTES}
SELECT date, category, article_count, source_count, matched_count, top_entities, sources FROM summ""")
def q_daily_summary(spark, sf):
    return R.flatten_summary(summaries(spark, sf))


@register("daily_summary_stored", "WITH " + _SUMMARY_CTES.replace(
    "strftime(a.collected_at, '%Y-%m-%d')",
    f"CASE WHEN a.category = 'fr' THEN '{RECOLLECT_AT.date()}' ELSE strftime(a.collected_at, '%Y-%m-%d') END") + """
SELECT date, category, article_count, source_count, matched_count, top_entities, sources FROM summ""")
def q_daily_summary_stored(spark, sf):
    """Partials stored by day; all French rows are collected again, and only the days that they
    left and the day that they moved to are renewed."""
    root = _result_path(spark, "partials")
    arts = matched_articles(spark, sf)
    R.update_partials(arts, root)
    french = F.col("category") == "fr"
    touched = {r[0] for r in arts.filter(french).select(R.day_of(F.col("collected_at"))).distinct().collect()}
    again = arts.withColumn("collected_at", F.when(french, B.ts_lit(RECOLLECT_AT)).otherwise(F.col("collected_at")))
    R.update_partials(again, root, sorted(touched | {RECOLLECT_AT.date().isoformat()}))
    return R.flatten_summary(R.finish_summary(R.read_partials(spark, root)))


@register("portfolio_stats", f"""WITH {_SUMMARY_CTES},
r AS (SELECT date, category, article_count,
             coalesce(matched_count / nullif(article_count, 0), 0.0) AS rate FROM summ)
SELECT CAST(count(*) AS BIGINT) AS total_reports, CAST(sum(article_count) AS BIGINT) AS total_articles,
       round((SELECT rate FROM r ORDER BY date DESC, category DESC LIMIT 1) * 100, 6) AS latest_match_rate,
       round(avg(rate) * 100, 6) AS avg_match_rate
FROM r""")
def q_portfolio_stats(spark, sf):
    return R.portfolio_stats(summaries(spark, sf), decimals=6)


@register("summary_trend", f"""WITH {_SUMMARY_CTES}
SELECT date, article_count, names[1] AS top_entity FROM summ
WHERE category = {S.q(SUMMARY_CATEGORY)}
  AND (SELECT count(*) FROM summ WHERE category = {S.q(SUMMARY_CATEGORY)}) >= 3""")
def q_summary_trend(spark, sf):
    return R.summary_trend(summaries(spark, sf), SUMMARY_CATEGORY)


@register("summary_top_tags", f"""WITH {_SUMMARY_CTES}
SELECT date, category, array_to_string(names[1:3], '|') AS top_tags FROM summ""")
def q_summary_top_tags(spark, sf):
    return R.summary_top_tags(summaries(spark, sf)).select(
        "date", "category", F.array_join(F.transform("top_tags", lambda e: e["name"]), "|").alias("top_tags"))


@register("summary_search", f"""WITH {_SUMMARY_CTES}
SELECT date, category FROM summ
WHERE contains(lower(category || ' ' || date || ' ' || array_to_string(names, ' ')), {S.q(SUMMARY_SEARCH)})""")
def q_summary_search(spark, sf):
    return R.summary_search(summaries(spark, sf), SUMMARY_SEARCH).select("date", "category")


@register("retain_summaries", f"""WITH {_SUMMARY_CTES},
names AS (SELECT category || '_' || replace(date, '-', '') AS stem FROM summ
          UNION ALL SELECT date FROM summ UNION ALL SELECT 'index')
SELECT stem FROM names
WHERE stem = 'index'
   OR CASE WHEN regexp_matches(stem, '[0-9]{{8}}$')
           THEN try_strptime(right(stem, 8), '%Y%m%d')::DATE
           WHEN length(stem) = 10 THEN try_strptime(stem, '%Y-%m-%d')::DATE END IS NULL
   OR CASE WHEN regexp_matches(stem, '[0-9]{{8}}$')
           THEN try_strptime(right(stem, 8), '%Y%m%d')::DATE
           WHEN length(stem) = 10 THEN try_strptime(stem, '%Y-%m-%d')::DATE END
      >= DATE '{SUMMARY_TODAY - B.dt.timedelta(days=SUMMARY_KEEP_DAYS)}'""")
def q_retain_summaries(spark, sf):
    s = summaries(spark, sf)
    names = (s.select(F.concat("category", F.lit("_"), F.regexp_replace("date", "-", "")).alias("stem"))
             .unionByName(s.select(F.col("date").alias("stem")))
             .unionByName(spark.range(1).select(F.lit("index").alias("stem"))))
    return R.retain_summaries(names, SUMMARY_KEEP_DAYS, SUMMARY_TODAY)


@register("scan_summaries", f"""WITH {_SUMMARY_CTES}
SELECT date, category, article_count, source_count, matched_count, top_entities, sources FROM summ""")
def q_scan_summaries(spark, sf):
    """Daily summaries written as JSON and read back."""
    where = _result_path(spark, "summaries")
    summaries(spark, sf).withColumn("generated_at", F.lit(LOGGED_AT.isoformat())).write.json(where)
    return R.flatten_summary(R.read_summaries(spark, where, multiline=False))


@register("articles_by_day", f"""WITH {A}
SELECT coalesce(strftime(published, '%Y-%m-%d'), 'Undated') AS day, CAST(count(*) AS BIGINT) AS articles
FROM articles GROUP BY 1""")
def q_articles_by_day(spark, sf):
    return R.articles_by_day(B.document_articles(spark, sf))


@register("source_counts", f"""WITH {A}
SELECT source, CAST(count(*) AS BIGINT) AS articles FROM articles GROUP BY source""")
def q_source_counts(spark, sf):
    return R.source_counts(B.document_articles(spark, sf))


@register("freshness_buckets", f"""WITH {A},
g AS (SELECT CASE WHEN published IS NULL THEN 'Undated'
                  WHEN date_diff('day', CAST(published AS DATE), DATE '{AS_OF.date()}') <= 1 THEN '0-1'
                  WHEN date_diff('day', CAST(published AS DATE), DATE '{AS_OF.date()}') <= 3 THEN '2-3'
                  WHEN date_diff('day', CAST(published AS DATE), DATE '{AS_OF.date()}') <= 7 THEN '4-7'
                  WHEN date_diff('day', CAST(published AS DATE), DATE '{AS_OF.date()}') <= 30 THEN '8-30'
                  ELSE '31+' END AS bucket FROM articles)
SELECT bucket, CAST(count(*) AS BIGINT) AS articles FROM g GROUP BY bucket""")
def q_freshness_buckets(spark, sf):
    return R.freshness_buckets(B.document_articles(spark, sf), AS_OF)


@register("entity_rate", f"""WITH {A},
{H}
SELECT entity, CAST(count(DISTINCT link) AS BIGINT) AS articles,
       round(count(DISTINCT link) / (SELECT count(*) FROM articles), 6) AS rate
FROM hits GROUP BY entity""")
def q_entity_rate(spark, sf):
    return R.entity_rate(matched_articles(spark, sf))


@register("entity_heatmap", f"""WITH {A},
{H}
SELECT h.entity, coalesce(strftime(a.published, '%Y-%m-%d'), 'Undated') AS day, CAST(count(*) AS BIGINT) AS hits
FROM hits h JOIN articles a ON a.link = h.link GROUP BY 1, 2""")
def q_entity_heatmap(spark, sf):
    return R.entity_heatmap(matched_articles(spark, sf))


def attempts(spark, sf):
    """Collection attempts bound from events: source = event type, ok = delay >= 2."""
    ev = B.read_table(spark, sf, "events")
    return ev.select(F.col("event_type").alias("source"), F.col("ts").alias("at"),
                     (F.col("value") >= HEALTH_OK_MIN_DELAY).alias("ok"), F.col("value").alias("delay"))


@register("source_health", f"""WITH att AS (SELECT event_type AS source, ts AS t_at, value >= {HEALTH_OK_MIN_DELAY} AS ok,
                    value AS delay FROM events),
lo AS (SELECT source, max(t_at) FILTER (WHERE ok) AS last_ok FROM att GROUP BY source),
g AS (SELECT a.source, count(*) AS attempts, count(*) FILTER (WHERE ok) AS successes,
             arg_max(delay, t_at) AS last_delay,
             count(*) FILTER (WHERE NOT ok AND (lo.last_ok IS NULL OR t_at > lo.last_ok)) AS failure_streak
      FROM att a JOIN lo USING (source) GROUP BY a.source)
SELECT source, CAST(attempts AS BIGINT) AS attempts, CAST(successes AS BIGINT) AS successes, last_delay,
       CAST(failure_streak AS BIGINT) AS failure_streak, round(successes / attempts, 6) AS success_rate,
       failure_streak >= {HEALTH_DISABLE_AFTER} AS disabled FROM g""")
def q_source_health(spark, sf):
    return R.source_health(attempts(spark, sf), HEALTH_DISABLE_AFTER)


def configured_sources(spark, sf):
    """Sources as configured: document feeds (rss) and page hosts (html, unsupported)."""
    docs = B.document_articles(spark, sf).select(F.col("source").alias("name")).distinct().withColumn("type", F.lit("rss"))
    pages = B.page_articles(spark, sf).select(F.col("source").alias("name")).distinct().withColumn("type", F.lit("html"))
    return docs.unionByName(pages).withColumn("url", F.lit(""))


@register("error_rollup", f"""WITH {A}, {FAULTY},
v AS (SELECT source, {S.validation_errors()} AS errs FROM faulty),
verr AS (SELECT source, 'validation' AS kind FROM v WHERE len(errs) > 0),
d AS (SELECT source, doc_id, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 6 AS t FROM articles),
derr AS (SELECT source, CASE WHEN t >= 4 THEN 'route' ELSE 'parse' END AS kind FROM d WHERE t >= 4 OR doc_id % 11 = 0)
SELECT kind, source, CAST(count(*) AS BIGINT) AS errors
FROM (SELECT * FROM verr UNION ALL SELECT * FROM derr) GROUP BY kind, source""")
def q_error_rollup(spark, sf):
    v = validate.validate_articles(faulty_articles(spark, sf))
    verr = v.filter(~F.col("is_valid")).select("source", F.lit("validation").alias("kind"),
                                              F.array_join("errors", ", ").alias("message"))
    return R.error_rollup(verr.unionByName(ING.dispatch_by_type(*dispatch_input(spark, sf))[1]))


@register("run_stats", f"""WITH {A},
{H},
v AS (SELECT link, source, {S.validation_errors()} AS errs FROM articles)
SELECT CAST(count(DISTINCT source) AS BIGINT) AS sources, CAST(count(*) AS BIGINT) AS collected,
       CAST(count(*) FILTER (WHERE link IN (SELECT link FROM hits)) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE len(errs) = 0) AS BIGINT) AS validated, {RECENT_DAYS} AS window_days
FROM v""")
def q_run_stats(spark, sf):
    v = validate.validate_articles(matched_articles(spark, sf))
    return R.run_stats(v, v, RECENT_DAYS)


# ---------------------------------------------------------------------------------------------
# Ingest: payloads are built by Spark from the documents table, then normalised back
# ---------------------------------------------------------------------------------------------
from tidewatch.sources import ingest as ING  # noqa: E402

# --- fixed values: ingest parameters -------------------------------------------------------
FIRST_N = 30             # only the query first_per_source has a limit
PAGE_SPAN = 200          # documents with doc_id // 200 equal share one list response
INGEST_CATEGORY = "museum"
# -------------------------------------------------------------------------------------------


def _landed(arts):
    return arts.select(F.col("source").alias("source_name"), F.lit(INGEST_CATEGORY).alias("category"),
                       F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("source_ord"),
                       F.col("doc_id").alias("item_ord"), "doc_id", "title", "link", "summary", "published",
                       "source", F.col("category").alias("lang"))


def met_payloads(spark, sf):
    a = _landed(B.document_articles(spark, sf))
    obj = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("objectID"), F.col("title").alias("title"),
        F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("artistDisplayName"),
        F.date_format("published", "yyyy").alias("objectDate"), F.col("lang").alias("medium"),
        F.when(F.col("doc_id") % 3 != 0, F.col("link")).otherwise(F.lit("")).alias("objectURL"),
        F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("metadataDate")))
    payload = F.when(F.col("doc_id") % 7 == 0, F.lit("[]")).otherwise(obj)
    return a.select("source_name", "category", "source_ord", "item_ord", payload.alias("payload"))


def _museum_sql(title, artist, date, medium):
    t = f"coalesce(nullif({S.strip_py(f'coalesce(nullif({title}, {S.q(chr(0))[:0] or chr(39)*2}), {S.q(ING.UNTITLED)})')}, ''), {S.q(ING.UNTITLED)})"
    a = S.strip_py(f"coalesce(nullif({artist}, ''), {S.q(ING.UNKNOWN_ARTIST)})")
    parts = f"list_filter([{a}, {S.strip_py(f'coalesce({date}, {chr(39)*2})')}, {S.strip_py(f'coalesce({medium}, {chr(39)*2})')}], lambda x: x <> '')"
    s = f"CASE WHEN len({parts}) > 0 THEN array_to_string({parts}, '. ') ELSE {S.q(ING.NO_DESCRIPTION)} END"
    return t, s


_MT, _MS = _museum_sql("title", "CASE WHEN doc_id % 4 <> 0 THEN source END", "strftime(published, '%Y')", "category")


@register("ingest_met", f"""WITH {A},
o AS (SELECT * FROM articles)
SELECT {_MT} AS title,
       CASE WHEN doc_id % 3 <> 0 THEN link ELSE {S.q(ING.MET_LINK)} || CAST(doc_id AS VARCHAR) END AS link,
       {_MS} AS summary, published, source, {S.q(INGEST_CATEGORY)} AS category,
       CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS source_ord, doc_id AS item_ord
FROM o WHERE doc_id % 7 <> 0""")
def q_ingest_met(spark, sf):
    arts, _ = ING.ingest_met(met_payloads(spark, sf))
    return arts


@register("first_per_source", f"""WITH {A}
SELECT source AS source_name, doc_id AS item_ord FROM articles
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= {FIRST_N}""")
def q_first_per_source(spark, sf):
    return ING.first_per_source(met_payloads(spark, sf), FIRST_N).select("source_name", "item_ord")


@register("ingest_met_skipped", f"""WITH {A},
o AS (SELECT * FROM articles)
SELECT source AS source_name, CAST(count(*) FILTER (WHERE doc_id % 7 = 0) AS BIGINT) AS skipped
FROM o GROUP BY source""")
def q_ingest_met_skipped(spark, sf):
    return ING.ingest_met(met_payloads(spark, sf))[1]


def aic_payloads(spark, sf):
    a = _landed(B.document_articles(spark, sf))
    row = F.struct(F.col("doc_id").alias("_k"), F.col("doc_id").cast("string").alias("id"), "title",
                   F.col("source").alias("artist_display"),
                   F.date_format("published", "yyyy").alias("date_display"),
                   F.col("lang").alias("medium_display"))
    page = (a.groupBy("source_name", "category", "source_ord", (F.col("doc_id") / PAGE_SPAN).cast("bigint").alias("item_ord"))
            .agg(F.array_sort(F.collect_list(row)).alias("rows")))
    data = F.transform("rows", lambda r: r.dropFields("_k"))
    return page.select("source_name", "category", "source_ord", "item_ord",
                       F.to_json(F.struct(data.alias("data"))).alias("payload"))


_AT, _AS = _museum_sql("title", "source", "strftime(published, '%Y')", "category")


@register("ingest_aic", f"""WITH {A},
o AS (SELECT *, CAST(floor(doc_id / {PAGE_SPAN}) AS BIGINT) AS page,
             row_number() OVER (PARTITION BY source, CAST(floor(doc_id / {PAGE_SPAN}) AS BIGINT) ORDER BY doc_id) - 1 AS pos
      FROM articles)
SELECT {_AT} AS title, {S.q(ING.AIC_LINK)} || CAST(doc_id AS VARCHAR) AS link, {_AS} AS summary,
       CAST(NULL AS TIMESTAMP) AS published, source, {S.q(INGEST_CATEGORY)} AS category,
       CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS source_ord, page * 100000 + pos AS item_ord
FROM o""")
def q_ingest_aic(spark, sf):
    return ING.ingest_aic(aic_payloads(spark, sf))


def si_payloads(spark, sf):
    a = _landed(B.document_articles(spark, sf))
    notes = F.array(
        F.struct(F.lit("Credit").alias("label"), F.col("source").alias("content")),
        F.struct(F.when(F.col("doc_id") % 2 == 0, F.lit("Summary")).otherwise(F.lit("Description")).alias("label"),
                 F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("title")).alias("content")))
    row = F.struct(
        F.col("doc_id").alias("_k"), F.col("doc_id").cast("string").alias("id"), "title",
        F.unix_seconds(F.col("published").cast("timestamp")).cast("string").alias("timestamp"),
        F.struct(F.struct(F.when(F.col("doc_id") % 3 != 0, F.col("link")).alias("record_link"),
                          F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Museum "), F.col("lang")))
                          .alias("data_source")).alias("descriptiveNonRepeating"),
                 F.struct(notes.alias("notes")).alias("freetext")).alias("content"))
    page = (a.groupBy("source_name", "category", "source_ord", (F.col("doc_id") / PAGE_SPAN).cast("bigint").alias("item_ord"))
            .agg(F.array_sort(F.collect_list(row)).alias("rows")))
    data = F.transform("rows", lambda r: r.dropFields("_k"))
    return page.select("source_name", "category", "source_ord", "item_ord",
                       F.to_json(F.struct(F.struct(data.alias("rows")).alias("response"))).alias("payload"))


@register("ingest_smithsonian", f"""WITH {A},
o AS (SELECT *, CAST(floor(doc_id / {PAGE_SPAN}) AS BIGINT) AS page,
             row_number() OVER (PARTITION BY source, CAST(floor(doc_id / {PAGE_SPAN}) AS BIGINT) ORDER BY doc_id) - 1 AS pos
      FROM articles)
SELECT coalesce(nullif({S.strip_py(f"coalesce(nullif(title, ''), {S.q(ING.UNTITLED)})")}, ''), {S.q(ING.UNTITLED)}) AS title,
       CASE WHEN doc_id % 3 <> 0 THEN link ELSE {S.q(ING.SI_LINK)} || CAST(doc_id AS VARCHAR) END AS link,
       CASE WHEN doc_id % 5 = 0 OR title = '' THEN {S.q(ING.NO_DESCRIPTION)} ELSE title END AS summary,
       published,
       CASE WHEN doc_id % 4 = 0 THEN 'Museum ' || category ELSE source END AS source,
       {S.q(INGEST_CATEGORY)} AS category,
       CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS source_ord, page * 100000 + pos AS item_ord
FROM o""")
def q_ingest_smithsonian(spark, sf):
    return ING.ingest_smithsonian(si_payloads(spark, sf))


def _xml_escape(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def _feed_item(title, link, text, day, i):
    """RSS for even ``i``, Atom for odd; every fourth item has its text in content:encoded."""
    text_tag = F.when(i % 4 == 0, F.lit("content:encoded")).otherwise(F.lit("description"))
    rss = F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><"), text_tag, F.lit(">"),
                   text, F.lit("</"), text_tag, F.lit("><pubDate>"), day, F.lit("</pubDate></item>"))
    atom = F.concat(F.lit('<entry><title type="text">'), title,
                    F.lit('</title><link rel="self" href="http://self.example/"/><link href="'), link,
                    F.lit('"/><summary>'), text, F.lit("</summary><updated>2024-01-02T00:30:00Z</updated></entry>"))
    return F.when(i % 2 == 0, rss).otherwise(atom)


FEED_DAY = "Tue, 02 Jan 2024 09:30:00 +0900"  # the time of the Atom entries as well


def rss_payloads(spark, sf):
    a = _landed(B.page_articles(spark, sf).withColumn("doc_id", F.col("page_id")))
    i = F.col("doc_id")
    item = _feed_item(_xml_escape(F.col("title")), _xml_escape(F.col("link")), _xml_escape(F.col("summary")), F.lit(FEED_DAY), i)
    payload = F.when(i % 9 == 8, F.lit("<item><title>cut off")).otherwise(item)
    return a.select(F.col("source_name"), "category", F.lit(0).alias("source_ord"), "item_ord",
                    payload.alias("payload"))


def _entities_sql(x: str) -> str:
    """The entities that the pages hold, decoded once: an ampersand that comes out starts no other."""
    named = f"replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    return f"regexp_replace({named}, '&amp;?', '&', 'g')"


@register("ingest_rss", f"""WITH {P},
t AS (SELECT *, {_entities_sql(S.strip_py("title"))} AS decoded FROM page_articles)
SELECT decoded AS title, link, {_entities_sql(S.strip_py("summary"))} AS summary, TIMESTAMP '2024-01-02 00:30:00' AS published,
       source, {S.q(INGEST_CATEGORY)} AS category, CAST(0 AS INTEGER) AS source_ord, page_id AS item_ord
FROM t WHERE page_id % 9 <> 8 AND decoded NOT IN ('', {S.q(ING.NO_TITLE)}) AND link <> ''""")
def q_ingest_rss(spark, sf):
    """Page titles and texts, entities included, through RSS and Atom items."""
    return ING.ingest_rss(rss_payloads(spark, sf))


# source srcN is of type DISPATCH_TYPES[N mod 6] (the last: not configured); payloads of
# documents with doc_id mod 11 = 0 are broken
DISPATCH_TYPES = ("rss", "met_museum", "aic", "smithsonian", "browser")


def dispatch_input(spark, sf):
    a = _landed(B.document_articles(spark, sf))
    kind = F.col("source_ord") % 6
    js_row = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "title"))
    whole = (F.when(kind == 0, _feed_item(_xml_escape(F.col("title")), F.col("link"), F.lit("text"), F.lit(FEED_DAY), F.col("doc_id")))
             .when(kind == 2, F.concat(F.lit('{"data": ['), js_row, F.lit("]}")))
             .when(kind == 3, F.concat(F.lit('{"response": {"rows": ['), js_row, F.lit("]}}"))).otherwise(js_row))
    payloads = a.select("source_name", "category", "item_ord",
                        F.when(F.col("doc_id") % 11 == 0, F.lit("<{")).otherwise(whole).alias("payload"))
    name = F.array(*[F.lit(t) for t in DISPATCH_TYPES])
    sources = (a.select(F.col("source_name").alias("name"), "source_ord").distinct().filter(F.col("source_ord") % 6 < 5)
               .select("name", F.element_at(name, F.col("source_ord") % 6 + 1).alias("type"), F.lit("u").alias("url"), "source_ord"))
    return sources, payloads


@register("dispatch_by_type", f"""WITH {A},
d AS (SELECT *, CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % 6 AS t FROM articles),
r AS (SELECT source, CASE WHEN t >= 4 THEN 'route' WHEN doc_id % 11 = 0 THEN 'parse'
             WHEN t = 0 AND {S.strip_py("title")} IN ('', {S.q(ING.NO_TITLE)}) THEN 'skipped' ELSE 'article' END AS kind FROM d)
SELECT source, kind, CAST(count(*) AS BIGINT) AS n FROM r WHERE kind <> 'skipped' GROUP BY source, kind""")
def q_dispatch_by_type(spark, sf):
    arts, errors = ING.dispatch_by_type(*dispatch_input(spark, sf))
    return (arts.select("source", F.lit("article").alias("kind")).unionByName(errors.select("source", "kind"))
            .groupBy("source", "kind").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@register("unsupported_sources", f"""WITH {A}, {P},
srcs AS (SELECT DISTINCT source AS name, 'rss' AS type FROM articles
         UNION ALL SELECT DISTINCT source, 'html' FROM page_articles)
SELECT name, type, name || ': Unsupported source type ''' || type || '''' AS message FROM srcs
WHERE lower(type) NOT IN ('rss', 'met_museum', 'aic', 'smithsonian', 'javascript', 'browser')""")
def q_unsupported_sources(spark, sf):
    return ING.unsupported_sources(configured_sources(spark, sf))


@register("union_sources", f"""WITH {A}, {P}
SELECT title, link, source, category, CAST(0 AS INTEGER) AS source_ord, item_ord FROM articles
UNION ALL SELECT title, link, source, category, 1, item_ord FROM page_articles""")
def q_union_sources(spark, sf):
    frames = [f.withColumn("source_ord", F.lit(i)) for i, f in enumerate(
        (B.document_articles(spark, sf), B.page_articles(spark, sf)))]
    return ING.union_sources(frames).select("title", "link", "source", "category", "source_ord", "item_ord")


# ---------------------------------------------------------------------------------------------
# Read-only SQL tool and streaming delivery
# ---------------------------------------------------------------------------------------------
from tidewatch.plans.sql_tool import read_only_sql  # noqa: E402
from tidewatch.session import checkpoint_dir  # noqa: E402
from tidewatch.streaming import delivery as STREAM  # noqa: E402

# --- fixed values: SQL tool and stream parameters ------------------------------------------
TOOL_SQL = ("WITH recent AS (SELECT category, source, collected_at FROM articles "
            "WHERE collected_at >= TIMESTAMP_NTZ'2024-01-20 00:00:00') "
            "SELECT category, count(*) AS n, count(DISTINCT source) AS sources FROM recent "
            "GROUP BY category ORDER BY n DESC, category")
STREAM_WATERMARK = "1 day"
DEDUP_WATERMARK = "3650 days"
# -------------------------------------------------------------------------------------------


@register("read_only_sql", f"""WITH {A},
recent AS (SELECT category, source, collected_at FROM articles WHERE collected_at >= TIMESTAMP '2024-01-20 00:00:00')
SELECT category, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT source) AS BIGINT) AS sources
FROM recent GROUP BY category""")
def q_read_only_sql(spark, sf):
    B.document_articles(spark, sf).createOrReplaceTempView("articles")
    return read_only_sql(spark, TOOL_SQL)


def _result_path(spark, name):
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/results/{name}-{uuid.uuid4().hex[:12]}"


@register("stream_event_counts", """
SELECT date_trunc('day', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2""")
def q_stream_event_counts(spark, sf):
    """Per-day event counts by type as an event-time windowed streaming aggregate."""
    s = STREAM.stream_table(spark, sf, "events.parquet")
    agg = STREAM.windowed_counts(s, "ts", ["event_type"], "1 day", STREAM_WATERMARK)
    out = STREAM.run_available(agg, _result_path(spark, "event_counts"), "complete", "event_counts")
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                          "event_type", "n")


@register("stream_dedup_links", "SELECT DISTINCT l_orderkey AS link FROM lineitem")
def q_stream_dedup_links(spark, sf):
    """Link dedup on a stream: first arrival per order key within the watermark."""
    s = STREAM.stream_table(spark, sf, "lineitem.parquet").select(
        F.col("l_orderkey").alias("link"), F.col("l_shipdate").cast("timestamp").alias("fetched_at"))
    d = STREAM.dedup_stream(s, "link", "fetched_at", DEDUP_WATERMARK)
    out = STREAM.run_available(d, _result_path(spark, "dedup"), "append", "dedup")
    return spark.read.parquet(out).select("link")


# turns of a conversation as copies of one link: an hour apart, in the order of (source_ord, turn)
TURN_SOURCES = 5


@register("stream_dedup_survivors", f"""
SELECT conv_id AS link, arg_min(turn, (turn * 7 % {TURN_SOURCES}) * 1000000 + turn) AS item_ord, arg_min(text,
       (turn * 7 % {TURN_SOURCES}) * 1000000 + turn) AS title FROM conversations GROUP BY conv_id""")
def q_stream_dedup_survivors(spark, sf):
    """Link dedup on a stream by keyed state and timers: the first row of each link in source order.
    A last row of its own link, long after the others, moves the watermark past them; it goes with
    the table's smallest row."""
    turns = STREAM.stream_table(spark, sf, "conversations.parquet")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    row = F.struct(F.col("conv_id").alias("link"), (start + F.make_interval(hours=F.col("turn").cast("int"))).alias("fetched_at"),
                   (F.col("turn") * 7 % TURN_SOURCES).cast("int").alias("source_ord"), F.col("turn").cast("long").alias("item_ord"),
                   F.col("text").alias("title"))
    end = F.struct(F.lit(-1).cast("long").alias("link"), (start + F.make_interval(years=F.lit(50))).alias("fetched_at"),
                   F.lit(0).alias("source_ord"), F.lit(0).cast("long").alias("item_ord"), F.lit("").alias("title"))
    first = B.read_table(spark, sf, "conversations").agg(F.min(F.struct("conv_id", "turn")).alias("r")).first()["r"]
    last = F.lit(False) if first is None else F.col("conv_id").eqNullSafe(first[0]) & F.col("turn").eqNullSafe(first[1])
    rows = turns.select(F.explode(F.when(last, F.array(row, end)).otherwise(F.array(row))).alias("r")).select("r.*")
    out = STREAM.run_available(STREAM.dedup_links_stream(rows, horizon="30 days"), _result_path(spark, "survivors"),
                               "append", "survivors")
    return spark.read.parquet(out).select("link", "item_ord", "title")


@register("stream_articles_by_day", ORACLE["articles_by_day"])
def q_stream_articles_by_day(spark, sf):
    """Documents on a stream, split into dated and undated rows; counts per publication day."""
    arts = B.articles_from_documents(STREAM.stream_table(spark, sf, "documents.parquet"))
    out = STREAM.split_by_date(arts.select("link", "title", "published"), _result_path(spark, "by-day"), name="by-day")
    return STREAM.read_by_day(spark, out)


@register("stream_upsert", f"""WITH {A},
{H}
SELECT category, CAST(count(*) AS BIGINT) AS articles,
       CAST(count(*) FILTER (WHERE link IN (SELECT link FROM hits)) AS BIGINT) AS matched
FROM articles GROUP BY category""")
def q_stream_upsert(spark, sf):
    """Documents streamed through binding -> entity match -> foreachBatch upsert into the
    versioned store; the stored table is then read back and rolled up."""
    s = STREAM.stream_table(spark, sf, "documents.parquet")
    arts = B.articles_from_documents(s).withColumn("batch_ord", F.col("item_ord"))
    matched = ent.entity_match(arts, DEMO_ENTITIES)
    root = _result_path(spark, "store")
    STREAM.upsert_stream(matched, root, RECOLLECT_AT, name="upsert")
    stored = STORE.read_articles(spark, root)
    m = F.coalesce(F.size("matched_entities") > 0, F.lit(False))
    return stored.groupBy("category").agg(F.count(F.lit(1)).cast("bigint").alias("articles"),
                                          F.count_if(m).cast("bigint").alias("matched"))


# ---------------------------------------------------------------------------------------------
# Date parsing, source tagging, entity unescape
# ---------------------------------------------------------------------------------------------

@register("parse_feed_date", """
SELECT event_id, date_trunc('second', ts) AS parsed_gmt,
       date_trunc('second', ts) - INTERVAL 9 HOUR AS parsed_kst,
       date_trunc('second', ts) AS parsed_iso, date_trunc('second', ts) AS parsed_unix
FROM events""")
def q_parse_feed_date(spark, sf):
    """Event times rendered as RFC 822 (GMT and +0900), ISO-8601 with offset and unix
    seconds, then parsed back to naive UTC."""
    ev = B.read_table(spark, sf, "events")
    rfc = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    unix = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return ev.select("event_id",
                     TX.parse_feed_date(F.concat(rfc, F.lit(" GMT"))).alias("parsed_gmt"),
                     TX.parse_feed_date(F.concat(rfc, F.lit(" +0900"))).alias("parsed_kst"),
                     TX.utc_naive(iso).alias("parsed_iso"),
                     TX.parse_unix_timestamp(unix).alias("parsed_unix"))


@register("articles_with_source", f"""WITH {A},
srcs AS (SELECT DISTINCT source AS name, 'rss' AS type FROM articles WHERE category <> 'es')
SELECT a.link, a.source, s.type FROM articles a LEFT JOIN srcs s ON a.source = s.name""")
def q_articles_with_source(spark, sf):
    arts = B.document_articles(spark, sf)
    srcs = (arts.filter(F.col("category") != "es").select(F.col("source").alias("name")).distinct()
            .withColumn("type", F.lit("rss")))
    return ING.articles_with_source(arts.select("link", "source"), srcs)


@register("html_unescape", f"""WITH {P}
SELECT page_id, {_entities_sql("title")} || CASE WHEN page_id % 2 = 0 THEN ' & <' || CAST(page_id AS VARCHAR) || '> é—"' ELSE '' END AS title
FROM page_articles""")
def q_html_unescape(spark, sf):
    """Page titles with their entities, half of them with more planted, decoded (only those reach Python)."""
    planted = F.concat(F.lit(" &amp; &lt;"), F.col("page_id").cast("string"), F.lit("&gt; &eacute;&#8212;&quot;"))
    title = F.concat(F.col("title"), F.when(F.col("page_id") % 2 == 0, planted).otherwise(F.lit("")))
    return ING.html_unescape(B.page_articles(spark, sf).select("page_id", title.alias("title")), ["title"])


# ---------------------------------------------------------------------------------------------
# Matching at dictionary scale (~900 keywords derived from the corpus by rule)
# ---------------------------------------------------------------------------------------------
from tidewatch.sources.config import dictionary_from_corpus  # noqa: E402


def large_dictionary(spark, sf):
    return dictionary_from_corpus(B.read_table(spark, sf, "documents"))


@register("entity_match_large")
def q_entity_match_large(spark, sf):
    """Per-entity keyword hits with a corpus-derived dictionary of ~900 keywords
    (equivalence with the brute-force matcher is tested on a small fixture)."""
    hits = ent.entity_hits(B.document_articles(spark, sf), large_dictionary(spark, sf))
    return trends.entity_totals_from_hits(hits)


@register("fts_tokenize", f"""WITH {A},
{_tok_sql()}
SELECT link, CAST(len(tt) AS BIGINT) AS title_tokens, CAST(len(bt) AS BIGINT) AS body_tokens,
       CAST(len(tt) + len(bt) AS BIGINT) AS dl FROM tok""")
def q_fts_tokenize(spark, sf):
    """Token counts per document under the full-text tokenizer (title, body, both)."""
    t = FTS.with_tokens(search_docs(spark, sf))
    return t.select("link", F.size("tt").cast("bigint").alias("title_tokens"),
                    F.size("bt").cast("bigint").alias("body_tokens"), "dl")


# the stored dictionary: words of at least four letters of the benchmark table, one entity per
# word length
KEYWORD_LETTERS = 4


def word_dictionary(words):
    """A dictionary frame of the distinct words (column ``k``), one entity per word length."""
    n = F.length("k")
    return ent.dictionary_frame(words.distinct().select(
        F.concat(F.lit("letters"), n).alias("entity"), n.alias("entity_ord"), F.col("k").alias("keyword"),
        F.lit(0).alias("keyword_ord")))


def benchmark_dictionary(spark, sf):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("k")
    return word_dictionary(B.read_table(spark, sf, "benchmark").select(words).filter(F.length("k") >= KEYWORD_LETTERS))


@register("entity_match_dictionary", f"""WITH {A},
kw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS k FROM benchmark),
w AS (SELECT link, unnest(list_distinct(regexp_extract_all(lower(coalesce(title, '') || chr(10) || coalesce(summary, '')),
             '[\\p{{L}}\\p{{N}}_]+'))) AS k FROM articles),
m AS (SELECT w.link, w.k FROM w JOIN kw ON w.k = kw.k WHERE length(kw.k) >= {KEYWORD_LETTERS})
SELECT a.link, CAST(count(m.k) AS BIGINT) AS n_keywords, CAST(count(DISTINCT length(m.k)) AS BIGINT) AS n_entities
FROM articles a LEFT JOIN m ON a.link = m.link GROUP BY a.link""")
def q_entity_match_dictionary(spark, sf):
    """Matches of every article with a stored dictionary of over a thousand keywords."""
    m = ent.entity_match(B.document_articles(spark, sf), benchmark_dictionary(spark, sf))
    sizes = F.transform(F.map_values("matched_entities"), lambda v: F.size(v))
    return m.select("link", F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_keywords"),
                    F.size("matched_entities").cast("long").alias("n_entities"))


@register("entity_match_script", f"""WITH {A},
kw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}]+')) AS k FROM benchmark),
n AS (SELECT k FROM kw WHERE regexp_matches(k, '[^\\x00-\\x7F]')),
t AS (SELECT link, lower(coalesce(title, '') || chr(10) || coalesce(summary, '')) AS t FROM articles),
m AS (SELECT link, k FROM t JOIN n ON contains(t, k))
SELECT a.link, CAST(count(m.k) AS BIGINT) AS n_keywords, CAST(count(DISTINCT length(m.k)) AS BIGINT) AS n_entities
FROM articles a LEFT JOIN m ON a.link = m.link GROUP BY a.link""")
def q_entity_match_script(spark, sf):
    """Substring matches of every article with the benchmark's words in non-ASCII letters."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("k")
    keywords = B.read_table(spark, sf, "benchmark").select(words).filter(F.col("k").rlike(r"[^\x00-\x7F]"))
    m = ent.entity_match(B.document_articles(spark, sf), word_dictionary(keywords))
    sizes = F.transform(F.map_values("matched_entities"), lambda v: F.size(v))
    return m.select("link", F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_keywords"),
                    F.size("matched_entities").cast("long").alias("n_entities"))
