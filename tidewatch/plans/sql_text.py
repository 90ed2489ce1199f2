"""SQL text shared by the DuckDB oracle statements.

These strings restate, in plain SQL, the bindings and parameters used by the Spark
queries, so the oracle reads the same parquet tables and computes the same thing
independently.
"""

from __future__ import annotations

import datetime as dt
import re

from tidewatch.operators.entities import prepare_dictionary
from tidewatch.sources.bindings import (AS_OF, COLLECTED_DAYS_MOD, EPOCH, NOT_PAGE_TEXT, PUBLISHED_EPOCH,
                                        PUBLISHED_MINUTES_MOD, PUBLISHED_STRIDE, UNDATED_MOD)

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ARTICLES_CTE = f"""articles AS (
  SELECT doc_id,
         split_part(text, chr(10), 1) AS title,
         'https://' || source || '.example.com/' || lang || '/' || CAST(doc_id AS VARCHAR) AS link,
         text AS summary,
         CASE WHEN doc_id % {UNDATED_MOD} = 0 THEN NULL
              ELSE {ts(PUBLISHED_EPOCH)} + to_minutes(CAST(doc_id * {PUBLISHED_STRIDE} % {PUBLISHED_MINUTES_MOD} AS BIGINT)) END AS published,
         source,
         lang AS category,
         {ts(EPOCH)} + to_days(CAST(doc_id % {COLLECTED_DAYS_MOD} AS INTEGER)) AS collected_at,
         doc_id AS item_ord
  FROM documents)"""

def _re2_escape(kw: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", kw)


def re2_keyword_pattern(kw: str) -> str:
    left = f"(^|{NON_WORD})" if re.match(r"\w", kw[0]) else WORD
    right = f"($|{NON_WORD})" if re.match(r"\w", kw[-1]) else WORD
    return "(?i)" + left + _re2_escape(kw) + right


def hits_ctes(entities, source: str = "articles") -> str:
    """CTEs ``raw_hits`` and ``hits`` (link, entity, entity_ord, keyword, keyword_ord).

    One branch per dictionary entry, each with a constant pattern (compiled once).
    """
    hay = "coalesce(title, '') || chr(10) || coalesce(summary, '')"
    branches = []
    for k in prepare_dictionary(entities):
        if k.mode == "sub":
            cond = f"contains(lower({hay}), {q(k.keyword)})"
        else:
            cond = f"regexp_matches({hay}, {q(re2_keyword_pattern(k.keyword))})"
        branches.append(
            f"  SELECT link, {q(k.entity)} AS entity, CAST({k.entity_ord} AS INTEGER) AS entity_ord, "
            f"{q(k.keyword)} AS keyword, CAST({k.keyword_ord} AS INTEGER) AS keyword_ord "
            f"FROM {source} WHERE {cond}")
    union = "\n  UNION ALL\n".join(branches)
    return f"""raw_hits AS (
{union}),
hits AS (
  SELECT link, entity, entity_ord, keyword, keyword_ord FROM (
    SELECT *, max(entity_ord) OVER (PARTITION BY link, entity) AS mx FROM raw_hits)
  WHERE entity_ord = mx)"""


def cutoff(days: int, as_of: dt.datetime = AS_OF) -> str:
    return ts(as_of - dt.timedelta(days=days))


# --- SQL spellings of the text helpers (RE2; 'g' = replace all, as Spark does) ------------
SP = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def strip_py(x: str) -> str:
    return f"regexp_replace({x}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def collapse(x: str) -> str:
    return strip_py(f"regexp_replace({x}, '[{SP}]+', ' ', 'g')")


PAGES_CTE = rf"""page_articles AS (
  SELECT page_id,
         regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
         url AS link,
         {collapse(f"regexp_replace(html, '{NOT_PAGE_TEXT}', ' ', 'g')")} AS summary,
         CAST(NULL AS TIMESTAMP) AS published,
         coalesce(nullif(lower(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//([^/?#]*)', 1)), ''), '') AS source,
         'web' AS category,
         page_id AS item_ord
  FROM pages)"""


def normalize_title(x: str) -> str:
    inner = f"regexp_replace({collapse(f'lower({x})')}, '[^\\p{{L}}\\p{{N}}_{SP}\\-]', '', 'g')"
    return f"coalesce({collapse(inner)}, '')"


def clean_url(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[\\t\\r\\n]', '', 'g'), '^[\\x{{00}}-\\x{{20}}]+', '')"


def valid_url(x: str) -> str:
    return f"coalesce(regexp_matches({clean_url(x)}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+'), false)"


URL_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def url_netloc(x: str) -> str:
    return f"regexp_extract({clean_url(x)}, '{URL_SPLIT}', 2)"


def url_path(x: str) -> str:
    return f"regexp_replace(regexp_extract({clean_url(x)}, '{URL_SPLIT}', 3), ';[^/]*$', '')"


def validation_errors(t="title", l="link", s="summary", src="source", c="category") -> str:
    def missing(x):
        return f"({x} IS NULL OR {x} = '')"
    return f"""list_filter([
      CASE WHEN {missing(t)} THEN 'title is missing or not a string'
           WHEN {strip_py(t)} = '' THEN 'title is empty' END,
      CASE WHEN {missing(l)} THEN 'link is missing or not a string'
           WHEN NOT {valid_url(l)} THEN 'link has invalid URL format: ' || {l} END,
      CASE WHEN {missing(s)} THEN 'summary is missing or not a string'
           WHEN {strip_py(s)} = '' THEN 'summary is empty' END,
      CASE WHEN {missing(src)} THEN 'source is missing or not a string' END,
      CASE WHEN {missing(c)} THEN 'category is missing or not a string' END], lambda x: x IS NOT NULL)"""
