"""Search tool: parse the query, rank, apply the day filter, hydrate results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.nlq import parse_query
from tidewatch.operators import recent, search


def search_documents(documents: DataFrame, articles: DataFrame, query: str, as_of: dt.datetime,
                     limit: int = 20, postings: DataFrame | None = None,
                     stats: DataFrame | None = None, buckets: int | None = None, blocks: DataFrame | None = None,
                     with_snippets: bool = False) -> DataFrame:
    """documents: (link, title, body) search corpus; articles: stored rows with collected_at.

    A limit found in the query overrides ``limit``; when parsing leaves no text the raw
    query is searched; the top-k is taken BEFORE the day filter, so fewer rows may return.
    """
    parsed = parse_query(query)
    k = parsed.limit if parsed.limit is not None else limit
    text = parsed.search_text or query.strip()
    terms = search.query_terms(text)
    if postings is None:
        top = search.bm25_scan(documents, terms, k if k > 0 else 0)
    elif blocks is not None:
        top, _ = search.bm25_topk_blocks(postings, blocks, stats, terms, k if k > 0 else 0, buckets=buckets)
    else:
        top = search.bm25_topk(postings, stats, terms, k if k > 0 else 0, buckets=buckets)
    if parsed.days is not None:
        recent_links = recent.collected_since(articles, as_of, parsed.days).select("link")
        top = top.join(recent_links, "link", "left_semi")
    # hydrate: the ranked side is at most k rows (top-k), so it is the broadcast side
    if "doc_bucket" in documents.columns:
        hydrated = search.fetch_documents(documents, top)
    else:
        hydrated = documents.join(F.broadcast(top), "link")
    if with_snippets:
        hydrated = search.with_snippet(hydrated, terms)
    return hydrated
