"""Full-text search over (title, body): tokens, postings, BM25 top-k, phrase / prefix /
any-term matching, and snippets.

Index layout.  ``fts_postings`` emits one row per (term, link, column) with the token
positions; every row carries the document length, so scoring needs no join back to the
documents.  A persisted index is partitioned by ``term_bucket = pmod(xxhash64(term), B)``;
a query's term filter turns into a constant bucket predicate and prunes partitions, so a
query reads only its terms' postings instead of the corpus.  Three small tables go with it:
the statistics, the lexicon (terms in order, with their buckets: a prefix is a range of it),
and the block maxima: documents are dealt to blocks by length class and hash, postings are
sorted by term and block, and each (term, block) has its largest impact, so a top-k query
bounds every block before it reads any and skips those that cannot reach the k-th score.

BM25 (k1 = 1.2, b = 0.75, both columns weight 1): ``idf = ln((N - n + 0.5) / (n + 0.5))``
floored at 1e-6, ``rank = -sum(idf * f * (k1 + 1) / (f + k1 * (1 - b + b * D / avgD)))``,
f = hits over both columns, D = tokens over both columns.  Lower rank is better.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import explode_rows, fts_tokens

# --- fixed values: ranking constants ------------------------------------------------------
K1 = 1.2
B = 0.75
IDF_FLOOR = 1e-6
SNIPPET_TOKENS = 32
SNIPPET_OPEN, SNIPPET_CLOSE, SNIPPET_ELLIPSIS = "<b>", "</b>", "..."
DEFAULT_BUCKETS = 64
BLOCK_DOCS = 512          # documents of a block, about
LENGTH_CLASSES = 8        # length classes that most documents fall into, about
TASK_TOKENS = 4_000_000   # tokens of a task of the index build, about: it sorts their postings in memory
CHUNK_TOKENS = 500_000    # tokens that are grouped at once
FIRST_BLOCKS = 16         # blocks that a top-k query reads first,
BLOCK_GROWTH = 4          # and how many times more in each next round
# -------------------------------------------------------------------------------------------


def query_terms(text: str) -> list[str]:
    """Tokenise a query string with the index tokenizer (driver side; a handful of words)."""
    import re
    import unicodedata
    from tidewatch.functions.text import DIACRITIC_FROM, DIACRITIC_TO
    folded = text.translate(str.maketrans(DIACRITIC_FROM, DIACRITIC_TO)).lower()
    out = []
    for tok in re.findall(r"[^\W_]+", folded):
        if all(unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "Co" for c in tok):
            out.append(tok)
    seen, uniq = set(), []
    for t in out:
        if t not in seen:
            seen.add(t)
            uniq.append(t)
    return uniq


def with_tokens(docs: DataFrame, title: str = "title", body: str = "body") -> DataFrame:
    """Adds ``tt`` / ``bt`` token arrays and the document length ``dl`` (narrow)."""
    return (docs.withColumn("tt", fts_tokens(F.col(title)))
            .withColumn("bt", fts_tokens(F.col(body)))
            .withColumn("dl", (F.size("tt") + F.size("bt")).cast("bigint")))


def fts_postings(docs: DataFrame, key: str = "link", title: str = "title", body: str = "body",
                 terms: list[str] | None = None, placed: bool = False) -> DataFrame:
    """(term, link, col, positions, tf, dl); ``terms`` restricts to those terms before the shuffle.

    Full build (no ``terms``): the only shuffle moves the text once, by key (``placed``: the rows
    of a key stand in one partition already).  The tokens of a key are grouped where they are,
    in Arrow batches, and never become rows.  ``doc_tf`` is the term's count in all columns of
    the key: a row with ``col`` 0 or ``tf`` equal to it is the first of its (term, key).
    Query-time build (``terms``): tokens are filtered right after the explode, so only the
    query's tokens are shuffled.
    """
    src = docs.select(key, title, body)
    if terms is None:
        src = src if placed else src.repartition(key)
        t = src.sortWithinPartitions(key).select(F.col(key).alias("key"), _spaced(F.col(title)).alias("tt"), _spaced(F.col(body)).alias("bt"))
        key_type = docs.schema[key].dataType.simpleString()
        return t.mapInArrow(_group_tokens(CHUNK_TOKENS, DEFAULT_BUCKETS), f"term string, `{key}` {key_type}, col int, positions array<int>, "
                                                                          "tf bigint, dl bigint, doc_tf bigint")
    t = with_tokens(src, title, body)

    def zipped(arr: str, ci: int) -> Column:
        n = F.size(arr)
        return F.when(n > 0, F.arrays_zip(F.array_repeat(F.lit(ci), n).alias("col"),
                                          F.sequence(F.lit(0), n - 1).alias("pos"), F.col(arr).alias("term"))
                      ).otherwise(F.array().cast("array<struct<col:int,pos:int,term:string>>"))
    toks = (t.select(key, "dl", explode_rows(F.concat(zipped("tt", 0), zipped("bt", 1))).alias("e"))
            .filter(F.col("e").isNotNull()).select(key, "dl", "e.col", "e.pos", "e.term"))
    return (toks.filter(F.col("term").isin(*terms)).groupBy("term", key, "col")
            .agg(F.array_sort(F.collect_list("pos")).alias("positions"),
                 F.count(F.lit(1)).cast("bigint").alias("tf"), F.max("dl").alias("dl")))


def _is_ascii(text: Column) -> Column:
    return (F.octet_length(text) == F.length(text)) & F.is_valid_utf8(text)


def _spaced(col: Column) -> Column:
    """A text whose tokens ``_group_tokens`` finds by its bytes: one in ASCII as it is, another
    one folded and with a space for all that stands between its tokens."""
    from tidewatch.functions.text import TOKEN_PATTERN, fts_fold
    text = F.coalesce(col, F.lit(""))
    between = "[^" + TOKEN_PATTERN.removeprefix("[")
    return F.when(_is_ascii(text), text).otherwise(F.regexp_replace(fts_fold(text), between, " "))


def _group_tokens(chunk_tokens: int, buckets: int):
    """Rows ``(key, tt, bt)`` of spaced texts sorted by key -> postings, some ``chunk_tokens`` tokens
    at a time, each time by term bucket, term, length class and key: the index's order, so that
    its sort finds runs to merge.

    A nested function, so that workers need not have this package.
    """
    def group(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        table = np.zeros(256, np.uint8)  # what a byte is in a token; 0 between tokens
        table[0x80:] = np.arange(0x80, 256)
        for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
            table[c] = c
            table[ord(chr(c).upper())] = c

        def group_of_row(rows):
            codes = rows.column("key").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            return np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])]).astype(np.int64)

        def tokens_of(texts):
            """Tokens of each text, one after the other, and their numbers."""
            texts = texts.cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            if at[0] == at[-1]:
                return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
            folded = table[np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]]]
            at = at - at[0]
            inside = folded != 0
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            edges = at[:-1][at[:-1] < len(inside)]
            first[edges] = inside[edges]
            starts = np.flatnonzero(first)
            chars = folded[inside]
            places = np.append(np.cumsum(inside)[starts] - 1, len(chars)).astype(np.int64)
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(chars))
            return words, np.diff(np.searchsorted(starts, at))

        def postings(rows):
            groups, n = group_of_row(rows), rows.num_rows
            (titles, in_title), (bodies, in_body) = tokens_of(rows.column("tt")), tokens_of(rows.column("bt"))
            each = [in_title, in_body]
            row = np.concatenate([np.repeat(np.arange(n), k) for k in each])
            pos = np.concatenate([np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) for k in each])
            col = np.repeat([0, 1], [k.sum() for k in each])
            if not len(row):
                return None
            words = pa.concat_arrays([titles, bodies]).dictionary_encode()
            terms, code = words.dictionary.cast(pa.string()), words.indices.to_numpy(zero_copy_only=False)
            # codes by bucket and term, keys by length class and key
            by_term = pc.sort_indices(terms).to_numpy()
            in_bucket = np.array([xxhash.xxh64_intdigest(t, 42) for t in terms.cast(pa.binary()).to_pylist()], np.uint64).view(np.int64) % buckets
            by_term = by_term[np.argsort(in_bucket[by_term], kind="stable")]
            rank = np.empty(len(terms), np.int64)
            rank[by_term] = np.arange(len(terms))
            length, n_groups = in_title + in_body, int(groups[-1]) + 1
            longest = np.zeros(n_groups, np.int64)
            np.maximum.at(longest, groups, length)
            by_class = np.argsort(np.floor(np.log2(longest + 1) * 2), kind="stable")
            place_of = np.empty(n_groups, np.int64)
            place_of[by_class] = np.arange(n_groups)
            place = (rank[code] * n_groups + place_of[groups[row]]) * 2 + col
            # the entries of one row and column are in order; those of more rows of a key are not
            if n_groups < n:
                order = np.lexsort((pos, place))
            elif len(terms) * n_groups * 2 < 2 ** 62 // len(place):  # key and entry sorted as one number
                order = np.sort(place * len(place) + np.arange(len(place))) % len(place)
            else:
                order = np.argsort(place, kind="stable")
            place, row = place[order], row[order]
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            tf = np.diff(np.append(starts, len(place)))
            pair = place[starts] // 2
            firsts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            doc_tf = np.repeat(np.add.reduceat(tf, firsts), np.diff(np.append(firsts, len(pair))))
            return pa.RecordBatch.from_arrays([
                terms.take(pa.array(by_term[pair // n_groups])), rows.column("key").take(pa.array(row[starts])),
                pa.array((place[starts] % 2).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.append(starts, len(place)).astype(np.int32)), pa.array(pos[order].astype(np.int32))),
                pa.array(tf.astype(np.int64)), pa.array(np.maximum.reduceat(length[row], starts)), pa.array(doc_tf.astype(np.int64))], names=names)

        def chunks(parts):
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            groups = group_of_row(rows)
            size = sum(pc.binary_length(rows.column(name)).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("tt", "bt"))
            tokens = np.bincount(groups, weights=size / 6)  # about
            chunk = (np.cumsum(tokens) // chunk_tokens)[groups]
            cuts = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), rows.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                out = postings(rows.slice(lo, hi - lo))
                if out is not None:
                    yield out

        names = ["term", "key", "col", "positions", "tf", "dl", "doc_tf"]
        held = []  # rows of the last key, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = group_of_row(batch)
            last = int(np.searchsorted(groups, groups[-1]))
            goes_on = held and held[-1].column("key")[-1].as_py() == batch.column("key")[0].as_py()
            if last == 0 and goes_on:
                held.append(batch)
                continue
            ready = held + ([batch.slice(0, last)] if last else [])
            held = [batch.slice(last)]
            if ready:
                yield from chunks(ready)
        if held:
            yield from chunks(held)
    return group


def doc_stats(docs: DataFrame, key: str = "link", title: str = "title", body: str = "body") -> DataFrame:
    return with_tokens(docs.select(key, title, body), title, body).select(key, "dl")


def term_bucket(term: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def doc_block(dl: Column, key: Column, slots: Column) -> Column:
    """Block of a document: its length class (half octaves) and one of ``slots`` hash places.
    Documents of like length have like impacts, which keeps a block's maxima close to them."""
    return F.floor(F.log2(dl + 1) * 2) * (1 << 32) + doc_slot(key, slots)


def doc_slot(key: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), slots)


def write_postings(postings: DataFrame, path: str, key: str = "link", buckets: int = DEFAULT_BUCKETS,
                   mode: str = "overwrite", slots: int = 1) -> None:
    """Postings in the index layout: partitioned by term bucket, sorted by term and block inside files.

    Every task writes its own rows, of which it should have no more than it can sort in memory
    (``place_documents``): postings are larger than the texts and are not shuffled.
    """
    post = (postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
            .withColumn("doc_block", doc_block(F.col("dl"), F.col(key), F.lit(slots))))
    (post.sortWithinPartitions("term_bucket", "term", "doc_block", key)
     .write.mode(mode).partitionBy("term_bucket").parquet(path))


def place_documents(docs: DataFrame, tokens: float, key: str = "link", slots: int = 1) -> DataFrame:
    """Documents dealt by key to partitions of about ``TASK_TOKENS`` tokens, whole blocks of
    documents to a partition where there are more slots than partitions."""
    parts = max(math.ceil(tokens / TASK_TOKENS), docs.sparkSession.sparkContext.defaultParallelism)
    if slots >= parts:
        place = F.floor(doc_slot(F.col(key), F.lit(slots)) * parts / slots)
    else:
        place = F.pmod(F.xxhash64(F.lit("place"), key), F.lit(parts))
    return docs.repartitionById(parts, place.cast("int"))


def token_counts(title: str, body: str) -> Column:
    """Number of tokens of both columns, without building them."""
    from tidewatch.functions.text import TOKEN_PATTERN, fts_fold

    def count(text: Column) -> Column:
        plain, other = F.regexp_count(text, F.lit("[0-9A-Za-z]+")), F.regexp_count(fts_fold(text), F.lit(TOKEN_PATTERN))
        return F.when(_is_ascii(text), plain).otherwise(other)
    return sum((count(F.coalesce(F.col(c), F.lit(""))) for c in (title, body)), F.lit(0)).cast("bigint")


def write_documents(docs: DataFrame, path: str, key: str = "link", title: str = "title", body: str = "body",
                    buckets: int = DEFAULT_BUCKETS, mode: str = "overwrite") -> None:
    """Search documents with their length, partitioned by a hash of the key."""
    lengths = docs.select(key, title, body, token_counts(title, body).alias("dl"))
    (lengths.withColumn("doc_bucket", term_bucket(F.col(key), buckets)).hint("rebalance", F.col("doc_bucket"))
     .sortWithinPartitions("doc_bucket", key).write.mode(mode).partitionBy("doc_bucket").parquet(path))


def impact(f: Column, dl: Column, avg_dl: Column) -> Column:
    """A term's part of a document's score, without its idf."""
    return f * (K1 + 1) / (f + K1 * (1 - B + B * dl / avg_dl))


def first_of_key() -> Column:
    """Whether a posting is the first of its (term, key): one posting of each is."""
    return (F.col("col") == 0) | (F.col("tf") == F.col("doc_tf"))


def term_counts(postings: DataFrame, key: str = "link") -> DataFrame:
    """``(term, doc_freq, total_tf)`` of all postings; documents without a key count as none."""
    return postings.groupBy("term").agg(F.count_if(first_of_key() & F.col(key).isNotNull()).cast("bigint").alias("doc_freq"),
                                        F.sum("tf").cast("bigint").alias("total_tf"))


def block_maxima(postings: DataFrame, avg_dl: Column) -> DataFrame:
    """``(term_bucket, term, doc_block, top, docs)``: largest impact and number of documents."""
    return postings.groupBy("term_bucket", "term", "doc_block").agg(
        F.max(impact(F.col("doc_tf"), F.col("dl"), avg_dl)).alias("top"), F.count_if(first_of_key()).alias("docs"))


def write_index(docs: DataFrame, path: str, key: str = "link", title: str = "title",
                body: str = "body", buckets: int = DEFAULT_BUCKETS, mode: str = "overwrite",
                block_docs: int = BLOCK_DOCS) -> None:
    """Persist documents, the corpus statistics (one row), postings, block maxima and lexicon."""
    spark = docs.sparkSession
    write_documents(docs, f"{path}/docs", key, title, body, buckets, mode)
    stored = spark.read.parquet(f"{path}/docs")
    slots = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (block_docs * LENGTH_CLASSES))).cast("int")
    stored.agg(F.count(F.lit(1)).cast("double").alias("n_docs"), F.avg("dl").alias("avg_dl"), slots.alias("slots")) \
        .write.mode(mode).parquet(f"{path}/stats")
    stats = read_stats(spark, path)
    row = stats.first()
    placed = place_documents(stored.select(key, title, body), row["n_docs"] * (row["avg_dl"] or 0), key, row["slots"])
    write_postings(fts_postings(placed, key, title, body, placed=True), f"{path}/postings", key, buckets, mode, row["slots"])
    (block_maxima(spark.read.parquet(f"{path}/postings"), corpus_stats(stats)[1])
     .sortWithinPartitions("term_bucket", "term")
     .write.mode(mode).partitionBy("term_bucket").parquet(f"{path}/blocks"))
    (spark.read.parquet(f"{path}/blocks").groupBy("term", "term_bucket").agg(F.sum("docs").alias("docs"))
     .repartitionByRange("term").sortWithinPartitions("term").write.mode(mode).parquet(f"{path}/lexicon"))


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/blocks")


def read_lexicon(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/lexicon")


def read_index(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(postings, documents with ``dl``); see ``read_stats`` for the corpus statistics."""
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/docs")


def read_stats(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/stats")


def postings_for(postings: DataFrame, terms: list[str], buckets: int | None = None) -> DataFrame:
    """Postings of the given terms; with a persisted index the bucket predicate, a constant
    after folding, prunes the partitions that are read."""
    p = postings
    if buckets is not None and "term_bucket" in postings.columns:
        wanted = F.lit(False)
        for t in terms:
            wanted = wanted | (F.col("term_bucket") == term_bucket(F.lit(t), buckets))
        p = p.filter(wanted)
    return p.filter(F.col("term").isin(*terms))


def fetch_documents(docs: DataFrame, ranked: DataFrame, key: str = "link", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """The stored documents of the ranked keys (a top-k, so the broadcast side is bounded by
    k); joining on the stored bucket as well lets Spark prune the partitions at run time."""
    keyed = ranked.withColumn("doc_bucket", term_bucket(F.col(key), buckets))
    return docs.join(F.broadcast(keyed), ["doc_bucket", key]).drop("doc_bucket", "dl")


def bm25_scores(hits: DataFrame, n_docs: Column, avg_dl: Column, key: str = "link",
                require_all: int | None = None) -> DataFrame:
    """hits (term, key, col, tf, dl) -> (key, rank, matched_terms).

    ``require_all`` = number of distinct query terms for implicit AND (None = any term).
    """
    per_doc_term = hits.groupBy(key, "term").agg(F.sum("tf").alias("f"), F.max("dl").alias("dl"))
    # document frequency per query term: at most one row per query term (tiny, broadcast)
    dfreq = per_doc_term.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    idf_raw = F.log((n_docs - F.col("n") + 0.5) / (F.col("n") + 0.5))
    dfreq = dfreq.select("term", F.when(idf_raw <= 0, F.lit(IDF_FLOOR)).otherwise(idf_raw).alias("idf"))
    scored = per_doc_term.join(F.broadcast(dfreq), "term")
    f, dl = F.col("f"), F.col("dl")
    contrib = F.col("idf") * f * (K1 + 1) / (f + K1 * (1 - B + B * dl / avg_dl))
    out = scored.groupBy(key).agg((-F.sum(contrib)).alias("rank"),
                                  F.count(F.lit(1)).alias("matched_terms"))
    if require_all is not None:
        out = out.filter(F.col("matched_terms") == require_all)
    return out


def corpus_stats(stats: DataFrame) -> tuple[Column, Column]:
    """(N, avgD), two numbers fetched once: from the stored one-row table, or aggregated over
    per-document lengths."""
    if "avg_dl" in stats.columns:
        r = stats.select(F.col("n_docs").alias("n"), F.col("avg_dl").alias("a")).first()
    else:
        r = stats.agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("dl").alias("a")).first()
    return F.lit(r["n"]), F.lit(r["a"] if r["a"] is not None else 1.0)


def idf_value(n_docs: float, n: float) -> float:
    """ln((N - n + 0.5) / (n + 0.5)), floored at 1e-6 when not positive."""
    import math
    v = math.log((n_docs - n + 0.5) / (n + 0.5))
    return IDF_FLOOR if v <= 0 else v


def bm25_topk(postings: DataFrame, stats: DataFrame, terms: list[str], limit: int = 20,
              key: str = "link", mode: str = "all", buckets: int | None = None) -> DataFrame:
    """Top ``limit`` documents by BM25 (rank ASC, ties by key); ``limit <= 0`` or no terms -> empty."""
    n_docs, avg_dl = corpus_stats(stats)
    hits = postings_for(postings, terms, buckets)
    scored = bm25_scores(hits, n_docs, avg_dl, key, len(terms) if mode == "all" else None)
    if limit <= 0 or not terms:
        return scored.limit(0)
    return scored.orderBy(F.asc("rank"), F.asc(key)).limit(limit)


def bm25_topk_blocks(postings: DataFrame, blocks: DataFrame, stats: DataFrame, terms: list[str], limit: int = 20,
                     key: str = "link", mode: str = "all", buckets: int | None = None,
                     first_blocks: int = FIRST_BLOCKS) -> tuple[DataFrame, dict]:
    """``bm25_topk`` that reads only blocks of documents that can hold a result, and what it read.

    The block maxima bound every block's best score.  Blocks are read from the largest bound
    on, in rounds that grow; the ``limit``-th best score so far is a threshold, and no block
    whose bound is below it is read.  The same ranks as ``bm25_topk``; the dictionary has
    ``blocks`` and ``read``.
    """
    from tidewatch.session import checkpoint_dir
    n_docs, avg_dl = corpus_stats(stats)
    mine = postings_for(blocks, terms, buckets)
    df = {r["term"]: r["n"] for r in mine.groupBy("term").agg(F.sum("docs").alias("n")).collect()} if terms else {}
    empty = postings.select(key, F.lit(0.0).alias("rank"), F.lit(0).cast("bigint").alias("matched_terms")).limit(0)
    if limit <= 0 or not df or (mode == "all" and len(df) < len(terms)):
        return empty, {"blocks": 0, "read": 0}
    idf_of = F.create_map(*[F.lit(v) for t, n in sorted(df.items()) for v in (t, idf_value(stats.first()["n_docs"], n))])
    bounds = mine.groupBy("doc_block").agg(F.sum(idf_of[F.col("term")] * F.col("top")).alias("bound"), F.count(F.lit(1)).alias("held"))
    if mode == "all":
        bounds = bounds.filter(F.col("held") == len(terms))
    checkpoint_dir(bounds.sparkSession)
    bounds = bounds.select("doc_block", "bound").checkpoint(eager=True)
    total = bounds.count()

    def scored(chosen: DataFrame) -> DataFrame:
        hits = postings_for(postings, terms, buckets).join(chosen.select("doc_block"), "doc_block", "left_semi")
        per_doc = hits.groupBy(key, "term").agg(F.sum("tf").alias("f"), F.max("dl").alias("dl"))
        part = idf_of[F.col("term")] * impact(F.col("f"), F.col("dl"), avg_dl)
        out = per_doc.groupBy(key).agg((-F.sum(part)).alias("rank"), F.count(F.lit(1)).alias("matched_terms"))
        if mode == "all":
            out = out.filter(F.col("matched_terms") == len(terms))
        return out.orderBy(F.asc("rank"), F.asc(key)).limit(limit)

    best, threshold, last, read = None, None, None, 0
    while True:
        left = bounds
        if last is not None:  # behind the blocks read so far
            left = left.filter((F.col("bound") < last["bound"])
                               | ((F.col("bound") == last["bound"]) & (F.col("doc_block") > last["doc_block"])))
        if threshold is not None:  # a tie counts; sums may differ in the last digits
            left = left.filter(F.col("bound") * (1 + 1e-9) >= threshold)
        chosen = left.orderBy(F.desc("bound"), F.asc("doc_block")).limit(first_blocks).checkpoint(eager=True)
        seen = chosen.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(-F.col("bound"), F.col("doc_block"))).alias("end")).first()
        if seen["n"] == 0:
            break
        read += seen["n"]
        last = {"bound": -seen["end"][0], "doc_block": seen["end"][1]}
        top = scored(chosen) if best is None else best.unionByName(scored(chosen)).orderBy(F.asc("rank"), F.asc(key)).limit(limit)
        best = top.checkpoint(eager=True)  # at most ``limit`` rows
        found = best.agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("worst")).first()
        if seen["n"] < first_blocks:
            break
        threshold = -found["worst"] if found["n"] == limit else None
        first_blocks *= BLOCK_GROWTH
    return empty if best is None else best, {"blocks": total, "read": read}


def fts_match_all(postings: DataFrame, terms: list[str], key: str = "link", buckets: int | None = None) -> DataFrame:
    """Documents containing every term (in any column)."""
    return (postings_for(postings, terms, buckets).groupBy(key)
            .agg(F.count_distinct("term").alias("k")).filter(F.col("k") == len(terms)).select(key))


def fts_any(postings: DataFrame, terms: list[str], key: str = "link", buckets: int | None = None) -> DataFrame:
    return postings_for(postings, terms, buckets).select(key).distinct()


def fts_prefix(postings: DataFrame, prefix: str, key: str = "link", lexicon: DataFrame | None = None) -> DataFrame:
    """Documents with a token starting with ``prefix``.

    With the index's lexicon the prefix is a range of its ordered terms; their buckets (a few
    numbers) become a constant predicate that prunes the postings' partitions.
    """
    p = postings
    if lexicon is not None:
        found = lexicon.filter(F.col("term").startswith(prefix)).select("term_bucket").distinct().collect()
        p = p.filter(F.col("term_bucket").isin(*[r[0] for r in found])) if found else p.limit(0)
    return p.filter(F.col("term").startswith(prefix)).select(key).distinct()


def fts_phrase(postings: DataFrame, phrase_terms: list[str], key: str = "link",
               buckets: int | None = None) -> DataFrame:
    """Documents where the terms occur consecutively inside one column.

    One exchange brings the terms' positions of a (document, column) together, one entry per
    distinct term; the terms are then matched one after the other without moving again.
    """
    if not phrase_terms:
        return postings.select(key).limit(0)
    distinct = sorted(set(phrase_terms))
    entry = F.struct("term", "positions")
    held = (postings_for(postings, distinct, buckets).groupBy(key, "col")
            .agg(F.collect_list(entry).alias("held")).filter(F.size("held") == len(distinct))
            .select(key, F.map_from_entries("held").alias("held")))
    held = held.withColumn("ends", F.element_at("held", F.lit(phrase_terms[0])))
    for t in phrase_terms[1:]:
        held = held.withColumn("ends", F.array_intersect(
            F.transform("ends", lambda x: x + 1), F.element_at("held", F.lit(t)))).filter(F.size("ends") > 0)
    return held.select(key).distinct()


def with_snippet(docs: DataFrame, terms: list[str], body: str = "body",
                 width: int = SNIPPET_TOKENS) -> DataFrame:
    """Adds ``snippet``: up to ``width`` body tokens around the hits, hits wrapped in <b></b>,
    '...' where the excerpt is cut.  The window is the one starting at a hit that covers the
    most distinct query terms (earliest wins); without a hit, the first ``width`` tokens.
    """
    from tidewatch.functions.text import TOKEN_PATTERN
    q = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    d = (docs.withColumn("_sn_f", fts_tokens(F.col(body)))
         .withColumn("_sn_r", F.coalesce(F.regexp_extract_all(F.col(body), F.lit(TOKEN_PATTERN), 0),
                                         F.array().cast("array<string>"))))
    f = F.col("_sn_f")
    idx = F.when(F.size(f) > 0, F.sequence(F.lit(0), F.size(f) - 1)).otherwise(
        F.array().cast("array<int>"))
    d = d.withColumn("_sn_h", F.filter(idx, lambda i: F.array_contains(q, F.try_element_at(f, i + 1)))
                     if terms else F.array().cast("array<int>"))
    h = F.col("_sn_h")
    coverage = F.transform(h, lambda s: F.struct(
        (-F.size(F.array_distinct(F.transform(
            F.filter(h, lambda p: (p >= s) & (p < s + width)), lambda p: F.try_element_at(f, p + 1)))))
        .alias("neg"), s.alias("start")))
    d = d.withColumn("_sn_s", F.when(F.size(h) > 0, F.array_min(coverage)["start"]).otherwise(F.lit(0)))
    s, r = F.col("_sn_s"), F.col("_sn_r")
    marked = F.transform(F.slice(r, s + 1, width), lambda t, i: F.when(
        F.array_contains(h, s + i), F.concat(F.lit(SNIPPET_OPEN), t, F.lit(SNIPPET_CLOSE))).otherwise(t))
    text = F.concat(F.when(s > 0, F.lit(SNIPPET_ELLIPSIS)).otherwise(F.lit("")),
                    F.array_join(marked, " "),
                    F.when(s + width < F.size(r), F.lit(SNIPPET_ELLIPSIS)).otherwise(F.lit("")))
    return d.withColumn("snippet", text).drop("_sn_f", "_sn_r", "_sn_h", "_sn_s")


def _term_pattern(term: str) -> str:
    tok = r"[\p{L}\p{N}\p{Co}]"
    return f"(?<!{tok})\\Q{term}\\E(?!{tok})"


def bm25_scan(docs: DataFrame, terms: list[str], limit: int = 20, key: str = "link",
              title: str = "title", body: str = "body", mode: str = "all") -> DataFrame:
    """BM25 top-k straight from the documents, without building postings.

    Per document, token counts come from ``regexp_count`` over the folded text (no token
    arrays are materialised, no per-token rows): ``dl`` for every document and ``f`` for
    each query term.  These numbers are checkpointed so the text is read once; corpus
    statistics (N, mean length, per-term document frequency) are one aggregate over them;
    scoring and the filter are narrow, so the only exchange is the final top-k.  Same
    ranks as ``bm25_topk`` over postings.
    """
    from tidewatch.functions.text import TOKEN_PATTERN, fts_fold
    d = docs.select(key, fts_fold(F.coalesce(F.col(title), F.lit(""))).alias("_ft"),
                    fts_fold(F.coalesce(F.col(body), F.lit(""))).alias("_fb"))
    cols = [(F.regexp_count("_ft", F.lit(TOKEN_PATTERN)) + F.regexp_count("_fb", F.lit(TOKEN_PATTERN)))
            .cast("double").alias("dl")]
    for i, t in enumerate(terms):
        p = F.lit(_term_pattern(t))
        cols.append((F.regexp_count("_ft", p) + F.regexp_count("_fb", p)).cast("double").alias(f"f{i}"))
    d = d.select(key, *cols)
    if limit <= 0 or not terms:
        return d.select(key, F.lit(0.0).alias("rank")).limit(0)
    # the text is scanned once: per-document numbers (one small row per document) are
    # checkpointed to the shared checkpoint folder, then read by the statistics and the scoring
    from tidewatch.session import checkpoint_dir
    checkpoint_dir(d.sparkSession)
    d = d.checkpoint(eager=True)
    # corpus statistics: one aggregate, 2 + len(terms) numbers fetched once
    st = d.agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("dl").alias("avgdl"),
               *[F.count_if(F.col(f"f{i}") > 0).cast("double").alias(f"n{i}")
                 for i in range(len(terms))]).first()
    score = None
    for i in range(len(terms)):
        f = F.col(f"f{i}")
        idf = idf_value(st["n"], st[f"n{i}"])
        part = F.lit(idf) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("dl") / F.lit(st["avgdl"] or 1.0)))
        score = part if score is None else score + part
    hit = [F.col(f"f{i}") > 0 for i in range(len(terms))]
    cond = hit[0]
    for h in hit[1:]:
        cond = (cond & h) if mode == "all" else (cond | h)
    return (d.filter(cond).select(key, (-score).alias("rank"))
            .orderBy(F.asc("rank"), F.asc(key)).limit(limit))
