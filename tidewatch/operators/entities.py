"""Dictionary entity matching.

Semantics (per article, haystack = title + "\\n" + summary):

* ASCII keyword  -> case-insensitive match bounded by non-word characters
  (word class = letters, numbers, underscore);
* other keyword  -> plain substring of the lower-cased haystack;
* keywords are lower-cased, kept in config order, duplicates inside one entity count
  again; an entity with no hit is absent; when two entities share a name the later one
  that has a hit wins.

Plan.  A keyword that starts and ends with a word character matches exactly when some
window of ``n`` consecutive *segments* of the folded haystack (maximal runs of word /
non-word characters, the window starting on a word run) equals the keyword, where ``n``
is the keyword's own segment count.  So each article is turned into the set of such
windows (``n`` restricted to the counts present in the dictionary) and intersected with
the dictionary.  With an inlined dictionary this is one narrow projection (hash-based
``array_intersect``): no shuffle, text never leaves its partition.  Dictionaries too
large to inline are joined instead (broadcast when their row count is under the limit); the
plan's size then does not depend on the dictionary.  All other keywords are found by an
anchor join: the text is cut to the longest keyword's length at every character that is not
ASCII, or not a word's, where such a keyword has its first one, and these cuts meet the keywords
on one or two characters from there on (the anchor); a keyword is found where a cut goes on as
it does, and its ASCII start stands before the cut.  A small inlined dictionary uses one
``instr`` per non-ASCII keyword and one literal regex per ASCII keyword with a non-word edge.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import (CASE_EXTRA_FROM, CASE_EXTRA_TO, NON_WORD_CLASS, WORD_CLASS,
                                      explode_rows)

# Largest dictionary matched inline (literals in the plan); the inline entry lookup costs
# O(keywords x matched words) per article, so larger dictionaries use the join plan.
MAX_INLINE_KEYWORDS = 128
# Largest dictionary broadcast in the join form; larger ones are shuffle-joined.
MAX_BROADCAST_KEYWORDS = 500_000

_WORD_RUN = re.compile(r"\w+|\W+")

HIT_TYPE = T.StructType([
    T.StructField("entity_ord", T.IntegerType()),
    T.StructField("keyword_ord", T.IntegerType()),
    T.StructField("entity", T.StringType()),
    T.StructField("keyword", T.StringType()),
])


@dataclass(frozen=True)
class Keyword:
    entity: str
    entity_ord: int
    keyword: str          # lower-cased keyword, the value reported in matches
    keyword_ord: int
    mode: str             # "gram" | "sub" | "regex"
    segments: int         # number of word/non-word runs (gram mode)


def prepare_dictionary(entities) -> list[Keyword]:
    """Entities -> flat keyword list with a matching mode per keyword (driver side, config-sized)."""
    out = []
    for eo, ent in enumerate(entities):
        for ko, raw in enumerate(ent.keywords):
            kw = raw.lower()
            if not kw:
                continue
            if not kw.isascii():
                out.append(Keyword(ent.name, eo, kw, ko, "sub", 0))
            elif re.match(r"\w", kw[0]) and re.match(r"\w", kw[-1]):
                out.append(Keyword(ent.name, eo, kw, ko, "gram", len(_WORD_RUN.findall(kw))))
            else:
                out.append(Keyword(ent.name, eo, kw, ko, "regex", 0))
    return out


def _haystack(title: Column, summary: Column) -> Column:
    return F.concat(F.coalesce(title.cast("string"), F.lit("")), F.lit("\n"),
                    F.coalesce(summary.cast("string"), F.lit("")))


def _folded(hay: Column) -> Column:
    # fold the four non-ASCII characters that case-insensitively equal an ASCII letter
    return F.lower(F.translate(hay, CASE_EXTRA_FROM, CASE_EXTRA_TO))


# Largest number of distinct first words put into one anchored window pattern.
MAX_ANCHORS = 64


def _windows(folded: Column, n: int, anchors: list[str] | None = None) -> Column:
    """All strings of ``n`` consecutive segments (word run, separator, word run, ...) that
    start on a word run -- overlapping windows included -- in one regex pass: a zero-width
    match at each word start whose lookahead captures the window.  With ``anchors`` the
    window must start with one of those words (the first words of the keywords)."""
    words = (n + 1) // 2
    if anchors:
        first = "(?:" + "|".join("\\Q" + a + "\\E" for a in sorted(anchors, key=lambda a: (-len(a), a))) + ")"
    else:
        first = WORD_CLASS + "+"
    window = first + (NON_WORD_CLASS + "+" + WORD_CLASS + "+") * (words - 1)
    pattern = "(?<!" + WORD_CLASS + ")(?=(" + window + "))"
    return F.regexp_extract_all(folded, F.lit(pattern), 1)


def with_candidates(df: DataFrame, folded: str, ns: list[int], out: str = "_tw_c",
                    anchors: dict[int, list[str]] | None = None) -> DataFrame:
    """Add the distinct candidate strings (word runs and n-segment windows) of ``folded``."""
    parts = []
    for n in sorted(set(ns)):
        if n == 1:
            w = F.regexp_extract_all(F.col(folded), F.lit(WORD_CLASS + "+"), 0)
        else:
            a = (anchors or {}).get(n)
            w = _windows(F.col(folded), n, a if a and len(a) <= MAX_ANCHORS else None)
        parts.append(F.coalesce(w, F.array().cast("array<string>")))
    cands = F.array_distinct(parts[0] if len(parts) == 1 else F.concat(*parts))
    return df.withColumn(out, cands)


def _anchors(grams: list[Keyword]) -> dict[int, list[str]]:
    """First word run of each multi-word keyword, per segment count."""
    out: dict[int, set[str]] = {}
    for k in grams:
        if k.segments > 1:
            out.setdefault(k.segments, set()).add(re.match(r"\w+", k.keyword).group(0))
    return {n: sorted(v) for n, v in out.items()}


def _hit_literal(k: Keyword) -> Column:
    return F.struct(F.lit(k.entity_ord).cast("int").alias("entity_ord"),
                    F.lit(k.keyword_ord).cast("int").alias("keyword_ord"),
                    F.lit(k.entity).alias("entity"), F.lit(k.keyword).alias("keyword"))


def _regex_for(kw: str) -> str:
    """Java regex for an ASCII keyword with explicit boundaries (flipped on non-word edges)."""
    body = "\\Q" + kw + "\\E"
    left = f"(?<!{WORD_CLASS})" if re.match(r"\w", kw[0]) else f"(?<={WORD_CLASS})"
    right = f"(?!{WORD_CLASS})" if re.match(r"\w", kw[-1]) else f"(?={WORD_CLASS})"
    return "(?s)" + left + body + right


def _empty_hits() -> Column:
    return F.array().cast(T.ArrayType(HIT_TYPE))


_NON_ASCII = r"[^\x{00}-\x{7f}]"
# The character prefilter costs one regex pass per document; below this many non-ASCII
# keywords the direct substring checks are cheaper.
MIN_KEYWORDS_FOR_CHAR_FILTER = 16


def _wants_char_filter(kws: list[Keyword]) -> bool:
    return sum(1 for k in kws if k.mode == "sub") >= MIN_KEYWORDS_FOR_CHAR_FILTER


def non_ascii_chars(lowered: Column) -> Column:
    """Distinct non-ASCII characters of a text (a small array per document)."""
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(_NON_ASCII), 0))


def _non_gram_hits(kws: list[Keyword], folded: Column, lowered: Column,
                   chars: Column | None = None) -> Column:
    """Checks for keywords outside the window plan.  With ``chars`` (the document's distinct
    non-ASCII characters) a substring check only runs when the keyword's first non-ASCII
    character occurs in the document -- lossless, and it skips most scans when the
    dictionary and the text use different scripts."""
    parts = []
    for k in kws:
        if k.mode == "sub":
            cond = F.instr(lowered, k.keyword) > 0
            if chars is not None:
                first = next(ch for ch in k.keyword if not ch.isascii())
                cond = F.array_contains(chars, first) & cond
            parts.append(F.when(cond, _hit_literal(k)))
        elif k.mode == "regex":
            parts.append(F.when(folded.rlike(_regex_for(k.keyword)), _hit_literal(k)))
    if not parts:
        return _empty_hits()
    return F.filter(F.array(*parts), lambda h: h.isNotNull())


def _has_duplicate_names(kws: list[Keyword]) -> bool:
    seen: dict[str, int] = {}
    for k in kws:
        if seen.setdefault(k.entity, k.entity_ord) != k.entity_ord:
            return True
    return False


def with_hits(articles: DataFrame, entities, out: str = "_hits",
              title: str = "title", summary: str = "summary") -> DataFrame:
    """Add ``out: array<struct<entity_ord, keyword_ord, entity, keyword>>`` (inline plan).

    Work is staged through projected columns, each referenced at least twice by the next
    projection, so Catalyst does not inline an expensive expression into a lambda body
    (where it would be re-evaluated once per dictionary entry).
    """
    kws = prepare_dictionary(entities) if not (entities and isinstance(entities[0], Keyword)) \
        else list(entities)
    hay = _haystack(F.col(title), F.col(summary))
    df = articles.withColumn("_tw_f", _folded(hay)).withColumn("_tw_l", F.lower(hay))
    grams = [k for k in kws if k.mode == "gram"]
    chars = None
    if _wants_char_filter(kws):
        df = df.withColumn("_tw_u", non_ascii_chars(F.col("_tw_l")))
        chars = F.col("_tw_u")
    hits = _non_gram_hits(kws, F.col("_tw_f"), F.col("_tw_l"), chars)
    if grams:
        vocab = F.array(*[F.lit(kw) for kw in sorted({k.keyword for k in grams})])
        df = with_candidates(df, "_tw_f", sorted({k.segments for k in grams}), anchors=_anchors(grams))
        df = df.withColumn("_tw_m", F.array_intersect(F.col("_tw_c"), vocab)).drop("_tw_c")
        table = F.array(*[F.struct(F.lit(k.keyword).alias("kw"), _hit_literal(k).alias("hit"))
                          for k in grams])
        m = F.col("_tw_m")
        gram_hits = F.when(F.size(m) > 0, F.transform(
            F.filter(table, lambda e: F.array_contains(m, e["kw"])), lambda e: e["hit"])
        ).otherwise(_empty_hits())
        hits = F.concat(gram_hits, hits)
    df = df.withColumn("_tw_h", hits)
    if _has_duplicate_names(kws):
        h = F.col("_tw_h")
        df = df.withColumn("_tw_h", F.when(F.size(h) > 1, F.filter(h, lambda x: ~F.exists(
            h, lambda o: (o["entity"] == x["entity"]) & (o["entity_ord"] > x["entity_ord"]))))
            .otherwise(h))
    df = df.withColumn(out, F.array_sort(F.col("_tw_h")))
    return df.drop("_tw_f", "_tw_l", "_tw_m", "_tw_h", "_tw_u")


@dataclass(frozen=True)
class Dictionary:
    """A dictionary as rows, with the few numbers that the join plan is built from."""
    rows: DataFrame                # DICTIONARY_SCHEMA
    size: int
    segments: tuple[int, ...]      # run counts of the keywords found as windows of runs
    anchors: dict[int, list[str]]  # their first words, where they are few
    cuts: dict[str, tuple[int, int, tuple[int, ...]]]  # kind -> ASCII characters before the first other
    #                                                    one, longest keyword, anchor lengths
    repeated_names: bool


DICTIONARY_SCHEMA = ("kw string, entity_ord int, keyword_ord int, entity string, keyword string, kind string, "
                     "anchor string, size int, word_after boolean")
ANCHOR_CHARS = 2
ASCII_CHARS = "".join(map(chr, range(128)))


def _ascii_start(text: Column) -> Column:
    return F.regexp_extract(text, r"^[\x00-\x7f]*", 0)


def _from_other(text: Column) -> Column:
    """The text from its first character on that is not ASCII."""
    return F.substr(text, F.length(_ascii_start(text)) + 1)


def dictionary_frame(keywords: DataFrame) -> Dictionary:
    """A dictionary from rows ``(entity, entity_ord, keyword, keyword_ord)``, which stay distributed.

    Kinds: ``gram`` starts and ends with a word character and is ASCII; ``sub`` is not ASCII;
    ``edge`` starts with another character (and so follows a word character); ``start`` only
    ends with one.  ``word_after``: a word character must follow.  Empty and null keywords are
    left out.
    """
    kw = F.lower("keyword")
    word = "^[A-Za-z0-9_]$"
    first, last = F.left(kw, F.lit(1)).rlike(word), F.right(kw, F.lit(1)).rlike(word)
    kind = (F.when(kw.rlike(r"[^\x00-\x7f]"), "sub").when(first & last, "gram").when(~first, "edge").otherwise("start"))
    anchor = F.left(F.when(kind == "sub", _from_other(kw)).otherwise(kw), F.lit(ANCHOR_CHARS))
    rows = (keywords.filter(kw != "").select(
        kw.alias("kw"), F.col("entity_ord").cast("int").alias("entity_ord"), F.col("keyword_ord").cast("int").alias("keyword_ord"),
        "entity", kw.alias("keyword"), kind.alias("kind"), anchor.alias("anchor"),
        F.length(kw).alias("size"), (~last).alias("word_after")))
    runs = F.size(F.regexp_extract_all("kw", F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_]+"), 0))
    shape = rows.groupBy("kind", F.when(F.col("kind") == "gram", runs).alias("runs")).agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("longest"), F.max(F.length(F.regexp_extract(
            "kw", r"^([\x00-\x7f]*)", 1))).alias("before"), F.collect_set(F.length("anchor")).alias("anchors")).collect()  # a row per run count
    names = rows.groupBy("entity").agg((F.min("entity_ord") < F.max("entity_ord")).alias("again"))
    anchors = {}
    for n in sorted(r.runs for r in shape if r.runs and r.runs > 1):
        found = (rows.filter((F.col("kind") == "gram") & (runs == n)).select(F.regexp_extract("kw", r"^\w+", 0).alias("w"))
                 .distinct().limit(MAX_ANCHORS + 1).collect())
        anchors[n] = sorted(r.w for r in found)
    return Dictionary(rows, sum(r.n for r in shape), tuple(sorted(r.runs for r in shape if r.runs)), anchors,
                      {r.kind: (r.before or 0, r.longest, tuple(sorted(r.anchors))) for r in shape if r.kind != "gram"},
                      bool(names.filter("again").limit(1).count()))


def _listed(spark, kws: list[Keyword]) -> Dictionary:
    """The same from a list on the driver."""
    def row(k: Keyword) -> tuple:
        kind = k.mode if k.mode != "regex" else "start" if re.match(r"\w", k.keyword[0]) else "edge"
        anchor = (k.keyword.lstrip(ASCII_CHARS) if kind == "sub" else k.keyword)[:ANCHOR_CHARS]
        return (k.keyword, k.entity_ord, k.keyword_ord, k.entity, k.keyword, kind, anchor,
                len(k.keyword), not re.match(r"\w", k.keyword[-1], re.ASCII))

    rows = [row(k) for k in kws]
    cuts = {}
    for kind in sorted({r[5] for r in rows} - {"gram"}):
        own = [r for r in rows if r[5] == kind]
        before = max(next((i for i, ch in enumerate(r[0]) if not ch.isascii()), 0) for r in own)
        cuts[kind] = before, max(r[7] for r in own), tuple(sorted({len(r[6]) for r in own}))
    grams = [k for k in kws if k.mode == "gram"]
    return Dictionary(spark.createDataFrame(rows, DICTIONARY_SCHEMA), len(rows), tuple(sorted({k.segments for k in grams})),
                      _anchors(grams), cuts, _has_duplicate_names(kws))


def _cuts(kind: str, folded: Column, lowered: Column, before: int, longest: int) -> Column:
    """Distinct pieces of text, each from a position where a keyword of this kind can start.

    ``sub``: one piece per character that is not ASCII, from the ``before`` ASCII characters
    on that stand before it, or from as many as there are.
    """
    rest = rf"[\s\S]{{0,{longest}}}"
    if kind == "sub":
        one, other = r"[\x00-\x7f]", r"[^\x00-\x7f]"
        edge = rf"(?:^|{other}|{one}(?={one}{{{before}}}{other}))"  # what the ASCII characters follow
        starts = F.regexp_extract_all(lowered, F.lit(rf"(?={other})(?<={edge}({one}{{0,{before}}})){other}"), 1)
        ends = F.regexp_extract_all(lowered, F.lit(rf"(?=({other}{rest})){other}"), 1)
        return F.array_distinct(F.zip_with(starts, ends, lambda a, b: F.concat(a, b)))
    if kind == "edge":
        pattern = rf"(?<={WORD_CLASS})(?=({NON_WORD_CLASS}{rest}))"
    else:
        pattern = rf"(?<!{WORD_CLASS})(?=({WORD_CLASS}{rest}))"
    return F.array_distinct(F.transform(F.regexp_extract_all(folded, F.lit(pattern), 1), lambda c: F.left(c, F.lit(longest + 1))))


def _hits_by_anchor(base: DataFrame, d: Dictionary) -> DataFrame:
    """Hits per distinct text (``TEXT_KEY``) of all keywords that are not windows of runs.

    Only short cuts of the texts are exploded and joined, never the texts; a cut meets the
    keywords that share its first characters.
    """
    found = None
    for kind, (before, longest, lengths) in sorted(d.cuts.items()):
        cuts = base.select(*TEXT_KEY, explode_rows(_cuts(kind, F.col("_f"), F.col("_l"), before, longest)).alias("cut"))
        cuts, dim = cuts.filter(F.col("cut").isNotNull()), d.rows.filter(F.col("kind") == kind)
        if kind == "sub":  # a piece's ASCII start ends with the keyword's
            cuts = cuts.withColumn("start", _ascii_start(F.col("cut"))).withColumn("cut", _from_other(F.col("cut")))
            dim = dim.withColumn("kw_start", _ascii_start(F.col("kw"))).withColumn("kw", _from_other(F.col("kw")))
        cuts = cuts.withColumn("anchor", explode_rows(F.array(*[F.left("cut", F.lit(n)) for n in lengths])))
        if d.size <= MAX_BROADCAST_KEYWORDS:
            dim = F.broadcast(dim)
        after = F.substr("cut", F.col("size") + 1, F.lit(1)).rlike(f"^{WORD_CLASS}$")
        fits = F.endswith("start", "kw_start") if kind == "sub" else after == F.col("word_after")
        one = (cuts.join(dim, "anchor").filter(F.startswith("cut", "kw") & fits)
               .select(*TEXT_KEY, "entity_ord", "keyword_ord", "entity", "keyword"))
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def _hits_by_join(articles: DataFrame, d: Dictionary, key_cols: list[str]) -> DataFrame:
    """Join form for large dictionaries (same result as the inline form).

    One candidate array per article -- word runs and n-segment windows -- is exploded once
    and joined to the dictionary on the keyword string (broadcast below the row limit).  The
    other keywords are found per distinct text and joined back by the text's hash.
    """
    hay = _haystack(F.col("title"), F.col("summary"))
    base = articles.select(*key_cols, *_text_key(hay), _folded(hay).alias("_f"), F.lower(hay).alias("_l"))
    hits = None
    if d.segments:
        dim = d.rows.filter(F.col("kind") == "gram").select("kw", "entity_ord", "keyword_ord", "entity", "keyword")
        if d.size <= MAX_BROADCAST_KEYWORDS:
            dim = F.broadcast(dim)
        cands = (with_candidates(base, "_f", list(d.segments), anchors=d.anchors)
                 .select(*key_cols, *TEXT_KEY, explode_rows("_tw_c").alias("kw")).filter(F.col("kw").isNotNull()))
        hits = cands.join(dim, "kw").drop("kw")
    if d.cuts:
        found = _hits_by_anchor(base, d)
        if key_cols:
            found = base.select(*key_cols, *TEXT_KEY).join(found, list(TEXT_KEY))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = base.select(*key_cols, *TEXT_KEY).join(
            d.rows.select("entity_ord", "keyword_ord", "entity", "keyword").limit(0), F.lit(False))
    if d.repeated_names:
        w = Window.partitionBy(*key_cols, *TEXT_KEY, "entity")  # equal texts have equal hits
        hits = hits.withColumn("_m", F.max("entity_ord").over(w)).filter(
            F.col("entity_ord") == F.col("_m")).drop("_m")
    return hits


TEXT_KEY = ("_tw_k1", "_tw_k2")


def _text_key(hay: Column) -> list[Column]:
    """128-bit hash of the text that is matched: rows with equal texts have equal matches, so
    matches can be regrouped by it whatever keys repeat or are NULL."""
    return [F.xxhash64(hay).alias(TEXT_KEY[0]), F.xxhash64(F.lit("text"), hay).alias(TEXT_KEY[1])]


def entity_hits(articles: DataFrame, entities, key_cols=("link",), mode: str = "auto") -> DataFrame:
    """Long form: one row per (article key, entity, keyword occurrence in the dictionary).

    ``entities``: a list, or a ``Dictionary`` of rows, which is always joined.
    """
    key_cols = list(key_cols)
    kws = None if isinstance(entities, Dictionary) else prepare_dictionary(entities)
    if kws is None or mode == "join" or (mode == "auto" and len(kws) > MAX_INLINE_KEYWORDS):
        d = entities if kws is None else _listed(articles.sparkSession, kws)
        return _hits_by_join(articles, d, key_cols).select(
            *key_cols, "entity", "entity_ord", "keyword", "keyword_ord")
    return (with_hits(articles.select(*key_cols, "title", "summary"), kws)
            .select(*key_cols, explode_rows("_hits").alias("h"))
            .filter(F.col("h").isNotNull())
            .select(*key_cols, "h.entity", "h.entity_ord", "h.keyword", "h.keyword_ord"))


def matches_to_map(hits: Column) -> Column:
    """Sorted hit array -> map<entity, array<keyword>> (empty map when no hit)."""
    names = F.array_distinct(F.transform(hits, lambda h: h["entity"]))
    entries = F.transform(names, lambda n: F.struct(
        n.alias("key"),
        F.transform(F.filter(hits, lambda h: h["entity"] == n), lambda h: h["keyword"]).alias("value")))
    return F.map_from_entries(entries)


def entity_match(articles: DataFrame, entities, mode: str = "auto") -> DataFrame:
    """Articles with ``matched_entities: map<string, array<string>>``; the same rows in either mode.

    Inline plan (small dictionaries): one narrow projection.  Join plan (large
    dictionaries): hits from the broadcast/shuffle join are regrouped per distinct text (at
    most one entry per dictionary keyword) and joined back by the text's hash, so repeated
    and NULL links each keep their own matches.
    """
    kws = None if isinstance(entities, Dictionary) else prepare_dictionary(entities)
    if kws is not None and (mode == "inline" or (mode == "auto" and len(kws) <= MAX_INLINE_KEYWORDS)):
        df = with_hits(articles, kws)
        return df.withColumn("matched_entities", matches_to_map(F.col("_hits"))).drop("_hits")
    hits = _hits_by_join(articles, entities if kws is None else _listed(articles.sparkSession, kws), [])
    per = hits.groupBy(*TEXT_KEY).agg(F.array_sort(F.collect_set(
        F.struct("entity_ord", "keyword_ord", "entity", "keyword"))).alias("_hits"))
    per = per.select(*TEXT_KEY, matches_to_map(F.col("_hits")).alias("matched_entities"))
    keyed = articles.select("*", *_text_key(_haystack(F.col("title"), F.col("summary"))))
    return (keyed.join(per, list(TEXT_KEY), "left").drop(*TEXT_KEY)
            .withColumn("matched_entities", F.coalesce(
                F.col("matched_entities"), F.create_map().cast("map<string,array<string>>"))))


def entity_flags(articles: DataFrame) -> DataFrame:
    """matched yes/no per article from an existing ``matched_entities`` column."""
    m = F.coalesce(F.col("matched_entities"), F.create_map().cast("map<string,array<string>>"))
    return articles.withColumn("matched", F.size(m) > 0)
