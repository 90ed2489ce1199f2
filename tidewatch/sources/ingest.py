"""Landed payloads -> canonical article rows.

Fetching is not Spark work; these operators start from landed payload rows
``(source_name, category, source_ord, item_ord, payload)`` -- one feed item (RSS or Atom, XML
text) or one API response (JSON text) per row -- and normalise them in bulk with ``from_xml``
/ ``from_json``, ``posexplode`` and column expressions.

Nothing is lost on the way: every ``parse_*`` function returns each item or list entry with
an ``outcome`` (article, skipped or error, with a message), and the ``ingest_*`` functions
are its articles.  No payload is left out unless a ``limit`` per source is asked for.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import (explode_rows, join_non_empty, parse_feed_date,
                                      parse_iso_datetime, parse_unix_timestamp, strip_py)

# --- fixed values: defaults, link templates, supported types -------------------------------
UNTITLED = "Untitled"
UNKNOWN_ARTIST = "Unknown artist"
NO_DESCRIPTION = "No description available"
NO_TITLE = "(no title)"
MET_LINK = "https://www.metmuseum.org/art/collection/search/"
AIC_LINK = "https://www.artic.edu/artworks/"
SI_LINK = "https://collections.si.edu/search/"
SI_NOTE_LABELS = ("Summary", "Description")
SUPPORTED_TYPES = ("rss", "met_museum", "aic", "smithsonian")
BROWSER_TYPES = ("javascript", "browser")
# -------------------------------------------------------------------------------------------

ARTICLE_COLS = ["title", "link", "summary", "published", "source", "category", "source_ord", "item_ord"]

ARTICLE, SKIPPED, ERROR = "article", "skipped", "error"
CORRUPT = "_corrupt"
XML_OPTIONS = {"ignoreNamespace": "true", "attributePrefix": "_", "valueTag": "_VALUE",
               "columnNameOfCorruptRecord": CORRUPT}
# RSS puts the address in <link>, Atom in the attribute of one of several <link href=..>
LINKS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("_VALUE", "_href", "_rel")]))
RSS_ITEM_SCHEMA = T.StructType([T.StructField("link", LINKS)] + [T.StructField(n, T.StringType()) for n in (
    "title", "summary", "description", "content", "encoded", "pubDate", "published", "updated", "date", CORRUPT)])


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else x)


def html_unescape(df: DataFrame, cols: list[str]) -> DataFrame:
    """HTML entities -> text.  Only rows containing '&' reach the Python UDF (split + union;
    a CASE WHEN would still ship every row to Python)."""
    has = None
    for c in cols:
        cond = F.coalesce(F.instr(F.col(c), "&") > 0, F.lit(False))
        has = cond if has is None else (has | cond)
    plain = df.filter(~has)
    # rows with entities are few in bytes; keep them spread so the Python stage is parallel
    ent = df.filter(has).repartition(df.sparkSession.sparkContext.defaultParallelism)
    for c in cols:
        ent = ent.withColumn(c, _unescape(F.col(c)))
    return plain.unionByName(ent)


# Salt buckets for the first phase of the per-source limit (splits a hot source).
LIMIT_SALTS = 32


def first_per_source(df: DataFrame, limit: int | None, order: str = "item_ord",
                     salts: int = LIMIT_SALTS) -> DataFrame:
    """First ``limit`` rows per source in item order (the limit is applied before any skip);
    all rows if it is None.

    Two phases, exact: the first ``limit`` rows of every (source, salt) slice are a superset
    of the source's first ``limit`` rows, so a source holding a large share of the rows is
    sorted by ``salts`` tasks instead of one, and the final window sees at most
    ``salts * limit`` rows per source.
    """
    if limit is None:
        return df
    if limit <= 0:
        return df.limit(0)
    salt = F.pmod(F.xxhash64(F.col(order)), F.lit(salts))
    w1 = Window.partitionBy("source_name", "_salt").orderBy(order)
    pre = (df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(w1))
           .filter(F.col("_rn") <= limit).drop("_rn", "_salt"))
    w = Window.partitionBy("source_name").orderBy(order)
    return pre.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")


def _nz(c: Column) -> Column:
    """Python ``str(x or '')`` for a string column."""
    return F.coalesce(c, F.lit(""))


def _error(what: str) -> Column:
    return F.concat(F.col("source_name"), F.lit(f": {what}"))


def _outcome(error: Column, skipped: Column) -> tuple[Column, Column]:
    """``(outcome, message)`` from the error message (NULL if none) and the skip condition."""
    return (F.when(error.isNotNull(), F.lit(ERROR)).when(skipped, F.lit(SKIPPED)).otherwise(F.lit(ARTICLE))
            .alias("outcome"), error.alias("message"))


def _articles(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("outcome") == ARTICLE).select(*ARTICLE_COLS)


def parse_errors(parsed: DataFrame) -> DataFrame:
    """(source, kind, message) of what could not be read."""
    return parsed.filter(F.col("outcome") == ERROR).select("source", F.lit("parse").alias("kind"), "message")


def parse_rss(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Feed items (RSS ``<item>`` or Atom ``<entry>``) with their outcome.

    summary = first non-empty of summary / description / content / content:encoded; the link is
    the text of ``<link>`` or the address of the first Atom link that is no side link; title
    and summary are stripped and HTML-unescaped.  Items with an empty title, '(no title)' or
    an empty link are skipped (after the per-source limit); what is no XML is an error.
    """
    it = first_per_source(items, limit).withColumn("p", F.from_xml(F.col("payload"), RSS_ITEM_SCHEMA, XML_OPTIONS)).select(
        "source_name", "category", "source_ord", "item_ord", "payload", "p.*")
    bad = F.coalesce(F.col(CORRUPT).isNotNull() | (strip_py(_nz(F.col("payload"))) == ""), F.lit(True))
    addresses = F.transform(
        F.filter(F.col("link"), lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"),
        lambda x: F.coalesce(F.nullif(strip_py(_nz(x["_VALUE"])), F.lit("")), strip_py(_nz(x["_href"]))))
    link = F.coalesce(F.get(F.filter(addresses, lambda x: x != ""), F.lit(0)), F.lit(""))
    summary = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("summary", "description", "content", "encoded")],
                         F.lit(""))
    date_text = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("published", "pubDate", "updated", "date")])
    it = it.withColumn("day", date_text)  # a column of its own: the parser names it many times
    out = it.select(strip_py(_nz(F.col("title"))).alias("title"), link.alias("link"),
                    strip_py(summary).alias("summary"),
                    parse_feed_date(F.col("day")).alias("published"),
                    F.col("source_name").alias("source"), "category", "source_ord", "item_ord",
                    F.when(bad, _error("malformed feed item")).alias("failed"))
    out = html_unescape(out, ["title", "summary"])
    blank = (F.col("title") == "") | (F.col("title") == NO_TITLE) | (F.col("link") == "")
    return out.select(*ARTICLE_COLS, *_outcome(F.col("failed"), blank))


def ingest_rss(items: DataFrame, limit: int | None = None) -> DataFrame:
    """The articles among feed items; see ``parse_rss``."""
    return _articles(parse_rss(items, limit))


MET_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "objectID", "title", "artistDisplayName", "objectDate", "medium", "objectURL", "metadataDate")])


def _museum_fields(title: Column, artist: Column, date: Column, medium: Column) -> tuple[Column, Column]:
    t = F.coalesce(F.nullif(strip_py(F.coalesce(F.nullif(title, F.lit("")), F.lit(UNTITLED))), F.lit("")),
                   F.lit(UNTITLED))
    a = strip_py(F.coalesce(F.nullif(artist, F.lit("")), F.lit(UNKNOWN_ARTIST)))
    s = join_non_empty([a, strip_py(_nz(date)), strip_py(_nz(medium))], ". ", NO_DESCRIPTION)
    return t, s


def parse_met(objects: DataFrame, limit: int | None = None) -> DataFrame:
    """Object payloads with their outcome.  JSON that is no object is skipped, as an object
    that was taken down is; what is no JSON is an error."""
    o = first_per_source(objects, limit)
    is_obj = F.coalesce(F.trim(F.col("payload")).startswith("{"), F.lit(False))
    o = o.withColumn("d", F.when(is_obj, F.from_json(F.col("payload"), MET_SCHEMA)))
    title, summary = _museum_fields(F.col("d.title"), F.col("d.artistDisplayName"),
                                    F.col("d.objectDate"), F.col("d.medium"))
    link = F.coalesce(F.nullif(F.col("d.objectURL"), F.lit("")),
                      F.concat(F.lit(MET_LINK), _nz(F.col("d.objectID"))))
    error = F.when(_no_json(F.col("payload")), _error("malformed object payload"))
    return o.select(title.alias("title"), link.alias("link"), summary.alias("summary"),
                    parse_iso_datetime(F.col("d.metadataDate")).alias("published"),
                    F.col("source_name").alias("source"), "category", "source_ord", "item_ord",
                    *_outcome(error, ~is_obj))


def _no_json(payload: Column) -> Column:
    """NULL, blank or not readable as JSON."""
    return F.coalesce(F.try_parse_json(payload).isNull(), F.lit(True))


def ingest_met(objects: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles, number of skipped payloads per source)."""
    parsed = parse_met(objects, limit)
    skipped = parsed.groupBy(F.col("source").alias("source_name")).agg(
        F.count_if(F.col("outcome") == SKIPPED).cast("bigint").alias("skipped"))
    return _articles(parsed), skipped


AIC_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(T.StructType([
    T.StructField(n, T.StringType()) for n in (
        "id", "title", "artist_display", "date_display", "medium_display", "department_title")])))])


def _listed(pages: DataFrame, entries: Column, limit: int | None) -> DataFrame:
    """One row per list entry ``r`` at ``pos``; a response without a list keeps one row."""
    rows = pages.select("source_name", "category", "source_ord", "item_ord", "payload",
                        F.posexplode_outer(entries).alias("pos", "r"))
    return rows if limit is None else rows.filter(F.col("pos").isNull() | (F.col("pos") < limit))


def _list_outcome() -> tuple[Column, Column]:
    """An unreadable response or entry is an error, a response without entries is skipped."""
    error = F.when(_no_json(F.col("payload")), _error("malformed response")).when(
        F.col("pos").isNotNull() & F.col("r").isNull(), _error("malformed entry"))
    return _outcome(error, F.col("r").isNull())


def _list_ord() -> Column:
    return (F.col("item_ord") * 100000 + F.coalesce("pos", F.lit(0))).alias("item_ord")


def parse_aic(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """``data[]`` list responses with their outcome (first ``limit`` entries of each)."""
    rows = _listed(pages, F.from_json(F.col("payload"), AIC_SCHEMA)["data"], limit)
    title, summary = _museum_fields(F.col("r.title"), F.col("r.artist_display"),
                                    F.col("r.date_display"), F.col("r.medium_display"))
    return rows.select(title.alias("title"),
                       F.concat(F.lit(AIC_LINK), F.coalesce(F.col("r.id"), F.lit("None"))).alias("link"),
                       summary.alias("summary"), F.lit(None).cast("timestamp_ntz").alias("published"),
                       F.col("source_name").alias("source"), "category", "source_ord", _list_ord(), *_list_outcome())


def ingest_aic(pages: DataFrame, limit: int | None = None) -> DataFrame:
    return _articles(parse_aic(pages, limit))


SI_SCHEMA = T.StructType([T.StructField("response", T.StructType([T.StructField("rows", T.ArrayType(
    T.StructType([
        T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("content", T.StructType([
            T.StructField("descriptiveNonRepeating", T.StructType([
                T.StructField("record_link", T.StringType()), T.StructField("data_source", T.StringType())])),
            T.StructField("freetext", T.StructType([T.StructField("notes", T.ArrayType(T.StructType([
                T.StructField("label", T.StringType()), T.StructField("content", T.StringType())])))]))]))])))]))])


def parse_smithsonian(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """``response.rows[]`` with their outcome; summary from the first Summary/Description note;
    ``data_source`` replaces the configured source name when present."""
    rows = _listed(pages, F.from_json(F.col("payload"), SI_SCHEMA)["response"]["rows"], limit)
    notes = F.col("r.content.freetext.notes")
    note = F.try_element_at(F.filter(notes, lambda n: n["label"].isin(*SI_NOTE_LABELS)), F.lit(1))
    summary = F.when(note.isNotNull(), F.coalesce(F.nullif(note["content"], F.lit("")), F.lit(NO_DESCRIPTION))
                     ).otherwise(F.lit(NO_DESCRIPTION))
    title = F.coalesce(F.nullif(strip_py(F.coalesce(F.nullif(F.col("r.title"), F.lit("")), F.lit(UNTITLED))),
                                F.lit("")), F.lit(UNTITLED))
    link = F.coalesce(F.nullif(F.col("r.content.descriptiveNonRepeating.record_link"), F.lit("")),
                      F.concat(F.lit(SI_LINK), _nz(F.col("r.id"))))
    source = F.coalesce(F.nullif(F.col("r.content.descriptiveNonRepeating.data_source"), F.lit("")),
                        F.col("source_name"))
    return rows.select(title.alias("title"), link.alias("link"), summary.alias("summary"),
                       parse_unix_timestamp(F.col("r.timestamp")).alias("published"),
                       source.alias("source"), "category", "source_ord", _list_ord(), *_list_outcome())


def ingest_smithsonian(pages: DataFrame, limit: int | None = None) -> DataFrame:
    return _articles(parse_smithsonian(pages, limit))


def unsupported_sources(sources: DataFrame) -> DataFrame:
    """Configured sources whose type has no handler -> (name, type, message) error rows."""
    t = F.lower(F.col("type"))
    return (sources.filter(~t.isin(*SUPPORTED_TYPES, *BROWSER_TYPES))
            .select("name", "type", F.concat(F.col("name"), F.lit(": Unsupported source type '"),
                                             F.col("type"), F.lit("'")).alias("message")))


PARSERS = {"rss": parse_rss, "met_museum": parse_met, "aic": parse_aic, "smithsonian": parse_smithsonian}


def dispatch_by_type(sources: DataFrame, payloads: DataFrame, limit: int | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """Route payloads by their source's type; returns (articles, errors).

    ``sources``: (name, type, url, source_ord); ``payloads``: (source_name, category,
    item_ord, payload).  Errors are (source, kind, message): one ``source`` row per configured
    source of an unknown type, one ``parse`` row per payload or entry that cannot be read,
    and one ``route`` row per payload whose source is not configured or has no parser for
    landed payloads (browser types).  The source table is joined by name (Spark broadcasts it
    by measured size).
    """
    known = sources.select(F.col("name").alias("source_name"), F.lower("type").alias("_type"), "source_ord")
    typed = payloads.drop("source_ord").join(known, "source_name", "left")
    parsed = None
    for kind, parse in PARSERS.items():
        part = parse(typed.filter(F.col("_type") == kind).drop("_type"), limit)
        parsed = part if parsed is None else parsed.unionByName(part)
    unrouted = typed.filter(~F.coalesce(F.col("_type").isin(*PARSERS), F.lit(False))).select(
        F.col("source_name").alias("source"), F.lit("route").alias("kind"),
        F.concat(F.coalesce("source_name", F.lit("")), F.when(F.col("_type").isNull(), F.lit(": source is not configured"))
                 .otherwise(F.concat(F.lit(": no parser for payloads of type '"), F.col("_type"), F.lit("'")))).alias("message"))
    by_source = unsupported_sources(sources).select(F.col("name").alias("source"), F.lit("source").alias("kind"), "message")
    return _articles(parsed), by_source.unionByName(unrouted).unionByName(parse_errors(parsed))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate per-source results; order is carried by (source_ord, item_ord)."""
    out = frames[0].select(*ARTICLE_COLS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*ARTICLE_COLS))
    return out


def articles_with_source(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Tag articles with their configured source row (articles whose source was replaced,
    e.g. by a data_source field, keep NULL config columns instead of being dropped)."""
    return articles.join(sources.withColumnRenamed("name", "source"), "source", "left")
