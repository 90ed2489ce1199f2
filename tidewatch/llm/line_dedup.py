"""Line dedup by site-relative frequency.

A line is boilerplate of a site when it stands on at least ``min_pages`` of the site's pages
and on more than ``max_ratio`` of them.  Pages with such lines lose them.  Only DataFrame
functions are used:

1. Each page's distinct lines become 128-bit hashes (the text of the lines never moves), and
   one aggregate, combined before the shuffle, counts the pages per (site, line).  A site
   or line that holds a third of all rows is spread over tasks by the hash in the key.
2. The lines over the ratio, at most (mean lines of a page / max_ratio) per site, are written
   to the shared folder as one row per site.
3. Pages meet their site's row in a left join.  The planner broadcasts that table only if its
   written size is below ``autoBroadcastJoinThreshold``; beyond it, a shuffled join runs whose
   hot sites adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import fresh_name, materialize

MAX_RATIO = 0.1
MIN_PAGES = 3
WHITE = " \t\n\u000b\f\r"


def line_key(line: Column) -> Column:
    """128-bit hash of a line without its outer white space."""
    bare = F.trim(line, F.lit(WHITE))
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b"))


def has_text(line: Column) -> Column:
    return F.trim(line, F.lit(WHITE)) != ""


def boilerplate_lines(pages: DataFrame, site_col: str, text_col: str, max_ratio: float = MAX_RATIO,
                      min_pages: int = MIN_PAGES) -> DataFrame:
    """``(site, line)`` keys of the lines over the ratio; a null site is one site of its own."""
    site = F.col(site_col).cast("string").alias("site")
    totals = pages.groupBy(site).agg(F.count(F.lit(1)).alias("site_pages"))
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    keys = F.array_distinct(F.transform(F.filter(lines, has_text), line_key))
    counts = (pages.select(site, F.explode(keys).alias("line")).groupBy("site", "line.a", "line.b")
              .agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= min_pages))
    # one row per site on the right: its size is the number of sites
    joined = counts.alias("c").join(totals.alias("t"), F.col("c.site").eqNullSafe(F.col("t.site")))
    return (joined.where(F.col("n_pages") > F.lit(max_ratio) * F.col("site_pages"))
            .select("c.site", F.struct("a", "b").alias("line"), "n_pages", "site_pages"))


def drop_boilerplate(pages: DataFrame, site_col: str = "source", text_col: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                     chars_col: str | None = None, counts: bool = False) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of the text.

    Every row stays, with its columns, in which only the text changes (and ``chars_col``, if
    given, to the new length).  A null text stays null, an empty one empty; a text that
    loses all lines is empty.  Blank lines are never boilerplate.  Lines are compared
    without their outer white space; repeated rows count as pages.  With ``counts`` the
    columns ``n_lines`` and ``n_dropped`` follow.
    """
    found = boilerplate_lines(pages, site_col, text_col, max_ratio, min_pages)
    site, drop, lines, kept = fresh_name(pages, "line_site", "line_drop", "line_all", "line_kept")
    per_site = materialize(
        found.groupBy(F.col("site").alias(site)).agg(F.collect_set("line").alias(drop)), "boilerplate")
    text = F.col(text_col).cast("string")
    joined = pages.join(per_site, F.col(site_col).cast("string").eqNullSafe(F.col(site)), "left")
    cut = (joined.withColumn(lines, F.split(text, "\n", -1))
           .withColumn(kept, F.when(F.col(drop).isNull(), F.col(lines)).otherwise(
               F.filter(F.col(lines), lambda x: ~F.array_contains(F.col(drop), line_key(x)) | ~has_text(x)))))
    new_text = F.when(F.col(drop).isNull(), text).otherwise(F.array_join(F.col(kept), "\n"))
    columns = [F.when(text.isNull(), F.lit(None)).otherwise(new_text).alias(c) if c == text_col
               else F.char_length(F.coalesce(new_text, F.lit(""))).cast(pages.schema[c].dataType).alias(c)
               if c == chars_col else F.col(c) for c in pages.columns]
    if counts:
        columns += [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long").alias("n_dropped")]
    return cut.select(*columns)
