"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are put in a seeded pseudo-random order and cut into blocks of
``block_chars`` characters.  A source with ``u`` of ``U`` weight units owes its block ``i``
between slot ``floor(i U / u)`` (release) and slot ``ceil((i + 1) U / u)`` (deadline).  Each
slot goes to the released block with the earliest deadline, which keeps every source less
than one block from its target share at every prefix.  After ``U`` slots every source has
had exactly its ``u`` blocks, so the schedule repeats: one period, whose size depends on the
weights alone, places any number of blocks.  When a source is used up, a new phase starts
in which the others share the slots by their weights; no row is dropped or repeated.

Only DataFrame functions are used.  Rows move once, by (source, hash range): a source that
holds a third of all rows is spread over as many ranges as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import fresh_name, materialize

BLOCK_CHARS = 65536
RESOLUTION = 1000        # weight units that all sources share
TEMPERATURE = 0.5        # default target: share of a source's size to this power
ROWS_PER_RANGE = 5_000   # rows of one source that one window partition orders, about
SEED = "mix"


def source_name(source_col: str) -> Column:
    return F.coalesce(F.col(source_col).cast("string"), F.lit(""))


def row_size(text_col: str) -> Column:
    """Characters of the row and one more, so that empty texts also advance the order."""
    return F.coalesce(F.char_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1


def weight_units(sizes: DataFrame, weights: DataFrame | None = None, resolution: int = RESOLUTION,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """``(source, size, units)``: whole weight units, at least one per source.

    ``weights`` (source, weight) states the targets; a source without a positive weight
    there has the smallest share.  Without ``weights`` the target is size ** temperature.
    """
    if weights is None:
        wanted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        stated = weights.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).agg(
            F.sum(F.col("weight").cast("double")).alias("weight"))
        wanted = sizes.join(stated, "source", "left").withColumn(
            "weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    total = wanted.agg(F.sum("weight")).first()[0] or 1.0
    share = wanted.withColumn("units", F.greatest(F.lit(1), F.round(F.lit(resolution) * F.col("weight") / F.lit(total))))
    return share.select("source", "size", F.col("units").cast("int").alias("units"))


#: Earliest deadline first over one period: ``u`` holds the units of the sources that take part,
#: the result the index of the source that each slot goes to.
EDF = """
aggregate(
  sequence(0L, total - 1),
  named_struct('done', transform(u, x -> 0L), 'slots', cast(array() as array<int>)),
  (s, t) -> transform(
    array(array_min(filter(
      transform(u, (x, i) -> IF(s.done[i] < x AND (s.done[i] * total) div x <= t,
                                named_struct('deadline', ((s.done[i] + 1) * total + x - 1) div x, 'i', i), NULL)),
      c -> c IS NOT NULL)).i),
    p -> named_struct('done', transform(s.done, (d, i) -> IF(i = p, d + 1, d)),
                      'slots', concat(s.slots, array(p))))[0],
  s -> s.slots)
"""


def mix_plan(units: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per source: its units and, for each phase it takes part in, when the phase
    starts and ends (in periods), its first slot, its period and the source's slots in it.

    The number of sources and their units bound this table, not the rows of the corpus.
    """
    sized = (units.withColumn("n_blocks", F.ceil(F.col("size") / F.lit(block_chars)).cast("long"))
             .withColumn("periods", F.ceil(F.col("n_blocks") / F.col("units")).cast("long")))
    # sources that are still there in the phase that ends with `periods`: all that last as long
    lasting = Window.orderBy(F.col("periods").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    member = F.struct("source", F.col("units").cast("long").alias("units"))
    phases = (sized.select("periods", F.array_sort(F.collect_list(member).over(lasting)).alias("members"))
              .groupBy("periods").agg(F.first("members").alias("members"))
              .withColumn("u", F.transform("members", lambda m: m["units"]))
              .withColumn("total", F.aggregate("u", F.lit(0).cast("long"), lambda a, x: a + x))
              .withColumn("slots", F.expr(EDF)))
    in_order = Window.orderBy("periods")
    phases = (phases.withColumn("start", F.coalesce(F.lag("periods").over(in_order), F.lit(0).cast("long")))
              .withColumn("length", (F.col("periods") - F.col("start")) * F.col("total"))
              .withColumn("base", F.sum("length").over(in_order) - F.col("length")))
    own = phases.select("periods", "start", "base", "total", "slots", F.posexplode("members").alias("at", "member"))
    mine = F.transform(F.filter(F.sequence(F.lit(0), F.size("slots") - 1),
                                lambda t: F.element_at("slots", t + 1) == F.col("at")), lambda t: t.cast("long"))
    phase = F.struct(F.col("periods").alias("end"), "start", "base", "total", mine.alias("slots"))
    return own.groupBy(F.col("member.source").alias("source"), F.col("member.units").alias("units")).agg(
        F.array_sort(F.collect_list(phase)).alias("phases"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source",
                id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
                resolution: int = RESOLUTION, temperature: float = TEMPERATURE) -> DataFrame:
    """All rows of ``docs`` with ``mix_block`` (the block within the source), ``mix_slot`` (the
    block's place in the mix) and ``mix_offset`` (the row's place in the block, in characters).

    Ordering by (mix_slot, mix_offset) gives the mix.  A null source is the source named ''.
    Rows without id are ordered by their text's hash, rows with equal ids by size and text.  Empty and null texts have
    size one.  A text longer than a block starts in one block and covers the next ones, which
    then stay idle.  Input columns of these three names are replaced.
    """
    docs = docs.drop("mix_block", "mix_slot", "mix_offset")
    src, key, size, rng, start, name, units, phases, phase, period, floor = fresh_name(
        docs, "mix_src", "mix_key", "mix_size", "mix_range", "mix_start", "mix_name", "mix_units", "mix_phases",
        "mix_phase", "mix_period", "mix_floor")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.md5(text.cast("binary")))
    keyed = (docs.withColumn(src, source_name(source_col)).withColumn(size, row_size(text_col))
             .withColumn(key, F.md5(F.concat_ws(":", F.lit(SEED), ident).cast("binary"))))
    # a source has as many ranges as its rows ask for; the key is uniform, so equal hash ranges
    # hold about equal parts
    ranges = materialize(
        keyed.groupBy(F.col(src).alias(name)).agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS_PER_RANGE)).cast("long").alias(units)),
        "mix-ranges")
    hashed = F.conv(F.substring(F.col(key), 1, 8), 16, 10).cast("long")
    keyed = keyed.join(ranges, F.col(src) == F.col(name)).withColumn(
        rng, F.shiftright(hashed * F.col(units), 32)).drop(name, units)

    sums = keyed.groupBy(F.col(src).alias("source"), F.col(rng).alias("range")).agg(F.sum(size).alias("chars"))
    grid = ranges.select(F.col(name).alias("source"), F.explode(F.sequence(F.lit(0).cast("long"), F.col(units) - 1)).alias("range"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    floors = materialize(
        grid.join(sums, ["source", "range"], "left").withColumn("chars", F.coalesce("chars", F.lit(0).cast("long")))
        .withColumn("before", F.coalesce(F.sum("chars").over(before), F.lit(0))), "mix-floors")
    plan = mix_plan(weight_units(floors.groupBy("source").agg(F.sum("chars").alias("size")),
                                 weights, resolution, temperature), block_chars)
    starts = floors.groupBy("source").agg(F.transform(  # dense: one start per range
        F.array_sort(F.collect_list(F.struct("range", "before"))), lambda r: r["before"]).alias(floor))
    table = materialize(starts.join(plan, "source").select(
        F.col("source").alias(name), F.col("units").alias(units), F.col("phases").alias(phases), floor), "mix-plan")

    in_range = Window.partitionBy(src, rng).orderBy(key, size, F.xxhash64(F.col(text_col).cast("string"))).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (keyed.withColumn(start, F.coalesce(F.sum(size).over(in_range), F.lit(0)))
              .join(table, F.col(src) == F.col(name))  # broadcast only if the written table is small
              .withColumn(start, F.col(start) + F.get(F.col(floor), F.col(rng).cast("int")))
              .withColumn("mix_block", F.floor(F.col(start) / F.lit(block_chars)).cast("long"))
              .withColumn(period, F.floor(F.col("mix_block") / F.col(units)).cast("long"))
              .withColumn(phase, F.filter(F.col(phases), lambda p: p["end"] > F.col(period))[0]))
    slot = (F.col(phase)["base"] + (F.col(period) - F.col(phase)["start"]) * F.col(phase)["total"]
            + F.element_at(F.col(phase)["slots"], (F.col("mix_block") % F.col(units) + 1).cast("int")))
    return placed.select(*[F.col(c) for c in docs.columns], "mix_block", slot.alias("mix_slot"),
                         (F.col(start) - F.col("mix_block") * F.lit(block_chars)).alias("mix_offset"))
