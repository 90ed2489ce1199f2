"""Corpus pipeline over ``documents``: each stage works on all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import line_dedup, mixing, packing, quality, simhash
from tidewatch.llm.shared import materialize, read_docs

SHINGLE_WORDS, MAX_BITS = 3, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and the quality classifier."""
    model = quality.train_quality(docs, read_docs(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, carry=True)


def line_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source; ``n_chars`` follows."""
    return line_dedup.drop_boilerplate(docs, chars_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash.keep_representatives(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix: the columns of documents, then ``mix_block``,
    ``mix_slot`` and ``mix_offset``, which the packing reads (stored rows have no order)."""
    return mixing.mix_sources(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset; ``first_slot`` and ``first_offset`` give each
    sequence the mix place of its earliest document, the order in which to read them."""
    return packing.in_mix_order(packing.pack_documents(docs, carry=("mix_slot", "mix_offset")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_boilerplate),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed_sequences),
]

#: A trained classifier, XXH64 fingerprints and a tokenizer are beyond SQL; the stages and the
#: whole run are tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read_docs(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-").lower())
    return docs
