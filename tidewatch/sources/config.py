"""Category configuration: keyword dictionaries and source lists.

Config files are small, driver-side documents; they become small dimension DataFrames
(or literals inlined in a plan) whose size is checked before any broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# --- fixed values: text fields of an entry and what stands in for a missing one -----------
SOURCE_TEXT = {"name": "Unnamed Source", "type": "rss", "url": ""}
ENTITY_TEXT = {"name": "entity", "display_name": None}      # None: as the name
CATEGORY_TEXT = {"category_name": None, "display_name": None}  # None: see Category.of
# -------------------------------------------------------------------------------------------


def text_fields(entry: dict, declared: dict[str, str | None]) -> dict[str, str | None]:
    """The declared fields of an entry; only text that is not blank counts as given."""
    return {key: entry[key] if str_given(entry.get(key)) else stand_in for key, stand_in in declared.items()}


def str_given(value: Any) -> bool:
    return isinstance(value, str) and value.strip() != ""


@dataclass(frozen=True)
class Entity:
    name: str
    display_name: str
    keywords: tuple[str, ...]

    @classmethod
    def of(cls, entry: dict) -> Entity:
        """Keywords lose their outer white space; blank ones go, repeated ones count again."""
        text = text_fields(entry, ENTITY_TEXT)
        given = entry.get("keywords")
        listed = given if isinstance(given, (list, tuple, set)) else ()
        keywords = tuple(filter(None, map(str.strip, map(str, listed))))
        return cls(text["name"], text["display_name"] or text["name"], keywords)


@dataclass(frozen=True)
class Source:
    name: str
    type: str
    url: str
    extra: dict[str, Any] = field(default_factory=dict, compare=False, hash=False)

    @classmethod
    def of(cls, entry: dict) -> Source:
        return cls(**text_fields(entry, SOURCE_TEXT),
                   extra={key: value for key, value in entry.items() if key not in SOURCE_TEXT})


@dataclass(frozen=True)
class Category:
    category_name: str
    display_name: str
    sources: tuple[Source, ...]
    entities: tuple[Entity, ...]

    @classmethod
    def of(cls, raw: dict, file_name: str) -> Category:
        """A category without a name has the file's; one without a title shows its name."""
        text = text_fields(raw, CATEGORY_TEXT)
        name = text["category_name"] or file_name
        return cls(name, text["display_name"] or name, *(
            tuple(map(kind.of, entries(raw, key))) for kind, key in ((Source, "sources"), (Entity, "entities"))))


def entries(raw: dict, key: str) -> list[dict]:
    """The mappings listed under ``key``; other items are not entries, an empty one is an error."""
    listed = raw.get(key)
    found = [item for item in listed if isinstance(item, dict)] if isinstance(listed, list) else []
    if not all(found):
        raise ValueError(f"an entry of '{key}' is empty")
    return found


def load_category(path: str | Path) -> Category:
    """Read a category file (YAML)."""
    import yaml  # optional dependency, needed for files only

    path = Path(path)
    raw = yaml.safe_load(path.read_text(encoding="utf-8"))
    return Category.of(raw if isinstance(raw, dict) else {}, path.stem)


DICTIONARY_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType(), False),
    T.StructField("display_name", T.StringType(), False),
    T.StructField("entity_ord", T.IntegerType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("keyword_ord", T.IntegerType(), False),
])

SOURCES_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("source_ord", T.IntegerType(), False),
])


def dictionary_rows(entities: tuple[Entity, ...] | list[Entity]) -> list[tuple]:
    """Long form (entity, display_name, entity_ord, keyword, keyword_ord); raw keywords."""
    return [(e.name, e.display_name, i, kw, j)
            for i, e in enumerate(entities) for j, kw in enumerate(e.keywords)]


def dictionary_frame(spark: SparkSession, entities) -> DataFrame:
    return spark.createDataFrame(dictionary_rows(entities), DICTIONARY_SCHEMA)


def sources_frame(spark: SparkSession, sources) -> DataFrame:
    return spark.createDataFrame([(s.name, s.type, s.url, i) for i, s in enumerate(sources)],
                                 SOURCES_SCHEMA)


def entities_from_pairs(pairs) -> tuple[Entity, ...]:
    """[(name, [keywords...]), ...] -> entities, with the same cleaning as the YAML path."""
    return tuple(Entity.of({"name": n, "keywords": list(k)}) for n, k in pairs)


def dictionary_from_corpus(texts: DataFrame, n_words: int = 700, n_phrases: int = 216,
                           n_entities: int = 7, text_col: str = "text",
                           anchor_words: int = 24) -> tuple[Entity, ...]:
    """A large keyword dictionary derived from a corpus by rule: the ``n_words`` most frequent
    word runs (length > 1) and the ``n_phrases`` most frequent two-word phrases starting with
    one of the ``anchor_words`` most frequent words (ties by text), dealt round-robin into
    ``n_entities`` entities in rank order.  Two top-k aggregates; only the top rows reach
    the driver."""
    from pyspark.sql import functions as F
    low = F.lower(F.col(text_col))
    word = r"[\p{L}\p{N}_]+"
    words = (texts.select(F.explode_outer(F.regexp_extract_all(low, F.lit(word), 0)).alias("k"))
             .filter(F.col("k").isNotNull() & (F.length("k") > 1))
             .groupBy("k").count().orderBy(F.desc("count"), "k").limit(n_words))
    top_words = [r["k"] for r in words.collect()]
    # phrases start with one of the most frequent words (one anchored regex pass per text)
    import re as _re
    lead = "|".join(_re.escape(w) for w in sorted(top_words[:anchor_words], key=lambda w: (-len(w), w)))
    pair = (r"(?<![\p{L}\p{N}_])(?=((?:" + lead + r") [\p{L}\p{N}_]+))") if lead else None
    ranked = list(top_words)
    if pair:
        phrases = (texts.select(F.explode_outer(F.regexp_extract_all(low, F.lit(pair), 1)).alias("k"))
                   .filter(F.col("k").isNotNull())
                   .groupBy("k").count().orderBy(F.desc("count"), "k").limit(n_phrases))
        ranked += [r["k"] for r in phrases.collect()]
    buckets: list[list[str]] = [[] for _ in range(n_entities)]
    for i, k in enumerate(ranked):
        buckets[i % n_entities].append(k)
    return tuple(Entity(f"Entity{j}", f"Entity {j}", tuple(b)) for j, b in enumerate(buckets))
