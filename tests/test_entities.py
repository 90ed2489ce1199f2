"""Dictionary entity matching: literal cases and equivalence with a brute-force matcher."""

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import entities as ent
from tidewatch.sources import bindings as B
from tidewatch.sources.config import Category, entities_from_pairs
from conftest import SF_SMALL


def articles(spark, rows):
    return spark.createDataFrame(
        [(f"https://example.com/{i}", t, s) for i, (t, s) in enumerate(rows)],
        "link string, title string, summary string")


def match(spark, rows, pairs):
    m = ent.entity_match(articles(spark, rows), entities_from_pairs(pairs))
    return [dict(r["matched_entities"]) for r in m.orderBy("link").collect()]


def test_title_and_summary(spark):
    got = match(spark, [("AI adoption accelerates", "Cloud migration continues.")],
                [("topic", ["ai", "cloud"]), ("lang", ["python"])])
    assert got == [{"topic": ["ai", "cloud"]}]


def test_no_entities_and_no_articles(spark):
    assert match(spark, [("AI", "x")], []) == [{}]
    assert match(spark, [], [("topic", ["ai"])]) == []


def test_case_insensitive_lowercased_config_order(spark):
    got = match(spark, [("Ai and PYTHON", "CLOUD operations")], [("topic", ["AI", "python", "cloud"])])
    assert got == [{"topic": ["ai", "python", "cloud"]}]


@pytest.mark.parametrize("text", ["CHAIR", "PAIR", "MAIL", "chair and pair"])
def test_word_boundary(spark, text):
    assert match(spark, [(text, "")], [("topic", ["ai"])]) == [{}]


def test_word_boundary_hit(spark):
    assert match(spark, [("the AI model", "")], [("topic", ["ai"])]) == [{"topic": ["ai"]}]


def test_non_ascii_substring(spark):
    got = match(spark, [("최신 인공지능기술 동향", "")], [("topic", ["인공지능"])])
    assert got == [{"topic": ["인공지능"]}]


def test_duplicates_boundaries_newline(spark):
    # duplicate keyword repeats; a letter (any script) after 'art' is no boundary;
    # a multi-word keyword cannot span the title/summary newline
    got = match(spark, [("modern art", "x"), ("art미술", "x"), ("modern", "art")],
                [("e", ["art", "art", "modern art"])])
    assert got == [{"e": ["art", "art", "modern art"]}, {}, {"e": ["art", "art"]}]


def test_same_entity_name_later_wins(spark):
    got = match(spark, [("alpha beta", "")], [("X", ["alpha"]), ("Y", ["beta"]), ("X", ["beta"])])
    assert got == [{"X": ["beta"], "Y": ["beta"]}]
    got = match(spark, [("alpha", "")], [("X", ["alpha"]), ("X", ["beta"])])
    assert got == [{"X": ["alpha"]}]


def test_punctuation_keywords(spark):
    got = match(spark, [("mail me at a.b@example.com now", "self-patterning works")],
                [("e", ["example.com", ".com", "self-patterning", "b@example"])])
    assert got == [{"e": ["example.com", ".com", "self-patterning", "b@example"]}]


def test_yaml_dictionary_parsing():
    cat = Category.of({"category_name": "art", "entities": [
        {"name": "Medium", "keywords": [" oil on canvas ", "", "ink", "ink"]},
        {"keywords": ("bronze",)}]}, "art")
    assert cat.entities[0].keywords == ("oil on canvas", "ink", "ink")
    assert cat.entities[1].name == "entity" and cat.entities[1].keywords == ("bronze",)


# --- brute force: the reference semantics written directly with Python's re -----------------
def brute(title, summary, entities):
    hay = f"{title}\n{summary}"
    low = hay.lower()
    out = {}
    for e in entities:
        hits = []
        for kw in e.keywords:
            k = kw.lower()
            if not k:
                continue
            if k.isascii():
                if re.search(r"\b" + re.escape(k) + r"\b", hay, re.IGNORECASE):
                    hits.append(k)
            elif k in low:
                hits.append(k)
        if hits:
            out[e.name] = hits
    return out


BRUTE_DICT = entities_from_pairs([
    ("Function", ["the", "and", "of", "le", "des", "für", "la", "the", "Und", "EN"]),
    ("Phrase", ["of the", "de la", "the the", "in the end", "der die das", "to the"]),
    ("Accent", ["é", "ü", "ñ", "ça", "über", "미술", "ßen"]),
    ("Contact", ["mail2", "example.com", "by-nc", ".com", "@mail"]),
    ("Phrase", ["und", "von der"]),
])


@pytest.mark.parametrize("mode", ["inline", "join"])
def test_equals_brute_force_on_documents(spark, mode):
    arts = B.document_articles(spark, SF_SMALL).select("link", "title", "summary")
    rows = arts.collect()
    hits = ent.entity_hits(arts, BRUTE_DICT, mode=mode).collect()
    got = {}
    for h in hits:
        got.setdefault(h["link"], {}).setdefault(h["entity"], []).append((h["keyword_ord"], h["keyword"]))
    got = {k: {e: [kw for _, kw in sorted(v)] for e, v in d.items()} for k, d in got.items()}
    want = {r["link"]: brute(r["title"] or "", r["summary"] or "", BRUTE_DICT) for r in rows}
    want = {k: v for k, v in want.items() if v}
    assert got == want


def test_plan_has_no_shuffle_for_inline_match(spark):
    arts = B.document_articles(spark, SF_SMALL)
    m = ent.entity_match(arts.select("link", "title", "summary"), BRUTE_DICT)
    plan = m._jdf.queryExecution().executedPlan().toString()
    # only the round-robin spread of a single-split scan may shuffle; no hash exchange
    assert "hashpartitioning" not in plan.lower()


def test_large_corpus_dictionary_equals_brute_force(spark):
    from tidewatch.sources.config import dictionary_from_corpus
    docs = B.read_table(spark, SF_SMALL, "documents")
    big = dictionary_from_corpus(docs)
    assert sum(len(e.keywords) for e in big) == 916
    arts = B.document_articles(spark, SF_SMALL).select("link", "title", "summary")
    rows = arts.collect()
    m = {r["link"]: dict(r["matched_entities"]) for r in ent.entity_match(arts, big).collect()}
    want = {r["link"]: brute(r["title"] or "", r["summary"] or "", big) for r in rows}
    assert m == want


def test_every_mode_gives_the_same_rows(spark):
    """Repeated and NULL links, repeated texts and an entity name used twice."""
    rows = [("u1", "modern art", ""), ("u1", "sculpture", "ink"), (None, "art", "Art!"), (None, "art", "Art!"),
            ("u2", None, "ärt ink"), ("u2", None, None), ("u3", "example.com", "modern art")]
    df = spark.createDataFrame(rows, "link string, title string, summary string")
    dictionary = entities_from_pairs([("a", ["art", "ink", "art"]), ("b", ["modern art", "example.com", ".com"]),
                                      ("c", ["ä"]), ("a", ["sculpture"])])
    def shown(mode):
        return sorted(str((r["link"], r["title"], r["summary"], sorted(r["matched_entities"].items())))
                      for r in ent.entity_match(df, dictionary, mode=mode).collect())
    assert shown("inline") == shown("join") and len(shown("join")) == len(rows)
    def hits(mode):
        return sorted(map(str, map(tuple, ent.entity_hits(df, dictionary, mode=mode).collect())))
    assert hits("inline") == hits("join")


def dictionary_of(spark, entities):
    rows = [(e.name, i, k, j) for i, e in enumerate(entities) for j, k in enumerate(e.keywords)]
    return ent.dictionary_frame(spark.createDataFrame(rows, "entity string, entity_ord int, keyword string, keyword_ord int"))


EDGES = entities_from_pairs([
    ("Edge", ["c++", ".net", "++", "c#", "-x-", ".", "a."]), ("Script", ["한국", "한국어", "한", "k-뷰티", "x한", "é", "caf é"]),
    ("Word", ["net", "of the", ""]), ("Script", ["국어"])])
EDGE_TEXTS = ["c++11 c++ c++x", "asp.net .net x.net.", "a++b ++ a++", "c#x c# xc#y", "k-x-y -x-", "한국어 교실", "K-뷰티 x한",
              "caf é É", "한" * 50 + "국어", "", "net of the", "a.b a. .a", "Kelvin K-뷰티", "\n한\n"]


def test_dictionary_rows_and_list_equal_brute_force(spark):
    """Substring keywords, keywords with a non-word edge and word keywords, in all three forms."""
    df = articles(spark, [(t, s) for t in EDGE_TEXTS for s in ("", "한국 c++ net")])
    def shown(entities, mode="auto"):
        return sorted(str((r["link"], sorted(r["matched_entities"].items())))
                      for r in ent.entity_match(df, entities, mode=mode).collect())
    want = sorted(str((r["link"], sorted(brute(r["title"], r["summary"], EDGES).items()))) for r in df.collect())
    assert shown(EDGES, "inline") == want
    assert shown(EDGES, "join") == want
    assert shown(dictionary_of(spark, EDGES)) == want
    def hits(entities, mode="auto"):
        return sorted(map(str, map(tuple, ent.entity_hits(df, entities, mode=mode).collect())))
    assert hits(EDGES, "inline") == hits(EDGES, "join") == hits(dictionary_of(spark, EDGES))


def test_one_cut_per_non_ascii_character(spark):
    """Cuts do not grow with the keywords' ASCII starts; half a surrogate pair is no character."""
    one = spark.createDataFrame([("x" * 500 + "caf\u00e9 de la \u00f1u \U0001f600abc\u00e9",)], "t string")
    cuts = one.select(ent._cuts("sub", F.col("t"), F.col("t"), 4, 6).alias("c")).first().c
    assert cuts == ["xcaf\u00e9 de la", " la \u00f1u \U0001f600abc", "u \U0001f600abc\u00e9", "abc\u00e9"]
    pairs = entities_from_pairs([("a", ["?abc\u00e9", "abc\u00e9", "\U0001f600abc\u00e9", "f\u00e9", "caf\u00e9 d", "la \u00f1u", "xxxxxxxxcaf\u00e9", "\u00e9f\u00e9"])])
    df = articles(spark, [("caf\u00e9 de la \u00d1u", "\U0001f600ABC\u00c9"), ("x" * 9 + "caf\u00e9", "\u00e9f\u00e9"), ("?abc\u00e9", None),
                          ("\u00e9", ""), ("plain", "")])
    want = [brute(r["title"] or "", r["summary"] or "", pairs) for r in df.orderBy("link").collect()]
    for entities, mode in ((pairs, "join"), (dictionary_of(spark, pairs), "auto")):
        assert [dict(r["matched_entities"]) for r in ent.entity_match(df, entities, mode=mode).orderBy("link").collect()] == want


def test_hundred_thousand_script_keywords(spark):
    """A plan of the same size for any dictionary, and the same result as plain substring tests."""
    import random
    rng = random.Random(2)
    syllables = [chr(0xAC00 + 7 * i) for i in range(400)]
    make = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    keywords = sorted({make(rng.randint(2, 4)) for _ in range(130_000)})[:100_000]
    texts = [" ".join(make(rng.randint(1, 9)) for _ in range(40)) for _ in range(25)] + ["no syllable", ""]
    df = articles(spark, [(t, "") for t in texts])
    frame = lambda ks: ent.dictionary_frame(spark.createDataFrame(
        [("all", 0, k, i) for i, k in enumerate(ks)], "entity string, entity_ord int, keyword string, keyword_ord int"))
    matched = ent.entity_match(df, frame(keywords))
    assert len(keywords) == 100_000
    lengths = {n: {k for k in keywords if len(k) == n} for n in (2, 3, 4)}
    want = [{t[i:i + n] for n, ks in lengths.items() for i in range(len(t)) if t[i:i + n] in ks} for t in texts]
    got = [set(dict(r["matched_entities"]).get("all", [])) for r in matched.orderBy(F.length("link"), "link").collect()]
    assert got == want and sum(map(len, want)) > 500
    nodes = lambda m: m._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert nodes(matched) == nodes(ent.entity_match(df, frame(keywords[:200])))
