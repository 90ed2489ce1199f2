"""Title normalisation, URL checks, pair similarity, validation and near-duplicate pairs."""

from difflib import SequenceMatcher
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as TX
from tidewatch.operators import similarity as SIM
from tidewatch.operators import validate as V
from tidewatch.sources import bindings as B
from conftest import SF_MID


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("\u2003Low TIDE\n", "low tide"), ("Reef [map]!", "reef map"), (None, ""), ("", ""),
                                      ("sea-wall", "sea-wall"), ("a\t\u00a0b  c?", "a b c"), ("№5 — Ünder_line", "5 ünder_line")])
def test_normalize_title(spark, raw, want):
    assert one(spark, TX.normalize_title, raw) == want


@pytest.mark.parametrize("url,want", [("ftp://files.example", True), ("https://h.example/p?q#f", True), (None, False),
                                      ("h.example/p", False), ("https:///p", False), ("", False), ("mailto:a@b", False),
                                      ("\n https://h.example", True), ("http://[abc/x", False), ("http://[::1]/x", True),
                                      ("http://a]b/x", False)])
def test_valid_url(spark, url, want):
    assert one(spark, TX.valid_url, url) is want


@pytest.mark.parametrize("url", ["https://Example.com/a/b;p?q=1#f", "//host/x", "mailto:me@x", "a b:c", "/rel/path"])
def test_url_parts_match_urlparse(spark, url):
    p = urlparse(url)
    assert one(spark, TX.url_netloc, url) == p.netloc
    assert one(spark, TX.url_path, url) == p.path


def pair(spark, rows):
    return spark.createDataFrame(rows, "id int, t1 string, u1 string, t2 string, u2 string")


def test_similar_url_cases(spark):
    page = "https://sea.example/reef/2024"
    rows = [(1, "", page, "", page), (2, "", page, "", page + "#map"), (3, "", page, "", "https://land.example/reef/2024"),
            (4, "", page, "", "https://sea.example/dunes"), (5, "", "reef", "", "dunes")]
    got = {r["id"]: r["similar_url"] for r in SIM.similar_url_pairs(pair(spark, rows), "u1", "u2").collect()}
    # 5: neither has a host and the paths share too few letters
    assert got == {1: True, 2: True, 3: False, 4: False, 5: SequenceMatcher(None, "reef", "dunes").ratio() >= 0.8}
    near = pair(spark, [(6, "", page, "", "https://sea.example/reef/2025")])
    assert SIM.similar_url_pairs(near, "u1", "u2", 0.9).first()["similar_url"] is True


def test_duplicate_flag_cases(spark):
    u, v = "https://sea.example/reef", "https://land.example/reef"
    rows = [(1, "Low tide today", u, "LOW  tide today!", u + "?s=1"), (2, "Low tide today", u, "Harbour closed", u),
            (3, "Low tide today", u, "Low tide today", v), (4, "Low tide today", u, "Low tides today", u)]
    got = {r["id"]: r["is_duplicate"] for r in SIM.duplicate_flag(pair(spark, rows), "t1", "u1", "t2", "u2").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_validation_messages(spark):
    rows = [("T", "https://e.com/a", "S", "src", "cat"),
            (None, "https://e.com/a", "S", "src", "cat"),
            ("  ", "bad", " ", None, "")]
    df = spark.createDataFrame(rows, "title string, link string, summary string, source string, category string")
    got = [r["errors"] for r in V.validate_articles(df).collect()]
    assert got[0] == []
    assert got[1] == ["title is missing or not a string"]
    assert got[2] == ["title is empty", "link has invalid URL format: bad", "summary is empty",
                      "source is missing or not a string", "category is missing or not a string"]
    _, bad = V.split_valid_invalid(V.validate_articles(df))
    assert sorted(r["error"] for r in bad.collect())[0].startswith("bad: title is empty")


PAIR_TITLES = ["Low tide at noon", "Low tide at noon!", "Low tide at night", "High water at noon", "Harbour closed",
               "Harbour closed.", "Harbor closed", "Lamps"]
PAIR_PATHS = ["/a/1", "/a/2", "/b/long-path", "/b/long-path?x=1"]


def test_duplicate_pairs_equal_all_pairs(spark):
    """Pairs of representatives == the definition applied to all pairs: titles at least 0.85
    alike after normalising, same host, paths equal or at least 0.8 alike."""
    rows = [(f"https://{host}.example{path}#{i}", title) for host in ("sea", "land")
            for i, title in enumerate(PAIR_TITLES) for path in PAIR_PATHS]
    arts = spark.createDataFrame(rows, "link string, title string")
    shown = {r["link"]: r for r in arts.select("link", TX.normalize_title(F.col("title")).alias("t"),
                                               TX.url_netloc(F.col("link")).alias("h"), TX.url_path(F.col("link")).alias("p")).collect()}
    reps = sorted({r["representative"] for r in SIM.duplicate_groups(arts).collect()})

    def alike(a, b, least):
        return SequenceMatcher(None, a, b).ratio() >= least

    def same(x, y):
        return x["h"] == y["h"] and alike(x["t"], y["t"], 0.85) and (x["p"] == y["p"] or alike(x["p"], y["p"], 0.8))

    got = {frozenset((r["link_a"], r["link_b"])) for r in SIM.duplicate_pairs(arts).collect()}
    loose = {frozenset((a, b)) for a in reps for b in reps if a < b and same(shown[a], shown[b])}
    swapped = {frozenset((a, b)) for a in reps for b in reps if a < b and same(shown[b], shown[a])}
    assert loose & swapped <= got <= loose | swapped and len(got) >= 6


def test_duplicate_pairs_on_real_pages(spark):
    arts = B.page_articles(spark, SF_MID).select("link", "title")
    links = {r["link"] for r in arts.collect()}
    assert all(r["link_a"] in links and r["link_b"] in links for r in SIM.duplicate_pairs(arts).collect())


def by_definition(spark, arts):
    """All pairs of representatives tested one by one, in the fixed argument order."""
    rows = arts.select("link", TX.normalize_title(F.col("title")).alias("t"), TX.url_netloc(F.col("link")).alias("h"),
                       TX.url_path(F.col("link")).alias("p")).collect()
    groups = {}
    for r in rows:
        groups[(r["h"], r["p"], r["t"])] = min(r["link"], groups.get((r["h"], r["p"], r["t"]), r["link"]))
    reps = sorted((t, p, k, h) for (h, p, t), k in groups.items())
    want = set()
    for i, (t, p, k, h) in enumerate(reps):
        for t2, p2, k2, h2 in reps[i + 1:]:
            if h != h2 or 2 * min(len(t), len(t2)) < 0.85 * (len(t) + len(t2)):
                continue
            m = SequenceMatcher(None, t, t2)
            if m.real_quick_ratio() < 0.85 or m.quick_ratio() < 0.85 or m.ratio() < 0.85:
                continue
            if p == p2 or SequenceMatcher(None, p, p2).ratio() >= 0.8:
                want.add((k, k2, round(m.ratio(), 6)))
    return want, len(reps)


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        if rng.random() < 0.5 and at < len(text):
            del text[at]
        else:
            text.insert(at, rng.choice("abcdefgé 1"))
    return "".join(text)


def test_duplicate_pairs_in_a_hot_host_equal_the_definition(spark):
    """Titles around the threshold, edited one character at a time, all on one host."""
    import random
    rng = random.Random(7)
    rows = []
    for i in range(60):
        base = "".join(rng.choice("abcdefg hijklmno") for _ in range(rng.choice([3, 8, 20, 60, 90])))
        for j in range(7):
            rows.append((f"https://hot.example/{edited(rng, 'article/section', j % 3)}#{i}-{j}", edited(rng, base, (j * len(base)) // 30)))
    arts = spark.createDataFrame(rows + [("https://hot.example/x", ""), ("https://hot.example/x#2", None)],
                                 "link string, title string")
    want, n = by_definition(spark, arts)
    got = {tuple(r) for r in SIM.duplicate_pairs(arts).collect()}
    assert got == want and len(want) > 200
    reps = SIM.representatives(arts, "link", "title", "link")
    assert sorted(map(tuple, SIM.candidate_pairs(reps, block=40).collect())) == sorted(map(tuple, SIM.candidate_pairs(reps).collect()))


def test_duplicate_pairs_on_all_pages_of_one_host(spark):
    """Real titles on one host: results by definition, few unrelated pairs reach the exact ratio."""
    arts = B.page_articles(spark, SF_MID).select(
        F.concat(F.lit("https://one.example/a#"), "page_id").alias("link"), "title")
    want, n = by_definition(spark, arts)
    got = {tuple(r) for r in SIM.duplicate_pairs(arts).collect()}
    assert got == want
    candidates = SIM.candidate_pairs(SIM.representatives(arts, "link", "title", "link")).count()
    assert len(want) <= candidates <= len(want) + 0.02 * n * (n - 1) / 2


def test_tiles_hold_each_pair_once_and_rows_meet_in_no_join(spark, monkeypatch):
    """Bands of several and of grown blocks, adjacent bands, null links: the pairs of one tile per band."""
    import random
    rng = random.Random(3)
    rows = [(f"https://h{i % 2}.example/a#{i}", edited(rng, "abcdefghij klmnop" * (1 + i % 4), i % 5)) for i in range(300)] + [(None, "x")] * 3
    reps = SIM.representatives(spark.createDataFrame(rows, "link string, title string"), "link", "title", "link")
    whole = sorted(map(tuple, SIM.candidate_pairs(reps).collect()))
    assert len(set(whole)) == len(whole) > 300
    monkeypatch.setattr(SIM, "MAX_BLOCKS", 3)
    for block in (1, 7, 40):
        found = SIM.candidate_pairs(reps, block=block)
        assert sorted(map(tuple, found.collect())) == whole
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_a" in plan and not [line for line in plan.splitlines() if "Join" in line and "row" in line]
