"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

import math

from tidewatch.llm import license_scan, line_dedup, merkle, mixing, secret_scan, warc

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
post AS (SELECT r, any_value(n) AS n, t, count(*)::BIGINT AS tf FROM (SELECT r, len(w) AS n, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*)::BIGINT AS df FROM post GROUP BY t),
q AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
qt AS (SELECT i, item_id, t, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS t FROM q) GROUP BY i, item_id, t),
scored AS (
  SELECT i, item_id, r, sum(times * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
           * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // total))))::BIGINT AS score
  FROM qt JOIN df USING (t) JOIN post USING (t), s GROUP BY i, item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS ra, b.r AS rb FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(ra, rb) AS (
  SELECT ra, rb FROM links
  UNION
  SELECT reach.ra, links.rb FROM reach JOIN links ON reach.rb = links.ra),
low AS (SELECT ra, min(vec_id) AS m FROM reach JOIN v ON v.r = rb GROUP BY ra),
deg AS (SELECT ra, count(*) AS k FROM links GROUP BY ra)
SELECT v.vec_id, coalesce(deg.k, 0)::BIGINT AS n_links, coalesce(least(low.m, v.vec_id), v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(least(low.m, v.vec_id), v.vec_id), false) AS kept
FROM v LEFT JOIN deg ON v.r = deg.ra LEFT JOIN low ON v.r = low.ra
"""

MIX_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS s, coalesce(length(text), 0) + 1 AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS k FROM documents),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY s ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         ::BIGINT AS start FROM d),
t AS (SELECT s, sum(size) AS size FROM d GROUP BY s),
u AS (
  SELECT s, size, greatest(1, round({mixing.RESOLUTION} * pow(size, {mixing.TEMPERATURE})
         / (SELECT sum(pow(size, {mixing.TEMPERATURE})) FROM t)))::BIGINT AS units FROM t),
n AS (SELECT *, ceil(ceil(size / {mixing.BLOCK_CHARS}.0) / units)::BIGINT AS periods FROM u),
ends AS (SELECT DISTINCT periods AS e FROM n),
member AS (
  SELECT e, list(s ORDER BY s) AS names, list(units ORDER BY s) AS u, sum(units)::BIGINT AS total
  FROM ends JOIN n ON n.periods >= e GROUP BY e),
edf(e, u, total, t, done, pick) AS (
  SELECT e, u, total, -1::BIGINT, list_transform(u, lambda x: 0::BIGINT), 0::BIGINT FROM member
  UNION ALL
  SELECT e, u, total, t, list_transform(list_zip(done, range(1, len(u) + 1)), lambda z: z[1] + (z[2] = pick)::BIGINT), pick
  FROM (
    SELECT e, u, total, t + 1 AS t, done,
      list_sort(list_filter(list_transform(list_zip(done, u, range(1, len(u) + 1)),
        lambda z: CASE WHEN z[1] < z[2] AND (z[1] * total) // z[2] <= t + 1
             THEN [((z[1] + 1) * total + z[2] - 1) // z[2], z[3]] END), lambda c: c IS NOT NULL))[1][2] AS pick
    FROM edf WHERE t + 1 < total)),
slots AS (
  SELECT m.e, m.total, names[pick] AS s, t, row_number() OVER (PARTITION BY m.e, pick ORDER BY t) - 1 AS j
  FROM edf JOIN member m ON edf.e = m.e WHERE t >= 0),
phase AS (
  SELECT e, total, start, coalesce(sum((e - start) * total) OVER (ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS base
  FROM (SELECT e, total, coalesce(lag(e) OVER (ORDER BY e), 0) AS start FROM member)),
placed AS (
  SELECT p.*, start // {mixing.BLOCK_CHARS} AS b, (start // {mixing.BLOCK_CHARS}) // n.units AS period, n.units
  FROM p JOIN n USING (s))
SELECT doc_id, source, b AS mix_block, (base + (period - phase.start) * phase.total + slots.t)::BIGINT AS mix_slot,
       placed.start - b * {mixing.BLOCK_CHARS} AS mix_offset
FROM placed JOIN phase ON phase.e = (SELECT min(e) FROM ends WHERE e > placed.period)
JOIN slots ON slots.e = phase.e AND slots.s = placed.s AND slots.j = placed.b % placed.units
"""

LINE_SQL = f"""
WITH l AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
x AS (
  SELECT source, unnest(list_distinct(list_filter(list_transform(lines, lambda s: trim(s, {WHITE})), lambda s: s <> ''))) AS line FROM l),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (
  SELECT x.source, list(line) AS gone FROM (
    SELECT source, line, count(*) AS c FROM x GROUP BY source, line) x
  JOIN t ON x.source IS NOT DISTINCT FROM t.source
  WHERE c >= {line_dedup.MIN_PAGES} AND c > {line_dedup.MAX_RATIO}::DOUBLE * pages GROUP BY x.source),
k AS (
  SELECT doc_id, l.source, lines, text, CASE WHEN gone IS NULL THEN lines ELSE
    list_filter(lines, lambda s: trim(s, {WHITE}) = '' OR NOT list_contains(gone, trim(s, {WHITE}))) END AS kept
  FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
       coalesce(length(array_to_string(kept, chr(10))), 0)::BIGINT AS n_chars,
       coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped
FROM k
"""


def license_sql() -> str:
    def words(text: str) -> str:
        return f"list_filter(regexp_split_to_array({text}, '{license_scan.SEPARATORS}'), lambda x: x <> '')"

    def starts(phrase: str) -> str:
        parts = phrase.split()
        same = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        return f"list_filter(range(greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {same})"

    def texts(words: list[str]) -> str:
        return f"[{', '.join(repr(w) for w in words)}]::VARCHAR[]"

    templates = ", ".join(
        f"('{label}', {texts(sorted(set(t.split())))}, {len(t.split())}, {texts(required.split())}, {texts(excluding.split())})"
        for label, t, required, excluding in license_scan.TEMPLATES)
    phrases = license_scan.PHRASES
    p_cols = ", ".join(f"{starts(p)} AS p{i}" for i, (_, p) in enumerate(phrases))
    all_p = " || ".join(f"p{i}" for i in range(len(phrases)))
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (label, _) in enumerate(phrases))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT r, doc_id, t, {words('t')} AS w FROM d),
p AS (SELECT r, doc_id, w, {p_cols} FROM w),
q AS (SELECT r, doc_id, len(w) AS n_words, {all_p} AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS own FROM p),
tpl(label, words, size, required, excluding) AS (VALUES {templates}),
may AS (
  SELECT r, w, label, words, size, required, excluding, ceil({license_scan.MIN_CONTAINMENT} * len(words) - 1e-9) AS need
  FROM (SELECT r, w, list_distinct(w) AS dw FROM w) JOIN tpl
    ON len(list_intersect(dw, words)) >= ceil({license_scan.MIN_CONTAINMENT} * len(words) - 1e-9)),
win AS (
  SELECT r, label, words, need, required, excluding, list_distinct(w[s + 1:s + size]) AS held,
         w[greatest(s - {license_scan.NEAR}, 0) + 1:s + size + {license_scan.NEAR}] AS near
  FROM (SELECT *, unnest(range(0, len(w))) AS s FROM may)),
hit AS (
  SELECT r, label, len(list_intersect(held, words))::DOUBLE / len(words) AS share FROM win
  WHERE len(list_intersect(held, words)) >= need AND len(list_intersect(held, required)) = len(required)
    AND NOT list_has_any(near, excluding)),
best AS (SELECT r, list(DISTINCT label) AS found, max(share) AS share FROM hit GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
       list_max(places)::BIGINT AS last_word, array_to_string(list_sort(list_distinct(own)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(own || coalesce(found, []))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM q LEFT JOIN best USING (r)
"""


WARC_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p WHERE n >= {warc.MIN_REVISIT_BYTES} GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, p.h AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
"""



def secret_sql() -> str:
    """Places by running sums over pieces and matches; every window's entropy counted anew."""
    quoted = [(k, p.replace("'", "''"), g, n) for k, p, g, n in secret_scan.BASE]
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    quoted[0] = ("assign", "(" + either + ")" + quoted[0][1].partition(")")[2], *quoted[0][2:])
    searches = [(i, k, p, g, n) for i, (k, p, g, n) in enumerate(quoted)]
    searches += [(len(quoted) + i, c.kind, f"[{c.chars}]{{{c.window},}}", 0, c.window)
                 for i, c in enumerate(secret_scan.CLASSES)]
    found = " UNION ALL ".join(f"""
  SELECT r, {i} AS rank, '{k}' AS kind, {n} AS least, regexp_extract_all(t, '{p}', 0) AS m,
         regexp_extract_all(t, '{p}', {g}) AS g, regexp_split_to_array(t, '{p}') AS pieces FROM d""" for i, k, p, g, n in searches)
    stop = " OR ".join([f"regexp_matches(m, '{p}')" for p in secret_scan.ALLOWED]
                       + [f"regexp_matches(before, '{p.replace(chr(39), chr(39) * 2)}')" for p in secret_scan.ALLOWED_BEFORE])
    classes = ", ".join(f"({len(quoted) + i}, {c.window}, {c.limit}, {str(c.mixed_case).lower()})"
                        for i, c in enumerate(secret_scan.CLASSES))
    widest = max(c.window for c in secret_scan.CLASSES)
    terms = ", ".join(str(round(c * math.log2(c) * 1_000_000)) for c in range(1, widest + 1))
    n_kinds = ", ".join(f"count(*) FILTER (WHERE rank = {i})::BIGINT AS n_{k}" for i, (k, *_) in enumerate(quoted))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
u AS (SELECT r, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m AS ms, g AS gs, pieces FROM f WHERE len(m) > 0),
x AS (SELECT r, rank, kind, least, i, ms[i] AS m, gs[i] AS g, right(pieces[i], {secret_scan.CONTEXT}) AS before,
             sum(length(pieces[i]) + length(ms[i])) OVER (PARTITION BY r, rank ORDER BY i) AS e FROM u),
base AS (SELECT r, rank, kind, (e - length(m))::BIGINT AS s, e::BIGINT AS e FROM x WHERE rank < {len(quoted)} AND length(g) >= least),
cls(rank, w, most, mixed) AS (VALUES {classes}),
win AS (
  SELECT r, rank, kind, e - length(m) AS run, w, most, mixed, j AS pos, substr(m, j + 1, w) AS s
  FROM (SELECT x.*, w, most, mixed, unnest(range(0, length(m) - w + 1)) AS j
        FROM x JOIN cls USING (rank) WHERE NOT ({stop}))),
good AS (
  SELECT * FROM win
  WHERE regexp_matches(s, '[0-9]') AND CASE WHEN mixed THEN regexp_matches(s, '[A-Z]') AND regexp_matches(s, '[a-z]')
        ELSE regexp_matches(s, '[A-Za-z]') END
    AND list_sum(list_transform(map_values(list_histogram(string_split(s, ''))), lambda c: [{terms}][c::INT])) <= most),
isle AS (
  SELECT *, sum(fresh) OVER (PARTITION BY r, rank, run ORDER BY pos) AS k FROM (
    SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY r, rank, run ORDER BY pos) <= w THEN 0 ELSE 1 END AS fresh FROM good)),
ent AS (SELECT r, rank, kind, (run + min(pos))::BIGINT AS s, (run + max(pos) + max(w))::BIGINT AS e FROM isle GROUP BY r, rank, kind, run, k),
spans AS (SELECT *, kind || ':' || s || ':' || e AS line FROM (SELECT * FROM base UNION ALL SELECT * FROM ent)),
per AS (
  SELECT r, {n_kinds}, coalesce(string_agg(line, ',' ORDER BY s, rank) FILTER (WHERE rank < {len(quoted)}), '') AS b,
         string_agg(line, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in quoted)}, sha256(coalesce(b, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""


def merkle_sql(levels: int = 8, top_levels: int = 4) -> str:
    """Trees by level, for up to 8^levels rows a language and 8^top_levels languages."""
    def enc(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def climb(name: str, levels: int) -> str:
        """Levels over ``name``0(k, i, h, n); ``name``_side has the siblings by level."""
        steps = [f"""
{name}{j + 1} AS (SELECT k, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
  (any_value(n) + 7) // 8 AS n FROM {name}{j} GROUP BY k, i // 8)""" for j in range(levels)]
        sides = " UNION ALL ".join(f"""
  SELECT {j} AS level, a.k, a.i, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS pre,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS post
  FROM {name}{j} a JOIN {name}{j} b ON a.k = b.k AND a.i // 8 = b.i // 8 GROUP BY a.k, a.i""" for j in range(levels))
        return ",".join(steps) + f",\n{name}_side AS ({sides})"

    def fold(start: str, name: str, key: str, at: str, levels: int, into: str) -> str:
        out, previous = [], start
        for j in range(levels):
            out.append(f"""
{into}{j + 1} AS (SELECT x.*  REPLACE (CASE WHEN s.n = 1 THEN x.f ELSE sha256(s.pre || x.f || s.post) END AS f,
  x.proof || s.pre || s.post AS proof) FROM {previous} x JOIN {name}_side s ON s.level = {j} AND s.k = x.{key} AND s.i = x.{at} // {8 ** j})""")
            previous = f"{into}{j + 1}"
        return ",".join(out)

    fields = " || ".join(enc(c) for c in merkle.FIELDS[:-1])
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
              ORDER BY x) AS v FROM range(256) t(x)),
d AS (
  SELECT *, coalesce('=' || lang, '') AS k, sha256({fields} || {enc('text')}) AS h,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda c, b: xor(c // 256, v[(xor(c, b) & 255) + 1])), 4294967295) % {merkle.TAMPER_EVERY} = 0 AS tampered
  FROM documents, crc_table),
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY k) AS n,
    CASE WHEN tampered THEN sha256({fields} || {enc(f"translate(text, '{UPPER}', '{LOWER}')")}) ELSE h END AS claim FROM d),
a0 AS (SELECT k, i, h, n FROM leaf),{climb('a', levels)},
b0 AS (SELECT '' AS k, row_number() OVER (ORDER BY encode(k)) - 1 AS i, h, count(*) OVER () AS n, k AS tree FROM a{levels}),{climb('b', top_levels)},
f0 AS (
  SELECT doc_id, leaf.h AS leaf, leaf.k, leaf.i, '' AS top, b0.i AS t, b0.h AS subroot, (SELECT h FROM b{top_levels}) AS root,
    claim AS f, '' AS proof FROM leaf JOIN b0 ON b0.tree = leaf.k),{fold('f0', 'a', 'k', 'i', levels, 'f')},{
    fold(f'f{levels}', 'b', 'top', 't', top_levels, 'g')}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM g{top_levels}
"""


ORACLE = {
    "op1_embedding_near_dedup": EMBEDDING_SQL,
    "op2_mix_sources": MIX_SQL,
    "op4_line_dedup": LINE_SQL,
    "op5_license_scans": license_sql(),
    "op8_warc": WARC_SQL,
    "op11_ranked_search": SEARCH_SQL,
    "op12_merkle_manifest": merkle_sql(),
    "op13_secret_scans": secret_sql(),
}
