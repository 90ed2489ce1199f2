import hashlib
import math
import random
import re
from collections import Counter

from tests.llm import cases
from tidewatch.llm import secret_scan as S
from tidewatch.llm.oracle import ORACLE


def brute(text):
    t = text or ""
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(S.BASE):
        flags = re.A | re.I if kind == "assign" else re.A
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, t, flags) if len(m.group(group)) >= least]
    for i, c in enumerate(S.CLASSES):
        last = 0
        for m in re.finditer(f"[{c.chars}]{{{c.window},}}", t):
            before, last = t[last:m.start()][-S.CONTEXT:], m.end()
            if any(re.search(p, m.group()) for p in S.ALLOWED) or any(re.search(p, before) for p in S.ALLOWED_BEFORE):
                continue
            opened = None
            for at in range(m.start(), m.end() - c.window + 1):
                w = t[at:at + c.window]
                mixed = re.search("[A-Z]", w) and re.search("[a-z]", w) if c.mixed_case else re.search("[A-Za-z]", w)
                total = sum(round(n * math.log2(n) * 1_000_000) for n in Counter(w).values())
                if not (mixed and re.search("[0-9]", w) and total <= c.limit):
                    continue
                if opened and at <= opened[1]:
                    opened[1] = at + c.window
                else:
                    if opened:
                        spans.append((opened[0], len(S.BASE) + i, opened[1], c.kind))
                    opened = [at, at + c.window]
            if opened:
                spans.append((opened[0], len(S.BASE) + i, opened[1], c.kind))
    return sorted(spans)


def line(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def want(doc_id, text):
    spans = brute(text)
    base = [s for s in spans if s[1] < 3]
    return (doc_id, *[sum(s[1] == r for s in spans) for r in range(3)],
            hashlib.sha256(line(base).encode()).hexdigest(), line(spans))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def texts():
    rng = random.Random(5)
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexa, b64 = "0123456789abcdef", S.ALPHABET
    return [
        'x password = "abcdefghijkl" y', "PassWord:short token=" + some(b64, 30), "token=secret=abcdefghijklmnop",
        "password:token: abcdefghijklmnop", "api_key: 'a.b-c_d/e=f+g123' apikey==abcdefghijklm", "AKIAABCDEFGHIJKLMN AKIA1 AKIAAKIAAKIAAKIAAK",
        some(hexa, 40), "é😀 " + some(hexa, 64) + " ü " + some(b64, 48), "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
        "123e4567-e89b-12d3-a456-426614174000 sha256:" + some(hexa, 64), "commit " + some(hexa.upper(), 40),
        some(hexa.upper(), 40) + " " + some(hexa.upper(), 40), "aaaaaaaaaaaaaaaa1111 internationalizationofwords",
        "/usr/lib/x86_64linux/" + some(b64, 30), "EXAMPLE" + some(b64, 30), some(b64, 400), "a" * 60 + some(b64, 60) + "b" * 90 + some(b64, 40),
        " ".join(some(hexa, rng.randint(14, 18)) for _ in range(700)), None, "", "token", "token=", "4111111111111111 " * 3]


def test_equal_to_brute_force(spark):
    cases_ = texts()
    got = {r.doc_id: tuple(r) for r in S.digest(S.scan_secrets(frame(spark, cases_))).collect()}
    assert got == {i: want(i, t) for i, t in enumerate(cases_)}
    assert "entropy_hex" in got[11][5] and "entropy_base64" in got[15][5]
    assert got[9][5].count("entropy") == 0 and got[10][5] == "" and got[14][5] == ""
    assert got[3][1:4] == (0, 0, 0) and got[2][1] == 1
    assert got[17][3] > 2 * S.TOTAL_BLOCK / 2


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(tuple(r) for r in S.digest(S.scan_secrets(docs)).collect())
    assert got == sorted(want(r.doc_id, r.text) for r in docs.collect())


def test_statement_on_awkward_texts(spark):
    import duckdb
    import pyarrow as pa
    rows = texts()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(rows))), "text": rows}))
    got = {r[0]: r for r in con.sql(ORACLE["op13_secret_scans"]).fetchall()}
    assert got == {i: want(i, t) for i, t in enumerate(rows)}


def test_awkward_rows_and_empty_table(spark):
    docs = cases.documents(spark)
    got = sorted(map(str, map(tuple, S.digest(S.scan_secrets(docs)).collect())))
    assert got == sorted(str(want(r.doc_id, r.text)) for r in docs.collect())
    assert S.scan_secrets(cases.empty_documents(spark)).collect() == []


def test_no_python_and_no_exchange_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = S.digest(S.scan_secrets(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_running_total_over_blocks(spark):
    n = 3 * S.TOTAL_BLOCK + 7
    from pyspark.sql import functions as F
    got = spark.range(1).select(S.running_total(F.sequence(F.lit(1), F.lit(n))).alias("x")).first().x
    assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]
