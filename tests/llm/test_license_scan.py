import math
import re

from tests.llm import cases
from tidewatch.llm import license_scan as L

FIND = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = FIND.findall(low)
    at, own = [], set()
    for label, phrase in L.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += hits
        own |= {label} if hits else set()
    best, labels = 0.0, set(own)
    have = set(w)
    for label, words, required, excluding in L.TEMPLATES:
        t, m = set(words.split()), len(words.split())
        need = math.ceil(L.MIN_CONTAINMENT * len(t) - 1e-9)
        if len(t & have) < need:
            continue
        for s in range(len(w)):
            held, near = set(w[s:s + m]), w[max(s - L.NEAR, 0):s + m + L.NEAR]
            if len(held & t) >= need and held >= set(required.split()) and not set(excluding.split()) & set(near):
                labels.add(label)
                best = max(best, len(held & t) / len(t))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(labels)),
            1.0 if at else best)


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation.")
WRAPPED_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a\ncopy of this software and associated "
               "documentation files, to deal in\nthe Software without restriction")

TEXTS = ["Licensed under CC BY-NC 4.0.", "x\nThis work is licensed under the GNU General Public License, version 3.\ny",
         "general public\nlicense general public license", "All Rights Reserved. all rights reserved; ALL-RIGHTS-RESERVED",
         "Released under MIT license", "released the license", "cc by cc by cc", "by cc", "cc", None, "", "\n\n",
         "a license mit released under of it " * 3000, "Licensed under the Apache License", "licensed apache",
         MIT.replace(". ", ".\n"), WRAPPED_MIT, "# " + "\n# ".join(WRAPPED_MIT.split("\n")), "x " * 50 + WRAPPED_MIT + " y" * 50,
         "This work is licensed under the GNU Lesser General Public License, version 3",
         "This work is licensed\nunder the GNU\nGeneral Public\nLicense, version 3.\n" + "z\n" * 40 + "lesser",
         "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
         "This work is licensed under a Creative Commons Attribution 4.0 International License.",
         "licensed under cc by 4 0", "released under the license", "public the lesser license general " * 40,
         "worK licensed under GNU general publiK license version 3", "ÉCC BY", "cc by", "cc_by"]


def test_equal_to_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, "w", "b") for i, t in enumerate(TEXTS + TEXTS[:3])],
                                 "doc_id long, text string, k1 int, word string, block string")
    got = {r.doc_id: tuple(r)[1:] for r in L.scan_licenses(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS + TEXTS[:3])}
    labels = {t: got[i][5] for i, t in enumerate(TEXTS)}
    assert labels[TEXTS[0]] == "cc-by,cc-by-nc" and got[4][5] == "mit"
    assert labels[MIT.replace(". ", ".\n")] == labels[WRAPPED_MIT] == "mit" and got[TEXTS.index(WRAPPED_MIT)][6] == 1.0
    assert labels["# " + "\n# ".join(WRAPPED_MIT.split("\n"))] == "mit"
    siblings = [labels[t] for t in TEXTS if t and ("Lesser" in t or "Attribution" in t or "lesser" in t)]
    assert siblings == ["gpl,lgpl", "gpl", "cc-by-sa", "cc-by", ""]  # "general public license" is a base phrase
    assert labels["released under the license"] == "" and labels["licensed under cc by 4 0"] == "cc-by"


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in L.scan_licenses(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_awkward_rows_and_empty_table(spark):
    docs = cases.documents(spark)
    got = sorted(map(str, (tuple(r) for r in L.scan_licenses(docs).collect())))
    assert got == sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect())
    assert L.scan_licenses(cases.empty_documents(spark)).collect() == []


def test_statement_on_wrapped_and_sibling_texts():
    import duckdb
    import pyarrow as pa
    from tidewatch.llm.oracle import ORACLE
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(TEXTS))), "text": TEXTS}))
    got = {r[0]: r[1:] for r in con.sql(ORACLE["op5_license_scans"]).fetchall()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
