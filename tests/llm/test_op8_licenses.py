import random
import re

import pyarrow.parquet as pq

from tidemark.llm import op8_licenses as lic
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["Licensed under the Apache License, Version 2.0.", "MIT  License, mit-license; GNU General Public License v3 or later",
         "SPDX-License-Identifier: GPL-2.0-or-later\nlicensed under the GNU General Public License, version 2",
         "Licensed under CC BY-NC 4.0. and again Licensed under CC BY-NC 4.0. CC-BY-SA 3.0",
         "PERMISSION IS HEREBY GRANTED, free of charge, to any person obtaining a copy", "unlicensed",
         "the mit license" * 300, "Kelvin K license İ license", "general public license mit license apache license"]


def brute(text):
    low = (text or "").translate(LOWER)
    words = re.findall(lic.WORD, low)
    places, base = [], set()
    for phrase, label in lic.PHRASES.items():
        for i in range(len(words) - len(phrase) + 1):
            if tuple(words[i:i + len(phrase)]) == phrase:
                places.append(i)
                base.add(label)
    table = lic.rules()
    found = [(m.start(), -m.end(), list(lic.KINDS).index(kind), k, label)
             for k, (label, kind, *_, pattern) in enumerate(table)
             for m in re.finditer(pattern, low, re.ASCII)]
    found.sort()
    kept = [d for n, d in enumerate(found) if not any(-e[1] >= -d[1] and e[2] <= d[2] for e in found[:n])]
    labels = sorted(base | {d[4] for d in kept})
    score = max([list(lic.KINDS.values())[d[2]] for d in kept], default=lic.BASE_SCORE if base else 0.0)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(labels), score)


def run(docs):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, *[r[x] for x in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])
        for r in lic.scan(docs).collect())


def test_rules():
    table = lic.rules()
    assert len(table) >= 300
    for label, kind, keyword, second, pattern in table:
        assert kind in lic.KINDS and keyword == keyword.lower() and re.compile(pattern)


def test_against_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert run(docs) == [(i, *brute(t)) for i, t in enumerate(TEXTS)]


def made_by(pattern, rnd):
    """A text that the pattern matches, its branches and repeats chosen at random."""
    def make(tree):
        return "".join(part(op, arg) for op, arg in tree)

    def part(op, arg):
        op = str(op)
        if op == "LITERAL":
            return chr(arg)
        if op == "ANY":
            return "x"
        if op == "IN":
            kind, value = rnd.choice(arg)
            return {"LITERAL": lambda: chr(value), "RANGE": lambda: chr(rnd.randint(*value)) if str(kind) == "RANGE" else "",
                    "CATEGORY": lambda: rnd.choice([" ", "\n", "  ", "\r\n\t"]) if "SPACE" in str(value) else "7"}[str(kind)]()
        if op == "MAX_REPEAT":
            lo, hi, tree = arg
            return "".join(make(tree) for _ in range(rnd.randint(lo, min(hi, lo + 1))))
        if op == "SUBPATTERN":
            return make(arg[3])
        if op == "BRANCH":
            return make(rnd.choice(arg[1]))
        assert op in ("AT", "ASSERT", "ASSERT_NOT"), op
        return ""
    return make(re._parser.parse(pattern, re.ASCII))


def test_every_match_holds_the_keywords():
    rnd = random.Random(4)
    for label, kind, keyword, second, pattern in lic.rules():
        for _ in range(40):
            flat = re.sub(r"\s+", " ", made_by(pattern, rnd), flags=re.ASCII)
            assert keyword in flat and second in flat, (label, kind, flat)


WRAPPED = ["under the GNU General\nPublic License, version 3", "GNU General  Public\tLicense", "GNU Lesser\r\n General Public License 2.1",
           "Permission is\nhereby granted, free of charge, to any person obtaining a copy", "Redistribution and\n * use",
           "Redistribution\n and  use in source and binary forms", "You should have\nreceived a copy of the GNU General Public License",
           "Creative\nCommons Attribution 4.0", "no\x0battribution MIT\fNo\n\nAttribution", "Licence Ouverte", "licence\nouverte",
           "Do What The F*ck You Want To Public License", "do what\nthe fork you want to public licence", "CreativeML Open RAIL-M",
           "open\nrail", "OpenRAIL++ license", "Unauthorised copying of this file", "all rights\nreserved", "open \u00a0rail"]


def test_wrapped_texts_and_branches(spark):
    docs = spark.createDataFrame(list(enumerate(WRAPPED)), "doc_id long, text string")
    got = run(docs)
    assert got == [(i, *brute(t)) for i, t in enumerate(WRAPPED)]
    assert [r[6] for r in got[9:17]] == ["etalab-2.0"] * 2 + ["wtfpl"] * 2 + ["openrail"] * 3 + ["proprietary"]


def test_given_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    want = sorted((i, *brute(t)) for i, t in zip(*pq.read_table(path).select(["doc_id", "text"]).to_pydict().values()))
    assert run(spark.read.parquet(path)) == want


def test_odd_rows(spark, odd, none):
    assert run(odd) == sorted((i if i is not None else -1, *brute(t)) for i, t in ODD)
    assert run(none) == []


def test_no_python_on_the_main_path(spark, odd):
    scanned, kept = lic.detections(odd)
    for df in (scanned, kept, lic.scan(odd)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
