import hashlib
import random
import re

import pyarrow.parquet as pq
from hypothesis import given, settings, strategies as st

from tidemark.llm import op3_pii as pii
from tests.llm.conftest import ODD

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [(a, kind, b) for a, _, kind, b in sorted(out)]


@settings(max_examples=600, deadline=None)
@given(st.text("a.@-+ 0123456789%()é\n", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_patterns_by_hand():
    for t in ["a@b.c-d@e.f", "a@b@c.d", "x..y@z.q.", "1.2.3.4.5.6.7.8", "0255.1.1.00001", "256.1.1.1", "4111 1111-1111 1111",
              "4111111111111111 1", "+1 (988) 555-2485", "+12345678", "++1 23456789", "1" * 30, "@" * 50, "a" * 50 + "@"]:
        assert pii.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ["1" * 300_000, "1." * 150_000, "a" * 300_000, "a@" * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "+" * 300_000]:
        pii.base_spans(t)


def columns(spans):
    told = lambda ss: ",".join(f"{k}:{a}:{b}" for a, k, b in ss)
    base = [s for s in spans if s[1] != "term"]
    return (*(sum(k == x for _, k, _ in base) for x in PATTERNS), hashlib.sha256(told(base).encode()).hexdigest())


def test_given_table(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    want = {i: columns(brute(t)) for i, t in zip(*pq.read_table(path).select(["doc_id", "text"]).to_pydict().values())}
    rows = pii.digest_columns(pii.find(spark.read.parquet(path))).collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in rows} == want and len(rows) == len(want)


def test_disclosing_terms(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    texts = []
    for k in range(60):
        text = " ".join(word() for _ in range(30)) + " common"
        if k % 10 == 0:  # the name stands beside the address alone, "common" everywhere
            text += f" Zorbulax {k} " + word() + " common zor@example.com " + word()
        texts.append(text)
    texts += ["copied unusual passage one@example.com of words"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(docs).collect()
    terms = {}
    for r in found:
        for s in r["spans"]:
            if s["kind"] == "term":
                terms.setdefault(texts[r["doc_id"]][s["start"]:s["end"]], set()).add(r["doc_id"])
    assert terms == {"Zorbulax": {0, 10, 20, 30, 40, 50}}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "Zorbulax" not in clean[10] and "[NAME]" in clean[10] and "[EMAIL]" in clean[10] and "common" in clean[10]
    assert clean[1] == texts[1] and len(clean) == len(texts)


def test_replace_merges_overlaps():
    spans = [dict(start=0, kind="phone", end=6), dict(start=2, kind="card", end=9), dict(start=10, kind="term", end=12)]
    assert pii.replace("0123456789ab", spans) == "[PHONE]9"


def test_odd_rows(spark, odd, none):
    rows = pii.digest_columns(pii.find(odd)).collect()
    want = sorted(((i or -1, *columns(brute(t or ""))) for i, t in ODD))
    assert sorted((r["doc_id"] or -1, *tuple(r)[1:6]) for r in rows) == want
    assert pii.digest_columns(pii.find(none)).collect() == []


def brute_terms(rows):
    """Disclosing terms from the definition, by sets."""
    import math
    spans = [pii.base_spans(t) for t in rows]
    near = [set(pii.contexts(t, s)) for t, s in zip(rows, spans)]
    docs_of, contexts_of, of_entity, of_term = {}, {}, {}, {}
    for k, (t, found) in enumerate(zip(rows, near)):
        for w in set(pii._WORD.findall(t.lower())):
            of_term.setdefault(w, set()).add(k)
        for entity, term, _, _, context in found:
            docs_of.setdefault((entity, term), set()).add(k)
            contexts_of.setdefault((entity, term), set()).add(context)
            of_entity.setdefault(entity, set()).add(k)
    n, telling = len(rows), set()
    for (e, w), held in docs_of.items():
        ic = math.log(n / len(of_entity[e]))
        pmi = math.log(n * len(held) / (len(of_term[w]) * len(of_entity[e])))
        if len(contexts_of[e, w]) >= pii.SUPPORT and ic > 0 and pmi >= pii.DISCLOSED * ic:
            telling.add((e, w))
    return [sorted({(x, y) for e, w, x, y, _ in found if (e, w) in telling}) for found in near]


def terms_of(found):
    return sorted([sorted((s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term") for r in found], key=str)


def test_terms_equal_brute_force(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    texts = [t or "" for t in pq.read_table(path)["text"].to_pylist()]
    assert terms_of(pii.find(spark.read.parquet(path)).collect()) == sorted(brute_terms(texts), key=str)


def test_contexts_of_one_document_are_one_document(spark):
    # five contexts in one text: PMI / IC is that of one document, not of five
    many = " . ".join(f"alpha{k} beta{k} gamma zed a@example.com delta{k} " + " ".join(f"f{k}x{j}" for j in range(40)) for k in range(5))
    texts = [many] + [f"zed nothing {k}" for k in range(4)] + [f"plain text {k}" for k in range(95)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert terms_of(pii.find(docs).collect()) == sorted(brute_terms(texts), key=str)
    first = next(r for r in pii.find(docs).collect() if r["doc_id"] == 0)
    assert "zed" not in {many[s["start"]:s["end"]] for s in first["spans"] if s["kind"] == "term"}


def test_sanitise_by_row_and_keeps_columns(spark):
    text = "write to someone@example.com today"
    rows = [(1, text, "a", 1), (1, text, "a", 1), (1, "complete other text", "b", 2), (None, text, "c", 3), (2, None, "d", 4), (3, "", "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, `a.b c` int")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    clean = text.replace("someone@example.com", "[EMAIL]")
    due = [(i, clean if t == text else t, r, n) for i, t, r, n in rows]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(due, key=str)
    assert pii.sanitise(docs.limit(0)).collect() == []
