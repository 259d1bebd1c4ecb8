import random

import pyarrow.parquet as pq
from hypothesis import given, settings, strategies as st

from tidemark.llm import op7_decontaminate as dc
from tests.llm.conftest import ODD


def greedy(item, doc, least):
    """Greedy string tiling as first defined: over and over the longest match."""
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        a[i:i + n] = b[j:j + n] = [True] * n
        tiles.append((i, j, n))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=50), st.integers(2, 4))
def test_tiles_are_valid_and_as_good_as_greedy(item, doc, least):
    tiles = dc.tile(item, doc, least)
    a, b = [0] * len(item), [0] * len(doc)
    for i, j, n in tiles:
        assert n >= least and item[i:i + n] == doc[j:j + n]
        for k in range(n):
            a[i + k] += 1
            b[j + k] += 1
    assert max(a, default=0) <= 1 and max(b, default=0) <= 1
    want = greedy(item, doc, least)
    # ties may fall differently, the longest tile may not
    assert [t[2] for t in tiles][:1] == [t[2] for t in want][:1]
    # nothing long enough is left unmarked on both sides
    for i in range(len(item) - least + 1):
        for j in range(len(doc) - least + 1):
            assert item[i:i + least] != doc[j:j + least] or any(a[i:i + least]) or any(b[j:j + least])


def make(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    items = [[word() for _ in range(40)] for _ in range(8)] + [["too", "short"], []]
    docs = []
    for k, it in enumerate(items[:8]):
        filler = [word() for _ in range(200)]
        half = it[20:] + ["and"] + it[:20]
        docs += [(f"{k}-whole", filler[:90] + it + filler[90:], [k]), (f"{k}-turned", filler[:5] + half + filler[5:], [k]),
                 (f"{k}-part", filler + it[:12], []), (f"{k}-upper", [w.upper() + "," for w in it], [k])]
    docs += [("clean", [word() for _ in range(5000)], []), ("two", items[0] + ["x"] * 50 + items[1], [0, 1]),
             ("again", (items[2] + ["y"]) * 300, [2]), ("short", ["too", "short"], [8]), ("apart", ["too", "very", "short"], [])]
    return items, docs


def test_planted_passages(spark):
    items, docs = make()
    bench = spark.createDataFrame([(k, " ".join(it), 1) for k, it in enumerate(items)] + [(90, None, 1)],
                                  "item_id long, text string, doc_id int")
    frame = spark.createDataFrame([(k, " ".join(ws)) for k, (_, ws, _) in enumerate(docs)], "doc_id long, text string")
    want = sorted((k, i) for k, (_, _, found) in enumerate(docs) for i in found)
    for least in (dc.SPREAD_FROM, 1):  # 1: every key on two rows or more is spread
        rows = dc.contained(frame, bench, spread_from=least).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == want
        assert all(r["covered"] >= 0.9 * r["item_words"] for r in rows)
    short = len(docs) - 2
    assert [r["item_id"] for r in dc.contained(frame, bench, shortest=3).where(f"doc_id = {short}").collect()] == []


def brute(docs, items, coverage=dc.COVERAGE, least=dc.MATCH):
    """(document place, item place) by tiling every document with every item."""
    out = []
    for k, text in enumerate(docs):
        for i, item in enumerate(items):
            ws, ids = dc.words_of(item or ""), {}
            if ws:
                a, b = ([ids.setdefault(w, len(ids)) for w in x] for x in (ws, dc.words_of(text or "")))
                if sum(n for _, _, n in dc.tile(a, b, min(least, len(a)))) >= coverage * len(ws):
                    out.append((k, i))
    return out


def test_few_words_many_common_seeds(spark):
    """Items made of few words share most of their seeds, with each other and with
    all documents; equal texts, equal items and items of few words among them."""
    rnd = random.Random(5)
    words = ["ab", "cd", "Ef", "gh"]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    opening = "which of the following is "
    items = [say(rnd.randrange(1, 30)) for _ in range(15)] + [opening + say(20) for _ in range(8)] + ["", None, "solo"]
    items.append(items[3])
    docs = [say(rnd.randrange(0, 40)) for _ in range(30)] + [opening + say(30) for _ in range(10)] + [None, "", "Solo, too"]
    docs += [docs[2]] * 4 + [" ".join(x for x in items if x)]
    want = brute(docs, items)
    assert 50 < len(want) < len(docs) * len(items)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for least in (dc.SPREAD_FROM, 1):
        assert sorted((r["doc_id"], r["item_id"]) for r in dc.contained(frame, bench, spread_from=least).collect()) == want
    dirty = {k for k, _ in want}
    assert sorted(r["doc_id"] for r in dc.clean(frame, bench).collect()) == [k for k in range(len(docs)) if k not in dirty]


def test_scripts_without_spaces(spark):
    han = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed\u6563\u6b65\u5427\u597d\u5417"
    thai = "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e04\u0e23\u0e31\u0e1a\u0e1c\u0e21\u0e0a\u0e37\u0e48\u0e2d"
    items = [han, thai, "one two three four"]
    docs = [f"prefix {han}\uff0csuffix", han[8:] + "\u3002" + han[:8], f"a{thai}b", "so ONE two, three four five", "one two three", han[:6]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = sorted((r["doc_id"], r["item_id"]) for r in dc.contained(frame, bench).collect())
    assert rows == brute(docs, items) == [(0, 0), (1, 0), (2, 1), (3, 2)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_words_in_arrays_are_the_words(texts):
    words = dc.Words(texts)
    got = [[] for _ in texts]
    for a, n, k in zip(words.start, words.length, words.of):
        got[k].append(words.text[a:a + n])
    assert got == [dc.words_of(t) for t in texts]
    flat = [w for ws in got for w in ws]
    assert len(set(zip(flat, words.hash.tolist()))) == len(set(flat)) == len(set(words.hash.tolist()))


def test_given_table(spark):
    d = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{d}/documents.parquet").to_pydict()
    bench = pq.read_table(f"{d}/benchmark.parquet").to_pydict()
    want = set()
    for i, t in zip(bench["item_id"], bench["text"]):
        for k, text in zip(docs["doc_id"], docs["text"]):
            if " ".join(dc.words_of(t)) in " ".join(dc.words_of(text)):
                want.add((k, i))
    rows = dc.contained(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in rows} and len(want) > 0


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "plain words here and there too"), (None, "word word word word word word")],
                                  "item_id long, text string")
    rows = dc.contained(odd, bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(6, None)]
    left = dc.clean(odd, bench)
    assert left.columns == odd.columns and left.count() == len(ODD) - 1
    assert dc.contained(odd.union(odd), bench).count() == 2 and dc.clean(none, bench).count() == 0
    assert dc.contained(none, bench).collect() == []
    assert dc.contained(odd, bench.limit(0)).collect() == [] and len(ODD) == 9
