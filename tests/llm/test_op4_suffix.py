import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import op4_suffix as sx
from tests.llm.conftest import ODD


def brute(rows, span):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for k, t in enumerate(texts):
        for p in range(len(t) - span + 1):
            w = t[p:p + span]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for (i, _), t in zip(rows, texts):
        flags = np.zeros(len(t) + 1, dtype=np.int32)
        for p in range(len(t) - span + 1):
            if seen[t[p:p + span]] > 1:
                flags[p] += 1
                flags[p + span] -= 1
        gone = np.cumsum(flags)[:len(t)] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r[x] for x in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
                   for r in sx.remove_repeats(docs, **kw).collect()), key=str)


def passages(seed, span):
    rnd = random.Random(seed)
    make = lambda n: "".join(rnd.choice("ab é") for _ in range(n))
    shared = [make(rnd.randrange(span // 2, 3 * span)) for _ in range(6)]
    rows = []
    for k in range(40):
        text = ""
        for _ in range(rnd.randrange(0, 5)):
            s = rnd.choice(shared)
            a = rnd.randrange(0, len(s) // 3 + 1)
            text += make(rnd.randrange(0, span)) + s[a:len(s) - rnd.randrange(0, len(s) // 3 + 1)]
        rows.append((k, text + make(rnd.randrange(0, 40))))
    return rows + [(100, "z" * 5 * span), (101, "xy" * 3 * span), (102, make(span)), (103, rows[3][1]), (3, rows[3][1]), (3, "other")]


@pytest.mark.parametrize("seed,group_bytes", [(1, sx.GROUP_BYTES), (2, 0), (3, 600)])
def test_against_brute_force(spark, seed, group_bytes):
    rows = passages(seed, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, span=40, gram=8, group_bytes=group_bytes) == brute(rows, 40)


def test_given_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = list(zip(*pq.read_table(path).select(["doc_id", "text"]).to_pydict().values()))
    assert run(spark.read.parquet(path)) == brute(rows, sx.SPAN)


def test_odd_rows(spark, odd, none):
    assert run(odd) == brute(ODD, sx.SPAN)
    assert run(none) == []


def test_remaining_bytes(spark):
    docs = spark.createDataFrame([(1, "A" + "q" * 10 + "B"), (2, "C" + "q" * 10), (3, "D")], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in sx.remove_repeats(docs, span=10, gram=4, with_bytes=True).collect()}
    assert bytes(got[1]) == b"AB" and bytes(got[2]) == b"C" and got[3] is None


def test_bytes_decide_and_not_words(spark):
    """57 words that two documents share stay at 399 bytes and go at 400."""
    rnd = random.Random(4)
    passage = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(57)).ljust(n, ".")
    short, long = passage(399), passage(400)
    rows = [(1, f"A{short}B"), (2, f"C{short}D"), (3, f"E{long}F"), (4, f"G{long}H")]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows, sx.SPAN)
    assert [r[2] for r in got] == [0, 0, 400, 400]


def test_suffix_order_and_extensions():
    rng = np.random.default_rng(1)
    for _ in range(40):
        contexts = [bytes(rng.integers(97, 99, rng.integers(12, 30)).astype(np.uint8)) for _ in range(25)]
        anchor = np.array([rng.integers(0, len(x) - 9) for x in contexts])
        key = np.sort(rng.integers(0, 3, len(contexts)))
        size = np.array([len(x) for x in contexts])
        data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
        at = np.cumsum(size) - size + anchor
        for back in (False, True):
            e = sx.Extensions(data, sx.PrefixHash(data), at, anchor if back else size - anchor, back, 400)
            strings = [x[:a][::-1] if back else x[a:] for x, a in zip(contexts, anchor)]
            order = e.sort(key)
            assert [(key[k], strings[k]) for k in order] == sorted(zip(key, strings))
            common = e.neighbours(order, key)
            for i, j, n in zip(order, order[1:], common[1:]):
                if key[i] == key[j]:
                    want = next((m for m, (x, y) in enumerate(zip(strings[i], strings[j])) if x != y),
                                min(len(strings[i]), len(strings[j])))
                    assert n == want


def test_long_text_in_pieces(monkeypatch, spark):
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefgh") for _ in range(3000))
    rows = [(1, part + "".join(rnd.choice("xyz") for _ in range(5000)) + part), (2, "short")]
    texts = [t.encode() for _, t in rows]
    monkeypatch.setattr(sx, "UNIT", 1000)
    pieces = [x for unit, places in sx._units(texts, 40) for x in zip(unit, places)]
    starts = sorted((k, at + p) for data, (k, at) in pieces for p in range(len(data) - 39))
    assert starts == [(k, p) for k, t in enumerate(texts) for p in range(len(t) - 39)]
