import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op13_katz as katz
from tidemark.llm.registry import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


class Brute:
    """Katz backoff by dictionaries."""

    def __init__(self, texts, order):
        self.order, self.count = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<"] * (order - 1) + words(t)
            for k in range(1, order + 1):
                self.count[k].update(tuple(w[i - k + 1:i + 1]) for i in range(order - 1, len(w)))
        self.n, self.known, self.below = sum(self.count[1].values()), {}, {}
        self.d = [None, *(self.discount(Counter(x.values())) for x in self.count[1:])]
        self.after = [defaultdict(list) for _ in range(order + 1)]
        for k in range(1, order + 1):
            for g in self.count[k]:
                self.after[k][g[:-1]].append(g[-1])

    @staticmethod
    def discount(n):
        for k in range(katz.K, 0, -1):
            if all(n[r] for r in range(1, k + 2)):
                a = (k + 1) * n[k + 1] / n[1]
                d = {r: ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) if a < 1 else 0 for r in range(1, k + 1)}
                if all(0 < x < 1 for x in d.values()):
                    return d
        return {}

    def seen(self, h):
        """Sum of discounted counts after h, and the divisor."""
        if h not in self.known:
            self.known[h] = self._seen(h)
        return self.known[h]

    def lower(self, h):
        if h not in self.below:
            self.below[h] = sum(self.p(h[1:], x) for x in self.after[len(h) + 1][h])
        return self.below[h]

    def _seen(self, h):
        k = len(h) + 1
        c = [self.count[k][(*h, w)] for w in self.after[k][h]]
        kept = sum(self.d[k].get(x, 1) * x for x in c)
        return kept, sum(c) + (kept == sum(c) or abs(kept - sum(c)) < 1e-9)

    def p(self, h, w):
        k = len(h) + 1
        if k == 1 and not self.n:
            return 1.0
        kept, scale = self.seen(h)
        if c := self.count[k][(*h, w)]:
            return self.d[k].get(c, 1) * c / scale
        if k == 1:
            return (scale - kept) / scale
        if not self.after[k][h]:
            return self.p(h[1:], w)
        return (scale - kept) / scale / (1 - self.lower(h)) * self.p(h[1:], w)

    def score(self, text):
        w = ["<"] * (self.order - 1) + words(text)
        return sum(math.log10(self.p(tuple(w[i - self.order + 1:i]), w[i])) for i in range(self.order - 1, len(w)))


def brute(rows, order):
    lm = Brute([t for i, t in rows if not held(i)], order)
    v, out = len(lm.count[1]), []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((lm.count[1][(x,)] + 1) / (lm.n + v + 1)) for x in w)
        out.append((i, held(i), len(w), sum((x,) in lm.count[1] for x in w), lm.n, base, lm.score(t)))
    return sorted(out, key=str), lm


def close(found, due):
    assert [x[:5] for x in found] == [x[:5] for x in due]
    for a, b in zip(found, due):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def is_held():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "b", 3) for i, t in rows], "doc_id long, text string, batch string, `a.b c` int")
    return sorted(map(tuple, katz.score(df, is_held(), **kw)[0].collect()), key=str)


def texts(seed, n=60, vocabulary=40):
    rnd = random.Random(seed)
    pick = lambda: f"W{min(int(rnd.paretovariate(0.7)), vocabulary)}"
    return [(k, " ".join(pick() for _ in range(rnd.randrange(0, 60)))) for k in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(katz, "RANGE_TOKENS", 300)  # several ranges
    monkeypatch.setattr(katz, "BATCH_BYTES", 1000)
    rows = texts(order)
    close(run(spark, rows, order=order), brute(rows, order)[0])


def test_odd_rows(spark):
    rows = [(1, "plain words here"), (2, None), (3, ""), (4, " \t\n "), (None, "no id"), (1, "plain words here"), (5, "x" * 60_000),
            (6, "word " * 20_000), (7, "Ünïcode ſ 漢字 🎉 \x1c\x85 é"), (1 << 60, "large id"), (8, "ſame ÀÉ Àé")]
    close(run(spark, rows), brute(rows, 2)[0])


def test_nothing_to_learn_from_and_empty(spark):
    rows = [(i, "some words") for i in range(200) if held(i)][:3]
    found = run(spark, rows)
    close(found, brute(rows, 2)[0])
    assert [x[4:] for x in found] == [(0, 0.0, 0.0)] * 3
    assert run(spark, []) == []


def test_every_distribution_sums_to_one():
    lm = brute(texts(9), 2)[1]
    for h in [*lm.after[2], ("never",)]:
        assert sum(lm.p(h, w) for w in [*(g[0] for g in lm.count[1]), "unknown"]) == pytest.approx(1, abs=1e-12)


def test_stored_model_scores_other_texts(spark):
    rows = texts(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both, model = katz.score(df, is_held())
    due = {r["doc_id"]: r["score"] for r in both.collect() if r["held_out"]}
    got = {r["doc_id"]: r["score"] for r in katz.score_by(model, df.where(is_held())).collect()}
    assert got.keys() == due.keys() and all(got[k] == pytest.approx(due[k], rel=1e-9) for k in due)


def test_pieces_and_numbers():
    text = ("ab " * 900_000).encode() + b"x" * (2 << 20) + b" y"
    assert b"".join(katz._pieces(text)) == text
    tokens, n = katz.hashed([text, b"", b"AB"])
    assert n.tolist() == [900_003, 1, 2] and tokens[0] == tokens[-2] and len(tokens) == n.sum()
    x = np.array([0, 1, 254, 255, 256, 1 << 40], dtype=np.uint64)
    assert (katz.unpack(katz.pack(x), len(x)) == x).all()


def test_query_equals_brute_force(spark):
    import pyarrow.parquet as pq
    rows = list(zip(*pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    close(sorted(map(tuple, QUERIES["op13_katz_scores"](spark, SF).collect()), key=str), brute(rows, 2)[0])
