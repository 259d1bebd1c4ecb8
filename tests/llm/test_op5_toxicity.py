import itertools
import zlib

import numpy as np
import pyarrow.parquet as pq

from tidemark.llm import op5_toxicity as tox
from tests.llm.conftest import ODD


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    sizes = np.array([1, 4, 2, 6, 1, 4])
    emit, pairs = rng.normal(size=sizes.sum()) * 2, rng.normal(size=(2, 2))
    got, expected = tox.chain_marginals(emit, sizes, pairs, True)
    want, count = [], np.zeros((2, 2))
    for a, n in zip(np.concatenate(([0], np.cumsum(sizes))), sizes):
        weight, top, seen = 0.0, np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(emit[a + k] for k, t in enumerate(tags) if t)
                       + sum(pairs[x, y] for x, y in zip(tags, tags[1:])))
            weight += w
            top += w * np.array(tags)
            for x, y in zip(tags, tags[1:]):
                seen[x, y] += w
        want += list(top / weight)
        count += seen / weight
    assert np.allclose(got, want) and np.allclose(expected, count)


def test_long_chain_and_chunks():
    emit = np.random.default_rng(3).normal(size=70_000)
    p, _ = tox.chain_marginals(emit, np.array([60_000, 10_000]), np.array([[1.0, -1], [-1, 1]]))
    q, _ = tox.chain_marginals(emit[60_000:], np.array([10_000]), np.array([[1.0, -1], [-1, 1]]))
    assert np.isfinite(p).all() and np.allclose(p[60_000:], q)


def test_held_out_fold(spark):
    ids = [*range(50), None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", tox.held_out(tox.c("doc_id")).alias("h"))
    for r in rows.collect():
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["h"] == (zlib.crc32(text.encode()) % 3 == 1)


def test_accuracy_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = {r["doc_id"]: r for r in tox.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    known = dict(zip(*pq.read_table(f"{d}/labels.parquet").select(["doc_id", "toxic"]).to_pydict().values()))
    out = [(rows[i], y) for i, y in known.items() if rows[i]["held_out"]]
    assert np.mean([r["predicted"] == y for r, y in out]) >= 0.93
    hits = sum(r["predicted"] and y for r, y in out)
    assert hits >= 0.8 * sum(r["predicted"] for r, _ in out) and hits >= 0.8 * sum(y for _, y in out) > 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    text = dict(zip(*pq.read_table(f"{d}/documents.parquet").select(["doc_id", "text"]).to_pydict().values()))
    words = [text[i][s["start"]:s["end"]].lower() for i, r in rows.items() for s in r["spans"]]
    assert any("idiot" in w for w in words) and not any("\n" in w for w in words)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    fit = tox.fit(docs, labels)
    turned = labels.withColumn("toxic", tox.F.when(tox.held_out(tox.c("doc_id")), 1 - tox.c("toxic")).otherwise(tox.c("toxic")))
    other = tox.fit(docs, turned)
    assert np.array_equal(fit.weights, other.weights) and np.array_equal(fit.fit, other.fit)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (99, 1), (None, 1), (4, 7)], "doc_id long, toxic int")
    rows = tox.classify(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    flat = tox.classify(odd, labels.limit(0)).collect()
    assert len({r["score"] for r in flat}) == 1 and not any(r["predicted"] for r in flat)
    assert tox.classify(none, labels).collect() == []


def test_only_near_copies_with_one_label_leave_the_sample():
    rnd = np.random.default_rng(1)
    foot = " ".join(f"f{k}" for k in range(100))
    own = [" ".join(f"w{x}" for x in rnd.integers(0, 5000, 60)) + " " + foot for _ in range(200)]
    assert tox._first_of_copies(own, [k % 2 == 0 for k in range(200)]) == list(range(200))
    near = own[:3] + [t + " end" for t in own[:3]] + ["", ""]
    assert tox._first_of_copies(near, [False] * 8) == [0, 1, 2, 6, 7]
    assert tox._first_of_copies(near, [False] * 3 + [True] * 5) == list(range(8))
    assert tox._first_of_copies([], []) == []
    some = [rnd.choice(60, size=rnd.integers(1, 40), replace=False) for _ in range(150)]
    some += [np.where(rnd.random(len(s)) < .08, 99, s) for s in some]
    texts = [" ".join(f"q{x} a b c d" for x in np.sort(s)) for s in some]
    sets = [set(map(int, s)) for s in tox.shingle_sets([t.encode() for t in texts])]
    kept = []
    for k, s in enumerate(sets):
        if not any(4 * len(s & sets[j]) >= 3 * len(s | sets[j]) for j in kept):
            kept.append(k)
    assert tox._first_of_copies(texts, [True] * len(texts)) == kept and len(kept) < len(texts)
