import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import op10_ngram_join as nj
from tidemark.llm.graph import components
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    lists = {}
    for k, s in enumerate(sets):
        near = {}
        for x in s:
            for j in lists.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            lists[x].append(k)
        for j, m in near.items():
            if 100 * m >= 75 * (len(s) + len(sets[j]) - m):
                up[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        key = i if i is not None else 1 << 60
        least[root(k)] = min(least.get(root(k), 1 << 60), key)
    return sorted(((i, len(s), least[root(k)] if least[root(k)] < 1 << 60 else None)
                   for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def run(docs, **kw):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                   for r in nj.jaccard_components(docs, **kw).collect()), key=str)


def near_copies(seed=3, groups=12, size=8, words=60):
    rnd, texts = random.Random(seed), []
    passage = " ".join(f"p{k}" for k in range(40))
    for g in range(groups):
        base = [f"w{rnd.randrange(3000)}" for _ in range(words)]
        for _ in range(rnd.randrange(1, size)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(50)}"
            texts.append(" ".join(copy) + (" " + passage if rnd.random() < .4 else ""))
    texts += ["A b\tc", "a B c", "one", "one two three four five", "ONE two three four  five"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("bound", [nj.BLOCK_SHINGLES, 200])
def test_against_brute_force(spark, bound):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, bound=bound) == brute(rows)


def test_given_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = list(zip(*pq.read_table(path).select(["doc_id", "text"]).to_pydict().values()))
    assert run(spark.read.parquet(path)) == brute(rows)


def test_odd_rows(spark, odd, none):
    got, want = run(odd), brute(ODD)
    assert got == want
    assert run(none) == []


def test_search_equals_counting():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        base = rnd.choice(400, size=rnd.integers(1, 120), replace=False)
        sets = [np.unique(np.where(rnd.random(len(base)) < .06, rnd.integers(0, 400, len(base)), base)).astype(np.uint64)
                for _ in range(12)]
        lists = nj.Lists(sets)
        for q in sets:
            want = [k for k, s in enumerate(sets)
                    if 100 * len(np.intersect1d(q, s)) >= 75 * len(np.union1d(q, s))]
            assert lists.search(q).tolist() == want


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 99), (98, 99), (7, 7), (200, 200), (-5, 98)]
    frame = spark.createDataFrame([*pairs, (None, 3)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {**{k: 0 for k in range(41)}, 98: -5, 99: -5, 100: -5, -5: -5, 200: 200}
    assert components(frame.limit(0)).collect() == []


def test_large_group_of_near_copies_is_connected_and_nothing_else():
    rnd = random.Random(8)
    base = [rnd.randrange(1 << 60) for _ in range(60)]
    sets = []
    for k in range(700):
        own = list(base)
        for x in rnd.sample(range(60), rnd.randrange(0, 13)):
            own[x] = rnd.randrange(1 << 60)
        sets.append(np.unique(np.array(own, dtype=np.uint64)))
    links, apart = nj._search_part(list(range(700)), sets, [nj.MEMBER] * 700)
    up = list(range(700))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for u, v in links:
        assert 100 * len(np.intersect1d(sets[u], sets[v])) >= 75 * len(np.union1d(sets[u], sets[v]))
        up[root(u)] = root(v)
    got = [root(k) for k in range(700)]
    up = list(range(700))
    for a in range(700):
        for b in range(a):
            if root(a) != root(b) and 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b])):
                up[root(a)] = root(b)
    want = [root(k) for k in range(700)]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_groups_not_connected_to_the_hub_give_few_links(spark):
    """Two groups of near copies in one split block, and an aggregator of large weight that links with nothing."""
    rnd, sets = random.Random(11), []
    for g in range(2):
        base = [rnd.randrange(1 << 60) for _ in range(60)]
        for _ in range(300 - 150 * g):
            own = list(base)
            for x in rnd.sample(range(60), rnd.randrange(0, 6)):
                own[x] = rnd.randrange(1 << 60)
            sets.append(sorted(own))
        sets.append(base[:40] + [rnd.randrange(1 << 60) for _ in range(30)])
    sets.append(sorted(x for s in sets[::50] for x in s[:30]))
    count = {}
    for s in sets:
        for x in set(s):
            count[x] = count.get(x, 0) + 1
    sets = [sorted(set(s)) for s in sets]
    near = spark.createDataFrame([(k, len(s), s, sum(count[x] for x in s)) for k, s in enumerate(sets)],
                                 "node long, n int, shingles array<long>, weight long")
    blocks = spark.createDataFrame([(k, 0) for k in range(len(sets))], "node long, block long")
    links = [tuple(r) for r in nj.search_blocks(near, blocks, bound=7000).collect()]
    assert len(links) < 3 * len(sets)
    linked = [[100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b)) for b in sets] for a in sets]
    assert all(linked[u][v] for u, v in links)

    def trees(pairs):
        forest = nj._Forest(len(sets))
        for u, v in pairs:
            forest.join(u, v)
        return [forest.root(k) for k in range(len(sets))]
    assert trees(links) == trees((a, b) for a in range(len(sets)) for b in range(a) if linked[a][b])


def test_tile_with_a_large_tree_links_it_once():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.where(rnd.random(60) < .05, rnd.integers(0, 1 << 60, 60).astype(np.uint64), base)) for _ in range(400)]
    tile = nj._Tile([(7, k, s) for k, s in enumerate(sets[:300])] + [(8, 300, np.arange(5, dtype=np.uint64))])
    links = [link for k, s in enumerate(sets[300:], 301) for link in tile.links(9, k, s)]
    assert len(links) == 1 and tile.links(8, 900, np.arange(5, dtype=np.uint64)) == []
    assert tile.links(10, 901, np.arange(5, dtype=np.uint64)) == [(901, 300)]


def test_hashing_a_batch_holds_little_memory():
    import tracemalloc

    import numpy as np

    from tidemark.llm.common import HASHED_BYTES, shingle_sets
    texts = [b" ".join(b"%d-%d-%s" % (k, j, b"x" * 40) for j in range(300)) for k in range(200)] + [b"", b"a B", b" \n"]
    tracemalloc.start()
    sets = shingle_sets(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 10 * HASHED_BYTES and peak < 30 << 20
    assert len(sets) == len(texts) and [len(s) for s in sets[-3:]] == [0, 1, 0]
    assert all(np.array_equal(a, shingle_sets([t])[0]) for a, t in zip(sets, texts))
