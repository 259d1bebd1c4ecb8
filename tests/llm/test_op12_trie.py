import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import op12_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, `a.b c` int"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    members, ends, last = defaultdict(list), defaultdict(list), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seq = own.get(c - (abs(c) % 100 * (1 if c >= 0 else -1)), [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        value = (len(m) - 1) * len(k[-1][1]) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += value
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items()), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, trie.prefix_trie(*trie.rebuild(trie.number_turns(df)), **kw).collect()), key=str)


def conversations(seed, n=60, long=0, words=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        base = rnd.choice([0, 100, 200, 300]) + rnd.randrange(60)
        rows += [(base, t, rnd.choice(["user", "assistant"]), "w" * rnd.randrange(words)) for t in range(rnd.randrange(1, 9))]
    rows += [(500, t, "user", "ab"[t % 2] * (t % 7)) for t in range(long)]
    rows += [(501, t, "user", "ab"[t % 2] * (t % 7)) for t in range(long // 2)]
    return rows


@pytest.mark.parametrize("local", [trie.LOCAL, 20, 1])
def test_equals_brute_force(spark, local):
    rows = conversations(local, n=40)
    assert run(spark, rows, local=local) == brute(rows)


def test_long_conversation_is_scanned_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 7)
    monkeypatch.setattr(trie, "PIECE", 2)
    rows = conversations(1, n=10, long=150)
    assert run(spark, rows, local=40) == brute(rows)


def test_nulls_ties_repeats_and_missing_heads(spark):
    rows = [(1, None, "user", None), (1, None, None, "a"), (1, 3, "user", "b"), (1, 3, "user", "b"), (1, 3, "user", "b"),
            (None, 1, "user", "lost"), (-7, 1, "user", "n"), (-7, 2, "user", "m"), (205, 1, "user", "only"), (7, 0, "", ""),
            (100, 1, "user", "x" * 50_000), (100, 1, "assistant", "é漢🎉")]
    rows += [(k, 1, "user", "same") for k in range(600, 690)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_roll_up_against_sums_from_below():
    rnd = random.Random(2)
    for n in (1, 2, 9, 300):
        parent = [-1] + [rnd.randrange(max(0, k - 4), k) for k in range(1, n)]
        values = [(rnd.randrange(5), rnd.randrange(100)) for _ in range(n)]
        weight, due = [1] * n, [list(v) for v in values]
        for k in range(n - 1, 0, -1):
            weight[parent[k]] += weight[k]
            due[parent[k]] = [x + y for x, y in zip(due[parent[k]], due[k])]
        assert trie.roll_up(parent, weight, values) == due
