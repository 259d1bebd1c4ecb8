"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their sets of distinct
five-word shingles is 0.75 or more.  For a set of n shingles every partner
shares at least T = ceil(0.75 n) of them.

1. *Census.* Documents of equal sets form one class.  A class that has a
   partner shares at least T shingles, so it has at most n - T that occur
   nowhere else.  A first census counts a third of the shingle universe (by
   hash) over all documents and drops those with more lone shingles than
   that; a second one counts all shingles of the classes left, which also
   gives every shingle's document frequency.
2. *Blocks.* Of two linked classes, the n - T + 1 rarest shingles of either
   have one in common.  Classes that meet in such a shingle are joined to
   its smallest class (never in pairs); connected classes form a block, and
   all links lie within blocks.
3. *Search.* In each block every class looks up its shingles' inverted
   lists: the short ones are merged by a heap, those met often enough are
   probed in the long ones by binary search, and what reaches the required
   overlap is a link.  A class is not searched for once all its block is
   connected.  A block beyond ``BLOCK_SHINGLES`` is split: each part searches
   itself and the block's hub, then the classes not connected to the hub
   search every other part, so no pair that could matter is left out.  That
   second search is dealt over tiles of one part and one slice of these
   classes; a tile streams the slice past the part's index and skips the
   trees that a class is connected to already.

Bounds hold per task (a batch of texts, a hash range, a part of a block);
counts are pre-aggregated by batch, so a shingle or a text that a third of
all documents share costs one entry per batch.

Defined results: null and empty texts, and texts without words, have an
empty set and link with nothing, not even with each other; a text of fewer
than five words is one shingle; repeated rows link as copies; a null id is
larger than any id as a component's id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.census import RANGE_HASHES, census, totals
from tidemark.llm.common import (c, join_spreading_hot, materialize, pieces_of, shingle_sets,
                                 shuffle_width, text_key, text_of)
from tidemark.llm.graph import components

#: link at 100 * intersection >= PERCENT * union
PERCENT, WIDTH = 75, 5
#: the first census counts one in so many shingles
UNIVERSE = 3
#: characters of text in a batch; shingles in a part of a block
BATCH_CHARS, BLOCK_SHINGLES = 2 << 20, 4_000_000
#: weight of a probe against a merged entry when lists are divided
PROBE = 0.0085
#: sets of a large tree that are tried before all sets of a block
TRIED = 64


def needed(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that a set of ``n`` shares with any partner at least."""
    return -(-PERCENT * n // 100)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


SETS = "batch string, uid array<long>, n array<int>, sizes array<int>, hashes binary"
BATCH = f"{SETS}, node array<long>, key array<binary>, digest array<binary>"


def _first_sets(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pieces_of(batches, "text", BATCH_CHARS):
        sets = shingle_sets([t.encode() for t in pdf["text"]], WIDTH)
        some = [s[s % np.uint64(UNIVERSE) == 0] for s in sets]
        yield pd.DataFrame({
            "batch": [uuid.uuid4().hex],
            "uid": [pdf["uid"].to_numpy()], "n": [np.array([len(s) for s in sets], dtype=np.int32)],
            "sizes": [np.array([len(s) for s in some], dtype=np.int32)],
            "hashes": [np.concatenate(some).tobytes()],
            "node": [[None if pd.isna(x) else int(x) for x in pdf["doc_id"]]], "key": [pdf["key"].tolist()],
            "digest": [[set_digest(s) for s in sets]]})


def _class_sets(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[int] = set()  # rows that repeat an id and a text bring one class more than once
    for pdf in pieces_of(batches, "text", BATCH_CHARS):
        pdf = pdf[~pdf["uid"].duplicated() & ~pdf["uid"].isin(seen)]
        if not len(pdf):
            continue
        seen.update(pdf["uid"])
        sets = shingle_sets([t.encode() for t in pdf["text"]], WIDTH)
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        yield pd.DataFrame({"batch": [uuid.uuid4().hex], "uid": [pdf["uid"].to_numpy()], "n": [sizes],
                            "sizes": [sizes], "hashes": [np.concatenate(sets).tobytes()]})


def _frequencies(row, replies: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's shingles, their document frequencies, and which document each is of."""
    return *totals(row.hashes, replies), np.repeat(np.arange(len(row.sizes)), row.sizes)


def _maybe_linked(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = []
    for row in left.itertuples():
        _, df, of = _frequencies(row, right)
        n = np.asarray(row.n)
        lone = np.bincount(of[df < 2], minlength=len(n))
        out += [(row.node[k], row.key[k], row.uid[k], row.digest[k]) for k in np.flatnonzero((n > 0) & (lone <= n - needed(n)))]
    return pd.DataFrame(out, columns=["doc_id", "key", "uid", "digest"], dtype=object)


def _rarest_first(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = []
    for row in left.itertuples():
        hashes, df, _ = _frequencies(row, right)
        edge = np.concatenate(([0], np.cumsum(row.sizes)))
        for k, (a, b) in enumerate(zip(edge, edge[1:])):
            n, (h, d) = b - a, (hashes[a:b], df[a:b])
            if (d < 2).sum() > n - needed(n):
                continue
            order = np.lexsort((h, d))[:n - needed(n) + 1]
            prefix = h[order][d[order] > 1]
            out.append((row.uid[k], n, h.view(np.int64), prefix.view(np.int64), int(d.sum(dtype=np.int64))))
    return pd.DataFrame(out, columns=["node", "n", "shingles", "prefix", "weight"], dtype=object)


class Lists:
    """Inverted lists over the sets of one block, searched by DivideSkip."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, start = np.unique(tokens[order], return_index=True)
        self.owner = owner[order]
        self.edge = np.append(start, len(tokens))

    def search(self, query: np.ndarray) -> np.ndarray:
        """The sets whose Jaccard similarity with ``query`` reaches the threshold."""
        n = len(query)
        at = np.searchsorted(self.tokens, query)
        known = at < len(self.tokens)
        known[known] = self.tokens[at[known]] == query[known]
        at = at[known]
        t = needed(n)
        if len(at) < t:
            return np.empty(0, dtype=np.int64)
        length = self.edge[at + 1] - self.edge[at]
        at = at[np.argsort(length, kind="stable")]
        longest = int(length.max())
        long = min(t - 1, int(t / (PROBE * np.log2(longest + 1) + 1)))
        short = len(at) - long
        merged = heapq.merge(*(self.owner[self.edge[i]:self.edge[i + 1]].tolist() for i in at[:short]))
        met = [(d, sum(1 for _ in g)) for d, g in groupby(merged)]
        cand = np.array([d for d, k in met if k >= t - long], dtype=np.int64)
        count = np.array([k for _, k in met if k >= t - long], dtype=np.int64)
        fits = (self.sizes[cand] >= t) & (needed(self.sizes[cand]) <= n)
        cand, count = cand[fits], count[fits]
        for rest, i in zip(range(long, 0, -1), at[short:]):
            live = count >= t - rest
            if not live.all():
                cand, count = cand[live], count[live]
            if not len(cand):
                break
            one = self.owner[self.edge[i]:self.edge[i + 1]]
            p = np.minimum(np.searchsorted(one, cand), len(one) - 1)
            count += one[p] == cand
        return cand[100 * count >= PERCENT * (n + self.sizes[cand] - count)]


class _Forest:
    def __init__(self, n: int):
        self.up, self.trees = list(range(n)), n

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)], self.trees = min(a, b), self.trees - 1
        return a != b


HUB, MEMBER, QUERY = 0, 1, 2


def _search_part(nodes: list[int], sets: list[np.ndarray], roles: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Links that connect one part of a block, and its nodes not connected to
    the hub, each with the node that stands for its tree.

    The hub goes first (the given one, or the set whose lists are longest),
    then every set still outside the hub's tree.
    """
    links: list[tuple[int, int]] = []
    lists = Lists(sets)
    forest = _Forest(len(nodes))
    hub = next((k for k, r in enumerate(roles) if r == HUB), None)
    if hub is None:
        length = np.diff(lists.edge)
        hub = int(np.argmax([length[np.searchsorted(lists.tokens, s)].sum() / len(s) for s in sets]))
    some: list[int] = []
    for q in [hub, *range(len(nodes))]:
        if forest.trees == 1:
            break
        if q != hub and forest.root(q) == forest.root(hub):
            continue
        # one link to the hub's tree settles a set, and a few of that tree's
        # sets often have it; only without one are all sets searched
        near = few.search(sets[q])[:1] if some else []
        met = [some[x] for x in near] or lists.search(sets[q]).tolist()
        for x in met:
            if forest.join(q, x):
                links.append((nodes[q], nodes[x]))
        if q == hub:
            tree = [k for k in range(len(nodes)) if forest.root(k) == forest.root(hub)]
            if len(tree) > 4 * TRIED:
                some = tree[::len(tree) // TRIED]
                few = Lists([sets[k] for k in some])
    return links, [(nodes[k], nodes[forest.root(k)]) for k in range(len(nodes)) if forest.root(k) != forest.root(hub)]


class _Tile:
    """One part of a block, searched by classes of other parts."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]):
        """``members`` are (tree, node, set); large trees get lists of their own."""
        self.number: dict[int, int] = {}
        self.forest = _Forest(0)
        trees: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for m in members:
            trees.setdefault(m[0], []).append(m)
        large = [ms for ms in trees.values() if len(ms) > 4 * TRIED]
        small = [m for ms in trees.values() if len(ms) <= 4 * TRIED for m in ms]
        # a few of a large tree's sets often have the link; only without one are all searched
        self.large = [(ms[0][0], [self._lists(ms[::len(ms) // TRIED]), self._lists(ms)]) for ms in large]
        self.small = self._lists(small) if small else None

    @staticmethod
    def _lists(members):
        return members, Lists([m[2] for m in members])

    def _place(self, tree: int) -> int:
        at = self.number.setdefault(tree, len(self.number))
        if at == len(self.forest.up):
            self.forest.up.append(at)
        return at

    def links(self, tree: int, node: int, query: np.ndarray) -> list[tuple[int, int]]:
        """One link to each tree that the query's tree is not connected to yet."""
        own, out = self._place(tree), []
        for other, tries in self.large:
            other = self._place(other)
            for members, lists in tries:
                if self.forest.root(own) == self.forest.root(other):
                    break
                for x in lists.search(query)[:1]:
                    self.forest.join(own, other)
                    out.append((node, members[x][1]))
        if self.small:
            members, lists = self.small
            for x in lists.search(query):
                if self.forest.join(own, self._place(members[x][0])):
                    out.append((node, members[x][1]))
        return out


LINKS = "u long, v long, block long, tree long"


def _set_of(shingles) -> np.ndarray:
    return np.sort(np.asarray(shingles, dtype=np.int64).view(np.uint64))


def _frames(rows: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["u", "v", "block", "tree"], dtype=object)
            out = []
    if out:
        yield pd.DataFrame(out, columns=["u", "v", "block", "tree"], dtype=object)


def _search_parts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Search each (block, part) of a partition sorted by them; rows with a
    null ``v`` name nodes not connected to their block's hub, with their tree."""
    def rows():
        for pdf in batches:
            yield from zip(pdf["block"], pdf["part"], pdf["role"], pdf["node"], pdf["shingles"])

    def found():
        for (block, _), group in groupby(rows(), key=lambda r: r[:2]):
            group = list(group)
            links, apart = _search_part([r[3] for r in group], [_set_of(r[4]) for r in group], [r[2] for r in group])
            yield from ((u, v, block, None) for u, v in links)
            yield from ((u, None, block, tree) for u, tree in apart)
    return _frames(found())


def _search_tiles(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each (block, part, slice) of a partition sorted by them, the
    part's members before the queries, which are not gathered."""
    def rows():
        for pdf in batches:
            yield from zip(pdf["block"], pdf["part"], pdf["slice"], pdf["role"], pdf["tree"], pdf["node"], pdf["shingles"])

    def found():
        for (block, _, _), group in groupby(rows(), key=lambda r: r[:3]):
            members, tile = [], None
            for *_, role, tree, node, shingles in group:
                if role == MEMBER:
                    members.append((tree, node, _set_of(shingles)))
                    continue
                tile = tile or _Tile(members)
                yield from ((u, v, block, None) for u, v in tile.links(tree, node, _set_of(shingles)))
    return _frames(found())


def _search(rows: DataFrame) -> DataFrame:
    return (rows.select("block", "part", "role", "node", "shingles")
            .repartition(shuffle_width(rows.sparkSession), "block", "part")
            .sortWithinPartitions("block", "part", "role", "node").mapInPandas(_search_parts, LINKS))


def _part_of(node: str, parts: str):
    return F.pmod(F.xxhash64(node), F.col(parts)).cast("int")


def search_blocks(near: DataFrame, blocks: DataFrame, bound: int = BLOCK_SHINGLES) -> DataFrame:
    """Connecting links ``(u, v)`` of the classes ``near(node, n, shingles, weight)``
    under ``blocks(node, block)``.  The hub of a split block is the class whose
    shingles are the most frequent on average."""
    sized = near.join(blocks, "node")
    split = materialize(
        sized.groupBy("block").agg(F.sum("n").alias("total"), F.max(F.struct(F.col("weight") / F.col("n"), "node")).alias("top"))
        .where(F.col("total") > bound)
        .select("block", F.ceil(F.col("total") / bound).alias("parts"), F.col("top.node").alias("hub")), "split_blocks")
    members = (sized.join(split, "block", "left")
               .withColumn("parts", F.coalesce("parts", F.lit(1)))
               .withColumn("part", _part_of("node", "parts")).withColumn("role", F.lit(MEMBER)))
    cols = ["block", "part", "role", "node", "shingles"]
    if split.isEmpty():
        return _search(members).where("v IS NOT NULL").select("u", "v")
    every = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))
    hubs = (near.join(split, near["node"] == split["hub"])
            .select("block", "parts", "node", "shingles", every.alias("part"), F.lit(HUB).alias("role")))
    first = members.where(F.col("hub").isNull() | (F.col("hub") != F.col("node")))
    found = materialize(_search(first.select(cols).unionByName(hubs.select(cols))), "links")
    apart = found.where("v IS NULL").select(F.col("u").alias("node"), "tree")
    inside = (members.where("hub IS NOT NULL").join(apart, "node", "left").withColumn("apart", F.col("tree").isNotNull())
              .withColumn("tree", F.coalesce("tree", "hub")))
    slices = materialize(inside.where("apart").groupBy("block").agg(F.ceil(F.sum("n") / bound).cast("int").alias("slices")), "slices")
    inside = inside.join(slices, "block")
    cols = ["block", "part", "slice", "role", "tree", "node", "shingles"]
    copies = inside.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    # its own part each class has searched
    queries = (inside.where("apart").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(1)), F.col("slices")).cast("int"))
               .withColumn("role", F.lit(QUERY)).withColumnRenamed("part", "own").withColumn("part", every).where("part <> own"))
    more = (copies.select(cols).unionByName(queries.select(cols))
            .repartition(shuffle_width(near.sparkSession), "block", "part", "slice")
            .sortWithinPartitions("block", "part", "slice", "role", "tree", "node").mapInPandas(_search_tiles, LINKS))
    return found.where("v IS NOT NULL").select("u", "v").unionByName(more.select("u", "v"))


def _ranges(sets: DataFrame, column: str) -> int:
    total = sets.select(F.sum(F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    return max(shuffle_width(sets.sparkSession), -(-total // RANGE_HASHES))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   bound: int = BLOCK_SHINGLES) -> DataFrame:
    """``(doc_id, text_key, n_shingles, component_id, first)`` of every row: the
    smallest id that links lead to, and whether the row is the first of those
    linked (smallest id, null last, then smallest ``text_key``).  Rows that
    repeat an id and a text are first together."""
    src = docs.select(c(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "key", text_key(F.col("text")))
    sets = materialize(src.withColumn("uid", F.monotonically_increasing_id()).mapInPandas(_first_sets, BATCH), "shingles")
    members = sets.select(F.explode(F.arrays_zip("node", "key", "n", "digest")).alias("m")).select(
        F.col("m.node").alias("doc_id"), "m.key", "m.n", "m.digest")

    heads = census(sets, _ranges(sets, "sizes"))
    maybe = (sets.groupBy("batch").cogroup(heads.groupBy("batch"))
             .applyInPandas(_maybe_linked, "doc_id long, key binary, uid long, digest binary"))
    reps = materialize(maybe.groupBy("digest").agg(F.min(F.struct("uid", "doc_id", "key")).alias("r"))
                       .select("digest", "r.uid", "r.doc_id", "r.key"), "classes")
    # by id and text: rows that share an id, or have none, spread by their texts
    texts = src.join(reps.select("uid", F.col("doc_id").alias("_id"), F.col("key").alias("_key")).hint("merge"),  # grows with the input
                     src["doc_id"].eqNullSafe(F.col("_id")) & (src["key"] == F.col("_key"))).select("uid", "text")
    again = materialize(texts.mapInPandas(_class_sets, SETS), "class_shingles")
    counts = census(again, _ranges(again, "sizes"))
    near = materialize(again.groupBy("batch").cogroup(counts.groupBy("batch")).applyInPandas(
        _rarest_first, "node long, n int, shingles array<long>, prefix array<long>, weight long"), "near")

    met = materialize(near.select("node", F.explode("prefix").alias("s")), "prefixes")
    first = materialize(met.groupBy("s").agg(F.min("node").alias("v"), F.max("node").alias("x"))
                        .where("v <> x").select("s", "v"), "leaders")
    edges = met.join(first, "s").select(F.col("node").alias("u"), "v").where("u <> v").distinct()
    blocks = materialize(components(edges).withColumnRenamed("component", "block"), "blocks")
    links = materialize(search_blocks(near, blocks, bound), "links")
    trees = components(links)

    # classes by digest, the first row of each, then of each tree
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("key").alias("k"))
    classes = materialize(members.where("n > 0").groupBy("digest").agg(
        F.min(order).alias("least"), F.count(F.lit(1)).alias("size")), "class_ids")
    node_of = reps.select("digest", F.col("uid").alias("node")).join(trees, "node").select("digest", "component")
    whole = classes.join(node_of, "digest", "left")
    best = whole.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("best"))
    labels = materialize(whole.join(best, "component", "left")
                         .select("digest", "size", F.coalesce("best", "least").alias("of")), "labels")
    total = members.count()
    out = join_spreading_hot(members.where("n > 0"), labels, "digest", "size", total)
    found = out.select("doc_id", "key", "n", F.col("of.i").alias("component_id"),
                       (F.col("doc_id").eqNullSafe(F.col("of.i")) & (F.col("key") == F.col("of.k"))).alias("first"))
    alone = members.where("n = 0").select("doc_id", "key", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return found.unionByName(alone).select("doc_id", F.col("key").alias("text_key"), F.col("n").cast("long").alias("n_shingles"),
                                           "component_id", "first")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       bound: int = BLOCK_SHINGLES) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row: the smallest id that
    links lead to."""
    return jaccard_groups(docs, id_col, text_col, bound).select("doc_id", "n_shingles", "component_id")
