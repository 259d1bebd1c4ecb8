"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of words: runs of letters and
digits, lower-cased; in scripts written without spaces (Chinese, Japanese,
Thai, Lao, Khmer, Burmese) every letter is a word.  Every run of ``MATCH``
words that a document shares with an item is a seed.  For each document and
item that share enough seeds, running Karp-Rabin matching looks for the longest
common runs of unmarked words, marks them as tiles on both sides, and goes on
with shorter ones down to ``MATCH`` words.  The share of the item's words under
tiles is its coverage, whatever the order in which the tiles stand in the
document, so reordered passages count in full.

The seeds meet in a join:

1. The benchmark's seeds become a table, and a Bloom filter of at most 8 MB.
2. One scan of the documents keeps, for each document, the seeds that the
   filter may hold, with their places; texts are neither shuffled nor written,
   and equal texts are searched once.
3. Tiles of ``w`` words in all, each of at least ``MATCH``, lie over at least
   ``w / MATCH`` of the item's seeds.  An item that needs ``t`` of them can do
   without its ``t - 1`` most common ones: a document without any of the others
   cannot contain it.  The others are joined to the documents' seeds, hot ones
   spread over several tasks, and give the pairs to look at; only these pairs
   get the common seeds as well.
4. A pair with ``t`` seeds or more is tiled in one group, from the seeds alone.

Seeds are compared by the MD5 of their words, and nothing of either table
passes through the driver but the filter.

Defined results: null text is empty; an item without words is never found; an
item of fewer than ``MATCH`` words is one seed, found where all its words stand
in a row (``shortest`` leaves out items of fewer words than that); equal items
are each reported; repeated rows are judged one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import HOT_SHARE, c, materialize, mix, pieces_of, text_key, text_of
from tidemark.operators.bloom import words_for
from tidemark.operators.joins import orphans_prefiltered

#: the shortest run of words that counts as shared
MATCH = 5
#: an item is contained in a document from this coverage on
COVERAGE = 0.5
#: the longest run looked for first
FIRST_RUN = 32
#: a join key on fewer rows than this is never spread
SPREAD_FROM = 100_000
#: scripts without spaces between words
_UNSPACED = "ก-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_WORDS = re.compile(rf"[^\W_{_UNSPACED}]+|[^\W_]").findall
_KR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
FOUND = "doc_id long, item_id long, item_words long, covered long, coverage double, tiles array<struct<item:int,doc:int,words:int>>"
_SEEDS = "uid long, item_id long, n long, need long, size int, key binary, h long, places array<int>, ids array<int>"
_HITS = "doc_id long, text_key binary, hits array<struct<key:binary,starts:array<int>>>"
_TILED = "text_key binary, item_id long, item_words long, covered long, coverage double, tiles array<struct<item:int,doc:int,words:int>>"


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def _run_hashes(seq: list[int], marked: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin: (start, hash) of every window of ``size`` unmarked words."""
    top = pow(_KR, size, 1 << 64)
    h = have = 0
    for end, x in enumerate(seq):
        if marked[end]:
            h = have = 0
            continue
        h = (h * _KR + x + 1) & _MASK
        have += 1
        if have > size:
            h = (h - (seq[end - size] + 1) * top) & _MASK
        if have >= size:
            yield end - size + 1, h


def tile(item: list[int], doc: list[int], least: int = MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles (item start, doc start, words), non-overlapping
    on both sides, longest first, then leftmost."""
    item_marked, doc_marked = bytearray(len(item)), bytearray(len(doc))
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(FIRST_RUN, len(item)))
    while True:
        # all maximal matches of at least `size` words, by length
        places: dict[int, list[int]] = {}
        for at, h in _run_hashes(item, item_marked, size):
            places.setdefault(h, []).append(at)
        found: list[tuple[int, int, int]] = []
        longest = 0
        if places:
            for at, h in _run_hashes(doc, doc_marked, size):
                for i in places.get(h, ()):
                    if i and at and item[i - 1] == doc[at - 1] and not (item_marked[i - 1] or doc_marked[at - 1]):
                        continue  # not the start of a maximal match
                    n = 0
                    while (i + n < len(item) and at + n < len(doc) and item[i + n] == doc[at + n]
                           and not item_marked[i + n] and not doc_marked[at + n]):
                        n += 1
                    if n >= size:
                        found.append((n, i, at))
                        longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, i, at in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if any(item_marked[i:i + n]) or any(doc_marked[at:at + n]):
                again = True  # what a longer tile left over is looked for once more
                continue
            item_marked[i:i + n] = doc_marked[at:at + n] = b"\x01" * n
            tiles.append((i, at, n))
        if all(item_marked) or (size == least and not again):
            return tiles
        if not again:
            size = max(least, size // 2)


# ---- words and seeds of whole batches ------------------------------------------

@cache
def _kinds() -> np.ndarray:
    """What every code point is: 0 no part of a word, 1 part of one, 2 a word alone."""
    out = np.fromiter((chr(k).isalnum() for k in range(0x110000)), dtype=np.uint8, count=0x110000)
    for a, b in re.findall("(.)-(.)", _UNSPACED):
        out[ord(a):ord(b) + 1] *= 2
    return out


class Words:
    """The words of some texts: their places in ``text`` and hashes, all in arrays."""

    def __init__(self, texts: list[str]):
        lower = [t.lower() for t in texts]
        self.text = "\n".join(lower)
        points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _kinds()[points]
        first = kind == 2
        first[1:] |= (kind[1:] == 1) & (kind[:-1] != 1)
        first[:1] |= kind[:1] == 1
        inside = np.flatnonzero(kind)
        self.start = np.flatnonzero(first)
        at = np.searchsorted(inside, self.start)
        self.length = np.diff(np.append(at, len(inside)))
        size = np.fromiter(map(len, lower), dtype=np.int64, count=len(lower))
        begin = np.cumsum(size + 1) - size - 1
        #: the text of each word, and the first word of each text
        self.of = np.searchsorted(begin, self.start, "right") - 1
        self.first = np.searchsorted(self.start, begin)
        if not len(self.start):
            self.hash = np.empty(0, np.uint64)
            return
        with np.errstate(over="ignore"):
            power = np.full(int(self.length.max()) + 1, _KR, dtype=np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            offset = np.arange(len(inside)) - np.repeat(at, self.length)
            self.hash = mix(np.add.reduceat((points[inside].astype(np.uint64) + np.uint64(1)) * power[offset], at))

    def seeds(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the runs of ``size`` words within one text."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.of[:n] == self.of[size - 1:])
        h = np.full(len(at), size, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                h = mix(h * np.uint64(_KR) + self.hash[at + k])
        return at, h

    def key(self, at: int, size: int) -> bytes:
        run = zip(self.start[at:at + size].tolist(), self.length[at:at + size].tolist())
        return _key([self.text[a:a + n] for a, n in run])


def _key(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def seed_table(benchmark: DataFrame, id_col: str, text_col: str, coverage: float, least: int, shortest: int) -> DataFrame:
    """One row per item and distinct seed: where it stands and the item's words there
    (each word by the place where the item has it first), and how many of its
    places a document that contains the item must share."""
    items = materialize(benchmark.select(F.monotonically_increasing_id().alias("uid"), c(id_col).cast("long").alias("item_id"),
                                         text_of(text_col).alias("text")), "benchmark_items")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pieces_of(batches, "text", 1 << 20):
            rows = []
            for uid, item_id, text in zip(pdf["uid"], pdf["item_id"], pdf["text"]):
                words, first = Words([text]), {}
                n = len(words.start)
                if n < max(shortest, 1):
                    continue
                size = min(least, n)
                ids = [first.setdefault(h, k) for k, h in enumerate(words_of(text))]
                need = -(-_least_words(coverage, n) // size)
                places: dict[bytes, list[int]] = {}
                hashes: dict[bytes, int] = {}
                at, h = words.seeds(size)
                for a, x in zip(at.tolist(), h.view(np.int64).tolist()):
                    key = words.key(a, size)
                    places.setdefault(key, []).append(a)
                    hashes[key] = x
                rows += [(uid, None if pd.isna(item_id) else int(item_id), n, need, size, key, hashes[key], p, ids[p[0]:p[0] + size])
                         for key, p in places.items()]
            if rows:
                yield pd.DataFrame(rows, columns=["uid", "item_id", "n", "need", "size", "key", "h", "places", "ids"], dtype=object)
    return materialize(items.mapInPandas(run, _SEEDS), "benchmark_seeds")


def _least_words(coverage: float, n: int) -> int:
    """The fewest words that are ``coverage`` of ``n``, at least one."""
    return next(k for k in range(max(1, int(coverage * n) - 1), n + 2) if k >= coverage * n)


# ---- the filter ------------------------------------------------------------------

def _filter(seeds: DataFrame) -> np.ndarray:
    """Bloom filter of the seeds' hashes: a power of two of 64-bit words, 8 MB at most.
    Tasks OR their bits by word first, and at most one row a word reaches the driver."""
    words = 1 << (words_for(seeds.count()) - 1).bit_length()  # at most bloom.MAX_WORDS, itself a power of two (2^20)

    def bits(k: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("h", 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    rows = seeds.select(F.shiftrightunsigned("h", 40).bitwiseAND(F.lit(words - 1)).alias("w"),
                        bits(0).bitwiseOR(bits(1)).bitwiseOR(bits(2)).bitwiseOR(bits(3)).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out


def _maybe(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.zeros(len(h), dtype=np.uint64)
    for k in range(4):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return filter_[((h >> np.uint64(40)) & np.uint64(len(filter_) - 1)).astype(np.int64)] & mask == mask


def _hits(docs: DataFrame, seeds: DataFrame, doc_id: Column, text_col: str) -> DataFrame:
    """Per document that may hold a seed: the keys of its seeds and their places."""
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # at most `least` numbers
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds))
    src = docs.select(doc_id.cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("text_key", text_key(F.col("text")))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for pdf in pieces_of(batches, "text", 1 << 20):
            words = Words(pdf["text"].tolist())
            found: dict[int, dict[bytes, list[int]]] = {}
            for size in sizes:
                at, h = words.seeds(size)
                at = at[_maybe(held, h)]
                for a, d, start in zip(at.tolist(), words.of[at].tolist(), (at - words.first[words.of[at]]).tolist()):
                    found.setdefault(d, {}).setdefault(words.key(a, size), []).append(start)
            if found:
                ids, keys = pdf["doc_id"].tolist(), pdf["text_key"].tolist()
                yield pd.DataFrame([(None if pd.isna(ids[d]) else int(ids[d]), keys[d], [{"key": k, "starts": s} for k, s in f.items()])
                                    for d, f in found.items()], columns=["doc_id", "text_key", "hits"], dtype=object)
    return materialize(src.mapInPandas(run, _HITS), "seed_hits")


# ---- pairs -----------------------------------------------------------------------

def _spread_join(big: DataFrame, small: DataFrame, key: str, by: str, least: int = SPREAD_FROM) -> DataFrame:
    """Inner join on ``key`` where some keys hold many rows of ``big``: the rows of
    such a key are dealt by ``by`` over several parts, and its rows of ``small`` go to each.
    More than 1 / HOT_SHARE of all rows have at most HOT_SHARE keys: the bound of the broadcast."""
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = max(big.count() // HOT_SHARE, least)
    hot = F.broadcast(counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = big.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("_parts")
    copied = small.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied.hint("merge"), [key, "_part"]).drop("_part")


def _matches(hits: DataFrame, seeds: DataFrame, least: int) -> DataFrame:
    """The shared seeds of every text and item that share as many as the item needs."""
    met = seeds.drop("h").join(hits.groupBy("key").agg(F.count(F.lit(1)).alias("often")).hint("merge"), "key")
    item = Window.partitionBy("uid")
    common_first = item.orderBy(F.desc("often"), "key").rowsBetween(Window.unboundedPreceding, 0)
    met = (met.withColumn("upto", F.sum(F.size("places")).over(common_first)).withColumn("all", F.sum(F.size("places")).over(item))
           .where("all >= need").withColumn("common", F.col("upto") < F.col("need")).drop("upto", "all", "often"))
    met = materialize(met, "seeds_met")
    rare = materialize(_spread_join(hits, met.where("NOT common").drop("common"), "key", "text_key", least), "seeds_shared")
    pairs = materialize(rare.select("text_key", "uid").distinct(), "pairs")
    rest = _spread_join(pairs, met.where("common").drop("common"), "uid", "text_key", least)
    rest = rest.join(hits.hint("merge"), ["text_key", "key"]).select(*rare.columns)
    pair = Window.partitionBy("text_key", "uid")
    return rare.unionByName(rest).withColumn("shared", F.sum(F.size("places")).over(pair)).where("shared >= need").drop("shared")


def _tiles_of(pair: pd.DataFrame) -> tuple[list[tuple[int, int, int]], int]:
    """Tiles and number of item words of one text and item, from the seeds they share."""
    n, size = int(pair["n"].iloc[0]), int(pair["size"].iloc[0])
    item = np.full(n, -1, dtype=np.int64)
    step = np.arange(size)
    at, ids = [], []
    for places, starts, words in zip(pair["places"], pair["starts"], pair["ids"]):
        words = np.asarray(words, dtype=np.int64)
        item[np.asarray(places, dtype=np.int64)[:, None] + step] = words
        at.append((np.asarray(starts, dtype=np.int64)[:, None] + step).ravel())
        ids.append(np.tile(words, len(starts)))
    # only words under shared seeds can be tiled; a break between separate
    # stretches keeps a tile from running across them
    under, one = np.unique(np.concatenate(at), return_index=True)
    gap = np.flatnonzero(np.diff(under) > 1) + 1
    doc = np.insert(np.concatenate(ids)[one], gap, -2)
    back = np.insert(under, gap, -1)
    return [(i, int(back[d]), k) for i, d, k in tile(item.tolist(), doc.tolist(), size)], n


def _found(docs: DataFrame, benchmark: DataFrame, doc_id: Column, text_col: str, item_col: str, item_text_col: str,
           coverage: float, least: int, shortest: int, spread_from: int) -> tuple[DataFrame, DataFrame]:
    """Documents with seeds (doc_id, text_key), and the items found in each text."""
    seeds = seed_table(benchmark, item_col, item_text_col, coverage, least, shortest)
    rows = _hits(docs, seeds, doc_id, text_col)
    hits = materialize(rows.dropDuplicates(["text_key"]).select("text_key", F.explode("hits").alias("x")).select("text_key", "x.*"), "hits")

    def judge(pair: pd.DataFrame) -> pd.DataFrame:
        tiles, n = _tiles_of(pair)
        got = sum(k for _, _, k in tiles)
        item_id = pair["item_id"].iloc[0]
        out = [(pair["text_key"].iloc[0], None if pd.isna(item_id) else int(item_id), n, got, got / n,
                [{"item": i, "doc": d, "words": k} for i, d, k in sorted(tiles)])] if got >= coverage * n else []
        return pd.DataFrame(out, columns=["text_key", "item_id", "item_words", "covered", "coverage", "tiles"], dtype=object)
    found = _matches(hits, seeds, spread_from).groupBy("text_key", "uid").applyInPandas(judge, _TILED)
    return rows.select("doc_id", "text_key"), materialize(found, "contained")


def contained(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE,
              least: int = MATCH, shortest: int = 1, spread_from: int = SPREAD_FROM) -> DataFrame:
    """The items that each document contains, reordered or not: ``FOUND`` rows."""
    rows, found = _found(docs, benchmark, c(id_col), text_col, item_col, item_text_col, coverage, least, shortest, spread_from)
    return (_spread_join(rows, found, "text_key", "doc_id", spread_from)
            .select("doc_id", "item_id", "item_words", "covered", "coverage", "tiles"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", coverage: float = COVERAGE, least: int = MATCH, shortest: int = 1,
          spread_from: int = SPREAD_FROM) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they are.  Rows
    whose text a Bloom filter of the texts with items does not hold stay in their task."""
    key = "_text_key"
    while key in {x.lower() for x in docs.columns}:
        key += "_"
    _, found = _found(docs, benchmark, F.lit(None), text_col, item_col, item_text_col, coverage, least, shortest, spread_from)
    bad = materialize(found.select("text_key").distinct(), "texts_with_items")
    return orphans_prefiltered(docs.withColumn(key, text_key(text_of(text_col))), key, bad, "text_key").drop(key)
