"""Language-model scores by Katz backoff over n-gram counts of the corpus.

    P(w | h) = d(c(hw)) / c(h)            where hw was seen,
               alpha(h) * P(w | h')       where only h was seen,
               P(w | h')                  else,

with ``h'`` = ``h`` without its first word, down to single words, whose unseen
mass goes to one class of unknown words.  ``d`` is the Good-Turing discount of
counts up to ``K`` (Katz's form; a smaller ``K`` where the corpus has too few
counts of counts for it), and

    alpha(h) = (1 - sum of d(c(hw)) / c(h)) / (1 - sum of P(w | h'))

over the words seen after ``h``, so every distribution sums to one exactly.
A history with no discounted word keeps one part in ``c(h) + 1`` for others.

How it runs.  Texts are read once and kept as batches of token numbers.  For
each order a batch sends its distinct n-grams (64-bit hashes) with their
training counts to hash ranges; a range adds them up, stores its part of the
n-gram table and answers each batch with the totals.  The batch that comes
first in a range owns an n-gram: it adds its share to the sums of the history,
which are dealt, added up, stored and answered likewise.  A word that
everything holds costs one entry a batch, a history of any number of followers
one entry a batch.  Then each batch evaluates the recursion for its tokens.

The tables of a model (``kind=table`` under ``grams_N`` and ``histories_N``)
stay: ``score_by`` scores other texts by them, asking them in the same way.

Defined results: null text is empty, with the end as its only token; a null
id counts as the empty text for ``held_out`` and is reported as null; repeated
rows are counted and scored one by one; without training texts every token is
unknown, with probability one; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.census import _ranges_of
from tidemark.llm.common import _LOWER, _SPACE, PrefixHash, c, mix, shuffle_width, text_of
from tidemark.session import scratch_path

#: bytes of text in a batch, hashed together, and tokens counted by one range, about
BATCH_BYTES, UNIT, RANGE_TOKENS = 16 << 20, 1 << 20, 2_000_000
#: largest count that is discounted; least mass of unseen words, against rounding
K, LEAST = 5, 1e-12
#: hashes of the end token and of what stands before a text
END, START = np.uint64(0x454E44), np.uint64(0x5354415254)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GAP = re.compile(rb"[\x20\x09-\x0D]").search


# ---- tokens of a batch ----------------------------------------------------------


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``UNIT`` bytes, cut behind white space."""
    at = 0
    while len(text) - at > UNIT and (space := _GAP(text, at + UNIT)):
        yield text[at:space.start()]
        at = space.start()
    yield text[at:]


def _words(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the pieces, and the number of words of each."""
    raw = np.frombuffer(b"\n".join(pieces).translate(_LOWER), dtype=np.uint8)
    space = np.concatenate(([True], _SPACE[raw], [True]))
    begin = np.flatnonzero(space[:-1] & ~space[1:])
    end = np.flatnonzero(~space[:-1] & space[1:])
    size = np.fromiter((len(p) + 1 for p in pieces), dtype=np.int64, count=len(pieces))
    edge = np.searchsorted(begin, np.concatenate(([0], np.cumsum(size))))
    return mix(PrefixHash(raw).of(begin, end)), np.diff(edge)


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and each text's number of tokens."""
    parts, many = [], np.ones(len(texts), dtype=np.int64)
    held: list[tuple[int, bytes]] = []

    def flush():
        if held:
            words, n = _words([p for _, p in held])
            np.add.at(many, [k for k, _ in held], n)
            parts.append(words)
            held.clear()
    size = 0
    for k, t in enumerate(texts):
        for p in _pieces(t):
            held.append((k, p))
            size += len(p) + 1
            if size > UNIT:
                flush()
                size = 0
    flush()
    out = np.full(int(many.sum()), END, dtype=np.uint64)
    word = np.ones(len(out), dtype=bool)
    word[np.cumsum(many) - 1] = False
    out[word] = np.concatenate(parts) if parts else []
    return out, many


TOKENS = "batch string, doc_id array<long>, named array<boolean>, train array<boolean>, n array<long>, vocabulary binary, ids binary"


def _tokens(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        if not len(pdf):
            continue
        texts = [t.encode() for t in pdf["text"]]
        size = np.cumsum([len(t) + 1 for t in texts])
        part = (size - 1) * -(-int(size[-1]) // BATCH_BYTES) // int(size[-1])
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            tokens, n = hashed([texts[k] for k in own])
            vocabulary, ids, count = np.unique(tokens, return_inverse=True, return_counts=True)
            often = np.argsort(-count, kind="stable")  # small numbers for frequent words
            place = np.empty(len(often), dtype=np.uint32)
            place[often] = np.arange(len(often), dtype=np.uint32)
            rows = pdf.iloc[own]
            yield pd.DataFrame({
                "batch": [uuid.uuid4().hex], "doc_id": [rows["doc_id"].to_numpy()], "named": [rows["named"].to_numpy()],
                "train": [rows["train"].to_numpy()], "n": [n], "vocabulary": [vocabulary[often].tobytes()],
                "ids": [place[ids].tobytes()]})


class Batch:
    """The tokens of a batch and its distinct n-grams."""

    def __init__(self, row):
        self.batch, self.n = row.batch, np.asarray(row.n, dtype=np.int64)
        self.tokens = np.frombuffer(row.vocabulary, dtype=np.uint64)[np.frombuffer(row.ids, dtype=np.uint32)]
        self.begin = np.cumsum(self.n) - self.n
        self.train = np.repeat(np.asarray(row.train, dtype=bool), self.n)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n-gram that ends at each token, and of its history."""
        own, before = self.tokens, np.full(len(self.tokens), START, dtype=np.uint64)
        for _ in range(order - 1):
            before = np.concatenate(([START], own[:-1]))
            before[self.begin] = START
            with np.errstate(over="ignore"):
                own = mix(before * _STEP + self.tokens)
        return own, before


# ---- counts on their way ----------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, most of them small: a byte each, larger ones in full behind."""
    return np.minimum(values, 255).astype(np.uint8).tobytes() + values[values >= 255].astype(np.uint64).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, dtype=np.uint8, count=n).astype(np.uint64)
    out[out == 255] = np.frombuffer(data, dtype=np.uint64, offset=n) if len(data) > n else []
    return out


def _dealt(batch: str, keys: np.ndarray, ranges: int, **columns: Callable[[int, int], bytes]) -> pd.DataFrame:
    """Sorted keys cut by hash range, with what belongs to them."""
    part = _ranges_of(keys, ranges)
    cut = np.flatnonzero(np.diff(part, prepend=-1))
    edge = list(zip(cut.tolist(), [*cut[1:].tolist(), len(keys)]))
    return pd.DataFrame({"batch": [batch] * len(cut), "part": part[cut], "keys": [keys[a:b].tobytes() for a, b in edge],
                         **{name: [f(a, b) for a, b in edge] for name, f in columns.items()}})


SENT = "batch string, part long, keys binary, data binary"
BACK = "kind string, batch string, part long, keys binary, data binary, own binary, stats array<long>"
STORED = ""  # the batch that stands for the stored table


def _send_grams(order: int, ranges: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for b in map(Batch, pdf.itertuples()):
                keys, at = np.unique(b.grams(order)[0], return_inverse=True)
                count = np.bincount(at, weights=b.train, minlength=len(keys)).astype(np.uint64)
                yield _dealt(b.batch, keys, ranges, data=lambda x, y: pack(count[x:y]))
    return run


def _answers(pdf: pd.DataFrame, size: list[int], own: np.ndarray | None, data: Callable[[int, int], bytes],
             table: dict) -> pd.DataFrame:
    """A row for every batch, and the range's part of the table if it isn't stored yet."""
    edge = np.concatenate(([0], np.cumsum(size))).tolist()
    rows = [("reply", b, p, None, data(x, y), None if own is None else np.packbits(own[x:y]).tobytes(), None)
            for b, p, x, y in zip(pdf["batch"], pdf["part"], edge, edge[1:]) if b != STORED]
    if len(rows) == len(pdf):
        rows.append(("table", STORED, pdf["part"].iloc[0], table["keys"], table["data"], None, table["stats"]))
    return pd.DataFrame(rows, columns=[x.split()[0] for x in BACK.split(", ")], dtype=object)


def _count_grams(pdf: pd.DataFrame) -> pd.DataFrame:
    size = [len(k) // 8 for k in pdf["keys"]]
    keys = np.frombuffer(b"".join(pdf["keys"]), dtype=np.uint64)
    count = np.concatenate([unpack(d, n) for d, n in zip(pdf["data"], size)])
    uniq, first, at = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(at, weights=count, minlength=len(uniq)).astype(np.uint64)
    own = np.zeros(len(keys), dtype=bool)
    if STORED not in set(pdf["batch"]):  # else the stored sums of the histories have them all
        own[first] = True
    seen = total > 0
    stats = [int(total.sum()), int(seen.sum()), *(int((total == r).sum()) for r in range(1, K + 2))]
    full = total[at]
    return _answers(pdf, size, own, lambda x, y: pack(full[x:y]),
                    {"keys": uniq[seen].tobytes(), "data": pack(total[seen]), "stats": stats})


class Discount(NamedTuple):
    """Good-Turing discounts of one order: ``d(r)`` for small ``r``, tokens, and the unseen mass."""
    of: np.ndarray
    tokens: int
    unseen: float

    def __call__(self, count: np.ndarray) -> np.ndarray:
        return np.where(count < len(self.of), self.of[np.minimum(count, len(self.of) - 1).astype(np.int64)], count.astype(np.float64))


def good_turing(stats: list[int]) -> Discount:
    """From tokens, types and the numbers of n-grams seen once, twice ... ``K + 1`` times."""
    tokens, n = stats[0], [0, *stats[2:]]
    for k in range(K, 0, -1):
        if not all(n[1:k + 2]):
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        d = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if rest < 1 else 0.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            lost = sum(r * (1 - x) * n[r] for r, x in enumerate(d, 1))
            return Discount(np.array([0.0, *(r * x for r, x in enumerate(d, 1))]), tokens, lost / tokens)
    return Discount(np.zeros(1), tokens, 1 / (tokens + 1))


# ---- the recursion ------------------------------------------------------------------


class Answers:
    """What a batch was told: totals by order, and the histories' counts and weights."""

    def __init__(self, replies: pd.DataFrame):
        self.by = {what: own.sort_values("part") for what, own in replies.groupby("what")}

    def totals(self, order: int, keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        size = np.bincount(_ranges_of(keys, ranges), minlength=ranges)
        own = self.by[f"grams_{order}"]
        sizes = size[own["part"].to_numpy(dtype=np.int64)]
        assert sizes.sum() == len(keys)
        return (np.concatenate([unpack(d, n) for d, n in zip(own["data"], sizes)]),
                np.concatenate([np.unpackbits(np.frombuffer(o, dtype=np.uint8), count=n) for o, n in zip(own["own"], sizes)]).astype(bool))

    def histories(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        both = [np.frombuffer(d, dtype=np.float64).reshape(2, -1) for d in self.by[f"histories_{order}"]["data"]]
        return tuple(np.concatenate(both, axis=1))


def _single(b: Batch, told: Answers, discounts: list[Discount], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's count and probability by itself."""
    keys, at = np.unique(b.tokens, return_inverse=True)
    count, d = told.totals(1, keys, ranges)[0], discounts[0]
    if d.tokens == 0:
        return count[at], np.ones(len(at))
    part = d(count) / (d.tokens + (len(d.of) == 1))  # without discounts one part is kept for the unknown
    return count[at], np.where(count > 0, part, d.unseen)[at]


def _backed_off(b: Batch, told: Answers, discounts: list[Discount], ranges: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's count and its probability by histories of up to ``order - 1`` words."""
    if order == 1:
        return _single(b, told, discounts, ranges)
    count, lower = _backed_off(b, told, discounts, ranges, order - 1)
    grams, before = b.grams(order)
    keys, at = np.unique(grams, return_inverse=True)
    seen = told.totals(order, keys, ranges)[0][at]
    _, hist = np.unique(before, return_inverse=True)
    total, alpha = (x[hist] for x in told.histories(order))
    own = discounts[order - 1](seen) / np.maximum(total, 1)
    return count, np.where(seen > 0, own, np.where(total > 0, alpha * lower, lower))


def _send_histories(order: int, ranges: int, discounts: list[Discount]):
    """Each batch's histories with its share of: counts, discounted counts, probability of the lower order."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        told = Answers(right)
        for b in map(Batch, left.itertuples()):
            _, lower = _backed_off(b, told, discounts, ranges, order - 1)
            grams, before = b.grams(order)
            keys, first = np.unique(grams, return_index=True)
            count, own = told.totals(order, keys, ranges)
            names, hist = np.unique(before, return_inverse=True)
            own &= count > 0
            at, count = first[own], count[own]
            sums = [np.bincount(hist[at], weights=x, minlength=len(names)) for x in
                    (count.astype(np.float64), discounts[order - 1](count), lower[at])]
            out.append(_dealt(b.batch, names, ranges, data=lambda x, y: np.concatenate([s[x:y] for s in sums]).tobytes()))
        return pd.concat(out) if out else pd.DataFrame(columns=["batch", "part", "keys", "data"], dtype=object)
    return run


def _weigh_histories(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and backoff weights of the histories."""
    size = [len(k) // 8 for k in pdf["keys"]]
    uniq, at = np.unique(np.frombuffer(b"".join(pdf["keys"]), dtype=np.uint64), return_inverse=True)
    parts = np.concatenate([np.frombuffer(d, dtype=np.float64).reshape(3, -1) for d in pdf["data"]], axis=1)
    total, kept, lower = (np.bincount(at, weights=x, minlength=len(uniq)) for x in parts)
    seen = total > 0
    scale = total + (seen & (kept == total))  # one part for others where nothing is discounted
    alpha = np.where(seen, (scale - kept) / np.maximum(scale, 1) / np.maximum(1 - lower, LEAST), 1.0)
    full = np.stack([scale, alpha])[:, at]
    return _answers(pdf, size, None, lambda x, y: full[:, x:y].tobytes(),
                    {"keys": uniq[seen].tobytes(), "data": np.stack([total, kept, lower])[:, seen].tobytes(), "stats": []})


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(order: int, ranges: int, discounts: list[Discount], types: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, n = [], discounts[0].tokens
        told = Answers(right)
        for row in left.itertuples():
            b = Batch(row)
            count, p = _backed_off(b, told, discounts, ranges, order)
            add = lambda x: np.add.reduceat(x, b.begin)
            out.append(pd.DataFrame({
                "doc_id": pd.Series(np.asarray(row.doc_id), dtype="Int64").where(np.asarray(row.named, dtype=bool)), "held_out": ~np.asarray(row.train, dtype=bool), "n_tokens": b.n,
                "n_known": add((count > 0).astype(np.int64)), "train_tokens": n,
                "base_score": add(np.log10((count + 1) / (n + types + 1))), "score": add(np.log10(p))}))
        return pd.concat(out) if out else pd.DataFrame(columns=[x.split()[0] for x in SCORES.split(", ")], dtype=object)
    return run


class Model(NamedTuple):
    """Where the tables are, and over how many hash ranges."""
    path: str
    ranges: int
    order: int

    def table(self, spark, name: str) -> DataFrame:
        return spark.read.schema(BACK).parquet(f"{self.path}/{name}").where("kind = 'table'")

    def stats(self, spark, order: int) -> list[int]:
        """Tokens, types and counts of counts: ``K + 3`` numbers."""
        row = self.table(spark, f"grams_{order}").select(*(F.sum(F.col("stats")[i]) for i in range(K + 3))).first()
        return [x or 0 for x in row]


def _tokenised(src: DataFrame) -> DataFrame:
    """The batches, in buckets, so that later only the answers are shuffled to them."""
    spark = src.sparkSession
    name = f"tokens_{uuid.uuid4().hex[:12]}"
    (src.mapInPandas(_tokens, TOKENS).write.format("parquet").bucketBy(shuffle_width(spark), "batch")
     .option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def _run(src: DataFrame, order: int, known: Model | None) -> tuple[DataFrame, Model]:
    spark, tokens = src.sparkSession, _tokenised(src)
    path = scratch_path(spark, "model")
    if known:
        model = known
    else:
        n = tokens.select(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
        model = Model(path, max(1, -(-n // RANGE_TOKENS)), order)
    told, discounts, types = None, [], 0

    def ask(sent: DataFrame, name: str, add) -> DataFrame:
        """Deal, add up, store and answer; all answers so far."""
        if known:
            sent = sent.unionByName(known.table(spark, name).select("batch", "part", "keys", "data"))
        sent.groupBy("part").applyInPandas(add, BACK).write.partitionBy("kind").parquet(f"{path}/{name}")
        got = (spark.read.schema(BACK).parquet(f"{path}/{name}").where("kind = 'reply'")
               .select("batch", "part", "data", "own", F.lit(name).alias("what")))
        return told.unionByName(got) if told else got

    for k in range(1, model.order + 1):
        told = ask(tokens.mapInPandas(_send_grams(k, model.ranges), SENT), f"grams_{k}", _count_grams)
        stats = model.stats(spark, k)
        discounts.append(good_turing(stats))
        types = types or stats[1]
        if k > 1:
            sent = (tokens.groupBy("batch").cogroup(told.groupBy("batch"))
                    .applyInPandas(_send_histories(k, model.ranges, list(discounts)), SENT))
            told = ask(sent, f"histories_{k}", _weigh_histories)
    return tokens.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(
        _score(model.order, model.ranges, discounts, types), SCORES), model


def _source(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    name = c(id_col).cast("long")
    return docs.select(F.coalesce(name, F.lit(0)).alias("doc_id"), name.isNotNull().alias("named"),
                       text_of(text_col).alias("text"), train.alias("train"))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          order: int = 2) -> tuple[DataFrame, Model]:
    """Scores of every row by a model of the rows that are not ``held_out``, and that model.

    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``
    with log10 probabilities; ``base_score`` adds one to single words' counts.
    """
    return _run(_source(docs, id_col, text_col, ~F.coalesce(held_out, F.lit(False))), order, None)


def score_by(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row by a stored model; all rows are held out."""
    return _run(_source(docs, id_col, text_col, F.lit(False)), model.order, model)[0]
