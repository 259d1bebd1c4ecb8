"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: a key is treated as hot once it holds more than 1/HOT_SHARE of all rows,
#: so at most HOT_SHARE keys can be hot: the proven bound of every hot-key broadcast
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def c(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with null counting as empty."""
    return F.coalesce(c(name).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """128 bits that tell a text from others with the same id, when it is read again."""
    return F.unhex(F.md5(text.cast("binary")))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a
    recomputation, and what was written is fixed for all later readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_spreading_hot(big: DataFrame, small: DataFrame, key: str, weight: str,
                       total: int) -> DataFrame:
    """Left join of ``big`` to ``small`` (unique on ``key``) with hot keys spread.

    ``weight`` is the number of ``big`` rows of each key and ``total`` their
    sum.  Keys above ``total / HOT_SHARE`` number at most ``HOT_SHARE``, so
    that part of ``small`` is broadcast and its rows never meet in one task;
    every other key goes through a sort-merge join.
    """
    limit = max(1, total // HOT_SHARE)
    hot = F.broadcast(small.where(F.col(weight) > limit).withColumn("_hot", F.lit(True)))
    met = big.join(hot, key, "left")
    cold = small.where(F.col(weight) <= limit)
    rest = met.where(F.col("_hot").isNull()).select(*big.columns).join(cold.hint("merge"), key, "left")
    done = met.where(F.col("_hot")).drop("_hot")
    return done.select(*rest.columns).unionByName(rest)


# ---- shingle hashes of whole Arrow batches -----------------------------------

#: bytes of text that are hashed together
HASHED_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, out=out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise a polynomial hash so that every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Prefix polynomial hashes (mod 2^64) of a byte array: any substring's hash in O(1)."""

    def __init__(self, data: np.ndarray, base: int = int(_BASE)):
        b = np.uint64(base | 1)
        n = len(data)
        h = np.zeros(n + 1, dtype=np.uint64)
        term = h[1:]  # in place: a byte costs 16 here, and no copies
        term += data
        with np.errstate(over="ignore"):
            term += np.uint64(1)
            term *= _powers(n, b)[:n]
            np.cumsum(term, out=term)
        self.h = h
        self.inv = _powers(n, _inverse(b))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.h[end] - self.h[start]) * self.inv[start]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with single spaces between words, and each word's span in them."""
    raw = np.frombuffer(text.translate(_LOWER), dtype=np.uint8)
    space = _SPACE[raw]
    # keep every word byte and the first white-space byte after a word
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    kept = raw[keep]
    sp = space[keep]
    kept = np.where(sp, np.uint8(32), kept)
    edge = np.flatnonzero(np.diff(np.concatenate(([1], sp.view(np.int8), [1]))))
    return kept, edge[0::2], edge[1::2]


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The set of ``width``-word shingle hashes of each text, sorted, as uint64.

    Words are maximal runs outside ``[\\x20\\x09-\\x0D]`` after lower-casing
    A-Z.  A text of fewer words is one shingle; one without words is empty.
    The texts are hashed together, so short ones cost no Python loop each, but
    ``HASHED_BYTES`` of them (or a longer one) at a time: a byte costs dozens.
    """
    part = np.cumsum([len(t) for t in texts]) // HASHED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return [s for a, b in zip(cuts, cuts[1:]) if b > a for s in _hashed_together(texts[a:b], width)]


def _hashed_together(texts: list[bytes], width: int) -> list[np.ndarray]:
    kept, starts, ends = word_spans(b"\n".join(texts))
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    out: list[np.ndarray] = []
    if len(starts) == 0:
        return [np.empty(0, dtype=np.uint64) for _ in texts]
    # which text a word belongs to: count words per text from the raw bytes
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    seen = np.concatenate(([0], np.cumsum(first)))
    lo = seen[begin]
    hi = seen[np.minimum(begin + sizes, len(raw))]
    hashes = PrefixHash(kept)
    n = len(starts)
    last = np.minimum(np.arange(n) + width - 1, n - 1)
    full = mix(hashes.of(starts, ends[last]))
    for a, b in zip(lo, hi):
        if b - a >= width:
            out.append(np.unique(full[a:b - width + 1]))
        elif b > a:
            out.append(mix(hashes.of(starts[a:a + 1], ends[b - 1:b])))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def pieces_of(batches: Iterable[pd.DataFrame], text: str, limit: int = 8 << 20) -> Iterable[pd.DataFrame]:
    """Cut Arrow batches so that one piece holds about ``limit`` characters at most
    (a single longer text still comes whole), which bounds working memory."""
    for pdf in batches:
        if not len(pdf):
            continue
        size = pdf[text].str.len().fillna(0).to_numpy()
        part = (np.cumsum(size) // limit).astype(np.int64)
        for p in np.unique(part):
            yield pdf[part == p]


def _slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterable[pa.RecordBatch]:
    """Slices of an Arrow batch whose texts hold about ``limit`` bytes at most."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.diff(np.cumsum(size) // limit)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def keep_rows(docs: DataFrame, text_col: str, judge: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps by their texts (null: empty),
    all columns as they are, decided in the scan without a shuffle."""
    # plain names on the way: a column's name may hold dots
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    text = f"c{docs.columns.index(text_col)}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, text):
                yield part.filter(pa.array(judge([t or "" for t in part.column(text).to_pylist()]), type=pa.bool_()))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
