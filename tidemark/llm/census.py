"""How often each of very many hashes occurs, told back to the batches that hold them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: hashes that one range counts, about
RANGE_HASHES = 4_000_000


def _ranges_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of each hash, non-decreasing in the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def census(batches: DataFrame, ranges: int, exact: bool = False) -> DataFrame:
    """Totals of the hashes (uint64, ``hashes binary``) of ``(batch, hashes)`` rows.

    Each batch sends its distinct hashes with their counts to the hashes'
    ranges and gets the totals (65535 at most) back as ``(batch, part, df)``,
    in the order of the batch's distinct hashes; see ``totals``.  A hash that
    everything holds costs one entry per batch.  Unless ``exact``, 32 bits
    tell hashes of one range apart, so a total may come out too large (about
    once in a thousand hashes), never too small.
    """
    kind = np.uint64 if exact else np.uint32

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for batch, data in zip(pdf["batch"], pdf["hashes"]):
                uniq, count = np.unique(np.frombuffer(data, dtype=np.uint64), return_counts=True)
                if not len(uniq):
                    continue
                part = _ranges_of(uniq, ranges)
                cut = np.flatnonzero(np.diff(part, prepend=-1))
                edge = np.append(cut, len(uniq))
                key, count = uniq.astype(kind), count.astype(np.uint32)
                yield pd.DataFrame({
                    "batch": [batch] * len(cut), "part": part[cut],
                    "keys": [key[a:b].tobytes() for a, b in zip(edge, edge[1:])],
                    "counts": [count[a:b].tobytes() for a, b in zip(edge, edge[1:])]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(pdf["keys"]), dtype=kind)
        counts = np.frombuffer(b"".join(pdf["counts"]), dtype=np.uint32)
        uniq, at = np.unique(keys, return_inverse=True)
        df = np.bincount(at, weights=counts, minlength=len(uniq))[at]
        df = np.minimum(df, 65535).astype(np.uint16)
        edge = np.concatenate(([0], np.cumsum([len(k) // keys.itemsize for k in pdf["keys"]])))
        return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"],
                             "df": [df[a:b].tobytes() for a, b in zip(edge, edge[1:])]})

    sent = batches.select("batch", "hashes").mapInPandas(send, "batch string, part long, keys binary, counts binary")
    return sent.groupBy("part").applyInPandas(total, "batch string, part long, df binary")


def totals(hashes: bytes, replies: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A batch's hashes and the total of each, from its replies."""
    own = np.frombuffer(hashes, dtype=np.uint64)
    uniq, at = np.unique(own, return_inverse=True)
    df = np.frombuffer(b"".join(replies.sort_values("part")["df"]), dtype=np.uint16)
    assert len(df) == len(uniq)
    return own, df[at]
