"""Hard negatives by segment summary filtering.

A vector is cut into segments; of each the mean and the deviation are stored.
Within a segment of ``n`` components the inner product of two vectors is
``n * mean * mean'`` plus or minus at most ``n * deviation * deviation'``
(Cauchy and Schwarz), so the summaries bound a score from both sides.  Rows
that the bounds of one segment rule out are gone; the rest is bounded by finer
segments, and only what is left after the finest is scored exactly.

1. The index: integer components and the summaries of every row, written once.
2. Anchors and rows are dealt in blocks; a task holds one block of each.  The
   first search gives each anchor its best rows of its own label: rows whose
   upper bound lies below the k-th best lower bound are ruled out.
3. The second search takes the rows of other labels whose score may lie in the
   window of one of the anchor's positives.
4. What the blocks found, a few rows each, is ranked by windows.

Every row is searched, so the recall is one; the summaries only save work.

Defined results: rows with a null label, vector or component, or one that is
not finite, take no part; a row without id is no anchor, and as a positive or
negative it comes after rows of equal score and has a null id.  Rows are told
apart by themselves, not by id: a repeated row is another row, a repeated
anchor gives its rows again.  Shorter vectors count as padded with zeros.
Components beyond ``LARGEST`` count as ``LARGEST``.  An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import c, materialize

#: rows and anchors that meet in one task
ROWS, ANCHORS = 1024, 4096
#: so that the score of a few thousand components fits a long
LARGEST = 1 << 25
#: each level has so many times the segments of the one before
FINER = 4
#: pairs bounded at once
PAIRS = 1 << 20

NO_ID = (1 << 63) - 1


def levels_of(dims: int) -> list[int]:
    """Numbers of segments, coarsest first; the finest has about four components a segment."""
    out = [1]
    while out[-1] * FINER * 4 <= dims:
        out.append(out[-1] * FINER)
    return out


def summaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, means and deviations of the segments of each row, both times the
    root of the segment's length, so that their plain products bound the score."""
    out = []
    for k in levels_of(x.shape[1]):
        at = np.arange(k) * x.shape[1] // k
        n = np.diff(np.append(at, x.shape[1]))
        mean = np.add.reduceat(x, at, axis=1) / n
        square = np.add.reduceat((x - np.repeat(mean, n, axis=1)) ** 2, at, axis=1)
        out.append((mean * np.sqrt(n), np.sqrt(square)))
    return out


def bounds(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of rows ``a`` with rows ``b``, from one level's summaries."""
    middle, off = a[0] @ b[0].T, a[1] @ b[1].T
    off += 1e-9 * (np.abs(middle) + off) + 1e-6  # rounding
    return middle - off, middle + off


class Block:
    """Rows of one block with their summaries."""

    def __init__(self, pdf: pd.DataFrame):
        self.uid, self.id, self.label = (pdf[x].to_numpy(dtype=np.int64) for x in ("uid", "id", "label"))
        self.x = np.frombuffer(b"".join(pdf["vector"]), dtype=np.int32).reshape(len(pdf), -1).astype(np.int64)
        stored = np.frombuffer(b"".join(pdf["summary"]), dtype=np.float64).reshape(len(pdf), -1)
        self.summary, at = [], 0
        for k in levels_of(self.x.shape[1]):
            self.summary.append((stored[:, at:at + k], stored[:, at + k:at + 2 * k]))
            at += 2 * k

    def level(self, k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.summary[k][0][rows], self.summary[k][1][rows]

    def scores(self, rows: np.ndarray, other: Block, others: np.ndarray) -> np.ndarray:
        a, b = self.x[rows], other.x[others]
        if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1] < 1 << 53:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)  # exact
        return a @ b.T


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then by smaller id."""
    return np.lexsort((ids, -score))[:k]


def search_best(anchors: Block, rows: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its best ``k`` other rows of its label here: (anchor, rows, scores)."""
    for label in np.intersect1d(anchors.label, rows.label):
        own, among = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
        step = max(1, PAIRS // len(among))
        for part in (own[i:i + step] for i in range(0, len(own), step)):
            alive = anchors.uid[part][:, None] != rows.uid[among]
            for level in range(len(rows.summary)):
                low, high = bounds(anchors.level(level, part), rows.level(level, among))
                alive &= high >= _kth_largest(np.where(alive, low, -np.inf), k)[:, None]
            some = alive.any(axis=0)
            score = anchors.scores(part, rows, among[some])
            for a, live, s in zip(part, alive[:, some], score):
                at = np.flatnonzero(live)
                best = at[_first(s[at], rows.id[among[some][at]], k)]
                if len(best):
                    yield a, among[some][best], s[best]


def search_windows(anchors: Block, rows: Block, low: list[np.ndarray], high: list[np.ndarray],
                   k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each of its windows ``low..high`` the best ``k`` rows of other
    labels here whose score lies in it: (anchor, window, rows, scores)."""
    most = max((len(x) for x in low), default=0)
    lo, hi = np.full((len(low), most), np.inf), np.full((len(low), most), -np.inf)
    for a, (x, y) in enumerate(zip(low, high)):
        lo[a, :len(x)], hi[a, :len(y)] = x, y
    step = max(1, PAIRS // max(1, len(rows.uid)))
    every = np.arange(len(rows.uid))
    for part in (np.arange(i, min(i + step, len(low))) for i in range(0, len(low), step)):
        alive = anchors.label[part][:, None] != rows.label
        need = lo[part]
        for level in range(len(rows.summary)):
            least, largest = bounds(anchors.level(level, part), rows.level(level, every))
            left = np.zeros_like(alive)
            for w in range(most):
                a, b = need[:, w, None], hi[part, w, None]
                sure = alive & (least >= a) & (largest <= b)
                need[:, w] = np.maximum(need[:, w], _kth_largest(np.where(sure, least, -np.inf), k))
                left |= (largest >= need[:, w, None]) & (least <= b)
            alive &= left
        some = np.flatnonzero(alive.any(axis=0))
        score = anchors.scores(part, rows, some)
        for a, live, s in zip(part, alive[:, some], score):
            at = np.flatnonzero(live)
            for w, (x, y) in enumerate(zip(low[a], high[a])):
                own = at[(s[at] >= x) & (s[at] <= y)]
                best = own[_first(s[own], rows.id[some[own]], k)]
                if len(best):
                    yield a, w, some[best], s[best]


INDEX = "uid long, id long, label long, anchor boolean, vector binary, summary binary"


def _summarise(dims: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = np.zeros((len(pdf), dims), dtype=np.int32)
            for k, v in enumerate(pdf["vector"]):
                x[k, :len(v)] = v
            parts = [y for pair in summaries(x.astype(np.float64)) for y in pair]
            yield pdf.assign(vector=[v.tobytes() for v in x], summary=[v.tobytes() for v in np.hstack(parts)])
    return run


def build_index(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "vector",
                label_col: str = "label") -> DataFrame:
    """The written index of ``rows`` (integer components): ``(uid, id, label, anchor, vector, summary)``."""
    own = rows.select(F.coalesce(c(id_col).cast("long"), F.lit(NO_ID)).alias("id"), c(label_col).cast("long").alias("label"),
                      F.coalesce(anchors, F.lit(False)).alias("anchor"), c(vector_col).alias("vector"))
    own = own.where("label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    dims = max(1, own.agg(F.max(F.size("vector"))).first()[0] or 0)
    clipped = F.transform("vector", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x)).cast("int"))
    out = own.select(F.monotonically_increasing_id().alias("uid"), "id", "label", "anchor", clipped.alias("vector"),
                     F.lit(b"").alias("summary"))
    return materialize(out.mapInPandas(_summarise(dims), INDEX), "vector_index")


def _cells(index: DataFrame, anchors: DataFrame, anchor_cols: list[str]):
    """Rows and anchors dealt in blocks, each pair of blocks under one key."""
    n, m = index.count(), index.where("anchor").count()
    high, wide = max(1, -(-n // ROWS)), max(1, -(-m // ANCHORS))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    deal = lambda k: F.pmod(F.xxhash64("uid"), F.lit(k)).cast("int")
    return (index.drop("anchor").select(deal(high).alias("block"), every(wide).alias("of"), "*").groupBy("block", "of"),
            anchors.select(every(high).alias("block"), deal(wide).alias("of"), *anchor_cols).groupBy("block", "of"))


BEST = "auid long, uid long, id long, score long"
FOUND = "auid long, anchor_id long, w int, positive_id long, positive_score long, uid long, negative_id long, negative_score long"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")], dtype=object)


def _best(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _frame([], BEST)
        rows, anchors = Block(left), Block(right)
        return _frame([(anchors.uid[a], rows.uid[r], rows.id[r], s) for a, at, score in search_best(anchors, rows, k)
                       for r, s in zip(at, score)], BEST)
    return run


def _windows(k: int, least: int, most: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _frame([], FOUND)
        rows, anchors = Block(left), Block(right)
        # least * positive <= 100 * negative <= most * positive, in whole numbers
        low = [np.array([-(-least * int(s) // 100) for s in x], dtype=np.int64) for x in right["scores"]]
        high = [np.array([most * int(s) // 100 for s in x], dtype=np.int64) for x in right["scores"]]
        ids, scores = right["ids"].tolist(), right["scores"].tolist()
        return _frame([(anchors.uid[a], anchors.id[a], w, ids[a][w], scores[a][w], rows.uid[r], rows.id[r], s)
                       for a, w, at, score in search_windows(anchors, rows, low, high, k) for r, s in zip(at, score)], FOUND)
    return run


def mine(index: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor's positives are its best ``positives`` other rows of the same
    label; for each, the best ``negatives`` rows of other labels whose score is
    ``least`` to ``most`` hundredths of the positive's score come back.
    """
    anchors = index.where("anchor")
    rows, dealt = _cells(index, anchors, ["uid", "id", "label", "vector", "summary"])
    best = rows.cogroup(dealt).applyInPandas(_best(positives), BEST)
    first = Window.partitionBy("auid").orderBy(F.desc("score"), "id", "uid")
    best = (best.withColumn("w", F.row_number().over(first)).where(F.col("w") <= positives)
            .groupBy("auid").agg(F.array_sort(F.collect_list(F.struct("w", "id", "score"))).alias("p"))
            .select(F.col("auid").alias("uid"), F.col("p.id").alias("ids"), F.col("p.score").alias("scores")))
    searched = materialize(anchors.join(best, "uid"), "anchors")
    rows, dealt = _cells(index, searched, ["uid", "id", "label", "vector", "summary", "ids", "scores"])
    found = rows.cogroup(dealt).applyInPandas(_windows(negatives, least, most), FOUND)
    order = Window.partitionBy("auid", "w").orderBy(F.desc("negative_score"), "negative_id", "uid")
    known = lambda x: F.when(F.col(x) != NO_ID, F.col(x)).alias(x)
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"),
                    "positive_score", "negative_score"))


def integer_vectors(rows: DataFrame, vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``rows`` with the column ``vector``: each component times ``scale`` as whole
    number below; null where a component is null or not finite."""
    x = c(vector_col)
    odd = F.exists(x, lambda v: F.coalesce(F.isnan(v) | (F.abs(v.cast("double")) == float("inf")), F.lit(True)))
    top = float(LARGEST)
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), v.cast("double") * scale))))
    return rows.withColumn("vector", F.when(~odd, whole))
