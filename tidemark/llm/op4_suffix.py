"""Removal of repeated byte strings by a hash-compared suffix sort.

Every byte covered by a string of ``SPAN`` bytes that also starts elsewhere,
in any document, is removed.

1. *Runs.* A window is a string of ``SPAN`` bytes.  Its anchor is its
   ``GRAM``-byte substring of least hash (the leftmost of equals), which
   depends on the window's content alone, so equal windows have equal anchor
   hashes at equal offsets.  Neighbouring windows of one anchor form a run;
   a text has a run for some hundred bytes.
2. *Census.* Runs whose anchor hash occurs once cannot repeat.  Runs of the
   others that are equal in whole (anchor hash, and hash of all the bytes
   under the run) form a class: a class of several runs repeats in whole.
3. *Suffix sort.* What is left are anchors with several classes: the ends of
   repeated passages.  The suffixes from the anchors on are sorted by
   mergesort; two of them are compared by their longest common extension,
   found by binary search over prefix polynomial hashes, so a comparison
   takes logarithmic time.  The strings before the anchors are sorted
   likewise, backwards.  The neighbours' common extensions are then verified
   byte by byte.  A window that starts ``o`` bytes before its anchor repeats
   when another class agrees with it on ``o`` bytes backwards and
   ``SPAN - o`` bytes onwards, i.e. falls in the same stretch of both orders.
4. Anchors with more than ``GROUP_BYTES`` of distinct surroundings are not
   put in one task: the hashes of their windows are counted over hash ranges.

Texts are shuffled once, and only those with a repeated run are kept for the
last step.  A batch, a chunk of sorted anchors and a hash range bound what a
task holds; a longer text is read in pieces that overlap.

Defined results: null text is empty; texts shorter than ``SPAN`` bytes lose
nothing; equal rows (repeated ids included) repeat each other in full;
matches never cross texts; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.census import RANGE_HASHES, census, totals
from tidemark.llm.common import PrefixHash, c, materialize, mix, shuffle_width, text_of
from tidemark.session import scratch_path

SPAN, GRAM = 400, 32
#: bytes hashed together; positions within must fit ``_PLACE``
UNIT = 1 << 18
#: texts of a batch, bytes sorted together, bytes of an anchor's classes in one task
BATCH_BYTES, CHUNK_BYTES, GROUP_BYTES = 8 << 20, 2 << 20, 2 << 20
#: runs that one range counts, about; texts of a bucket
RUNS_COUNTED, BUCKET_BYTES = 500_000, 16 << 20
_PLACE = np.uint64(UNIT - 1)


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every window of ``w`` values."""
    n = len(v)
    x = np.concatenate([v, np.full(-n % w, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def runs_of(pieces: list[bytes], span: int = SPAN, gram: int = GRAM) -> list[np.ndarray]:
    """Runs of the windows of pieces of ``UNIT`` bytes in all at most:
    ``[piece, first start, last start, anchor - first start, anchor hash, hash of the run's bytes]``."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    if len(data) < span:
        return [np.empty(0, dtype=np.int64)] * 4 + [np.empty(0, dtype=np.uint64)] * 2
    hashes = PrefixHash(data)
    at = np.arange(len(data) - gram + 1)
    place = at.astype(np.uint64)
    least = _window_min(mix(hashes.of(at, at + gram)) & ~_PLACE | place, span - gram + 1)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    first = np.zeros(len(data) + 1, dtype=bool)
    long = sizes >= span
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - span + 1, -1)
    first[begins[long]] = True
    ok = np.cumsum(inside)[:len(least)] > 0
    change = np.append(True, least[1:] != least[:-1]) | first[:len(least)]
    lo = np.flatnonzero(ok & change)
    piece = np.searchsorted(ends, lo, side="right")
    hi = np.minimum(np.append(lo[1:], len(least)), ends[piece] - span + 1) - 1
    anchor = (least[lo] & _PLACE).astype(np.int64)
    return [piece, lo - begins[piece], hi - begins[piece], anchor - lo, least[lo] & ~_PLACE, hashes.of(lo, hi + span)]


RUNS = ("batch string, uid array<long>, doc_id array<long>, sha array<binary>, n_bytes array<long>, "
        "sizes array<int>, hashes binary, lo binary, hi binary, anchor binary, span binary")


def _units(texts: list[bytes], span: int) -> Iterator[tuple[list[bytes], list[tuple[int, int]]]]:
    """Pieces of texts, ``UNIT`` bytes together at most, with each piece's text and offset.
    Pieces of one text share ``span - 1`` bytes, so every window is in one piece."""
    pieces, places, size = [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - span + 1), UNIT - span + 1):
            p = t[at:at + UNIT]
            if size + len(p) > UNIT:
                yield pieces, places
                pieces, places, size = [], [], 0
            pieces.append(p)
            places.append((k, at))
            size += len(p)
    if pieces:
        yield pieces, places


def _runs(span: int, gram: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            size = np.cumsum(pdf["text"].str.len().to_numpy(dtype=np.int64)) // BATCH_BYTES if len(pdf) else []
            for part in np.unique(size):
                own = pdf[size == part]
                texts = [t.encode() for t in own["text"]]
                found: list[list[np.ndarray]] = []
                for pieces, places in _units(texts, span):
                    got = runs_of(pieces, span, gram)
                    of, at = np.array([p[0] for p in places]), np.array([p[1] for p in places], dtype=np.int64)
                    found.append([of[got[0]], got[1] + at[got[0]], got[2] + at[got[0]], *got[3:]])
                doc, lo, hi, anchor, key, whole = (np.concatenate(x) for x in zip(*found))
                yield pd.DataFrame({
                    "batch": [uuid.uuid4().hex], "uid": [own["uid"].to_numpy()],
                    "doc_id": [[None if pd.isna(x) else int(x) for x in own["doc_id"]]],
                    "sha": [[hashlib.sha256(t).digest() for t in texts]], "n_bytes": [[len(t) for t in texts]],
                    "sizes": [np.bincount(doc.astype(np.int64), minlength=len(texts)).astype(np.int32)],
                    "hashes": [mix(key).tobytes()], "lo": [lo.astype(np.int32).tobytes()], "hi": [hi.astype(np.int32).tobytes()],
                    "anchor": [anchor.astype(np.int16).tobytes()], "span": [whole.tobytes()]})
    return run


SHARED = "key long, span long, uid long, lo int, hi int, anchor short"


def _shared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The runs of a batch whose anchor hash occurs again."""
    out = []
    for row in left.itertuples():
        key, df = totals(row.hashes, right)  # mixed, a bijection: as good a name
        own = df > 1
        col = lambda data, kind: np.frombuffer(data, dtype=kind)[own]
        out.append(pd.DataFrame({
            "key": key.view(np.int64)[own], "span": col(row.span, np.int64), "uid": np.repeat(row.uid, row.sizes)[own],
            "lo": col(row.lo, np.int32), "hi": col(row.hi, np.int32), "anchor": col(row.anchor, np.int16)}))
    return pd.concat(out) if out else pd.DataFrame(columns=[x.split()[0] for x in SHARED.split(", ")], dtype=object)


# ---- the suffix sort of one chunk of anchors ---------------------------------


class Extensions:
    """Longest common extensions from given places, onwards or backwards, by hash."""

    def __init__(self, data: np.ndarray, hashes: PrefixHash, at: np.ndarray, room: np.ndarray, back: bool, most: int):
        self.data, self.hashes, self.at, self.back = data, hashes, at, back
        self.room = np.minimum(room, most)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that the strings from places ``i`` and ``j`` have in common."""
        low, high = np.zeros(len(i), dtype=np.int64), np.minimum(self.room[i], self.room[j])
        a, b = self.at[i], self.at[j]
        while len(low) and (low < high).any():
            mid = (low + high + 1) // 2
            same = (self.hashes.of(a - mid, a) == self.hashes.of(b - mid, b) if self.back
                    else self.hashes.of(a, a + mid) == self.hashes.of(b, b + mid))
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def _next(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The byte after ``n`` common ones; -1 at the end."""
        place = self.at[i] - 1 - n if self.back else self.at[i] + n
        inside = n < self.room[i]
        return np.where(inside, self.data[np.where(inside, place, 0)].astype(np.int64), -1)

    def before(self, i: np.ndarray, j: np.ndarray, ties: bool) -> np.ndarray:
        n = self.common(i, j)
        x, y = self._next(i, n), self._next(j, n)
        return (x < y) | ((x == y) & ties)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Mergesort of the places by group (non-decreasing), then by string.
        All merges of one level are made together: an element's place in the
        merged list is its own rank plus its rank in the other list."""
        n = len(group)
        order = np.arange(n)
        begin = np.searchsorted(group, group, side="left")
        end = np.searchsorted(group, group, side="right")
        largest = int((end - begin).max(initial=0))
        width = 1
        while width < largest:
            slot = np.arange(n) - begin
            block = slot // width
            odd = block % 2 == 1
            start = begin + (block ^ 1) * width  # the list to merge with
            stop = np.minimum(start + width, end)
            low, high = np.minimum(start, end), np.maximum(stop, np.minimum(start, end))
            base = low.copy()
            todo = np.flatnonzero(low < high)
            while len(todo):
                mid = (low[todo] + high[todo]) // 2
                # of equals, those of the even list come first
                goes = self.before(order[mid], order[todo], odd[todo])
                low[todo] = np.where(goes, mid + 1, low[todo])
                high[todo] = np.where(goes, high[todo], mid)
                todo = todo[low[todo] < high[todo]]
            first = begin + (block - odd) * width
            place = first + (slot - block * width) + (low - base)
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, 2 * width
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common extension of each place with the one before it in ``order``
        (-1 at a group's first), verified byte by byte."""
        out = np.full(len(order), -1, dtype=np.int64)
        k = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1
        i, j = order[k - 1], order[k]
        n = self.common(i, j)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        sign, off = (-1, -1) if self.back else (1, 0)
        x = self.data[np.repeat(self.at[i] + off, n) + sign * step]
        y = self.data[np.repeat(self.at[j] + off, n) + sign * step]
        if (x != y).any():
            raise Collision
        out[k] = n
        return out


class Collision(Exception):
    """Two different strings had equal hashes."""


def repeated_windows(key: np.ndarray, contexts: list[bytes], anchor: np.ndarray, span: int = SPAN,
                     base: int | None = None) -> np.ndarray:
    """Which windows of each context occur in another context of the same key.

    ``key`` is non-decreasing.  Row k of the result tells for each offset
    ``o`` whether the window that starts ``o`` bytes before the anchor of
    context k is repeated.  On a hash collision another hash base is tried.
    """
    size = np.array([len(x) for x in contexts], dtype=np.int64)
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    begin = np.cumsum(size) - size
    at = begin + anchor
    hashes = PrefixHash(data, base) if base else PrefixHash(data)
    try:
        fore = Extensions(data, hashes, at, size - anchor, False, span)
        back = Extensions(data, hashes, at, anchor, True, span)
        orders = [(e, o, e.neighbours(o, key)) for e, o in ((e, e.sort(key)) for e in (fore, back))]
    except Collision:
        return repeated_windows(key, contexts, anchor, span, hash((base or 1, len(data))) | 1)
    n = len(key)
    last = size - span  # the last start in the context
    out = np.zeros((n, int(anchor.max(initial=-1)) + 1), dtype=bool)
    stretch = [np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)]
    for o in range(out.shape[1]):
        live = (o <= anchor) & (anchor - o <= last)
        if live.sum() < 2:
            continue
        for (_, order, common), need, s in zip(orders, (span - o, o), stretch):
            s[order] = np.cumsum(common < need)
        k = np.flatnonzero(live)
        code = stretch[0][k] * (n + 1) + stretch[1][k]
        _, where, count = np.unique(code, return_inverse=True, return_counts=True)
        out[k, o] = count[where] > 1
    return out


EDGE = "key long, n long, uid long, lo int, anchor short, context binary"
STARTS = "uid long, lo int, hi int"


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _sorted_anchors(span: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            anchor = pdf["anchor"].to_numpy(dtype=np.int64)
            flags = repeated_windows(pdf["key"].to_numpy(), pdf["context"].tolist(), anchor, span)
            rows = []
            for row, f, n, uid, lo, a in zip(range(len(pdf)), flags, pdf["n"], pdf["uid"], pdf["lo"], anchor):
                if n == 1 and f.any():  # f[o] is of the start at anchor - o
                    rows += [(uid, lo + a - y, lo + a - x) for x, y in _stretches(f)]
            return pd.DataFrame(rows, columns=["uid", "lo", "hi"], dtype=object)
        for pdf in frames:
            held.append(pdf)
            if sum(x["context"].str.len().sum() for x in held) < CHUNK_BYTES:
                continue
            own = pd.concat(held)
            done = (own["key"] != own["key"].iloc[-1]).to_numpy()  # the last key may go on
            held = [own[~done]]
            for part in _chunks(own[done]):
                yield solve(part)
        if held:
            for part in _chunks(pd.concat(held)):
                yield solve(part)
    return run


def _chunks(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Whole keys, ``CHUNK_BYTES`` together or a single key."""
    if not len(pdf):
        return
    size = np.cumsum(pdf["context"].str.len().to_numpy())
    key = pdf["key"].to_numpy()
    first = np.searchsorted(key, key, side="left")
    part = size[first] // CHUNK_BYTES
    for p in np.unique(part):
        yield pdf[part == p]


def _surroundings(span: int, big: bool):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [x.split()[0] for x in EDGE.split(", ")]
        for pdf in frames:
            rows, size = [], 0
            for uid, text, *edges in zip(*(pdf[x] for x in ("uid", "text", "key", "n", "first", "last", "anchor", "big"))):
                data = text.encode()
                for key, n, lo, hi, anchor, large in zip(*edges):
                    if large == big:
                        rows.append((key, n, uid, lo, anchor, data[lo:hi + span]))
                        size += len(rows[-1][-1])
                if size > CHUNK_BYTES:
                    yield pd.DataFrame(rows, columns=cols, dtype=object)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=cols, dtype=object)
    return run


WINDOWS = "batch string, uid array<long>, lo array<int>, n array<long>, sizes array<int>, hashes binary"


def _window_hashes(span: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for k in range(0, len(pdf), 4000):
                own = pdf.iloc[k:k + 4000]
                size = own["context"].str.len().to_numpy()
                hashes = PrefixHash(np.frombuffer(b"".join(own["context"]), dtype=np.uint8))
                begin, many = np.cumsum(size) - size, size - span + 1
                at = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield pd.DataFrame({"batch": [uuid.uuid4().hex], "uid": [own["uid"].to_numpy()], "lo": [own["lo"].to_numpy()],
                                    "n": [own["n"].to_numpy()], "sizes": [many.astype(np.int32)],
                                    "hashes": [mix(hashes.of(at, at + span)).tobytes()]})
    return run


def _counted_windows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for row in left.itertuples():
        _, df = totals(row.hashes, right)
        for uid, lo, n, flags in zip(row.uid, row.lo, row.n, np.split(df > 1, np.cumsum(row.sizes)[:-1])):
            if n == 1:
                rows += [(uid, lo + x, lo + y) for x, y in _stretches(flags)]
    return pd.DataFrame(rows, columns=["uid", "lo", "hi"], dtype=object)


KEPT = "uid long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(span: int, with_bytes: bool):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [x.split()[0] for x in KEPT.split(", ")]
        for pdf in frames:
            rows = []
            for uid, text, *starts in zip(*(pdf[x] for x in ("uid", "text", "lo", "hi", "end_lo", "end_hi"))):
                lo, hi = (np.concatenate([y for y in x if y is not None]) for x in (starts[::2], starts[1::2]))
                data, spans = text.encode(), []
                for k in np.lexsort((hi, lo)).tolist():
                    a, b = int(lo[k]), int(hi[k]) + span
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                keep = hashlib.sha256()
                parts, at = [], 0
                for a, b in [*spans, (len(data), len(data))]:
                    keep.update(data[at:a])
                    if with_bytes:
                        parts.append(data[at:a])
                    at = b
                rows.append((uid, sum(b - a for a, b in spans), len(spans), keep.hexdigest(),
                             b"".join(parts) if with_bytes else None))
            yield pd.DataFrame(rows, columns=cols, dtype=object)
    return run


def _once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows with the same uid, which come one after another, the first."""
    last = None
    for batch in batches:
        uid = batch.column("uid").to_numpy()
        if len(uid):
            yield batch.filter(pa.array(np.append(uid[0] != last, uid[1:] != uid[:-1])))
            last = uid[-1]


#: a text concerned: its runs that repeat in whole, and its edges' columns
TEXTS = ("uid long, text string, lo array<int>, hi array<int>, key array<long>, n array<long>, "
         "first array<int>, last array<int>, anchor array<short>, big array<boolean>")


def _columns(array: str, **fields: str) -> list:
    """Fields of an array of structs as arrays of their own, which reach Python as numpy arrays."""
    return [F.col(f"{array}.{f}").alias(name) for name, f in fields.items()]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                   gram: int = GRAM, with_bytes: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` of every row.

    ``with_bytes`` adds the remaining bytes of the documents that lost some
    (null elsewhere).
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    src = docs.select(c(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    runs = materialize(src.withColumn("uid", F.monotonically_increasing_id()).mapInPandas(_runs(span, gram), RUNS), "runs")
    members = runs.select(F.explode(F.arrays_zip("uid", "doc_id", "sha", "n_bytes")).alias("m")).select("m.*")
    total = lambda x: F.coalesce(F.sum(F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)), F.lit(0))
    n_runs, n_bytes = runs.select(total("sizes"), total("n_bytes")).first()
    # as many tasks as the texts ask for, whatever the number of shuffle partitions
    width = min(width, -(-n_bytes // BUCKET_BYTES) or 1)
    counted = census(runs, -(-n_runs // RUNS_COUNTED) or 1)
    shared = materialize(
        runs.select("batch", "uid", "sizes", "hashes", "lo", "hi", "anchor", "span").groupBy("batch")
        .cogroup(counted.groupBy("batch")).applyInPandas(_shared, SHARED).coalesce(width), "shared_runs")

    # classes of equal runs; anchors whose classes differ
    classes = materialize(
        shared.groupBy("key", "span").agg(F.count(F.lit(1)).alias("n"),
                                          F.min(F.struct("uid", "lo", "hi", "anchor")).alias("rep")).coalesce(width), "run_classes")
    several = materialize(
        classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"),
                                   F.sum(F.col("rep.hi") - F.col("rep.lo") + span).alias("bytes"))
        .where("classes > 1 AND least = 1").select("key", (F.col("bytes") > group_bytes).alias("big")).coalesce(width), "anchors")
    edges = classes.join(several, "key").select(
        "rep.uid", F.struct("key", "n", "rep.lo", "rep.hi", "rep.anchor", "big").alias("edge"))
    whole = (shared.join(classes.where("n > 1").select("key", "span"), ["key", "span"])
             .select("uid", F.struct("lo", "hi").alias("run")))
    per_text = (edges.select("uid", "edge", F.lit(None).cast("struct<lo:int,hi:int>").alias("run"))
                .unionByName(whole.select("uid", F.lit(None).cast(edges.schema["edge"].dataType).alias("edge"), "run"))
                .groupBy("uid").agg(F.collect_list("run").alias("whole"), F.collect_list("edge").alias("edges")))

    # the texts concerned, kept in buckets of the uid for the two steps that read them
    one = members.groupBy("doc_id", "sha").agg(F.min("uid").alias("uid"))
    wanted = one.join(per_text, "uid").withColumnRenamed("doc_id", "_id").withColumnRenamed("sha", "_sha")
    texts = src.withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    joined = (texts.join(wanted, (F.col("sha") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id")))
              .select("uid", "text", *_columns("whole", lo="lo", hi="hi"),
                      *_columns("edges", key="key", n="n", first="lo", last="hi", anchor="anchor", big="big"))
              .coalesce(width).mapInArrow(_once, TEXTS))
    name = f"repeat_texts_{uuid.uuid4().hex[:12]}"
    (joined.write.format("parquet").bucketBy(width, "uid").option("path", scratch_path(spark, name)).saveAsTable(name))
    kept_texts = spark.table(name)

    around = kept_texts.where(F.size("key") > 0).drop("lo", "hi")
    ends = (around.mapInPandas(_surroundings(span, False), EDGE).repartition(width, "key").sortWithinPartitions("key")
            .mapInPandas(_sorted_anchors(span), STARTS))
    if not several.where("big").isEmpty():
        windows = materialize(around.mapInPandas(_surroundings(span, True), EDGE).mapInPandas(_window_hashes(span), WINDOWS), "windows")
        n = windows.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
        replies = census(windows, -(-n // RANGE_HASHES) or 1, exact=True)
        ends = ends.unionByName(windows.groupBy("batch").cogroup(replies.groupBy("batch"))
                                .applyInPandas(_counted_windows, STARTS))
    ends = (ends.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("ends"))
            .select("uid", *_columns("ends", end_lo="lo", end_hi="hi")))
    cut = (kept_texts.select("uid", "text", "lo", "hi").join(ends, "uid", "left")
           .select("uid", "text", "lo", "hi", "end_lo", "end_hi").mapInPandas(_cut(span, with_bytes), KEPT))
    cut = cut.where("n_removed > 0").withColumnRenamed("uid", "_uid")

    own = one.join(cut, F.col("uid") == F.col("_uid")).select(
        F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"), "n_removed", "n_spans", "kept_sha256", "kept")
    out = members.join(own, (F.col("sha") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    cols = ["doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256")]
    return out.select(*cols, *(["kept"] if with_bytes else []))
