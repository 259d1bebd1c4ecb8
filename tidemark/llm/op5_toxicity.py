"""Toxic spans by a linear-chain conditional random field.

*Token labels.*  The labels are per document, so the training tokens' labels
come from them: in a toxic document a word is toxic when it, or its first
letters, occur far more often in toxic than in clean training documents (by
document, ``RATIO`` times after smoothing, in at least ``SUPPORT`` toxic
ones); everything else is not.

*Model.*  Two tags in a chain along each line.  A word's features are its
form, first and last letters (hashed), and weight the toxic tag; a two-by-two
table weights neighbouring tags.  It is trained by Adagrad on the exact
gradient of the log-likelihood, from at most ``SAMPLE`` labelled documents of
either class (by smallest hash of the id): the documented bound of what the
driver sees.

*Scores.*  Forward-backward gives each token's marginal probability of the
toxic tag, in whole documents.  A document's score comes from its largest
marginals through a logistic fit on the same training documents; spans are
the runs of tokens of a marginal of at least 0.5.

Defined results: null or empty text, and text without words, scores as a
document without a toxic token; without a toxic and a clean training row the
score is the smoothed base rate; a null id counts as the empty text for the
fold; rows of the labels that name no document, or a null label, are ignored;
repeated rows are scored one by one; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import c, keep_rows, pieces_of, shingle_sets, text_of

#: training documents of either class at most
SAMPLE = 1000
RATIO, SUPPORT, SHARE = 8.0, 2, 0.005
BITS, EPOCHS, RATE, SHRINK = 18, 10, 0.5, 1e-6
#: marginals that a document's score looks at
TOP = 5
#: tokens that are put through forward-backward together; words a worker remembers
CHUNK, CACHE = 200_000, 150_000
THRESHOLD = 0.7
_LINE = re.compile(r"[^\n]+")
_WORD = re.compile(r"[^\W_]+")


def held_out(id_col: Column) -> Column:
    """Rows whose label is never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def features(word: str) -> list[int]:
    w = word.lower()
    names = ("w" + w, "4" + w[:4], "5" + w[:5], "b")
    return [zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names]


@dataclass
class Model:
    """Emission weights of the toxic tag, tag-pair weights and the score's fit."""

    weights: np.ndarray
    pairs: np.ndarray  # [from, to], log scale
    fit: np.ndarray
    base: float
    cache: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        cache, weights = self.cache, self.weights
        for w in set(words).difference(cache):
            cache[w] = float(weights[features(w)].sum())
        out = np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words))
        if len(cache) > CACHE:
            cache.clear()
        return out

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's token marginals, in order."""
        words, sizes, owner = [], [], []
        for k, t in enumerate(texts):
            for line in _LINE.findall(t):
                found = _WORD.findall(line)
                if found:
                    words += found
                    sizes.append(len(found))
                    owner.append(k)
        if not words:
            return [np.empty(0) for _ in texts]
        p = chain_marginals(self.emissions(words), np.array(sizes), self.pairs)[0]
        tokens = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(int)
        return np.split(p, np.cumsum(tokens)[:-1])

    def score(self, p: np.ndarray) -> float:
        if self.fit is None:
            return self.base
        return float(1 / (1 + np.exp(-(summary(p) @ self.fit))))


def summary(p: np.ndarray) -> np.ndarray:
    """What the score sees of a document's marginals: the largest one and the mass of the top."""
    top = np.sort(p)[::-1][:TOP] if len(p) else np.zeros(1)
    first = min(max(top[0], 1e-6), 1 - 1e-6)
    return np.array([1.0, np.log(first / (1 - first)) / 4, top.sum()])


def chain_marginals(emit: np.ndarray, sizes: np.ndarray, pairs: np.ndarray,
                    want_pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once.

    ``emit`` holds the toxic tag's weight of all tokens, chain by chain.
    Returns the marginals of the toxic tag and the expected number of each
    pair of tags.  Chains of like length are worked side by side.
    """
    out = np.empty(len(emit))
    expected = np.zeros((2, 2))
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    order = np.argsort(-sizes, kind="stable")
    m = np.exp(pairs)
    at = 0
    while at < len(order):
        longest = int(sizes[order[at]])
        rows = order[at:at + max(1, CHUNK // longest)]
        at += len(rows)
        n, start = sizes[rows], begin[rows]
        live = np.searchsorted(-n, -np.arange(1, longest + 1), side="right")  # chains that reach step t
        e = np.zeros((longest, len(rows), 2))
        for t in range(longest):
            e[t, :live[t], 1] = emit[start[:live[t]] + t]
        e = np.exp(np.clip(e, -30, 30))
        fwd, bwd = np.ones_like(e), np.ones_like(e)
        a = e[0] / e[0].sum(1, keepdims=True)
        fwd[0] = a
        for t in range(1, longest):
            k = live[t]
            a = (a[:k] @ m) * e[t, :k]
            a /= a.sum(1, keepdims=True)
            fwd[t, :k] = a
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            b = (bwd[t + 1, :k] * e[t + 1, :k]) @ m.T
            bwd[t, :k] = b / b.sum(1, keepdims=True)
            if want_pairs:
                joint = fwd[t, :k, :, None] * m * (bwd[t + 1, :k] * e[t + 1, :k])[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        both = fwd * bwd
        p = both[..., 1] / both.sum(2)
        for t in range(longest):
            out[start[:live[t]] + t] = p[t, :live[t]]
    return out, expected


def _token_labels(docs: list[list[list[str]]], toxic: list[bool]) -> list[list[np.ndarray]]:
    """Toxic words of toxic documents, by how much more often they occur there."""
    total = Counter(toxic)
    seen = {True: Counter(), False: Counter()}
    for doc, y in zip(docs, toxic):
        seen[y].update({x for line in doc for w in line for x in (w, "^" + w[:4])})

    def much(x: str) -> bool:
        a, b = seen[True][x], seen[False][x]
        return a >= max(SUPPORT, SHARE * total[True]) and a / total[True] >= RATIO * (b + 1.5) / (total[False] + 1)
    picked = {w for w in seen[True] if not w.startswith("^") and (much(w) or len(w) >= 4 and much("^" + w[:4]))}
    return [[np.array([y and w in picked for w in line], dtype=float) for line in doc] for doc, y in zip(docs, toxic)]


def _near(a: np.ndarray, b: np.ndarray) -> bool:
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 4 * shared >= 3 * (len(a) + len(b) - shared)


def _first_of_copies(texts: list[str], toxic: list[bool]) -> list[int]:
    """One text of each group of near copies with the same label (shingle sets
    of Jaccard similarity 0.75 or more to one kept before): else a copied
    document's words would all look like signs of its label.  Texts that only
    share a passage all stay.

    The sample is bounded, and so is this.  Of two near copies, the rarest
    quarter of either's shingles (and one more) holds a shared one, so only
    texts that meet there are compared.
    """
    sets = shingle_sets([t.encode() for t in texts])
    every, count = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64),) * 2
    met: dict[tuple[bool, int], list[int]] = {}
    out = []
    for k, (s, y) in enumerate(zip(sets, toxic)):
        n = len(s)
        rarest = s[np.lexsort((s, count[np.searchsorted(every, s)]))][:n - -(-3 * n // 4) + 1].tolist()
        near = {j for x in rarest for j in met.get((y, x), ())}
        if any(_near(s, sets[j]) for j in near):
            continue
        out.append(k)
        for x in rarest:
            met.setdefault((y, x), []).append(k)
    return out


def train(rows: list[tuple[str, int]]) -> Model:
    """Fit the field and the score on (text, label) rows; the order of rows does not matter."""
    rows = sorted(((t or "", bool(y)) for t, y in rows), key=lambda r: (r[1], zlib.crc32(r[0].encode()), r[0]))
    toxic = [y for _, y in rows]
    base = (sum(toxic) + 1) / (len(rows) + 10)
    first = _first_of_copies([t for t, _ in rows], toxic)
    rows, toxic = [rows[k] for k in first], [toxic[k] for k in first]
    model = Model(np.zeros(1 << BITS), np.zeros((2, 2)), None, base)
    if len(set(toxic)) < 2:
        return model
    docs = [[[w.lower() for w in _WORD.findall(line)] for line in _LINE.findall(t)] for t, _ in rows]
    docs = [[line for line in doc if line] for doc in docs]
    labels = _token_labels(docs, toxic)
    lines = [line for doc in docs for line in doc]
    gold = [y for doc in labels for y in doc]
    ids: dict[str, int] = {}
    which = [np.array([ids.setdefault(w, len(ids)) for w in line]) for line in lines]
    feats = np.array([features(w) for w in ids]).reshape(len(ids), -1)
    weights, pairs = model.weights, model.pairs
    seen_w, seen_p = np.full(len(weights), 1e-6), np.full((2, 2), 1e-6)
    order = np.random.default_rng(0).permutation(len(lines))
    parts = np.array_split(order, max(1, min(len(order), sum(map(len, lines)) // 20_000)))
    for _ in range(EPOCHS):
        for part in parts:
            words = np.concatenate([which[k] for k in part])
            y = np.concatenate([gold[k] for k in part])
            sizes = np.array([len(which[k]) for k in part])
            p, expected = chain_marginals(weights[feats[words]].sum(1), sizes, pairs, True)
            per_word = np.bincount(words, weights=y - p, minlength=len(ids))
            used = np.flatnonzero(np.bincount(words, minlength=len(ids)))
            grad = np.bincount(feats[used].ravel(), weights=np.repeat(per_word[used], feats.shape[1]), minlength=len(weights))
            grad -= SHRINK * len(y) * weights
            last = np.cumsum(sizes) - 1
            inner = np.ones(len(y), dtype=bool)
            inner[last] = False
            a, b = y[:-1][inner[:-1]].astype(int), y[1:][inner[:-1]].astype(int)
            real = np.bincount(2 * a + b, minlength=4).reshape(2, 2)
            seen_w += grad ** 2
            seen_p += (real - expected) ** 2
            weights += RATE * grad / np.sqrt(seen_w)
            pairs += RATE * (real - expected) / np.sqrt(seen_p)
    x = np.array([summary(p) for p in model.marginals([t for t, _ in rows])])
    y = np.array(toxic, dtype=float)
    model.fit = _logistic(x, y)
    model.cache = {}
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a little shrinkage; the classes weigh as they occur."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled documents of either class, none of them held out."""
    known = (labels.where(~held_out(c(label_id))).where(c(label_id).isNotNull() & c(label_col).isin(0, 1))
             .groupBy(c(label_id).cast("long").alias("_id")).agg(F.max(c(label_col)).alias("_y")))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    src = docs.select(c(id_col).cast("long").alias("_doc"), text_of(text_col).alias("_text"))
    rows = (src.join(F.broadcast(picked), src["_doc"] == F.col("_id"))  # 2 * sample rows at most
            .groupBy("_doc").agg(F.max("_text").alias("_text"), F.max("_y").alias("_y")))
    return train([(r["_text"], r["_y"]) for r in rows.toLocalIterator()])


SCORED = "doc_id long, score double, spans array<struct<start:int,end:int,marginal:double>>"


def _spans(text: str, p: np.ndarray, least: float) -> list[dict]:
    """Runs of neighbouring tokens in a line with a marginal of at least ``least``."""
    if not len(p) or p.max() < least:
        return []
    out, k = [], 0
    for line in _LINE.finditer(text):
        last = -2
        for n, m in enumerate(_WORD.finditer(text, line.start(), line.end())):
            if p[k] >= least:
                if last == n - 1:
                    out[-1]["end"], out[-1]["marginal"] = m.end(), max(out[-1]["marginal"], float(p[k]))
                else:
                    out.append({"start": m.start(), "end": m.end(), "marginal": float(p[k])})
                last = n
            k += 1
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          least: float = 0.5) -> DataFrame:
    """``SCORED`` rows: the score and the toxic spans (code points) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in pieces_of(batches, "text", 4 << 20):
            texts = pdf["text"].tolist()
            ps = model.marginals(texts)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "score": [model.score(p) for p in ps],
                                "spans": [_spans(t, p, least) for t, p in zip(texts, ps)]})
    return (docs.select(c(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .mapInPandas(run, SCORED))


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns as
    they are; decided row by row in the scan, so nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: list[str]) -> list[bool]:
        return [shared.value.score(p) < threshold for p in shared.value.marginals(texts)]
    return keep_rows(docs, text_col, judge)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted, spans)`` of every document, trained on ``labels``."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
