"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that can end
its BPE encoding.  ``last[i]`` stores it for the prefix of ``i`` bytes: among
the tokens that end at ``i``, the one whose predecessor ``last[i - len]`` may
stand before it, i.e. no merge would cross the border of the two.  Reading
``last`` backwards gives the encoding.  The table only grows with appended
bytes, so an append is exact, and an edit leaves the table before it valid.

Every match of the split pattern is encoded by itself, as byte-level
tokenizers do.  A piece that is a token is that token; the table is kept per
distinct piece in a bounded cache of each worker.

Defined results: null text is empty text, with no tokens; ids decode to the
text's UTF-8 bytes exactly; repeated rows are encoded one by one; a very
long piece takes time in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import c, pieces_of, text_of

#: distinct pieces and token pairs that a worker remembers
CACHE, PAIRS = 500_000, 400_000
#: longer pieces are not remembered
CACHED_CHARS = 64


class PrefixEncoder:
    """BPE over the ranks of a vocabulary: ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.split: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.occur = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.occur.add_word(t.decode("latin-1"), i)
        self.occur.make_automaton()

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte."""
        if token not in self.split:
            ids = self._merge(self.tokens[token], self.ranks[self.tokens[token]])
            self.split[token] = (ids[0], ids[1]) if len(ids) == 2 else None
        return self.split[token]

    def _merge(self, data: bytes, below: int | None = None) -> list[int]:
        """Plain BPE by repeated best merge; with ``below``, merges of lower rank only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60 or below is not None and rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _fits(self, a: int, b: int) -> bool:
        """Whether BPE of the two tokens' bytes gives back the same two tokens."""
        # Undo merges from the last one back.  A merge across the border that
        # would have come before the one just undone rules the pair out; of
        # equal merges the leftmost comes first.
        limit, tokens, ranks = 1 << 60, self.tokens, self.ranks
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < limit:
                return False
            left, right = self._parts(a), self._parts(b)
            if left and (not right or a > b):
                limit, a = a, left[1]
            elif right:
                limit, b = b + 1, right[0]
            else:
                return True

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill the table on to the end of ``data``; ``last`` may hold it for a prefix.

        ``last[0]`` is -1; ``last[i]`` is the last token of the encoding of
        ``data[:i]``.  After an edit at byte ``p``, pass ``last[:p + 1]``.
        """
        if not last:
            last.append(-1)
        done, begin = len(last), max(0, len(last) - self.longest)
        pairs, fits, size = self.pairs, self._fits, self.size
        # every token that occurs, by the byte it ends at, the longest first
        for end, t in self.occur.iter(data[begin:].decode("latin-1")):
            end += begin + 1
            if end < done:
                continue
            start = end - size[t]
            if start < begin:
                continue
            if start:
                key = last[start] << 32 | t
                ok = pairs.get(key)
                if ok is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    ok = pairs[key] = fits(last[start], t)
                if not ok:
                    continue
            last.append(t)
            done = end + 1
        if len(last) != len(data) + 1:
            raise ValueError("the vocabulary lacks a byte of the text")
        return last

    def ids(self, last: list[int]) -> list[int]:
        """The encoding that a filled table stands for."""
        out, at = [], len(last) - 1
        while at > 0:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.ids(self.extend(data, []))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Tokenizer:
    """A split pattern before a ``PrefixEncoder``, with a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = PrefixEncoder(ranks)
        self.find = regex.compile(pattern).findall
        plain = _latin1(pattern)
        self.plain = self.find if r"\p" in plain else re.compile(plain).findall
        self.cache: dict[str, bytes] = {}  # ids packed as uint32

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.plain(text)

    def encode(self, text: str) -> list[int]:
        pieces, cache = self.split(text), self.cache
        long = []
        for p in set(pieces).difference(cache):
            cache[p] = np.array(self.bpe.encode(p.encode()), dtype=np.uint32).tobytes()
            if len(p) > CACHED_CHARS:
                long.append(p)
        ids = np.frombuffer(b"".join(map(cache.__getitem__, pieces)), dtype=np.uint32).tolist()
        for p in long:
            del cache[p]
        if len(cache) > CACHE:
            cache.clear()
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return self.bpe.decode(ids)


def _latin1(pattern: str) -> str:
    """The pattern with its classes spelled out for texts of Latin-1 characters,
    which the standard library then splits in half the time."""
    letter, number = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
    space = r"\t-\r \x85\xa0"
    inside = (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
              .replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]"))
    return inside.replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file (base64 token, rank), once per worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    return Tokenizer(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` of every row; the vocabulary file lies on every machine."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = load(path, pattern)
        for pdf in pieces_of(batches, "text", 2 << 20):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [tok.encode(t) for t in pdf["text"]]})
    return (docs.select(c(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .mapInPandas(run, "doc_id long, ids array<int>"))


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, data binary)`` from ``(doc_id, ids)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = load(path, pattern)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "data": [tok.decode([] if x is None else x) for x in pdf["ids"]]})
    return tokens.mapInPandas(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode every row in one pass, keeping digests of both.

    Returns ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = load(path, pattern)
        for pdf in pieces_of(batches, "text", 2 << 20):
            n, ids_hash, text_hash = [], [], []
            for t in pdf["text"]:
                ids = tok.encode(t)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(tok.decode(ids)).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": ids_hash,
                                "decoded_sha256": text_hash})
    return (docs.select(c(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
            .mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
