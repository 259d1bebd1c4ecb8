"""Bloom filters over the keys of a table, built and asked by column expressions.

A filter is an array of 64-bit words.  A key's hash names one word and a second
one up to four bits in it, so a key costs one row of one aggregation and a probe
costs one array access.  The number of words is a parameter with a ceiling: the
filter is what every task holds, so ``MAX_WORDS`` (8 MB) is the proven bound of
what is sent to the tasks, whatever the number of keys.  A filter that is too
small for its keys says "maybe" more often; it never says "no" for a key that
it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a word that a key sets (some may coincide)
BITS = 4
#: bits of the filter for each expected key
PER_KEY = 16
MAX_WORDS = 1 << 20


def words_for(keys: int) -> int:
    """Words of a filter for about ``keys`` distinct keys, at most ``MAX_WORDS``."""
    return max(1, min(MAX_WORDS, -(-keys * PER_KEY // 64)))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit(1), key)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def build(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row, ``filter array<long>``, of ``words`` words; null keys are left out.

    Tasks OR their keys' bits by word before the shuffle, so a task sends at
    most one row a word, however many keys it reads and however hot they are.
    """
    if not 1 <= words <= MAX_WORDS:
        raise ValueError(f"a filter has 1 to {MAX_WORDS} words, not {words}")
    own = (keys.select(F.col(key).alias("k")).where("k IS NOT NULL")
           .select(_word(F.col("k"), words).alias("w"), _mask(F.col("k")).alias("bits")))
    # every word has a row, so a word's place in the array is its number
    blank = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("bits"))
    dense = own.unionByName(blank).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("filter"))


def maybe(filter_: Column, key: Column, words: int) -> Column:
    """Whether the filter may hold the key: false only for keys it does not
    hold; null for a null key."""
    mask = _mask(key)
    return F.when(key.isNotNull(), F.get(filter_, _word(key, words)).bitwiseAND(mask) == mask)
