"""A Bloom filter of a few texts, for tables in which most rows have none of them.

The filter is a table of 64-bit words. A key has one word and four bits in it;
every task ors the bits of its keys word by word before anything is shuffled.
It has ``WORDS`` words at most, some 20 MB as a broadcast, however many keys
there are; with more keys more rows are possible hits, none is ever missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.pin import settle

WORDS = 1 << 20

#: Bits of a key in its word.
BITS = 4


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """Up to ``BITS`` bits, six places of a hash each."""
    bits = F.xxhash64(F.lit(2), key)
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_filter(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``bloom_word, bloom_bits``: the filter of the column ``key``, settled and marked for broadcast."""
    found = keys.select(_word(F.col(key), words).alias("bloom_word"), _mask(F.col(key)).alias("mask"))
    return F.broadcast(settle(found.groupBy("bloom_word").agg(F.bit_or("mask").alias("bloom_bits"))))


def possible(df: DataFrame, key: Column, found: DataFrame, words: int = WORDS) -> DataFrame:
    """``df`` with ``bloom_hit``: false for rows whose key isn't among those of ``bloom_filter``, true for few others."""
    keyed = df.withColumns({"bloom_word": _word(key, words), "bloom_mask": _mask(key)})
    met = keyed.join(found, "bloom_word", "left")
    hit = F.coalesce(F.col("bloom_bits").bitwiseAND(F.col("bloom_mask")) == F.col("bloom_mask"), F.lit(False))
    return met.select(*[met[c] for c in df.columns], hit.alias("bloom_hit"))
