"""Rows that cannot meet a key are left out before the shuffle: a Bloom filter of fixed size, then the exact join.

The filter is a table of 64-bit words made by ordinary aggregation, so tasks combine their parts before they are shuffled, and
it has at most ``bits / 64`` rows whatever it is made from.  It pays where few keys are kept of many: the keys are read
once more, and facts of keys that are gone never reach the exchange.  It never loses a row that has its key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

#: Rows of the largest exact set that is sent to all tasks: two longs each.
MOST_WORDS = 1 << 20
#: 2^26 bits are at most 1,048,576 rows of two longs: the largest filter that is sent to all tasks.
MOST_BITS = 1 << 26
HASHES = 2


def bits_for(keys: int, false_share: float = 0.05, hashes: int = HASHES) -> int | None:
    """The bits, a power of two, that let at most this share of other keys pass; None if that is over MOST_BITS."""
    needed = -hashes * max(keys, 1) / math.log(1 - false_share ** (1 / hashes))
    bits = max(64, 1 << math.ceil(math.log2(needed)))
    return bits if bits <= MOST_BITS else None


def _place(key: str, number: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(number)), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int, hashes: int = HASHES) -> DataFrame:
    """Columns _word, _bits: the words of the filter that are not zero.  Null keys leave no trace."""
    if bits % 64 or not 0 < bits <= MOST_BITS:
        raise ValueError(f"bits must be a multiple of 64 up to {MOST_BITS}: {bits}")
    places = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*(_place(key, i, bits) for i in range(hashes)))).alias("_at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_at") % 64).cast("int"))
    return places.groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))


def maybe_among(df: DataFrame, key: str, keys: DataFrame, bits: int, hashes: int = HASHES) -> DataFrame:
    """The rows whose key may be among ``keys``: all that are, and few others.  An exact join must follow."""
    words = F.broadcast(key_filter(keys, key, bits, hashes))
    for number in range(hashes):
        place = _place(key, number, bits)
        is_set = F.getbit(F.col("_bits"), (place % 64).cast("int")) == 1
        df = df.join(words, (F.shiftright(place, 6) == F.col("_word")) & is_set, "left_semi")
    return df


# Exact sets -------------------------------------------------------------------

def key_words(keys: DataFrame, key: str, most: int = MOST_WORDS) -> DataFrame | None:
    """The set of whole-number keys as _word, _bits: 64 neighbouring numbers a row; None beyond `most` rows, or for other types.

    Ids that are dense take a bit each, so that a look-up of a fact needs neither a shuffle nor a sort; ids too scattered for
    the bound are left to a join.  Counts the rows, so a job to call once, on written keys.
    """
    if not isinstance(keys.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None
    number = F.col(key).cast("bigint")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int"))
    words = keys.where(F.col(key).isNotNull()).groupBy(F.shiftright(number, 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    return words if words.count() <= most else None


def among_words(df: DataFrame, key: str, words: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: is ``key`` in the set?  Null never is."""
    number = F.col(key).cast("bigint")
    is_set = F.getbit(F.col("_bits"), F.pmod(number, F.lit(64)).cast("int")) == 1
    placed = df.join(F.broadcast(words), F.shiftright(number, 6) == F.col("_word"), "left")
    return placed.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_word", "_bits")
