"""A blocked Bloom filter as a table, built and asked by built-in expressions.

Each key sets ``BITS`` bits of one 64-bit word, chosen by its hash; the words are a
partial aggregate (``bit_or``), so a filter over any number of keys is one small
shuffle, and a key is looked up by an equi-join on the word. A key that was put
in is always found; one that was not is found with a chance of about 1 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys a word (16 bits a key) and bits a key.
KEYS_PER_WORD, BITS = 4, 4


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(words))


def _mask(key: Column) -> Column:
    """``BITS`` bits, each by six bits of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def words_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_WORD))


def build(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(word, bits) of the keys; at most ``words`` rows."""
    return keys.groupBy(_word(F.col(key), words).alias("word")).agg(F.bit_or(_mask(F.col(key))).alias("bits"))


def maybe(df: DataFrame, key: str, bloom: DataFrame, words: int, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: false where the filter surely lacks the key."""
    word, bits = f"{flag}_word", f"{flag}_bits"
    table = F.broadcast(bloom.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    found = df.withColumn(f"{flag}_at", _word(F.col(key), words)).join(table, F.col(f"{flag}_at") == F.col(word), "left")
    mask = _mask(F.col(key))
    hit = F.col(key).isNotNull() & F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False))
    return found.withColumn(flag, hit).drop(word, bits, f"{flag}_at")
