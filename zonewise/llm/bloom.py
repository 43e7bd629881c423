"""Bloom filters as small tables of 64-bit words, built and probed with SQL functions only.

A key's hash picks one word and a few bits in it, so a probe is one lookup.  The table is
broadcast: it has at most ``MAX_WORDS`` rows of two longs, whatever the input.  Beyond the
keys that fit, more keys pass as possible members; results stay exact, as every possible
member is confirmed by a join, and the saving gets smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 20
MIN_WORDS = 1 << 10
KEYS_PER_WORD = 4


def words_for(keys: int) -> int:
    """A power of two with about 16 bits for each key, within the bound."""
    words = MIN_WORDS
    while words * KEYS_PER_WORD < keys and words < MAX_WORDS:
        words *= 2
    return words


def word_of(key_hash: Column, words: int) -> Column:
    return key_hash.bitwiseAND(F.lit(words - 1))


def bits_of(key_hash: Column) -> list[Column]:
    """The positions within the word; the word's own bits of the hash are not used again."""
    return [F.shiftrightunsigned(key_hash, at).bitwiseAND(F.lit(63)).cast("int") for at in (28, 36, 44)]


def mask_of(key_hash: Column) -> Column:
    mask = F.lit(0).cast("long")
    for bit in bits_of(key_hash):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def members(keys: DataFrame, key_hash: Column, words: int) -> DataFrame:
    """``word, bits``: the filter of all keys.  Combines on the map side."""
    return (
        keys.select(word_of(key_hash, words).alias("x_word"), mask_of(key_hash).alias("x_mask"))
        .groupBy("x_word")
        .agg(F.bit_or("x_mask").alias("x_bits"))
    )


def hit_twice(keys: DataFrame, key_hash: Column, words: int) -> DataFrame:
    """``word, bits``: the bits that two or more rows set.  A repeated key has all of its own among them."""
    cells = keys.select(
        word_of(key_hash, words).alias("x_word"), F.explode(F.array_distinct(F.array(*bits_of(key_hash)))).alias("x_bit")
    )
    twice = cells.groupBy("x_word", "x_bit").agg(F.count(F.lit(1)).alias("x_n")).filter("x_n > 1")
    return twice.groupBy("x_word").agg(F.bit_or(F.expr("shiftleft(1L, x_bit)")).alias("x_bits"))


def probe(rows: DataFrame, key_hash: Column, table: DataFrame, words: int, flag: str) -> DataFrame:
    """Add ``flag``: true where the key may be in the filter, false where it surely is not."""
    table = F.broadcast(table.select(F.col("x_word").alias("x_probe"), F.col("x_bits").alias("x_found")))
    mask = mask_of(key_hash)
    return (
        rows.join(table, word_of(key_hash, words) == F.col("x_probe"), "left")
        .withColumn(flag, F.coalesce(F.col("x_found").bitwiseAND(mask) == mask, F.lit(False)))
        .drop("x_probe", "x_found")
    )


def without(rows: DataFrame, key: list[Column], dropped: DataFrame, dropped_key: list[str], count: int) -> DataFrame:
    """``rows`` without those whose key is in ``dropped`` (few columns, stored, ``count`` rows).

    Rows that the filter clears pass straight through; only possible members shuffle.
    """
    if count == 0:
        return rows
    words = words_for(count)
    table = members(dropped, F.xxhash64(*dropped_key), words)
    names = [f"x_key{i}" for i in range(len(key))]
    packed = rows.select(F.struct("*").alias("x_row"), *[k.alias(n) for k, n in zip(key, names)])
    flagged = probe(packed, F.xxhash64(*names), table, words, "x_maybe")
    aside = dropped.select(*[F.col(c).alias(f"x_gone{i}") for i, c in enumerate(dropped_key)])
    same = [F.col(n).eqNullSafe(F.col(f"x_gone{i}")) for i, n in enumerate(names)]
    stay = flagged.filter("x_maybe").join(aside, same, "left_anti")
    return flagged.filter("NOT x_maybe").select("x_row.*").unionByName(stay.select("x_row.*"))
