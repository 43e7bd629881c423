"""Exact deduplication in two passes with a Bloom filter.  SQL functions only.

The first pass hashes every text and sets bits; bits set twice mark the hashes that may be
repeated.  The second pass probes every row: rows that cannot be repeated pass straight
through, the others shuffle by their hash and are decided exactly.

Texts are equal when identical after removing all characters of ``[\\x20\\x09-\\x0D]``; equality is
decided by SHA-256.  Null counts as empty, so null and blank texts form one group.  Of a group,
the text with the most code points stays, then the smallest id; a null id comes after all others.
Rows that repeat both id and text are one document: ``duplicates`` keeps each row and marks all of
them alike, ``keep_first`` returns one.  Input columns of any name are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm import bloom
from zonewise.llm.common import as_text, field, materialize


def fingerprint(text_col: str) -> Column:
    """SHA-256 of the text without white space, lower-case hex."""
    return F.sha2(F.regexp_replace(as_text(text_col), r"[\x20\x09-\x0D]+", ""), 256)


def _facts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The narrow table both passes read: id, fingerprint, length."""
    return materialize(
        docs.select(
            field(id_col).alias("x_id"),
            fingerprint(text_col).alias("x_sha"),
            F.char_length(as_text(text_col)).cast("long").alias("x_len"),
        )
    )


def _filter(facts: DataFrame) -> tuple[DataFrame, int]:
    words = bloom.words_for(facts.count())
    return materialize(bloom.hit_twice(facts, F.xxhash64("x_sha"), words)), words


def _groups(maybe: DataFrame) -> DataFrame:
    """One row for each fingerprint: the id that stays and the size.  Combines on the map side,
    and is stored so that the join back can split a hot group."""
    first = F.min(F.struct((-F.col("x_len")).alias("a"), F.isnull("x_id").alias("b"), F.col("x_id").alias("c")))
    grouped = maybe.groupBy("x_sha").agg(F.count(F.lit(1)).alias("x_size"), first.alias("x_first"))
    return materialize(grouped.select("x_sha", "x_size", F.col("x_first.c").alias("x_keep")))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` (the id under its own name)."""
    facts = _facts(docs, id_col, text_col)
    table, words = _filter(facts)
    flagged = bloom.probe(facts, F.xxhash64("x_sha"), table, words, "x_maybe")
    maybe = flagged.filter("x_maybe")
    groups = _groups(maybe)
    alone = flagged.filter("NOT x_maybe").select(
        "x_id", F.col("x_id").alias("x_keep"), F.lit(1).cast("long").alias("x_size"), "x_sha"
    )
    shared = maybe.join(groups, "x_sha").select("x_id", "x_keep", "x_size", "x_sha")
    return alone.unionByName(shared).select(
        F.col("x_id").alias(id_col),
        F.col("x_keep").alias("keep_id"),
        F.col("x_size").alias("group_size"),
        F.col("x_id").eqNullSafe(F.col("x_keep")).alias("kept"),
        F.col("x_sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    facts = _facts(docs, id_col, text_col)
    table, words = _filter(facts)
    groups = _groups(bloom.probe(facts, F.xxhash64("x_sha"), table, words, "x_maybe").filter("x_maybe"))
    rows = docs.select(F.struct("*").alias("x_row"), field(id_col).alias("x_id"), fingerprint(text_col).alias("x_sha"))
    flagged = bloom.probe(rows, F.xxhash64("x_sha"), table, words, "x_maybe")
    winners = groups.select(F.col("x_sha").alias("x_of"), "x_keep")
    chosen = (
        flagged.filter("x_maybe")
        .join(winners, (F.col("x_sha") == F.col("x_of")) & F.col("x_id").eqNullSafe(F.col("x_keep")), "left_semi")
        .dropDuplicates(["x_sha"])
    )
    return flagged.filter("NOT x_maybe").select("x_row.*").unionByName(chosen.select("x_row.*"))
