"""Spelling variants of words by permuterm rotations.

A word marked with a terminator is turned so that each of its characters comes last in one rotation: of
``word$`` the rotations are ``$word``, ``d$wor``, ``rd$wo``, ``ord$w`` and ``word$``.  Two words that differ in one
replaced character have a rotation each that agrees but for its last character, the edited one; and where a word has
one character more than another, its rotation without that character is a whole rotation of the shorter word.
So in the sorted rotations all near words of a word lie under the prefixes that skip one of its characters:

* a *skipping* row for each character of a word: the rotation that ends with it, without it;
* a *whole* row for each rotation of the word itself.

Rows are sorted and grouped by rotation.  A group holds at most one whole row, as a rotation has one word, and one
skipping row for each character of the alphabet; it is scanned once, and each of its words gets how many near
words it has there and the best of them.  No pair of words is written.  Of a run of equal characters only the first
is skipped to find shorter words, so two words meet as longer and shorter once, and as replaced once.

Words travel as numbers that follow their order, and rotations longer than 64 characters as digests, so a row is small
however long the word.

Defined results: null and empty texts have no words; a null id is empty in the hash; repeated rows count as often as they
stand; a word that would be near in two ways counts once; of an empty table nothing comes out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import ascii_lower, as_text, field, materialize, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
#: Every this many-th occurrence by hash loses a character: made variants.
ERROR_EVERY = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: The near word must be this many times as frequent.
DOMINANCE = 2
#: Rotations longer than this are compared by digest.
LONGEST_PLAIN = 64


def occurrences(docs: DataFrame, id_col: str, text_col: str, error_every: int | None = None) -> DataFrame:
    """``word`` for each run of letters; with ``error_every``, those whose hash it divides lose a character."""
    runs = docs.select(
        F.coalesce(field(id_col).cast("string"), F.lit("")).alias("x_id"),
        F.explode(F.regexp_extract_all(as_text(text_col), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).select("x_id", ascii_lower(F.col("run")).alias("word"))
    if error_every is None:
        return runs.select("word")
    hashed = runs.withColumn("h", F.crc32(F.concat("x_id", F.lit(":"), "word").cast("binary")))
    at = F.expr("cast(h % char_length(word) as int)")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return hashed.select(F.when(F.col("h") % error_every == 0, shorter).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n, x_word``: frequent words, numbered in code-point order.

    The table is sorted by ranges and kept, so the numbers, which tell partition and place, stay.
    """
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # UTF-8 bytes sort as code points do.
    ordered = counted.filter(F.col("n") >= min_count).sort("word")
    return materialize(ordered.select("word", "n", F.monotonically_increasing_id().alias("x_word")))


def _key(rotation: Column) -> Column:
    return F.when(F.length(rotation) <= LONGEST_PLAIN, rotation).otherwise(F.sha2(rotation, 256))


def rotations(vocab: DataFrame) -> DataFrame:
    """``rotation, whole, first, x_word, n``: whole rotations, and those without their last character."""
    # A word makes some twenty rows, so the few partitions of the vocabulary are spread out first.
    n = int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = vocab.repartition(n, "x_word").select("word", "n", "x_word", F.explode(F.expr("sequence(0, char_length(word))")).alias("i"))
    before = F.substring("word", F.lit(1), F.col("i"))
    char = F.substring("word", F.col("i") + 1, F.lit(1))
    after = F.substring("word", F.col("i") + 2, F.length("word"))
    whole = F.struct(
        _key(F.concat(char, after, F.lit("$"), before)).alias("rotation"),
        F.lit(True).alias("whole"),
        F.lit(True).alias("first"),
    )
    # ``first``: not within a run of equal characters, where skipping gives a word that was met before.
    skipping = F.struct(
        _key(F.concat(after, F.lit("$"), before)).alias("rotation"),
        F.lit(False).alias("whole"),
        ((F.col("i") == 0) | (char != F.substring("word", F.col("i"), F.lit(1)))).alias("first"),
    )
    rows = F.when(F.col("i") < F.length("word"), F.array(whole, skipping)).otherwise(F.array(whole))
    made = places.select("x_word", "n", F.explode(rows).alias("r"))
    return made.select("r.rotation", "r.whole", "r.first", "x_word", "n")


def nearest(vocab: DataFrame) -> DataFrame:
    """``x_word, n_near, best``: the number of near words, and ``best.rank``/``best.x_word`` of the most frequent one."""
    member = F.struct((-F.col("n")).alias("rank"), "x_word", "whole", "first")
    groups = rotations(vocab).groupBy("rotation").agg(F.sort_array(F.collect_list(member)).alias("members"))
    met = groups.filter(F.size("members") > 1).select(F.explode("members").alias("m"), "members")
    # Two skipping rows are near by replacement, a whole and a first skipping row by an added character.
    near = F.filter(
        "members",
        lambda o: (o["x_word"] != F.col("m.x_word"))
        & F.when(F.col("m.whole"), o["first"]).when(o["whole"], F.col("m.first")).otherwise(True),
    )
    scanned = met.select("m.x_word", near.alias("near")).filter(F.size("near") > 0)
    best = F.struct(F.col("near")[0]["rank"].alias("rank"), F.col("near")[0]["x_word"].alias("x_word"))
    return (
        scanned.select("x_word", F.size("near").cast("long").alias("n_near"), best.alias("best"))
        .groupBy("x_word")
        .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``x_word, root`` for every row of ``forms`` (``x_word, form``): the last word of the chain of forms.

    Pointers are doubled, and a form is at least twice as frequent as its word, so few rounds are needed.
    """
    reached = stored(forms.select("x_word", F.col("form").alias("root")))
    while True:
        step = reached.select(F.col("x_word").alias("root"), F.col("root").alias("further"))
        moved = stored(reached.join(step, "root", "left").select("x_word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reached = moved.select("x_word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def variants(vocab: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``vocabulary``."""
    found = vocab.join(nearest(vocab), "x_word", "left")
    count = -F.col("best.rank")
    formed = stored(
        found.select(
            "x_word",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(count >= dominance * F.col("n"), F.struct(F.col("best.x_word").alias("x_word"), count.alias("n"))).alias("f"),
        )
    )
    ends = roots(formed.filter("f IS NOT NULL").select("x_word", F.col("f.x_word").alias("form")))
    named = vocab.select("x_word", "word")
    form = named.select(F.col("x_word").alias("x_form"), F.col("word").alias("form"))
    root = named.select(F.col("x_word").alias("x_root"), F.col("word").alias("root"))
    chained = formed.filter("f IS NOT NULL").join(ends.withColumnRenamed("root", "x_root"), "x_word")
    joined = chained.withColumn("x_form", F.col("f.x_word")).join(form, "x_form").join(root, "x_root")
    out = ["word", "form", "root", "n", "n_near", "form_n"]
    with_form = joined.withColumn("form_n", F.col("f.n").cast("long")).select(*out)
    alone = formed.filter("f IS NULL").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", F.lit(None).cast("long").alias("form_n")
    )
    return with_form.unionByName(alone.select(*out))
