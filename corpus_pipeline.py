"""From raw documents to a training mix: five stages, each an operator of ``zonewise.llm``.

Each stage takes the documents that its predecessor kept.  A row's columns are those of the table
``documents`` until the last stage, which adds the rate of each document in the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.llm import bloom, decontaminate, exact_dedup, jaccard_join, language_id, mixing
from zonewise.llm.common import materialize, read
from zonewise.llm.queries import TARGETS, domain
from zonewise.session import shared_dir

#: Near copies: five-word shingles, similarity 0.8 or more.
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go: no text, no letter, or two languages about as likely."""
    model = language_id.train(docs.filter(~language_id.held_out()).select("doc_id", "text", "lang"))
    return language_id.recognised(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; rows without an id are not grouped."""
    found = jaccard_join.classes(docs.filter("doc_id IS NOT NULL").select("doc_id", "text"), size=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
    dropped = materialize(found.filter("doc_id <> component_id").select("doc_id"))
    return bloom.without(docs, [F.col("doc_id")], dropped, ["doc_id"], dropped.count())


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as its rate asks; those of rate 0 go."""
    model = mixing.train(docs, read(spark, sf_dir, "labels"), domain())
    members = mixing.memberships(docs.select("text"), model).select("n_tokens", "posteriors")
    return mixing.mixed(docs, mixing.solve(materialize(members), model, TARGETS))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard_join", near_stage),
    ("decontaminate", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Classifiers decide in the first and last stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
