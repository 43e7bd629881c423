"""The registered queries of this package: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.llm import (
    bpe_chunks,
    conversations,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    lm_scoring,
    mixing,
    spelling,
    surrogates,
    token_counts,
    url_filter,
    warc,
)
from zonewise.llm.common import materialize, read
from zonewise.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

SURROGATE_KEY = "change-me"
TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
WORD_BPE = "word_bpe_49k.json"
RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]
#: Domains are quality and toxicity of the labelled table; shares of all tokens.
TARGETS = {"q1t0": 0.90, "q0t0": 0.08, "q1t1": 0.015, "q0t1": 0.005}


def domain():
    """The domain of a row of ``labels``; null where a label is."""
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = surrogates.replace(docs, SURROGATE_KEY)
    return done.select("doc_id", "text", "n_entities", F.to_json("entity_types").alias("entity_types"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scoring.score(docs, lm_scoring.train(docs))
    return scored.drop("text")


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rule = url_filter.rule_for(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")), RULES)
    labelled = pages.select("url", (rule["verdict"] == "block").cast("int").alias("blocked"))
    return url_filter.judge(pages, url_filter.train(labelled), RULES).drop("url")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = language_id.held_out()
    model = language_id.train(docs.filter(~held).select("doc_id", "text", "lang"))
    out = language_id.identify(docs.select("doc_id", "text", held.alias("held_out")), model)
    return out.drop("text")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.write(read(spark, sf_dir, "pages"))
    back = warc.read_records(spark, folder, index, payloads=False)
    number = {c: F.col(c).cast("long").alias(c) for c in ("page_id", "refers_to")}
    return back.select(number["page_id"], "payload_bytes", "payload_digest", "record_type", number["refers_to"])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.train(docs, read(spark, sf_dir, "labels"), domain())
    members = materialize(mixing.memberships(docs, model).drop("text"))
    mix = mixing.solve(members, model, TARGETS)
    shares = [F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return mix.rated(members).select("doc_id", "n_tokens", "rate", *shares)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, read(spark, sf_dir, "benchmark"))
    found = found.select("doc_id", "n_words", decontaminate.hit_words(F.col("hits")).alias("n_hit"), decontaminate.items_of(F.col("hits")).alias("x_items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("x_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("x_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return counted.select("doc_id", size, "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op11_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe_chunks.encode(docs, public_tokenizers.path(WORD_BPE), decoded="decoded")
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(read(spark, sf_dir, "conversations"))
    return conversations.repair(rows).withColumnRenamed("conv", "conv_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.occurrences(docs, "doc_id", "text", spelling.ERROR_EVERY)
    return spelling.variants(spelling.vocabulary(words))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_pii_surrogates,
        op3_lm_scores,
        op4_url_verdicts,
        op5_language_id,
        op6_exact_dedup,
        op7_warc_bundles,
        op8_mixing,
        op9_decontaminate,
        op10_token_counts,
        op11_bpe_chunks,
        op12_conversation_repair,
        op13_spelling_variants,
        pipeline,
    )
}
