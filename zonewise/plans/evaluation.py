"""Triage quality against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.operators import evaluation as ops
from zonewise.operators import triage
from zonewise.plans import sql as S
from zonewise.plans.detection import seed_breaches
from zonewise.plans.registry import plan
from zonewise.plans.triage import BASELINE_SQL, RUBRIC_SQL
from zonewise.sources import tables as tb

_LABELS = """
labels_ AS (
  SELECT vehicleId, timestamp, CASE WHEN value % 100 > 40 THEN 'genuine' ELSE 'false_positive' END AS label FROM telemetry
)"""

_COUNTS = """
count(*) FILTER (WHERE label = 'genuine' AND severity <> 'LOW') AS tp,
count(*) FILTER (WHERE label <> 'genuine' AND severity <> 'LOW') AS fp,
count(*) FILTER (WHERE label = 'genuine' AND severity = 'LOW') AS fn,
count(*) FILTER (WHERE label <> 'genuine' AND severity = 'LOW') AS tn"""

_RATES = """
coalesce(tn / nullif(tn + fp, 0), 1.0::DOUBLE) AS suppression,
coalesce(tp / nullif(tp + fn, 0), 1.0::DOUBLE) AS recall,
coalesce(tp / nullif(tp + fp, 0), 1.0::DOUBLE) AS precision"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per position, from the event value."""
    return tb.telemetry(spark, sf_dir).selectExpr(
        "vehicleId", "timestamp", "if(value % 100 > 40, 'genuine', 'false_positive') AS label"
    )


def _scored(source: str) -> str:
    return f"""
scored_{source} AS (SELECT *, {_RATES} FROM (SELECT {_COUNTS} FROM {source} JOIN labels_ USING (vehicleId, timestamp)))"""


@plan(
    "c6_label_join",
    S.with_(
        *S.SEED_BREACHES,
        RUBRIC_SQL,
        _LABELS,
        select="SELECT vehicleId, timestamp, zoneId, label, severity FROM rubric JOIN labels_ USING (vehicleId, timestamp)",
    ),
)
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = triage.rubric(seed_breaches(spark, sf_dir))
    joined = ops.join_labels(judged, labels(spark, sf_dir))
    return joined.select("vehicleId", "timestamp", "zoneId", "label", "severity")


@plan(
    "d1_confusion",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        _LABELS,
        select=f"SELECT zoneKind, {_COUNTS} FROM baseline JOIN labels_ USING (vehicleId, timestamp) GROUP BY zoneKind",
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = triage.baseline(seed_breaches(spark, sf_dir))
    scored = ops.score(ops.join_labels(judged, labels(spark, sf_dir)), by=["zoneKind"])
    return scored.select("zoneKind", "tp", "fp", "fn", "tn")


@plan(
    "d2_rates",
    S.with_(
        *S.SEED_BREACHES,
        RUBRIC_SQL,
        _LABELS,
        _scored("rubric"),
        select="""
SELECT tp + fp + fn + tn AS n, tp + fn AS genuine, fp + tn AS false_positive, tp, fp, fn, tn,
  round(suppression, 9) AS false_positive_suppression, round(recall, 9) AS genuine_retention,
  round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 9) AS f1
FROM scored_rubric""",
    ),
)
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ops.evaluate(seed_breaches(spark, sf_dir), labels(spark, sf_dir), triage.rubric)
    rounded = ["false_positive_suppression", "genuine_retention", "precision", "recall", "f1"]
    return scored.select(
        "n", "genuine", "false_positive", "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in rounded]
    )


@plan(
    "d3_cost",
    S.with_(
        *S.SEED_BREACHES,
        select="""
SELECT zoneId, round(sum(CASE WHEN seq % 4 = 0 THEN 0 ELSE 0.0025::DOUBLE * (seq % 10) END), 6) AS cost_total,
  round(sum(CASE WHEN seq % 4 = 0 THEN 0 ELSE 0.0025::DOUBLE * (seq % 10) END) / count(*), 9) AS cost_per_event
FROM breaches GROUP BY zoneId""",
    ),
)
def cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A triager that reports a cost for three calls in four."""
    judged = triage.baseline(seed_breaches(spark, sf_dir))
    priced = judged.withColumn("cost", F.expr("if(seq % 4 = 0, null, 0.0025D * (seq % 10))"))
    scored = ops.score(ops.join_labels(priced, labels(spark, sf_dir)), by=["zoneId"])
    return scored.select(
        "zoneId",
        F.round("cost_total", 6).alias("cost_total"),
        F.round("cost_per_event", 9).alias("cost_per_event"),
    )


@plan(
    "b14_label_withheld",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        select="SELECT vehicleId, seq, zoneId, severity, false AS label_seen FROM baseline",
    ),
)
def label_withheld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A triager run over labelled breaches never finds the label among its columns."""
    labelled = ops.join_labels(seed_breaches(spark, sf_dir), labels(spark, sf_dir))

    def triager(found: DataFrame) -> DataFrame:
        return triage.baseline(found).withColumn("label_seen", F.lit("label" in found.columns))

    judged = triage.run_triager(labelled, triager)
    return judged.select("vehicleId", "seq", "zoneId", "severity", "label_seen")


@plan(
    "c7_eval_delta",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        RUBRIC_SQL,
        _LABELS,
        _scored("rubric"),
        _scored("baseline"),
        select="""
SELECT 'rubric' AS name, r.tp AS subject_tp, b.tp AS baseline_tp,
  round(r.suppression - b.suppression, 9) AS delta_false_positive_suppression,
  round(r.recall - b.recall, 9) AS delta_recall, round(r.precision - b.precision, 9) AS delta_precision
FROM scored_rubric r, scored_baseline b""",
    ),
)
def eval_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = ops.compare(seed_breaches(spark, sf_dir), labels(spark, sf_dir), triage.rubric, "rubric")
    deltas = ["delta_false_positive_suppression", "delta_recall", "delta_precision"]
    return compared.select("name", "subject_tp", "baseline_tp", *[F.round(c, 9).alias(c) for c in deltas])
