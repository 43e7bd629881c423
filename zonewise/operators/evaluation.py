"""Scoring triagers against labelled breaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.operators.triage import Triager, baseline, run_triager

GENUINE = "genuine"
DELTAS = ["false_positive_suppression", "genuine_retention", "precision", "recall", "f1"]


def without_labels(labelled: DataFrame) -> DataFrame:
    return labelled.drop("label")


def join_labels(breaches: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels by vehicle and time.  Only here, after the decisions, do the two meet."""
    return breaches.join(labels.select("vehicleId", "timestamp", "label"), ["vehicleId", "timestamp"])


def rate(part: Column, whole: Column) -> Column:
    """``part / whole``; 1.0 when there is nothing to count."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(1.0))


def score(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion counts, rates and cost of ``outcomes(label, alert[, cost])``, per ``by`` if given."""
    genuine, alert = F.col("label") == GENUINE, F.coalesce(F.col("alert"), F.lit(False))
    genuine = F.coalesce(genuine, F.lit(False))
    cost = F.coalesce(F.col("cost").cast("double"), F.lit(0.0)) if "cost" in outcomes.columns else F.lit(0.0)
    grouped = outcomes.groupBy(*by) if by else outcomes.groupBy()
    counts = grouped.agg(
        F.count_if(genuine & alert).alias("tp"),
        F.count_if(~genuine & alert).alias("fp"),
        F.count_if(genuine & ~alert).alias("fn"),
        F.count_if(~genuine & ~alert).alias("tn"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost_total"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = rate(tp, tp + fp), rate(tp, tp + fn)
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(
        F.try_divide(2 * precision * recall, precision + recall)
    )
    n = tp + fp + fn + tn
    return counts.select(
        *(by or []),
        n.alias("n"),
        (tp + fn).alias("genuine"),
        (fp + tn).alias("false_positive"),
        rate(tn, tn + fp).alias("false_positive_suppression"),
        recall.alias("genuine_retention"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        "tp",
        "fp",
        "fn",
        "tn",
        "cost_total",
        rate(F.col("cost_total"), n).alias("cost_per_event"),
    )


def _outcomes(breaches: DataFrame, labels: DataFrame, triager: Triager, side: str) -> DataFrame:
    judged = run_triager(breaches, triager)
    cost = F.col("cost").cast("double") if "cost" in judged.columns else F.lit(0.0)
    return join_labels(judged, labels).select(F.lit(side).alias("side"), "label", "alert", cost.alias("cost"))


def evaluate(breaches: DataFrame, labels: DataFrame, triager: Triager) -> DataFrame:
    return score(_outcomes(breaches, labels, triager, "subject"))


def compare(breaches: DataFrame, labels: DataFrame, triager: Triager, name: str) -> DataFrame:
    """A triager beside the baseline, one row, with the differences of the rates."""
    both = _outcomes(breaches, labels, triager, "subject").unionByName(
        _outcomes(breaches, labels, baseline, "baseline")
    )
    scored = score(both, by=["side"])
    metrics = [c for c in scored.columns if c != "side"]

    def of(side: str, metric: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(metric)))

    return scored.agg(
        F.lit(name).alias("name"),
        *[of(side, m).alias(f"{side}_{m}") for side in ("subject", "baseline") for m in metrics],
        *[(of("subject", m) - of("baseline", m)).alias(f"delta_{m}") for m in DELTAS],
    )
