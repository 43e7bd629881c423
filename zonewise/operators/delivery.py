"""From gated decisions to one composed alert per incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.functions import messages as M
from zonewise.operators.ordered import MILLIS_PER_SEGMENT, asof_join

TTL_DAYS = 30
DAY_S = 86_400


def delivery_messages(decided: DataFrame) -> DataFrame:
    """``breach`` and ``decision`` with their dedupe key."""
    b = F.col("breach")
    return decided.withColumn(
        "dedupeKey", M.dedupe_key(b["vehicleId"], b["zoneId"], b["breachType"], b["timestamp"])
    )


def first_claims(messages: DataFrame, order: str = "seq") -> DataFrame:
    """The first message of every key.  Combines map-side: copies of one key never meet in a task."""
    rest = [c for c in messages.columns if c != "dedupeKey"]
    first = F.min_by(F.struct(*rest), F.col(order))
    return messages.groupBy("dedupeKey").agg(first.alias("first")).select("dedupeKey", "first.*")


def live_claims(ledger: DataFrame, now_s: Column | int) -> DataFrame:
    now_s = now_s if isinstance(now_s, Column) else F.lit(now_s)
    return ledger.where(F.col("expiresAt") > now_s)


def undelivered(messages: DataFrame, ledger: DataFrame, now_s: int, order: str = "seq") -> DataFrame:
    """First message of every key that holds no live claim."""
    return first_claims(messages, order).join(
        live_claims(ledger, now_s).select("dedupeKey"), "dedupeKey", "left_anti"
    )


def already_delivered(messages: DataFrame, ledger: DataFrame, now_s: int) -> DataFrame:
    """Messages whose key holds a live claim."""
    return messages.join(live_claims(ledger, now_s).select("dedupeKey"), "dedupeKey", "left_semi")


def claims(messages: DataFrame, now_s: int, ttl_days: int = TTL_DAYS) -> DataFrame:
    """Ledger rows for delivered messages."""
    return messages.select("dedupeKey", F.lit(int(now_s) + ttl_days * DAY_S).cast("long").alias("expiresAt"))


def claims_per_key(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("dedupeKey").agg(F.count(F.lit(1)).alias("claims"))


def compose(messages: DataFrame, drafted: str | None = None) -> DataFrame:
    """Adds ``subject`` and ``body``; ``drafted`` names an optional ``map<string,string>`` column."""
    sections = None if drafted is None else F.col(drafted)
    return messages.withColumn("subject", M.subject()).withColumn("body", M.body(sections))


def outbox(messages: DataFrame, drafted: str | None = None) -> DataFrame:
    """The rows handed to the notifier: the subject as long as it takes, and whole beside it."""
    return compose(messages, drafted).select(
        "dedupeKey", M.cut_subject(F.col("subject")).alias("subject"), F.col("subject").alias("full_subject"), "body"
    )


def rule_effect(edits: DataFrame, breaches: DataFrame, span_ms: int = MILLIS_PER_SEGMENT) -> DataFrame:
    """First breach of the zone at or after each zone edit, and the time to it in seconds.

    ``edits(zoneId, updatedAt)`` against ``breaches(zoneId, timestamp)``; edits that saw no
    breach yet are left out.
    """
    first = asof_join(
        edits,
        breaches.select("zoneId", "timestamp"),
        ["zoneId"],
        "updatedAt",
        "timestamp",
        "hit",
        direction="forward",
        span=span_ms,
    )
    return first.where(F.col("hit").isNotNull()).select(
        *edits.columns,
        F.col("hit.timestamp").alias("firstBreach"),
        ((F.col("hit.timestamp") - F.col("updatedAt")) / 1000).alias("effect_s"),
    )
