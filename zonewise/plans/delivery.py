"""Dedupe keys, claims, alert texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions import messages as M
from zonewise.operators import delivery as ops
from zonewise.operators import triage
from zonewise.plans import sql as S
from zonewise.plans.detection import seed_breaches
from zonewise.plans.registry import plan
from zonewise.plans.triage import DECISIONS_SQL, decided
from zonewise.schemas import BREACH
from zonewise.sources import envelopes
from zonewise.sources import tables as tb
from zonewise.sources.fixed import SEED_ZONES

NOW_S = 1_705_276_800  # the middle of the event month

KEY_SQL = """
keyed AS (
  SELECT *, concat(vehicleId, '|', zoneId, '|', breachType, '|', timestamp) AS dedupeKey FROM decisions
), gated AS (SELECT * FROM keyed WHERE decision = 'ALERT')"""


def gated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.delivery_messages(triage.gate(decided(spark, sf_dir)))


@plan(
    "h13_dedupe_keys",
    S.with_(*S.SEED_BREACHES, DECISIONS_SQL, KEY_SQL, select="SELECT seq, dedupeKey FROM keyed"),
)
def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seed_breaches(spark, sf_dir)
    key = M.dedupe_key(F.col("vehicleId"), F.col("zoneId"), F.col("breachType"), F.col("timestamp"))
    return found.select("seq", key.alias("dedupeKey"))


@plan(
    "a9_delivery_messages",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        select="SELECT dedupeKey, severity, timestamp AS eventTime, zoneKind, distanceOutsideM FROM gated",
    ),
)
def delivery_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_messages(spark, sf_dir).selectExpr(
        "dedupeKey", "decision.severity", "decision.eventTime", "breach.zoneKind", "breach.distanceOutsideM"
    )


# Redelivery: two thirds of the events come a second time, one key in seven a third time.
_REDELIVERED = """
redelivered AS (
  SELECT dedupeKey, seq * 10 + copy AS seq, vehicleId FROM keyed, (SELECT unnest([0, 1, 2]) AS copy) c
  WHERE copy = 0 OR (copy = 1 AND keyed.seq % 3 <> 0) OR (copy = 2 AND keyed.seq % 7 = 0)
), ledger AS (
  SELECT dedupeKey, timestamp // 1000 + (seq % 40 - 10) * 86400 AS expiresAt FROM keyed WHERE seq % 5 < 2
)"""


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = M.dedupe_key(F.col("vehicleId"), F.col("zoneId"), F.col("breachType"), F.col("timestamp"))
    copies = F.expr(
        "explode(filter(array(0, 1, 2), c -> c = 0 OR (c = 1 AND seq % 3 <> 0) OR (c = 2 AND seq % 7 = 0)))"
    )
    keyed = seed_breaches(spark, sf_dir).select(key.alias("dedupeKey"), "seq", "vehicleId")
    return keyed.withColumn("copy", copies).selectExpr("dedupeKey", "seq * 10 + copy AS seq", "vehicleId")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = M.dedupe_key(F.col("vehicleId"), F.col("zoneId"), F.col("breachType"), F.col("timestamp"))
    return (
        seed_breaches(spark, sf_dir)
        .where("seq % 5 < 2")
        .select(key.alias("dedupeKey"), F.expr("timestamp div 1000 + (seq % 40 - 10) * 86400 AS expiresAt"))
    )


@plan(
    "e7_first_claim",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        _REDELIVERED,
        select="SELECT dedupeKey, min(seq) AS seq, min(vehicleId) AS vehicleId FROM redelivered GROUP BY dedupeKey",
    ),
)
def first_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_claims(_redelivered(spark, sf_dir)).select("dedupeKey", "seq", "vehicleId")


@plan(
    "c4_undelivered",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        _REDELIVERED,
        select=f"""
SELECT dedupeKey, min(seq) AS seq FROM redelivered
WHERE dedupeKey NOT IN (SELECT dedupeKey FROM ledger WHERE expiresAt > {NOW_S}) GROUP BY dedupeKey""",
    ),
)
def undelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = ops.undelivered(_redelivered(spark, sf_dir), _ledger(spark, sf_dir), NOW_S)
    return new.select("dedupeKey", "seq")


@plan(
    "c4_already_delivered",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        _REDELIVERED,
        select=f"""
SELECT dedupeKey, seq FROM redelivered
WHERE dedupeKey IN (SELECT dedupeKey FROM ledger WHERE expiresAt > {NOW_S})""",
    ),
)
def already_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = ops.already_delivered(_redelivered(spark, sf_dir), _ledger(spark, sf_dir), NOW_S)
    return old.select("dedupeKey", "seq")


@plan(
    "a12_claims",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        _REDELIVERED,
        select=f"""
SELECT DISTINCT dedupeKey, {NOW_S} + 30 * 86400::BIGINT AS expiresAt FROM redelivered
WHERE dedupeKey NOT IN (SELECT dedupeKey FROM ledger WHERE expiresAt > {NOW_S})""",
    ),
)
def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = ops.undelivered(_redelivered(spark, sf_dir), _ledger(spark, sf_dir), NOW_S)
    return ops.claims(new, NOW_S)


@plan(
    "d14_claims_per_key",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        _REDELIVERED,
        select="SELECT dedupeKey, count(*) AS claims FROM redelivered GROUP BY dedupeKey",
    ),
)
def claims_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries per key before deduplication."""
    return ops.claims_per_key(_redelivered(spark, sf_dir))


_SUBJECT_SQL = "concat('[', severity, '] Vehicle ', vehicleId, ': ', zoneName, ' ', breachType)"


@plan(
    "h14_subjects",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        select=f"SELECT dedupeKey, {_SUBJECT_SQL} AS subject FROM gated",
    ),
)
def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compose(gated_messages(spark, sf_dir)).select("dedupeKey", "subject")


@plan(
    "h15_locations",
    S.with_(
        *S.SEED_BREACHES, select="SELECT vehicleId, seq, zoneId, printf('%.5f, %.5f', lat, lon) AS place FROM breaches"
    ),
)
def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seed_breaches(spark, sf_dir)
    return found.select("vehicleId", "seq", "zoneId", M.location_text(F.col("location")).alias("place"))


_BODY_SQL = """
concat('CURRENT STATUS:\n', CASE WHEN seq % 4 = 0 THEN 'Moving fast.' ELSE concat('Vehicle ', vehicleId, ' at ',
    printf('%.5f, %.5f', lat, lon), '; ', durationInStateS, 's in state, ', printf('%.1f', distanceOutsideM),
    'm outside the boundary.') END,
  '\n\nWHY THIS ALERT:\n', trim(concat(severity, ' ', zoneKind, ' ', breachType, ' at ', zoneName, '. ', reason)),
  '\n\nIMPACT:\nNo prior related history on record.',
  '\n\nRECOMMENDED ACTIONS:\n', CASE WHEN recommendedAction = '' THEN 'Review and dispatch as appropriate.'
    ELSE recommendedAction END)"""


@plan(
    "h16_bodies",
    S.with_(*S.SEED_BREACHES, DECISIONS_SQL, KEY_SQL, select=f"SELECT dedupeKey, {_BODY_SQL} AS body FROM gated"),
)
def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert in four has a drafted status section, the rest falls back to the facts."""
    drafted = F.expr("if(seq % 4 = 0, map('CURRENT STATUS', ' Moving fast. ', 'IMPACT', ''), null)")
    messages = gated_messages(spark, sf_dir).withColumn("drafted", drafted)
    return ops.compose(messages, "drafted").select("dedupeKey", "body")


@plan(
    "a10_outbox",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        select=f"""
SELECT dedupeKey, substr({_SUBJECT_SQL}, 1, 100) AS subject, {_SUBJECT_SQL} AS full_subject, {_BODY_SQL.replace("seq % 4 = 0", "false")} AS body
FROM gated""",
    ),
)
def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.outbox(gated_messages(spark, sf_dir))


# ---------------------------------------------------------------- envelopes

_ENVELOPE_SQL = """
SELECT seq, CASE WHEN seq % 13 = 0 THEN NULL ELSE vehicleId END AS vehicleId,
  CASE WHEN seq % 13 = 0 THEN NULL ELSE distanceOutsideM END AS distanceOutsideM,
  CASE WHEN seq % 13 = 0 THEN NULL ELSE ingestTime END AS ingestTime, seq % 13 = 0 AS failed FROM breaches"""


@plan("a7_stream_envelopes", S.with_(*S.SEED_BREACHES, select=_ENVELOPE_SQL))
def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches through base64 envelopes; every thirteenth position's is damaged."""
    records = envelopes.encode_stream_records(seed_breaches(spark, sf_dir), "seq").withColumn(
        "data", F.expr("if(seq % 13 = 0, '%%not base64%%', data)")
    )
    return envelopes.decode_stream_records(records).selectExpr(
        "seq",
        "breach.vehicleId",
        "breach.distanceOutsideM",
        "breach.trace.ingestTime",
        "decode_error IS NOT NULL AS failed",
    )


@plan(
    "a8_queue_envelopes",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        KEY_SQL,
        select="""
SELECT seq, CASE WHEN seq % 10 <> 0 THEN dedupeKey END AS dedupeKey, CASE WHEN seq % 10 <> 0 THEN severity END AS severity,
  seq % 10 = 0 AS failed FROM gated""",
    ),
)
def queue_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    queued = gated_messages(spark, sf_dir).selectExpr(
        "seq", "if(seq % 10 = 0, '{\"dedupeKey\": ', to_json(struct(dedupeKey, decision, breach))) AS body"
    )
    return envelopes.decode_queue_records(queued).selectExpr(
        "seq", "alert.dedupeKey", "alert.decision.severity", "decode_error IS NOT NULL AS failed"
    )


@plan(
    "a3_alert_records",
    S.with_(*S.SEED_BREACHES, select="SELECT vehicleId AS key, zoneId, timestamp, distanceOutsideM FROM breaches"),
)
def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches as the alert sink writes them: one JSON value per event, keyed by vehicle."""
    records = tb.keyed_json(seed_breaches(spark, sf_dir).select(*[f.name for f in BREACH]), "vehicleId")
    return records.select("key", F.from_json("value", BREACH).alias("b")).selectExpr(
        "key", "b.zoneId", "b.timestamp", "b.distanceOutsideM"
    )


@plan(
    "a11_history_rows",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        select="""
SELECT vehicleId, timestamp AS eventTime, severity, reason, zoneId FROM decisions WHERE severity IS NOT NULL""",
    ),
)
def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.history_rows(decided(spark, sf_dir)).selectExpr(
        "vehicleId", "eventTime", "decision.severity", "decision.reason", "breach.zoneId"
    )


# ---------------------------------------------------------------- rule effect

_SEED_IDS = [zone[0] for zone in SEED_ZONES]


@plan(
    "c9_rule_effect",
    S.with_(
        *S.SEED_BREACHES,
        S.CHANGES,
        select=f"""
, edits AS (SELECT ({_SEED_IDS!r})[seq % 4 + 1] AS zoneId, updatedAt, seq FROM changes)
SELECT e.zoneId, e.updatedAt, e.seq, min(b.timestamp) AS firstBreach,
  round((min(b.timestamp) - e.updatedAt) / 1000, 3) AS effect_s
FROM edits e JOIN breaches b ON b.zoneId = e.zoneId AND b.timestamp >= e.updatedAt GROUP BY e.zoneId, e.updatedAt, e.seq""",
    ),
)
def rule_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as edits of the seed zones: when does the first breach after each edit come?"""
    ids = ", ".join(f"'{i}'" for i in _SEED_IDS)
    edits = tb.order_changes(spark, sf_dir).selectExpr(
        f"get(array({ids}), int(seq % 4)) AS zoneId", "updatedAt", "seq"
    )
    found = ops.rule_effect(edits, seed_breaches(spark, sf_dir))
    return found.withColumn("effect_s", F.round("effect_s", 3))
