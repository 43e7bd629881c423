"""Judging, decision parsing, history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions import triage as T
from zonewise.operators import triage as ops
from zonewise.plans import sql as S
from zonewise.plans.detection import seed_breaches
from zonewise.plans.registry import plan
from zonewise.schemas import BREACH
from zonewise.session import materialize
from zonewise.sources import tables as tb

BASELINE_SQL = """
baseline AS (
  SELECT *, CASE
    WHEN zoneKind = 'dwell' OR (accuracy >= 15 AND distanceOutsideM < 25 AND durationInStateS < 20) THEN 'LOW'
    WHEN zoneKind = 'containment' OR distanceOutsideM > 200 OR durationInStateS > 60 THEN 'CRITICAL'
    ELSE 'HIGH' END AS severity
  FROM breaches
)"""

CORROBORATED = """((doorOpen AND ignition) OR speed > 140 OR engineTemperature > 120 OR fuelLevel < 0.05)"""

RUBRIC_SQL = f"""
rubric AS (
  SELECT *, CASE WHEN NOT genuine THEN 'LOW'
    WHEN corroborated OR zoneKind = 'containment' OR distanceOutsideM >= 100 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
  FROM (
    SELECT *, {CORROBORATED} AS corroborated, {CORROBORATED} OR (zoneKind <> 'dwell' AND durationInStateS >= 30
      AND (distanceOutsideM > 2 * greatest(accuracy, 1)
           OR (zoneKind = 'exclusion' AND distanceOutsideM = 0 AND accuracy <= 8))) AS genuine
    FROM breaches)
)"""

_VERDICT = "SELECT vehicleId, seq, zoneId, severity <> 'LOW' AS alert, severity FROM {}"


@plan("h25_baseline", S.with_(*S.SEED_BREACHES, BASELINE_SQL, select=_VERDICT.format("baseline")))
def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.baseline(seed_breaches(spark, sf_dir)).select("vehicleId", "seq", "zoneId", "alert", "severity")


@plan(
    "h26_corroboration",
    S.with_(*S.SEED_BREACHES, select=f"SELECT vehicleId, seq, zoneId, {CORROBORATED} AS corroborated FROM breaches"),
)
def corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seed_breaches(spark, sf_dir)
    return found.select("vehicleId", "seq", "zoneId", T.corroborated().alias("corroborated"))


@plan("h27_rubric", S.with_(*S.SEED_BREACHES, RUBRIC_SQL, select=_VERDICT.format("rubric")))
def rubric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rubric(seed_breaches(spark, sf_dir)).select("vehicleId", "seq", "zoneId", "alert", "severity")


@plan(
    "h28_severity_order",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        select="""
SELECT vehicleId, max(CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END)::BIGINT AS worst
FROM baseline GROUP BY vehicleId""",
    ),
)
def severity_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = ops.baseline(seed_breaches(spark, sf_dir))
    return judged.groupBy("vehicleId").agg(F.max(T.severity_rank(F.col("severity"))).alias("worst"))


# ---------------------------------------------------------------- answers

# The answer a model might give to each breach: plain, fenced, in prose, off the rules, or useless.
_ANSWER = """CASE seq % 9
  WHEN 0 THEN '{"decision":"ALERT","severity":"HIGH","reason":" left the yard ","confidence":0.75,"recommendedAction":"call","historicalPattern":""}'
  WHEN 1 THEN concat('```json\\n', '{"severity":"critical","confidence":5,"reason":"{nested}"}', '\\n```')
  WHEN 2 THEN 'Here you go: {"decision":"ALERT","severity":"LOW","confidence":"bogus"} anything else?'
  WHEN 3 THEN '{"decision":"NO_ALERT","severity":"CRITICAL","confidence":-1,"reason":"door"}'
  WHEN 4 THEN 'not json'
  WHEN 5 THEN '[1, 2, 3]'
  WHEN 6 THEN '{"severity":"SEVERE"}'
  WHEN 7 THEN '{"severity":"Medium","confidence":"0.5","recommendedAction":"  wait "}'
  ELSE 'sorry { no' END"""

DECISIONS_SQL = """
decisions AS (
  SELECT *, CASE WHEN severity IN ('HIGH', 'CRITICAL') THEN 'ALERT' WHEN severity IS NOT NULL THEN 'NO_ALERT' END AS decision,
    CASE WHEN severity IS NULL THEN NULL WHEN seq % 9 = 0 THEN 'left the yard' WHEN seq % 9 = 1 THEN '{nested}'
      WHEN seq % 9 = 3 THEN 'door' ELSE '' END AS reason,
    CASE seq % 9 WHEN 0 THEN 0.75 WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 7 THEN 0.5 END::DOUBLE AS confidence,
    CASE seq % 9 WHEN 0 THEN 'call' WHEN 7 THEN 'wait' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN '' END AS recommendedAction,
    CASE seq % 9 WHEN 4 THEN 'analyzer output is not JSON' WHEN 8 THEN 'analyzer output is not JSON'
      WHEN 5 THEN 'analyzer output is not a JSON object' WHEN 6 THEN 'unknown severity' END AS decision_error
  FROM (SELECT *, CASE seq % 9 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'LOW' WHEN 3 THEN 'CRITICAL'
    WHEN 7 THEN 'MEDIUM' END AS severity FROM breaches)
)"""


def breach_column(found: DataFrame) -> DataFrame:
    """``seq`` and the breach event as one struct."""
    fields = ", ".join(f.name for f in BREACH)
    return found.selectExpr("seq", f"struct({fields}) AS breach")


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = breach_column(seed_breaches(spark, sf_dir)).withColumn("raw", F.expr(_ANSWER))
    return ops.parse_decisions(answers)


@plan(
    "h11_decisions",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        select="""
SELECT vehicleId, seq, zoneId, decision, severity, reason, confidence, recommendedAction, decision_error FROM decisions""",
    ),
)
def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir).selectExpr(
        "breach.vehicleId",
        "seq",
        "breach.zoneId",
        "decision.decision",
        "decision.severity",
        "decision.reason",
        "decision.confidence",
        "decision.recommendedAction",
        "decision_error",
    )


@plan(
    "b11_gate",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        select="SELECT vehicleId, seq, zoneId, severity FROM decisions WHERE decision = 'ALERT'",
    ),
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = ops.gate(decided(spark, sf_dir))
    return passed.selectExpr("breach.vehicleId", "seq", "breach.zoneId", "decision.severity")


@plan(
    "b12_consistent_decisions",
    S.with_(
        *S.SEED_BREACHES,
        DECISIONS_SQL,
        select="""
SELECT coalesce(decision, 'INVALID') AS decision, coalesce(severity, 'NONE') AS severity, count(*) AS n
FROM decisions GROUP BY ALL""",
    ),
)
def consistent_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        decided(spark, sf_dir)
        .selectExpr(
            "coalesce(decision.decision, 'INVALID') AS decision", "coalesce(decision.severity, 'NONE') AS severity"
        )
        .groupBy("decision", "severity")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@plan(
    "h10_json_recovery",
    """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN props WHEN 2 THEN concat('{"p": ', props, '}') END
  AS found FROM events""",
)
def json_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tb.read_table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN concat('note: ', props, ' {second}')
             WHEN 2 THEN concat('x {"p": ', props, '} }') ELSE concat('open {', props) END AS text""",
    )
    return texts.select("event_id", T.first_json_object("text").alias("found"))


@plan(
    "h12_confidence",
    """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE least(1, greatest(0, value / 200 - 0.5::DOUBLE)) END::DOUBLE
  AS confidence FROM events""",
)
def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = tb.read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "if(event_id % 5 = 0, 'bogus', string(value / 200 - 0.5D)) AS answer"
    )
    return values.select("event_id", T.clamp_confidence(F.col("answer")).alias("confidence"))


@plan(
    "h30_throttles",
    """
SELECT event_type, count(*) FILTER (WHERE event_id % 6 < 4) AS throttled, count(*) AS failed
FROM events GROUP BY event_type""",
)
def throttles(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = ", ".join(f"'{c}'" for c in [*T.THROTTLE_ERRORS, "AccessDeniedException"])
    failed = tb.read_table(spark, sf_dir, "events").selectExpr(
        "event_type", f"get(array({codes}), int(event_id % 6)) AS error_code"
    )
    return failed.groupBy("event_type").agg(
        F.count_if(T.is_throttle(F.col("error_code"))).alias("throttled"), F.count(F.lit(1)).alias("failed")
    )


# ---------------------------------------------------------------- history

_HISTORY_SQL = """
history AS (
  SELECT vehicleId, timestamp AS eventTime, severity, seq * 2 + CASE WHEN breachType = 'entry' THEN 1 ELSE 0 END AS seq
  FROM baseline
)"""


def baseline_history(found: DataFrame) -> DataFrame:
    """The baseline's verdicts on breaches as history; two crossings of one position get distinct numbers."""
    return ops.baseline(found).selectExpr(
        "vehicleId", "timestamp AS eventTime", "severity", "seq * 2 + if(breachType = 'entry', 1, 0) AS seq"
    )


@plan(
    "e4_history_last5",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        _HISTORY_SQL,
        select="""
SELECT vehicleId, seq, len(prior)::INTEGER AS n, array_to_string(prior, ',') AS prior FROM (
  SELECT vehicleId, seq, coalesce(list(severity) OVER (PARTITION BY vehicleId ORDER BY eventTime, seq
    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS prior FROM history)""",
    ),
)
def history_last5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.last_decisions(baseline_history(seed_breaches(spark, sf_dir))).selectExpr(
        "vehicleId", "seq", "size(prior) AS n", "array_join(transform(prior, p -> p.severity), ',') AS prior"
    )


@plan(
    "c5_history_join",
    S.with_(
        *S.SEED_BREACHES,
        BASELINE_SQL,
        _HISTORY_SQL,
        select="""
, ranked AS (
  SELECT b.vehicleId, b.seq, b.zoneId, b.timestamp, h.severity, h.seq AS hseq,
    row_number() OVER (PARTITION BY b.vehicleId, b.seq, b.zoneId ORDER BY h.eventTime DESC, h.seq DESC) AS rn
  FROM breaches b LEFT JOIN history h ON h.vehicleId = b.vehicleId AND h.eventTime < b.timestamp
    AND h.eventTime >= b.timestamp - 10 * 86400000::BIGINT)
SELECT vehicleId, seq, zoneId, count(severity)::INTEGER AS n,
  coalesce(string_agg(severity, ',' ORDER BY rn DESC), '') AS prior
FROM ranked WHERE rn <= 5 GROUP BY vehicleId, seq, zoneId""",
    ),
)
def history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ten days instead of ninety, so that some history expires within the data."""
    found = materialize(seed_breaches(spark, sf_dir))  # read by both sides
    asked = found.select("vehicleId", "seq", "zoneId", "timestamp")
    joined = ops.with_history(asked, baseline_history(found), days=10)
    return joined.selectExpr(
        "vehicleId",
        "seq",
        "zoneId",
        "size(history) AS n",
        "array_join(transform(history, h -> h.severity), ',') AS prior",
    )


_JSON_SQL = """
, ranked AS (
  SELECT b.*, h.severity AS h_severity, h.eventTime AS h_time, h.seq AS hseq,
    row_number() OVER (PARTITION BY b.vehicleId, b.seq, b.zoneId ORDER BY h.eventTime DESC, h.seq DESC) AS rn
  FROM breaches b LEFT JOIN history h ON h.vehicleId = b.vehicleId AND h.eventTime < b.timestamp
    AND h.eventTime >= b.timestamp - 90 * 86400000::BIGINT
), gathered AS (
  SELECT vehicleId, seq, zoneId, count(h_severity) AS n, string_agg(
      to_json({'eventTime': h_time, 'seq': hseq, 'severity': h_severity})::VARCHAR, chr(10) ORDER BY rn DESC) FILTER (WHERE h_severity IS NOT NULL) AS lines,
    any_value(to_json({'breachType': breachType, 'distanceOutsideM': distanceOutsideM, 'durationInStateS': durationInStateS,
      'location': {'accuracy': accuracy, 'latitude': round(lat, 4), 'longitude': round(lon, 4)}, 'timestamp': timestamp,
      'trace': {'eventTime': timestamp, 'flinkEmit': NULL::BIGINT, 'flinkRead': NULL::BIGINT, 'ingestTime': ingestTime},
      'vehicleId': vehicleId, 'zoneId': zoneId, 'zoneKind': zoneKind, 'zoneName': zoneName})::VARCHAR) AS event
  FROM ranked WHERE rn <= 5 GROUP BY vehicleId, seq, zoneId)
SELECT vehicleId, seq, zoneId, concat('Breach event:', chr(10), event, chr(10), chr(10), CASE WHEN n > 0
  THEN concat('Vehicle history (', n, ' prior record(s), newest last):', chr(10), lines) ELSE 'Vehicle history: none on record.' END) AS request
FROM gathered"""


@plan("h18_requests", S.with_(*S.SEED_BREACHES, BASELINE_SQL, _HISTORY_SQL, select=_JSON_SQL))
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request texts with history.  Coordinates are rounded, as engines print the last digit of a double differently."""
    found = materialize(seed_breaches(spark, sf_dir))
    joined = ops.with_history(found, baseline_history(found)).withColumn(
        "location",
        F.struct(*[F.round(f"location.{c}", 4).alias(c) for c in ("latitude", "longitude")], F.col("location.accuracy").alias("accuracy")),
    )
    event = [f.name for f in BREACH if f.name != "vehicle"]
    return ops.request_texts(joined, event).select("vehicleId", "seq", "zoneId", "request")


_QUERY_VECTOR = [1.0 if i % 2 == 0 else -1.0 for i in range(64)]


@plan(
    "f2_similar_history",
    """
WITH q AS (SELECT list_transform(range(64), lambda i: CASE WHEN i % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS v),
scored AS (
  SELECT label, vec_id, list_dot_product(embedding::DOUBLE[], v) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))
    * sqrt(list_dot_product(v, v))) AS s FROM embeddings, q
)
SELECT label, vec_id, round(s, 6) AS similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= 5""",
)
def similar_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stored items of every owner nearest to one query vector."""
    stored = tb.read_table(spark, sf_dir, "embeddings")
    found = ops.similar_history(stored, _QUERY_VECTOR, "label", "embedding", "vec_id", 5)
    return found.withColumn("similarity", F.round("similarity", 6))


@plan(
    "f2_similar_to_each",
    """
WITH scored AS (
  SELECT a.vec_id AS ask_id, h.label, h.vec_id, round(list_dot_product(a.embedding::DOUBLE[], h.embedding::DOUBLE[])
    / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(h.embedding::DOUBLE[], h.embedding::DOUBLE[]))), 9) AS s
  FROM embeddings a JOIN embeddings h ON a.label = h.label WHERE a.vec_id % 20 = 0
)
SELECT ask_id, label, vec_id, round(s, 6) AS similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ask_id ORDER BY s DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= 5""",
)
def similar_to_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stored items of the same owner nearest to each twentieth item, compared with all of them."""
    stored = tb.read_table(spark, sf_dir, "embeddings")
    asked = stored.where("vec_id % 20 = 0").select(F.col("vec_id").alias("ask_id"), "label", "embedding")
    found = ops.similar_to_each(asked, stored, "label", "embedding", "vec_id", 5)
    return found.withColumn("similarity", F.round("similarity", 6))
