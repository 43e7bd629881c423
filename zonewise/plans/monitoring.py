"""Latency per hop, statistics per minute, alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions import latency as L
from zonewise.operators import monitoring as ops
from zonewise.operators.quality import POISON_REASONS, split_poison
from zonewise.plans import sql as S
from zonewise.plans.quality import _DAMAGE_SQL, _parsed
from zonewise.plans.registry import plan
from zonewise.sources import tables as tb
from zonewise.sources.fixed import ALARM_RULES

# The arrival on the stream lies between ingest and read.
_ARRIVAL = "ingestTime + 5 + seq % 7"


def _traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.telemetry(spark, sf_dir).selectExpr(
        "vehicleId",
        "seq",
        "timestamp",
        "struct(timestamp AS eventTime, ingestTime, flinkRead, flinkEmit) AS trace",
        f"{_ARRIVAL} AS streamArrival",
        "alertsArrival",
        "value",
    )


HOPS_SQL = f"""
hops AS (
  SELECT vehicleId, seq, timestamp, alertsArrival, unnest(['SourceToIoT', 'StreamWait', 'FlinkProcess', 'DetectionTotal']) AS hop,
    unnest([ingestTime - timestamp, flinkRead - ({_ARRIVAL}), flinkEmit - flinkRead, flinkEmit - timestamp]) AS ms
  FROM telemetry
)"""
PROBE_SQL = """
hops AS (
  SELECT vehicleId, seq, unnest(['SourceToIoT', 'IngestToFlink', 'FlinkProcess', 'FlinkToAlerts']) AS hop,
    unnest([ingestTime - timestamp, flinkRead - ingestTime, flinkEmit - flinkRead, alertsArrival - flinkEmit]) AS ms
  FROM telemetry
)"""


@plan("h19_hops", S.with_(S.TELEMETRY, HOPS_SQL, select="SELECT vehicleId, seq, hop, ms FROM hops WHERE ms IS NOT NULL"))
def hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.detection_hops(F.col("trace"), F.col("streamArrival"))
    return ops.hop_rows(_traced(spark, sf_dir), found, "vehicleId", "seq")


@plan(
    "h20_probe_hops",
    S.with_(S.TELEMETRY, PROBE_SQL, select="SELECT vehicleId, seq, hop, ms FROM hops WHERE ms IS NOT NULL"),
)
def probe_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.hop_rows(
        _traced(spark, sf_dir), L.probe_hops(F.col("trace"), F.col("alertsArrival")), "vehicleId", "seq"
    )


@plan("h21_probe_total", S.with_(S.TELEMETRY, select="SELECT seq, alertsArrival - timestamp AS total_ms FROM telemetry"))
def probe_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = L.probe_total(F.col("trace"), F.col("alertsArrival"))
    return _traced(spark, sf_dir).select("seq", total.alias("total_ms"))


@plan(
    "h22_processor_metrics",
    S.with_(
        S.TELEMETRY,
        HOPS_SQL,
        select="""
SELECT seq, hop, ms FROM hops WHERE ms IS NOT NULL AND hop IN ('StreamWait', 'FlinkProcess')""",
    ),
)
def processor_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.processor_metrics(L.detection_hops(F.col("trace"), F.col("streamArrival")))
    return ops.hop_rows(_traced(spark, sf_dir), found, "seq")


_TRIAGE_STAMPS = [
    "alertsArrival + 5 AS analyzerRead",
    "if(seq % 11 = 0, null, alertsArrival + 200 + seq % 500) AS bedrockDone",
    "alertsArrival + 210 + seq % 500 AS sqsEnqueue",
    "alertsArrival + 900 AS publisherRead",
    "alertsArrival + 930 + seq % 60 AS snsPublish",
]


def _triage_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later stamps: analyzer and publisher; some are missing."""
    return tb.telemetry(spark, sf_dir).selectExpr("seq", *_TRIAGE_STAMPS)


def _with_triage(traced: DataFrame) -> DataFrame:
    return traced.selectExpr("*", *_TRIAGE_STAMPS)


TRIAGE_HOPS_SQL = """
triage_hops AS (
  SELECT seq, alertsArrival, unnest(['TriageBedrock', 'SqsEnqueue', 'NotifyTotal']) AS hop,
    unnest([CASE WHEN seq % 11 <> 0 THEN 195 + seq % 500 END, CASE WHEN seq % 11 <> 0 THEN 10 END, 30 + seq % 60]) AS ms
  FROM telemetry
)"""


@plan(
    "h23_triage_hops",
    S.with_(S.TELEMETRY, TRIAGE_HOPS_SQL, select="SELECT seq, hop, ms FROM triage_hops WHERE ms IS NOT NULL"),
)
def triage_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = _triage_stamps(spark, sf_dir)
    columns = {c: F.col(c) for c in stamps.columns}
    return ops.hop_rows(stamps, L.hop_map(columns, L.ANALYZER_HOPS | L.PUBLISHER_HOPS), "seq")


@plan(
    "h24_metric_documents",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT seq, CASE WHEN seq % 11 = 0 THEN '' ELSE 'TriageBedrock,SqsEnqueue' END AS metrics, 'analyzer' AS stage,
  'Geofence/Latency' AS namespace, alertsArrival + 210 + seq % 500 AS ts,
  CASE WHEN seq % 11 <> 0 THEN 195 + seq % 500 END AS TriageBedrock FROM telemetry""",
    ),
)
def metric_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric log lines of the analyzer, read back field by field."""
    return _documents(_triage_stamps(spark, sf_dir), "analyzer", L.ANALYZER_HOPS, "sqsEnqueue", "TriageBedrock")


@plan(
    "h24_publisher_documents",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT seq, 'NotifyTotal' AS metrics, 'publisher' AS stage, 'Geofence/Latency' AS namespace,
  alertsArrival + 930 + seq % 60 AS ts, 30 + seq % 60 AS NotifyTotal FROM telemetry""",
    ),
)
def publisher_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the publisher."""
    return _documents(_triage_stamps(spark, sf_dir), "publisher", L.PUBLISHER_HOPS, "snsPublish", "NotifyTotal")


def _documents(stamps: DataFrame, stage: str, table: dict, ts: str, metric: str) -> DataFrame:
    hops = L.hop_map({c: F.col(c) for c in stamps.columns}, table)
    lines = stamps.select("seq", L.metric_document(hops, F.lit(stage), F.col(ts)).alias("line"))
    head = "get_json_object(line, '$._aws.CloudWatchMetrics[0]"
    names = f"from_json({head}.Metrics'), 'array<struct<Name:string,Unit:string>>')"
    return lines.selectExpr(
        "seq",
        f"array_join(transform({names}, m -> m.Name), ',') AS metrics",
        "get_json_object(line, '$.stage') AS stage",
        f"{head}.Namespace') AS namespace",
        "bigint(get_json_object(line, '$._aws.Timestamp')) AS ts",
        f"bigint(get_json_object(line, '$.{metric}')) AS {metric}",
    )


@plan(
    "b15_stamped_trace",
    S.with_(S.TELEMETRY, select="SELECT seq, timestamp AS eventTime, flinkRead, flinkEmit FROM telemetry"),
)
def stamped_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.telemetry(spark, sf_dir).selectExpr(
        "seq",
        "struct(timestamp AS eventTime, ingestTime) AS trace",
        "flinkRead AS read",
        "flinkEmit AS emit",
    )
    return rows.select("seq", L.stamp(F.col("trace"), F.col("read"), F.col("emit")).alias("t")).select(
        "seq", "t.eventTime", "t.flinkRead", "t.flinkEmit"
    )


@plan(
    "d4_hop_means",
    S.with_(
        S.TELEMETRY, PROBE_SQL, select="SELECT hop, round(avg(ms), 6) AS mean_ms FROM hops WHERE ms IS NOT NULL GROUP BY hop"
    ),
)
def hop_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.hop_rows(_traced(spark, sf_dir), L.probe_hops(F.col("trace"), F.col("alertsArrival")))
    return ops.hop_means(rows).withColumn("mean_ms", F.round("mean_ms", 6))


@plan(
    "d5_mean_total",
    S.with_(
        S.TELEMETRY, select="SELECT round(coalesce(avg(alertsArrival - timestamp), 0), 6) AS mean_total_ms FROM telemetry"
    ),
)
def mean_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _traced(spark, sf_dir).select(L.probe_total(F.col("trace"), F.col("alertsArrival")).alias("total"))
    return ops.mean_total(totals, "total").withColumn("mean_total_ms", F.round("mean_total_ms", 6))


# ---------------------------------------------------------------- metrics

_METRICS_SQL = f"""
metrics AS (
  SELECT alertsArrival AS ts, 'detection' AS stage, hop AS name, ms AS value FROM hops WHERE ms IS NOT NULL
  UNION ALL
  SELECT alertsArrival, CASE WHEN hop = 'NotifyTotal' THEN 'publisher' ELSE 'analyzer' END, hop, ms
  FROM triage_hops WHERE ms IS NOT NULL
  UNION ALL
  SELECT alertsArrival, unnest(['vehicle-telemetry', 'geofence-processor', 'geofence-processor', 'geofence-processor', 'vehicle-telemetry']),
    unnest(['GetRecords.IteratorAgeMilliseconds', 'millisBehindLatest', 'backPressuredTimeMsPerSecond',
            'numberOfFailedCheckpoints', 'WriteProvisionedThroughputExceeded']),
    unnest([floor(value * 200)::BIGINT, floor(value * 150)::BIGINT, floor(value * 2)::BIGINT,
            CASE WHEN seq % 97 = 0 THEN 1 ELSE 0 END, CASE WHEN seq % 89 = 0 THEN 1 ELSE 0 END])
  FROM telemetry
)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hops of both tracks and the processor's own signals in one long table, from one pass over the positions."""
    traced = _with_triage(_traced(spark, sf_dir))
    stamps = {c: F.col(c) for c in traced.columns}
    hops = L.detection_hops(F.col("trace"), F.col("streamArrival"))
    tracks = [("detection", hops), ("analyzer", L.hop_map(stamps, L.ANALYZER_HOPS)), ("publisher", L.hop_map(stamps, L.PUBLISHER_HOPS))]
    signals = F.expr("""array(
          struct('vehicle-telemetry' AS stage, 'GetRecords.IteratorAgeMilliseconds' AS name, floor(value * 200) AS value),
          struct('geofence-processor' AS stage, 'millisBehindLatest' AS name, floor(value * 150) AS value),
          struct('geofence-processor' AS stage, 'backPressuredTimeMsPerSecond' AS name, floor(value * 2) AS value),
          struct('geofence-processor' AS stage, 'numberOfFailedCheckpoints' AS name, if(seq % 97 = 0, 1L, 0L) AS value),
          struct('vehicle-telemetry' AS stage, 'WriteProvisionedThroughputExceeded' AS name, if(seq % 89 = 0, 1L, 0L) AS value)
        )""")
    return ops.metric_rows(traced, F.col("alertsArrival"), tracks, signals)


_STATS_SQL = """
stats AS (
  SELECT ts // 60000 * 60000 AS minute, stage, name, max(value) AS max, cast(sum(value) AS bigint) AS sum,
    quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.99) AS p99
  FROM metrics GROUP BY ALL
)"""


@plan(
    "d9_minute_stats",
    S.with_(
        S.TELEMETRY,
        HOPS_SQL,
        TRIAGE_HOPS_SQL,
        _METRICS_SQL,
        _STATS_SQL,
        select="SELECT minute, stage, name, max, sum, round(p50, 6) AS p50, round(p99, 6) AS p99 FROM stats",
    ),
)
def minute_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = ops.minute_stats(metrics(spark, sf_dir))
    return stats.withColumn("p50", F.round("p50", 6)).withColumn("p99", F.round("p99", 6))


_LAYERS = ["FlinkProcess", "DetectionTotal", "TriageBedrock", "NotifyTotal"]


@plan(
    "d10_hop_percentiles",
    S.with_(
        S.TELEMETRY,
        HOPS_SQL,
        TRIAGE_HOPS_SQL,
        _METRICS_SQL,
        select="SELECT ts // 60000 * 60000 AS minute, stage, "
        + ", ".join(
            f"round(quantile_cont(value, {q}) FILTER (WHERE name = '{hop}'), 6) AS {hop}_p{round(q * 100)}"
            for hop in _LAYERS
            for q in (0.5, 0.99)
        )
        + " FROM metrics WHERE stage IN ('detection', 'analyzer', 'publisher') GROUP BY ALL",
    ),
)
def hop_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = metrics(spark, sf_dir).where(F.col("stage").isin("detection", "analyzer", "publisher"))
    table = ops.hop_percentiles(tracks, _LAYERS)
    kept = ("minute", "stage")
    return table.select(*kept, *[F.round(c, 6).alias(c) for c in table.columns if c not in kept])


_RULES_SQL = "rules AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', '{n}', '{d}', '{s}', '{c}', {t}::DOUBLE)" for a, n, d, s, c, t in ALARM_RULES
) + ") AS v(alarm, name, stage, statistic, comparison, threshold))"


@plan(
    "d11_alarms",
    S.with_(
        S.TELEMETRY,
        HOPS_SQL,
        TRIAGE_HOPS_SQL,
        _METRICS_SQL,
        _STATS_SQL,
        _RULES_SQL,
        select="""
, judged AS (
  SELECT m.minute, r.alarm, r.comparison, r.threshold,
    CASE r.statistic WHEN 'max' THEN s.max::DOUBLE WHEN 'sum' THEN s.sum::DOUBLE ELSE s.p99 END AS value
  FROM (SELECT DISTINCT minute FROM stats) m CROSS JOIN rules r
  LEFT JOIN stats s ON s.minute = m.minute AND s.stage = r.stage AND s.name = r.name)
SELECT minute, alarm, round(value, 6) AS value, CASE WHEN (comparison = 'GT' AND value > threshold)
  OR (comparison = 'GE' AND value >= threshold) THEN 'ALARM' ELSE 'OK' END AS state FROM judged""",
    ),
)
def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = ops.minute_stats(metrics(spark, sf_dir))
    return ops.alarms(stats).withColumn("value", F.round("value", 6))


@plan(
    "d12_iterator_age",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT minute, 'vehicle-telemetry' AS stream, max(age) AS max_age FROM (
  SELECT timestamp // 60000 * 60000 AS minute, substr(vehicleId, 9, 1) AS shard, max(floor(value * 200)::BIGINT) AS age
  FROM telemetry GROUP BY 1, 2) GROUP BY minute""",
    ),
)
def iterator_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = _traced(spark, sf_dir).selectExpr(
        "timestamp AS ts",
        "'vehicle-telemetry' AS stream",
        "substr(vehicleId, 9, 1) AS shard",
        "floor(value * 200) AS age",
    )
    return ops.iterator_age(progress)


@plan(
    "d13_dead_letter_depth",
    S.with_(
        S.TELEMETRY,
        _DAMAGE_SQL,
        select="""
SELECT queue, count(poison_reason) AS depth, CASE WHEN count(poison_reason) >= 1 THEN 'ALARM' ELSE 'OK' END AS state
FROM (SELECT unnest(['telemetry-undecodable', 'telemetry-not_object', 'telemetry-missing_vehicle', 'telemetry-missing_location',
  'telemetry-bad_coordinate', 'alert-delivery']) AS queue)
LEFT JOIN parsed ON queue = concat('telemetry-', poison_reason) GROUP BY queue""",
    ),
)
def dead_letter_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_poison(_parsed(spark, sf_dir))
    letters = bad.select(F.concat(F.lit("telemetry-"), "poison_reason").alias("queue"))
    return ops.queue_depth(letters, [*[f"telemetry-{r}" for r in POISON_REASONS], "alert-delivery"])
