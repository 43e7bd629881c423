"""Parsing, validation, stream health."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions import quality as Q
from zonewise.operators import quality as ops
from zonewise.plans import sql as S
from zonewise.plans.detection import seed_breaches
from zonewise.plans.registry import plan
from zonewise.schemas import BREACH, TELEMETRY
from zonewise.session import shared_dir
from zonewise.sources import streams
from zonewise.sources import tables as tb


def _message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry as JSON lines, with ``seq`` beside them."""
    fields = ", ".join(f.name for f in TELEMETRY)
    return tb.telemetry(spark, sf_dir).selectExpr("seq", "vehicleId", f"to_json(struct({fields})) AS raw")


@plan(
    "a1_telemetry",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT vehicleId, seq, timestamp, ingestTime, lat, lon, round(accuracy, 6) AS accuracy, round(speed, 6) AS speed,
  ignition, doorOpen, round(fuelLevel, 6) AS fuelLevel FROM telemetry""",
    ),
)
def telemetry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines back to typed columns."""
    good, _ = ops.split_poison(ops.parse_telemetry(_message_json(spark, sf_dir).select("raw")))
    return good.selectExpr(
        "vehicleId",
        "seq",
        "timestamp",
        "ingestTime",
        "location.latitude AS lat",
        "location.longitude AS lon",
        "round(location.accuracy, 6) AS accuracy",
        "round(location.speed, 6) AS speed",
        "vss.`vehicle.ignition` AS ignition",
        "vss.`vehicle.cabin.door.row1.left.isOpen` AS doorOpen",
        "round(vss.`vehicle.fuel.level`, 6) AS fuelLevel",
    )


_WINDOW = (1704067200000 + 5 * 86_400_000, 1704067200000 + 12 * 86_400_000)


@plan(
    "a6_window_read",
    S.with_(
        S.TELEMETRY,
        select=f"""
SELECT vehicleId, seq, ingestTime FROM telemetry WHERE ingestTime >= {_WINDOW[0]} AND ingestTime < {_WINDOW[1]}""",
    ),
)
def window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One week of arrivals: the bounded read of a verification window, from a table laid out by time."""
    folder = f"{shared_dir(spark)}/arrivals-{uuid.uuid4()}"
    rows = tb.telemetry(spark, sf_dir).select("vehicleId", "seq", "ingestTime")
    streams.write_by_time(rows, "ingestTime", folder)
    return streams.stored_window(spark, folder, "ingestTime", *_WINDOW)


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines some of which are broken in the ways the parser must survive."""
    return tb.telemetry(spark, sf_dir).selectExpr(
        "seq",
        """CASE seq % 23
          WHEN 0 THEN '{not valid json'
          WHEN 1 THEN '[1, 2, 3]'
          WHEN 2 THEN to_json(struct(timestamp, location))
          WHEN 3 THEN to_json(struct(vehicleId, timestamp))
          WHEN 4 THEN concat('{"vehicleId":"', vehicleId, '","location":{"latitude":"north","longitude":', location.longitude, '}}')
          WHEN 5 THEN concat('{"vehicleId":"', vehicleId, '","location":{"latitude":"', location.latitude, '","longitude":', location.longitude, '}}')
          WHEN 6 THEN concat('{"vehicleId":0,"location":{"latitude":', location.latitude, ',"longitude":', location.longitude, '}}')
          WHEN 7 THEN concat('{"vehicleId":"', vehicleId, '","location":{"latitude":null,"longitude":1}}')
          WHEN 8 THEN concat('{"vehicleId":', seq, ',"vss":null,"location":{"latitude":', location.latitude, ',"longitude":', location.longitude, '}}')
          ELSE to_json(struct(vehicleId, timestamp, location, vss)) END AS raw""",
    )


_DAMAGE_SQL = """
parsed AS (
  SELECT seq, CASE seq % 23 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'not_object' WHEN 2 THEN 'missing_vehicle'
    WHEN 3 THEN 'missing_location' WHEN 4 THEN 'bad_coordinate' WHEN 6 THEN 'missing_vehicle'
    WHEN 7 THEN 'missing_location' END AS poison_reason,
    CASE WHEN seq % 23 IN (0, 1, 2) THEN NULL WHEN seq % 23 = 6 THEN '0' WHEN seq % 23 = 8 THEN cast(seq AS varchar)
      ELSE vehicleId END AS vehicleId,
    CASE WHEN seq % 23 IN (0, 1, 3, 4, 7) THEN NULL ELSE lat END AS lat
  FROM telemetry
)"""


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = _damaged(spark, sf_dir).withColumnRenamed("seq", "row_seq")
    return ops.parse_telemetry(damaged).drop("seq").withColumnRenamed("row_seq", "seq")


@plan("b2_poison_split", S.with_(S.TELEMETRY, _DAMAGE_SQL, select="SELECT * FROM parsed"))
def poison_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).selectExpr("seq", "poison_reason", "vehicleId", "location.latitude AS lat")


@plan(
    "b3_poison_counts",
    S.with_(
        S.TELEMETRY,
        _DAMAGE_SQL,
        select="""
SELECT poison_reason, count(*) AS dropped FROM parsed WHERE poison_reason IS NOT NULL GROUP BY poison_reason""",
    ),
)
def poison_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.poison_counts(_parsed(spark, sf_dir))


@plan(
    "d7_dropped_total",
    S.with_(S.TELEMETRY, _DAMAGE_SQL, select="SELECT count(poison_reason) AS dropped, count(*) AS read FROM parsed"),
)
def dropped_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).agg(
        F.count("poison_reason").alias("dropped"), F.count(F.lit(1)).alias("read")
    )


@plan(
    "a13_dead_letters",
    S.with_(
        S.TELEMETRY,
        _DAMAGE_SQL,
        select="SELECT seq, concat('telemetry-', poison_reason) AS queue FROM parsed WHERE poison_reason IS NOT NULL",
    ),
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = ops.split_poison(_parsed(spark, sf_dir))
    return bad.select("seq", F.concat(F.lit("telemetry-"), "poison_reason").alias("queue"))


@plan(
    "b1_ingest_stamp",
    S.with_(S.TELEMETRY, select="SELECT vehicleId, seq, ingestTime FROM telemetry"),
)
def ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp from a given column; without one it is the current time."""
    stamped = tb.telemetry(spark, sf_dir).withColumnRenamed("ingestTime", "brokerTime")
    return tb.with_ingest_time(stamped, "brokerTime").select("vehicleId", "seq", "ingestTime")


@plan(
    "b4_message_errors",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT seq, CASE seq % 11
  WHEN 0 THEN 'message /location/latitude must be <= 90'
  WHEN 1 THEN 'message /location/longitude must be >= -180'
  WHEN 2 THEN 'message /timestamp must be integer'
  WHEN 3 THEN 'message /vehicleId must NOT have fewer than 1 characters'
  WHEN 4 THEN 'message / must have required property ''deviceInfo'''
  WHEN 5 THEN 'message /location must have required property ''accuracy'''
  WHEN 6 THEN 'message / must have required property ''vss'';message /geoFenceId must be string'
  ELSE '' END AS errors, CASE WHEN seq % 11 = 6 THEN 2 WHEN seq % 11 < 6 THEN 1 ELSE 0 END AS n
FROM telemetry""",
    ),
)
def message_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = "telemetry, routeInfo"
    damaged = tb.telemetry(spark, sf_dir).selectExpr(
        "seq",
        f"""CASE seq % 11
          WHEN 0 THEN to_json(struct(vehicleId, geoFenceId, timestamp,
            struct(location.latitude + 60 AS latitude, location.longitude, location.altitude, location.heading,
                   location.speed, location.accuracy) AS location, vss, deviceInfo, {rest}))
          WHEN 1 THEN to_json(struct(vehicleId, geoFenceId, timestamp,
            struct(location.latitude, location.longitude - 100 AS longitude, location.altitude, location.heading,
                   location.speed, location.accuracy) AS location, vss, deviceInfo, {rest}))
          WHEN 2 THEN to_json(struct(vehicleId, geoFenceId, timestamp + 0.5D AS timestamp, location, vss, deviceInfo, {rest}))
          WHEN 3 THEN to_json(struct('' AS vehicleId, geoFenceId, timestamp, location, vss, deviceInfo, {rest}))
          WHEN 4 THEN to_json(struct(vehicleId, geoFenceId, timestamp, location, vss, {rest}))
          WHEN 5 THEN to_json(struct(vehicleId, geoFenceId, timestamp,
            struct(location.latitude, location.longitude, location.altitude, location.heading, location.speed)
              AS location, vss, deviceInfo, {rest}))
          WHEN 6 THEN to_json(struct(vehicleId, 7 AS geoFenceId, timestamp, location, deviceInfo, {rest}))
          ELSE to_json(struct(vehicleId, geoFenceId, timestamp, location, vss, deviceInfo, {rest})) END AS raw""",
    )
    checked = damaged.select("seq", F.try_parse_json(F.col("raw")).alias("message"))
    return checked.select("seq", Q.message_errors("message").alias("errors")).select(
        "seq", F.array_join("errors", ";").alias("errors"), F.size("errors").alias("n")
    )


@plan(
    "b5_zone_errors",
    S.with_(
        S.SUPPLIER_SITES,
        select="""
, made AS (
  SELECT zoneId, CASE cast(substr(zoneId, 6) AS bigint) % 4 WHEN 1 THEN polygon[1:6] WHEN 2 THEN polygon[1:3]
    WHEN 3 THEN list_transform(polygon, lambda p: [p[1] + 45, p[2]]) ELSE polygon END AS polygon FROM all_zones)
SELECT zoneId, (len(polygon) < 4) AS too_short, (polygon[1] <> polygon[len(polygon)]) AS open_ring,
  len(list_filter(polygon, lambda p: p[1] > 90))::INTEGER AS out_of_range FROM made""",
    ),
)
def zone_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = tb.supplier_zones(spark, sf_dir).selectExpr(
        "id",
        """CASE bigint(substr(id, 6)) % 4 WHEN 1 THEN slice(polygon, 1, 6) WHEN 2 THEN slice(polygon, 1, 3)
             WHEN 3 THEN transform(polygon, p -> array(p[0] + 45, p[1])) ELSE polygon END AS polygon""",
    )
    return made.select("id", Q.zone_errors("id", "polygon").alias("errors")).selectExpr(
        "id AS zoneId",
        "exists(errors, e -> e LIKE '%needs >= 4 points%') AS too_short",
        "exists(errors, e -> e LIKE '%ring is not closed') AS open_ring",
        "size(filter(errors, e -> e LIKE '%point out of range%')) AS out_of_range",
    )


@plan(
    "b6_route_errors",
    """
SELECT s_suppkey AS suppkey, CASE WHEN s_suppkey % 4 < 2 THEN concat(s_name, ': route needs >= 2 waypoints') ELSE '' END
  AS errors FROM supplier""",
)
def route_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths along the fences of sites, cut after none to three of their corners."""
    routes = tb.supplier_zones(spark, sf_dir).selectExpr(
        "bigint(substring(id, 6)) AS suppkey", "name", "slice(polygon, 1, int(bigint(substring(id, 6)) % 4)) AS waypoints"
    )
    return routes.select("suppkey", F.array_join(Q.route_errors("name", "waypoints"), ";").alias("errors"))


@plan(
    "b17_fact_only",
    S.with_(
        *S.SEED_BREACHES,
        select="""
SELECT zoneId, count(*) AS events, count(*) FILTER (WHERE seq % 5 <> 0) AS factual FROM breaches GROUP BY zoneId""",
    ),
)
def fact_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breach events as JSON; every fifth position's event carries a judgement it must not have."""
    fields = ", ".join(f.name for f in BREACH)
    keep = "map('ignoreNullFields', 'false')"
    events = seed_breaches(spark, sf_dir).selectExpr(
        "zoneId",
        f"""if(seq % 5 = 0, to_json(struct({fields}, 'HIGH' AS severity), {keep}), to_json(struct({fields}), {keep}))
            AS event""",
    )
    return events.groupBy("zoneId").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(Q.is_fact_only("event")).alias("factual")
    )


@plan(
    "b18_field_presence",
    S.with_(S.TELEMETRY, select="SELECT vehicleId, count(*) AS complete FROM telemetry GROUP BY vehicleId"),
)
def field_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _message_json(spark, sf_dir)
    return messages.groupBy("vehicleId").agg(F.count_if(Q.is_complete_message("raw")).alias("complete"))


# Arrival order with every seventh position delivered after a later one of its vehicle.
_SHUFFLED = "seq + if(seq % 7 = 0, 3000, 0)"
_LATE_SQL = """
late AS (
  SELECT *, timestamp < lag(timestamp) OVER (PARTITION BY vehicleId ORDER BY arrival) AS is_late
  FROM (SELECT *, seq + CASE WHEN seq % 7 = 0 THEN 3000 ELSE 0 END AS arrival FROM telemetry)
)"""


def _shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tb.telemetry(spark, sf_dir)
        .withColumn("event_seq", F.col("seq"))
        .withColumn("seq", F.expr(f"({_SHUFFLED}) * 2 + if(event_seq % 7 = 0, 1, 0)"))
    )


@plan(
    "e3_out_of_order",
    S.with_(
        S.TELEMETRY,
        _LATE_SQL.replace("ORDER BY arrival", "ORDER BY arrival * 2 + CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END"),
        select="SELECT vehicleId, seq, timestamp FROM late WHERE is_late",
    ),
)
def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = ops.out_of_order(_shuffled(spark, sf_dir).select("vehicleId", "seq", "event_seq", "timestamp"))
    return late.selectExpr("vehicleId", "event_seq AS seq", "timestamp")


@plan(
    "d6_stream_health",
    S.with_(
        S.TELEMETRY,
        _LATE_SQL.replace("ORDER BY arrival", "ORDER BY arrival * 2 + CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END"),
        select="""
SELECT count(*) AS records, count(DISTINCT vehicleId) AS vehicles, max(ingestTime - timestamp) / 1000 AS max_latency_s,
  cast(count(*) FILTER (WHERE is_late) AS bigint) AS out_of_order,
  CASE WHEN count(*) > 0 AND max(ingestTime - timestamp) / 1000 < 5 AND count(*) FILTER (WHERE is_late) = 0
    THEN 'PASS' ELSE 'FAIL' END AS result FROM late""",
    ),
)
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stream_health(_shuffled(spark, sf_dir), "ingestTime")


@plan(
    "c8_reconcile",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT vehicleId, count(*) AS published,
  cast(count(*) FILTER (WHERE seq % 31 <> 0) + count(*) FILTER (WHERE seq % 31 <> 0 AND seq % 37 = 0) AS bigint) AS received,
  count(*) FILTER (WHERE seq % 31 <> 0 AND seq % 37 = 0) AS duplicates,
  count(*) FILTER (WHERE seq % 31 = 0) AS drops
FROM telemetry GROUP BY vehicleId""",
    ),
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The received side lost every 31st message and got every 37th twice."""
    sent = tb.telemetry(spark, sf_dir).select("vehicleId", "seq")
    copies = F.expr("explode(sequence(1, if(seq % 31 = 0, 0, if(seq % 37 = 0, 2, 1)), 1))")
    received = sent.where("seq % 31 <> 0").withColumn("copy", copies)
    return ops.reconcile(sent, received)


@plan(
    "d15_batch_failures",
    S.with_(
        S.TELEMETRY,
        _DAMAGE_SQL,
        select="""
SELECT seq // 10 AS batch, count(*) FILTER (WHERE poison_reason IS NOT NULL AND seq % 29 <> 0)::INTEGER AS failed,
  coalesce(string_agg(concat('rec-', lpad(cast(seq AS varchar), 12, '0')), ',' ORDER BY seq)
    FILTER (WHERE poison_reason IS NOT NULL AND seq % 29 <> 0), '') AS items
FROM parsed GROUP BY seq // 10""",
    ),
)
def batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parsed(spark, sf_dir).selectExpr(
        "seq div 10 AS batch",
        "if(seq % 29 <> 0, concat('rec-', lpad(string(seq), 12, '0')), null) AS item",
        "poison_reason IS NOT NULL AS failed",
    )
    return ops.batch_failures(rows, "batch", "item", "failed").selectExpr(
        "batch", "size(batchItemFailures) AS failed", "array_join(batchItemFailures, ',') AS items"
    )
