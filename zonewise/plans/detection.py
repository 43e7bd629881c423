"""Containment, crossings and breaches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.functions import geometry as G
from zonewise.operators import crossings as X
from zonewise.operators.ordered import ARRIVALS_PER_SEGMENT, span_segment
from zonewise.operators.zones import zone_versions
from zonewise.plans import sql as S
from zonewise.plans.registry import plan
from zonewise.session import shared_dir, table_path
from zonewise.sources import tables as tb
from zonewise.sources.fixed import seed_zones
from zonewise.sources.streams import read_files
from zonewise.streaming.breaches import BreachDetector

#: The streaming query runs over the events in so many pieces, and takes so many files in one micro-batch.
STREAM_BATCHES, STREAM_FILES = 3, 8


def flat_breaches(found: DataFrame) -> DataFrame:
    return found.select(
        "vehicleId",
        "seq",
        "zoneId",
        "zoneName",
        "zoneKind",
        "breachType",
        "timestamp",
        F.col("location.latitude").alias("lat"),
        F.col("location.longitude").alias("lon"),
        F.round("location.accuracy", 6).alias("accuracy"),
        "distanceOutsideM",
        "durationInStateS",
    )


_FLAT_SQL = """
SELECT vehicleId, seq, zoneId, zoneName, zoneKind, breachType, timestamp, lat, lon,
  round(accuracy, 6) AS accuracy, distanceOutsideM, durationInStateS FROM breaches"""


def seed_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.breaches(tb.telemetry(spark, sf_dir), seed_zones(spark))


@plan("b10_breaches", S.with_(*S.SEED_BREACHES, select=_FLAT_SQL))
def breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_breaches(seed_breaches(spark, sf_dir))


@plan(
    "b9_diagnostics",
    S.with_(
        *S.SEED_BREACHES,
        select="""
SELECT vehicleId, seq, zoneId, round(speed, 6) AS speed, ignition, round(fuelLevel, 6) AS fuelLevel,
  CASE WHEN event_type = 'view' THEN 'park' ELSE 'drive' END AS gear,
  round(engineTemperature, 6) AS engineTemperature, 0.85::DOUBLE AS brakeFluidLevel, doorOpen FROM breaches""",
    ),
)
def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vehicle")
    return seed_breaches(spark, sf_dir).select(
        "vehicleId",
        "seq",
        "zoneId",
        F.round(v["speed"], 6).alias("speed"),
        v["ignition"].alias("ignition"),
        F.round(v["fuelLevel"], 6).alias("fuelLevel"),
        v["gear"].alias("gear"),
        F.round(v["engineTemperature"], 6).alias("engineTemperature"),
        v["brakeFluidLevel"].alias("brakeFluidLevel"),
        v["doorOpen"].alias("doorOpen"),
    )


@plan(
    "c1_inside_flags",
    S.with_(S.TELEMETRY, S.SEED, S.SEED_EDGES, S.FLAGS, select="SELECT vehicleId, seq, zoneId, inside FROM flags WHERE inside"),
)
def inside_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.inside_flags(tb.telemetry(spark, sf_dir), seed_zones(spark))


_EDGE_SQL = "SELECT vehicleId, seq, zoneId, zoneKind, edge FROM edges"


@plan("e1_edges", S.with_(S.TELEMETRY, S.SEED, S.SEED_EDGES, S.FLAGS, S.EDGES, select=_EDGE_SQL))
def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.edges(tb.telemetry(spark, sf_dir), seed_zones(spark))
    return found.select("vehicleId", "seq", "zoneId", "zoneKind", "edge")


@plan("c10_grid_edges", S.with_(S.TELEMETRY, S.SUPPLIER_SITES, S.SEED_EDGES, S.FLAGS, S.EDGES, select=_EDGE_SQL))
def grid_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.grid_edges(tb.telemetry(spark, sf_dir), tb.supplier_zones(spark, sf_dir), cell_deg=0.005)
    return found.select("vehicleId", "seq", "zoneId", "zoneKind", "edge")


@plan("c1_site_breaches", S.with_(*S.SITE_BREACHES, select=_FLAT_SQL))
def site_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_breaches(X.breaches(tb.telemetry(spark, sf_dir), tb.supplier_zones(spark, sf_dir)))


@plan(
    "b8_breach_kinds",
    S.with_(
        *S.SEED_BREACHES,
        select="SELECT zoneKind, breachType, count(*) AS breaches FROM breaches GROUP BY zoneKind, breachType",
    ),
)
def breach_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seed_breaches(spark, sf_dir)
    return found.groupBy("zoneKind", "breachType").agg(F.count(F.lit(1)).alias("breaches"))


@plan(
    "d8_breaches_per_vehicle",
    S.with_(*S.SEED_BREACHES, select="SELECT vehicleId, count(*) AS breaches FROM breaches GROUP BY vehicleId"),
)
def breaches_per_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_breaches(spark, sf_dir).groupBy("vehicleId").agg(F.count(F.lit(1)).alias("breaches"))


@plan(
    "h5_boundary_distance",
    S.with_(
        S.TELEMETRY,
        S.SEED,
        S.SEED_EDGES,
        S.FLAGS,
        select="SELECT vehicleId, seq, zoneId, round(distance, 3) AS distance_m FROM flags WHERE inside",
    ),
)
def boundary_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How deep inside its zone each contained position lies."""
    index = X.build_index(X.active_zones(seed_zones(spark)))
    positions = X.flat_positions(tb.telemetry(spark, sf_dir)).select("vehicleId", "seq", "lat", "lon")
    inside = X.inside_pairs(positions, index)
    distance = G.edges_distance_m("lat", "lon", "edges")
    return inside.select("vehicleId", "seq", "zoneId", F.round(distance, 3).alias("distance_m"))


@plan(
    "b16_co_partition",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT vehicleId, seq // 16777216 AS segment, count(*) AS positions, 1::BIGINT AS tasks FROM telemetry GROUP BY 1, 2""",
    ),
)
def co_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions of a vehicle's segment meet in one task."""
    placed = X.co_partition(tb.telemetry(spark, sf_dir).select("vehicleId", "seq")).select(
        "vehicleId", span_segment("seq", ARRIVALS_PER_SEGMENT).alias("segment"), F.spark_partition_id().alias("task")
    )
    per_task = placed.groupBy("vehicleId", "segment", "task").agg(F.count(F.lit(1)).alias("n"))
    return per_task.groupBy("vehicleId", "segment").agg(F.sum("n").alias("positions"), F.count(F.lit(1)).alias("tasks"))


@plan(
    "e2_edge_sequence",
    """
WITH bits AS (
  SELECT o_orderkey, i, (o_orderkey >> i) & 1 = 1 AS now
  FROM orders CROSS JOIN (SELECT unnest(range(0, 10)) AS i)
), steps AS (
  SELECT *, lag(now) OVER (PARTITION BY o_orderkey ORDER BY i) AS was FROM bits
)
SELECT o_orderkey, cast(i AS integer) AS at_index, CASE WHEN now THEN 'entry' ELSE 'exit' END AS edge
FROM steps WHERE was IS NOT NULL AND was <> now""",
)
def edge_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.transform(
        F.sequence(F.lit(0), F.lit(9)), lambda i: F.col("o_orderkey").bitwiseAND(F.pow(F.lit(2), i).cast("long")) != 0
    )
    return (
        tb.read_table(spark, sf_dir, "orders")
        .select("o_orderkey", flags.alias("flags"))
        .select("o_orderkey", F.explode(X.edges_of_sequence(F.col("flags"))).alias("e"))
        .select("o_orderkey", F.col("e.index").alias("at_index"), F.col("e.edge").alias("edge"))
    )


@plan(
    "e8_prior_state",
    S.with_(
        S.TELEMETRY,
        S.SEED,
        S.SEED_EDGES,
        S.FLAGS,
        S.EDGES,
        select="""
SELECT e.vehicleId, e.seq, e.zoneId, e.edge,
  (t.timestamp - lag(t.timestamp) OVER (PARTITION BY e.vehicleId, e.zoneId ORDER BY e.seq)) // 1000 AS priorStateS
FROM edges e JOIN telemetry t USING (vehicleId, seq)""",
    ),
)
def prior_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.edges(tb.telemetry(spark, sf_dir), seed_zones(spark))
    rows = found.select("vehicleId", "seq", "zoneId", "edge", "timestamp")
    return X.prior_state_duration(rows).drop("timestamp")


# ---------------------------------------------------------------- live-edited zones

_JUDGED = """
first_active AS (SELECT min(valid_from) AS f FROM versions WHERE active),
judged AS (
  SELECT *, greatest(pos, f) AS clock FROM (
    SELECT t.*, coalesce(ingestTime, timestamp) AS pos, f FROM telemetry t, first_active)
)"""

_VERSIONED = f"""
zone_edges AS (
  SELECT zoneId, valid_from, polygon[i][2] AS x1, polygon[i][1] AS y1, polygon[i + 1][2] AS x2, polygon[i + 1][1] AS y2
  FROM (SELECT *, unnest(range(1, len(polygon))) AS i FROM versions)
), candidates AS (
  SELECT j.*, v.zoneId, v.valid_from, v.zoneName, v.zoneKind
  FROM judged j JOIN versions v ON v.active AND j.clock >= v.valid_from AND j.clock < v.valid_to
), flags AS (
  SELECT vehicleId, seq, zoneId, any_value(clock) AS clock, any_value(zoneName) AS zoneName,
    any_value(zoneKind) AS zoneKind, any_value(timestamp) AS timestamp, {S.INSIDE} AS inside, {S.DISTANCE} AS distance
  FROM candidates c JOIN zone_edges z USING (zoneId, valid_from) GROUP BY vehicleId, seq, zoneId
), steps AS (
  SELECT *, lag(inside) OVER (PARTITION BY vehicleId, zoneId ORDER BY clock, seq) AS was FROM flags
), edges AS (
  SELECT *, CASE WHEN inside THEN 'entry' ELSE 'exit' END AS edge FROM steps WHERE was IS NOT NULL AND was <> inside
)"""

_VERSIONED_BREACHES = """
SELECT vehicleId, seq, zoneId, zoneName, zoneKind, edge AS breachType, timestamp,
  CASE WHEN inside THEN 0.0::DOUBLE ELSE round(distance, 1) END AS distanceOutsideM
FROM edges
WHERE (zoneKind = 'exclusion' AND edge = 'entry') OR (zoneKind = 'containment' AND edge = 'exit') OR zoneKind = 'dwell'"""


def _flat_versioned(found: DataFrame) -> DataFrame:
    return found.select(
        "vehicleId", "seq", "zoneId", "zoneName", "zoneKind", "breachType", "timestamp", "distanceOutsideM"
    )


@plan(
    "c2_breaches_versioned",
    S.with_(S.TELEMETRY, S.CHANGES, S.VERSIONS, _JUDGED, _VERSIONED, select=_VERSIONED_BREACHES),
)
def breaches_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = zone_versions(tb.order_changes(spark, sf_dir))
    return _flat_versioned(X.breaches_versioned(tb.telemetry(spark, sf_dir), versions))


@plan(
    "c3_stream_breaches",
    S.with_(S.TELEMETRY, S.CHANGES, S.VERSIONS, _JUDGED, _VERSIONED, select=_VERSIONED_BREACHES),
)
def stream_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``c2_breaches_versioned``, found by the streaming job over the same rows in several micro-batches."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4()}"
    events, orders = (tb.read_table(spark, sf_dir, name) for name in ("events", "orders"))
    # The positions come in order of time, as they would from a log.
    span = events.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("low"), F.unix_micros(F.max("ts").cast("timestamp")).alias("high")).first()
    clock = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = span["low"] or 0, span["high"] or 0
    cuts = [low + (high + 1 - low) * i // STREAM_BATCHES for i in range(STREAM_BATCHES + 1)]
    for start, end in zip(cuts, cuts[1:]):
        piece = events.where((clock >= start) & (clock < end)).repartition(STREAM_FILES, "user_id")
        piece.write.mode("append").parquet(f"{folder}/events")
    telemetry = tb.telemetry_of(read_files(spark, f"{folder}/events", events.schema, "parquet", max_files=STREAM_FILES))
    rules = tb.order_changes_of(read_files(spark, table_path(sf_dir, "orders").replace(".parquet", "*.parquet"), orders.schema, "parquet"))
    detector = BreachDetector(spark, f"{folder}/detector")
    for query in detector.start(telemetry, rules, availableNow=True):
        query.awaitTermination()
    return _flat_versioned(detector.breaches())


# The seed zones switched on ten days into the events: what came before waits for them.
_LATE_SEED = """
versions AS (
  SELECT zoneId, zoneName, zoneKind, polygon, 1704067200000 + 864000000::BIGINT AS valid_from,
    9223372036854775807 AS valid_to, true AS active FROM zones
)"""


def _late_seed(spark: SparkSession) -> DataFrame:
    start = F.lit(1704067200000 + 864_000_000).cast("long")
    changes = seed_zones(spark).select(
        F.lit("INSERT").alias("op"),
        "id",
        "active",
        "kind",
        "polygon",
        "properties",
        start.alias("updatedAt"),
        "name",
        F.lit(0).cast("long").alias("seq"),
    )
    return zone_versions(changes)


@plan(
    "i3_bootstrap_replay",
    S.with_(S.TELEMETRY, S.SEED, _LATE_SEED, _JUDGED, _VERSIONED, select=_VERSIONED_BREACHES),
)
def bootstrap_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_versioned(X.breaches_versioned(tb.telemetry(spark, sf_dir), _late_seed(spark)))


@plan(
    "f3_hold_cap",
    S.with_(
        S.TELEMETRY,
        S.SEED,
        _LATE_SEED,
        _JUDGED,
        select="SELECT vehicleId, seq, clock FROM judged WHERE pos < f",
    ),
)
def hold_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions held for the first zone: all of those before it."""
    start = 1704067200000 + 864_000_000
    positions = X.judged_positions(tb.telemetry(spark, sf_dir))
    early = positions.where(F.col("clock") < start)
    return X.hold_until(early, start).select("vehicleId", "seq", "clock")


# ---------------------------------------------------------------- movement


@plan(
    "h6_heading",
    S.with_(
        S.TELEMETRY,
        select="""
SELECT vehicleId, seq, round(((atan2(sin(dl) * cos(p2), cos(p1) * sin(p2) - sin(p1) * cos(p2) * cos(dl))
    * 180 / pi()) + 360) % 360, 4) AS heading
FROM (
  SELECT vehicleId, seq, radians(lat) AS p2, radians(lag(lat) OVER w) AS p1,
    radians(lon) - radians(lag(lon) OVER w) AS dl
  FROM telemetry WINDOW w AS (PARTITION BY vehicleId ORDER BY seq))
WHERE p1 IS NOT NULL""",
    ),
)
def heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = X.flat_positions(tb.telemetry(spark, sf_dir)).select("vehicleId", "seq", "lat", "lon")
    moves = X.hops(positions)
    course = G.bearing_deg("prev_lat", "prev_lon", "lat", "lon")
    return moves.select("vehicleId", "seq", F.round(course, 4).alias("heading"))


@plan(
    "h7_position_along",
    S.with_(
        S.SUPPLIER_SITES,
        """
asked AS (
  SELECT zoneId, polygon AS pts,
    least(greatest(cast(suffix AS double) / 90 - 0.05::DOUBLE, 0), 0.9999::DOUBLE) * (len(polygon) - 1) AS s
  FROM (SELECT *, cast(substr(zoneId, 6) AS bigint) % 100 AS suffix FROM all_zones)
), legs AS (
  SELECT *, cast(floor(s) AS integer) AS leg, s - floor(s) AS f,
    pts[cast(floor(s) AS integer) + 1] AS a, pts[cast(floor(s) AS integer) + 2] AS b FROM asked
)""",
        select="SELECT zoneId, round(a[1] + (b[1] - a[1]) * f, 6) AS lat, round(a[2] + (b[2] - a[2]) * f, 6) AS lon FROM legs",
    ),
)
def position_along(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place on the fence of each site, by the share of its legs that lie before it."""
    at = G.position_along("polygon", "double(bigint(substring(id, 6)) % 100) / 90 - 0.05D")
    fences = tb.supplier_zones(spark, sf_dir).select(F.col("id").alias("zoneId"), at.alias("at"))
    return fences.select("zoneId", F.round("at.lat", 6).alias("lat"), F.round("at.lon", 6).alias("lon"))
