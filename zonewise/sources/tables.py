"""Telemetry, zones and change logs derived from the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.schemas import SIGNALS
from zonewise.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def epoch_millis_sql(ts: str) -> str:
    """Epoch milliseconds of a timestamp without zone, whatever the session time zone."""
    clock = f"hour({ts}) * 3600000L + minute({ts}) * 60000L + bigint(floor(extract(SECOND FROM {ts}) * 1000))"
    return f"unix_date(date({ts})) * 86400000L + {clock}"


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as canonical telemetry, plus the later stamps of each record's way."""
    return telemetry_of(read_table(spark, sf_dir, "events"))


def telemetry_of(events: DataFrame) -> DataFrame:
    """Event rows, batch or streaming, as canonical telemetry.

    Columns beyond the canonical schema: ``flinkRead``, ``flinkEmit``, ``alertsArrival``,
    ``event_type`` and ``value``.
    """
    stamped = events.selectExpr(
        "concat('veh-', lpad(string(user_id), 5, '0')) AS vehicleId",
        "event_id AS seq",
        f"{epoch_millis_sql('ts')} AS timestamp",
        "51.0005D + double((event_id * 7919L + user_id * 31L) % 180L) * 0.001D AS lat",
        "-114.1205D + double((event_id * 104729L + user_id * 17L) % 140L) * 0.001D AS lon",
        "event_type",
        "value",
    )
    ingest = "timestamp + 50 + seq % 400"
    read = f"{ingest} + 20 + seq % 300"
    emit = f"{read} + seq % 9"
    signals = {
        "speed": "value % 160",
        "ignition": "event_type <> 'view'",
        "fuelLevel": "value % 100 / 100",
        "odometer": "value * 100",
        "gear": "if(event_type = 'view', 'park', 'drive')",
        "brakeFluidLevel": "0.85D",
        "doorOpen": "event_type = 'error'",
        "engineTemperature": "60D + value % 70",
    }
    vss = ", ".join(f"{made} AS `{SIGNALS[name][0]}`" for name, made in signals.items())
    return stamped.selectExpr(
        "vehicleId",
        "'zone-airport-yyc' AS geoFenceId",
        "timestamp",
        f"{ingest} AS ingestTime",
        "seq",
        """struct(lat AS latitude, lon AS longitude, 1040D + value % 11 AS altitude, value * 7 % 360 AS heading,
             value % 160 AS speed, 3D + value % 27 AS accuracy) AS location""",
        f"struct({vss}) AS vss",
        """struct(1500D + value AS engineRpm, 12.6D AS batteryVoltage, -8D AS outsideTemperature,
             struct(0D AS x, 0D AS y, 1D AS z) AS accelerometerData) AS telemetry""",
        """struct(concat('tracker-', right(vehicleId, 4)) AS deviceId, '2.3.5' AS firmwareVersion,
             70D + value % 30 AS signalStrength) AS deviceInfo""",
        "struct('highway' AS routeType, event_type AS routeName) AS routeInfo",
        f"if(seq % 17 <> 0, {read}, null) AS flinkRead",
        f"{emit} AS flinkEmit",
        f"{emit} + 30 + seq % 90 AS alertsArrival",
        "event_type",
        "value",
    )


def _notched_ring(lat: str, lon: str, height: str, width: str) -> str:
    """A closed ring around a concave six-corner plot: a rectangle without its north-east quarter."""
    north, middle_lat = f"{lat} + {height} * 0.002D", f"{lat} + {height} * 0.001D"
    east, middle_lon = f"{lon} + {width} * 0.002D", f"{lon} + {width} * 0.001D"
    corners = [
        (lat, lon),
        (north, lon),
        (north, middle_lon),
        (middle_lat, middle_lon),
        (middle_lat, east),
        (lat, east),
        (lat, lon),
    ]
    return "array(" + ", ".join(f"array({y}, {x})" for y, x in corners) + ")"


def _kind(number: str) -> str:
    return f"get(array('exclusion', 'containment', 'dwell'), int({number} % 3))"


def _site_ring(number: str, height: str, width: str) -> str:
    lat = f"(51.0D + double({number} * 37 % 170) * 0.001D)"
    lon = f"(-114.12D + double({number} * 53 % 130) * 0.001D)"
    return _notched_ring(lat, lon, f"double({height})", f"double({width})")


def supplier_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concave zone per supplier; the zone set grows with the data."""
    return read_table(spark, sf_dir, "supplier").selectExpr(
        "concat('site-', s_suppkey) AS id",
        "s_name AS name",
        f"{_kind('s_suppkey')} AS kind",
        f"{_site_ring('s_suppkey', '2 + s_suppkey % 5', '2 + s_suppkey % 7')} AS polygon",
        "s_acctbal > 0 AS active",
        "1704067200000L AS updatedAt",
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as edits of customer zones, spread over the event month."""
    return order_changes_of(read_table(spark, sf_dir, "orders"))


def order_changes_of(orders: DataFrame) -> DataFrame:
    """Order rows, batch or streaming, as zone edits."""
    zoned = orders.withColumn("zone", F.expr("o_custkey div 15"))
    return zoned.selectExpr(
        "CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'MODIFY' ELSE 'REMOVE' END AS op",
        "concat('cust-', zone) AS id",
        "o_orderpriority <> '5-LOW' AS active",
        f"{_kind('zone')} AS kind",
        f"{_site_ring('zone', '3 + o_orderkey % 4', '3 + o_orderkey % 5')} AS polygon",
        "1704067200000L + datediff(date(o_orderdate), date'1995-01-01') * 1078203L AS updatedAt",
        "if(o_orderstatus <> 'F', concat('Customer site ', zone), null) AS name",
        "o_orderkey AS seq",
    )


def with_ingest_time(rows: DataFrame, clock: str | None = None) -> DataFrame:
    """Stamp rows on arrival: with a given column, or with the current time."""
    stamp = F.col(clock).cast("long") if clock else F.unix_millis(F.current_timestamp())
    return rows.withColumn("ingestTime", stamp)


def keyed_json(rows: DataFrame, key: str) -> DataFrame:
    """Rows as log records: ``key`` and one JSON ``value`` each, nulls kept."""
    fields = F.struct(*[F.col(c) for c in rows.columns])
    return rows.select(F.col(key).alias("key"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))
