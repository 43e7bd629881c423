"""Fixed values of the pilot: seed zones, alarm rules."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from zonewise.schemas import ZONE

SEEDED_AT = 1782000000000

# Fixed values: (id, name, kind, alert level, ring of [lat, lon]).
SEED_ZONES = [
    (
        "zone-downtown-restricted",
        "Downtown Restricted Core",
        "exclusion",
        "high",
        [[51.050, -114.085], [51.050, -114.060], [51.040, -114.060], [51.040, -114.085], [51.050, -114.085]],
    ),
    (
        "zone-depot-foothills",
        "Foothills Depot Yard",
        "containment",
        "critical",
        [[51.025, -114.010], [51.025, -113.990], [51.012, -113.990], [51.012, -114.010], [51.025, -114.010]],
    ),
    (
        "zone-airport-yyc",
        "YYC Airside",
        "exclusion",
        "critical",
        [[51.140, -114.020], [51.140, -113.995], [51.120, -113.995], [51.120, -114.020], [51.140, -114.020]],
    ),
    (
        "zone-jobsite-north",
        "North Job Site",
        "dwell",
        "low",
        [[51.165, -114.080], [51.165, -114.065], [51.155, -114.065], [51.155, -114.080], [51.165, -114.080]],
    ),
]

# Alarm, metric, dimension, statistic, comparison, threshold.
ALARM_RULES = [
    ("TelemetryIteratorAge", "GetRecords.IteratorAgeMilliseconds", "vehicle-telemetry", "max", "GT", 60000.0),
    ("AlertsIteratorAge", "GetRecords.IteratorAgeMilliseconds", "geofence-alerts", "max", "GT", 60000.0),
    ("FlinkMillisBehindLatest", "millisBehindLatest", "geofence-processor", "max", "GT", 60000.0),
    ("FlinkBackpressure", "backPressuredTimeMsPerSecond", "geofence-processor", "max", "GT", 500.0),
    ("FlinkFailedCheckpoints", "numberOfFailedCheckpoints", "geofence-processor", "sum", "GE", 1.0),
    ("FlinkDowntime", "downtime", "geofence-processor", "max", "GT", 0.0),
    ("WriteThroughputExceededCanary", "WriteProvisionedThroughputExceeded", "vehicle-telemetry", "sum", "GE", 1.0),
    ("RulesBridgeDlqDepth", "ApproximateNumberOfMessagesVisible", "geofence-rules-bridge-dlq", "max", "GE", 1.0),
    ("DetectionLatencySlo", "DetectionTotal", "detection", "p99", "GT", 5000.0),
]


def local_table(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    """A few rows known to the driver, as a local relation Catalyst can see into."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), schema)


def seed_zones(spark: SparkSession) -> DataFrame:
    """The seed zones as a zone table, all active."""
    rows = [
        {
            "id": zone_id,
            "name": name,
            "kind": kind,
            "polygon": ring,
            "properties": {"type": kind, "alertLevel": level, "maxSpeed": None},
            "active": True,
            "createdAt": SEEDED_AT,
            "updatedAt": SEEDED_AT,
        }
        for zone_id, name, kind, level, ring in SEED_ZONES
    ]
    return local_table(spark, rows, ZONE)
