"""Zone table and change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.operators import zones as Z
from zonewise.plans import sql as S
from zonewise.plans.registry import plan
from zonewise.sources import envelopes
from zonewise.sources import tables as tb
from zonewise.sources.fixed import seed_zones


@plan(
    "a4_seed_zones",
    S.with_(
        S.SEED,
        select="""
, placed AS (SELECT zoneId, s_suppkey FROM supplier JOIN zones ON zoneKind = (['exclusion', 'containment', 'dwell'])[s_suppkey % 3 + 1])
SELECT p.zoneId, z.zoneName, z.zoneKind, z.alertLevel, z.active, z.updatedAt, count(*) AS sites
FROM placed p JOIN zones z USING (zoneId) GROUP BY ALL""",
    ),
)
def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed zones with the number of supplier sites of the same kind."""
    sites = tb.supplier_zones(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("sites"))
    return (
        seed_zones(spark)
        .join(sites, "kind")
        .selectExpr(
            "id AS zoneId",
            "name AS zoneName",
            "kind AS zoneKind",
            "properties.alertLevel AS alertLevel",
            "active",
            "updatedAt",
            "sites",
        )
    )


@plan(
    "a4_zone_upsert",
    S.with_(
        S.SUPPLIER_SITES,
        S.CHANGES,
        select="""
, both_rows AS (
  SELECT zoneId AS id, zoneKind AS kind, active, updatedAt, 0 AS edit, -1 AS seq FROM all_zones
  UNION ALL
  SELECT concat('site-', substr(zoneId, 6)), zoneKind, active, updatedAt, 1, seq FROM changes)
SELECT id, kind, active, updatedAt FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updatedAt DESC, edit DESC, seq DESC) AS rn FROM both_rows)
WHERE rn = 1""",
    ),
)
def zone_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = tb.supplier_zones(spark, sf_dir).select("id", "kind", "active", "updatedAt")
    edits = tb.order_changes(spark, sf_dir).selectExpr(
        "concat('site-', substr(id, 6)) AS id", "kind", "active", "updatedAt", "seq"
    )
    return Z.upsert_zones(current, edits, tie="seq").select("id", "kind", "active", "updatedAt")


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as the zone store emits it: typed attributes in JSON, old and new images."""
    image = """named_struct(
      'id', if(seq % 19 = 0, null, named_struct('S', id)),
      'name', if(name IS NULL, null, named_struct('S', name)),
      'active', named_struct('BOOL', active),
      'polygon', named_struct('L', transform(polygon, p -> named_struct('L',
         array(named_struct('N', string(p[0])), named_struct('N', string(p[1])))))),
      'properties', named_struct('M', named_struct('type', named_struct('S', kind), 'alertLevel', named_struct('S', 'high'),
         'maxSpeed', if(seq % 3 = 0, named_struct('N', string(seq % 100)), null))),
      'updatedAt', named_struct('N', string(updatedAt)))"""
    text = f"""to_json(named_struct('eventName', op, 'dynamodb', named_struct(
      'Keys', if(seq % 19 = 0, null, named_struct('id', named_struct('S', id))),
      'NewImage', if(op = 'REMOVE', null, {image}),
      'OldImage', if(op = 'INSERT', null, {image}),
      'SequenceNumber', string(seq))))"""
    raw = tb.order_changes(spark, sf_dir).selectExpr(f"{text} AS raw")
    return envelopes.decode_change_records(raw)


@plan(
    "a5_rule_changes",
    S.with_(
        S.CHANGES,
        select="""
SELECT op, zoneId AS id, op <> 'REMOVE' AND active AS active, zoneKind AS kind, len(polygon)::INTEGER AS points,
  polygon[3][1] AS lat, polygon[3][2] AS lon, updatedAt, name, seq,
  CASE WHEN seq % 3 = 0 THEN cast(seq % 100 AS double) END AS maxSpeed
FROM changes WHERE seq % 19 <> 0""",
    ),
)
def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.rule_changes(change_records(spark, sf_dir)).selectExpr(
        "op",
        "id",
        "active",
        "kind",
        "size(polygon) AS points",
        "polygon[2][0] AS lat",
        "polygon[2][1] AS lon",
        "updatedAt",
        "name",
        "seq",
        "properties.maxSpeed AS maxSpeed",
    )


_LATEST = """
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zoneId ORDER BY updatedAt DESC, seq DESC) AS rn FROM changes)
  WHERE rn = 1
)"""


@plan(
    "e5_latest_zone",
    S.with_(S.CHANGES, _LATEST, select="SELECT zoneId AS id, op, active, updatedAt, seq FROM latest"),
)
def latest_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.latest_zones(tb.order_changes(spark, sf_dir)).select("id", "op", "active", "updatedAt", "seq")


@plan(
    "b7_active_zones",
    S.with_(
        S.CHANGES, _LATEST, select="SELECT zoneId AS id, zoneKind AS kind, seq FROM latest WHERE op <> 'REMOVE' AND active"
    ),
)
def active_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.active_set(tb.order_changes(spark, sf_dir)).select("id", "kind", "seq")


@plan(
    "e6_zone_versions",
    S.with_(S.CHANGES, S.VERSIONS, select="SELECT zoneId AS id, valid_from, valid_to, active, seq FROM versions"),
)
def zone_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.zone_versions(tb.order_changes(spark, sf_dir)).select("id", "valid_from", "valid_to", "active", "seq")


@plan(
    "i1_activity_periods",
    S.with_(
        S.CHANGES,
        S.VERSIONS,
        select="""
, starts AS (
  SELECT *, CASE WHEN active AND NOT coalesce(lag(active) OVER w, false) THEN 1 ELSE 0 END AS s
  FROM versions WINDOW w AS (PARTITION BY zoneId ORDER BY valid_from)
), periods AS (
  SELECT *, sum(s) OVER (PARTITION BY zoneId ORDER BY valid_from) AS period FROM starts
)
SELECT zoneId AS id, min(valid_from) AS activity_from, max(valid_to) AS activity_to, count(*) AS versions
FROM periods WHERE active GROUP BY zoneId, period""",
    ),
)
def activity_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbroken active periods of every zone: what a vehicle's remembered state must bridge."""
    spans = Z.with_activity(Z.zone_versions(tb.order_changes(spark, sf_dir)))
    return spans.groupBy("id", "activity_from", "activity_to").agg(F.count(F.lit(1)).alias("versions"))
