"""SQL fragments shared by the counterparts of the Spark queries.

The statements test every position against every zone and edge, and order whole vehicles
in one window: the plain definition of the results, without any of the library's indexes.
"""

from __future__ import annotations

from zonewise.sources.fixed import SEED_ZONES, SEEDED_AT

TELEMETRY = """
telemetry AS (
  SELECT *,
    timestamp + 50 + seq % 400 AS ingestTime,
    CASE WHEN seq % 17 <> 0 THEN timestamp + 50 + seq % 400 + 20 + seq % 300 END AS flinkRead,
    timestamp + 50 + seq % 400 + 20 + seq % 300 + seq % 9 AS flinkEmit,
    timestamp + 50 + seq % 400 + 20 + seq % 300 + seq % 9 + 30 + seq % 90 AS alertsArrival,
    value % 160 AS speed, 3.0::DOUBLE + value % 27 AS accuracy,
    event_type <> 'view' AS ignition, event_type = 'error' AS doorOpen,
    value % 100 / 100 AS fuelLevel, 60.0::DOUBLE + value % 70 AS engineTemperature
  FROM (
    SELECT concat('veh-', lpad(cast(user_id AS varchar), 5, '0')) AS vehicleId,
      event_id AS seq, epoch_us(ts) // 1000 AS timestamp,
      cast(51.0005 AS double) + cast((event_id * 7919 + user_id * 31) % 180 AS double) * cast(0.001 AS double) AS lat,
      cast(-114.1205 AS double) + cast((event_id * 104729 + user_id * 17) % 140 AS double) * cast(0.001 AS double) AS lon,
      event_type, value
    FROM events)
)"""


def _points(ring: list[list[float]]) -> str:
    return "[" + ", ".join(f"[{lat!r}::DOUBLE, {lon!r}::DOUBLE]" for lat, lon in ring) + "]"


def _seed_rows() -> str:
    return ", ".join(
        f"('{zone_id}', '{name}', '{kind}', '{level}', {_points(ring)}, true, {SEEDED_AT}::BIGINT)"
        for zone_id, name, kind, level, ring in SEED_ZONES
    )


SEED = f"""
zones AS (
  SELECT * FROM (VALUES {_seed_rows()}) AS v(zoneId, zoneName, zoneKind, alertLevel, polygon, active, updatedAt)
)"""


def ring(lat: str, lon: str, height: str, width: str) -> str:
    """The concave six-corner plot used for derived zones, closed."""
    c = "cast({} AS double)".format
    north, mid_lat = f"({lat} + {height} * {c('0.002')})", f"({lat} + {height} * {c('0.001')})"
    east, mid_lon = f"({lon} + {width} * {c('0.002')})", f"({lon} + {width} * {c('0.001')})"
    corners = [
        (lat, lon),
        (north, lon),
        (north, mid_lon),
        (mid_lat, mid_lon),
        (mid_lat, east),
        (lat, east),
        (lat, lon),
    ]
    return "[" + ", ".join(f"[{y}, {x}]" for y, x in corners) + "]"


def _kind(number: str) -> str:
    return f"(['exclusion', 'containment', 'dwell'])[{number} % 3 + 1]"


def _site(number: str) -> tuple[str, str]:
    return (
        f"(cast(51.0 AS double) + cast({number} * 37 % 170 AS double) * cast(0.001 AS double))",
        f"(cast(-114.12 AS double) + cast({number} * 53 % 130 AS double) * cast(0.001 AS double))",
    )


SUPPLIER_SITES = f"""
all_zones AS (
  SELECT concat('site-', s_suppkey) AS zoneId, s_name AS zoneName, {_kind('s_suppkey')} AS zoneKind,
    {ring(*_site('s_suppkey'), 'cast(2 + s_suppkey % 5 AS double)', 'cast(2 + s_suppkey % 7 AS double)')} AS polygon,
    s_acctbal > 0 AS active, 1704067200000::BIGINT AS updatedAt
  FROM supplier
), zones AS (SELECT * FROM all_zones WHERE active)"""

CHANGES = f"""
changes AS (
  SELECT CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'MODIFY' ELSE 'REMOVE' END AS op,
    concat('cust-', zone) AS zoneId, o_orderpriority <> '5-LOW' AS active, {_kind('zone')} AS zoneKind,
    {ring(*_site('zone'), 'cast(3 + o_orderkey % 4 AS double)', 'cast(3 + o_orderkey % 5 AS double)')} AS polygon,
    1704067200000 + date_diff('day', DATE '1995-01-01', cast(o_orderdate AS date)) * 1078203 AS updatedAt,
    CASE WHEN o_orderstatus <> 'F' THEN concat('Customer site ', zone) END AS name, o_orderkey AS seq
  FROM (SELECT *, o_custkey // 15 AS zone FROM orders)
)"""

VERSIONS = """
versions AS (
  SELECT zoneId, coalesce(nullif(name, ''), zoneId) AS zoneName, zoneKind, polygon, valid_from, valid_to, op, seq,
    op <> 'REMOVE' AND coalesce(active, false) AS active
  FROM (
    SELECT *, updatedAt AS valid_from,
      coalesce(lead(updatedAt) OVER (PARTITION BY zoneId ORDER BY updatedAt, seq), 9223372036854775807) AS valid_to
    FROM changes)
  WHERE valid_from < valid_to
)"""

# Edges of a ring relation: needs zones(zoneId, polygon, + the columns named in the format call).
EDGE_ROWS = """
zone_edges AS (
  SELECT {columns}, polygon[i][2] AS x1, polygon[i][1] AS y1, polygon[i + 1][2] AS x2, polygon[i + 1][1] AS y2
  FROM (SELECT *, unnest(range(1, len(polygon))) AS i FROM {source})
)"""

_ON_EDGE = """
  abs((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1)) <= 1e-9::DOUBLE
  AND lon BETWEEN least(x1, x2) - 1e-9::DOUBLE AND greatest(x1, x2) + 1e-9::DOUBLE
  AND lat BETWEEN least(y1, y2) - 1e-9::DOUBLE AND greatest(y1, y2) + 1e-9::DOUBLE"""
_CROSSES = "(y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1"
INSIDE = f"(bool_or({_ON_EDGE}) OR count(*) FILTER (WHERE {_CROSSES}) % 2 = 1)"

_KX = "(111320.0::DOUBLE * cos(radians(lat)))"
_KY = "111320.0::DOUBLE"
_ALONG = f"""
  least(1.0::DOUBLE, greatest(0.0::DOUBLE,
    ((lon * {_KX} - x1 * {_KX}) * (x2 * {_KX} - x1 * {_KX}) + (lat * {_KY} - y1 * {_KY}) * (y2 * {_KY} - y1 * {_KY}))
    / (power(x2 * {_KX} - x1 * {_KX}, 2) + power(y2 * {_KY} - y1 * {_KY}, 2))))"""
DISTANCE = f"""
  min(sqrt(power(lon * {_KX} - (x1 * {_KX} + {_ALONG} * (x2 * {_KX} - x1 * {_KX})), 2)
         + power(lat * {_KY} - (y1 * {_KY} + {_ALONG} * (y2 * {_KY} - y1 * {_KY})), 2)))"""

FLAGS = f"""
flags AS (
  SELECT vehicleId, seq, zoneId, {INSIDE} AS inside, {DISTANCE} AS distance
  FROM telemetry CROSS JOIN zone_edges GROUP BY vehicleId, seq, zoneId
)"""

EDGES = """
steps AS (
  SELECT *, lag(inside) OVER (PARTITION BY vehicleId, zoneId ORDER BY seq) AS was FROM flags
), edges AS (
  SELECT s.*, CASE WHEN inside THEN 'entry' ELSE 'exit' END AS edge, z.zoneName, z.zoneKind
  FROM steps s JOIN zones z USING (zoneId) WHERE was IS NOT NULL AND was <> inside
)"""

BREACHES = """
breaches AS (
  SELECT e.vehicleId, e.zoneId, e.zoneName, e.zoneKind, e.edge AS breachType, t.timestamp,
    t.lat, t.lon, t.accuracy, CASE WHEN e.inside THEN 0.0::DOUBLE ELSE round(e.distance, 1) END AS distanceOutsideM,
    0::BIGINT AS durationInStateS, t.speed, t.ignition, t.fuelLevel, t.engineTemperature, t.doorOpen,
    t.event_type, t.value, t.ingestTime, t.flinkRead, t.flinkEmit, t.alertsArrival, e.seq
  FROM edges e JOIN telemetry t USING (vehicleId, seq)
  WHERE (zoneKind = 'exclusion' AND edge = 'entry') OR (zoneKind = 'containment' AND edge = 'exit')
     OR zoneKind = 'dwell'
)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + select


SEED_EDGES = EDGE_ROWS.format(columns="zoneId", source="zones")

# Everything up to `breaches` for the seed zones, and for the supplier sites.
SEED_BREACHES = (TELEMETRY, SEED, SEED_EDGES, FLAGS, EDGES, BREACHES)
SITE_BREACHES = (TELEMETRY, SUPPLIER_SITES, SEED_EDGES, FLAGS, EDGES, BREACHES)
