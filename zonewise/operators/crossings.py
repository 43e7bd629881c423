"""Boundary crossings and breach events.

A crossing needs a position and the one before it, so detection is two steps: bring each
position together with its predecessor (one shuffle by vehicle, split by segments), then
ask which zones contain exactly one of the two (a spatial join on grid cells).  Positions
far from every zone never meet a zone row, and the number of zones does not multiply the
number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.functions import geometry as G
from zonewise.operators.ordered import (
    ARRIVALS_PER_SEGMENT,
    MILLIS_PER_SEGMENT,
    ROWS_PER_SEGMENT,
    asof_join,
    largest_group,
    lookback,
    measured_segments,
    span_segment,
)
from zonewise.operators.spatial import (
    BASE_CELL_DEG,
    BROADCAST_LIMIT_BYTES,
    NO_KEY,
    BitIndex,
    ZoneIndex,
    bit_index,
    build_index,
    inside_pairs,
)
from zonewise.operators.zones import with_activity
from zonewise.schemas import SIGNALS
from zonewise.session import materialize

# Fixed values.
ENTRY = "entry"
EXIT = "exit"
BREACHING_EDGES = {"exclusion": (ENTRY,), "containment": (EXIT,), "dwell": (ENTRY, EXIT)}

_ZONE_COLUMNS = ["zoneId", "zoneName", "zoneKind"]


# ---------------------------------------------------------------- columns


def detect_edge(was: Column, now: Column) -> Column:
    """``entry``, ``exit`` or null; an unknown former state gives null."""
    return F.when(~was & now, F.lit(ENTRY)).when(was & ~now, F.lit(EXIT))


def _breach_sql(kind: str, edge: str) -> str:
    rules = [
        f"({kind} = '{name}' AND {edge} IN ({', '.join(repr(e) for e in edges)}))"
        for name, edges in BREACHING_EDGES.items()
    ]
    return f"coalesce({' OR '.join(rules)}, false)"


def is_breach(kind: str, edge: str) -> Column:
    """Does this crossing (column names) go against the zone's purpose?"""
    return F.expr(_breach_sql(kind, edge))


def edges_of_sequence(flags: Column) -> Column:
    """``array<struct<index, edge>>`` of the transitions in an array of inside flags."""
    steps = F.transform(
        flags,
        lambda now, i: F.struct(i.alias("index"), detect_edge(F.get(flags, i - 1), now).alias("edge")),
    )
    return F.filter(steps, lambda s: s["edge"].isNotNull())


# ---------------------------------------------------------------- positions


def flat_positions(telemetry: DataFrame) -> DataFrame:
    """The fields detection and the breach event use, one column each."""

    signals = ("ignition", "fuelLevel", "gear", "engineTemperature", "brakeFluidLevel", "doorOpen")
    return telemetry.selectExpr(
        "vehicleId",
        "seq",
        "timestamp",
        "ingestTime",
        "location.latitude AS lat",
        "location.longitude AS lon",
        "location.accuracy AS accuracy",
        "location.speed AS speed",
        *[f"vss.`{SIGNALS[name][0]}` AS {name}" for name in signals],
    )


def co_partition(positions: DataFrame, segment: Column | None = None) -> DataFrame:
    """Positions hash-partitioned as detection needs them: by vehicle, long histories by segment too.

    Detection does this by itself; written out for jobs that store positions partitioned.
    """
    segment = span_segment("seq", ARRIVALS_PER_SEGMENT) if segment is None else segment
    return positions.repartition(F.col("vehicleId"), segment)


def hops(
    positions: DataFrame,
    order: tuple[str, ...] = ("seq",),
    segment: Column | None = None,
    carry: tuple[str, ...] = ("lat", "lon"),
) -> DataFrame:
    """Positions that have a predecessor, with its ``carry`` columns as ``prev_*``."""
    segment = span_segment("seq", ARRIVALS_PER_SEGMENT) if segment is None else segment
    made = {f"prev_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in carry}
    return lookback(positions, ["vehicleId"], list(order), segment, made).where(
        F.col(f"prev_{carry[0]}").isNotNull()
    )


def _probes(moves: DataFrame, index: ZoneIndex | BitIndex, versioned: bool) -> DataFrame:
    """Two lookups per hop: zones around the position (may be entered) and around its predecessor.

    ``at_*`` is the end of the hop looked up, ``off_*`` the other one.
    """
    clocks = [("clock",), ("prev_clock",)] if versioned else [(), ()]
    now = index.probe_keys("lat", "lon", *clocks[0]) or [NO_KEY]
    before = index.probe_keys("prev_lat", "prev_lon", *clocks[1]) or [NO_KEY]
    under = "bit" if isinstance(index, BitIndex) else "slot"
    names = ("lat", "lon", "clock") if versioned else ("lat", "lon")
    # As fields of what is exploded: else each use of an end below would repeat the choice between the two.
    asks = [
        f"struct({str(enters).lower()} AS enters, {key}.cell AS cell, {key}.{under} AS {under}, "
        + ", ".join(f"{a}{name} AS at_{name}, {b}{name} AS off_{name}" for name in names)
        + ")"
        for enters, keys, a, b in ((True, now, "", "prev_"), (False, before, "prev_", ""))
        for key in keys
    ]
    return (
        moves.withColumn("__ask", F.expr(f"explode(array({', '.join(asks)}))"))
        .select(*moves.columns, "__ask.*")
        .selectExpr("*", f"if(enters, '{ENTRY}', '{EXIT}') AS edge")
    )


def _contains_sql(index: ZoneIndex, end: str) -> str:
    return index.contains_sql(f"{end}_lat", f"{end}_lon")


def crossings(moves: DataFrame, index: ZoneIndex, breaches_only: bool = False) -> DataFrame:
    """One row per hop and zone whose boundary lies between the two positions.

    A zone is entered when it contains the position and not its predecessor, left when it
    is the other way round; so entries are found from the position's cell, exits from the
    predecessor's, and no pair is found twice.
    """
    found = index.join(_probes(moves, index, versioned=False))
    if breaches_only:
        found = found.where(is_breach("zoneKind", "edge"))
    return found.where(f"{_contains_sql(index, 'at')} AND NOT {_contains_sql(index, 'off')}").select(
        *moves.columns, *_ZONE_COLUMNS, "edge", "edges"
    )


def bit_crossings(moves: DataFrame, index: BitIndex, breaches_only: bool = False) -> DataFrame:
    """``crossings`` of many zones, with all columns of the zone."""
    return index.only_one(_probes(moves, index, versioned=False), _breach_sql("zoneKind", "edge") if breaches_only else "true")


def fixed_crossings(moves: DataFrame, zones: DataFrame, base_cell: float = BASE_CELL_DEG) -> DataFrame:
    """``crossings`` of a fixed set of zones, by the index that suits it."""
    many = bit_index(active_zones(zones), base_cell)
    if many is None:
        return crossings(moves, build_index(active_zones(zones), base_cell))
    return bit_crossings(moves, many).select(*moves.columns, *_ZONE_COLUMNS, "edge", "edges")


# ---------------------------------------------------------------- breach events


def breach_event(rows: DataFrame, read: str = "null", emit: str = "null", metres: str | None = None) -> DataFrame:
    """Flat crossing rows (position columns, zone columns, ``edge``, ``edges``) as breach events.

    ``read`` and ``emit`` are SQL expressions of the processor's stamps, where known, ``metres`` one of the distance to
    the zone's boundary where the rows have its edges otherwise.
    """
    outside = f"if(edge = '{ENTRY}', 0D, {metres or G.edges_distance_fast_sql('lat', 'lon', 'edges', '__kx')})"
    return rows.withColumn("__kx", F.expr(G.metres_per_lon_sql("lat"))).selectExpr(
        "vehicleId",
        *_ZONE_COLUMNS,
        "edge AS breachType",
        "timestamp",
        "struct(lat AS latitude, lon AS longitude, accuracy) AS location",
        f"round({outside}, 1) AS distanceOutsideM",
        "0L AS durationInStateS",
        "struct(speed, ignition, fuelLevel, gear, engineTemperature, brakeFluidLevel, doorOpen) AS vehicle",
        f"""struct(timestamp AS eventTime, ingestTime, bigint({read}) AS flinkRead, bigint({emit}) AS flinkEmit)
            AS trace""",
        "seq",
    )


def active_zones(zones: DataFrame) -> DataFrame:
    return zones.where(F.coalesce(F.col("active"), F.lit(False)))


def inside_flags(telemetry: DataFrame, zones: DataFrame, base_cell: float | None = None) -> DataFrame:
    """(vehicleId, seq, zoneId) of every position inside an active zone."""
    index = build_index(active_zones(zones), **({"base_cell": base_cell} if base_cell else {}))
    positions = flat_positions(telemetry).select("vehicleId", "seq", "lat", "lon")
    return inside_pairs(positions, index).select("vehicleId", "seq", "zoneId", F.lit(True).alias("inside"))


def edges(telemetry: DataFrame, zones: DataFrame, segment: Column | None = None) -> DataFrame:
    """All entries and exits of a fixed zone set, breach or not."""
    positions = flat_positions(telemetry).select("vehicleId", "seq", "timestamp", "lat", "lon")
    return fixed_crossings(hops(positions, segment=segment), zones)


def breaches(telemetry: DataFrame, zones: DataFrame, segment: Column | None = None) -> DataFrame:
    """Breach events of a fixed zone set.  The output also carries ``seq``."""
    moves = hops(flat_positions(telemetry), segment=segment)
    many = bit_index(active_zones(zones))
    if many is None:
        return breach_event(crossings(moves, build_index(active_zones(zones)), breaches_only=True))
    return breach_event(many.with_distance(bit_crossings(moves, many, breaches_only=True), "__metres", "lat", "lon"), metres="__metres")


def grid_edges(telemetry: DataFrame, zones: DataFrame, cell_deg: float) -> DataFrame:
    """``edges`` with a chosen finest cell, for zone sets much denser or sparser than a city's."""
    positions = flat_positions(telemetry).select("vehicleId", "seq", "timestamp", "lat", "lon")
    return fixed_crossings(hops(positions), zones, cell_deg)


# ---------------------------------------------------------------- live-edited zones


def hold_until(positions: DataFrame, first_active: int, hold_cap: int | None = None) -> DataFrame:
    """Positions from before the first active zone are judged when it appears.

    All of them are kept, and so are positions without a clock; ``hold_cap`` keeps the newest so many only.
    """
    if hold_cap is None:
        return positions.withColumn("clock", F.greatest("clock", F.lit(first_active).cast("long")))
    early = F.col("clock") < first_active
    kept = positions.where(early).orderBy(F.desc("seq")).limit(hold_cap)
    held = kept.withColumn("clock", F.lit(first_active).cast("long"))
    return positions.where(~early).unionByName(held)


def judged_positions(telemetry: DataFrame) -> DataFrame:
    """Flat positions with their clock: ingest time, or event time where that is missing."""
    return flat_positions(telemetry).withColumn("clock", F.coalesce("ingestTime", "timestamp"))


@dataclass(frozen=True)
class ZoneLog:
    """Zone versions prepared for judging positions: computed once, read by several joins."""

    periods: DataFrame  # zoneId, activity_from, activity_to: when a zone is active without a break
    index: ZoneIndex
    first_active: int
    shortest_period: int
    edited: bool  # some zone has several versions
    switched: bool  # some zone has several periods


def zone_log(versions: DataFrame) -> ZoneLog | None:
    """The log of zone versions (``zones.zone_versions``); null if no zone was ever active."""
    spans = materialize(with_activity(materialize(versions)))
    facts = spans.agg(
        F.min("valid_from").alias("first_active"),
        F.min(F.col("activity_to") - F.col("activity_from")).alias("shortest"),
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("valid_from") == F.col("activity_from")).alias("periods"),
        F.count_distinct("id").alias("zones"),
    ).first()
    if facts["first_active"] is None:
        return None
    periods = spans.where("valid_from = activity_from").select(F.col("id").alias("zoneId"), "activity_from", "activity_to")
    return ZoneLog(
        periods=periods,
        index=build_index(spans),
        first_active=facts["first_active"],
        shortest_period=facts["shortest"],
        edited=facts["versions"] > facts["zones"],
        switched=facts["periods"] > facts["zones"],
    )


def edges_versioned(
    telemetry: DataFrame,
    versions: DataFrame,
    hold_cap: int | None = None,
    span_ms: int = MILLIS_PER_SEGMENT,
    breaches_only: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Crossings under zones that change while vehicles move.

    Each position is judged by the zone versions in force at its clock, in (clock, seq)
    order, and compared with the vehicle's last *judged* state for that zone.  A state
    outlives removal and edits of its zone.  Three cases follow:

    * both positions under one version: decided from the hop alone;
    * zone edited between them but active throughout: the position is looked up in the new
      version and its predecessor in the old one, and the two answers are put together;
    * zone inactive in between: the nearest judged position on the other side of the gap is
      found by as-of hops (``judged_across``).

    The second and third case concern only positions inside a zone next to an edit.
    """
    positions = judged_positions(telemetry)
    log = zone_log(versions)
    if log is None:
        return _no_crossings(positions)
    positions = hold_until(positions, log.first_active, hold_cap)
    segmented, segment = measured_segments(positions, ["vehicleId"], "clock", rows_per_segment)
    moves = hops(segmented, order=("clock", "seq"), segment=segment, carry=("lat", "lon", "clock", "seq"))
    if "__cut" in moves.columns:
        moves = moves.drop("__cut")
    found, ends = near_edits(moves, log, positions.columns, breaches_only)
    if log.switched:
        found = found.unionByName(_gap_crossings(positions, ends, log.periods, span_ms, rows_per_segment))
    return with_versions(found, log, positions.columns, span_ms, breaches_only)


def near_edits(
    moves: DataFrame, log: ZoneLog, base: list[str], breaches_only: bool = False, keep: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(crossings decided from the hop alone, positions inside a zone next to its inactive time).

    Crossings are ``base`` columns, ``zoneId, edge`` and ``valid_from``, the version in force where it is known.  The
    others have ``enters``: is it the hop's end (first judged after the gap) or its start (last judged before) that is inside?
    """
    hits = (
        log.index.join(_probes(moves, log.index, versioned=True))
        .where("at_clock >= valid_from AND at_clock < valid_to")
        .where(_contains_sql(log.index, "at"))
        .withColumn("settled", F.expr("if(enters, prev_clock >= valid_from, clock < valid_to)"))
        .withColumn("same_period", F.expr("if(enters, prev_clock >= activity_from, clock < activity_to)"))
        .where(f"NOT settled OR NOT {_contains_sql(log.index, 'off')}")
    )
    if breaches_only:
        hits = hits.where(F.expr("NOT settled") | is_breach("zoneKind", "edge"))
    hits = hits.select(*base, "zoneId", "edge", "valid_from", "enters", "settled", "same_period", "prev_clock", "prev_seq")
    if log.edited or keep:
        # Read by up to three branches and small beside the positions: computed once.
        hits = materialize(hits)
    found = hits.where("settled").select(*base, "zoneId", "edge", "valid_from")
    if log.edited:
        edited = (
            hits.where(~F.col("settled") & F.col("same_period"))
            .groupBy("vehicleId", "seq", "clock", "zoneId")
            .agg(
                F.count(F.lit(1)).alias("sides"),
                F.first(F.struct(*[c for c in base if c not in ("vehicleId", "seq", "clock")], "edge")).alias("row"),
            )
            .where(F.col("sides") == 1)
            .select("vehicleId", "seq", "clock", "zoneId", "row.*", F.lit(None).cast("long").alias("valid_from"))
        )
        found = found.unionByName(edited)
    ends = hits.where(~F.col("settled") & ~F.col("same_period"))
    return found, ends.select(*base, "zoneId", "enters", "prev_clock", "prev_seq")


def with_versions(found: DataFrame, log: ZoneLog, base: list[str], span_ms: int, breaches_only: bool) -> DataFrame:
    """Crossings with the columns of the zone version in force."""
    zones = log.index.zones.select("zoneId", "valid_from", "zoneName", "zoneKind", "edges")
    if log.edited or log.switched:
        known = found.where("valid_from IS NOT NULL")
        loose = materialize(found.where("valid_from IS NULL").drop("valid_from"))
        dated = asof_join(loose, zones.select("zoneId", "valid_from"), ["zoneId"], "clock", "valid_from", "__v", span=span_ms)
        found = known.unionByName(dated.withColumn("valid_from", F.col("__v.valid_from")).drop("__v"))
    joined = found.join(F.broadcast(zones) if log.index.small else zones, ["zoneId", "valid_from"])
    out = joined.select(*base, *_ZONE_COLUMNS, "edge", "edges")
    return out.where(is_breach("zoneKind", "edge")) if breaches_only else out


#: Hops of ``judged_across`` in one job.
HOPS_AT_ONCE = 4
#: Zones of up to so many periods, and of so many in all (16 bytes each), are looked up in a broadcast; others by an as-of join.
PERIODS_IN_ROW, PERIODS_BROADCAST = 256, BROADCAST_LIMIT_BYTES // 16

# What a row of a trail stands for: a position, a position of which no more is known, and one from which on the vehicle
# reported without a silence that could hide a whole active period.
POSITION, REPORT, STEADY = 0, 1, 2


def _period_on_the_way(rows: DataFrame, both: DataFrame, spans: DataFrame | None, by_zone: int | None) -> DataFrame:
    """Rows with the ``period`` of their zone that is the first on their way from ``at``, if they are open."""
    if spans is None:
        asked = rows.withColumn("__t", F.expr("if(state <> 'open', null, if(way = 1, at + 1, -at))"))
        return asof_join(asked, both, ["zoneId", "way"], "__t", "reach", "period", direction="forward", span=by_zone).drop("__t")
    ahead = "get(filter(spans, p -> p.activity_to > at), 0)"
    behind = "try_element_at(filter(spans, p -> p.activity_from <= at), -1)"
    found = rows.join(F.broadcast(spans), "zoneId", "left")
    return found.withColumn("period", F.expr(f"if(state <> 'open', null, if(way = 1, {ahead}, {behind}))")).drop("spans")


def _hop(
    rows: DataFrame, both: DataFrame, spans: DataFrame | None, path: DataFrame, columns: list[str], by_zone: int | None, by_vehicle: int | None
) -> DataFrame:
    """One hop of the rows that are still open: to the zone's period on the way, and from there to a position."""
    met = (
        _period_on_the_way(rows, both, spans, by_zone)
        .withColumn("until", F.expr("if(state <> 'open', until, if(way = 1, period.activity_from, period.activity_to))"))
        .withColumn(
            "state",
            F.expr(
                """CASE WHEN state <> 'open' THEN state WHEN period IS NULL THEN 'gone'
                   WHEN at >= period.activity_from AND at < period.activity_to THEN 'judged' ELSE 'open' END"""
            ),
        )
        # Back: strictly before the end of the period.  Those that need no hop ask for nothing.
        .withColumn("__t", F.expr("if(state <> 'open', null, if(way = 1, until, 1 - until))"))
        .drop("period")
    )
    found = asof_join(met, path, ["vehicleId", "way"], "__t", "reach", "found", tie="tie", direction="forward", span=by_vehicle)
    open_ = F.col("state") == "open"
    moved = {
        "kind": F.when(open_, F.col("found.kind")).otherwise(F.col("kind")),
        "at": F.when(open_ & F.col("found").isNotNull(), F.col("found.clock")).otherwise(F.col("at")),
        "at_seq": F.when(open_ & F.col("found").isNotNull(), F.col("found.seq")).otherwise(F.col("at_seq")),
        "state": F.expr(f"""CASE WHEN state <> 'open' THEN state WHEN found IS NULL THEN 'gone'
                            WHEN found.kind = {STEADY} THEN 'judged' ELSE 'open' END"""),
    }
    return found.withColumns(moved).select(*columns, "kind", "until", "state")


def judged_across(
    asks: DataFrame, periods: DataFrame, trail: DataFrame, span_ms: int, past: DataFrame | None = None, rows: int = ROWS_PER_SEGMENT
) -> tuple[DataFrame, DataFrame]:
    """The nearest judged position of a vehicle on the way from a place in time: (found rows, rows that ran out).

    ``asks`` has ``vehicleId, zoneId``, a direction ``way`` (1 on, -1 back) and a position ``at, at_seq`` of the
    vehicle, which counts itself if the zone is active then.  Where it is not, the next hop goes to the zone's next
    active period on the way, and from there to the vehicle's first position on that way, until the two meet.  A job
    takes ``HOPS_AT_ONCE`` hops of the rows still open.  Vehicles and zones of more than ``rows`` rows are cut into spans of time.

    ``trail`` holds positions (``vehicleId, clock, seq``); ``past`` what is known of earlier ones, as ``vehicleId,
    clock, kind``.  Found rows have the position they came to as ``at, at_seq`` and, if it was not the one asked with, its
    ``kind``.  Rows that ran out have ``until``, the time they looked for, or null if no period was left.
    """
    ways = F.explode(F.array(F.lit(1), F.lit(-1))).alias("way")
    both = materialize(
        periods.select("*", ways).withColumn("reach", F.expr("if(way = 1, activity_to, -activity_from)"))
    )
    columns = asks.columns
    fresh = {"kind": F.lit(None).cast("int"), "until": F.lit(None).cast("long"), "state": F.lit("open")}
    open_ = materialize(asks.withColumns(fresh))
    concerned = trail.join(open_.select("vehicleId").distinct(), "vehicleId", "left_semi")
    path = concerned.select("vehicleId", "clock", "seq", F.lit(POSITION).alias("kind"), ways)
    if past is not None:
        path = path.unionByName(past.select("vehicleId", "clock", F.lit(None).cast("long").alias("seq"), "kind", F.lit(-1).alias("way")))
    path = materialize(path.withColumn("reach", F.expr("way * clock")).withColumn("tie", F.expr("way * coalesce(seq, -kind)")))
    sizes = largest_group(
        *[(df, [key, "way"]) for df, key in ((open_, "zoneId"), (both, "zoneId"), (open_, "vehicleId"), (path, "vehicleId"))], (both, ["way"])
    )
    by_zone, by_vehicle = (None if sum(pair) <= rows else span_ms for pair in (sizes[:2], sizes[2:4]))
    spans = None
    if sizes[1] <= min(PERIODS_IN_ROW, rows) and sizes[4] <= PERIODS_BROADCAST:
        listed = F.sort_array(F.collect_list(F.struct("activity_from", "activity_to"))).alias("spans")
        spans = materialize(both.where("way = 1").groupBy("zoneId").agg(listed))
    ended = []
    while not open_.isEmpty():
        for _ in range(HOPS_AT_ONCE):
            open_ = _hop(open_, both, spans, path, columns, by_zone, by_vehicle)
        hopped = materialize(open_)
        ended.append(hopped.where("state <> 'open'"))
        open_ = hopped.where("state = 'open'")
    every = reduce(DataFrame.unionByName, ended, open_.limit(0))
    found = every.where("state = 'judged'").select(*columns, "kind")
    return found, every.where("state = 'gone'").select(*columns, "until")


def gap_asks(ends: DataFrame) -> DataFrame:
    """From each position inside a zone next to its inactive time: the way across, and where the way begins."""
    return ends.select(
        "vehicleId",
        "zoneId",
        F.expr("if(enters, -1, 1)").alias("way"),
        # Back from the predecessor of the first position inside, on from the successor of the last one.
        F.expr("if(enters, prev_clock, clock)").alias("at"),
        F.expr("if(enters, prev_seq, seq)").alias("at_seq"),
        F.expr("if(enters, clock, prev_clock)").alias("from_clock"),
        F.expr("if(enters, seq, prev_seq)").alias("from_seq"),
    )


def gap_edges(found: DataFrame, ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Crossings among rows of ``judged_across``, those whose two ends differ, with the columns of their position.

    The position across is inside if it is itself the end of such a row: the first inside after a gap as seen from
    before it, or the last inside before a gap as seen from behind it.
    """
    across = ends.select(
        F.col("vehicleId"),
        F.col("zoneId"),
        F.expr("if(enters, 1, -1)").alias("way"),
        F.expr("if(enters, clock, prev_clock)").alias("at"),
        F.expr("if(enters, seq, prev_seq)").alias("at_seq"),
    ).distinct()
    differ = found.join(across, ["vehicleId", "zoneId", "way", "at", "at_seq"], "left_anti")  # never met by a mere report
    # Gone in between: the crossing is where the vehicle is first judged outside.  Come in between: at the first position inside.
    named = differ.select(
        "vehicleId",
        F.expr("if(way = 1, at, from_clock)").alias("clock"),
        F.expr("if(way = 1, at_seq, from_seq)").alias("seq"),
        "zoneId",
        F.expr(f"if(way = 1, '{EXIT}', '{ENTRY}')").alias("edge"),
    )
    key = ["vehicleId", "clock", "seq"]
    # A repeated position crosses once.
    return positions.join(named, key).dropDuplicates([*key, "zoneId", "edge"]).select(*positions.columns, "zoneId", "edge")


def _gap_crossings(positions: DataFrame, ends: DataFrame, periods: DataFrame, span_ms: int, rows: int) -> DataFrame:
    """Crossings between the last judged state before a zone was switched off and the first after."""
    found, _ = judged_across(gap_asks(ends), periods, positions.select("vehicleId", "clock", "seq"), span_ms, rows=rows)
    return gap_edges(found, ends, positions).withColumn("valid_from", F.lit(None).cast("long"))


def _no_crossings(positions: DataFrame) -> DataFrame:
    edge_type = "array<struct<ax:double,ay:double,bx:double,by:double>>"
    return positions.where(F.lit(False)).select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in (*_ZONE_COLUMNS, "edge")],
        F.lit(None).cast(edge_type).alias("edges"),
    )


def breaches_versioned(
    telemetry: DataFrame,
    versions: DataFrame,
    hold_cap: int | None = None,
    span_ms: int = MILLIS_PER_SEGMENT,
) -> DataFrame:
    """Breach events under live-edited zones; see ``edges_versioned``."""
    return breach_event(edges_versioned(telemetry, versions, hold_cap, span_ms, breaches_only=True))


def prior_state_duration(found: DataFrame, span: int = ARRIVALS_PER_SEGMENT) -> DataFrame:
    """Seconds since the vehicle's previous crossing of the same zone; null for the first one.

    An optional enrichment: breach events themselves report a duration of zero.
    """
    previous = lookback(
        found,
        ["vehicleId", "zoneId"],
        ["seq"],
        span_segment("seq", span),
        {"__since": lambda w: F.lag("timestamp").over(w)},
    )
    seconds = F.floor((F.col("timestamp") - F.col("__since")) / 1000)
    return previous.withColumn("priorStateS", seconds).drop("__since")
