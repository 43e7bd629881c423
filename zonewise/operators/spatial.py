"""Grid index over polygons and the spatial join built on it.

Every zone is covered by the cells of one grid level, the finest level that needs no more
than ``CELLS_PER_ZONE`` cells, so a yard and a country both cost a bounded number of index
rows.  A position looks up its own cell on each level the zones use.  The join is an
equi-join on the cell; the bounding box and the exact polygon test then run on the few
candidates.  Versions of a zone are indexed by time slots in the same manner.

Many zones of a fixed set have an index of their own (``BitIndex``): a cell tells with two bits for each of its 8 by 8 parts
whether the zone covers the part or has an edge near it, so that few candidates need an edge.

Whether the index is broadcast is decided from its measured size.  Beyond the limit the
join shuffles by cell, and adaptive execution splits a cell that holds too many positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.functions import geometry as G
from zonewise.functions.once import once
from zonewise.session import materialize

BASE_CELL_DEG = 0.01
CELL_GROWTH = 4
CELL_LEVELS = 8
CELLS_PER_ZONE = 64

BASE_SLOT_MS = 3_600_000
SLOT_GROWTH = 8
SLOT_LEVELS = 6
SLOTS_PER_VERSION = 4
ALWAYS = SLOT_LEVELS  # level of versions too long, or open-ended, for slots

BROADCAST_LIMIT_BYTES = 64 << 20

#: Zones whose masks one task makes; more are spread over tasks first.
ZONES_PER_TASK = 256

#: A cell of a ``BitIndex`` has so many parts on a side; all of them fit the bits of a long.
BIT_SIDE = 8
#: Edges whose distances Spark computes in one compiled method; Java interprets methods of more than 8000 bytes.
EDGES_IN_STEPS = 6
#: Bytes of a cell of a zone in the broadcast.
_PART_BYTES = 64

NO_KEY = "named_struct('cell', -1L, 'slot', 0L)"  # matches nothing: there are no zones

# A cell key is (level, y, x) in one long, a slot key (level, slot).
_OFFSET = 1 << 28
_WIDTH = 1 << 29
_SLOTS = 1 << 48


def position_cell_sql(lat: str, lon: str, level: int, base: float) -> str:
    """The cell of a position; null, and so in no zone, for coordinates that no place on earth has."""
    size = f"{base * CELL_GROWTH**level!r}D"
    row = f"{level * _WIDTH + _OFFSET}L + floor({lat} / {size})"
    cell = f"({row}) * {_WIDTH}L + floor({lon} / {size}) + {_OFFSET}L"
    return f"CASE WHEN {lat} BETWEEN -1000 AND 1000 AND {lon} BETWEEN -1000 AND 1000 THEN {cell} END"


def position_slot_sql(clock: str, level: int | None) -> str:
    if level is None:
        return "0L"
    start = f"{level * _SLOTS}L"
    return start if level == ALWAYS else f"{start} + floor({clock} / {BASE_SLOT_MS * SLOT_GROWTH**level})"


@dataclass(frozen=True)
class ZoneIndex:
    """Indexed zones plus the facts about them that shape the join."""

    cells: DataFrame  # one row per zone (version) and cell (and slot)
    zones: DataFrame  # one row per zone (version), with edges and box
    combos: tuple[tuple[int, int | None], ...]  # (cell level, slot level) pairs in use
    base_cell: float
    small: bool  # measured size is below the broadcast limit
    masked: bool  # each zone has a mask, which decides most positions; versions have none, they are too many

    def contains_sql(self, lat: str, lon: str) -> str:
        """Does the zone (columns ``box, edges`` and, if masked, ``mask``) contain the position?"""
        if self.masked:
            return f"({G.masked_contain_sql(lat, lon, 'edges', 'box', 'mask')})"
        return f"({G.boxed_contain_sql(lat, lon, 'edges', 'box')})"

    def probe_keys(self, lat: str, lon: str, clock: str | None = None) -> list[str]:
        """SQL structs ``(cell, slot)`` under which a position finds its zones."""
        return [
            f"named_struct('cell', {position_cell_sql(lat, lon, level, self.base_cell)}, "
            f"'slot', {position_slot_sql(clock, slot_level)})"
            for level, slot_level in self.combos
        ]

    def join(self, probes: DataFrame) -> DataFrame:
        """Probes with ``cell`` and ``slot`` against the zones that may contain them."""
        cells = F.broadcast(self.cells) if self.small else self.cells
        return probes.join(cells, ["cell", "slot"]).drop("cell", "slot")


def prepare_zones(zones: DataFrame) -> DataFrame:
    """Zone rows with named columns, prepared edges and bounding box."""
    extra = [c for c in ("valid_from", "valid_to", "activity_from", "activity_to") if c in zones.columns]
    return (
        zones.select(
            F.col("id").alias("zoneId"),
            F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id")).alias("zoneName"),
            F.col("kind").alias("zoneKind"),
            G.ring_edges("polygon").alias("edges"),
            *extra,
        )
        .withColumn("box", G.edges_box("edges"))
    )


def _cover(base: float) -> Column:
    """``struct<level, y0, y1, x0, x1>``: the finest level covering the box in few cells."""
    choices = []
    for level in range(CELL_LEVELS):
        size = f"{base * CELL_GROWTH**level!r}D"
        y0, y1 = f"floor(box.south / {size})", f"floor(box.north / {size})"
        x0, x1 = f"floor(box.west / {size})", f"floor(box.east / {size})"
        fits = f"({y1} - {y0} + 1) * ({x1} - {x0} + 1) <= {CELLS_PER_ZONE}"
        cover = f"named_struct('level', {level}, 'y0', {y0}, 'y1', {y1}, 'x0', {x0}, 'x1', {x1})"
        choices.append(cover if level == CELL_LEVELS - 1 else f"if({fits}, {cover}, null)")
    return F.expr(f"coalesce({', '.join(choices)})")


def _cover_time() -> Column:
    """``struct<level, s0, s1>`` of slots for ``[valid_from, valid_to)``."""
    choices = []
    for level in range(SLOT_LEVELS):
        size = BASE_SLOT_MS * SLOT_GROWTH**level
        s0, s1 = f"floor(valid_from / {size})", f"floor((valid_to - 1) / {size})"
        cover = f"named_struct('level', {level}, 's0', {s0}, 's1', {s1})"
        choices.append(f"if({s1} - {s0} < {SLOTS_PER_VERSION}, {cover}, null)")
    choices.append(f"named_struct('level', {ALWAYS}, 's0', 0L, 's1', 0L)")
    return F.expr(f"coalesce({', '.join(choices)})")


def build_index(
    zones: DataFrame,
    base_cell: float = BASE_CELL_DEG,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> ZoneIndex:
    """Index a zone table, or a table of zone versions when it has ``valid_from``/``valid_to``.

    Runs one small aggregation over the zone table (one result row) to learn which grid
    levels occur and how large the index is.
    """
    versioned = "valid_from" in zones.columns
    prepared = prepare_zones(zones)
    # Fewer than three corners contain nothing, so such rings need no cells.
    covered = prepared.where(F.size("edges") >= 3).withColumn("cover", _cover(base_cell))
    cells = "(cover.y1 - cover.y0 + 1) * (cover.x1 - cover.x0 + 1)"
    slots, slot_level = "1", "cast(null as int)"
    if versioned:
        covered = covered.withColumn("when", _cover_time())
        slots, slot_level = "(`when`.s1 - `when`.s0 + 1)", "`when`.level"
    facts = covered.agg(
        F.expr(f"sort_array(collect_set(struct(cover.level as cell, {slot_level} as slot)))").alias("combos"),
        F.expr(f"sum({cells} * {slots} * (size(edges) * 48 + 256 + {0 if versioned else G.MASK_SIDE ** 2}))").alias("bytes"),
        F.count(F.lit(1)).alias("zones"),
    ).first()

    if not versioned:
        if facts["zones"] > ZONES_PER_TASK:
            # A file of zones is small for Spark, but not the work on each: spread evenly.
            covered = covered.repartition(int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions")), "zoneId")
        covered = covered.withColumn("mask", F.expr(G.edges_mask_sql("edges", "box")))
    spread = covered.withColumn(
        "cell",
        F.expr(
            "explode(flatten(transform(sequence(cover.y0, cover.y1), y -> transform(sequence(cover.x0, cover.x1), "
            f"x -> (cover.level * {_WIDTH}L + y + {_OFFSET}) * {_WIDTH}L + x + {_OFFSET}))))"
        ),
    )
    slot = f"explode(transform(sequence(`when`.s0, `when`.s1), s -> `when`.level * {_SLOTS}L + s))"
    spread = spread.withColumn("slot", F.expr(slot if versioned else "0L"))
    return ZoneIndex(
        cells=spread.drop("cover", "when"),
        zones=prepared,
        combos=tuple((c["cell"], c["slot"]) for c in facts["combos"]),
        base_cell=base_cell,
        small=(facts["bytes"] or 0) <= broadcast_limit,
        masked=not versioned,
    )


def inside_pairs(positions: DataFrame, index: ZoneIndex, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Every (position, zone) pair with the position inside the zone."""
    keys = index.probe_keys(lat, lon) or [NO_KEY]
    probes = positions.withColumn("__key", F.expr(f"explode(array({', '.join(keys)}))")).select(
        *positions.columns, F.col("__key.cell").alias("cell"), F.col("__key.slot").alias("slot")
    )
    return index.join(probes).where(index.contains_sql(lat, lon)).drop("mask")


# ---------------------------------------------------------------- many zones


@dataclass(frozen=True)
class BitIndex:
    """Many zones, each once, and their cells as a number of the zone and bits: small enough to be broadcast."""

    parts: DataFrame  # cell, zone, sure, near: a bit for each part of the cell that the zone covers, or has an edge near
    shapes: DataFrame  # one row per zone, with its box and, if it is ``flat``, its edges as plain numbers
    levels: tuple[int, ...]
    base_cell: float
    edges: int  # most edges of a flat zone
    all_flat: bool

    def with_distance(self, rows: DataFrame, name: str, lat: str, lon: str) -> DataFrame:
        """Rows of ``only_one`` with the metres from a position to the zone's boundary."""
        if self.all_flat and self.edges <= EDGES_IN_STEPS:
            return G.with_flat_distance(rows, name, lat, lon, self.edges)
        scaled = rows.withColumn("__kx", F.expr(G.metres_per_lon_sql(lat)))
        return scaled.withColumn(name, F.expr(G.edges_distance_fast_sql(lat, lon, "edges", "__kx"))).drop("__kx")

    def probe_keys(self, lat: str, lon: str) -> list[str]:
        """SQL structs ``(cell, bit)`` under which a position finds its zones; null for coordinates that no place on earth has."""
        keys = []
        for level in self.levels:
            size = f"{self.base_cell * CELL_GROWTH**level!r}D"
            row, column = (f"int(floor(({v} / {size} - floor({v} / {size})) * {BIT_SIDE}))" for v in (lat, lon))
            key = (
                f"named_struct('cell', {position_cell_sql(lat, lon, level, self.base_cell)}, "
                f"'bit', shiftleft(1L, {row} * {BIT_SIDE} + {column}))"
            )
            keys.append(f"CASE WHEN {lat} BETWEEN -1000 AND 1000 AND {lon} BETWEEN -1000 AND 1000 THEN {key} END")
        return keys

    def only_one(self, probes: DataFrame, condition: str = "true") -> DataFrame:
        """Probes (``cell, bit``, an end ``at_lat, at_lon`` and another ``off_lat, off_lon``) with the zones that contain the
        first end and not the other, and for which ``condition`` (over columns of probes and zone) holds.

        The tests are a semi-join, so what they read of a zone is not copied into the rows.
        """
        found = probes.join(F.broadcast(self.parts), "cell").where("((sure | near) & bit) <> 0")
        found = found.withColumn("known", F.expr("(sure & bit) <> 0")).drop("cell", "bit", "sure", "near")
        tests = self.shapes.select(
            F.col("zone").alias("__zone"), "zoneKind", "south", "north", "west", "east", "flat", "f", F.expr("if(flat, null, edges)").alias("edges")
        )
        on = F.expr(f"zone = __zone AND ({condition}) AND {self._only_one_sql('at', 'off')}")
        names = self.shapes.select("zone", "zoneId", "zoneName", "zoneKind", "edges", "flat", "f")
        return found.join(F.broadcast(tests), on, "left_semi").join(F.broadcast(names), "zone").drop("zone", "known")

    def _only_one_sql(self, at: str, off: str) -> str:
        """CASE keeps Spark from computing what the tests share before it is known which are needed."""
        tests = []
        for end in (at, off):
            lat, lon = f"{end}_lat", f"{end}_lon"
            exact = f"WHEN flat THEN {G.flat_contain_sql(lat, lon, self.edges)} ELSE {G.edges_contain_sql(lat, lon, 'edges')} END"
            outside = f"NOT coalesce({lat} BETWEEN south AND north AND {lon} BETWEEN west AND east, false)"
            known = "WHEN known THEN true " if end == at else ""
            tests.append(f"CASE {known}WHEN {outside} THEN false {exact}")
        return f"CASE WHEN {tests[0]} THEN NOT ({tests[1]}) ELSE false END"


def bit_index(
    zones: DataFrame, base_cell: float = BASE_CELL_DEG, broadcast_limit: int = BROADCAST_LIMIT_BYTES, few: int = ZONES_PER_TASK
) -> BitIndex | None:
    """The index of a fixed set of more than ``few`` zones, if it can be broadcast; else null."""
    prepared = prepare_zones(zones).where(F.size("edges") >= 3).withColumn("cover", _cover(base_cell))
    cells = "(cover.y1 - cover.y0 + 1) * (cover.x1 - cover.x0 + 1)"
    # Nine numbers and a share of ``edges`` for each edge, 256 for the rest of the row.
    facts = prepared.withColumn("flat", F.expr(G.flat_sql("edges"))).agg(
        F.count(F.lit(1)).alias("zones"),
        F.max(F.expr("if(flat, size(edges), 0)")).alias("edges"),
        F.sum(F.expr(f"{cells} * {_PART_BYTES}")).alias("parts_bytes"),
        F.sum(F.expr("size(edges) * 48 + 256")).alias("shapes_bytes"),
        F.expr("sort_array(collect_set(cover.level))").alias("levels"),
        F.bool_and("flat").alias("all_flat"),
    ).first()
    if facts["zones"] <= few:
        return None
    n = max(facts["edges"], 3)
    if max(facts["parts_bytes"], facts["shapes_bytes"] + facts["zones"] * n * 72) > broadcast_limit:
        return None
    tasks = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of a zone holds because its row is kept.
    shapes = materialize(
        prepared.repartition(tasks).select(
            F.monotonically_increasing_id().alias("zone"),
            *[c for c in prepared.columns if c != "box"],
            "box.*",
            F.expr(G.flat_sql("edges")).alias("flat"),
            F.expr(G.usual_edges_sql("edges")).alias("usual"),
            G.flat_edges("edges", n).alias("f"),
        )
    )
    return BitIndex(_bit_parts(shapes, base_cell, n), shapes.drop("cover", "usual"), tuple(facts["levels"]), base_cell, n, facts["all_flat"])


def _bit_parts(shapes: DataFrame, base_cell: float, n: int) -> DataFrame:
    """``cell, zone, sure, near`` of the rows of ``bit_index``."""
    sizes = ", ".join(f"{base_cell * CELL_GROWTH**level!r}D" for level in range(CELL_LEVELS))
    place = f"""struct((cover.level * {_WIDTH}L + y + {_OFFSET}) * {_WIDTH}L + x + {_OFFSET} AS cell, part,
                       (y + (part div {BIT_SIDE} + 0.5D) / {BIT_SIDE}) * size AS cy, (x + (part % {BIT_SIDE} + 0.5D) / {BIT_SIDE}) * size AS cx,
                       size / {2 * BIT_SIDE} AS half)"""
    places = (
        shapes.withColumn("size", F.expr(f"get(array({sizes}), cover.level)"))
        .withColumn("y", F.expr("explode(sequence(cover.y0, cover.y1))"))
        .withColumn("x", F.expr("explode(sequence(cover.x0, cover.x1))"))
        .withColumn("part", F.expr(f"explode(sequence(0, {BIT_SIDE**2 - 1}))"))
        .withColumn("place", once(F.expr(place)))
        .select("zone", "place.*", "edges", "flat", "usual", "f")
    )
    at = ("cy", "cx")
    kind = f"""CASE WHEN flat THEN CASE WHEN {G.flat_near_sql(*at, 'half', n)} THEN 2 WHEN {G.flat_contain_sql(*at, n)} THEN 1 ELSE 0 END
                    WHEN usual THEN CASE WHEN {G.edges_near_sql(*at, 'half', 'edges')} THEN 2 WHEN {G.edges_contain_sql(*at, 'edges')} THEN 1 ELSE 0 END
                    ELSE 2 END"""
    bit = "shiftleft(1L, part)"
    return (
        places.select("cell", "zone", "part", F.expr(kind).alias("kind"))
        .groupBy("cell", "zone")
        .agg(F.expr(f"bit_or(if(kind = 1, {bit}, 0L))").alias("sure"), F.expr(f"bit_or(if(kind = 2, {bit}, 0L))").alias("near"))
        .where("(sure | near) <> 0")
    )
