"""Polygon and track geometry as Column expressions.

Arguments are column names, SQL expressions or numbers, like those of ``F.expr``; the
expressions are built as SQL text because one parsed text is far cheaper to set up than a
tree of Column calls.  ``*_sql`` functions return the text itself for use inside others.

A ring is ``array<array<double>>`` of ``[lat, lon]`` points, closed or not.  Rings are
turned once into an array of directed edges (``ring_edges``); containment and distance
are then folds over that array, so a table of polygons pays for the preparation once
per polygon and not once per position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.functions.once import let_sql

# Fixed values.
ON_EDGE_EPS = 1e-9
METRES_PER_DEGREE = 111_320.0
LAST_PROGRESS = 0.9999

#: Polygons of up to so many edges are tested by expressions written out edge by edge, which Spark compiles; the folds over
#: longer ones are interpreted.
EDGES_WRITTEN_OUT = 8

_EPS = f"{ON_EDGE_EPS!r}D"
_METRES = f"{METRES_PER_DEGREE!r}D"


def _text(value: str | float) -> str:
    """A SQL operand: the expression in parentheses, or a double literal."""
    return f"({value})" if isinstance(value, str) else f"({float(value)!r}D)"


# ---------------------------------------------------------------- rings


def open_ring_sql(ring: str) -> str:
    closed = "size(r) > 1 AND get(r, 0) = get(r, size(r) - 1)"
    return let_sql("r", ring, f"if({closed}, slice(r, 1, size(r) - 1), r)")


def open_ring(ring: str) -> Column:
    """The ring without its closing duplicate point."""
    return F.expr(open_ring_sql(ring))


def ring_edges_sql(ring: str) -> str:
    edge = ", ".join(
        f"'{name}', cast(get({point}, {i}) AS double)"
        for name, point, i in (("ax", "a", 1), ("ay", "a", 0), ("bx", "b", 1), ("by", "b", 0))
    )
    followers = "concat(slice(p, 2, greatest(size(p) - 1, 0)), slice(p, 1, 1))"
    return let_sql("p", open_ring_sql(ring), f"zip_with(p, {followers}, (a, b) -> named_struct({edge}))")


def ring_edges(ring: str) -> Column:
    """``array<struct<ax, ay, bx, by>>`` with x = longitude and y = latitude."""
    return F.expr(ring_edges_sql(ring))


def edges_box(edges: str) -> Column:
    """Bounding box of the edges, widened by the on-edge tolerance."""
    sides = [("south", "min", "ay", "-"), ("north", "max", "ay", "+"), ("west", "min", "ax", "-"), ("east", "max", "ax", "+")]
    fields = ", ".join(
        f"'{side}', array_{pick}(transform({edges}, e -> e.{axis})) {sign} {_EPS}" for side, pick, axis, sign in sides
    )
    return F.expr(f"named_struct({fields})")


def in_box_sql(lat: str, lon: str, box: str) -> str:
    return f"({lat} BETWEEN {box}.south AND {box}.north AND {lon} BETWEEN {box}.west AND {box}.east)"


# ---------------------------------------------------------------- containment


def edges_contain_sql(lat: str | float, lon: str | float, edges: str, boundary_inside: bool = True) -> str:
    touches, crosses = _touches_sql(lat, lon, "e"), _crosses_sql(lat, lon, "e")
    return (
        f"CASE WHEN size({edges}) < 3 THEN false "
        f"WHEN exists({edges}, e -> {touches}) THEN {str(boundary_inside).lower()} "
        f"ELSE size(filter({edges}, e -> {crosses})) % 2 = 1 END"
    )


def _touches_sql(lat: str | float, lon: str | float, e: str) -> str:
    y, x = _text(lat), _text(lon)
    return (
        f"{y} BETWEEN least({e}.ay, {e}.by) - {_EPS} AND greatest({e}.ay, {e}.by) + {_EPS} "
        f"AND {x} BETWEEN least({e}.ax, {e}.bx) - {_EPS} AND greatest({e}.ax, {e}.bx) + {_EPS} "
        f"AND abs(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax)) <= {_EPS}"
    )


def _crosses_sql(lat: str | float, lon: str | float, e: str) -> str:
    y, x = _text(lat), _text(lon)
    return (
        f"({e}.ay > {y}) <> ({e}.by > {y}) "
        f"AND {x} < try_divide(({e}.bx - {e}.ax) * ({y} - {e}.ay), {e}.by - {e}.ay) + {e}.ax"
    )


def edges_contain_fast_sql(lat: str, lon: str, edges: str, boundary_inside: bool = True) -> str:
    """``edges_contain_sql`` for tests of many pairs: the same arithmetic, compiled for polygons of few edges."""
    each = [f"get({edges}, {i})" for i in range(EDGES_WRITTEN_OUT)]
    touches = " OR ".join(f"({_touches_sql(lat, lon, e)})" for e in each)
    crossed = " + ".join(f"if({_crosses_sql(lat, lon, e)}, 1, 0)" for e in each)
    return (
        f"CASE WHEN size({edges}) < 3 THEN false "
        f"WHEN size({edges}) > {EDGES_WRITTEN_OUT} THEN {edges_contain_sql(lat, lon, edges, boundary_inside)} "
        f"WHEN {touches} THEN {str(boundary_inside).lower()} "
        f"ELSE ({crossed}) % 2 = 1 END"
    )


#: A mask divides a polygon's box into so many rows and columns.
MASK_SIDE = 16
_OUTSIDE, _INSIDE, _MIXED = 0, 1, 2
#: Twice the on-edge tolerance: also covers the rounding of a position's place in the mask.
_MARGIN = f"{2 * ON_EDGE_EPS!r}D"


def _near_sql(y: str, x: str, high: str, wide: str) -> str:
    """Does the edge ``e`` come near the part around ``y, x`` that reaches ``high`` and ``wide`` to its sides?"""
    return (
        f"least(e.ay, e.by) <= {y} + {high} + {_MARGIN} AND greatest(e.ay, e.by) >= {y} - {high} - {_MARGIN} "
        f"AND least(e.ax, e.bx) <= {x} + {wide} + {_MARGIN} AND greatest(e.ax, e.bx) >= {x} - {wide} - {_MARGIN} "
        f"AND abs((e.bx - e.ax) * ({y} - e.ay) - (e.by - e.ay) * ({x} - e.ax)) "
        f"<= abs(e.bx - e.ax) * ({high} + {_MARGIN}) + abs(e.by - e.ay) * ({wide} + {_MARGIN}) + {_MARGIN}"
    )


def edges_near_sql(y: str, x: str, half: str, edges: str) -> str:
    """Does an edge come near the square part of the map around ``y, x`` that reaches ``half`` to each side?"""
    return f"exists({edges}, e -> {_near_sql(y, x, half, half)})"


def edges_mask_sql(edges: str, box: str) -> str:
    """``array<tinyint>``: for each part of the box, row by row, whether all of it is inside, all outside, or an edge comes near.

    An edge is near a part if their boxes meet and the edge's line passes through the part.
    """
    high, wide = f"(({box}.north - {box}.south) / {MASK_SIDE})", f"(({box}.east - {box}.west) / {MASK_SIDE})"
    near = _near_sql("c.y", "c.x", f"{high} / 2", f"{wide} / 2")
    usual = usual_edges_sql(edges)
    part = (
        f"CASE WHEN exists({edges}, e -> {near}) THEN {_MIXED} "
        f"WHEN {edges_contain_sql('c.y', 'c.x', edges)} THEN {_INSIDE} ELSE {_OUTSIDE} END"
    )
    centre = (
        f"named_struct('y', {box}.south + (i div {MASK_SIDE} + 0.5D) * {high}, 'x', {box}.west + (i % {MASK_SIDE} + 0.5D) * {wide})"
    )
    parts = f"transform(transform(sequence(0, {MASK_SIDE**2 - 1}), i -> {centre}), c -> tinyint({part}))"
    return f"if({usual}, {parts}, null)"


def masked_contain_sql(lat: str, lon: str, edges: str, box: str, mask: str) -> str:
    """Is the position in the box and the polygon: the mask decides, and the edges where one is near.

    One CASE: of conditions joined by AND, Spark computes what they share before the first of them.
    """
    row, column = (
        f"least({MASK_SIDE - 1}, int(floor(({v} - {box}.{low}) * {MASK_SIDE} / ({box}.{top} - {box}.{low}))))"
        for v, low, top in ((lat, "south", "north"), (lon, "west", "east"))
    )
    exact = edges_contain_fast_sql(lat, lon, edges)
    part = f"coalesce(get({mask}, {row} * {MASK_SIDE} + {column}), {_MIXED})"
    return (
        f"CASE WHEN NOT coalesce({in_box_sql(lat, lon, box)}, false) THEN false "
        f"WHEN {part} = {_INSIDE} THEN true WHEN {part} = {_OUTSIDE} THEN false ELSE {exact} END"
    )


def boxed_contain_sql(lat: str, lon: str, edges: str, box: str) -> str:
    """The same without a mask."""
    exact = edges_contain_fast_sql(lat, lon, edges)
    return f"CASE WHEN NOT coalesce({in_box_sql(lat, lon, box)}, false) THEN false WHEN size({edges}) < 3 THEN false ELSE {exact} END"


def edges_contain(lat: str | float, lon: str | float, edges: str, boundary_inside: bool = True) -> Column:
    """Containment for a prepared edge array; the boundary counts as inside by default."""
    return F.expr(edges_contain_sql(lat, lon, edges, boundary_inside))


def point_in_polygon(lat: str | float, lon: str | float, ring: str, boundary_inside: bool = True) -> Column:
    """Is the position inside the ring?  Concave rings are fine; fewer than 3 points never contain."""
    contained = edges_contain_sql(lat, lon, "edges_", boundary_inside)
    return F.expr(let_sql("edges_", ring_edges_sql(ring), contained))


# ---------------------------------------------------------------- distance


def edges_distance_sql(lat: str | float, lon: str | float, edges: str) -> str:
    y, x = _text(lat), _text(lon)
    # Metres per degree of longitude at this latitude, then each edge relative to the position.
    local = (
        f"named_struct('ax', (e.ax - {x}) * kx, 'ay', (e.ay - {y}) * {_METRES}, "
        f"'dx', (e.bx - e.ax) * kx, 'dy', (e.by - e.ay) * {_METRES})"
    )
    along = (
        "greatest(0D, least(1D, coalesce("
        "try_divide(-(s.ax * s.dx + s.ay * s.dy), s.dx * s.dx + s.dy * s.dy), 0D)))"
    )
    distance = let_sql("t", along, "hypot(s.ax + t * s.dx, s.ay + t * s.dy)")
    nearest = f"array_min(transform(transform({edges}, e -> {local}), s -> {distance}))"
    scaled = let_sql("kx", metres_per_lon_sql(lat), nearest)
    return f"if(size({edges}) < 2, double('Infinity'), {scaled})"


def edges_distance_fast_sql(lat: str, lon: str, edges: str, kx: str) -> str:
    """``edges_distance_sql`` for many rows: the same arithmetic, compiled for polygons of few edges.

    ``kx`` is a column of metres per degree of longitude (``metres_per_lon_sql``).
    """
    y, x = _text(lat), _text(lon)

    def distance(e: str) -> str:
        ax, ay = f"(({e}.ax - {x}) * {kx})", f"(({e}.ay - {y}) * {_METRES})"
        dx, dy = f"(({e}.bx - {e}.ax) * {kx})", f"(({e}.by - {e}.ay) * {_METRES})"
        t = f"greatest(0D, least(1D, coalesce(try_divide(-({ax} * {dx} + {ay} * {dy}), {dx} * {dx} + {dy} * {dy}), 0D)))"
        return f"hypot({ax} + {t} * {dx}, {ay} + {t} * {dy})"

    nearest = ", ".join(f"if({i} < size({edges}), {distance(f'get({edges}, {i})')}, null)" for i in range(EDGES_WRITTEN_OUT))
    few = f"if(size({edges}) < 2, double('Infinity'), least({nearest}))"
    return f"if(size({edges}) > {EDGES_WRITTEN_OUT}, {edges_distance_sql(lat, lon, edges)}, {few})"


def metres_per_lon_sql(lat: str | float) -> str:
    return f"{_METRES} * cos(radians({_text(lat)}))"


def edges_distance_m(lat: str | float, lon: str | float, edges: str) -> Column:
    """Metres to the nearest edge in a local equirectangular projection around the position."""
    return F.expr(edges_distance_sql(lat, lon, edges))


def distance_to_boundary_m(lat: str | float, lon: str | float, ring: str) -> Column:
    return F.expr(let_sql("edges_", ring_edges_sql(ring), edges_distance_sql(lat, lon, "edges_")))


# ---------------------------------------------------------------- few edges, one column each part


#: What each field of ``flat_edges`` holds.
FLAT_PARTS = {
    "ax": "{e}.ax",
    "ay": "{e}.ay",
    "by": "{e}.by",
    "dx": "{e}.bx - {e}.ax",
    "dy": "{e}.by - {e}.ay",
    "south": f"least({{e}}.ay, {{e}}.by) - {_EPS}",
    "north": f"greatest({{e}}.ay, {{e}}.by) + {_EPS}",
    "west": f"least({{e}}.ax, {{e}}.bx) - {_EPS}",
    "east": f"greatest({{e}}.ax, {{e}}.bx) + {_EPS}",
}


def flat_edges(edges: str, n: int) -> Column:
    """The first ``n`` edges as one struct of numbers, ``e0_ax, e0_ay, ...``, NaN where there is no such edge.

    An edge of NaN is met by no test: Spark sorts NaN above all numbers.  For polygons that are ``flat_sql``.
    """
    fields = [
        F.expr(f"coalesce({made.format(e=f'get({edges}, {i})')}, double('NaN'))").alias(f"e{i}_{part}")
        for i in range(n)
        for part, made in FLAT_PARTS.items()
    ]
    return F.struct(*fields)


def flat_sql(edges: str) -> str:
    """Do ``flat_edges`` tell all of the polygon?"""
    return f"(size({edges}) <= {EDGES_WRITTEN_OUT} AND {usual_edges_sql(edges)})"


def usual_edges_sql(edges: str) -> str:
    """Are all coordinates there, and of a size that arithmetic near the tolerance bears?"""
    return f"forall({edges}, e -> coalesce(abs(e.ax) + abs(e.ay) + abs(e.bx) + abs(e.by) <= 1e6D, false))"


def flat_contain_sql(lat: str, lon: str, n: int) -> str:
    """``edges_contain_sql`` over ``flat_edges`` in a column ``f``: the same arithmetic on fields that are read only where an edge is asked for."""
    touches = " OR ".join(
        f"({lat} BETWEEN f.e{i}_south AND f.e{i}_north AND {lon} BETWEEN f.e{i}_west AND f.e{i}_east "
        f"AND abs(f.e{i}_dx * ({lat} - f.e{i}_ay) - f.e{i}_dy * ({lon} - f.e{i}_ax)) <= {_EPS})"
        for i in range(n)
    )
    # The ends of an edge that is crossed differ in height, so nothing is divided by zero.
    crossed = " + ".join(
        f"if((f.e{i}_ay > {lat}) <> (f.e{i}_by > {lat}) AND {lon} < f.e{i}_dx * ({lat} - f.e{i}_ay) / f.e{i}_dy + f.e{i}_ax, 1, 0)"
        for i in range(n)
    )
    return f"({touches} OR ({crossed}) % 2 = 1)"


def flat_near_sql(y: str, x: str, half: str, n: int) -> str:
    """``edges_near_sql`` over ``flat_edges``."""
    reach = f"({half} + {_MARGIN})"
    return " OR ".join(
        f"(f.e{i}_south <= {y} + {reach} AND f.e{i}_north >= {y} - {reach} AND f.e{i}_west <= {x} + {reach} AND f.e{i}_east >= {x} - {reach} "
        f"AND abs(f.e{i}_dx * ({y} - f.e{i}_ay) - f.e{i}_dy * ({x} - f.e{i}_ax)) <= (abs(f.e{i}_dx) + abs(f.e{i}_dy)) * {reach} + {_MARGIN})"
        for i in range(n)
    )


def with_flat_distance(rows: DataFrame, name: str, lat: str, lon: str, n: int) -> DataFrame:
    """Rows with ``edges_distance_sql`` over ``flat_edges`` of at least two edges: the same arithmetic, one step after the other.

    In steps, as Spark computes a column once but an expression wherever it stands.
    """
    known = rows.columns
    place = rows.selectExpr("*", f"coalesce({lat}, double('NaN')) AS __y", f"coalesce({lon}, double('NaN')) AS __x")
    scaled = place.withColumn("__k", F.expr(metres_per_lon_sql("__y")))
    parts = {"ax": "(f.e{i}_ax - __x) * __k", "ay": "(f.e{i}_ay - __y) * {m}", "dx": "f.e{i}_dx * __k", "dy": "f.e{i}_dy * {m}"}
    local = scaled.selectExpr("*", *[f"{made.format(i=i, m=_METRES)} AS __{part}{i}" for i in range(n) for part, made in parts.items()])
    share = "coalesce(try_divide(-(__ax{i} * __dx{i} + __ay{i} * __dy{i}), __dx{i} * __dx{i} + __dy{i} * __dy{i}), 0D)"
    along = local.selectExpr("*", *[f"greatest(0D, least(1D, {share.format(i=i)})) AS __t{i}" for i in range(n)])
    # Spark's ``least`` sorts NaN, the distance to an edge that is not there, above all numbers.
    nearest = ", ".join(f"hypot(__ax{i} + __t{i} * __dx{i}, __ay{i} + __t{i} * __dy{i})" for i in range(n))
    return along.selectExpr(*known, f"if({lat} IS NULL OR {lon} IS NULL, null, least({nearest})) AS {name}")


# ---------------------------------------------------------------- tracks


def bearing_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    turn = f"(radians({lon2}) - radians({lon1}))"
    east = f"sin({turn}) * cos({p2})"
    north = f"cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({turn})"
    return f"pmod(degrees(atan2({east}, {north})) + 360, 360)"


def bearing_deg(lat1: str | float, lon1: str | float, lat2: str | float, lon2: str | float) -> Column:
    """Initial bearing from the first to the second point, in [0, 360)."""
    return F.expr(bearing_sql(*[_text(v) for v in (lat1, lon1, lat2, lon2)]))


def position_along(route: str, progress: str | float) -> Column:
    """``struct<lat, lon, heading>`` at ``progress`` of a polyline; every leg has equal weight."""
    scaled = f"least(greatest({_text(progress)}, 0D), {LAST_PROGRESS!r}D) * (size({route}) - 1)"
    a, b = f"get({route}, int(floor(s)))", f"get({route}, int(floor(s)) + 1)"
    lat1, lon1, lat2, lon2 = f"get({a}, 0)", f"get({a}, 1)", f"get({b}, 0)", f"get({b}, 1)"
    place = (
        f"named_struct('lat', {lat1} + ({lat2} - {lat1}) * (s - floor(s)), "
        f"'lon', {lon1} + ({lon2} - {lon1}) * (s - floor(s)), "
        f"'heading', {bearing_sql(lat1, lon1, lat2, lon2)})"
    )
    return F.expr(f"if(size({route}) > 1, {let_sql('s', scaled, place)}, null)")
