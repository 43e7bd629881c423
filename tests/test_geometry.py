import math
import random

import pytest
from pyspark.sql import functions as F

from zonewise.functions import geometry as G
from zonewise.functions import quality as Q
from zonewise.operators import spatial
from zonewise.sources.fixed import local_table, seed_zones
from zonewise.schemas import ZONE

L_RING = [[0.0, 0.0], [0.0, 4.0], [2.0, 4.0], [2.0, 2.0], [4.0, 2.0], [4.0, 0.0], [0.0, 0.0]]


def _rings(spark, ring, points):
    return spark.createDataFrame([(ring, float(a), float(b)) for a, b in points], "ring array<array<double>>, lat double, lon double")


def _inside(spark, ring, points, **kw):
    rows = _rings(spark, ring, points).select("lat", "lon", G.point_in_polygon("lat", "lon", "ring", **kw).alias("i"))
    return {(r.lat, r.lon): r.i for r in rows.collect()}


def test_concave_ring(spark):
    want = {
        (1, 1): True,
        (3, 1): True,
        (1, 3): True,
        (3, 3): False,
        (5, 5): False,
        (1, -1): False,
        (0, 2): True,
        (3, 2): True,
        (-0.0001, 2): False,
    }
    assert _inside(spark, L_RING, want) == want


def test_strict_interior_and_degenerate_rings(spark):
    assert _inside(spark, L_RING, [(0, 2)], boundary_inside=False) == {(0, 2): False}
    assert _inside(spark, [[0.0, 0.0], [1.0, 1.0]], [(0.5, 0.5)]) == {(0.5, 0.5): False}
    assert _inside(spark, [[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]], [(0.5, 0.5)]) == {(0.5, 0.5): False}


def test_closing_and_rotation_do_not_matter(spark):
    rng = random.Random(4)
    points = [(rng.uniform(-1, 5), rng.uniform(-1, 5)) for _ in range(200)]
    open_ring = L_RING[:-1]
    want = _inside(spark, L_RING, points)
    for turn in range(len(open_ring)):
        assert _inside(spark, open_ring[turn:] + open_ring[:turn], points) == want


def test_distance_to_boundary(spark):
    rows = _rings(spark, L_RING, [(-0.0001, 2), (0, 2)]).select(G.distance_to_boundary_m("lat", "lon", "ring").alias("d"))
    near, on = [r.d for r in rows.collect()]
    assert 10 < near < 13 and on < 1e-6
    single = _rings(spark, [[1.0, 1.0]], [(0, 0)]).select(G.distance_to_boundary_m("lat", "lon", "ring").alias("d"))
    assert math.isinf(single.first().d)
    repeated = _rings(spark, [[1.0, 1.0], [1.0, 1.0], [1.0, 2.0]], [(1.0, 0.0)])
    d = repeated.select(G.distance_to_boundary_m("lat", "lon", "ring").alias("d")).first().d
    assert d == pytest.approx(111320.0 * math.cos(math.radians(1.0)))


def test_bearing_and_position_along(spark):
    one = spark.range(1)
    north, east, west = one.select(
        G.bearing_deg(0.0, 0.0, 1.0, 0.0), G.bearing_deg(0.0, 0.0, 0.0, 1.0), G.bearing_deg(0.0, 1.0, 0.0, 0.0)
    ).first()
    assert (north, east, west) == (pytest.approx(0), pytest.approx(90), pytest.approx(270))
    route = spark.createDataFrame([([[0.0, 10.0], [0.0, 10.5], [0.0, 11.0]],)], "route array<array<double>>")
    start, middle, end = route.select(
        G.position_along("route", -1.0), G.position_along("route", 0.5), G.position_along("route", 7.0)
    ).first()
    assert (start.lat, start.lon) == (0.0, 10.0)
    assert middle.lon == pytest.approx(10.5)
    assert end.lon == pytest.approx(11.0, abs=1e-3) and end.heading == pytest.approx(90, abs=0.1)


def test_seed_zones_are_valid(spark):
    zones = seed_zones(spark)
    assert zones.count() == 4 and zones.where("active").count() == 4
    assert zones.select(F.explode(Q.zone_errors("id", "polygon"))).count() == 0


def test_zone_errors(spark):
    rows = [
        ("short", [[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]),
        ("open", [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]),
        ("range", [[91.0, 0.0], [1.0, 0.0], [1.0, 181.0], [91.0, 0.0]]),
        ("empty", []),
    ]
    df = spark.createDataFrame(rows, "id string, polygon array<array<double>>")
    found = {r.id: r.e for r in df.select("id", Q.zone_errors("id", "polygon").alias("e")).collect()}
    assert found["short"] == ["short: polygon needs >= 4 points (closed ring with >= 3 vertices)"]
    assert found["open"] == ["open: polygon ring is not closed"]
    assert [e.split("[")[0] for e in found["range"]] == ["range: point out of range "] * 3
    assert len(found["empty"]) == 2


def _random_ring(rng, lat, lon, size):
    n = rng.randint(3, 8)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [[lat + size * rng.uniform(0.3, 1) * math.sin(a), lon + size * rng.uniform(0.3, 1) * math.cos(a)] for a in angles]


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_index_finds_what_testing_every_pair_finds(spark, limit):
    """Zones of very different sizes, broadcast and shuffled."""
    rng = random.Random(7)
    zones = [
        {"id": f"z{i}", "name": None, "kind": "dwell", "polygon": _random_ring(rng, rng.uniform(50, 52), rng.uniform(-115, -113), size), "active": True}
        for i, size in enumerate([0.002, 0.01, 0.05, 0.2, 1.0, 5.0, 30.0] * 4)
    ]
    table = local_table(spark, zones, ZONE)
    points = [(i, rng.uniform(49, 53), rng.uniform(-116, -112)) for i in range(1500)]
    positions = spark.createDataFrame(points, "seq long, lat double, lon double")
    index = spatial.build_index(table, broadcast_limit=limit)
    assert len(index.combos) > 3 and index.small == (limit > 0)
    got = spatial.inside_pairs(positions, index).select("seq", "zoneId").collect()
    pairs = positions.join(table.select("id", "polygon"))
    want = pairs.where(G.point_in_polygon("lat", "lon", "polygon")).select("seq", "id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 1000


def test_masks_decide_like_the_edges(spark):
    """The mask and the written-out test agree with the folds, on edges too, and leave few positions to the edges."""
    rng = random.Random(8)
    rings = []
    for n in (3, 4, 6, 8, 9, 14):
        spokes = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        rings.append([[51 + rng.uniform(0.2, 1) * math.sin(s) / 100, -114 + rng.uniform(0.2, 1) * math.cos(s) / 100] for s in spokes])
    rings += [[[51.0, -114.0], [51.01, -114.0], [51.01, -113.99], [51.0, -113.99]], [[51.0, -114.0], [51.0, -114.0], [51.0, -114.0]], [[51.0, -114.0]]]
    rings.append([[51.0, None], [51.01, -114.0], [51.01, -113.99]])
    zones = [{"id": f"z{i}", "kind": "dwell", "active": True, "polygon": r} for i, r in enumerate(rings)]
    index = spatial.build_index(local_table(spark, zones, ZONE))
    assert index.masked
    spots = [(rng.uniform(50.99, 51.01), rng.uniform(-114.01, -113.99)) for _ in range(1500)]
    for ring in rings:
        for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]):
            if None not in (a, b, c, d):
                spots += [(a, b), ((a + c) / 2, (b + d) / 2), (a + (c - a) * 0.3 + 5e-10, b + (d - b) * 0.3), (a + 3e-9, b - 3e-9)]
    positions = spark.createDataFrame([*spots, (float("nan"), -114.0), (None, -114.0)], "lat double, lon double")
    zoned = spatial.prepare_zones(local_table(spark, zones, ZONE)).withColumn("mask", F.expr(G.edges_mask_sql("edges", "box")))
    plain = f"coalesce({G.in_box_sql('lat', 'lon', 'box')} AND {G.edges_contain_sql('lat', 'lon', 'edges')}, false)"
    pairs = positions.crossJoin(zoned).selectExpr(
        f"{plain} AS want",
        f"coalesce({G.masked_contain_sql('lat', 'lon', 'edges', 'box', 'mask')}, false) AS masked",
        f"coalesce({G.boxed_contain_sql('lat', 'lon', 'edges', 'box')}, false) AS boxed",
        f"round({G.edges_distance_sql('lat', 'lon', 'edges')}, 6) AS far",
        f"round({G.edges_distance_fast_sql('lat', 'lon', 'edges', G.metres_per_lon_sql('lat'))}, 6) AS fast",
    )
    assert pairs.where("want").count() > 100
    assert pairs.where("want <> masked OR want <> boxed OR NOT far <=> fast").collect() == []
    left = zoned.where("zoneId = 'z6'").selectExpr(f"size(filter(mask, m -> m = {G._MIXED})) AS n").first().n
    assert left <= 4 * G.MASK_SIDE
