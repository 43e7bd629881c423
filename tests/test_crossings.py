"""Detector sequences, live zone edits, and random histories against a direct simulation."""

import random

import pytest
from pyspark.sql import functions as F

from zonewise.operators import crossings as X
from zonewise.operators.ordered import span_segment
from zonewise.operators.zones import zone_versions
from zonewise.schemas import TELEMETRY, ZONE, ZONE_CHANGE
from zonewise.sources.fixed import local_table


def square(low, high):
    return [[low, low], [low, high], [high, high], [high, low], [low, low]]


ZONES = {"excl": ("exclusion", square(0.0, 2.0)), "cont": ("containment", square(10.0, 12.0)), "dwell": ("dwell", square(20.0, 22.0))}


def zones(spark, *names):
    rows = [{"id": n, "kind": ZONES[n][0], "polygon": ZONES[n][1], "active": True} for n in names]
    return local_table(spark, rows, ZONE)


def pings(spark, points, vehicle="v", start=1000):
    rows = [
        {
            "vehicleId": vehicle,
            "seq": i,
            "timestamp": start + i,
            "location": {"latitude": float(a), "longitude": float(b), "accuracy": 3.0, "speed": 40.0},
        }
        for i, (a, b) in enumerate(points)
    ]
    return local_table(spark, rows, TELEMETRY)


def change(op, name, pos, seq=0, active=True, ring=None):
    kind, polygon = ZONES[name]
    return {"op": op, "id": name, "active": active, "kind": kind, "polygon": ring or polygon, "updatedAt": pos, "seq": seq}


def versions(spark, changes):
    return zone_versions(local_table(spark, changes, ZONE_CHANGE))


def types(found):
    return [r.breachType for r in found.orderBy("seq").collect()]


@pytest.mark.parametrize(
    "names,points,want",
    [
        (["excl"], [(5, 5), (1, 1), (1.5, 1.5)], ["entry"]),
        (["excl"], [(1, 1), (5, 5)], []),
        (["cont"], [(11, 11), (15, 15)], ["exit"]),
        (["cont"], [(15, 15), (11, 11)], []),
        (["dwell"], [(25, 25), (21, 21), (25, 25)], ["entry", "exit"]),
        (["excl", "cont"], [(11, 11), (11.2, 11.2), (11.5, 11.5), (11.1, 10.9)], []),
        ([], [(1, 1)], []),
    ],
)
def test_sequences(spark, names, points, want):
    found = X.breaches(pings(spark, points), zones(spark, *names))
    assert types(found) == want


def test_breach_event_fields(spark):
    telemetry = pings(spark, [(5, 5), (1, 1)]).withColumn("ingestTime", F.col("timestamp") + 180)
    event = X.breaches(telemetry, zones(spark, "excl")).first()
    assert (event.zoneName, event.zoneKind, event.distanceOutsideM, event.durationInStateS) == ("excl", "exclusion", 0.0, 0)
    assert event.location.asDict() == {"latitude": 1.0, "longitude": 1.0, "accuracy": 3.0}
    assert event.vehicle.speed == 40.0 and event.vehicle.ignition is None
    assert event.trace.eventTime == 1001 and event.trace.ingestTime == 1181 and event.trace.flinkRead is None
    assert "severity" not in event and "reason" not in event
    exit_event = X.breaches(pings(spark, [(11, 11), (15, 15)]), zones(spark, "cont")).first()
    assert exit_event.distanceOutsideM > 0


def test_edges_of_a_flag_sequence(spark):
    def edges(flags):
        df = spark.createDataFrame([(flags,)], "f array<boolean>")
        return [tuple(e) for e in df.select(X.edges_of_sequence(F.col("f")).alias("e")).first().e]

    assert edges([False, False, True, True, False, False]) == [(2, "entry"), (4, "exit")]
    assert edges([True, False, True]) == [(1, "exit"), (2, "entry")]
    assert edges([]) == [] and edges([True]) == []


def test_deactivated_zone_reports_nothing(spark):
    log = [change("INSERT", "excl", 0), change("MODIFY", "excl", 1002, 1, active=False)]
    found = X.breaches_versioned(pings(spark, [(5, 5), (1, 1), (5, 5), (1, 1)]), versions(spark, log))
    assert types(found) == ["entry"]


@pytest.mark.parametrize("points,want", [([(5, 5), (1, 1)], ["entry"]), ([(5, 5), (6, 6)], [])])
def test_positions_before_the_first_zone_are_replayed(spark, points, want):
    found = X.breaches_versioned(pings(spark, points), versions(spark, [change("INSERT", "excl", 5000)]))
    assert types(found) == want


def test_hold_keeps_every_early_position(spark):
    points = [(1, 1)] + [(5, 5)] * 999 + [(1, 1)]
    log = versions(spark, [change("INSERT", "excl", 10_000)])
    assert types(X.breaches_versioned(pings(spark, points), log)) == ["entry"]
    kept = X.hold_until(X.judged_positions(pings(spark, points)), 10_000)
    assert kept.count() == 1001 and kept.agg(F.min("seq")).first()[0] == 0
    assert types(X.breaches_versioned(pings(spark, points), log, hold_cap=1)) == []


def test_reactivation_compares_with_the_state_before_removal(spark):
    log = [
        change("INSERT", "excl", 0),
        change("REMOVE", "excl", 1002, 1),
        change("INSERT", "excl", 1004, 2),
    ]
    # Outside while active, moves in while the zone is away, still inside when it returns.
    found = X.breaches_versioned(pings(spark, [(5, 5), (5, 5), (1, 1), (1, 1), (1, 1)]), versions(spark, log))
    assert [(r.seq, r.breachType) for r in found.collect()] == [(4, "entry")]


def test_polygon_edit_makes_a_crossing_without_movement(spark):
    log = [change("INSERT", "excl", 0), change("MODIFY", "excl", 1001, 1, ring=square(4.0, 6.0))]
    found = X.breaches_versioned(pings(spark, [(5, 5), (5, 5)]), versions(spark, log))
    assert [(r.seq, r.breachType) for r in found.collect()] == [(1, "entry")]


def test_rules_apply_before_positions_of_the_same_instant(spark):
    log = [change("INSERT", "excl", 1001)]
    found = X.breaches_versioned(pings(spark, [(5, 5), (1, 1)]), versions(spark, log))
    assert types(found) == ["entry"]


def test_nothing_without_active_zones(spark):
    log = [change("INSERT", "excl", 0, active=False)]
    assert X.breaches_versioned(pings(spark, [(5, 5), (1, 1)]), versions(spark, log)).count() == 0


def _contains(ring, lat, lon):
    """Axis-parallel squares only."""
    return ring[0][0] <= lat <= ring[2][0] and ring[0][1] <= lon <= ring[2][1]


def _simulate(positions, log, hold_cap=1000):
    """One row after the other, with plain dictionaries."""
    first = None
    for t in sorted({c["updatedAt"] for c in log}):
        live = {}
        for c in sorted((c for c in log if c["updatedAt"] <= t), key=lambda c: (c["updatedAt"], c["seq"])):
            live[c["id"]] = c if c["op"] != "REMOVE" and c["active"] else None
        if any(live.values()):
            first = t
            break
    if first is None:
        return []
    held = sorted((p for p in positions if p[2] < first), key=lambda p: p[1])[-hold_cap:]
    judged = [(v, s, max(t, first), a, b) for v, s, t, a, b in held + [p for p in positions if p[2] >= first]]
    state, found = {}, []
    for v, s, t, a, b in sorted(judged, key=lambda p: (p[2], p[1])):
        live = {}
        for c in sorted((c for c in log if c["updatedAt"] <= t), key=lambda c: (c["updatedAt"], c["seq"])):
            live[c["id"]] = c if c["op"] != "REMOVE" and c["active"] else None
        for zone_id, zone in live.items():
            if zone is None:
                continue
            now, was = _contains(zone["polygon"], a, b), state.get((v, zone_id))
            state[v, zone_id] = now
            if was is not None and was != now:
                found.append((v, s, zone_id, "entry" if now else "exit"))
    return sorted(found)


@pytest.mark.parametrize("seed,cut", [(1, 5), (2, 5), (3, X.ROWS_PER_SEGMENT)])
def test_random_histories(spark, seed, cut):
    """Many edits, removals and reactivations; small segments so that every border case occurs."""
    rng = random.Random(seed)
    log = []
    for i in range(60):
        name = rng.choice(list(ZONES))
        low = rng.choice([0.0, 1.0, 2.0])
        log.append(
            change(rng.choice(["INSERT", "MODIFY", "REMOVE"]), name, rng.randint(0, 90) * 10, i, rng.random() < 0.8, square(low, low + 2))
        )
    positions = [
        (f"v{rng.randint(0, 4)}", i, rng.randint(0, 1000), rng.choice([0.5, 1.5, 2.5, 3.5, 9.0]), rng.choice([0.5, 1.5, 2.5, 3.5, 9.0]))
        for i in range(300)
    ]
    rows = [
        {"vehicleId": v, "seq": s, "timestamp": t, "location": {"latitude": a, "longitude": b}} for v, s, t, a, b in positions
    ]
    telemetry = local_table(spark, rows, TELEMETRY)
    found = X.edges_versioned(telemetry, versions(spark, log), span_ms=37, hold_cap=20, rows_per_segment=cut)
    got = sorted((r.vehicleId, r.seq, r.zoneId, r.edge) for r in found.collect())
    want = _simulate(positions, log, hold_cap=20)
    assert got == want and len(want) > 30


def test_fixed_zones_with_small_segments(spark):
    rng = random.Random(5)
    points = [(rng.choice([1, 5, 11, 15, 21]),) * 2 for _ in range(200)]
    telemetry = pings(spark, points)
    whole = X.breaches(telemetry, zones(spark, *ZONES))
    split = X.breaches(telemetry, zones(spark, *ZONES), segment=span_segment("seq", 3))
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect())) and whole.count() > 50


def test_positions_off_the_earth_are_outside(spark):
    rows = spark.createDataFrame([(510005000.0, 1.0), (1e300, float("nan")), (1.5, 1.5), (None, 1.0)], "lat double, lon double")
    from zonewise.operators.spatial import position_cell_sql

    got = rows.selectExpr(f"{position_cell_sql('lat', 'lon', 0, 0.01)} AS cell").collect()
    assert [r.cell is None for r in got] == [True, True, False, True]


def _odd_zones(spark):
    """Zones of three to twelve corners at random places, some of them repeated, unknown in part, or of one line."""
    rng = random.Random(11)
    rows = []
    for i in range(40):
        n, y, x = rng.randint(3, 12), rng.uniform(0, 0.05), rng.uniform(0, 0.05)
        ring = [[y + rng.uniform(0, 0.02), x + rng.uniform(0, 0.02)] for _ in range(n)]
        rows.append({"id": f"z{i % 35}", "kind": rng.choice(["exclusion", "containment", "dwell"]), "polygon": ring, "active": True})
    rows.append({"id": None, "kind": "dwell", "polygon": [[0.01, 0.01], [0.03, 0.01], [0.03, 0.03], [0.01, 0.03], [0.01, 0.01]], "active": True})
    rows.append({"id": "gap", "kind": "dwell", "polygon": [[0.01, 0.01], [0.03, None], [0.03, 0.03], [0.01, 0.03]], "active": True})
    rows.append({"id": "wide", "kind": None, "polygon": [[-60.0, -90.0], [60.0, -90.0], [0.02, 0.02]], "active": True})
    rows.append({"id": "line", "kind": "dwell", "polygon": [[0.01, 0.01], [0.02, 0.02], [0.01, 0.01]], "active": True})
    return local_table(spark, rows, ZONE)


@pytest.mark.parametrize("most", [5, 8])
def test_many_zones_find_what_few_do(spark, monkeypatch, most):
    """The index for many zones against the one for few: same crossings, kinds, names and distances."""
    rng = random.Random(3)
    corners = [p for r in _odd_zones(spark).collect() for p in r.polygon if p[1] is not None][:60]
    points = [rng.choice(corners) if rng.random() < 0.3 else (rng.uniform(-0.01, 0.08), rng.uniform(-0.01, 0.08)) for _ in range(300)]
    points[7:9] = [(1e300, float("nan")), (0.02, float("nan"))]
    rows = [
        {"vehicleId": f"v{i % 3}", "seq": i, "timestamp": i, "location": {"latitude": float(a), "longitude": float(b)}}
        for i, (a, b) in enumerate(points)
    ]
    rows[20]["location"] = {"latitude": 0.02}
    telemetry = local_table(spark, rows, TELEMETRY)
    for zone_set in (_odd_zones(spark), _odd_zones(spark).where(f"size(polygon) <= {most} AND id <> 'gap'")):
        plain = [X.breaches(telemetry, zone_set), X.edges(telemetry, zone_set)]
        with monkeypatch.context() as patch:
            index = X.bit_index
            patch.setattr(X, "bit_index", lambda zones, *base: index(zones, *base, few=0))
            many = [X.breaches(telemetry, zone_set), X.edges(telemetry, zone_set)]
        for a, b in zip(plain, many):
            assert a.columns == b.columns and "__zone" in b._jdf.queryExecution().toString()
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() > 5
