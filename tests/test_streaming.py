"""Streams: same result as the batch job, restart, delivery once."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.functions import triage as rules_fn
from zonewise.operators import crossings as X
from zonewise.operators.monitoring import minute_stats
from zonewise.operators.zones import zone_versions
from zonewise.schemas import BREACH, TELEMETRY, ZONE_CHANGE
from zonewise.sources import files, streams
from zonewise.sources import tables as tb
from zonewise.sources.fixed import local_table
from zonewise.streaming.breaches import BreachDetector
from zonewise.streaming.delivery import (
    Bisecting,
    Outbox,
    ProgressMetrics,
    dead_letter_sink,
    deduplicated,
    metric_sink,
    minute_windows,
)

from tests.conftest import SMALL


def _changes(spark):
    """Order edits as zone changes, the first ones four days into the events."""
    changes = tb.order_changes(spark, SMALL).where("updatedAt >= 1704067200000 + 345600000")
    fields = ZONE_CHANGE.fieldNames()
    return changes.withColumn("properties", F.lit(None).cast(ZONE_CHANGE["properties"].dataType)).select(*fields)


def _telemetry(spark):
    return tb.telemetry(spark, SMALL).select(*TELEMETRY.fieldNames())


def _key(rows):
    return sorted(
        (r.vehicleId, r.seq, r.zoneId, r.zoneName, r.zoneKind, r.breachType, r.timestamp, r.distanceOutsideM)
        for r in rows
    )


def _place(frame, folder, files=1):
    frame.coalesce(files).write.mode("append").parquet(folder)


def _inputs(spark, folder, max_files=1):
    return (
        streams.read_files(spark, f"{folder}/telemetry", TELEMETRY, "parquet", max_files=max_files),
        streams.read_files(spark, f"{folder}/rules", ZONE_CHANGE, "parquet", max_files=1),
    )


def _run(spark, folder, **options):
    """Process everything that is in the input folders; a new detector goes on where the last one stopped."""
    detector = BreachDetector(spark, f"{folder}/job", **options)
    for query in detector.start(*_inputs(spark, folder), availableNow=True):
        query.awaitTermination()
    return detector


def test_stream_equals_batch_across_a_restart(spark, folder):
    telemetry, changes = _telemetry(spark), _changes(spark)
    want = X.breaches_versioned(telemetry, zone_versions(changes)).collect()
    assert len(want) > 20

    spark.createDataFrame([], TELEMETRY).write.parquet(f"{folder}/telemetry")
    spark.createDataFrame([], ZONE_CHANGE).write.parquet(f"{folder}/rules")
    # Three pieces in time; each is a new run on the same checkpoint, of several micro-batches.
    cuts = [0, 1704067200000 + 6 * 86_400_000, 1704067200000 + 17 * 86_400_000, 1 << 60]
    for start, end in zip(cuts, cuts[1:]):
        _place(streams.read_window(telemetry, "ingestTime", start, end), f"{folder}/telemetry")
        _place(streams.read_window(changes, "updatedAt", start, end), f"{folder}/rules")
        detector = _run(spark, folder)
    got = detector.breaches()
    assert _key(got.collect()) == _key(want)
    assert got.where("trace.flinkRead IS NULL OR trace.flinkEmit < trace.flinkRead").count() == 0
    assert len(files.committed_folders(spark, detector.out)) > 3


def _square(low, high):
    return [[low, low], [low, high], [high, high], [high, low], [low, low]]


def _pings(spark, rows):
    """``(vehicle, seq, clock, lat, lon)``"""
    made = [
        {"vehicleId": v, "seq": s, "timestamp": t, "ingestTime": t, "location": {"latitude": a, "longitude": b}} for v, s, t, a, b in rows
    ]
    return local_table(spark, made, TELEMETRY)


@pytest.mark.parametrize("seed", [2])
def test_random_histories_in_small_micro_batches(spark, folder, seed):
    """Zones come, go and move while vehicles report or fall silent; state is handed on from batch to batch."""
    rng = random.Random(seed)
    places = [0.5, 1.5, 2.5, 3.5, 9.0]
    log = [
        {
            "op": rng.choice(["INSERT", "MODIFY", "REMOVE"]),
            "id": f"z{rng.randrange(4)}",
            "active": rng.random() < 0.8,
            "kind": "dwell",
            "polygon": _square(low := rng.choice([0.0, 1.0, 2.0]), low + 2),
            "updatedAt": rng.randrange(90) * 10,
            "seq": i,
        }
        for i in range(70)
    ]
    silent = {f"v{i}": sorted(rng.sample(range(1000), 2)) for i in range(5)}
    rows = []
    for i in range(260):
        v, t = f"v{rng.randrange(5)}", rng.randrange(1000)
        if not silent[v][0] < t < silent[v][1]:
            rows.append((v, i, t, rng.choice(places), rng.choice(places)))
    rows.sort(key=lambda r: r[2])
    changes = local_table(spark, log, ZONE_CHANGE)
    want = X.breaches_versioned(_pings(spark, rows), zone_versions(changes)).collect()
    assert len(want) > 30
    cuts = [0, *sorted(rng.sample(range(1, 1000), 4)), 1000]
    detector = BreachDetector(spark, folder, span_ms=37)
    detector.rules.add(changes, 0)
    for n, (start, end) in enumerate(zip(cuts, cuts[1:])):
        part = _pings(spark, [r for r in rows if start <= r[2] < end])
        detector.judge(part, n)
        if n == 2:  # a micro-batch that failed after its work is done again, by another process
            files.write_json(spark, f"{folder}/committed.json", [1])
            detector = BreachDetector(spark, folder, span_ms=37)
            detector.judge(part, n)
    assert _key(detector.breaches().collect()) == _key(want)
    state = spark.read.parquet(f"{folder}/state/{len(cuts) - 2}/inside")
    assert state.count() <= 20 and not files.exists(spark, f"{folder}/state/0")


def test_all_rules_come_before_the_first_position(spark, folder):
    """The rules are spread over three files, and so three micro-batches; the positions are all in the first."""
    zones = [
        {"op": "INSERT", "id": f"z{i}", "active": True, "kind": "exclusion", "polygon": _square(4.0 * i, 4.0 * i + 2), "updatedAt": 5000 + i, "seq": i}
        for i in range(3)
    ]
    _place(_pings(spark, [("v", 0, 1000, 9.9, 3.0), *[("v", i + 1, 1001 + i, 4.0 * i + 1, 4.0 * i + 1) for i in range(3)]]), f"{folder}/telemetry")
    for zone in zones:
        _place(local_table(spark, [zone], ZONE_CHANGE), f"{folder}/rules")
    detector = _run(spark, folder)
    assert len(detector.rules.parts(spark)) == 3
    want = X.breaches_versioned(spark.read.schema(TELEMETRY).parquet(f"{folder}/telemetry"), zone_versions(local_table(spark, zones, ZONE_CHANGE)))
    found = detector.breaches().collect()
    assert _key(found) == _key(want.collect()) and found


def test_positions_wait_for_a_zone_over_micro_batches(spark, folder):
    detector = BreachDetector(spark, folder)
    rule = {"op": "INSERT", "id": "z", "active": True, "kind": "exclusion", "polygon": _square(0.0, 2.0), "updatedAt": 5000, "seq": 0}
    detector.judge(_pings(spark, [("v", 0, 1000, 5.0, 5.0)]), 0)
    detector.judge(_pings(spark, [("v", 1, 1001, 1.0, 1.0), ("w", 2, 1002, 1.0, 1.0)]), 1)
    assert detector.breaches().count() == 0
    detector.rules.add(local_table(spark, [rule], ZONE_CHANGE), 0)
    detector.judge(_pings(spark, [("w", 3, 6000, 5.0, 5.0)]), 2)
    assert [(r.vehicleId, r.seq, r.breachType) for r in detector.breaches().collect()] == [("v", 1, "entry")]


def test_bad_rules_are_put_aside(spark, folder):
    good = {"op": "INSERT", "id": "z", "active": True, "kind": "exclusion", "polygon": _square(0.0, 2.0), "updatedAt": 0, "seq": 0}
    bad = [good | {"polygon": None, "updatedAt": 1, "seq": 1}, good | {"id": None, "seq": 2}, good | {"id": " ", "seq": 3}, good | {"updatedAt": None, "seq": 4}]
    changes = local_table(spark, [good, *bad], ZONE_CHANGE)
    pings = _pings(spark, [("v", 0, 1000, 5.0, 5.0), ("v", 1, 1001, 1.0, 1.0)])
    detector = BreachDetector(spark, folder)
    detector.rules.add(changes, 0)
    detector.judge(pings, 0)
    assert detector.breaches().count() == X.breaches_versioned(pings, zone_versions(changes)).count() == 1
    reasons = spark.read.parquet(f"{folder}/rejected_rules").groupBy("rule_error").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"missing_polygon": 1, "missing_id": 2, "missing_time": 1}


def test_json_lines_with_poison_through_the_stream(spark, folder):
    from zonewise.operators.quality import parse_telemetry

    lines = ['{"vehicleId":"v","location":{"latitude":1,"longitude":2}}', "{broken", '{"location":{}}']
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{folder}/in")
    parsed = parse_telemetry(streams.read_lines(spark, f"{folder}/in"))
    query = (
        parsed.writeStream.format("memory").queryName("poison_check").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    reasons = [r.poison_reason for r in spark.table("poison_check").collect()]
    assert sorted(reasons, key=str) == [None, "missing_vehicle", "undecodable"]


def _messages(spark, keys):
    rows = [
        (k, i, {"vehicleId": "v", "severity": "HIGH", "decision": "ALERT"}, {"vehicleId": "v", "zoneId": k})
        for i, k in enumerate(keys)
    ]
    from zonewise.schemas import DECISION

    schema = T.StructType(
        [
            T.StructField("dedupeKey", T.StringType()),
            T.StructField("seq", T.LongType()),
            T.StructField("decision", DECISION),
            T.StructField("breach", BREACH),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _delivered(spark, folder):
    return sorted(r.dedupeKey for r in spark.read.parquet(f"{folder}/outbox").collect())


def test_outbox_delivers_each_key_once_even_when_a_batch_repeats(spark, folder):
    clock = [1000]
    sink = Outbox(spark, f"{folder}/outbox", f"{folder}/ledger", ttl_days=1, now_s=lambda: clock[0])
    sink.write(_messages(spark, ["a", "b", "a"]), 0)
    assert _delivered(spark, folder) == ["a", "b"]
    sink.write(_messages(spark, ["a", "b", "a"]), 0)
    assert _delivered(spark, folder) == ["a", "b"]
    sink.write(_messages(spark, ["b", "c"]), 1)
    assert _delivered(spark, folder) == ["a", "b", "c"]
    expiries = {r.expiresAt for r in sink.claims(spark).collect()}
    assert expiries == {87400}
    clock[0] = 1000 + 2 * 86_400
    sink.write(_messages(spark, ["a"]), 2)
    assert _delivered(spark, folder) == ["a", "a", "b", "c"]


def test_ledger_is_compacted_and_stays_bounded(spark, folder):
    """Many batches, a restart, a repetition after compaction, and claims that run out."""
    clock = [0]

    def sink():
        return Outbox(spark, f"{folder}/outbox", f"{folder}/ledger", ttl_days=1, now_s=lambda: clock[0], buckets=4, compact_after=5)

    outbox, most = sink(), 0
    for n in range(30):
        clock[0] = n * 6000  # a claim lasts about fourteen batches
        if n == 13:
            outbox = sink()
        outbox.write(_messages(spark, [f"k{n}", f"k{n - 1}", f"k{n - 20}"]), n)
        names = [p for _, _, names in os.walk(f"{folder}/ledger") for p in names if p.endswith(".parquet")]
        most = max(most, len(names))
    # Each key once, and again when its claim had run out.
    assert _delivered(spark, folder) == sorted([f"k{n}" for n in range(30)] + [f"k{n - 20}" for n in range(30)] + ["k-1"])
    outbox.write(_messages(spark, ["k29", "k28", "k9"]), 29)
    assert len(_delivered(spark, folder)) == 61
    assert most <= 4 * (2 + 2 * 6), most
    assert outbox.claims(spark).count() < 40
    # Only the buckets of the keys asked for are read.
    key = spark.createDataFrame([("k29",)], "dedupeKey string")
    some = outbox.ledger.claims(key)
    assert {r.bucket for r in some.select("bucket").distinct().collect()} == {key.select(outbox.ledger.bucket()).first()[0]}


def test_claims_merged_by_another_stream_do_not_stop_a_repeated_batch(spark, folder):
    context = spark.sparkContext
    sink = Outbox(spark, f"{folder}/outbox", f"{folder}/ledger", now_s=lambda: 0, compact_after=1)
    try:
        context.setLocalProperty("sql.streaming.queryId", "one")
        sink.write(_messages(spark, ["a"]), 0)
        context.setLocalProperty("sql.streaming.queryId", "two")
        sink.write(_messages(spark, ["b", "a"]), 0)
        assert sink.ledger._state()["base"] is not None
        context.setLocalProperty("sql.streaming.queryId", "one")
        sink.write(_messages(spark, ["a"]), 0)
        assert _delivered(spark, folder) == ["a", "b"]
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_a_bad_row_is_found_by_halving(spark, folder):
    """One row of 1 000 fails: alone in the dead letters after three more tries, the rest is delivered once."""
    sink = Outbox(spark, f"{folder}/outbox", f"{folder}/ledger", now_s=lambda: 0)
    tried = []

    def handle(rows, batch_id, part):
        bad = rows.where("dedupeKey = 'k500'").count()
        tried.append(bad)
        if bad:
            raise ValueError("cannot handle k500")
        sink.deliver(rows, batch_id, part)

    writer = Bisecting(handle, f"{folder}/dead", begin=sink.begin, wait=lambda attempt: None)
    # An earlier attempt that was broken off has left one alert and its claim.
    sink.deliver(_messages(spark, ["k1"]), 7, "all-0")
    writer.write(_messages(spark, [f"k{i}" for i in range(1000)]), 7)
    dead = spark.read.parquet(f"{folder}/dead/query=none").collect()
    assert [(r.dedupeKey, r.retries, r.error) for r in dead] == [("k500", 3, "ValueError: cannot handle k500")]
    assert _delivered(spark, folder) == sorted(f"k{i}" for i in range(1000) if i != 500)
    assert len(tried) < 50


def test_expired_rows_are_not_tried(spark, folder):
    seen = []
    writer = Bisecting(
        lambda rows, n, part: seen.extend(r.k for r in rows.collect()), f"{folder}/dead", arrival="at", max_age_ms=100, now_ms=lambda: 1000
    )
    writer.write(spark.createDataFrame([("new", 950), ("old", 100)], "k string, at bigint"), 0)
    assert seen == ["new"]
    dead = spark.read.parquet(f"{folder}/dead/query=none").first()
    assert (dead.k, dead.error, dead.retries, dead.age_ms) == ("old", "expired", 0, 900)


def test_metric_and_dead_letter_sinks(spark, folder):
    rows = spark.createDataFrame([(1, "s", "m", 2.0, None), (2, "s", "m", 3.0, "bad")], "ts bigint, stage string, name string, value double, error string")
    sink = dead_letter_sink(metric_sink(f"{folder}/metrics"), f"{folder}/dead", "error")
    for _ in range(2):
        sink(rows, 4)
        assert [r.ts for r in spark.read.parquet(f"{folder}/metrics").collect()] == [1]
        assert [(r.ts, r.error) for r in spark.read.parquet(f"{folder}/dead").collect()] == [(2, "bad")]


def test_stream_percentiles_equal_those_of_the_batch(spark, folder):
    schema = "ts bigint, stage string, name string, value bigint"
    rng = random.Random(3)
    rows = [(rng.randrange(6) * 60_000 + rng.randrange(60_000), "s", rng.choice("ab"), rng.randrange(900)) for _ in range(600)]
    metrics = spark.createDataFrame(rows, schema)
    # A last row far on lets the watermark close the minutes before it.
    late = spark.createDataFrame([(10_000_000, "s", "a", 1)], schema)
    for frame in (metrics, late):
        _place(frame, f"{folder}/in", 3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    writer = minute_windows(stream, lateness="10 minutes").writeStream.format("parquet").option("path", f"{folder}/out")
    writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    columns = ["minute", "stage", "name", "max", "sum", "p50", "p99"]
    got = sorted(map(tuple, spark.read.parquet(f"{folder}/out").select(columns).collect()))
    assert got == sorted(map(tuple, minute_stats(metrics).select(columns).collect())) and len(got) == 12


def test_deduplicated_stream_and_minute_windows(spark, folder):
    schema = "dedupeKey string, ts bigint"
    rows = [("k1", 60_000), ("k1", 61_000), ("k2", 62_000)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in")
    spark.createDataFrame([("k1", 63_000)], schema).write.mode("append").parquet(f"{folder}/in")
    alerts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = deduplicated(alerts, "ts").writeStream.format("memory").queryName("dedup_check")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.dedupeKey for r in spark.table("dedup_check").collect()) == ["k1", "k2"]

    metrics = alerts.selectExpr("ts", "'s' AS stage", "'m' AS name", "ts AS value")
    query = minute_windows(metrics).writeStream.format("memory").queryName("minute_check").outputMode("complete")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    row = spark.table("minute_check").collect()[0]
    assert (row.minute, row["max"], row["sum"], row.p50, row.p99) == (60_000, 63_000, 246_000, 61_500.0, 62_970.0)


def test_progress_reports_go_to_a_table(spark, folder):
    """Two runs on one checkpoint; the reports of both are there, and feed the statistics per minute."""
    for run in range(2):
        listener = ProgressMetrics(spark, f"{folder}/progress")
        spark.streams.addListener(listener)
        try:
            spark.range(5).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema("id bigint").parquet(f"{folder}/in")
            query = stream.writeStream.format("noop").queryName("watched").trigger(availableNow=True)
            query.option("checkpointLocation", f"{folder}/cp").start().awaitTermination()
            for _ in range(100):
                rows = listener.table().where("stage = 'watched' AND name = 'inputRows'").collect()
                if sum(r.value for r in rows) == 5 * (run + 1):
                    break
                time.sleep(0.2)
        finally:
            spark.streams.removeListener(listener)
        assert sum(r.value for r in rows) == 5 * (run + 1)
    assert minute_stats(listener.table()).where("name = 'inputRows'").agg(F.sum("sum")).first()[0] == 10


def test_throttle_names():
    assert len(rules_fn.THROTTLE_ERRORS) == 4


def test_outbox_keeps_alerts_of_an_earlier_checkpoint(spark, folder):
    from zonewise.streaming.delivery import batch_path

    context = spark.sparkContext
    rows = spark.createDataFrame([("a",)], "k string")
    try:
        context.setLocalProperty("sql.streaming.queryId", "one")
        first = batch_path(folder, rows, 0)
        context.setLocalProperty("sql.streaming.queryId", "two")
        assert batch_path(folder, rows, 0) != first
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_log_rows_are_numbered_by_their_place(spark, folder):
    """Rows as a log gives them, without a broker: the order of each partition is kept, in batch and stream alike."""
    rng = random.Random(6)
    line = '{{"vehicleId":"v{}","location":{{"latitude":1,"longitude":2}},"timestamp":{}}}'
    rows = [(f"v{p}", line.format(p, rng.randrange(99)), p, o, 1000 + o) for p in range(4) for o in range(50)]
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "key string, value string, partition int, offset bigint, ms bigint").selectExpr(
        "binary(key) AS key", "binary(value) AS value", "partition", "offset", "timestamp_millis(ms) AS timestamp"
    )
    numbered = streams.log_rows(log)
    got = numbered.orderBy("seq").collect()
    assert len({r.seq for r in got}) == 200
    for p in range(4):
        assert [r.offset for r in got if r.partition == p] == list(range(50))
    log.write.parquet(f"{folder}/in")
    stream = streams.log_rows(spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
    from zonewise.operators.quality import parse_telemetry

    query = parse_telemetry(stream).writeStream.format("memory").queryName("numbered").trigger(availableNow=True).start()
    query.awaitTermination()
    parsed = spark.table("numbered").select("vehicleId", "seq", "offset").collect()
    assert sorted(map(tuple, parsed)) == sorted((r.key, r.seq, r.offset) for r in got)
