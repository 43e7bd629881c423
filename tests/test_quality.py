import json

from pyspark.sql import functions as F

from zonewise.functions import quality as Q
from zonewise.operators import quality as ops
from zonewise.sources import envelopes, streams
from zonewise.sources.tables import with_ingest_time

GOOD = {
    "vehicleId": "veh-1",
    "geoFenceId": "zone-airport-yyc",
    "timestamp": 1000,
    "location": {"latitude": 51.1, "longitude": -114.0, "altitude": 1, "heading": 2, "speed": 3, "accuracy": 4},
    "vss": {"vehicle.speed": 0, "vehicle.ignition": False, "vehicle.transmission.gear": "drive"},
    "telemetry": {"engineRpm": 0, "batteryVoltage": 1, "outsideTemperature": 2, "accelerometerData": {"x": 0, "y": 0, "z": 1}},
    "deviceInfo": {"deviceId": "d", "firmwareVersion": "1", "signalStrength": 2},
    "routeInfo": {"routeType": "highway", "routeName": "r"},
}
HERE = {"location": {"latitude": 1, "longitude": 2}}


def _reasons(spark, *texts):
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, raw string")
    return [r.poison_reason for r in ops.parse_telemetry(raw).orderBy("n").collect()]


def test_poison_reasons(spark):
    texts = {
        "{not valid json": "undecodable",
        None: "undecodable",
        "": "undecodable",
        '{"vehicleId":"v","location":{"latitude":1,"longitude":2}} tail': "undecodable",
        "[1,2]": "not_object",
        '"text"': "not_object",
        json.dumps(HERE): "missing_vehicle",
        json.dumps({"vehicleId": ""} | HERE): "missing_vehicle",
        json.dumps({"vehicleId": 0} | HERE): "missing_vehicle",
        json.dumps({"vehicleId": None} | HERE): "missing_vehicle",
        '{"vehicleId":"v"}': "missing_location",
        '{"vehicleId":"v","location":"x"}': "missing_location",
        '{"vehicleId":"v","location":{"latitude":null,"longitude":1}}': "missing_location",
        '{"vehicleId":"v","location":{"latitude":"north","longitude":1}}': "bad_coordinate",
        '{"vehicleId":"v","location":{"latitude":"51.5","longitude":1}}': None,
        '{"vehicleId":17,"vss":null,"location":{"latitude":1,"longitude":1}}': None,
        json.dumps(GOOD): None,
    }
    assert _reasons(spark, *texts) == list(texts.values())


def test_parsed_values_and_split(spark):
    raw = spark.createDataFrame([(json.dumps(GOOD),), ("{",)], "raw string")
    good, bad = ops.split_poison(ops.parse_telemetry(raw))
    row = good.first()
    assert row.vehicleId == "veh-1" and row.location.latitude == 51.1 and row.vss["vehicle.ignition"] is False
    assert bad.count() == 1 and bad.first().raw == "{"


def _errors(spark, message):
    df = spark.createDataFrame([(json.dumps(message),)], "raw string").select(F.try_parse_json(F.col("raw")).alias("m"))
    return df.select(Q.message_errors("m").alias("e")).first().e


def test_message_rules(spark):
    assert _errors(spark, GOOD) == []
    assert _errors(spark, [1]) == ["message / must be object"]
    assert _errors(spark, GOOD | {"vehicleId": ""}) == ["message /vehicleId must NOT have fewer than 1 characters"]
    assert _errors(spark, GOOD | {"timestamp": 1.5}) == ["message /timestamp must be integer"]
    far = GOOD | {"location": GOOD["location"] | {"latitude": 91, "longitude": -181}}
    assert _errors(spark, far) == ["message /location/latitude must be <= 90", "message /location/longitude must be >= -180"]
    bare = {k: v for k, v in GOOD.items() if k not in ("deviceInfo", "vss")}
    assert _errors(spark, bare) == [
        "message / must have required property 'vss'",
        "message / must have required property 'deviceInfo'",
    ]
    wrong = GOOD | {"geoFenceId": 3, "routeInfo": "r"}
    assert _errors(spark, wrong) == ["message /geoFenceId must be string", "message /routeInfo must be object"]


def test_presence_counts_false_and_zero(spark):
    complete = json.dumps(GOOD)
    partial = json.dumps(GOOD | {"routeInfo": {"routeType": "x"}})
    df = spark.createDataFrame([(complete,), (partial,), ("{",)], "raw string")
    assert [r[0] for r in df.select(Q.is_complete_message("raw")).collect()] == [True, False, False]


def test_fact_only(spark):
    facts = {
        "location": {"latitude": 1, "longitude": 2, "accuracy": None},
        "distanceOutsideM": 0,
        "durationInStateS": 0,
        "vehicle": {"speed": None},
    }
    rows = [json.dumps(facts), json.dumps(facts | {"severity": "HIGH"}), json.dumps({"vehicle": {}})]
    df = spark.createDataFrame([(r,) for r in rows], "raw string")
    assert [r[0] for r in df.select(Q.is_fact_only("raw")).collect()] == [True, False, False]


def test_out_of_order_uses_the_previous_row(spark):
    rows = [("v", i, t) for i, t in enumerate([1000, 3000, 2000, 2500])]
    df = spark.createDataFrame(rows, "vehicleId string, seq long, timestamp long")
    for span in (1, 2, 100):
        assert [r.timestamp for r in ops.out_of_order(df, span).collect()] == [2000]


def test_stream_health(spark):
    rows = [("a", 0, 1000, 1500), ("a", 1, 2000, 2970), ("b", 2, 1000, 1200)]
    df = spark.createDataFrame(rows, "vehicleId string, seq long, timestamp long, arrival long")
    assert tuple(ops.stream_health(df, "arrival").first()) == (3, 2, 0.97, 0, "PASS")
    late = df.withColumn("arrival", F.col("arrival") + 5000)
    assert ops.stream_health(late, "arrival").first().result == "FAIL"
    assert tuple(ops.stream_health(df.where("false"), "arrival").first()) == (0, 0, 0.0, 0, "FAIL")


def test_reconcile(spark):
    sent = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "vehicleId string, seq long")
    got = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("a", 4), ("b", 9)], "vehicleId string, seq long")
    rows = {r.vehicleId: (r.published, r.received, r.duplicates, r.drops) for r in ops.reconcile(sent, got).collect()}
    assert rows == {"a": (5, 4, 1, 2), "b": (1, 1, 0, 0)}


def test_only_failed_items_are_reported(spark):
    rows = [(1, "x", True), (1, "y", False), (1, None, True), (2, "z", False)]
    df = spark.createDataFrame(rows, "batch int, item string, failed boolean")
    found = {r.batch: r.batchItemFailures for r in ops.batch_failures(df, "batch", "item", "failed").collect()}
    assert found == {1: ["x"], 2: []}


def test_envelopes(spark):
    import base64

    body = base64.b64encode(b'{"vehicleId":"v","zoneId":"z","timestamp":5}').decode()
    df = spark.createDataFrame([(1, body), (2, "%%%"), (3, base64.b64encode(b"{oops").decode())], "n int, data string")
    rows = {r.n: r for r in envelopes.decode_stream_records(df).collect()}
    assert rows[1].breach.vehicleId == "v" and rows[1].decode_error is None
    assert rows[2].decode_error and rows[3].decode_error and rows[3].breach is None


def test_bounded_reads_and_expiry(spark):
    df = spark.createDataFrame([(0,), (10,), (20,)], "arrival long")
    assert streams.read_window(df, "arrival", 0, 20).count() == 2
    young, old = streams.split_expired(df, "arrival", 20, max_age_ms=10)
    assert [r.arrival for r in old.collect()] == [0] and young.count() == 2


def test_ingest_stamp(spark):
    df = spark.createDataFrame([(7,)], "t long")
    assert with_ingest_time(df, "t").first().ingestTime == 7
    assert with_ingest_time(df).first().ingestTime > 1_700_000_000_000


def test_white_space_around_a_record_loses_nothing(spark):
    good = '{"vehicleId": "v", "location": {"latitude": 51.0, "longitude": -114.0}}'
    raws = [f"{good}\n", f"\n{good}", f"\t{good}\r\n"]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "n int, raw string")
    got = {r.n: r.poison_reason for r in ops.parse_telemetry(rows).collect()}
    assert got == {0: None, 1: None, 2: None}


def test_a_window_reads_few_files(spark, folder):
    """Thirty days of rows: the window's bounds reach the scan, which reads the files of its days alone."""
    day = 86_400_000
    rows = spark.range(3000).selectExpr("id", f"id * {day // 100} AS arrival")
    streams.write_by_time(rows, "arrival", f"{folder}/t", files_per_day=2)
    start, end = 3 * day + 5, 5 * day - 7
    found = streams.stored_window(spark, f"{folder}/t", "arrival", start, end)
    assert sorted(r.id for r in found.collect()) == [i for i in range(3000) if start <= i * (day // 100) < end]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(arrival," in plan and "LessThan(arrival," in plan
    scans = found._jdf.queryExecution().executedPlan().collectLeaves()
    read = scans.apply(0).metrics().apply("numFiles").value()
    assert 0 < read <= 6 and len(spark.read.parquet(f"{folder}/t").inputFiles()) >= 30
