"""Keys, texts, claims, hops, statistics and alarms."""

import json

import pytest
from pyspark.sql import functions as F

from zonewise.functions import latency as L
from zonewise.functions import messages as M
from zonewise.operators import delivery as D
from zonewise.operators import monitoring as mon
from zonewise.schemas import DELIVERY
from zonewise.sources.fixed import local_table

PLACE = {"latitude": 48.25, "longitude": 16.375, "accuracy": 3.0}
ALERT = {
    "dedupeKey": "truck-77|depot-north|entry|1700000123000",
    "decision": {
        "decision": "ALERT",
        "severity": "HIGH",
        "reason": "Gate was shut.",
        "recommendedAction": "Call the driver.",
        "historicalPattern": "First in May.",
        "vehicleId": "truck-77",
        "zoneId": "depot-north",
        "zoneName": "North depot",
        "zoneKind": "exclusion",
        "breachType": "entry",
        "location": PLACE,
        "eventTime": 1700000123000,
    },
    "breach": {"vehicleId": "truck-77", "location": PLACE, "distanceOutsideM": 0.0, "durationInStateS": 31},
}


def _compose(spark, alert, drafted=None):
    df = local_table(spark, [alert], DELIVERY)
    if drafted is None:
        return D.compose(df).first()
    pairs = [F.lit(x) for kv in drafted.items() for x in kv]
    return D.compose(df.withColumn("d", F.create_map(*pairs)), "d").first()


def test_dedupe_key(spark):
    key = M.dedupe_key(F.lit("truck-77"), F.lit("depot-north"), F.lit("entry"), F.lit(1700000123000))
    gap = M.dedupe_key(F.lit("v"), F.lit(None), F.lit("exit"), F.lit(None))
    assert tuple(spark.range(1).select(key, gap).first()) == (ALERT["dedupeKey"], "v||exit|")


def test_subject_and_body(spark):
    row = _compose(spark, ALERT)
    assert row.subject == "[HIGH] Vehicle truck-77: North depot entry"
    assert row.body == (
        "CURRENT STATUS:\nVehicle truck-77 at 48.25000, 16.37500; 31s in state, 0.0m outside the boundary.\n\n"
        "WHY THIS ALERT:\nHIGH exclusion entry at North depot. Gate was shut.\n\n"
        "IMPACT:\nFirst in May.\n\nRECOMMENDED ACTIONS:\nCall the driver."
    )


def test_fallbacks(spark):
    bare = {"dedupeKey": "k", "decision": {"zoneId": "z1", "recommendedAction": "", "historicalPattern": None}, "breach": {"vehicleId": "v9"}}
    row = _compose(spark, bare)
    assert row.subject == "[UNKNOWN] Vehicle v9: z1 breach"
    assert M.NO_HISTORY in row.body and M.NO_ACTION in row.body and "at unknown; 0s in state, 0m outside" in row.body
    empty = _compose(spark, {"dedupeKey": "k", "decision": {}, "breach": {}})
    assert empty.subject == "[UNKNOWN] Vehicle unknown: a geofence breach"


def test_drafted_section_wins(spark):
    row = _compose(spark, ALERT, {"IMPACT": " Runway closed. ", "CURRENT STATUS": ""})
    assert "IMPACT:\nRunway closed.\n\n" in row.body and "Vehicle truck-77 at" in row.body


def test_long_subject_is_cut(spark):
    long = ALERT | {"decision": ALERT["decision"] | {"zoneName": "x" * 200}}
    row = D.outbox(local_table(spark, [long], DELIVERY)).first()
    assert len(row.subject) == 100


def test_first_claim_wins_and_expires(spark):
    messages = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 3, "x")], "dedupeKey string, seq long, text string")
    assert {r.dedupeKey: r.text for r in D.first_claims(messages).collect()} == {"a": "first", "b": "x"}
    ledger = D.claims(messages.where("dedupeKey = 'a'").limit(1), now_s=1000, ttl_days=1)
    assert ledger.first().expiresAt == 87400
    assert [r.dedupeKey for r in D.undelivered(messages, ledger, 87399).collect()] == ["b"]
    assert sorted(r.dedupeKey for r in D.undelivered(messages, ledger, 87400).collect()) == ["a", "b"]
    assert D.already_delivered(messages, ledger, 1001).count() == 2


def test_rule_effect(spark):
    edits = spark.createDataFrame([("z", 1000), ("z", 5000), ("y", 0)], "zoneId string, updatedAt long")
    hits = spark.createDataFrame([("z", 900), ("z", 1000), ("z", 4000)], "zoneId string, timestamp long")
    rows = D.rule_effect(edits, hits).collect()
    assert [(r.zoneId, r.updatedAt, r.firstBreach, r.effect_s) for r in rows] == [("z", 1000, 1000, 0.0)]


def _trace(spark, **stamps):
    names = ("eventTime", "ingestTime", "flinkRead", "flinkEmit", "arrival")
    row = ", ".join(f"bigint({stamps.get(n, 'null')}) AS {n}" for n in names)
    return spark.sql(f"SELECT struct(*) AS trace, arrival FROM (SELECT {row})")


def test_detection_and_probe_hops(spark):
    full = _trace(spark, eventTime=1000, ingestTime=1180, flinkRead=1520, flinkEmit=1523, arrival=1400)
    hops = full.select(L.detection_hops(F.col("trace"), F.col("arrival"))).first()[0]
    assert hops == {"SourceToIoT": 180, "StreamWait": 120, "FlinkProcess": 3, "DetectionTotal": 523}
    assert full.select(L.processor_metrics(L.detection_hops(F.col("trace"), F.col("arrival")))).first()[0] == {"StreamWait": 120, "FlinkProcess": 3}
    part = _trace(spark, eventTime=1000, ingestTime=1180)
    assert part.select(L.detection_hops(F.col("trace"))).first()[0] == {"SourceToIoT": 180}
    probe = _trace(spark, eventTime=1000, ingestTime=1180, flinkRead=1520, flinkEmit=1523, arrival=1600)
    row = probe.select(L.probe_hops(F.col("trace"), F.col("arrival")), L.probe_total(F.col("trace"), F.col("arrival"))).first()
    assert row[0] == {"SourceToIoT": 180, "IngestToFlink": 340, "FlinkProcess": 3, "FlinkToAlerts": 77} and row[1] == 600


def test_means(spark):
    rows = spark.createDataFrame([("FlinkProcess", 3), ("FlinkProcess", 13), ("SourceToIoT", 180)], "hop string, ms long")
    assert {r.hop: r.mean_ms for r in mon.hop_means(rows).collect()} == {"FlinkProcess": 8.0, "SourceToIoT": 180.0}
    assert mon.mean_total(rows.where("false"), "ms").first()[0] == 0.0


def test_metric_document(spark):
    stamps = spark.sql("SELECT 1000L AS analyzerRead, 1240L AS bedrockDone, 1250L AS sqsEnqueue, 2000L AS publisherRead, bigint(null) AS snsPublish")
    columns = {c: F.col(c) for c in stamps.columns}
    line = stamps.select(L.metric_document(L.hop_map(columns, L.ANALYZER_HOPS), F.lit("analyzer"), F.col("sqsEnqueue"))).first()[0]
    document = json.loads(line)
    assert document["TriageBedrock"] == 240 and document["SqsEnqueue"] == 10 and document["stage"] == "analyzer"
    head = document["_aws"]["CloudWatchMetrics"][0]
    assert head["Namespace"] == L.NAMESPACE and head["Dimensions"] == [["stage"]] and document["_aws"]["Timestamp"] == 1250
    assert head["Metrics"] == [{"Name": "TriageBedrock", "Unit": "Milliseconds"}, {"Name": "SqsEnqueue", "Unit": "Milliseconds"}]
    empty = stamps.select(L.metric_document(L.hop_map(columns, L.PUBLISHER_HOPS), F.lit("publisher"))).first()[0]
    assert json.loads(empty) == {"_aws": {"CloudWatchMetrics": [{"Namespace": L.NAMESPACE, "Dimensions": [["stage"]], "Metrics": []}]}, "stage": "publisher"}


def test_minute_stats_and_alarms(spark):
    rows = [(60_000 + i, "detection", "DetectionTotal", v) for i, v in enumerate([100, 200, 9000])]
    rows += [(120_000, "geofence-processor", "downtime", 0), (120_001, "geofence-processor", "numberOfFailedCheckpoints", 1)]
    stats = mon.minute_stats(spark.createDataFrame(rows, "ts long, stage string, name string, value long"))
    total = stats.where("name = 'DetectionTotal'").first()
    assert (total["max"], total["sum"], total.p50) == (9000, 9300, 200.0) and total.p99 == pytest.approx(8824.0)
    states = {(r.minute, r.alarm): r.state for r in mon.alarms(stats).collect()}
    assert len(states) == 18
    raised = {k for k, v in states.items() if v == "ALARM"}
    assert raised == {(60_000, "DetectionLatencySlo"), (120_000, "FlinkFailedCheckpoints")}


def test_iterator_age_and_queue_depth(spark):
    rows = [(0, "s", "1", 5), (1, "s", "2", 9), (60_000, "s", "1", 3)]
    ages = mon.iterator_age(spark.createDataFrame(rows, "ts long, stream string, shard string, age long"))
    assert {r.minute: r.max_age for r in ages.collect()} == {0: 9, 60_000: 3}
    letters = spark.createDataFrame([("q",), ("q",)], "queue string")
    got = sorted(map(tuple, mon.queue_depth(letters, ["q", "empty"]).collect()))
    assert got == [("empty", 0, "OK"), ("q", 2, "ALARM")]
