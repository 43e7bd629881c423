"""The whole job over file sources, against the batch operators on the same rows."""

import json

from pyspark.sql import functions as F

from zonewise.operators import crossings as X
from zonewise.operators import delivery as D
from zonewise.operators import triage
from zonewise.operators.quality import parse_telemetry, split_poison
from zonewise.operators.zones import zone_versions
from zonewise.schemas import ZONE_CHANGE
from zonewise.sources import streams
from zonewise.sources.fixed import local_table
from zonewise.streaming.job import FleetJob

RING = [[0.0, 0.0], [0.0, 2.0], [2.0, 2.0], [2.0, 0.0]]


def _line(vehicle, clock, lat):
    where = {"latitude": lat, "longitude": 1.0, "accuracy": 2.0, "speed": 150.0}
    return json.dumps({"vehicleId": vehicle, "timestamp": clock, "ingestTime": clock, "location": where})


def test_lines_to_alerts(spark, folder):
    """Three micro-batches with poison; a second process repeats nothing and goes on where the first stopped."""
    rules = [{"op": "INSERT", "id": "z", "active": True, "kind": "exclusion", "polygon": RING, "updatedAt": 0, "seq": 0}]
    local_table(spark, rules, ZONE_CHANGE).write.parquet(f"{folder}/rules")
    rows, seq = [], 0
    for part in range(3):
        lines = []
        for vehicle in ("a", "b"):
            for lat in (5.0, 1.0):
                seq += 1
                lines.append((_line(vehicle, 1000 * part + seq, lat), seq))
        lines += [("{broken", 900 + part), (_line("a", 1, 1.0) + "{}", 950 + part)]
        rows += lines
        spark.createDataFrame(lines, "raw string, seq bigint").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        job = FleetJob(spark, f"{folder}/job", now_ms=lambda: 10_000_000)
        source = spark.readStream.schema("raw string, seq bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        for query in job.start(source, streams.read_files(spark, f"{folder}/rules", ZONE_CHANGE, "parquet"), availableNow=True):
            query.awaitTermination()
        return job

    job = run()
    found = job.detector.breaches()
    good, _ = split_poison(parse_telemetry(spark.createDataFrame(rows, "raw string, seq bigint")))
    want = X.breaches_versioned(good, zone_versions(local_table(spark, rules, ZONE_CHANGE)))
    assert sorted(r.seq for r in found.collect()) == sorted(r.seq for r in want.collect()) and want.count() == 6

    dropped = job.dropped().groupBy("name").agg(F.sum("value").alias("n")).collect()
    assert {r.name: r.n for r in dropped} == {"undecodable": 6}
    assert spark.read.parquet(f"{folder}/job/dead_letters").count() == 6

    verdicts = {(r.vehicleId, r.timestamp): r.severity for r in triage.rubric(want).collect()}
    assert {(r.vehicleId, r.eventTime): r.severity for r in job.history().collect()} == verdicts
    alerts = spark.read.parquet(f"{folder}/job/outbox")
    high = [k for k, s in verdicts.items() if s in ("HIGH", "CRITICAL")]
    assert high and sorted(r.dedupeKey for r in alerts.collect()) == sorted(f"{v}|z|entry|{t}" for v, t in high)
    # The last breach of a vehicle saw the two decisions before it, those of earlier micro-batches.
    asked = triage.with_history(found, job.history())
    assert max(len(r.history) for r in asked.collect()) == 2
    assert D.claims_per_key(job.outbox.claims(spark)).where("claims > 1").count() == 0

    run()
    assert spark.read.parquet(f"{folder}/job/outbox").count() == len(high)
