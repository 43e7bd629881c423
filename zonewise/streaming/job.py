"""The whole job: lines of a log to delivered alerts, as one chain over shared storage.

A micro-batch is parsed once.  Poison goes to the dead letters and is counted by reason; the rest is judged by the detector, its
breaches are triaged with the vehicle's history, decisions are remembered, and those that pass the gate are delivered.
Every step writes what belongs to the micro-batch in a folder of its own and replaces it if the micro-batch is repeated.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from zonewise.functions.triage import decision_of
from zonewise.operators import delivery as D
from zonewise.operators import triage
from zonewise.operators.quality import parse_telemetry, poison_counts, split_poison
from zonewise.schemas import BREACH, DECISION
from zonewise.session import materialize, scratch
from zonewise.sources import files
from zonewise.streaming.breaches import BreachDetector
from zonewise.streaming.delivery import Bisecting, Outbox, batch_path

_HISTORY = T.StructType([
    T.StructField("vehicleId", T.StringType()),
    T.StructField("eventTime", T.LongType()),
    T.StructField("severity", T.StringType()),
    T.StructField("seq", T.LongType()),
])


class FleetJob:
    """``triager`` adds ``alert`` and ``severity`` to breaches, which have the vehicle's last decisions as ``history``."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        triager: triage.Triager = triage.rubric,
        now_ms: Callable[[], int] = lambda: int(time.time() * 1000),
        **bisecting,
    ):
        self.spark, self.folder, self.triager, self.now_ms = spark, folder, triager, now_ms
        self.detector = BreachDetector(spark, f"{folder}/detector", sink=self._triaged, now_ms=now_ms)
        self.outbox = Outbox(spark, f"{folder}/outbox", f"{folder}/ledger", now_s=lambda: now_ms() // 1000)
        self.deliver = Bisecting(self.outbox.deliver, f"{folder}/undelivered", begin=self.outbox.begin, now_ms=now_ms, **bisecting)

    # ------------------------------------------------------------ what it has written

    def _table(self, name: str, schema: T.StructType | str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def history(self, but: int | None = None) -> DataFrame:
        """Decisions remembered, newest last by ``eventTime, seq``; without those of the micro-batch ``but``."""
        rows = self._table("history", T.StructType([*_HISTORY.fields, T.StructField("batch", T.LongType())]))
        return rows.where(F.col("batch") != but).drop("batch") if but is not None else rows.drop("batch")

    def dropped(self) -> DataFrame:
        """``ts, stage, name, value``: poison records by reason and micro-batch, as metric rows."""
        return self._table("dropped", "ts bigint, stage string, name string, value bigint")

    # ------------------------------------------------------------ a micro-batch

    def handle(self, lines: DataFrame, batch_id: int) -> None:
        """Take in a micro-batch of ``raw`` lines; other columns, such as ``seq``, are kept."""
        work = f"{self.folder}/work/{batch_id}"
        files.delete(self.spark, work)
        with scratch(work):
            parsed = materialize(parse_telemetry(lines))
        good, poison = split_poison(parsed)
        poison.write.mode("overwrite").parquet(batch_path(f"{self.folder}/dead_letters", lines, batch_id))
        counts = poison_counts(parsed).select(
            F.lit(self.now_ms()).alias("ts"), F.lit("telemetry").alias("stage"), F.col("poison_reason").alias("name"), F.col("dropped").alias("value")
        )
        counts.write.mode("overwrite").parquet(batch_path(f"{self.folder}/dropped", lines, batch_id))
        self.detector.judge(good, batch_id)
        files.delete(self.spark, work)

    def decisions(self, found: DataFrame, batch_id: int) -> DataFrame:
        """``breach, decision, seq`` of breaches: the triager's severity, from which the decision follows."""
        asked = triage.with_history(found, self.history(but=batch_id))
        severity = F.col("severity")
        decision = {
            "decision": decision_of(severity),
            "severity": severity,
            "eventTime": F.col("timestamp"),
            **{c: F.col(c) for c in ("vehicleId", "zoneId", "zoneName", "zoneKind", "breachType", "location")},
        }
        fields = [decision.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DECISION]
        return triage.run_triager(asked, self.triager).select(
            F.struct(*[f.name for f in BREACH]).alias("breach"), F.struct(*fields).alias("decision"), "seq"
        )

    def _triaged(self, found: DataFrame, batch_id: int) -> None:
        work = f"{self.folder}/work/triage-{batch_id}"
        files.delete(self.spark, work)
        with scratch(work):
            decided = materialize(self.decisions(found, batch_id))
        remembered = decided.select("decision.vehicleId", "decision.eventTime", "decision.severity", "seq")
        remembered.write.mode("overwrite").parquet(f"{self.folder}/history/batch={batch_id}")
        messages = D.delivery_messages(triage.gate(decided))
        self.deliver.write(messages, batch_id)
        files.delete(self.spark, work)

    def start(self, lines: DataFrame, rules: DataFrame, **trigger) -> list[StreamingQuery]:
        """Take in all rules there are, then start; rules go on coming in beside it (``BreachDetector.start``)."""
        self.detector.rules.start(rules, availableNow=True).awaitTermination()
        trigger = trigger or {"processingTime": "5 seconds"}
        live = [] if trigger.get("availableNow") else [self.detector.rules.start(rules, **trigger)]
        writer = lines.writeStream.foreachBatch(self.handle).option("checkpointLocation", f"{self.folder}/checkpoint")
        return [*live, writer.trigger(**trigger).start()]
