"""Deduplicated delivery, metric windows and progress metrics on streams."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from zonewise.operators import delivery as D
from zonewise.session import materialize, scratch
from zonewise.sources import files
from zonewise.sources.streams import HOUR_MS, split_expired

CLAIMS = "dedupeKey string, expiresAt bigint, bucket int, query string, batch bigint"

#: A ledger's buckets, the batches after which it is compacted, and how long a compaction may take before another takes over.
LEDGER_BUCKETS, COMPACT_AFTER, STALE_S = 64, 16, 3600


def query_of(rows: DataFrame) -> str:
    """The id of the stream that hands over a micro-batch; it stays the same as long as the checkpoint does."""
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_path(path: str, rows: DataFrame, batch_id: int) -> str:
    """The partition that one micro-batch of one stream owns, and overwrites if it is repeated."""
    return f"{path}/query={query_of(rows)}/batch={batch_id}"


class Ledger:
    """Claims of delivered keys, by a hash of the key in buckets.

    Each batch of a stream adds a folder of its own, written by bucket; after ``COMPACT_AFTER`` of them they are merged with
    the base into a new base, without claims that have expired.  A small file names the base and what it holds, and is put in
    place at once, so readers see the old state or the new one.  The base before stays until the next compaction for those
    who still read it.  A batch reads only the buckets of its own keys.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = LEDGER_BUCKETS, compact_after: int = COMPACT_AFTER):
        self.spark, self.path, self.buckets, self.compact_after = spark, path, buckets, compact_after

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("dedupeKey"), F.lit(self.buckets)).cast("int")

    def _state(self) -> dict:
        return files.read_json(self.spark, f"{self.path}/current.json", {"base": None, "merged": [], "before": None})

    def _added(self) -> list[str]:
        """Folders of batches, ``query=Q/batch=N/part=P``, whose writing has ended."""
        spark, root = self.spark, f"{self.path}/added"
        out = []
        for query in files.folders(spark, root):
            for batch in files.folders(spark, f"{root}/{query}"):
                parts = files.committed_folders(spark, f"{root}/{query}/{batch}")
                out += [f"{query}/{batch}/{part}" for part in parts]
        return out

    def _read(self, base: str | None, added: list[str], but: tuple[str, int] | None = None) -> DataFrame:
        spark = self.spark
        out = spark.createDataFrame([], CLAIMS)
        if base is not None:
            merged = spark.read.schema(CLAIMS).parquet(f"{self.path}/base/{base}")
            out = out.unionByName(merged if but is None else merged.where((F.col("query") != but[0]) | (F.col("batch") != but[1])))
        # At most ``compact_after`` and what other streams are adding.
        for name in added:
            out = out.unionByName(spark.read.schema(CLAIMS).parquet(f"{self.path}/added/{name}"))
        return out

    def claims(self, keys: DataFrame | None = None, but: tuple[str, int] | None = None) -> DataFrame:
        """All claims, or those in the buckets of ``keys`` (``dedupeKey``).

        ``but`` names the batch of a stream that asks: what the base holds of it comes from an earlier attempt.
        """
        state = self._state()
        rows = self._read(state["base"], [a for a in self._added() if a not in set(state["merged"])], but)
        if keys is None:
            return rows
        # At most ``buckets`` numbers.
        wanted = [r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect()]
        return rows.where(F.col("bucket").isin(wanted))

    def add(self, claims: DataFrame, query: str, batch_id: int, part: str = "all") -> None:
        rows = claims.select(
            "dedupeKey", "expiresAt", F.lit(query).alias("query"), F.lit(batch_id).cast("long").alias("batch"), self.bucket().alias("bucket")
        )
        path = f"{self.path}/added/query={query}/batch={batch_id}/part={part}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def forget(self, query: str, batch_id: int) -> None:
        """Take back what a batch that is repeated added before."""
        files.delete(self.spark, f"{self.path}/added/query={query}/batch={batch_id}")

    def compact(self, now_s: int, sparing: tuple[str, int] | None = None) -> bool:
        """Merge added claims into a new base, if there are enough; not those of the batch ``sparing``, which may be repeated."""
        state, added = self._state(), self._added()
        old = [a for a in added if a in set(state["merged"])]
        spared = f"query={sparing[0]}/batch={sparing[1]}/" if sparing else None
        ready = [a for a in added if a not in set(old) and not (spared and a.startswith(spared))]
        if len(ready) < self.compact_after or not files.create_lock(self.spark, f"{self.path}/compacting", STALE_S):
            return False
        try:
            live = self._read(state["base"], ready).where(F.col("expiresAt") > now_s)
            name = uuid.uuid4().hex
            live.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/base/{name}")
            files.write_json(self.spark, f"{self.path}/current.json", {"base": name, "merged": ready, "before": state["base"]})
            # What the base before last and the last merge held is read by nobody any more.
            if state["before"] is not None:
                files.delete(self.spark, f"{self.path}/base/{state['before']}")
            for a in old:
                files.delete(self.spark, f"{self.path}/added/{a}")
        finally:
            files.delete(self.spark, f"{self.path}/compacting")
        return True


class Outbox:
    """Alert rows and the ledger of delivered keys, as tables in shared storage.

    Each micro-batch of a stream owns one partition (``query=Q/batch=N``) of both tables and replaces it, and
    reads only the claims of other batches.  A repeated batch therefore finds the same
    claims, writes the same rows, and delivers each key once.  A batch may be handed over in parts
    (``Bisecting``): ``begin`` takes back what an earlier attempt at it has left, and a part sees the claims of those before it.
    """

    def __init__(
        self,
        spark: SparkSession,
        outbox: str,
        ledger: str,
        ttl_days: int = D.TTL_DAYS,
        now_s: Callable[[], int] = lambda: int(time.time()),
        drafted: str | None = None,
        buckets: int = LEDGER_BUCKETS,
        compact_after: int = COMPACT_AFTER,
    ):
        self.outbox, self.ledger = outbox, Ledger(spark, ledger, buckets, compact_after)
        self.ttl_days, self.now_s, self.drafted = ttl_days, now_s, drafted

    def claims(self, spark: SparkSession) -> DataFrame:
        return self.ledger.claims()

    def begin(self, rows: DataFrame, batch_id: int) -> None:
        self.ledger.forget(query_of(rows), batch_id)
        files.delete(self.ledger.spark, batch_path(self.outbox, rows, batch_id))
        self.ledger.compact(self.now_s(), sparing=(query_of(rows), batch_id))

    def deliver(self, messages: DataFrame, batch_id: int, part: str = "all") -> None:
        """Deliver a part of a micro-batch."""
        now, query = self.now_s(), query_of(messages)
        with scratch(f"{self.ledger.path}/work/{uuid.uuid4().hex}") as work:
            rows = materialize(messages)
            others = self.ledger.claims(rows, but=(query, batch_id))
            new = materialize(D.undelivered(rows, others, now))
            D.outbox(new, self.drafted).write.mode("overwrite").parquet(f"{batch_path(self.outbox, messages, batch_id)}/part={part}")
            self.ledger.add(D.claims(new, now, self.ttl_days), query, batch_id, part)
        files.delete(self.ledger.spark, work)

    def write(self, messages: DataFrame, batch_id: int) -> None:
        """Deliver one micro-batch of delivery messages (``dedupeKey``, ``decision``, ``breach``, ``seq``)."""
        self.begin(messages, batch_id)
        self.deliver(messages, batch_id)


class Bisecting:
    """A ``foreachBatch`` writer that finds the rows a handler fails on and delivers the others.

    A batch that fails is halved by a hash of its rows, and each half again, until a row fails alone; that row is tried
    ``retries`` times more and then goes to the dead letters, with the error, the number of tries and its age.  Rows older than
    ``max_age_ms`` by the column ``arrival`` go there untried.  Of n rows with one bad one, about 2 log2(n) parts are tried.
    ``handle(rows, batch_id, part)`` must replace what it wrote for the same part; ``begin(rows, batch_id)`` is called
    first, to take back what an earlier attempt at the batch left.  Equal rows cannot be told apart and fail together.
    """

    def __init__(
        self,
        handle: Callable[[DataFrame, int, str], None],
        dead_letters: str,
        begin: Callable[[DataFrame, int], None] | None = None,
        retries: int = 3,
        arrival: str | None = None,
        max_age_ms: int = HOUR_MS,
        wait: Callable[[int], None] = lambda attempt: time.sleep(min(10.0, 0.5 * 2**attempt)),
        now_ms: Callable[[], int] = lambda: int(time.time() * 1000),
    ):
        self.handle, self.begin, self.dead_letters = handle, begin, dead_letters
        self.retries, self.arrival, self.max_age_ms, self.wait, self.now_ms = retries, arrival, max_age_ms, wait, now_ms

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark, place = rows.sparkSession, batch_path(self.dead_letters, rows, batch_id)
        files.delete(spark, place)
        if self.begin is not None:
            self.begin(rows, batch_id)
        work = f"{self.dead_letters}/_work/{uuid.uuid4().hex}"
        with scratch(work):
            whole = materialize(rows.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])))
            if self.arrival is not None:
                young, old = split_expired(whole, self.arrival, self.now_ms(), self.max_age_ms)
                self._bury(old.drop("error"), place, "expired", "expired", 0)
                whole = young
            self._try(whole, batch_id, "all", 0, place)
        files.delete(spark, work)

    def _try(self, rows: DataFrame, batch_id: int, part: str, depth: int, place: str) -> None:
        try:
            self.handle(rows.drop("__h"), batch_id, part)
            return
        except Exception as error:
            failed = error
        facts = rows.agg(F.min("__h").alias("low"), F.max("__h").alias("high")).first()
        if facts["low"] is None:
            raise failed  # no row is to blame
        if facts["low"] != facts["high"]:
            bit = F.shiftright("__h", depth).bitwiseAND(F.lit(1)) == 0
            for half, name in ((rows.where(bit), f"{part}-0"), (rows.where(~bit), f"{part}-1")):
                if not half.isEmpty():
                    self._try(half, batch_id, name, depth + 1, place)
            return
        for attempt in range(self.retries):
            self.wait(attempt)
            try:
                self.handle(rows.drop("__h"), batch_id, part)
                return
            except Exception as error:
                failed = error
        self._bury(rows, place, part, f"{type(failed).__name__}: {failed}"[:1000], self.retries)

    def _bury(self, rows: DataFrame, place: str, part: str, error: str, retries: int) -> None:
        age = F.lit(None) if self.arrival is None else F.lit(self.now_ms()) - F.col(self.arrival)
        made = rows.drop("__h").select(
            "*", F.lit(error).alias("error"), F.lit(retries).alias("retries"), age.cast("long").alias("age_ms")
        )
        made.write.mode("overwrite").parquet(f"{place}/part={part}")


def start_delivery(messages: DataFrame, checkpoint: str, sink: Outbox, **trigger) -> StreamingQuery:
    """Start delivering a stream of messages; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = messages.writeStream.foreachBatch(sink.write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def deduplicated(alerts: DataFrame, clock_ms: str, days: int = D.TTL_DAYS) -> DataFrame:
    """Drop repeats of a key inside the stream, for as long as the watermark remembers it."""
    timed = alerts.withColumn("__ts", F.timestamp_millis(F.col(clock_ms)))
    return timed.withWatermark("__ts", f"{days} days").dropDuplicatesWithinWatermark(["dedupeKey"]).drop("__ts")


def minute_windows(metrics: DataFrame, ts: str = "ts", lateness: str = "2 minutes") -> DataFrame:
    """Streaming ``metrics(ts, stage, name, value)`` per minute: max, sum, p50 and p99.

    The state of a minute counts its distinct values, so the percentiles are those of ``monitoring.minute_stats`` over the
    same rows; it is closed when the watermark has passed.
    """
    timed = metrics.withColumn("__ts", F.timestamp_millis(F.col(ts))).withWatermark("__ts", lateness)
    grouped = timed.groupBy(F.window("__ts", "1 minute"), "stage", "name").agg(
        F.max("value").alias("max"),
        F.sum("value").alias("sum"),
        F.percentile("value", F.array(F.lit(0.5), F.lit(0.99))).alias("p"),
    )
    return grouped.select(
        F.unix_millis("window.start").alias("minute"), "stage", "name", "max", "sum", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p99")
    )


def metric_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of metric rows; a repeated batch overwrites its own partition."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(batch_path(path, rows, batch_id))

    return write


def dead_letter_sink(
    good: Callable[[DataFrame, int], None], dead_letters: str, error: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that sends rows with an error aside and hands on the rest."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.where(F.col(error).isNotNull()).write.mode("overwrite").parquet(batch_path(dead_letters, rows, batch_id))
        good(rows.where(F.col(error).isNull()).drop(error), batch_id)

    return write


PROGRESS = "ts bigint, stage string, name string, value double"


class ProgressMetrics(StreamingQueryListener):
    """Appends the progress reports of streaming queries as metric rows to a table by day, one small file for each report.

    A report is written when it comes, so nothing is kept on the driver and nothing is lost with it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ts = int(datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
        stage = p.name or str(p.id)
        values = {
            "inputRows": p.numInputRows,
            "inputRowsPerSecond": p.inputRowsPerSecond,
            "processedRowsPerSecond": p.processedRowsPerSecond,
            "triggerMs": p.durationMs.get("triggerExecution", 0),
        }
        rows = [{"ts": ts, "stage": stage, "name": name, "value": float(v or 0.0)} for name, v in values.items()]
        files.write_json(self.spark, f"{self.path}/day={ts // 86_400_000}/{p.id}-{p.runId}-{p.batchId}-{ts}.json", rows)

    def table(self) -> DataFrame:
        """All reports, ready for ``monitoring.minute_stats``."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).json(self.path).select("ts", "stage", "name", "value")
