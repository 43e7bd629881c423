"""Latency means, per-minute statistics and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.sources.fixed import ALARM_RULES

MINUTE_MS = 60_000


def hop_rows(df: DataFrame, hops: Column, *keep: str) -> DataFrame:
    """A hop map as rows: ``hop``, ``ms``."""
    return df.select(*keep, F.explode(hops).alias("hop", "ms"))


def hop_means(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hop").agg(F.avg("ms").alias("mean_ms"))


def mean_total(totals: DataFrame, column: str) -> DataFrame:
    """One row: the mean of the known totals, 0 without any."""
    return totals.agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("mean_total_ms"))


def _counted(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences per distinct value: a busy metric reaches the percentile already condensed."""
    return metrics.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def minute_of(ts: str) -> Column:
    return (F.floor(F.col(ts) / MINUTE_MS) * MINUTE_MS).cast("long")


def minute_stats(metrics: DataFrame, ts: str = "ts") -> DataFrame:
    """``metrics(ts, stage, name, value)`` to max, sum, p50 and p99 per minute, stage and name."""
    keys = ["minute", "stage", "name"]
    counted = _counted(metrics.withColumn("minute", minute_of(ts)), keys)
    stats = counted.groupBy(*keys).agg(
        F.max("value").alias("max"),
        F.sum(F.col("value") * F.col("n")).alias("sum"),
        F.percentile("value", F.array(F.lit(0.5), F.lit(0.99)), F.col("n")).alias("__p"),
    )
    return stats.select(*keys, "max", "sum", F.col("__p")[0].alias("p50"), F.col("__p")[1].alias("p99"))


def hop_percentiles(metrics: DataFrame, hops: list[str], ts: str = "ts") -> DataFrame:
    """p50 and p99 of each hop side by side, per minute and stage."""
    keys = ["minute", "stage"]
    counted = _counted(metrics.withColumn("minute", minute_of(ts)), [*keys, "name"])
    picks = []
    for hop in hops:
        value = F.when(F.col("name") == hop, F.col("value"))
        weight = F.when(F.col("name") == hop, F.col("n")).otherwise(F.lit(0))
        picks += [
            F.percentile(value, 0.5, weight).alias(f"{hop}_p50"),
            F.percentile(value, 0.99, weight).alias(f"{hop}_p99"),
        ]
    return counted.groupBy(*keys).agg(*picks)


def iterator_age(progress: DataFrame, ts: str = "ts") -> DataFrame:
    """Worst age across the shards of each stream per minute: ``progress(ts, stream, shard, age)``."""
    shards = progress.groupBy(minute_of(ts).alias("minute"), "stream", "shard").agg(F.max("age").alias("age"))
    return shards.groupBy("minute", "stream").agg(F.max("age").alias("max_age"))


def queue_depth(letters: DataFrame, queues: list[str]) -> DataFrame:
    """Messages waiting in each of the dead-letter ``queues``, and whether that raises the depth alarm.

    An empty queue has depth 0 and is OK; letters of a queue that is not named count too.
    """
    named = letters.sparkSession.createDataFrame([(q,) for q in queues], "queue string")
    found = letters.groupBy("queue").agg(F.count(F.lit(1)).alias("depth"))
    depth = F.coalesce("depth", F.lit(0)).cast("long")
    return found.join(F.broadcast(named), "queue", "full").select(
        "queue", depth.alias("depth"), F.when(depth >= 1, "ALARM").otherwise("OK").alias("state")
    )


def metric_rows(rows: DataFrame, ts: Column, tracks: list[tuple[str, Column]], signals: Column | None = None) -> DataFrame:
    """``ts, stage, name, value`` from hop maps by stage and an array of ready entries, in one pass over ``rows``."""

    def entries(stage: str, hops: Column) -> Column:
        return F.transform(
            F.map_entries(hops), lambda e: F.struct(F.lit(stage).alias("stage"), e["key"].alias("name"), e["value"].alias("value"))
        )

    every = F.concat(*[entries(stage, hops) for stage, hops in tracks], *([] if signals is None else [signals]))
    return rows.select(ts.alias("ts"), F.inline(every))


def alarms(stats: DataFrame, rules: list[tuple] = ALARM_RULES) -> DataFrame:
    """State of every alarm rule in every minute of ``stats``; a missing metric is OK.

    One group per minute picks the values the rules read, then the short fixed list of rules expands it in place.
    """
    sources = {"max": F.col("max").cast("double"), "sum": F.col("sum").cast("double")}
    picks, states = [], []
    for i, (alarm, name, dimension, statistic, comparison, threshold) in enumerate(rules):
        here = (F.col("name") == name) & (F.col("stage") == dimension)
        picks.append(F.max(F.when(here, sources.get(statistic, F.col("p99")))).alias(f"v{i}"))
        value = F.col(f"v{i}")
        breached = value > threshold if comparison == "GT" else value >= threshold
        state = F.when(F.coalesce(breached, F.lit(False)), "ALARM").otherwise("OK")
        states.append(F.struct(F.lit(alarm).alias("alarm"), value.alias("value"), state.alias("state")))
    return stats.groupBy("minute").agg(*picks).select("minute", F.inline(F.array(*states)))
