"""Hop latencies from in-band stamps, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hop name -> (start stamp, end stamp).
DETECTION_HOPS = {
    "SourceToIoT": ("eventTime", "ingestTime"),
    "StreamWait": ("streamArrival", "flinkRead"),
    "FlinkProcess": ("flinkRead", "flinkEmit"),
    "DetectionTotal": ("eventTime", "flinkEmit"),
}
PROBE_HOPS = {
    "SourceToIoT": ("eventTime", "ingestTime"),
    "IngestToFlink": ("ingestTime", "flinkRead"),
    "FlinkProcess": ("flinkRead", "flinkEmit"),
    "FlinkToAlerts": ("flinkEmit", "alertsArrival"),
}
ANALYZER_HOPS = {
    "TriageBedrock": ("analyzerRead", "bedrockDone"),
    "SqsEnqueue": ("bedrockDone", "sqsEnqueue"),
}
PUBLISHER_HOPS = {"NotifyTotal": ("publisherRead", "snsPublish")}
PROCESSOR_METRICS = ["StreamWait", "FlinkProcess"]
NAMESPACE = "Geofence/Latency"
UNIT = "Milliseconds"


def delta(start: Column, end: Column) -> Column:
    """``end - start``; null when either stamp is missing."""
    return end - start


def hop_map(stamps: Mapping[str, Column], hops: Mapping[str, tuple[str, str]]) -> Column:
    """``map<hop, ms>`` of the hops that have both stamps."""
    absent = F.lit(None).cast("long")
    pairs = []
    for name, (start, end) in hops.items():
        pairs += [F.lit(name), delta(stamps.get(start, absent), stamps.get(end, absent)).cast("long")]
    return F.map_filter(F.create_map(*pairs), lambda _, ms: ms.isNotNull())


def trace_stamps(trace: Column, **more: Column) -> dict[str, Column]:
    """The stamps of a breach's trace block, plus stamps the consumer knows."""
    inside = {name: trace[name] for name in ("eventTime", "ingestTime", "flinkRead", "flinkEmit")}
    return inside | more


def detection_hops(trace: Column, stream_arrival: Column | None = None) -> Column:
    more = {} if stream_arrival is None else {"streamArrival": stream_arrival}
    return hop_map(trace_stamps(trace, **more), DETECTION_HOPS)


def probe_hops(trace: Column, alerts_arrival: Column) -> Column:
    return hop_map(trace_stamps(trace, alertsArrival=alerts_arrival), PROBE_HOPS)


def probe_total(trace: Column, alerts_arrival: Column) -> Column:
    """Event to alert stream; ``DetectionTotal`` of the processor ends earlier, at its emit."""
    return delta(trace["eventTime"], alerts_arrival)


def processor_metrics(hops: Column) -> Column:
    """The hops the processor itself reports."""
    return F.map_filter(hops, lambda name, _: name.isin(*PROCESSOR_METRICS))


def stamp(trace: Column, read: Column, emit: Column) -> Column:
    """The trace with the processor's read and emit times."""
    return trace.withField("flinkRead", read.cast("long")).withField("flinkEmit", emit.cast("long"))


def metric_document(metrics: Column, stage: Column, timestamp: Column | None = None) -> Column:
    """One metric log line (JSON) for a ``map<string, bigint>``; null values are left out."""
    held = F.map_filter(metrics, lambda _, v: v.isNotNull())
    names = F.transform(F.map_keys(held), lambda n: F.struct(n.alias("Name"), F.lit(UNIT).alias("Unit")))
    head = F.struct(
        F.array(
            F.struct(
                F.lit(NAMESPACE).alias("Namespace"),
                F.array(F.array(F.lit("stage"))).alias("Dimensions"),
                names.alias("Metrics"),
            )
        ).alias("CloudWatchMetrics"),
        *([] if timestamp is None else [timestamp.alias("Timestamp")]),
    )
    fixed = F.to_json(F.struct(head.alias("_aws"), stage.alias("stage")))
    values = F.to_json(held)
    # Values sit at the root, beside the fixed part.
    return F.when(F.size(held) == 0, fixed).otherwise(
        F.concat(F.substring(fixed, F.lit(1), F.length(fixed) - 1), F.lit(","), F.substring(values, F.lit(2), F.length(values)))
    )
