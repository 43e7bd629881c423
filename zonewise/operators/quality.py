"""Telemetry parsing with quarantine, stream health, and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewise.functions.once import once
from zonewise.operators.ordered import ARRIVALS_PER_SEGMENT, lookback, span_segment
from zonewise.schemas import LOCATION, TELEMETRY

CORRUPT = "_corrupt_record"
MAX_LATENCY_S = 5.0

# Identity and coordinates stay VARIANT while parsing: their JSON type decides whether a
# record is usable.
_LOOSE = T.StructType(
    [
        *[
            T.StructField(
                f.name,
                T.VariantType()
                if f.name == "vehicleId"
                else T.StructType(
                    [
                        T.StructField(
                            p.name, T.VariantType() if p.name in ("latitude", "longitude") else p.dataType
                        )
                        for p in LOCATION
                    ]
                )
                if f.name == "location"
                else f.dataType,
            )
            for f in TELEMETRY
        ],
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# JSON texts of an id that counts as missing.
_EMPTY_IDS = ["null", '""', "0", "0.0", "-0", "-0.0", "false", "[]", "{}"]


#: What makes a record poison, in the order in which it is looked for.
POISON_REASONS = ["undecodable", "not_object", "missing_vehicle", "missing_location", "bad_coordinate"]


def parse_telemetry(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Raw JSON text as canonical telemetry plus ``poison_reason`` (null for usable rows).

    One parse; nothing fails.  Other columns of ``raw`` are kept.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = raw.withColumn("__r", once(F.from_json(column, _LOOSE, options)))
    rec = F.col("__r")
    lat, lon = rec["location"]["latitude"], rec["location"]["longitude"]

    def missing(v: Column) -> Column:
        return v.isNull() | F.is_variant_null(v)

    def number(v: Column) -> Column:
        return F.try_variant_get(v, "$", "double")

    text = F.ltrim(F.col(column), F.lit(" \t\n\r"))
    # A reader stops behind the first object; as an item of an array, followed by another, it must be all of the text.
    # NaN and infinities are numbers here, but not to that function.
    listed = F.concat(F.lit("["), F.col(column), F.lit(",0]"))
    finite = F.regexp_replace(listed, r"-?\b(NaN|Infinity)\b", "0")
    alone = F.coalesce(F.json_array_length(listed), F.json_array_length(finite), F.lit(0)) == 2
    unreadable = rec.isNull() | (rec[CORRUPT].isNotNull() & rec["vehicleId"].isNull() & rec["location"].isNull())
    reason = (
        F.when(F.col(column).isNull(), "undecodable")
        .when(
            ~text.startswith("{"),
            F.when(F.try_parse_json(F.col(column)).isNull(), "undecodable").otherwise("not_object"),
        )
        .when(unreadable | ~alone, "undecodable")
        .when(
            rec["vehicleId"].isNull() | F.to_json(rec["vehicleId"]).isin(_EMPTY_IDS),
            "missing_vehicle",
        )
        .when(rec["location"].isNull() | missing(lat) | missing(lon), "missing_location")
        .when(number(lat).isNull() | number(lon).isNull(), "bad_coordinate")
    )
    location = F.when(
        rec["location"].isNotNull(),
        F.struct(
            number(lat).alias("latitude"),
            number(lon).alias("longitude"),
            *[rec["location"][f.name].alias(f.name) for f in LOCATION[2:]],
        ),
    )
    fields = {
        "vehicleId": F.try_variant_get(rec["vehicleId"], "$", "string"),
        "location": location,
    }
    if "seq" in raw.columns:  # the arrival number of the log, which the record cannot know
        fields["seq"] = F.col("seq").cast("long")
    kept = [c for c in raw.columns if c not in TELEMETRY.names]
    return parsed.select(
        *kept,
        *[fields.get(f.name, rec[f.name]).alias(f.name) for f in TELEMETRY],
        reason.alias("poison_reason"),
    )


def split_poison(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable telemetry, dead letters)."""
    good = parsed.where(F.col("poison_reason").isNull()).drop("poison_reason")
    return good, parsed.where(F.col("poison_reason").isNotNull())


def poison_counts(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where(F.col("poison_reason").isNotNull())
        .groupBy("poison_reason")
        .agg(F.count(F.lit(1)).alias("dropped"))
    )


def out_of_order(telemetry: DataFrame, span: int = ARRIVALS_PER_SEGMENT) -> DataFrame:
    """Rows whose timestamp is before that of the vehicle's previously *seen* row."""
    seen = lookback(
        telemetry,
        ["vehicleId"],
        ["seq"],
        span_segment("seq", span),
        {"prev_timestamp": lambda w: F.lag("timestamp").over(w)},
    )
    return seen.where(F.col("timestamp") < F.col("prev_timestamp"))


def stream_health(telemetry: DataFrame, arrival: str, span: int = ARRIVALS_PER_SEGMENT) -> DataFrame:
    """One row: records, vehicles, largest latency, rows out of order, verdict.

    Counts per vehicle first, so the distinct count needs no second shuffle of the rows.
    """
    seen = lookback(
        telemetry.select("vehicleId", "seq", "timestamp", F.col(arrival).alias("__arrival")),
        ["vehicleId"],
        ["seq"],
        span_segment("seq", span),
        {"__prev": lambda w: F.lag("timestamp").over(w)},
    )
    late = F.count_if(F.col("timestamp") < F.col("__prev"))
    per_vehicle = seen.groupBy("vehicleId").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("__arrival") - F.col("timestamp")).alias("worst"),
        late.alias("late"),
    )
    totals = per_vehicle.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count(F.lit(1)).alias("vehicles"),
        F.greatest(F.coalesce(F.max("worst"), F.lit(0)), F.lit(0)).alias("max_latency_ms"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"),
    )
    latency = F.col("max_latency_ms").cast("double") / 1000
    ok = (F.col("records") > 0) & (latency < MAX_LATENCY_S) & (F.col("out_of_order") == 0)
    return totals.select(
        "records",
        "vehicles",
        latency.alias("max_latency_s"),
        "out_of_order",
        F.when(ok, "PASS").otherwise("FAIL").alias("result"),
    )


def reconcile(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Published against received messages per vehicle: drops and duplicates.

    Both sides are merged and counted per message, which combines map-side, then per vehicle.
    """
    sides = sent.select("vehicleId", "seq", F.lit(1).alias("out"), F.lit(0).alias("back")).unionByName(
        received.select("vehicleId", "seq", F.lit(0).alias("out"), F.lit(1).alias("back"))
    )
    messages = sides.groupBy("vehicleId", "seq").agg(F.sum("out").alias("out"), F.sum("back").alias("back"))
    return messages.groupBy("vehicleId").agg(
        F.sum("out").alias("published"),
        F.sum("back").alias("received"),
        F.sum(F.greatest(F.col("back") - 1, F.lit(0))).alias("duplicates"),
        F.count_if((F.col("out") > 0) & (F.col("back") == 0)).alias("drops"),
    )


def batch_failures(rows: DataFrame, batch: str, item: str, failed: str) -> DataFrame:
    """Ids of the failed items of each batch; items without an id cannot be reported.

    A batch holds a handful of records, which bounds the list.
    """
    reported = F.col(failed) & F.col(item).isNotNull()
    return rows.groupBy(batch).agg(
        F.sort_array(F.collect_list(F.when(reported, F.col(item)))).alias("batchItemFailures")
    )
