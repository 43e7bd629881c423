"""Severity rules, decision parsing and request text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
DELIVERABLE = ["HIGH", "CRITICAL"]
THROTTLE_ERRORS = [
    "ThrottlingException",
    "TooManyRequestsException",
    "ServiceQuotaExceededException",
    "ModelTimeoutException",
]
JITTER_ACCURACY_M, JITTER_DISTANCE_M, JITTER_DURATION_S = 15.0, 25.0, 20.0
FAR_OUTSIDE_M, LONG_DURATION_S = 200, 60
SPEED_LIMIT, TEMPERATURE_LIMIT, FUEL_RESERVE = 140.0, 120.0, 0.05
GOOD_FIX_M, SUSTAINED_S, CRITICAL_DISTANCE_M = 8.0, 30.0, 100

_BLANKS = " \t\n\r\x0b\x0c"


def _number(column: Column) -> Column:
    return F.coalesce(column.cast("double"), F.lit(0.0))


def _verdict(alert: Column, severity: Column) -> Column:
    return F.struct(
        alert.alias("alert"), F.when(alert, severity).otherwise(F.lit("LOW")).alias("severity")
    )


def severity_rank(severity: Column) -> Column:
    """1 for LOW up to 4 for CRITICAL, 0 for anything else."""
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)


def baseline() -> Column:
    """Threshold rule over a breach: dwell traffic and GPS jitter stay quiet, the rest pages."""
    kind = F.coalesce(F.col("zoneKind"), F.lit(""))
    accuracy = _number(F.col("location.accuracy"))
    distance, duration = _number(F.col("distanceOutsideM")), _number(F.col("durationInStateS"))
    jitter = (
        (accuracy >= JITTER_ACCURACY_M) & (distance < JITTER_DISTANCE_M) & (duration < JITTER_DURATION_S)
    )
    critical = (kind == "containment") | (distance > FAR_OUTSIDE_M) | (duration > LONG_DURATION_S)
    return _verdict((kind != "dwell") & ~jitter, F.when(critical, "CRITICAL").otherwise("HIGH"))


def corroborated() -> Column:
    """Do the vehicle's signals speak for a real incident, whatever the geometry?"""
    fuel = F.col("vehicle.fuelLevel")
    moving_open = F.coalesce(F.col("vehicle.doorOpen"), F.lit(False)) & F.coalesce(
        F.col("vehicle.ignition"), F.lit(False)
    )
    return (
        moving_open
        | (_number(F.col("vehicle.speed")) > SPEED_LIMIT)
        | (_number(F.col("vehicle.engineTemperature")) > TEMPERATURE_LIMIT)
        | F.coalesce(fuel < FUEL_RESERVE, F.lit(False))
    )


def rubric() -> Column:
    """Weighs distance against the GPS error and uses the vehicle's own signals."""
    kind = F.coalesce(F.col("zoneKind"), F.lit(""))
    accuracy = _number(F.col("location.accuracy"))
    distance, duration = _number(F.col("distanceOutsideM")), _number(F.col("durationInStateS"))
    clear_of_error = distance > 2 * F.greatest(accuracy, F.lit(1.0))
    clean_entry = (kind == "exclusion") & (distance == 0.0) & (accuracy <= GOOD_FIX_M)
    lasting = duration >= SUSTAINED_S
    genuine = corroborated() | ((kind != "dwell") & lasting & (clear_of_error | clean_entry))
    critical = corroborated() | (kind == "containment") | (distance >= CRITICAL_DISTANCE_M)
    return _verdict(genuine, F.when(critical, "CRITICAL").otherwise("HIGH"))


def decision_of(severity: Column) -> Column:
    return F.when(severity.isin(*DELIVERABLE), "ALERT").otherwise("NO_ALERT")


def passes_gate(decision: Column, severity: Column) -> Column:
    return F.coalesce((decision == "ALERT") & severity.isin(*DELIVERABLE), F.lit(False))


def is_throttle(error_code: Column) -> Column:
    return F.coalesce(error_code.isin(*THROTTLE_ERRORS), F.lit(False))


def clamp_confidence(value: Column) -> Column:
    """To [0, 1]; anything that is no number counts as 0."""
    number = F.coalesce(value.try_cast("double"), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))


def first_json_object(text: str) -> Column:
    """The first balanced ``{...}`` in the text column, or null.

    Folds over the braces alone: each step knows the length of the text before its brace.
    Braces inside JSON strings count like any other.
    """
    tail = f"substr({text}, instr({text}, '{{'))"
    return F.expr(
        f"""CASE WHEN instr({text}, '{{') > 0 THEN aggregate(
              zip_with(split({tail}, '[{{}}]'), regexp_extract_all({tail}, '[{{}}]', 0),
                       (before, brace) -> named_struct('width', length(before) + 1, 'brace', brace)),
              named_struct('depth', 0, 'at', 0, 'stop', 0),
              (acc, s) -> CASE WHEN acc.stop > 0 OR s.brace IS NULL THEN acc ELSE named_struct(
                'depth', acc.depth + if(s.brace = '{{', 1, -1),
                'at', acc.at + s.width,
                'stop', if(acc.depth + if(s.brace = '{{', 1, -1) = 0, acc.at + s.width, 0)) END,
              acc -> if(acc.stop > 0, substr({tail}, 1, acc.stop), null)) END"""
    )


def answer_text(answer: Column, path: str) -> Column:
    """A text field of a VARIANT answer: trimmed, empty when absent, ``None`` for JSON null."""
    held = F.try_variant_get(answer, path, "variant")
    text = F.when(F.is_variant_null(held), "None").otherwise(F.try_variant_get(answer, path, "string"))
    return F.coalesce(F.btrim(text, F.lit(_BLANKS)), F.lit(""))


def canonical(value: Column, kind: T.DataType) -> Column:
    """A value whose JSON has sorted keys at every level, built from its schema; nulls stay nulls."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        made = F.struct(*[canonical(value.getField(f.name), f.dataType).alias(f.name) for f in fields])
        return F.when(value.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: canonical(v, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"], canonical(e["value"], kind.valueType)))
        return F.map_from_entries(F.array_sort(entries))
    return value


def request_text(breach: Column, breach_type: T.DataType, history: Column, history_type: T.ArrayType) -> Column:
    """The request for one breach: its JSON with sorted keys, then the history, newest last.

    ``breach`` is a struct, ``history`` an array of structs (null or empty: none on record).
    """
    keep = {"ignoreNullFields": "false"}
    known = F.coalesce(F.size(history), F.lit(0)) > 0
    lines = F.concat_ws("\n", F.transform(history, lambda record: F.to_json(canonical(record, history_type.elementType), keep)))
    heading = F.concat(
        F.lit("Vehicle history ("), F.size(history).cast("string"), F.lit(" prior record(s), newest last):\n")
    )
    return F.concat(
        F.lit("Breach event:\n"),
        F.to_json(canonical(breach, breach_type), keep),
        F.lit("\n\n"),
        F.when(known, F.concat(heading, lines)).otherwise(F.lit("Vehicle history: none on record.")),
    )
