"""Dedupe key and alert text as Column expressions.

They read the columns ``decision`` and ``breach`` of a delivery message.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SECTIONS = ["CURRENT STATUS", "WHY THIS ALERT", "IMPACT", "RECOMMENDED ACTIONS"]
NO_HISTORY = "No prior related history on record."
NO_ACTION = "Review and dispatch as appropriate."
SUBJECT_LIMIT = 100


def dedupe_key(vehicle: Column, zone: Column, breach_type: Column, timestamp: Column) -> Column:
    """``vehicle|zone|type|time``; a missing part stays empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (vehicle, zone, breach_type, timestamp)]
    return F.concat_ws("|", *parts)


def _or(*choices: Column) -> Column:
    """The first choice that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices[:-1]], choices[-1])


def _else(column: Column, fallback: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit(fallback))


def subject() -> Column:
    d, b = F.col("decision"), F.col("breach")
    return F.format_string(
        "[%s] Vehicle %s: %s %s",
        _else(d["severity"], "UNKNOWN"),
        _or(d["vehicleId"], _else(b["vehicleId"], "unknown")),
        _or(d["zoneName"], d["zoneId"], F.lit("a geofence")),
        _or(d["breachType"], _else(b["breachType"], "breach")),
    )


def location_text(location: Column) -> Column:
    known = location["latitude"].isNotNull() & location["longitude"].isNotNull()
    return F.when(
        known, F.format_string("%.5f, %.5f", location["latitude"], location["longitude"])
    ).otherwise("unknown")


def _metres(value: Column) -> Column:
    """Shortest text of a double, without an exponent."""
    return F.when(F.abs(value) < 1e7, value.cast("string")).when(value.isNotNull(), F.format_string("%.1f", value))


def _facts() -> dict[str, Column]:
    d, b = F.col("decision"), F.col("breach")
    status = F.concat(
        F.lit("Vehicle "),
        _else(d["vehicleId"], "unknown"),
        F.lit(" at "),
        location_text(F.coalesce(d["location"], b["location"])),
        F.lit("; "),
        _else(b["durationInStateS"], "0"),
        F.lit("s in state, "),
        F.coalesce(_metres(b["distanceOutsideM"]), F.lit("0")),
        F.lit("m outside the boundary."),
    )
    why = F.concat(
        _else(d["severity"], "UNKNOWN"),
        F.lit(" "),
        _else(d["zoneKind"], ""),
        F.lit(" "),
        _else(d["breachType"], "breach"),
        F.lit(" at "),
        _or(d["zoneName"], _else(d["zoneId"], "a geofence")),
        F.lit(". "),
        _else(d["reason"], ""),
    )
    return {
        "CURRENT STATUS": status,
        "WHY THIS ALERT": why,
        "IMPACT": _or(d["historicalPattern"], F.lit(NO_HISTORY)),
        "RECOMMENDED ACTIONS": _or(d["recommendedAction"], F.lit(NO_ACTION)),
    }


def body(drafted: Column | None = None) -> Column:
    """The four sections in order; a drafted text (``map<string,string>``) replaces the facts."""
    parts = []
    for name, fact in _facts().items():
        text = fact if drafted is None else _or(F.try_element_at(drafted, F.lit(name)), fact)
        parts.append(F.concat(F.lit(f"{name}:\n"), F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))))
    return F.concat_ws("\n\n", *parts)


def cut_subject(text: Column) -> Column:
    return F.substring(text, 1, SUBJECT_LIMIT)
