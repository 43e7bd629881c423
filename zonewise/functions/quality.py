"""Checks of telemetry, zones and routes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewise.functions.once import let_sql

# What a telemetry message must carry, by parent path.
REQUIRED = {
    "": ["vehicleId", "geoFenceId", "timestamp", "location", "vss", "telemetry", "deviceInfo", "routeInfo"],
    "/location": ["latitude", "longitude", "altitude", "heading", "speed", "accuracy"],
    "/telemetry": ["engineRpm", "batteryVoltage", "outsideTemperature", "accelerometerData"],
    "/deviceInfo": ["deviceId", "firmwareVersion", "signalStrength"],
    "/routeInfo": ["routeType", "routeName"],
}
# The type of each checked field.
FIELD_TYPES = {
    "/vehicleId": "string",
    "/geoFenceId": "string",
    "/timestamp": "integer",
    "/location": "object",
    "/location/latitude": "number",
    "/location/longitude": "number",
    "/location/altitude": "number",
    "/location/heading": "number",
    "/location/speed": "number",
    "/location/accuracy": "number",
    "/vss": "object",
    "/telemetry": "object",
    "/deviceInfo": "object",
    "/routeInfo": "object",
}
# Allowed range of the coordinates.
RANGES = {"/location/latitude": (-90, 90), "/location/longitude": (-180, 180)}
NON_EMPTY = ["/vehicleId", "/geoFenceId"]

# Fields of a complete message and of a factual breach event.
COMPLETE_MESSAGE = {
    "": ["vehicleId", "geoFenceId", "timestamp"],
    "location": ["latitude", "longitude", "accuracy"],
    "vss": ["vehicle.speed", "vehicle.ignition", "vehicle.transmission.gear"],
    "telemetry": ["engineRpm"],
    "telemetry.accelerometerData": ["x"],
    "deviceInfo": ["deviceId"],
    "routeInfo": ["routeName"],
}
FACT_FIELDS = {
    "": ["distanceOutsideM", "durationInStateS"],
    "location": ["latitude", "longitude", "accuracy"],
    "vehicle": ["speed"],
}
JUDGEMENT_FIELDS = ["severity", "reason", "violation_name"]


def _is(kind: str, shape: str, value: str) -> str:
    number = f"try_variant_get({value}, '$', 'double')"
    numeric = f"({shape} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {shape} LIKE 'DECIMAL%')"
    return {
        "string": f"{shape} = 'STRING'",
        "object": f"{shape} LIKE 'OBJECT%'",
        "number": numeric,
        "integer": f"({numeric} AND {number} = floor({number}))",
    }[kind]


def message_errors(message: str) -> Column:
    """All rule violations of the VARIANT column ``message``, as ``array<string>``.

    Every field the rules name is looked up once (``f``) and its JSON type found once (``s``).
    """
    pointers = list(dict.fromkeys(["", *[f"{p}/{n}" for p, names in REQUIRED.items() for n in names], *FIELD_TYPES]))
    typed = [p for p in pointers if p == "" or p in FIELD_TYPES]
    number_of = {p: i for i, p in enumerate(pointers)}
    value = {p: f"f.v{i}" for p, i in number_of.items()}
    shape = {p: f"s.t{number_of[p]}" for p in typed}
    values = ", ".join(
        f"'v{i}', " + (f"try_variant_get({message}, '${p.replace('/', '.')}', 'variant')" if p else message)
        for p, i in number_of.items()
    )
    shapes = ", ".join(f"'t{number_of[p]}', schema_of_variant({value[p]})" for p in typed)

    root_ok = f"coalesce({_is('object', shape[''], value[''])}, false)"
    found = [f"CASE WHEN NOT {root_ok} THEN 'message / must be object' END"]

    def add(condition: str, pointer: str, text: str) -> None:
        quoted = text.replace("'", "\\'")
        found.append(f"CASE WHEN {condition} THEN 'message {pointer or '/'} {quoted}' END")

    for parent, names in REQUIRED.items():
        present = f"coalesce({_is('object', shape[parent], value[parent])}, false)"
        for name in names:
            missing = f"{value[f'{parent}/{name}']} IS NULL"
            add(f"{present} AND {missing}", parent, f"must have required property '{name}'")
    for pointer, kind in FIELD_TYPES.items():
        wrong = f"NOT coalesce({_is(kind, shape[pointer], value[pointer])}, false)"
        add(f"{value[pointer]} IS NOT NULL AND {wrong}", pointer, f"must be {kind}")
    for pointer, (low, high) in RANGES.items():
        numeric = _is("number", shape[pointer], value[pointer])
        number = f"try_variant_get({value[pointer]}, '$', 'double')"
        add(f"coalesce({numeric} AND {number} < {low}, false)", pointer, f"must be >= {low}")
        add(f"coalesce({numeric} AND {number} > {high}, false)", pointer, f"must be <= {high}")
    for pointer in NON_EMPTY:
        text = f"{shape[pointer]} = 'STRING' AND try_variant_get({value[pointer]}, '$', 'string') = ''"
        add(f"coalesce({text}, false)", pointer, "must NOT have fewer than 1 characters")
    rules = f"filter(array({', '.join(found)}), e -> e IS NOT NULL)"
    return F.expr(let_sql("f", f"named_struct({values})", let_sql("s", f"named_struct({shapes})", rules)))


def zone_errors(zone_id: str, polygon: str) -> Column:
    """Violations of the ring rules of a zone: enough points, closed, in range."""
    return F.expr(
        f"""concat(
          if(size({polygon}) < 4,
             array(concat({zone_id}, ': polygon needs >= 4 points (closed ring with >= 3 vertices)')), array()),
          if(coalesce(get({polygon}, 0)[0] = get({polygon}, size({polygon}) - 1)[0]
                  AND get({polygon}, 0)[1] = get({polygon}, size({polygon}) - 1)[1], false),
             array(), array(concat({zone_id}, ': polygon ring is not closed'))),
          transform(
            filter({polygon}, p -> NOT (p[0] BETWEEN -90 AND 90 AND p[1] BETWEEN -180 AND 180)),
            p -> concat({zone_id}, ': point out of range [', p[0], ', ', p[1], ']')))"""
    )


def route_errors(name: str, waypoints: str) -> Column:
    return F.expr(f"if(size({waypoints}) < 2, array(concat({name}, ': route needs >= 2 waypoints')), array())")


def _has(json: str, parent: str, name: str) -> str:
    holder = f"get_json_object({json}, '$.{parent}')" if parent else json
    return f"coalesce(array_contains(json_object_keys({holder}), '{name}'), false)"


def _has_all(json: str, fields: dict[str, list[str]]) -> str:
    return " AND ".join(_has(json, parent, name) for parent, names in fields.items() for name in names)


def is_complete_message(json: str) -> Column:
    """Every named field is present in the JSON text; false and zero count as present."""
    return F.expr(_has_all(json, COMPLETE_MESSAGE))


def is_fact_only(json: str) -> Column:
    """A breach event in JSON that has all facts and no judgement."""
    judged = " OR ".join(_has(json, "", name) for name in JUDGEMENT_FIELDS)
    return F.expr(f"{_has_all(json, FACT_FIELDS)} AND NOT ({judged})")
