"""Canonical schemas of the tables and messages."""

from __future__ import annotations

from pyspark.sql import types as T

# Signal names carried in the open vehicle-signal map.
SIGNALS = {
    "speed": ("vehicle.speed", T.DoubleType()),
    "ignition": ("vehicle.ignition", T.BooleanType()),
    "fuelLevel": ("vehicle.fuel.level", T.DoubleType()),
    "odometer": ("vehicle.odometer", T.DoubleType()),
    "gear": ("vehicle.transmission.gear", T.StringType()),
    "brakeFluidLevel": ("vehicle.chassis.axle.row1.wheel.left.brake.fluidLevel", T.DoubleType()),
    "doorOpen": ("vehicle.cabin.door.row1.left.isOpen", T.BooleanType()),
    "engineTemperature": ("vehicle.powertrain.engine.temperature", T.DoubleType()),
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()

LOCATION = _struct(latitude=_D, longitude=_D, altitude=_D, heading=_D, speed=_D, accuracy=_D)
VSS = T.StructType([T.StructField(path, kind) for path, kind in SIGNALS.values()])

TELEMETRY = _struct(
    vehicleId=_S,
    geoFenceId=_S,
    timestamp=_L,
    ingestTime=_L,
    seq=_L,
    location=LOCATION,
    vss=VSS,
    telemetry=_struct(
        engineRpm=_D,
        batteryVoltage=_D,
        outsideTemperature=_D,
        accelerometerData=_struct(x=_D, y=_D, z=_D),
    ),
    deviceInfo=_struct(deviceId=_S, firmwareVersion=_S, signalStrength=_D),
    routeInfo=_struct(routeType=_S, routeName=_S),
)

RING = T.ArrayType(T.ArrayType(_D))
ZONE_PROPERTIES = _struct(type=_S, alertLevel=_S, maxSpeed=_D)

ZONE = _struct(
    id=_S, name=_S, kind=_S, polygon=RING, properties=ZONE_PROPERTIES, active=_B, createdAt=_L, updatedAt=_L
)

ZONE_CHANGE = _struct(
    op=_S,
    id=_S,
    active=_B,
    kind=_S,
    polygon=RING,
    properties=ZONE_PROPERTIES,
    updatedAt=_L,
    name=_S,
    seq=_L,
)

BREACH = _struct(
    vehicleId=_S,
    zoneId=_S,
    zoneName=_S,
    zoneKind=_S,
    breachType=_S,
    timestamp=_L,
    location=_struct(latitude=_D, longitude=_D, accuracy=_D),
    distanceOutsideM=_D,
    durationInStateS=_L,
    vehicle=_struct(
        speed=_D,
        ignition=_B,
        fuelLevel=_D,
        gear=_S,
        engineTemperature=_D,
        brakeFluidLevel=_D,
        doorOpen=_B,
    ),
    trace=_struct(eventTime=_L, ingestTime=_L, flinkRead=_L, flinkEmit=_L),
)

DECISION = _struct(
    decision=_S,
    severity=_S,
    reason=_S,
    confidence=_D,
    recommendedAction=_S,
    historicalPattern=_S,
    vehicleId=_S,
    zoneId=_S,
    zoneName=_S,
    zoneKind=_S,
    breachType=_S,
    location=_struct(latitude=_D, longitude=_D, accuracy=_D),
    eventTime=_L,
)

DELIVERY = _struct(dedupeKey=_S, decision=DECISION, breach=BREACH)

# One typed attribute of a zone change image, as far as the zone table uses them.
_TEXT = _struct(S=_S)
_NUMBER = _struct(N=_S)
_POINT = _struct(L=T.ArrayType(_NUMBER))
ZONE_IMAGE = _struct(
    id=_TEXT,
    name=_TEXT,
    active=_struct(BOOL=_B),
    polygon=_struct(L=T.ArrayType(_POINT)),
    properties=_struct(M=_struct(type=_TEXT, alertLevel=_TEXT, maxSpeed=_NUMBER)),
    updatedAt=_NUMBER,
)
CHANGE_RECORD = _struct(
    eventName=_S,
    dynamodb=_struct(Keys=_struct(id=_TEXT), NewImage=ZONE_IMAGE, OldImage=ZONE_IMAGE, SequenceNumber=_S),
)
