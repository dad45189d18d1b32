"""Explicit schemas of every table and message; nothing is inferred at run time."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns):
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# JSON payload of one camera sighting.
CAMERA_EVENT = _struct(
    event_id=StringType(),
    batch_id=IntegerType(),
    car_plate=StringType(),
    camera_id=IntegerType(),
    timestamp=TimestampType(),
    speed_reading=DoubleType(),
)

# Headers that travel beside the payload, by name and type.
EVENT_HEADERS = {
    "producer_id": "int",
    "speed_limit": "int",
    "dist_next": "int",
    "processing_timestamp": "timestamp",
}

# A message as the broker hands it over, headers included.
ENVELOPE = _struct(
    key=BinaryType(),
    value=BinaryType(),
    headers=ArrayType(_struct(key=StringType(), value=BinaryType())),
    topic=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
)

CAMERA = _struct(
    camera_id=IntegerType(),
    latitude=DoubleType(),
    longitude=DoubleType(),
    position=DoubleType(),
    speed_limit=IntegerType(),
)

# Raw vehicle register; the date is parsed after the scan.
VEHICLE_RAW = _struct(
    car_plate=StringType(),
    owner_name=StringType(),
    owner_addr=StringType(),
    vehicle_type=StringType(),
    registration_date=StringType(),
)

# Raw historic violations; both times come in mixed formats.
HISTORIC_RAW = _struct(
    car_plate=StringType(),
    camera_id_start=IntegerType(),
    camera_id_end=IntegerType(),
    timestamp_start=StringType(),
    timestamp_end=StringType(),
    speed_reading=DoubleType(),
)

# Flat violation table: one row per violation.
VIOLATION = _struct(
    car_plate=StringType(),
    date=DateType(),
    type=StringType(),
    camera_id_start=IntegerType(),
    camera_id_end=IntegerType(),
    timestamp_start=TimestampType(),
    timestamp_end=TimestampType(),
    speed_reading=DoubleType(),
    updated_at=TimestampType(),
    origin=StringType(),
)

# What makes two violation rows the same violation.
VIOLATION_KEY = [
    "car_plate",
    "date",
    "type",
    "camera_id_start",
    "camera_id_end",
    "timestamp_start",
    "timestamp_end",
    "speed_reading",
]

DROPPED_PAIR = _struct(
    event_id=StringType(),
    car_plate=StringType(),
    camera_id=IntegerType(),
    timestamp=TimestampType(),
    ingested_at=TimestampType(),
)
