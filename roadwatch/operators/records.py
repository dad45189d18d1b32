"""Rows of the violation table and the drop log, from detection results."""

from pyspark.sql import functions as F

from roadwatch.functions.times import event_day, mixed_timestamp
from roadwatch.schemas import DROPPED_PAIR, VIOLATION


def _typed(rows, schema, **columns):
    return rows.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in schema.fields]
    )


def average_records(violations, processed_at=None):
    """Average violations as rows; they belong to the day on which the pair ended."""
    return _typed(
        violations,
        VIOLATION,
        car_plate=F.col("car_plate"),
        date=event_day(F.col("timestamp_end")),
        type=F.lit("average"),
        camera_id_start=F.col("camera_id_start"),
        camera_id_end=F.col("camera_id_end"),
        timestamp_start=F.col("timestamp_start"),
        timestamp_end=F.col("timestamp_end"),
        speed_reading=F.col("average_speed"),
        updated_at=_now(processed_at),
        origin=F.lit("stream"),
    )


def instant_records(violations, processed_at=None):
    """Instant violations as rows; the start columns stay NULL."""
    return _typed(
        violations,
        VIOLATION,
        car_plate=F.col("car_plate"),
        date=event_day(F.col("timestamp")),
        type=F.lit("instant"),
        camera_id_start=F.lit(None),
        camera_id_end=F.col("camera_id"),
        timestamp_start=F.lit(None),
        timestamp_end=F.col("timestamp"),
        speed_reading=F.col("speed_reading"),
        updated_at=_now(processed_at),
        origin=F.lit("stream"),
    )


def historic_records(rows):
    """Historic average violations; they belong to the day on which the pair started."""
    parsed = rows.withColumns(
        {name: mixed_timestamp(name) for name in ("timestamp_start", "timestamp_end")}
    )
    return _typed(
        parsed,
        VIOLATION,
        car_plate=F.col("car_plate"),
        date=event_day(F.col("timestamp_start")),
        type=F.lit("average"),
        camera_id_start=F.col("camera_id_start"),
        camera_id_end=F.col("camera_id_end"),
        timestamp_start=F.col("timestamp_start"),
        timestamp_end=F.col("timestamp_end"),
        speed_reading=F.col("speed_reading"),
        updated_at=F.col("timestamp_end"),
        origin=F.lit("historic"),
    )


def unparsed_history(rows):
    """Historic rows with a time that no format fits; `historic_records` leaves that time NULL."""
    lost = [
        F.col(name).isNotNull() & mixed_timestamp(name).isNull()
        for name in ("timestamp_start", "timestamp_end")
    ]
    return rows.filter(lost[0] | lost[1])


def dropped_records(unmatched, ingested_at=None):
    """One sighting per unmatched pair: the end side if it has an event id, else the start side."""
    no_end = F.coalesce(F.col("event_id_end"), F.lit("")) == ""

    def present(name):
        return F.when(no_end, F.col(f"{name}_start")).otherwise(F.col(f"{name}_end"))

    return _typed(
        unmatched,
        DROPPED_PAIR,
        event_id=present("event_id"),
        car_plate=present("car_plate"),
        camera_id=present("camera_id"),
        timestamp=present("timestamp"),
        ingested_at=_now(ingested_at),
    )


def _now(moment):
    return F.current_timestamp() if moment is None else moment
