"""Speed violations at one camera and between two. Batch and streaming alike."""

from pyspark.sql import functions as F

from roadwatch.functions.speed import average_speed, limit_seconds
from roadwatch.functions.times import elapsed_seconds
from roadwatch.operators.pairing import union_all


def instant_violations(*sightings):
    """Readings at or above the limit, over any number of cameras."""
    return union_all(
        frame.filter(F.col("speed_reading") >= F.col("speed_limit")) for frame in sightings
    )


def average_violations(*pairs):
    """Matched pairs driven in no more than the time the limit allows, with their speed.

    The distance comes from the start camera, the limit from the end camera. A
    pair at the same instant is kept and has no speed.
    """
    allowed = limit_seconds(F.col("dist_next"), F.col("speed_limit"))
    return (
        union_all(pairs)
        .withColumn("duration", elapsed_seconds(F.col("timestamp_start"), F.col("timestamp_end")))
        .filter(F.col("duration") <= allowed)
        .withColumn("average_speed", average_speed(F.col("dist_next"), F.col("duration")))
    )
