"""Hour-of-day statistics per camera and per segment, and the hotspot map's data."""

from pyspark.sql import functions as F

from roadwatch.functions.speed import midpoint
from roadwatch.functions.times import hour_of_day
from roadwatch.sources.tables import in_date_range

THRESHOLD = 100


def hourly_camera_stats(violations, start, end):
    """Count and mean speed per hour of day and end camera, all types, dates in [start, end)."""
    return (
        in_date_range(violations, start, end)
        .groupBy(
            hour_of_day(F.col("timestamp_end")).alias("hour"),
            F.col("camera_id_end").alias("camera_id"),
        )
        .agg(*_measures())
        .orderBy("hour")
    )


def hourly_segment_stats(violations, start, end):
    """The same per segment, for average violations."""
    return (
        in_date_range(violations, start, end)
        .filter(F.col("type") == "average")
        .groupBy(
            hour_of_day(F.col("timestamp_end")).alias("hour"),
            "camera_id_start",
            "camera_id_end",
            "type",
        )
        .agg(*_measures())
        .orderBy("hour")
    )


def _measures():
    return [
        F.count("*").alias("violation_count"),
        F.avg("speed_reading").alias("exceeded_speed"),
    ]


def hotspot_class(count, threshold=THRESHOLD):
    """'hotspot' above the threshold, 'normal' below, NULL exactly on it."""
    return F.when(count > threshold, "hotspot").when(count < threshold, "normal")


def hotspots(violations, cameras, start, end, hour=None, threshold=THRESHOLD):
    """Camera cells with coordinates and class; `hour` picks one hour of the day.

    Cells exactly on the threshold carry no marker and keep a NULL class. The
    lookup joins aggregated cells, a handful of rows per camera.
    """
    cells = hourly_camera_stats(violations, start, end)
    if hour is not None:
        cells = cells.filter(F.col("hour") == hour)
    return cells.join(
        cameras.select("camera_id", "latitude", "longitude"), "camera_id", "inner"
    ).select(
        "hour",
        "camera_id",
        "latitude",
        "longitude",
        "violation_count",
        F.round("exceeded_speed", 2).alias("exceeded_speed"),
        hotspot_class(F.col("violation_count"), threshold).alias("class"),
    )


def segment_hotspots(violations, cameras, start, end, hour=None):
    """Segment cells placed halfway between their two cameras."""
    cells = hourly_segment_stats(violations, start, end)
    if hour is not None:
        cells = cells.filter(F.col("hour") == hour)
    return place_segments(cells, cameras).withColumn(
        "exceeded_speed", F.round("exceeded_speed", 2)
    )


def place_segments(cells, cameras):
    """Add the midpoint of the start and end camera."""

    def ends(side):
        return cameras.select(
            F.col("camera_id").alias(f"camera_id_{side}"),
            F.col("latitude").alias(f"lat_{side}"),
            F.col("longitude").alias(f"lon_{side}"),
        )

    return (
        cells.join(ends("start"), "camera_id_start")
        .join(ends("end"), "camera_id_end")
        .withColumns(
            {
                "mid_lat": midpoint(F.col("lat_start"), F.col("lat_end")),
                "mid_lon": midpoint(F.col("lon_start"), F.col("lon_end")),
            }
        )
        .drop("lat_start", "lon_start", "lat_end", "lon_end")
    )
