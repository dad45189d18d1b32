"""The live view: recently changed documents, trailing hour, five-minute statistics."""

from pyspark.sql import functions as F

from roadwatch.functions.times import SECOND, bin_start

BIN_SECONDS = 300


def changed_documents(violations, since):
    """All rows of documents that a stream has written to after `since`.

    The choice is by document (car and day): a chosen one comes whole, with older
    and historic rows. Documents known from history alone are never chosen. The days concerned, at
    most one row per day of the calendar, are broadcast first, so that a store partitioned by
    date is read for those days alone.
    """
    touched = (
        violations.filter((F.col("origin") == "stream") & (F.col("updated_at") > since))
        .select("car_plate", "date")
        .distinct()
    )
    days = touched.filter("date IS NOT NULL").select("date").distinct()
    dated = violations.filter("date IS NOT NULL").join(F.broadcast(days), "date", "left_semi")
    undated = violations.filter("date IS NULL")
    of = touched.select(F.col("car_plate").alias("of_plate"), F.col("date").alias("of_date"))
    same = F.col("car_plate").eqNullSafe(F.col("of_plate")) & F.col("date").eqNullSafe(F.col("of_date"))
    return dated.unionByName(undated).join(of, same, "left_semi")


def arrivals(violations, bin_seconds=BIN_SECONDS):
    """The live view's columns: camera, type, speed and the bin of arrival."""
    return violations.select(
        F.col("camera_id_end").alias("camera_id"),
        bin_start(F.col("timestamp_end"), bin_seconds).alias("arrival_time"),
        "updated_at",
        "speed_reading",
        "type",
    )


def trailing_hour(rows, horizon_seconds=3600, max_cameras=100_000):
    """Rows no further than the horizon behind the latest arrival at their camera.

    The latest arrivals are one small row per camera. Once their number is known to be below
    `max_cameras` they are broadcast, so that rows are never shuffled by camera, where a few
    keys would hold everything; more cameras spread well enough for a shuffled join.
    """
    arrival = F.unix_micros("arrival_time")
    horizon = int(horizon_seconds) * SECOND
    latest = rows.groupBy(F.col("camera_id").alias("latest_camera")).agg(
        F.max(arrival).alias("latest")
    )
    if latest.limit(max_cameras + 1).count() <= max_cameras:
        latest = F.broadcast(latest)
    return rows.join(
        latest,
        F.col("camera_id").eqNullSafe(F.col("latest_camera"))
        & (arrival >= F.col("latest") - F.lit(horizon)),
        "inner",
    ).drop("latest_camera", "latest")


def bin_statistics(rows, time="arrival_time", bin_seconds=BIN_SECONDS, quantile=0.9):
    """Count, mean speed and approximate quantile per bin, camera and type.

    Also valid on a stream with a watermark on `time`.
    """
    return (
        rows.groupBy(F.window(time, f"{bin_seconds} seconds"), "camera_id", "type")
        .agg(
            F.count("*").alias("total_violations"),
            F.avg("speed_reading").alias("avg_speed"),
            F.percentile_approx("speed_reading", quantile).alias("p90_speed"),
        )
        .select(
            "camera_id",
            "type",
            "total_violations",
            "avg_speed",
            "p90_speed",
            F.col("window.start").alias("start_time"),
            F.col("window.end").alias("end_time"),
        )
    )


def live_statistics(rows, horizon_seconds=3600, bin_seconds=BIN_SECONDS, quantile=0.9):
    """Five-minute statistics of each camera's trailing hour; earlier bins are never sketched."""
    recent = trailing_hour(rows, horizon_seconds)
    return bin_statistics(recent, bin_seconds=bin_seconds, quantile=quantile)


# Size of the quantile sketch of a bin; one with fewer speeds keeps them all.
SKETCH = 1024


def bin_parts(violations, bin_seconds=BIN_SECONDS):
    """What a day adds to each bin: counts, the sum of speeds and a sketch of them, all of which can be merged."""
    rows = violations.withColumn("arrival_time", bin_start(F.col("timestamp_end"), bin_seconds))
    return rows.groupBy("date", F.col("camera_id_end").alias("camera_id"), "type", "arrival_time").agg(
        F.count("*").alias("total"),
        F.count("speed_reading").alias("n_speeds"),
        F.sum("speed_reading").alias("speed_sum"),
        F.kll_sketch_agg_double(F.col("speed_reading"), SKETCH).alias("speeds"),
    )


def merged_statistics(parts, horizon_seconds=3600, bin_seconds=BIN_SECONDS, quantile=0.9):
    """The live statistics of each camera's trailing hour, from stored parts of bins."""
    bins = trailing_hour(parts, horizon_seconds).groupBy("camera_id", "type", "arrival_time").agg(
        F.sum("total").alias("total_violations"),
        (F.sum("speed_sum") / F.nullif(F.sum("n_speeds"), F.lit(0))).alias("avg_speed"),
        F.sum("n_speeds").alias("n_speeds"),
        F.kll_merge_agg_double("speeds", SKETCH).alias("speeds"),
    )
    high = F.kll_sketch_get_quantile_double("speeds", F.lit(float(quantile)))
    return bins.select(
        "camera_id",
        "type",
        "total_violations",
        "avg_speed",
        F.when(F.col("n_speeds") > 0, high).alias("p90_speed"),
        F.col("arrival_time").alias("start_time"),
        F.timestamp_seconds(F.unix_seconds("arrival_time") + F.lit(int(bin_seconds))).alias("end_time"),
    )


def high_water_mark(rows, since):
    """One row: `since` as it was, and the latest update among the rows as `next_since`."""
    return rows.agg(F.max("updated_at").alias("next_since")).select(
        since.alias("since"), F.greatest("next_since", since).alias("next_since")
    )
