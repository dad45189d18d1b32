"""Peaks, lows, spikes and drops of time series, over all series at once."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def peak_and_low(points, keys, time, value):
    """Highest and lowest value of each series, each with its earliest time."""
    earliest_first = -F.unix_micros(F.col(time))
    return points.groupBy(*keys).agg(
        F.max(value).alias("peak"),
        F.max_by(time, F.struct(F.col(value), earliest_first)).alias("peak_time"),
        F.min(value).alias("low"),
        F.min_by(time, F.struct(F.col(value), F.col(time))).alias("low_time"),
    )


def spikes_and_drops(points, keys, time, value, reach=1, sigmas=2.0):
    """Flag points that rise or fall by more than `sigmas` deviations of the series' steps.

    Adds diff, threshold, spike, drop, and for flagged points the region from
    `reach` points before to `reach` points after, cut at the ends of the series.
    """
    series = Window.partitionBy(*keys)
    ordered = series.orderBy(time)
    stepped = points.withColumns(
        {
            "diff": F.col(value) - F.lag(value).over(ordered),
            "before": F.coalesce(F.lag(time, reach).over(ordered), F.min(time).over(series)),
            "after": F.coalesce(F.lead(time, reach).over(ordered), F.max(time).over(series)),
        }
    )
    judged = stepped.withColumn("threshold", F.lit(sigmas) * F.stddev_samp("diff").over(series))
    spike = F.coalesce(F.col("diff") > F.col("threshold"), F.lit(False))
    drop = F.coalesce(F.col("diff") < -F.col("threshold"), F.lit(False))
    flagged = F.col("spike") | F.col("drop")
    return (
        judged.withColumns({"spike": spike, "drop": drop})
        .withColumns(
            {
                "region_start": F.when(flagged, F.col("before")),
                "region_end": F.when(flagged, F.col("after")),
            }
        )
        .drop("before", "after")
    )


def long_form(stats, measures, time="start_time", keys=("camera_id", "type")):
    """Wide statistics to one row per point and measure, ready for the functions above."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value"))
            for name in measures
        ]
    )
    return stats.select(*keys, time, F.inline(pairs))
