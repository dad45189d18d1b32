"""Cameras and vehicles: reduction, lookups and key checks."""

from pyspark.sql import functions as F

from roadwatch.functions.speed import midpoint


def latest_vehicles(vehicles, order=("registration_date",), key="car_plate"):
    """One row per plate: for each column, the last non-null value by `order`.

    Rows without a plate are left out. Further columns in `order` settle ties;
    only its first column is part of the result.
    """
    tiebreaks = set(order[1:])
    rank = F.struct(*order)
    values = [c for c in vehicles.columns if c != key and c not in tiebreaks]
    return (
        vehicles.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[
                F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c)
                for c in values
            ]
        )
    )


def with_id(rows, key):
    """Rename a table's key to `id`, the name it is stored under."""
    return rows.withColumnRenamed(key, "id")


def with_owner(violations, vehicles):
    """Violations with the vehicle's details; a car not in the register keeps its rows.

    A plain join: adaptive execution splits the partition of a plate with very many violations. Both
    sides from `save_by_plate` are joined bucket by bucket, without any shuffle.
    """
    return violations.join(vehicles, "car_plate", "left")


def save_by_plate(rows, name, path, buckets):
    """Save a table in buckets of plates, sorted, for joins by plate without a shuffle.

    A plate is in one bucket, so this is for tables that no plate holds much of; `path` is the
    table's folder, `name` its name in the session's catalog.
    """
    rows.write.bucketBy(buckets, "car_plate").sortBy("car_plate").mode("overwrite").option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def without_deregistered(vehicles, deregistered):
    """Vehicles whose plate is not in the deregistered list."""
    return vehicles.join(deregistered.select("car_plate").distinct(), "car_plate", "left_anti")


def orphan_cameras(violations, cameras):
    """Camera ids that violations refer to but the camera table lacks, with their row counts."""
    referred = violations.select(
        F.explode(F.array("camera_id_start", "camera_id_end")).alias("camera_id")
    ).filter(F.col("camera_id").isNotNull())
    return (
        referred.groupBy("camera_id")
        .agg(F.count("*").alias("violation_count"))
        .join(cameras, "camera_id", "left_anti")
    )


def repeated_keys(rows, keys):
    """Keys that occur more than once, with the number of rows."""
    return (
        rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    )


def bounds(cameras):
    """Bounding box of the cameras and its centre, one row."""
    box = cameras.agg(
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )
    return box.withColumns(
        {
            "center_lat": midpoint(F.col("min_lat"), F.col("max_lat")),
            "center_lon": midpoint(F.col("min_lon"), F.col("max_lon")),
        }
    )
