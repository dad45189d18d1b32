"""Scans and loads of dimension, history and violation tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.functions.times import mixed_timestamp
from roadwatch.schemas import CAMERA, HISTORIC_RAW, VEHICLE_RAW, VIOLATION
from roadwatch.sources.batches import read_batches, write_batch


def read_cameras(spark, path):
    return spark.read.schema(CAMERA).csv(path, header=True)


def read_vehicles(spark, path):
    """Vehicle register with the registration date parsed; plates may repeat."""
    rows = spark.read.schema(VEHICLE_RAW).csv(path, header=True)
    return rows.withColumn("registration_date", mixed_timestamp("registration_date"))


def read_historic(spark, path):
    """Historic violations as text; `operators.records.historic_records` parses them."""
    return spark.read.schema(HISTORIC_RAW).csv(path, header=True)


def append_history(rows, root, load):
    """Append historic violations (`operators.records.historic_records`) to a violation store.

    A load that runs again replaces itself; loads and the batches of streams are numbered apart.
    """
    write_batch(rows, root, load, ["date"], writer="history")


def save_table(rows, path, partition_by=()):
    """Replace a table, for instance a dimension after its bulk load."""
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_violations(spark, *paths, start=None, end=None):
    """Violation rows from one or more stores, dates in [start, end).

    The stores are partitioned by date, so the range prunes whole folders.
    """
    stores = [read_batches(spark, path, VIOLATION) for path in paths]
    return in_date_range(reduce(DataFrame.unionByName, stores), start, end)


def in_date_range(violations, start=None, end=None):
    """Half-open range on the violation date; either bound may be absent."""
    if start is not None:
        violations = violations.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        violations = violations.filter(F.col("date") < F.lit(end).cast("date"))
    return violations
