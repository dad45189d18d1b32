"""Stores of batches: plain Parquet, partitioned by the caller's columns and then by batch.

A batch is written by Spark's dynamic partition overwrite, so that one that runs again replaces what it
wrote before and touches no other. Readers see a table like any other and prune it by partition.
Copies that a changed or compacted batch may leave behind are the readers' to combine
(`operators.store`), as with any source that delivers at least once.
"""

import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadwatch.session import delete_folders

BATCH = "batch"


def write_batch(rows, root, batch_id, partition_by=(), writer="stream"):
    """Write one batch of a writer; a day's rows go to few files, a busy day's to several.

    Batch ids belong to their writer, so that a backfill and a stream never replace each other's.
    """
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    _overwrite(rows, root, f"{writer}-{int(batch_id)}", partition_by)


def _overwrite(rows, root, batch, partition_by):
    overwrite_partitions(rows.withColumn(BATCH, F.lit(batch)), root, [*partition_by, BATCH])


def overwrite_partitions(rows, root, partition_by):
    """Replace the partitions that the rows belong to; all others stay as they are."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(root)


def read_partitions(spark, root, schema):
    """Rows of a partitioned table; none for one that was never written."""
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _read(spark, root, schema):
    """Rows with their batch."""
    return read_partitions(spark, root, T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))


def written_days(spark, roots, schema, batch):
    """The days that a batch, given by writer and number, has rows of in any of the stores."""
    own = [_read(spark, root, schema).filter(F.col(BATCH) == batch).select("date") for root in roots]
    return [row.date for row in reduce(DataFrame.union, own).distinct().collect()]


def read_batches(spark, root, schema):
    """Rows of all batches; no rows for an empty store."""
    return _read(spark, root, schema).drop(BATCH)


def read_latest(spark, root, schema, writer="stream", before=None):
    """Rows of the writer's batch with the highest id (below `before`), for stores whose batches replace each other.

    The ids are partition values: the first pass reads no data, the second one batch.
    """
    rows = _read(spark, root, schema)
    number = F.regexp_extract(BATCH, f"^{writer}-([0-9]+)$", 1)
    earlier = F.lit(True) if before is None else number.try_cast("long") < F.lit(int(before))
    latest = rows.filter((number != "") & earlier).agg(F.max(number.try_cast("long"))).first()[0]
    return rows.filter(F.col(BATCH) == F.lit(f"{writer}-{latest}")).drop(BATCH)


def compact(spark, root, schema, reduced, order, partition_by=("date",)):
    """Rewrite the rows that are there now, as `reduced` makes them, in few files in the given order.

    The range partitioning samples the data, so a busy day or plate spreads over several files. The
    folders that were read are deleted when the new ones are complete; for quiet times, since a
    reader that has listed them before may miss them. Until then, and if the job dies in between, both are
    there, and batches that come in meanwhile stay.
    """
    rows = _read(spark, root, schema)
    read = {file.rsplit("/", 1)[0] for file in rows.inputFiles()}
    ordered = reduced(rows.drop(BATCH)).repartitionByRange(*order).sortWithinPartitions(*order)
    _overwrite(ordered, root, f"compacted-{time.time_ns()}", partition_by)
    delete_folders(spark, read)


def drop_partitions(spark, root, column, before):
    """Delete all folders of a store's first partition column whose value is below `before`.

    Nothing else is read or written. Values compare as text, as ISO dates do; rows without a value stay.
    """
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{column}=*")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = folders.getFileSystem(conf).globStatus(folders) or []
    paths = [status.getPath() for status in found]
    old = [p for p in paths if p.getName().split("=", 1)[1] < str(before) and "HIVE_DEFAULT" not in p.getName()]
    delete_folders(spark, [p.toString() for p in old])
    return len(old)
