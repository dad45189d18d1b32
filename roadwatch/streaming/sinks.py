"""Replay-safe sinks for `foreachBatch`.

Each micro-batch replaces the partitions that it wrote before
(`sources.batches`). A batch that runs again after a failure leaves the store as it was. Executors
write the rows; nothing passes through the driver. Errors are not swallowed: the batch
fails and the checkpoint replays it.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadwatch.functions.times import event_day
from roadwatch.operators.detection import average_violations
from roadwatch.operators.live import (
    BIN_SECONDS,
    bin_parts,
    changed_documents,
    high_water_mark,
    merged_statistics,
)
from roadwatch.operators.pairing import as_trips, matched, unmatched
from roadwatch.operators.records import average_records, dropped_records, instant_records
from roadwatch.operators.store import distinct_violations
from roadwatch.schemas import DROPPED_PAIR, VIOLATION
from roadwatch.sources.batches import (
    compact,
    drop_partitions,
    overwrite_partitions,
    read_batches,
    read_latest,
    read_partitions,
    write_batch,
    written_days,
)
from roadwatch.sources.tables import read_violations


def instant_sink(root, processed_at=None):
    """Instant violations into a violation store."""

    def write(violations, batch_id):
        write_batch(instant_records(violations, processed_at), root, batch_id, ["date"])

    return write


def average_sink(root, processed_at=None, writer="stream"):
    """Average violations into a violation store."""

    def write(violations, batch_id):
        write_batch(average_records(violations, processed_at), root, batch_id, ["date"], writer)

    return write


def dropped_sink(root, ingested_at=None, writer="stream"):
    """Unmatched pairs into the drop log, a folder per day of ingestion."""

    def write(pairs, batch_id):
        rows = dropped_records(pairs, ingested_at)
        rows = rows.withColumn("ingested_on", event_day(rows["ingested_at"]))
        write_batch(rows, root, batch_id, ["ingested_on"], writer)

    return write


def pair_sink(average_root, dropped_root, processed_at=None, writer="stream"):
    """Average violations and drop log from one pair stream, so that state is kept once.

    The batch is held while both writes run; otherwise the second would run the
    join again.
    """
    average = average_sink(average_root, processed_at, writer)
    dropped = dropped_sink(dropped_root, processed_at, writer)

    def write(pairs, batch_id):
        held = pairs.persist()
        try:
            average(average_violations(as_trips(matched(held))), batch_id)
            dropped(unmatched(held), batch_id)
        finally:
            held.unpersist()

    return write


def live_sink(stores, out, since, writer="stream", bin_seconds=BIN_SECONDS):
    """Refresh the live view's bins behind each batch of the stores, by the days that the batch wrote to.

    A day's bins are made anew from the day's rows and replace the former ones, so that a batch that
    runs again changes nothing and a violation that was written twice counts once; other days are not
    read. Which documents count is said by `since`, as in `changed_documents`. The mark, the latest
    write that the view has seen, moves on with each batch and is stored beside the bins. The days of
    a batch reach the driver: at most one value per day of the calendar.
    """

    def write(batch, batch_id):
        spark = batch.sparkSession
        rows = read_violations(spark, *stores)
        days = written_days(spark, stores, VIOLATION, f"{writer}-{int(batch_id)}")
        known = [day for day in days if day is not None]
        concerned = F.col("date").isin(known) if known else F.lit(False)
        if None in days:
            concerned |= F.col("date").isNull()
        changed = changed_documents(rows.filter(concerned), since)
        parts = bin_parts(distinct_violations(changed), bin_seconds)
        overwrite_partitions(parts, f"{out}/bins", ["date"])
        before = F.coalesce(*[F.lit(row.next_since) for row in live_mark(spark, out, batch_id).collect()], since)
        write_batch(high_water_mark(changed, before), f"{out}/marks", batch_id, writer=writer)

    return write


_MARK = T.StructType([T.StructField(name, T.TimestampType()) for name in ("since", "next_since")])


def live_mark(spark, out, before=None):
    """The mark of the last refresh (or of the last before a batch): `since` and `next_since`, at most one row."""
    return read_latest(spark, f"{out}/marks", _MARK, before=before)


def live_view(spark, out, horizon_seconds=3600, bin_seconds=BIN_SECONDS, quantile=0.9):
    """The live statistics as the last refresh left them, from the stored bins alone."""
    parts = read_partitions(spark, f"{out}/bins", _PARTS)
    return merged_statistics(parts, horizon_seconds, bin_seconds, quantile)


_PARTS = (
    "camera_id int, type string, arrival_time timestamp, total bigint, n_speeds bigint, speed_sum double, "
    "speeds binary, date date"
)


def in_turn(*parts):
    """One sink of several: each batch goes through all of them in order."""

    def write(batch, batch_id):
        held = batch.persist()
        try:
            for part in parts:
                part(held, batch_id)
        finally:
            held.unpersist()

    return write


_LOGGED = T.StructType([*DROPPED_PAIR.fields, T.StructField("ingested_on", T.DateType())])


def read_dropped(spark, root, ingested_from=None):
    """Raw drop-log rows; `operators.store.latest_dropped` reduces them to one per event.

    `ingested_from` is a day; folders of earlier days are not read.
    """
    rows = read_batches(spark, root, _LOGGED)
    if ingested_from is not None:
        rows = rows.filter(F.col("ingested_on") >= F.lit(ingested_from).cast("date"))
    return rows.select(*DROPPED_PAIR.fieldNames())


def expire_dropped(spark, root, as_of, keep="1 year"):
    """Delete the drop log's days of ingestion that lie before `as_of` by more than `keep`.

    Whole folders go; no row is read and no other folder is touched. The day on which the retention
    time ends stays, `operators.store.retained` filters it. Returns the number of days.
    """
    first = spark.range(1).select((F.lit(as_of).cast("timestamp") - F.expr(f"interval {keep}")).cast("date")).first()[0]
    return drop_partitions(spark, root, "ingested_on", first)


def compact_violations(spark, root):
    """Rewrite a violation store without copies, in few large files sorted by plate within each day."""
    compact(spark, root, VIOLATION, distinct_violations, ["date", "car_plate", "timestamp_end"])
