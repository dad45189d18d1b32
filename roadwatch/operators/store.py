"""The violation store seen as a set: deduplication, daily documents, the drop log."""

from pyspark.sql import functions as F

from roadwatch.schemas import DROPPED_PAIR, VIOLATION, VIOLATION_KEY

DAY = ["car_plate", "date"]

# One embedded violation, the end time first so that entries sort by it.
ENTRY = [
    "timestamp_end",
    "type",
    "camera_id_start",
    "camera_id_end",
    "timestamp_start",
    "speed_reading",
    "origin",
]


def distinct_violations(violations):
    """One row per violation however often it was written; the first write time stays.

    Copies are combined before the shuffle, so a violation written many times is
    no heavier than one written once. A historic and a streamed copy stay apart.
    """
    return (
        violations.groupBy(*VIOLATION_KEY, "origin")
        .agg(F.min("updated_at").alias("updated_at"))
        .select(*VIOLATION.fieldNames())
    )


def daily_documents(violations, parts=1):
    """One document per car and day with its set of violations, whatever the size of the day.

    Columns: car_plate, date, part, violations (array of structs in time order),
    updated_at (latest write of any entry). A caller whose store cannot take long
    documents asks for `parts`: each document then comes as that many rows, entries dealt by
    content, `part` from 0; parts without entries are left out.
    """
    # Copies combine before the first shuffle, which leaves each entry once.
    entries = violations.groupBy(*DAY, *ENTRY).agg(
        F.min("updated_at").alias("first"), F.max("updated_at").alias("latest")
    )
    part = F.pmod(F.xxhash64(*ENTRY), F.lit(int(parts))).cast("int") if parts > 1 else F.lit(0)
    documents = entries.groupBy(*DAY, part.alias("part")).agg(
        F.sort_array(
            F.collect_list(F.struct(*ENTRY, F.col("first").alias("updated_at")))
        ).alias("violations"),
        F.max("latest").alias("updated_at"),
    )
    return documents.select(*DAY, "part", "violations", "updated_at")


def entries_of(documents, keep_empty=False):
    """One row per embedded violation; `keep_empty` keeps documents without any."""
    explode = F.explode_outer if keep_empty else F.explode
    return documents.select(
        "car_plate",
        "date",
        F.col("updated_at").alias("document_updated_at"),
        explode("violations").alias("entry"),
    ).select("car_plate", "date", "document_updated_at", "entry.*")


def latest_dropped(dropped):
    """The drop log: one row per event id, the last write wins."""
    rest = [name for name in DROPPED_PAIR.fieldNames() if name != "event_id"]
    newest = F.max(F.struct("ingested_at", *[c for c in rest if c != "ingested_at"]))
    return (
        dropped.groupBy("event_id")
        .agg(newest.alias("row"))
        .select("event_id", *[F.col(f"row.{name}").alias(name) for name in rest])
    )


def retained(dropped, as_of, keep="1 year"):
    """Drop-log rows still within the retention time, counted from ingestion."""
    return dropped.filter(F.col("ingested_at") >= as_of - F.expr(f"interval {keep}"))
