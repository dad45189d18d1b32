"""The streaming queries: watermarks, detection, and start, wait and stop."""

from pyspark.sql import functions as F

from roadwatch.operators.detection import instant_violations
from roadwatch.operators.live import bin_statistics
from roadwatch.operators.pairing import chain_pairs, segment_pairs
from roadwatch.streaming.sinks import instant_sink, pair_sink

TOLERANCE = "30 minutes"

# State outside the heap, one RocksDB instance per partition of a join.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def prepare(spark):
    """Give the session the state settings that it has no value for."""
    for key, value in STATE_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def watermarked(sightings, tolerance=TOLERANCE):
    """Tolerate lateness of this much behind the latest sighting of the stream.

    Over several streams the slowest counts, so a silent camera holds back the
    unmatched rows of every query it takes part in. `start_segments` starts one query per segment.
    """
    return sightings.withWatermark("timestamp", tolerance)


def start(rows, sink, checkpoint, once=False, name=None, interval=None):
    """Start an append query with its own checkpoint; `once` stops it when the input is used up."""
    prepare(rows.sparkSession)
    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
    )
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def start_pairs(sightings, windows, store, checkpoint, tolerance=TOLERANCE, once=False,
                processed_at=None):
    """Average violations and the drop log, from cameras in road order."""
    pairs = chain_pairs([watermarked(frame, tolerance) for frame in sightings], windows)
    sink = pair_sink(f"{store}/average", f"{store}/dropped", processed_at)
    return start(pairs, sink, f"{checkpoint}/pairs", once, "pairs")


def start_segments(sightings, windows, store, checkpoint, tolerance=TOLERANCE, once=False,
                   processed_at=None):
    """As `start_pairs`, but one query per segment, each with a watermark of its own.

    A silent camera then holds back its own segments alone. The queries share the stores; each
    numbers its batches for itself.
    """
    queries = []
    for number, window in enumerate(windows):
        pairs = segment_pairs(*[watermarked(frame, tolerance) for frame in sightings[number : number + 2]], window)
        sink = pair_sink(f"{store}/average", f"{store}/dropped", processed_at, f"segment{number}")
        queries.append(start(pairs, sink, f"{checkpoint}/segment{number}", once, f"segment{number}"))
    return queries


def join_state(spark, checkpoint, operator=0):
    """The sightings that a pair query still holds, from its checkpoint: side, key and value.

    Spark's own reader of state stores, for a query that does not run at the moment.
    """
    prepare(spark)

    def side(name):
        rows = spark.read.format("statestore").option("operatorId", operator).option("joinSide", name).load(checkpoint)
        return rows.select(F.lit(name).alias("side"), "key", "value")

    return side("left"), side("right")


def start_instant(sightings, store, checkpoint, tolerance=TOLERANCE, once=False,
                  processed_at=None):
    """Instant violations. Stateless, so late sightings count too."""
    flagged = instant_violations(*[watermarked(frame, tolerance) for frame in sightings])
    sink = instant_sink(f"{store}/instant", processed_at)
    return start(flagged, sink, f"{checkpoint}/instant", once, "instant")


def live_stream(arrivals, tolerance=TOLERANCE, bin_seconds=300, quantile=0.9):
    """Statistics per bin as a stream; a bin comes out once the watermark has passed it."""
    return bin_statistics(
        arrivals.withWatermark("arrival_time", tolerance),
        bin_seconds=bin_seconds,
        quantile=quantile,
    )


def wait(spark, *queries):
    """Wait until one query ends, then stop the others; an error of any is raised at once."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def finish(*queries):
    """Wait for `once` queries to use up their input; returns their progress reports."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
    return [query.recentProgress for query in queries]


def late_rows(progress):
    """Sightings that arrived behind the watermark and were left out of a join, from progress reports.

    Exact per segment: each segment's join leaves a late sighting out once. A query keeps its last
    reports only (`spark.sql.streaming.numRecentProgressUpdates`); a long-running one is summed by a listener.
    """
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for report in progress
        for operator in report["stateOperators"]
    )
