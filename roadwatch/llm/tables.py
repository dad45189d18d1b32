"""Helpers shared by the operators of this folder."""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadwatch.session import shared_folder

# A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(frame, name):
    """`frame` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read the files, and values
    that depend on task placement (positions, names) are fixed from here on.
    """
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def texts(documents, id_col="doc_id", text_col="text", **more):
    """Only the id, the text (NULL as empty) and the asked-for columns, under fixed names.

    Whatever other columns a table has, of whatever name, stays out of the way.
    """
    return documents.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[F.col(column).alias(name) for name, column in more.items()],
    )


def let(value, body):
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text):
    """Number of words of a text column that has no NULL."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def n_bytes(text):
    return F.octet_length(text).cast("long")


def sort_places(frame, order, name):
    """Sort a whole frame over all tasks and tell each row where it came to stand.

    Returns the stored frame with `part`, the range it fell in, and `place`, its place
    there from 0. Ranges follow each other in the order, so a running figure over the
    whole frame is one within the range plus one over the few ranges before it; no
    task ever sees more than a range. `order` should end in a unique column, so that
    a hot value spans several ranges.
    """
    ranges = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    spot = ranges.select("*", F.monotonically_increasing_id().alias("spot"))
    return stored(
        spot.select(
            *frame.columns,
            F.shiftrightunsigned("spot", 33).cast("int").alias("part"),
            F.col("spot").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        name,
    )


def positions(frame, order, name):
    """`frame` with `position`, gapless from 0 in the order, and `total`, the row count.

    The only data that is broadcast is one row per range: at most as many as there
    are shuffle partitions.
    """
    sorted_rows = sort_places(frame, order, name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sorted_rows.groupBy("part").agg(F.count("*").alias("n"))
    offsets = counts.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    return sorted_rows.join(F.broadcast(offsets), "part").select(
        *frame.columns, (F.col("offset") + F.col("place")).alias("position"), "total"
    )


def slices(batches, column, limit=4_000_000):
    """The Arrow batches in pieces of at most `limit` bytes of a text column, one row at least.

    Bounds what Python holds at a time, whatever the batch size.
    """
    for batch in batches:
        sizes = batch.column(column).nbytes if batch.num_rows else 0
        if sizes <= limit or batch.num_rows <= 1:
            if batch.num_rows:
                yield batch
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    _give_back()


def _give_back():
    """Return freed memory to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def shuffled(frame):
    """`frame`, to be joined by a shuffle of both sides whatever its size.

    For joins with whole texts: the plan is the same for small and large tables, and no
    growing table is ever broadcast.
    """
    return frame.hint("merge")
