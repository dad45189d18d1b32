"""Line deduplication by content-defined chunks of lines.

Lines are hashed, and a rolling hash runs over the line hashes of the shortest windows that count
as a passage: two lines with words and eight words. Boundaries of chunks are where that hash
begins or ceases to be one that the table holds elsewhere, so a passage is cut in the same way
after whatever lines it stands, however short it is. Chunks that occur before are
removed, after the bytes of their windows have been compared.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from roadwatch.llm.tables import let, shuffled, slices, stored, texts

# Windows have at least so many lines that hold a word, and so many words.
MIN_LINES = 2
MIN_WORDS = 8
# A line counts as one word for so many bytes, if that is more: some languages put no spaces.
BYTES_PER_WORD = 12
# Odd bases of the two rolling hashes, modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
# Rows of windows that a task hands over at a time.
WINDOWS_AT_ONCE = 65_536

KEYS = ["doc_id", "key_1", "key_2"]


def row_keys(text):
    """128 bits that tell the texts of rows with one id apart."""
    return [F.xxhash64(text).alias("key_1"), F.xxhash64(F.lit(1), text).alias("key_2")]


def line_hashes(lines):
    return np.fromiter((xxhash.xxh64_intdigest(line) for line in lines), np.uint64, len(lines))


def windows(sizes, least_lines=MIN_LINES, least_words=MIN_WORDS):
    """(first line, end line) of the shortest windows from each line and up to each line, given the lines' words.

    Any run of lines that holds enough lines and words is covered by the windows inside it.
    """
    lines = np.flatnonzero(sizes)
    before = np.concatenate([[0], np.cumsum(sizes[lines])])
    place = np.arange(len(lines))
    last = np.maximum(place + least_lines - 1, np.searchsorted(before, before[:-1] + least_words) - 1)
    first = np.minimum(place - least_lines + 1, np.searchsorted(before, before[1:] - least_words, side="right") - 1)
    on, back = last < len(lines), first >= 0
    found = np.stack([np.concatenate([place[on], first[back]]), np.concatenate([last[on], place[back]])], axis=1)
    found = np.unique(found, axis=0)
    return lines[found[:, 0]], lines[found[:, 1]] + 1


def rolled(hashes, starts, ends):
    """The rolling hashes of windows: 16 bytes each, the same wherever the lines stand."""
    sides = []
    for base in BASES:
        powers = np.full(len(hashes) + 1, base, np.uint64)
        back = np.full(len(hashes) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[0] = back[0] = 1
        powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1], dtype=np.uint64)])
        sides.append((sums[ends] - sums[starts]) * back[starts])
    return np.stack(sides, axis=1).astype("<u8").tobytes()


def chunks(text):
    """First lines, end lines and joined 16-byte hashes of a text's windows."""
    lines = text.split(b"\n")
    sizes = np.fromiter((max(n, len(line) // BYTES_PER_WORD) if (n := len(line.split())) else 0 for line in lines), np.int64, len(lines))
    starts, ends = windows(sizes)
    return starts, ends, rolled(line_hashes(lines), starts, ends)


def _bytes(batch, column):
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def _list_chunks(batches):
    """A row per window: its lines and hash, without its text."""
    for batch in slices(batches, "text"):
        rows, starts, ends, hashes = [], [], [], []
        for row, text in enumerate(_bytes(batch, "text")):
            first, end, hashed = chunks(text)
            rows.append(np.full(len(first), row))
            starts.append(first)
            ends.append(end)
            hashes.append(hashed)
        rows, starts, ends = (np.concatenate(part).astype(np.int64) for part in (rows, starts, ends))
        digests = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(b"".join(hashes))])
        # Pieces of bounded size: a text may have far more lines than a batch has rows.
        for at in range(0, len(rows), WINDOWS_AT_ONCE):
            part = slice(at, at + WINDOWS_AT_ONCE)
            keys = [batch.column(name).take(pa.array(rows[part])) for name in KEYS]
            found = [pa.array(starts[part], pa.int32()), pa.array(ends[part], pa.int32()), digests[part].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*keys, *found], names=[*KEYS, "start", "end", "digest"])


def _merge_windows(batches):
    """Overlapping and adjoining windows of a row as chunks, in order."""
    for batch in batches:
        merged = []
        for found in batch.column("ranges").to_pylist():
            starts, ends = (np.array([r[side] for r in found]) for side in ("start", "end"))
            order = np.argsort(starts, kind="stable")
            starts, reach = starts[order], np.maximum.accumulate(ends[order])
            apart = np.flatnonzero(starts[1:] > reach[:-1])
            begins, stops = starts[np.r_[0, apart + 1]], reach[np.r_[apart, len(reach) - 1]]
            merged.append([{"start": s, "end": e} for s, e in zip(begins.tolist(), stops.tolist(), strict=True)])
        ranges = pa.array(merged, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in KEYS], ranges], names=[*KEYS, "ranges"])


def _keyed(rows):
    return rows.select("doc_id", *row_keys(F.col("text")), "text")


def _same_row():
    """Rows of one id and one text; NULL ids are equal."""
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id"))
    return same & (F.col("key_1") == F.col("of_key_1")) & (F.col("key_2") == F.col("of_key_2"))


def _aside(frame):
    """Key columns renamed, to stand on the other side of a join."""
    return frame.withColumnsRenamed({name: f"of_{name}" for name in KEYS})


def _pieces(rows, occurrences):
    """The bytes of chunks: KEYS, start, digest, piece."""
    per_row = occurrences.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "end", "digest")).alias("chunks"))

    def cut(lines):
        return F.transform(
            "chunks",
            lambda c: F.struct(
                c["start"].alias("start"),
                c["digest"].alias("digest"),
                F.array_join(F.slice(lines, c["start"] + 1, c["end"] - c["start"]), "\n").alias("piece"),
            ),
        )

    return (
        _keyed(rows)
        .join(shuffled(_aside(per_row)), _same_row())
        .select(*KEYS, F.explode(let(F.split("text", "\n"), cut)).alias("cut"))
        .select(*KEYS, "cut.*")
    )


def later_occurrences(rows, listed):
    """Chunks (KEYS, start, end) that are not the first of their bytes, of all that `listed` has with a digest."""
    repeated = stored(
        listed.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "repeated-chunks"
    )
    occurrences = stored(listed.join(repeated, "digest", "left_semi"), "occurrences")
    # Equal bytes are merged before the shuffle; grouping by the bytes is the comparison.
    first = F.min(F.struct(*KEYS, "start")).alias("first")
    classes = stored(_pieces(rows, occurrences).groupBy("digest", "piece").agg(first), "chunk-classes")
    by_digest = classes.groupBy("digest").agg(F.min("first").alias("first"), F.count("*").alias("n"))
    by_digest = stored(by_digest, "chunk-digests")
    later = ~F.struct(*KEYS, "start").eqNullSafe(F.col("first"))
    clear = by_digest.filter("n = 1").select("digest", "first")
    removed = occurrences.join(clear, "digest").filter(later).select(*KEYS, "start", "end")
    clashing = by_digest.filter("n > 1").select("digest")
    if not clashing.isEmpty():
        # Different chunks of one hash: their places find their class by bytes.
        of_clash = occurrences.join(clashing, "digest", "left_semi")
        found = _pieces(rows, of_clash).join(classes, ["digest", "piece"]).filter(later)
        places = found.select(*[F.col(c).alias(f"of_{c}") for c in KEYS], F.col("start").alias("of_start"))
        at_place = _same_row() & (F.col("start") == F.col("of_start"))
        removed = removed.union(of_clash.join(places, at_place, "left_semi").select(*KEYS, "start", "end"))
    return removed


def repeated_ranges(rows):
    """Lines to remove per row: doc_id, key_1, key_2 and `ranges`, an ordered array of (start, end).

    `rows` has doc_id and text.
    """
    id_type = rows.schema["doc_id"].dataType.simpleString()
    layout = f"doc_id {id_type}, key_1 long, key_2 long, start int, end int, digest binary"
    listed = stored(_keyed(rows).mapInArrow(_list_chunks, layout), "chunks")
    found = later_occurrences(rows, listed).groupBy(*KEYS).agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    merged = f"doc_id {id_type}, key_1 long, key_2 long, ranges array<struct<start:int,end:int>>"
    return found.mapInArrow(_merge_windows, merged)


def _kept_lines(lines, ranges):
    """Lines outside the ranges, which are in order and do not overlap."""

    def between(k):
        after = F.coalesce(F.get(ranges, k - 1)["end"], F.lit(0))
        until = F.coalesce(F.get(ranges, k)["start"], F.size(lines))
        return F.slice(lines, after + 1, until - after)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(ranges)), between))


def without_repeated_chunks(documents, id_col="doc_id", text_col="text"):
    """`documents` with its own columns, repeated chunks taken out of the text, and `n_lines`, `n_removed`.

    A line goes if it lies in a run of lines that also stands earlier in the table. The run begins and
    ends with lines that hold words, has two of them at least, and eight words (or 12 bytes for each missing one). Earlier is the smaller id,
    NULL first, and in one document the smaller line; a line's first place always stays. The rule
    looks at the input, not at what is left. Texts without a
    removed line come back unchanged, NULL included; a text that loses all lines is empty. A
    repeated row (same id and text) is the same document and keeps what the other keeps. NULL and
    empty texts have no lines. Very long texts are handled whole: a task holds one and its windows'
    hashes. Columns named n_lines or n_removed are replaced. An empty table gives no rows.
    """
    rows = texts(documents, id_col, text_col)
    ranges = stored(repeated_ranges(rows), "ranges")
    own = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = documents.select(F.struct(*own).alias("own"), F.col(id_col).alias("doc_id"), *row_keys(text))
    joined = keyed.join(shuffled(_aside(ranges)), _same_row(), "left")
    old = F.col("own").getField(text_col)
    lost = F.aggregate("ranges", F.lit(0), lambda total, r: total + r["end"] - r["start"])
    shortened = let(F.split(old, "\n"), lambda lines: F.array_join(_kept_lines(lines, F.col("ranges")), "\n"))
    new = F.when(F.col("ranges").isNull(), old).otherwise(shortened)
    empty = F.length(F.coalesce(old, F.lit(""))) == 0
    n_lines = F.when(empty, 0).otherwise(F.size(F.split(old, "\n")))
    return joined.select(
        *[new.alias(c) if c == text_col else F.col("own").getField(c).alias(c) for c in own],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_removed"),
    )


def line_report(documents, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_lines, n_removed, kept_sha256."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return without_repeated_chunks(rows).select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))
