"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of SPAN bytes that covers it also starts anywhere else in the table.
Sorting all suffixes of a table is out of reach; but equal strings have the same anchor gram at
the same distance, so only starts whose anchor occurs elsewhere can matter. Such starts
come, with the bytes after them, to the task of their anchor. There the suffixes are sorted in two
stages, and common prefixes of neighbours in the order tell which strings occur again.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.llm.anchors import SPAN, anchors
from roadwatch.llm.line_chunks import row_keys
from roadwatch.llm.shingles import mix
from roadwatch.llm.suffix_sort import END, shared_spans, sort_suffixes
from roadwatch.llm.tables import n_bytes, shuffled, slices, stored, texts

# Anchors in more texts than this are settled by aggregates over starts instead of in one task.
CROWDED = 2_000
# Suffixes that are sorted together, but for the groups of single anchors.
TOGETHER = 200_000
# Stretches that a task remembers to have sent.
REMEMBERED = 200_000

KEYS = ["key_1", "key_2"]


def _bytes_of(batch):
    parts = batch.column("text").cast(pa.large_binary()).to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    return b"".join(parts), bounds


def _keys_of(batch):
    return [batch.column(name).to_numpy() for name in KEYS]


def _owners(key_1, key_2, place):
    """One number for a place in a text."""
    with np.errstate(over="ignore"):
        return mix(key_1.view(np.uint64) ^ mix(key_2.view(np.uint64) + mix(place.astype(np.uint64)))).view(np.int64)


def _list_anchors(batches):
    """Each text's distinct anchor grams, with one of its places and whether there are more."""
    for batch in slices(batches, "text", 2_000_000):
        raw, bounds = _bytes_of(batch)
        text, place, _, _, gram = anchors(np.frombuffer(raw, np.uint8), bounds)
        if not len(text):
            continue
        # The place changes from run to run; a gram in two runs of a text is one at two places.
        order = np.lexsort((place, gram, text))
        text, place, gram = text[order], place[order], gram[order]
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])])
        at = np.flatnonzero(new)
        ends = np.concatenate([at[1:], [len(text)]]) - 1
        key_1, key_2 = _keys_of(batch)
        owner = _owners(key_1[text[at]], key_2[text[at]], place[at] - bounds[text[at]])
        columns = [gram[at].view(np.int64), key_1[text[at]], owner, place[at] != place[ends]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["gram", "key_1", "owner", "again"])


def _stretches(crowded):
    """Rows of starts that share an anchor which occurs elsewhere, with their bytes and SPAN more.

    A stretch that the task has sent before comes without bytes. With `crowded`, only those of
    crowded anchors, without bytes; otherwise only the others.
    """

    def run(batches):
        sent = set()
        for batch in slices(batches, "text", 2_000_000):
            raw, bounds = _bytes_of(batch)
            text, _, first, last, gram = anchors(np.frombuffer(raw, np.uint8), bounds)
            gram = gram.view(np.int64)
            wanted = np.zeros(len(text), bool)
            lists = batch.column("crowded_grams" if crowded else "grams").to_pylist()
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
            for row, grams in enumerate(lists):
                if grams:
                    here = slice(cuts[row], cuts[row + 1])
                    wanted[here] = np.isin(gram[here], np.array(grams, np.int64))
            key_1, key_2 = _keys_of(batch)
            # A stretch that a text repeats, as periodic texts do, is one row with all its places.
            rows, places, sizes = {}, [], []
            for t, a, b, g in zip(*(x[wanted].tolist() for x in (text, first, last, gram)), strict=True):
                piece = raw[a : b + SPAN]
                digest = hashlib.blake2b(piece, digest_size=16).digest()
                row = rows.get((t, digest))
                if row is None:
                    row = rows[t, digest] = (g, None if crowded or digest in sent else piece, len(places))
                    places.append([])
                    sizes.append(b - a + 1)
                places[row[2]].append(int(a - bounds[t]))
                if len(sent) > REMEMBERED:
                    sent.clear()
                sent.add(digest)
            here = np.array([t for t, _ in rows], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([g for g, _, _ in rows.values()], pa.int64()),
                    pa.array([digest for _, digest in rows], pa.binary()),
                    pa.array([piece for _, piece, _ in rows.values()], pa.binary()),
                    pa.array(key_1[here]),
                    pa.array(key_2[here]),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(sizes, pa.int32()),
                ],
                names=["gram", "digest", "piece", *KEYS, "places", "starts"],
            )

    return run


def _repeated_in(pieces, several):
    """For distinct stretches, per stretch the bool array of starts whose SPAN bytes occur again.

    `several` tells stretches that stand in more than one place: all their starts do.
    """
    raw = END.join([*pieces, b""])
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    counts = sizes - SPAN + 1
    offsets = np.cumsum(counts) - counts
    wanted = np.arange(counts.sum()) + np.repeat(begins - offsets, counts)
    order = sort_suffixes(raw, wanted)
    found = np.zeros(len(raw), bool)
    found[order[shared_spans(raw, order)]] = True
    flags = found[wanted] | np.repeat(np.array(several, bool), counts)
    return [flags[a : a + n] for a, n in zip(offsets.tolist(), counts.tolist(), strict=True)]


def _runs(flags):
    """(begin, end) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def _ranges(rows):
    """Ranges of starts whose strings occur again, for rows of whole anchor groups."""
    digests, pieces, owners = {}, [], []
    numbers = []
    for digest, piece, key_1, key_2, places in rows:
        number = digests.setdefault(digest, len(digests))
        if number == len(pieces):
            pieces.append(None)
            owners.append(None)
        if pieces[number] is None:
            pieces[number] = piece
        place = (key_1, key_2)
        once = len(places) == 1 and owners[number] in (None, place)
        owners[number] = place if once else False
        numbers.append(number)
    flags = _repeated_in(pieces, [owner is False for owner in owners])
    runs = [_runs(f).tolist() for f in flags]
    for (_, _, key_1, key_2, places), number in zip(rows, numbers, strict=True):
        for first in places:
            for begin, end in runs[number]:
                yield key_1, key_2, first + begin, first + end


def _sort_groups(batches):
    """Ranges of repeated starts from stretches that arrive sorted by anchor."""
    names = ["digest", "piece", *KEYS, "places"]
    held, size, last = [], 0, None

    def out():
        found = list(_ranges(held))
        columns = list(zip(*found, strict=True)) if found else [(), (), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*KEYS, "begin", "end"]
        )

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in names]
        for gram, starts, *row in zip(
            batch.column("gram").to_pylist(), batch.column("starts").to_pylist(), *columns, strict=True
        ):
            if gram != last and size >= TOGETHER:
                yield out()
                held, size = [], 0
            last = gram
            held.append(row)
            size += starts if row[1] is not None else 0
    if held:
        yield out()


def _each_start(batches):
    """A row per start of crowded stretches: the digest of its SPAN bytes and its place."""
    for batch in slices(batches, "text", 2_000_000):
        raw, bounds = _bytes_of(batch)
        rows, places, digests = [], [], []
        for row, ranges in enumerate(batch.column("alone").to_pylist()):
            for piece in ranges:
                for start in range(piece["first"], piece["first"] + piece["starts"]):
                    at = bounds[row] + start
                    rows.append(row)
                    places.append(start)
                    digests.append(hashlib.sha256(raw[at : at + SPAN]).digest())
        key_1, key_2 = _keys_of(batch)
        rows = np.array(rows, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(key_1[rows]), pa.array(key_2[rows]), pa.array(places, pa.int32())],
            names=["span", *KEYS, "begin"],
        )


def _crowded_ranges(flagged):
    """Ranges for crowded anchors: equal stretches are counted, and of those that stand alone the single starts.

    All counting combines before the shuffle, so that no task holds a crowded anchor.
    """
    layout = "gram long, digest binary, piece binary, key_1 long, key_2 long, places array<int>, starts int"
    rows = flagged.mapInArrow(_stretches(True), layout).drop("piece").withColumn("first", F.explode("places"))
    rows = stored(rows.drop("places"), "crowded")
    owner = F.xxhash64(*KEYS, "first")
    counted = rows.groupBy("gram", "digest").agg(F.min(owner).alias("least"), F.max(owner).alias("most"))
    counted = stored(counted.select("gram", "digest", (F.col("least") != F.col("most")).alias("several")), "crowded-counts")
    known = stored(rows.join(counted, ["gram", "digest"]), "crowded-known")
    end = F.col("first") + F.col("starts")
    whole = known.filter("several").select(*KEYS, F.col("first").alias("begin"), end.alias("end"))
    alone = known.filter("NOT several").groupBy(*KEYS).agg(F.collect_set(F.struct("first", "starts")).alias("alone"))
    layout = "span binary, key_1 long, key_2 long, begin int"
    starts = stored(flagged.select(*KEYS, "text").join(alone, KEYS).mapInArrow(_each_start, layout), "crowded-starts")
    # Such a start may also be equal to one inside a stretch that stands in several places.
    one = known.filter("several").groupBy("gram", "digest").agg(F.min(F.struct(*KEYS, "first", "starts")).alias("one"))
    others = one.select("one.*").groupBy(*KEYS).agg(F.collect_set(F.struct("first", "starts")).alias("alone"))
    inside = flagged.select(*KEYS, "text").join(others, KEYS).mapInArrow(_each_start, layout)
    owner = F.xxhash64(*KEYS, "begin")
    counts = starts.unionByName(inside).groupBy("span").agg(F.min(owner).alias("least"), F.max(owner).alias("most"))
    again = stored(counts.filter("least <> most").select("span"), "crowded-spans")
    single = starts.join(again, "span", "left_semi").select(*KEYS, "begin", (F.col("begin") + 1).alias("end"))
    return whole.union(single)


def _covered(ranges, size):
    """Byte runs covered by SPAN bytes from each start of the ranges."""
    runs = []
    for begin, end in sorted((r["begin"], r["end"]) for r in ranges):
        end = min(size, end - 1 + SPAN)
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return runs


def _cut_out(batches):
    for batch in slices(batches, "text"):
        removed, kept, digests = [], [], []
        raw = batch.column("text").cast(pa.large_binary()).to_pylist()
        for text, ranges in zip(raw, batch.column("ranges").to_pylist(), strict=True):
            runs = _covered(ranges, len(text))
            edges = [0, *[e for run in runs for e in run], len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            removed.append([{"begin": a, "end": b} for a, b in runs])
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in KEYS], pa.array(removed, span), pa.array(digests), pa.array(kept, pa.binary())],
            names=[*KEYS, "removed", "kept_sha256", "kept"],
        )


def _flagged_texts(keyed, crowded):
    """Texts with an anchor that occurs elsewhere, once each, and these anchors; and whether any is crowded."""
    long = keyed.filter(n_bytes(F.col("text")) >= SPAN)
    listed = stored(long.mapInArrow(_list_anchors, "gram long, key_1 long, owner long, again boolean"), "anchors")
    counted = listed.groupBy("gram").agg(
        F.min("owner").alias("least"), F.max("owner").alias("most"), F.max("again").alias("again"), F.count("*").alias("n")
    )
    repeated = stored(
        counted.filter("again OR least <> most").select("gram", (F.col("n") > crowded).alias("crowded")), "repeated-anchors"
    )
    per_text = (
        listed.select("gram", "key_1")
        .join(repeated, "gram")
        .groupBy("key_1")
        .agg(
            F.collect_set(F.when(~F.col("crowded"), F.col("gram"))).alias("grams"),
            F.collect_set(F.when(F.col("crowded"), F.col("gram"))).alias("crowded_grams"),
        )
    )
    per_text = per_text.withColumnRenamed("key_1", "of_key_1")
    # One row stands for a text: the one of least id, or without any.
    least = long.groupBy(F.col("key_1").alias("one_key_1"), F.col("key_2").alias("one_key_2"))
    one = least.agg(F.min("doc_id").alias("one_id")).join(per_text, F.col("one_key_1") == F.col("of_key_1"))
    same = (F.col("key_1") == F.col("one_key_1")) & (F.col("key_2") == F.col("one_key_2"))
    found = long.join(shuffled(stored(one, "flagged-ones")), same & F.col("doc_id").eqNullSafe(F.col("one_id")))
    flagged = stored(found.select(*KEYS, "text", "grams", "crowded_grams"), "flagged-texts")
    return flagged, not repeated.filter("crowded").isEmpty()


def repeated_strings(rows, crowded=CROWDED):
    """Per text with something to remove: key_1, key_2, `removed` (byte ranges), `kept` (bytes) and its sha256.

    `rows` has doc_id and text. Texts that stand in several rows are not compared with their own copies here.
    """
    keyed = rows.select("doc_id", *row_keys(F.col("text")), "text")
    flagged, any_crowded = _flagged_texts(keyed, crowded)
    layout = "gram long, digest binary, piece binary, key_1 long, key_2 long, places array<int>, starts int"
    stretches = flagged.mapInArrow(_stretches(False), layout)
    placed = stretches.repartition("gram").sortWithinPartitions("gram", "digest")
    ranges = placed.mapInArrow(_sort_groups, "key_1 long, key_2 long, begin int, end int")
    if any_crowded:
        ranges = ranges.union(_crowded_ranges(flagged))
    per_text = stored(ranges, "repeated-starts").groupBy(*KEYS).agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    # Repeated rows of one text are equal, so one of them is enough.
    cut = flagged.select(*KEYS, "text").join(shuffled(stored(per_text, "ranges")), KEYS).mapInArrow(
        _cut_out,
        "key_1 long, key_2 long, removed array<struct<begin:int,end:int>>, kept_sha256 string, kept binary",
    )
    return cut


def byte_report(documents, id_col="doc_id", text_col="text", crowded=CROWDED):
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes; NULL counts as empty and has nothing to remove. A text of at least SPAN bytes that
    stands in several rows is removed whole, and so are repeated rows of one id; NULL ids are
    documents like others. An empty table gives no rows.
    """
    rows = texts(documents, id_col, text_col)
    text = F.col("text")
    figures = rows.select("doc_id", *row_keys(text), n_bytes(text).alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    digest = stored(figures, "bytes")
    copies = stored(digest.groupBy(*KEYS).agg(F.count("*").alias("copies")), "copies")
    length = F.aggregate("removed", F.lit(0), lambda total, r: total + r["end"] - r["begin"])
    cut = repeated_strings(rows, crowded).select(
        *KEYS, length.cast("long").alias("lost"), F.size("removed").cast("long").alias("spans"), "kept_sha256"
    )
    joined = digest.join(copies, KEYS).join(stored(cut.dropDuplicates(KEYS), "cut"), KEYS, "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= SPAN)
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("lost", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
