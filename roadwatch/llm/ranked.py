"""Ranked lexical search: an item's documents are grouped by which of its terms they hold.

Documents are indexed once per block of items, in segments: the documents of a few megabytes
of text, with a posting list for each term that an item of the block has. A second pass over the
segments ranks. For each item the bitmaps of its terms, one bit per document, are turned
into one presence mask per document; documents of equal masks form a group. The largest score that a
group can reach follows from its mask, its shortest document and the segment's highest term counts.
Groups are scored from the largest such bound on, until it falls below the item's last place.
"""

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadwatch.llm.tables import slices, stored, texts

# Bytes of item terms that one pass over the documents takes.
BLOCK_BYTES = 4_000_000
# A segment ends with this many documents or postings.
SEGMENT_DOCS, SEGMENT_POSTINGS = 4096, 1_000_000
# Entries of the table of terms by documents that is worked on at a time.
TABLE = 4_000_000
# Bytes of a text that are split at a time.
PIECE = 1 << 20
# First choices of different tasks are merged in so many groups, then per item.
MERGES = 64

# Fixed values of the term pattern: digits, ASCII letters (A-Z as a-z) and the bytes of other characters.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(text):
    """Terms of a text's UTF-8 bytes with their numbers; a long text is split piece by piece."""
    plain = text.translate(_LETTERS)
    counts, begin = Counter(), 0
    while begin < len(plain):
        end = plain.find(b" ", begin + PIECE)
        end = len(plain) if end < 0 else end
        counts.update(plain[begin:end].split())
        begin = end
    return counts


def _numbered_items(items, id_col, text_col):
    """Stored items with numbers of their own, in parcels of at most BLOCK_BYTES (or of one item)."""
    rows = texts(items, id_col, text_col)

    def run(batches):
        part, number, parcel, size = TaskContext.get().partitionId() << 33, 0, 0, 0
        for batch in batches:
            found = [term_counts(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            costs, parcels = [], []
            for counts in found:
                cost = sum(map(len, counts)) + 8 * len(counts)
                if size and size + cost > BLOCK_BYTES:
                    parcel, size = parcel + 1, 0
                size += cost
                costs.append(cost)
                parcels.append(part + parcel)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(range(part + number, part + number + len(found)), pa.int64()),
                    pa.array(parcels, pa.int64()),
                    pa.array(costs, pa.int64()),
                    pa.array([list(counts) for counts in found], pa.list_(pa.binary())),
                    pa.array([list(counts.values()) for counts in found], pa.list_(pa.int64())),
                ],
                names=["item_id", "item", "parcel", "cost", "terms", "times"],
            )
            number += len(found)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"item_id {kind}, item long, parcel long, cost long, terms array<binary>, times array<long>"
    return stored(rows.mapInArrow(run, schema), "items")


def _passes(items):
    """Lists of parcels that together keep to BLOCK_BYTES; one list is one pass over the documents.

    Only the parcels' sizes reach the driver: at most one small parcel per task and the full ones.
    """
    sizes = items.groupBy("parcel").agg(F.sum("cost").alias("cost")).orderBy("parcel").collect()
    packed, size = [], 0
    for parcel, cost in sizes:
        if not packed or size + cost > BLOCK_BYTES:
            packed.append([])
            size = 0
        packed[-1].append(parcel)
        size += cost
    return packed


def _segments(documents, vocabulary):
    """Stored segments: ids and lengths of documents, and the posting list of each term they hold.

    Documents without any term of the vocabulary only count.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_ids", "ns", "n_docs", "n_terms", "terms", "dfs", "places", "tfs"]

    def build(id_type, ids, ns, held, n_docs, n_terms):
        terms = np.concatenate([np.array([], np.int64), *(t for t, _ in held)])
        tfs = np.concatenate([np.array([], np.int64), *(n for _, n in held)])
        places = np.repeat(np.arange(len(held)), [len(t) for t, _ in held])
        order = np.argsort(terms, kind="stable")
        terms, dfs = np.unique(terms, return_counts=True)
        values = [
            [ids], [ns], [n_docs], [n_terms], [terms], [dfs],
            [places[order].astype("<u2").tobytes()], [tfs[order].astype("<u4").tobytes()],
        ]
        kinds = [pa.list_(id_type), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        kinds += [pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    def run(batches):
        ids, ns, held, n_docs, n_terms, postings = [], [], [], 0, 0, 0
        for batch in slices(batches, "text"):
            id_type = batch.column("doc_id").type
            found = zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True)
            for doc_id, text in found:
                counts = term_counts(text)
                n = sum(counts.values())
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                known = [(number, tf) for term, tf in counts.items() if (number := vocabulary.get(term)) is not None]
                if known:
                    ids.append(doc_id)
                    ns.append(n)
                    held.append(np.array(known, np.int64).T)
                    postings += len(known)
                if len(ids) == SEGMENT_DOCS or postings >= SEGMENT_POSTINGS:
                    yield build(id_type, ids, ns, held, n_docs, n_terms)
                    ids, ns, held, n_docs, n_terms, postings = [], [], [], 0, 0, 0
        if n_docs:
            yield build(id_type, ids, ns, held, n_docs, n_terms)

    schema = f"doc_ids array<{kind}>, ns array<long>, n_docs long, n_terms long, terms array<int>, dfs array<int>, "
    return stored(documents.mapInArrow(run, schema + "places binary, tfs binary"), "segments")


class Best:
    """The best few documents of an item so far: highest score first, then least id, no id last."""

    def __init__(self, limit):
        self.limit, self.rows = limit, []

    @property
    def floor(self):
        """The least score that may still enter."""
        return self.rows[-1][0] if len(self.rows) == self.limit else 1

    def add(self, rows):
        least = self.floor
        more = [row for row in rows if row[0] >= least]
        if more:
            key = lambda row: (-row[0], row[1] is None, row[1] if row[1] is not None else 0)
            self.rows = heapq.nsmallest(self.limit, self.rows + more, key)


def impact(tf, m):
    """What `tf` occurrences in a document of measure `m` count for, before the term's weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def mask_groups(held):
    """Documents (columns) that hold the same terms (rows): the first one and the group of each."""
    bits = np.packbits(held, axis=0)
    bits = np.concatenate([bits, np.zeros((-len(bits) % 8, bits.shape[1]), np.uint8)])
    words = np.ascontiguousarray(bits.T).view(np.uint64)
    group = np.zeros(len(words), np.int64)
    for word in words.T:
        _, rank = np.unique(word, return_inverse=True)
        _, first, group = np.unique(group * (rank.max() + 1) + rank, return_index=True, return_inverse=True)
    return first, group


def _rank_block(tfs, weights, ms, highest, ids, best):
    """Let the documents of a table of term counts (terms by documents) compete for an item's places."""
    first, group = mask_groups(tfs > 0)
    order = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group))
    shortest = np.minimum.reduceat(ms[order], ends - np.diff(ends, prepend=0))
    masks = tfs[:, first].T > 0
    bounds = masks @ (weights * impact(highest, ms.min()))
    hopeful = np.flatnonzero(bounds >= best.floor)
    tight = np.where(masks[hopeful], impact(highest, shortest[hopeful, None]), 0) @ weights
    ranked = np.argsort(-tight, kind="stable")
    hopeful, tight = hopeful[ranked], tight[ranked]
    begin, step = 0, 2 * best.limit
    while begin < len(hopeful) and tight[begin] >= best.floor:
        groups = hopeful[begin : begin + step]
        docs = np.concatenate([order[ends[g - 1] if g else 0 : ends[g]] for g in groups])
        scores = weights @ impact(tfs[:, docs], ms[docs])
        better = np.flatnonzero(scores >= best.floor)
        best.add([(int(scores[i]), ids[docs[i]]) for i in better])
        begin, step = begin + step, 2 * step


def _candidates(segments, items, weights, n_docs, n_terms, limit):
    """Each task's best documents per item: item, doc_id, score."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        best, id_type = {item: Best(limit) for item, _, _ in items}, None
        for batch in batches:
            id_type = batch.column("doc_ids").type.value_type
            for row in range(batch.num_rows):
                cells = {name: batch.column(name)[row] for name in batch.schema.names}
                ids = cells["doc_ids"].as_py()
                if not ids:
                    continue
                terms = cells["terms"].values.to_numpy()
                ends = np.cumsum(cells["dfs"].values.to_numpy(), dtype=np.int64)
                places = np.frombuffer(cells["places"].as_py(), "<u2")
                tfs = np.frombuffer(cells["tfs"].as_py(), "<u4").astype(np.int64)
                starts = ends - np.diff(ends, prepend=0)
                highest = np.maximum.reduceat(tfs, starts)
                ns, place = np.unique(cells["ns"].values.to_numpy(), return_inverse=True)
                # Exact for any size: the products may exceed 64 bits.
                ms = np.array([25 + 75 * n * n_docs // n_terms for n in ns.tolist()], np.int64)[place]
                for item, numbers, times in items:
                    spots = np.searchsorted(terms, numbers)
                    there = spots < len(terms)
                    there[there] = terms[spots[there]] == numbers[there]
                    worth = weights[numbers] * times
                    there &= worth > 0
                    spots, worth = spots[there], worth[there]
                    if not len(spots) or worth @ impact(highest[spots], ms.min()) < best[item].floor:
                        continue
                    wide = max(1, TABLE // len(spots))
                    for low in range(0, len(ids), wide):
                        table = np.zeros((len(spots), min(wide, len(ids) - low)), np.int64)
                        for line, s in enumerate(spots):
                            at = places[starts[s] : ends[s]].astype(np.int64) - low
                            inside = (at >= 0) & (at < table.shape[1])
                            table[line, at[inside]] = tfs[starts[s] : ends[s]][inside]
                        some = np.flatnonzero(table.any(axis=0))
                        if len(some):
                            names = [ids[low + i] for i in some]
                            _rank_block(table[:, some], worth, ms[low + some], highest[spots], names, best[item])
        rows = [(item, doc_id, score) for item, places in best.items() for score, doc_id in places.rows]
        if rows:
            kinds = [pa.int64(), id_type, pa.int64()]
            columns = [pa.array(column, k) for column, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return segments.mapInArrow(run, f"item long, doc_id {kind}, score long")


def _first(rows, limit, *by):
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def ranked_documents(documents, items, limit=10, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """One row per item and place: item_id, rank, doc_id, score; the `limit` best documents above 0.

    Terms, weights and scores are whole numbers as in the queries' contract. A block of items
    is at most BLOCK_BYTES of terms (or one item); the driver and each task hold one block, and each
    block reads the documents once. NULL and empty texts have no terms: such items have no rows and such
    documents are nowhere. Each row of either table is an item or a document of its own, repeated ids and
    NULL ids included. Equal scores go by ascending doc_id, NULL last. Other columns do not matter. Very
    long texts are split piece by piece; only their distinct terms are held. Without
    items or documents there are no rows.
    """
    spark = documents.sparkSession
    rows = texts(documents, id_col, text_col)
    numbered = _numbered_items(items, item_col, item_text_col)
    found = None
    for parcels in _passes(numbered):
        block = numbered.filter(F.col("parcel").isin(parcels)).select("item", "terms", "times").orderBy("item").collect()
        vocabulary = {}
        for _, terms, _ in block:
            for term in terms:
                vocabulary.setdefault(bytes(term), len(vocabulary))
        asked = [
            (item, np.array([vocabulary[bytes(t)] for t in terms], np.int64), np.array(times, np.int64))
            for item, terms, times in block
        ]
        segments = _segments(rows, vocabulary)
        n_docs, n_terms = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            continue
        pairs = segments.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p")).select("p.*")
        dfs = np.zeros(len(vocabulary), np.int64)
        for term, df in pairs.groupBy("terms").agg(F.sum("dfs")).collect():
            dfs[term] = df
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs.tolist()], np.int64)
        part = _candidates(segments, asked, weights, n_docs, n_terms, limit)
        found = part if found is None else found.union(part)
    if found is None:
        kinds = rows.schema["doc_id"].dataType.simpleString()
        found = spark.createDataFrame([], f"item long, doc_id {kinds}, score long")
    salted = found.withColumn("salt", F.spark_partition_id() % MERGES)
    best = _first(_first(salted, limit, "item", "salt").drop("rank"), limit, "item")
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
