"""Which tokens of two tokenizers cover the same bytes, counted over a whole corpus.

Texts are cut where both tokenizers begin anew, before a space that follows a character of a word.
A task encodes each distinct part once and keeps it with its links. When its dictionary is full it
closes a run: for each pair of linked ids the number of its documents, sorted by the first side's id,
cut by radixes of that id and compressed. A radix is merged by a heap over its runs;
pairs come out in order of the first side, so that an id's highest count is known when the next id begins,
and each run is sent the counts of its pairs back. There they are added up per part and per document.
"""

import heapq
import json
import re
from hashlib import sha256
from itertools import chain, groupby, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadwatch.llm import piece_model
from roadwatch.llm.runs import first_run, one_list, pack, spread, sums, unpack
from roadwatch.llm.tables import slices, stored, texts
from roadwatch.llm.tokens import read_model

BYTE_PATH, PIECE_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

# A run ends with the document that brings this many parts, or bytes of parts, or pairs.
RUN_PARTS, RUN_BYTES, RUN_PAIRS = 200_000, 16_000_000, 1_000_000
# Characters that are cut and encoded at a time.
WINDOW = 500_000
# Longer words of the first side are left to the library that reads them in one pass.
LONG_WORD = 10_000
# Groups with more links are counted by distinct ids.
WIDE_GROUP = 1 << 16
# Entries of a run that a merge has unpacked as objects at a time.
HELD = 1024

# The pre-tokenizer's pattern, and the bytes that the vocabulary writes as themselves.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Not before a text's last space: alone it would be a part that the second side takes for no text.
CUT = re.compile(rf"(?<=[^\s{piece_model.SPACE}])(?= (?s:.))")
ID_BITS = 20

PAIRS, PARTS, DOCS = 0, 1, 2


def _printed_bytes():
    """The byte that each character of a byte-level vocabulary stands for."""
    others = (b for b in range(256) if b not in PRINTED)
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both sides: ids of parts, and the bytes of ids."""

    def __init__(self, byte_file, piece_file):
        spec, model = json.loads(byte_file), piece_model.parse(piece_file)
        self.whole = Tokenizer.from_str(byte_file.decode())
        self.whole.encode_special_tokens = True
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        back = _printed_bytes()
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        first = [b""] * self.whole.get_vocab_size()
        for token, i in vocabulary.items():
            first[i] = bytes(map(back.__getitem__, token)) if all(c in back for c in token) else token.encode()
        self.bytes = [first, piece_model.piece_bytes(model)]
        before = spec["pre_tokenizer"] or {}
        by_words = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        by_words = by_words and not before["add_prefix_space"] and spec["normalizer"] is None
        plain = not model.char_map and not model.trim_spaces and model.dummy_prefix and model.escape_spaces
        # Elsewhere a token might reach across a cut.
        self.in_parts = bool(by_words and plain and piece_model.cuts_at_spaces(model))
        self.quick = None
        if by_words and _ranked(spec["model"], vocabulary):
            ranks = {first[i]: i for token, i in vocabulary.items() if all(c in back for c in token)}
            self.quick = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        if max(map(len, self.bytes)) >> ID_BITS:
            raise ValueError("a vocabulary of more than a million tokens")

    def encode(self, parts):
        """Ids of each part by both sides. Parts begin with a space, which the second adds by itself."""
        left = [None] * len(parts)
        if self.quick:
            # The same merges by ranks; character classes of other libraries could differ outside ASCII.
            easy = [part.isascii() and len(part) <= LONG_WORD for part in parts]
            left = [self.quick.encode_ordinary(part) if e else None for part, e in zip(parts, easy, strict=True)]
        rest = [i for i, ids in enumerate(left) if ids is None]
        found = self.whole.encode_batch_fast([parts[i] for i in rest], add_special_tokens=False)
        for i, encoding in zip(rest, found, strict=True):
            left[i] = encoding.ids
        return left, self.piece.encode([part[1:] for part in parts], num_threads=1)


def _ranked(model, vocabulary):
    """Whether merges are in the order of the ids that they make, so that ids serve as ranks."""
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
        return False
    pairs = (merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"])
    made = [vocabulary["".join(pair)] for pair in pairs]
    return all(a < b for a, b in zip(made, made[1:], strict=False)) and len(made) + 256 >= len(vocabulary) - 1


class Dictionary:
    """The parts of a run: their ids' numbers, groups and linked pairs."""

    def __init__(self, sides):
        self.sides = sides
        self.tables = []
        for names in sides.bytes:
            self.tables.append(np.fromiter(map(len, names), np.int64, len(names)))
        numbers = range(max(map(len, sides.bytes)))
        written = [f"{i}{mark}".encode() for i in numbers for mark in ",|;"]
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.widths = np.fromiter(map(len, written), np.int64, len(written))
        self.clear()

    def clear(self):
        self.known, self.names, self.size = {}, [], 0
        # Per part: whether it is spelled right, tokens of both sides, groups, links, distinct pairs.
        self.facts = np.zeros((6, 0), np.int64)
        self.keys, self.times = np.array([], np.int64), np.array([], np.int64)

    def learn(self, parts):
        sides = [list(ids) for ids in self.sides.encode(parts)]
        raw = [part.encode() for part in parts]
        right = np.ones(len(parts), bool)
        for names, found in zip(self.sides.bytes, sides, strict=True):
            right &= [b"".join([names[i] for i in ids]) == text for ids, text in zip(found, raw, strict=True)]
        for i in np.flatnonzero(~right):
            sides[0][i], sides[1][i], raw[i] = [], [], b""
        counts = [np.fromiter(map(len, found), np.int64, len(found)) for found in sides]
        ids = [np.fromiter(chain.from_iterable(f), np.int64, n.sum()) for f, n in zip(sides, counts, strict=True)]
        ends = [np.cumsum(table[flat]) for table, flat in zip(self.tables, ids, strict=True)]
        part_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        ending = np.zeros(part_ends[-1] + 1, bool)
        ending[ends[0]] = True
        cuts = ends[1][ending[ends[1]]]
        group = [np.searchsorted(cuts, e) for e in ends]
        members = [np.bincount(g, minlength=len(cuts)) for g in group]
        part = np.searchsorted(part_ends, cuts)
        keys, times, pairs = _pairs(ids, group, members, part, len(parts))
        links = np.bincount(part, members[0] * members[1], len(parts)).astype(np.int64)
        facts = np.array([right, *counts, np.bincount(part, minlength=len(parts)), links, pairs])
        self._write(ids, group, members, part, len(parts))
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.facts = np.concatenate([self.facts, facts], axis=1)
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])
        self.size += int(part_ends[-1])

    def _write(self, ids, group, members, part, n_parts):
        """Each part's groups as text, with a semicolon after each."""
        last = [np.zeros(len(flat), bool) for flat in ids]
        for side in (0, 1):
            last[side][np.cumsum(members[side]) - 1] = True
        place = np.concatenate([2 * group[0], 2 * group[1] + 1])
        order = np.argsort(place, kind="stable")
        words = np.concatenate([3 * ids[0] + last[0], 3 * ids[1] + 2 * last[1]])[order]
        text = spread(self.written, self.widths, words).tobytes()
        sizes = np.bincount(part[place[order] >> 1], self.widths[words], n_parts).astype(np.int64)
        ends = np.cumsum(sizes)
        self.names += [text[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def _pairs(ids, group, members, part, n_parts):
    """Linked pairs of each part, its distinct ones with their numbers; parts one after the other."""
    links = members[0] * members[1]
    small = links[group[0]] <= WIDE_GROUP
    at, left = group[0][small], ids[0][small]
    partners = members[1][at]
    first = (np.cumsum(members[1]) - members[1])[at]
    steps = np.arange(partners.sum()) - np.repeat(np.cumsum(partners) - partners, partners)
    found = [(np.repeat(part[at], partners), np.repeat(left, partners), ids[1][np.repeat(first, partners) + steps], None)]
    for g in np.flatnonzero(links > WIDE_GROUP):
        (a, n), (b, m) = (np.unique(flat[own == g], return_counts=True) for flat, own in zip(ids, group, strict=True))
        found.append((np.full(len(a) * len(b), part[g]), np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(n, m).ravel()))
    whole = np.concatenate([(p << 2 * ID_BITS) + (a << ID_BITS) + b for p, a, b, _ in found])
    times = np.concatenate([np.ones(len(p), np.int64) if n is None else n for p, _, _, n in found])
    distinct, place = np.unique(whole, return_inverse=True)
    times = np.bincount(place, times, len(distinct)).astype(np.int64)
    return distinct & ((1 << 2 * ID_BITS) - 1), times, np.bincount(distinct >> 2 * ID_BITS, minlength=n_parts)


class Document:
    """What is known of a text while its windows are read."""

    def __init__(self, doc_id):
        self.doc_id, self.numbers, self.digest, self.held = doc_id, [], sha256(), b""

    def add(self, dictionary, parts):
        numbers = [dictionary.known[part] for part in parts]
        self.numbers.append(np.array(numbers, np.int64))
        self.digest.update(self.held)
        self.held = b"".join([dictionary.names[i] for i in numbers])

    def finish(self, dictionary):
        """Its distinct parts with their numbers, and its own figures."""
        parts, times = np.unique(np.concatenate([np.array([], np.int64), *self.numbers]), return_counts=True)
        facts = dictionary.facts[:, parts]
        if not len(parts) or not facts[0].all():
            return parts[:0], times[:0], (self.doc_id, 0, 0, 0, 0, "")
        self.digest.update(self.held[:-1])
        return parts, times, (self.doc_id, *(facts[1:5] @ times).tolist(), self.digest.hexdigest())


def _windows(text, in_parts):
    """A text with its leading space in windows that end where parts do."""
    text, begin = " " + text, 0
    while begin < len(text):
        cut = CUT.search(text, begin + WINDOW) if in_parts and len(text) - begin > WINDOW else None
        end = cut.start() if cut else len(text)
        yield text[begin:end], end == len(text)
        begin = end


DOC_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
DOC_SCHEMA = "n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string"


class Writer:
    """A task's runs as rows: packed pairs per radix, parts, and documents."""

    def __init__(self, sides, radixes, id_type):
        self.dictionary, self.radixes, self.run = Dictionary(sides), radixes, first_run()
        self.in_parts, self.open, self.pending, self.size = sides.in_parts, None, [], 0
        kinds = [id_type, *[pa.int64()] * 4, pa.string()]
        self.docs_type = pa.struct(list(zip(DOC_FIELDS, kinds, strict=True)))
        self.counted, self.n_counted = [], 0

    def row(self, kind, radix, blob, docs=()):
        docs = pa.array([dict(zip(DOC_FIELDS, doc, strict=True)) for doc in docs], self.docs_type)
        columns = [pa.array([self.run]), pa.array([kind], pa.int8()), pa.array([radix]), pa.array([blob], pa.binary())]
        names = ["run", "kind", "radix", "blob", "docs"]
        return pa.RecordBatch.from_arrays([*columns, one_list(docs)], names=names)

    def add(self, doc_id, text):
        for window, last in _windows(text, self.in_parts) if text else [("", True)]:
            self.pending.append((doc_id, window, last))
            self.size += len(window) + 1
            if self.size >= WINDOW:
                yield from self.flush()

    def flush(self):
        """Encode what is pending; rows of the documents that end in it."""
        book, split = self.dictionary, CUT.split if self.in_parts else lambda text: [text]
        cut = [split(window) if window else [] for _, window, _ in self.pending]
        fresh = [part for part in dict.fromkeys(chain.from_iterable(cut)) if part not in book.known]
        if fresh:
            book.learn(fresh)
        done = []
        for (doc_id, _, last), parts in zip(self.pending, cut, strict=True):
            self.open = self.open or Document(doc_id)
            self.open.add(book, parts)
            if last:
                done.append(self.open.finish(book))
                self.open = None
        self.pending, self.size = [], 0
        if done:
            sizes = np.array([len(parts) for parts, _, _ in done])
            parts, times = (np.concatenate([d[i] for d in done]) for i in (0, 1))
            self._count(parts, sizes)
            yield self.row(DOCS, -1, pack(sizes, parts, times), [doc for _, _, doc in done])
        full = len(book.known) >= RUN_PARTS or book.size >= RUN_BYTES or self.n_counted >= RUN_PAIRS
        if full and not self.open:
            yield from self.close()

    def _count(self, parts, sizes):
        """Add the documents' distinct pairs to the counts of the run."""
        book = self.dictionary
        n_pairs = book.facts[5]
        docs = np.repeat(np.repeat(np.arange(len(sizes)), sizes), n_pairs[parts])
        records = np.unique((docs << 2 * ID_BITS) + spread(book.keys, n_pairs, parts))
        self.counted.append(np.unique(records & ((1 << 2 * ID_BITS) - 1), return_counts=True))
        self.n_counted += len(self.counted[-1][0])
        if self.n_counted >= RUN_PAIRS:
            self._combine()

    def _combine(self):
        keys, place = np.unique(np.concatenate([k for k, _ in self.counted]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n for _, n in self.counted]), len(keys)).astype(np.int64)
        self.counted, self.n_counted = [(keys, counts)], len(keys)

    def close(self):
        if self.counted:
            self._combine()
            keys, counts = self.counted[0]
            radix = (keys >> ID_BITS) % self.radixes
            for r in np.unique(radix).tolist():
                yield self.row(PAIRS, r, pack(np.diff(keys[radix == r], prepend=0), counts[radix == r]))
        book = self.dictionary
        yield self.row(PARTS, -1, pack(book.facts[5], book.keys, book.times))
        book.clear()
        self.counted, self.n_counted = [], 0
        self.run += 1


def _entries(run, keys, counts):
    """A run's pairs as (pair, run, place, documents), unpacked a few at a time."""
    for i in range(0, len(keys), HELD):
        some = keys[i : i + HELD].tolist()
        yield from zip(some, repeat(run), range(i, i + len(some)), counts[i : i + HELD].tolist(), strict=False)


def merge_radix(runs):
    """Of each run's pairs (pairs, documents, both sorted by pair): all runs' documents, and if that is its first id's most."""
    totals = [np.zeros(len(keys), np.int64) for keys, _ in runs]
    best = [np.zeros(len(keys), np.int64) for keys, _ in runs]
    entries = heapq.merge(*(_entries(run, *pairs) for run, pairs in enumerate(runs)))
    for _, of_id in groupby(entries, lambda entry: entry[0] >> ID_BITS):
        # One id of the first side: at most as many pairs as its runs hold.
        highest, counted = 0, []
        for _, same in groupby(of_id, lambda entry: entry[0]):
            places = list(same)
            total = sum(entry[3] for entry in places)
            highest = max(highest, total)
            counted.append((total, places))
        for total, places in counted:
            for _, run, place, _ in places:
                totals[run][place] = total
                best[run][place] = total == highest
    return zip(totals, best, strict=True)


def _merge(batches):
    """Rows of packed pairs, radix after radix; one row per run and radix with its pairs' figures."""

    def answer(held):
        pairs = [(np.cumsum(keys), counts) for keys, counts in (unpack(blob) for _, blob in held)]
        runs = [run for run, _ in held]
        blobs = [pack(keys, *found) for (keys, _), found in zip(pairs, merge_radix(pairs), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(runs), pa.array(blobs, pa.binary())], names=["run", "blob"])

    radix, held = None, []
    for batch in batches:
        for run, at, blob in zip(*(batch.column(name).to_pylist() for name in ("run", "radix", "blob")), strict=True):
            if at != radix and held:
                yield answer(held)
                held = []
            radix = at
            held.append((run, blob))
    if held:
        yield answer(held)


def _finish(batches):
    """Rows of each run, its counts first, then its parts, then its documents: one row per document."""
    run, answers, table = None, [], None
    for batch in batches:
        columns = [batch.column(name) for name in ("run", "kind", "blob", "docs")]
        for at, (own, kind, blob) in enumerate(zip(*(c.to_pylist() for c in columns[:3]), strict=True)):
            if own != run:
                run, answers = own, []
            if kind == PAIRS:
                answers.append(unpack(blob))
            elif kind == PARTS:
                n_pairs, keys, times = unpack(blob)
                # One entry that no key equals, for runs without pairs.
                none = [np.array([1 << 2 * ID_BITS]), np.array([0]), np.array([0])]
                pairs, totals, best = (np.concatenate(column) for column in zip(*answers, none, strict=True))
                order = np.argsort(pairs)
                place = order[np.searchsorted(pairs, keys, sorter=order)]
                # Parts of documents that are spelled wrong elsewhere may have pairs that no document counts.
                times = times * (pairs[place] == keys)
                table = sums(times * best[place], n_pairs), sums(times * totals[place], n_pairs)
            else:
                sizes, parts, times = unpack(blob)
                docs = columns[3][at].values
                figures = [pa.array(sums(times * of_part[parts], sizes), pa.int64()) for of_part in table]
                fields = dict(zip(DOC_FIELDS, docs.flatten(), strict=True))
                own_columns = [fields[name] for name in DOC_FIELDS[:-1]]
                names = [*DOC_FIELDS[:-1], "n_best", "count_sum", DOC_FIELDS[-1]]
                yield pa.RecordBatch.from_arrays([*own_columns, *figures, fields[DOC_FIELDS[-1]]], names=names)


def token_alignment(documents, byte_path=BYTE_PATH, piece_path=PIECE_PATH, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A is the byte-level tokenizer file, side B the SentencePiece model. A link is a pair of token
    occurrences in one group; its count is the number of documents that hold its pair of ids linked, each
    row a document, repeated rows too. `n_best`: links whose count is the highest of their A id, ties
    included. NULL and empty texts and texts that one side cannot spell have zeros and ''. Other columns do
    not matter. A very long text is read window by window; a single word without spaces is one part.
    No group grows with the corpus but a radix, by one entry per run and pair; there are as many
    radixes as shuffle partitions. An empty table gives no rows.
    """
    spark = documents.sparkSession
    files = [read_model(spark, path) for path in (byte_path, piece_path)]
    radixes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(documents, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        writer = None
        for batch in slices(batches, "text", WINDOW):
            writer = writer or Writer(Tokenizers(*files), radixes, batch.column("doc_id").type)
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                yield from writer.add(doc_id, text)
        if writer:
            yield from writer.flush()
            yield from writer.close()

    docs = f"docs array<struct<doc_id: {kind}, {DOC_SCHEMA}>>"
    written = stored(rows.mapInArrow(run, f"run long, kind byte, radix long, blob binary, {docs}"), "token-runs")
    pairs = written.filter(F.col("kind") == PAIRS).select("run", "radix", "blob")
    dealt = pairs.repartition(radixes, "radix").sortWithinPartitions("radix", "run")
    answers = dealt.mapInArrow(_merge, "run long, blob binary").withColumn("kind", F.lit(PAIRS).cast("byte"))
    rest = written.filter(F.col("kind") != PAIRS).drop("radix")
    whole = rest.unionByName(answers, allowMissingColumns=True).repartition("run").sortWithinPartitions("run", "kind")
    figures = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return whole.mapInArrow(_finish, f"doc_id {kind}, {figures}")
