"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file is read through Spark and travels with the job; workers rebuild the
tokenizer from it. Texts are normalised and cut wherever no piece of the vocabulary reaches
across; parts that a task has not met lately are encoded in one multithreaded batch call
and compared with the SentencePiece library's own answer.
"""

from dataclasses import replace
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from roadwatch.llm import piece_model
from roadwatch.llm.shingles import mix
from roadwatch.llm.tables import slices, texts

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# Characters that are worked on at a time.
LONGEST_RUN = 1_000_000
# Parts that a task remembers; beyond that it forgets all and starts again.
REMEMBERED = 300_000

ENCODED = "n_tokens long, n_byte_tokens long, ids array<int>, parity boolean, round_trip boolean"


def read_model(spark, path):
    """The bytes of a model file in any store that Spark reads."""
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row[0])


class Encoder:
    """Ids of texts, remembering parts that were encoded before."""

    def __init__(self, data):
        self.model = piece_model.parse(data)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes = piece_model.piece_bytes(self.model)
        self.is_byte = np.array([kind == piece_model.BYTE for kind in self.model.kinds])
        self.joints = piece_model.Joints(self.model)
        # Parts are cut only if normalising leaves all but spaces alone.
        plain = not self.model.char_map and not self.model.trim_spaces
        plain = plain and self.model.dummy_prefix and self.model.escape_spaces and self.model.byte_fallback
        self.in_parts = plain and self.joints.stranger is not None
        self.at_spaces = piece_model.cuts_at_spaces(self.model)
        if self.in_parts:
            self.core = piece_model.core(self.model)
            # Without other rules than for spaces a text can be normalised piece by piece.
            self.first = piece_model.normalizer(self.model)
            self.rest = piece_model.normalizer(replace(self.model, dummy_prefix=False))
            # What the library gives for a stranger before a part, to be taken off again.
            self.lead = len(self.own.encode(self.joints.stranger))
        else:
            self.twin = piece_model.backend(self.model)
        self.forget()

    def forget(self):
        self.known = np.array([], np.uint64)
        self.numbers = np.array([], np.int64)
        self.flat, self.sizes, self.same = np.array([], np.int32), np.array([], np.int64), np.array([], bool)

    def _compare(self, new):
        """Ids of parts by the tokenizers library, and whether the SentencePiece library agrees; where not, its ids."""
        space = piece_model.SPACE
        got = [encoding.ids for encoding in self.core.encode_batch_fast(new, add_special_tokens=False)]
        # The library puts its marker before any text; other parts get a stranger to bear it.
        bare = [p[0] == space and len(p) > 1 for p in new]
        raw = [(p[1:] if b else self.joints.stranger + p).replace(space, " ") for p, b in zip(new, bare, strict=True)]
        want = self.own.encode(raw, num_threads=1)
        want = [ids if b else ids[self.lead :] for ids, b in zip(want, bare, strict=True)]
        return _checked(got, want)

    def _learn(self, hashes, new):
        ids, same = self._compare(new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known = np.concatenate([self.known, hashes])
        self.numbers = np.concatenate([self.numbers, np.arange(len(ids)) + len(self.sizes)])
        order = np.argsort(self.known)
        self.known, self.numbers = self.known[order], self.numbers[order]
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32, sizes.sum())])
        self.same = np.concatenate([self.same, np.array(same, bool)])

    def _whole(self, batch):
        """Ids of whole texts, for models whose normaliser does more than mark spaces."""
        got = [encoding.ids for encoding in self.twin.encode_batch_fast(batch, add_special_tokens=False)]
        ids, same = _checked(got, self.own.encode(batch, num_threads=1))
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, counts.sum())
        return flat, counts, np.array(same, bool)

    def _normalised(self, text):
        """A text as the rebuilt normaliser gives it: markers for spaces, and one before it."""
        pieces = range(0, len(text), LONGEST_RUN)
        return "".join((self.rest if a else self.first).normalize_str(text[a : a + LONGEST_RUN]) for a in pieces)

    def _runs(self, marked):
        """A normalised text in runs of bounded length, cut where no piece reaches across."""
        space, begin = piece_model.SPACE, 0
        while len(marked) - begin > LONGEST_RUN:
            cut = marked.rfind(self.joints.stranger, begin, begin + LONGEST_RUN) + 1
            if not cut and self.at_spaces:
                cut = marked.rfind(space, begin + 1, begin + LONGEST_RUN)
                while cut > begin and marked[cut - 1] == space:
                    cut -= 1
            if cut <= begin:
                break
            yield marked[begin:cut]
            begin = cut
        yield marked[begin:]

    def encode(self, batch):
        """Flat ids, ids per text, and whether both libraries agree on each text."""
        if not self.in_parts:
            return self._whole(batch)
        # Each text with its dummy prefix; empty ones have none.
        marked = [(row, self._normalised(text)) for row, text in enumerate(batch) if text]
        runs = [(row, run) for row, text in marked for run in self._runs(text)]
        ids, counts, same = [], np.zeros(len(batch), np.int64), np.ones(len(batch), bool)
        begin = 0
        while begin < len(runs):
            end, size = begin, 0
            while end < len(runs) and (end == begin or size + len(runs[end][1]) <= LONGEST_RUN):
                size += len(runs[end][1])
                end += 1
            found, n_ids, agree = self._encode([run for _, run in runs[begin:end]])
            ids.append(found)
            rows = np.array([row for row, _ in runs[begin:end]])
            np.add.at(counts, rows, n_ids)
            np.logical_and.at(same, rows, agree)
            begin = end
        return np.concatenate(ids) if ids else np.array([], np.int32), counts, same

    def _encode(self, marked):
        """The same for normalised texts."""
        if len(self.sizes) > REMEMBERED:
            self.forget()
        joined = "".join(marked)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        begins = self.joints.cuts(points)
        begins[bounds[:-1][bounds[:-1] < len(points)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))[: len(starts)]
        hashes, first, place = np.unique(part_hashes(points, starts, ends), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, hashes)
        found = np.zeros(len(hashes), bool)
        inside = spot < len(self.known)
        found[inside] = self.known[spot[inside]] == hashes[inside]
        if not found.all():
            cut = first[~found]
            self._learn(hashes[~found], [joined[a:b] for a, b in zip(starts[cut].tolist(), ends[cut].tolist(), strict=True)])
        numbers = self.numbers[np.searchsorted(self.known, hashes)][place]
        cuts = np.searchsorted(starts, bounds)
        tokens = np.concatenate([[0], np.cumsum(self.sizes[numbers])])[cuts]
        differing = np.concatenate([[0], np.cumsum(~self.same[numbers])])[cuts]
        return ragged(self.flat, self.sizes, numbers), np.diff(tokens), np.diff(differing) == 0

    def encode_checked(self, batch):
        """`encode`, with bool per text whether its ids decode to the normalised text.

        Parts are told apart by a 64-bit hash; a text that does not decode is encoded again as a whole.
        """
        ids, counts, same = self.encode(batch)
        whole = self._decodes(batch, ids, counts)
        if not whole.all() and self.in_parts:
            pieces = np.split(ids, np.cumsum(counts)[:-1])
            for row in np.flatnonzero(~whole):
                pieces[row] = np.array(self.own.encode(batch[row]), np.int32)
            ids, counts = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
            whole = self._decodes(batch, ids, counts)
        return ids, counts, same, whole

    def _decodes(self, batch, ids, counts):
        space = piece_model.SPACE
        texts = batch if self.in_parts else [self.own.normalize(t).replace(space, " ").removeprefix(" ") for t in batch]
        decoded = self.decode(ids, counts)
        return np.array([got == text.replace(space, " ").encode() for text, got in zip(texts, decoded, strict=True)], bool)

    def decode(self, ids, counts):
        """The texts' bytes of flat ids; unlike text, bytes of split characters can be told apart."""
        table = np.frombuffer(b"".join(self.bytes), np.uint8)
        sizes = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        joined = ragged(table, sizes, ids).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        pieces = [joined[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [p[1:] if p[:1] == b" " else p for p in pieces] if self.model.dummy_prefix else pieces


def _checked(got, want):
    """The ids that the tokenizers library gives, or the model's own library's where they differ; and where not."""
    same = [mine == theirs for mine, theirs in zip(got, want, strict=True)]
    return [mine if s else theirs for mine, theirs, s in zip(got, want, same, strict=True)], same


def part_hashes(points, starts, ends):
    """64-bit hashes of the parts of an array of code points."""
    if not len(points):
        return np.array([], np.uint64)
    base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def powers(of):
        filled = np.full(len(points), of, np.uint64)
        filled[0] = 1
        return np.cumprod(filled, dtype=np.uint64)

    with np.errstate(over="ignore"):
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * powers(base), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * powers(inverse)[starts] + (ends - starts).astype(np.uint64))


def ragged(flat, sizes, picked):
    """Concatenate pieces of `flat`, of the given sizes, in the order of `picked`."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[picked]
    ends = np.cumsum(lengths)
    steps = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
    return flat[np.repeat(starts[picked], lengths) + steps]


def encode(documents, model_path=MODEL_PATH, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_tokens, n_byte_tokens, ids, parity, round_trip.

    `ids` are those of the tokenizers library, without control tokens. `parity`: SentencePiece gives
    the same ids for the whole text (parts where it does not have SentencePiece's). `round_trip`: the ids decode to the normalised text. NULL and empty texts have
    no ids. Repeated rows and NULL ids are rows like others. An empty table gives no rows.
    """
    data = read_model(documents.sparkSession, model_path)

    def run(batches):
        encoder = Encoder(data)
        for batch in slices(batches, "text", 1_000_000):
            ids, counts, same, whole = encoder.encode_checked(batch.column("text").to_pylist())
            bounds = np.concatenate([[0], np.cumsum(counts)])
            bytes_used = np.concatenate([[0], np.cumsum(encoder.is_byte[ids])])[bounds]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(np.diff(bytes_used), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(same),
                    pa.array(whole),
                ],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids", "parity", "round_trip"],
            )

    rows = texts(documents, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, {ENCODED}")


def decode(tokens, model_path=MODEL_PATH, id_col="doc_id", ids_col="ids"):
    """One row per row of ids: doc_id, text. NULL ids give a NULL text.

    Bytes that form no character become U+FFFD. An id outside the vocabulary is an error.
    """
    data = read_model(tokens.sparkSession, model_path)
    ids = F.col(ids_col).cast("array<int>")

    def run(batches):
        encoder = Encoder(data)
        for batch in batches:
            rows = [row or [] for row in batch.column("ids").to_pylist()]
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            flat = np.fromiter((i for row in rows for i in row), np.int64, counts.sum())
            if len(flat) and (flat.min() < 0 or flat.max() >= len(encoder.bytes)):
                raise ValueError("an id outside the vocabulary")
            missing = batch.column("ids").is_null().to_pylist()
            decoded = zip(encoder.decode(flat, counts), missing, strict=True)
            out = [None if gone else piece.decode("utf-8", "replace") for piece, gone in decoded]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    rows = tokens.select(F.col(id_col).alias("doc_id"), ids.alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, text string")
