"""Language-model scores: how likely a text is under a unigram model of subwords, all spellings counted.

A text is the sequence of its lower-cased words, each with a space before it, and an end. Its chance is
the sum over all ways to spell it with the vocabulary's pieces of the product of the pieces'
chances, times that of the end. No piece reaches across a word's beginning, so that a text's sum is the
product of its words' sums. Chances start from the vocabulary's own scores; expectation-maximisation over
the training documents' words then estimates them, with the scores as prior.

Tasks count words in runs. Each run asks once for each of its words, and is sent
back the word's number in training documents and its chance; texts themselves are never shuffled.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.llm import piece_model
from roadwatch.llm.lattice import Lattice, spellings
from roadwatch.llm.runs import first_run, one_list, pack, unpack
from roadwatch.llm.tables import slices, stored, texts
from roadwatch.llm.tokens import MODEL_PATH, read_model

# A run ends with the document that brings this many words.
RUN_WORDS = 300_000
# Documents in one packed row end with this many entries.
PACKED = 500_000
# Bytes of a text that are split at a time.
PIECE = 1 << 20
# Words whose lattices are worked on together.
TOGETHER = 20_000
# Entries of answers that a task packs at a time.
ANSWERS = 1_000_000
# Rounds of estimation, and the occurrences that the vocabulary's own scores count for, per spelling.
ROUNDS, PRIOR = 2, 0.5

WORDS, DOCS = 0, 1

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_counts(text):
    """Words of a text's UTF-8 bytes with their numbers; a long text is split piece by piece."""
    plain, counts, begin = text.translate(_LOWER), Counter(), 0
    while begin < len(plain):
        blank = _BLANK.search(plain, begin + PIECE)
        end = blank.start() if blank else len(plain)
        counts.update(plain[begin:end].split())
        begin = end
    return counts


class Writer:
    """A task's runs as rows: their words with the numbers in training documents, and packed documents."""

    def __init__(self, id_type):
        self.run = first_run()
        self.docs_type = pa.struct([("doc_id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64())])
        self.book, self.docs, self.words, self.times, self.size = {}, [], [], [], 0
        self.trained = []

    def add(self, doc_id, held_out, text):
        counts, book = word_counts(text), self.book
        self.words.append(np.array([book.setdefault(word, len(book)) for word in counts], np.int64))
        self.times.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.docs.append((doc_id, held_out, int(self.times[-1].sum()) + 1))
        self.size += len(counts) + 1
        if self.size >= PACKED or len(book) >= RUN_WORDS:
            yield from self.flush()
        if len(book) >= RUN_WORDS:
            yield from self.close()

    def _row(self, kind, idx, words, n, blob, docs):
        size = len(idx)
        columns = [pa.array([self.run] * size, pa.int64()), pa.array([kind] * size, pa.int8()), pa.array(idx, pa.int32())]
        columns += [pa.array(words, pa.binary()), pa.array(n, pa.int64()), pa.array(blob, pa.binary()), docs]
        return pa.RecordBatch.from_arrays(columns, names=["run", "kind", "idx", "word", "n", "blob", "docs"])

    def flush(self):
        if not self.docs:
            return
        sizes = np.array([len(words) for words in self.words])
        words, times = np.concatenate(self.words), np.concatenate(self.times)
        training = np.array([not held_out for _, held_out, _ in self.docs])
        learnt = np.bincount(words, times * np.repeat(training, sizes), len(self.book)).astype(np.int64)
        self.trained.append(learnt)
        names = [f.name for f in self.docs_type]
        docs = pa.array([dict(zip(names, doc, strict=True)) for doc in self.docs], self.docs_type)
        blob = pack(sizes, words, times)
        yield self._row(DOCS, [None], [None], [int(training.sum())], [blob], one_list(docs))
        self.docs, self.words, self.times, self.size = [], [], [], 0

    def close(self):
        yield from self.flush()
        n = np.zeros(len(self.book), np.int64)
        for learnt in self.trained:
            n[: len(learnt)] += learnt
        words = list(self.book)
        for a in range(0, len(words), TOGETHER):
            some, size = words[a : a + TOGETHER], len(words[a : a + TOGETHER])
            empty = pa.nulls(size, pa.list_(self.docs_type))
            yield self._row(WORDS, range(a, a + size), some, n[a : a + size], [None] * size, empty)
        self.book, self.trained = {}, []
        self.run += 1


def _count_words(rows):
    """Stored runs of (doc_id, held_out, text)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        writer = None
        for batch in slices(batches, "text"):
            writer = writer or Writer(batch.column("doc_id").type)
            texts_of = batch.column("text").cast(pa.binary()).to_pylist()
            ids, held = (batch.column(name).to_pylist() for name in ("doc_id", "held_out"))
            for doc in zip(ids, held, texts_of, strict=True):
                yield from writer.add(*doc)
        if writer:
            yield from writer.close()

    docs = f"docs array<struct<doc_id: {kind}, held_out: boolean, n_tokens: bigint>>"
    return stored(rows.mapInArrow(run, f"run long, kind byte, idx int, word binary, n long, blob binary, {docs}"), "word-runs")


def _read_lattice(names, logs, batches, columns, times=None):
    """For some words at a time: the columns asked for, and what the lattice says of the words."""
    lattice = Lattice(names, logs)
    for batch in batches:
        for a in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(a, TOGETHER)
            strings = [b" " + word for word in some.column("word").to_pylist()]
            counts = some.column(times).to_numpy() if times else None
            yield [some.column(name) for name in columns], *lattice.read(strings, counts)


def estimate(lexicon, names, weights, end, rounds=ROUNDS):
    """Chances of the spellings and, last, of the end, from training words (word, c) and `end` documents.

    Expected numbers come back as one row per spelling: at most the vocabulary.
    """
    prior = np.append(weights * len(names), 1.0) * PRIOR
    chances = prior / prior.sum()
    training = lexicon.filter("c > 0").select("word", "c")
    for _ in range(rounds):
        logs = np.log(chances[:-1])

        def expect(batches, logs=logs):
            total = np.zeros(len(names), np.int64)
            for _, _, expected in _read_lattice(names, logs, batches, [], "c"):
                total += expected
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["spelling", "units"])

        found = np.zeros(len(names) + 1)
        for spelling, units in training.mapInArrow(expect, "spelling long, units long").groupBy("spelling").agg(F.sum("units")).collect():
            found[spelling] = units / 65536
        found[-1] = end
        chances = (found + prior) / (found.sum() + prior.sum())
    return chances


def _answers(batches, names, logs):
    """For each run that asked, packed: its words' numbers in the run, in training documents, and their chances."""

    def packed(held):
        run, idx, c, chances = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.argsort(run, kind="stable")
        cuts = np.flatnonzero(np.diff(run[order], prepend=-1))
        each = np.split(order, cuts[1:])
        blobs = [pack(idx[rows], c[rows], chances[rows].view(np.int64)) for rows in each]
        return pa.RecordBatch.from_arrays([pa.array(run[order[cuts]]), pa.array(blobs, pa.binary())], names=["run", "blob"])

    held, size = [], 0
    for (places, c), chances, _ in _read_lattice(names, logs, batches, ["places", "c"]):
        sizes, asked = places.value_lengths().to_numpy(), places.flatten()
        found = np.repeat(c.to_numpy(), sizes), np.repeat(chances, sizes)
        held.append((*(asked.field(name).to_numpy() for name in ("run", "idx")), *found))
        size += len(asked)
        if size >= ANSWERS:
            yield packed(held)
            held, size = [], 0
    if size:
        yield packed(held)


def _finish(batches, n_train, n_distinct, end, log_end):
    """Rows of each run, its words' figures first, then its documents: one row per document."""
    whole = n_train + 0.5 * (n_distinct + 1)
    run, answers, table = None, [], None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("run", "kind", "blob")]
        for at, (own, kind, blob) in enumerate(zip(*columns, strict=True)):
            if own != run:
                run, answers, table = own, [], None
            if kind == WORDS:
                answers.append(unpack(blob))
                continue
            if table is None:
                none = [np.array([], np.int64)] * 3
                idx, c, chances = (np.concatenate(column) for column in zip(none, *answers, strict=True))
                order = np.argsort(idx)
                log = chances.view(np.float64)[order]
                table, answers = (c[order] > 0, np.log10((c[order] + 0.5) / whole), log), []
            sizes, words, times = unpack(blob)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            known, base, log = (np.bincount(doc, times * of_word[words], len(sizes)) for of_word in table)
            fields = batch.column("docs")[at].values.flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    *fields,
                    pa.array(known.astype(np.int64) + (end > 0)),
                    pa.array(np.full(len(sizes), n_train, np.int64)),
                    pa.array(base + np.log10((end + 0.5) / whole)),
                    pa.array((log + log_end) / np.log(10)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


def text_scores(documents, model_path=MODEL_PATH, rounds=ROUNDS, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose CRC-32 of the id leaves 1 when divided by 5 are held out, all others train. `base_score`
    is the smoothed word model's log10 chance, `score` the subword lattice's. NULL and empty texts are just
    an end. A NULL id is not held out; repeated rows count as often as they stand there. Bytes that
    no piece spells have a small chance of their own, so that every text has a finite score. Other columns do
    not matter. Very long texts are counted piece by piece; only their distinct words are held. A word's
    group has one entry per run, however frequent it is. An empty table gives no rows.
    """
    spark = documents.sparkSession
    model = piece_model.parse(read_model(spark, model_path))
    if not piece_model.cuts_at_spaces(model):
        raise ValueError("a piece of the vocabulary reaches across the beginning of a word")
    names, weights = spellings(model)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    rows = texts(documents, id_col, text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    written = _count_words(rows)
    places = F.collect_list(F.struct("run", "idx")).alias("places")
    words = written.filter(F.col("kind") == WORDS).groupBy("word").agg(F.sum("n").alias("c"), places)
    lexicon = stored(words, "lexicon")
    n_words, n_distinct = lexicon.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    end = written.filter(F.col("kind") == DOCS).agg(F.sum("n")).first()[0] or 0
    n_train, n_distinct = (n_words or 0) + end, n_distinct + (end > 0)
    logs = np.log(estimate(lexicon, names, weights, end, rounds))

    kind, log_end = rows.schema["doc_id"].dataType.simpleString(), float(logs[-1])
    asked = lexicon.select("word", "places", "c")
    answers = asked.mapInArrow(lambda batches: _answers(batches, names, logs[:-1]), "run long, blob binary")
    answers = answers.withColumn("kind", F.lit(WORDS).cast("byte"))
    packed = written.filter(F.col("kind") == DOCS).select("run", "kind", "blob", "docs")
    whole = packed.unionByName(answers, allowMissingColumns=True).repartition("run").sortWithinPartitions("run", "kind")
    return whole.mapInArrow(
        lambda batches: _finish(batches, n_train, n_distinct, end, log_end),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
