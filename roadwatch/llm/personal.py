"""Personal data by weak supervision.

Patterns give base spans, which stay. Beyond them, wider patterns propose candidates;
regex, gazetteer and context labelers vote on each or abstain. Votes are counted per pattern of
votes over the whole table, expectation-maximisation estimates how reliable each
labeler is, and a logistic classifier over kind, length and votes, trained on the posteriors,
decides which candidates are spans.
"""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.llm import spans
from roadwatch.llm.tables import slices, stored, texts

# First guess of each labeler's reliability, in the order of spans.LABELERS, and of the share of true
# candidates by kind, in the order of spans.MORE_KINDS.
FIRST_RELIABILITY = np.array([0.97, 0.85, 0.8, 0.8, 0.9, 0.85])
FIRST_SHARES = np.array([0.4, 0.6, 0.5, 0.3, 0.2, 0.4, 0.6])
# The guesses count as much as this share of all candidates, and as this many of a kind.
ANCHOR, ANCHOR_OF_KIND = 0.1, 20.0
ROUNDS = 50

FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "base array<struct<kind:string,start:int,end:int>>, "
    "candidates array<struct<kind:string,start:int,end:int,code:int>>"
)
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
CANDIDATE = pa.struct([*SPAN, ("code", pa.int32())])


def _scan(batches):
    for batch in slices(batches, "text"):
        rows = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "candidates")}
        for text in batch.column("text").to_pylist():
            base = spans.base_spans(text)
            counts = Counter(kind for kind, _, _ in base)
            for kind in spans.BASE_KINDS:
                rows[f"n_{kind}"].append(counts[kind])
            rows["base_sha256"].append(hashlib.sha256(spans.joined(base).encode()).hexdigest())
            rows["base"].append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base])
            more = spans.candidates(text, base)
            rows["candidates"].append([dict(zip(("kind", "start", "end", "code"), s, strict=True)) for s in more])
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(SPAN), pa.list_(CANDIDATE)]
        arrays = [pa.array(values, kind) for values, kind in zip(rows.values(), types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *rows])


def label_model(votes, counts, kinds=None, first_shares=(0.5,), rounds=ROUNDS):
    """Posterior of each vote pattern, and each labeler's estimated reliability.

    `kinds` numbers each pattern's kind; kinds have shares of true candidates of their own.
    """
    kinds = np.zeros(len(counts), int) if kinds is None else np.asarray(kinds)
    guess = np.asarray(first_shares, float)
    cast = votes >= 0
    reliability, shares = FIRST_RELIABILITY.copy(), guess.copy()
    imagined = ANCHOR * counts.sum()
    of_kind = np.bincount(kinds, counts, len(guess))
    for _ in range(rounds):
        weight = np.log(reliability / (1 - reliability))
        score = np.log(shares / (1 - shares))[kinds] + (cast * np.where(votes == 1, weight, -weight)).sum(axis=1)
        chance = 1 / (1 + np.exp(-score))
        right = (counts * chance)[:, None] * (votes == 1) + (counts * (1 - chance))[:, None] * (votes == 0)
        total = (counts[:, None] * cast).sum(axis=0)
        reliability = (right.sum(axis=0) + imagined * FIRST_RELIABILITY) / (total + imagined)
        shares = (np.bincount(kinds, counts * chance, len(guess)) + ANCHOR_OF_KIND * guess) / (of_kind + ANCHOR_OF_KIND)
    return chance, reliability


def disproved(kind, cast):
    return cast[0] == 0 and spans.MORE_KINDS[kind] in spans.CHECKED_KINDS


def design(codes):
    """Indicator features of codes: kind, length class, each labeler's vote, and a checksum that fails where it decides."""
    rows = []
    for code in codes:
        kind, length, cast = spans.features_of(code)
        row = np.zeros(2 + len(spans.MORE_KINDS) + spans.N_LENGTHS + 2 * len(cast))
        row[-1] = disproved(kind, cast)
        row[0] = row[1 + kind] = row[1 + len(spans.MORE_KINDS) + length] = 1
        for j, vote in enumerate(cast):
            if vote >= 0:
                row[1 + len(spans.MORE_KINDS) + spans.N_LENGTHS + 2 * j + vote] = 1
        rows.append(row)
    return np.array(rows)


def train(features, chance, counts, steps=30, penalty=1e-3):
    """Weights of a logistic classifier for soft labels, by Newton's method."""
    weights = np.zeros(features.shape[1])
    share = counts / counts.sum()
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-features @ weights))
        slope = features.T @ (share * (guess - chance)) + penalty * weights
        curve = (features * (share * guess * (1 - guess))[:, None]).T @ features
        weights -= np.linalg.solve(curve + penalty * np.eye(len(weights)), slope)
    return weights


def accepted_codes(counted):
    """Codes that the trained classifier takes for personal data.

    `counted` has code and n: at most 7 * 4 * 3^6 rows, whatever the number of documents.
    """
    rows = counted.orderBy("code").collect()
    if not rows:
        return frozenset()
    codes, counts = [r["code"] for r in rows], np.array([float(r["n"]) for r in rows])
    kinds, _, votes = zip(*[spans.features_of(code) for code in codes], strict=True)
    chance, _ = label_model(np.array(votes), counts, kinds, FIRST_SHARES)
    # A checksum that decides leaves no doubt for the classifier to learn.
    chance[[disproved(kind, cast) for kind, cast in zip(kinds, votes, strict=True)]] = 0
    features = design(codes)
    decided = features @ train(features, chance, counts)
    return frozenset(code for code, score in zip(codes, decided, strict=True) if score > 0)


def personal_data(documents, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans.

    `n_spans` counts all spans, base and added. `spans` is text of kind:start:end; `found`, the same as an array of structs, is for those
    who go on to redact. Texts are read once; what was found is stored, and the classifier's
    verdict applied to that. Very long texts are scanned whole. Columns of the table other than the id
    and the text stay out. Of overlapping added spans the first stays, at a tie the kind named first. NULL and empty texts have no spans. Repeated rows and NULL ids are
    documents like others. An empty table gives no rows.
    """
    rows = texts(documents, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scanned = stored(rows.mapInArrow(_scan, f"doc_id {id_type}, {FOUND}"), "spans")
    codes = scanned.select(F.explode("candidates.code").alias("code"))
    accepted = accepted_codes(codes.groupBy("code").agg(F.count("*").alias("n")))

    def decide(batches):
        for batch in batches:
            found = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                kept = [(c["kind"], c["start"], c["end"]) for c in more if c["code"] in accepted]
                found.append(spans.merged([(s["kind"], s["start"], s["end"]) for s in base], kept))
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f] for f in found]
            out = pa.array(rows, pa.list_(SPAN))
            plain = [batch.column(name) for name in plain_names]
            text, number = pa.array([spans.joined(f) for f in found], pa.string()), pa.array(map(len, found), pa.int64())
            yield pa.RecordBatch.from_arrays([*plain, text, number, out], names=[*plain_names, "spans", "n_spans", "found"])

    plain_names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    kinds = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return scanned.mapInArrow(
        decide, f"doc_id {id_type}, {kinds}, found array<struct<kind:string,start:int,end:int>>"
    )
