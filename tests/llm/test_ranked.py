import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import edge_rows, prose, table

from roadwatch.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, limit=10):
    bags = [(i, Counter(terms(text))) for i, text in documents]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            score = 0
            for term in terms(text):
                if bag[term]:
                    df = sum(1 for _, b in bags if b[term])
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 100 - 75 + 75 * sum(bag.values()) * n_docs // n_terms
                    score += weight * (1000000000 * bag[term] // (1000 * bag[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:limit], 1):
            out.append((item_id, rank, None if missing else doc_id, -score))
    return sorted(out, key=repr)


def found(spark, documents, items, **more):
    left = table(spark, [(i, text, "en", "a") for i, text in documents])
    right = spark.createDataFrame([(*item, "x", 1) for item in items], "item_id long, text string, rank string, doc_id int")
    result = ranked.ranked_documents(left, right, **more)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(row) for row in result.collect()), key=repr)


ITEMS = [
    (1, prose(1)[:200]), (2, None), (3, ""), (4, "the THE of zzz"), (5, prose(1003, 300, 10)), (5, "日本語 Ünï x_y"),
    (None, prose(6)), (8, "!!"),
]


@pytest.mark.parametrize("limit", [1, 3, 10])
def test_edge_cases(spark, limit):
    documents = [row[:2] for row in edge_rows()]
    assert found(spark, documents, ITEMS, limit=limit) == brute(documents, ITEMS, limit)


def test_small_blocks_segments_and_tables(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 400)
    monkeypatch.setattr(ranked, "SEGMENT_DOCS", 3)
    monkeypatch.setattr(ranked, "TABLE", 40)
    monkeypatch.setattr(ranked, "PIECE", 64)
    documents = [row[:2] for row in edge_rows()] + [(100 + i, prose(i % 40, 40)) for i in range(120)]
    assert found(spark, documents, ITEMS) == brute(documents, ITEMS)


def test_ties_and_many_copies(spark):
    documents = [(i, "alpha beta" if i % 2 else "alpha gamma gamma") for i in range(300, 0, -1)]
    documents += [(i, prose(i, 30)) for i in range(400, 1000)]
    items = [(1, "alpha"), (2, "gamma beta alpha beta"), (3, prose(400, 30))]
    assert found(spark, documents, items) == brute(documents, items)


def test_no_rows(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, [(1, "the end")], []) == []


def test_mask_groups():
    held = np.random.default_rng(1).random((130, 500)) < 0.01
    first, group = ranked.mask_groups(held)
    assert (held[:, first[group]] == held).all()
    assert len(first) == len({column.tobytes() for column in held.T})


def test_bounds_stop_early(spark, monkeypatch):
    """Few documents are scored in full when some are far better than the rest."""
    scored, whole = [], ranked.impact

    def counted(tf, m):
        scored.append(np.size(tf))
        return whole(tf, m)

    monkeypatch.setattr(ranked, "impact", counted)
    rng = np.random.default_rng(2)
    tfs = (rng.random((20, 4000)) < 0.2).astype(np.int64)
    tfs[:, :10] = 3
    best = ranked.Best(10)
    ranked._rank_block(tfs, np.arange(1, 21), np.full(4000, 50), tfs.max(axis=1), list(range(4000)), best)
    assert [doc for _, doc in best.rows] == list(range(10))
    assert sum(scored[2:]) < tfs.size / 10
