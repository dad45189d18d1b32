import hashlib
import random

import numpy as np
import pytest
from cases import edge_rows, prose, table

from roadwatch.llm.anchors import SPAN, anchors
from roadwatch.llm.suffix_sort import END, shared_spans, smaller_than_successor, sort_suffixes
from roadwatch.llm.suffixes import byte_report


def brute(rows):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = {}
    for _, text in texts:
        for s in range(len(text) - SPAN + 1):
            seen[text[s : s + SPAN]] = seen.get(text[s : s + SPAN], 0) + 1
    out = []
    for i, text in texts:
        gone = np.zeros(len(text) + 1, np.int32)
        for s in range(len(text) - SPAN + 1):
            if seen[text[s : s + SPAN]] > 1:
                gone[s] += 1
                gone[s + SPAN] -= 1
        gone = np.cumsum(gone)[: len(text)] > 0
        spans = int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def report(frame, **more):
    return sorted((tuple(r) for r in byte_report(frame, **more).collect()), key=repr)


def planted():
    passage, other, short = prose(1, 160, 1), prose(2, 90, 1), prose(3, 50, 1)[: SPAN - 1]
    rows = []
    for i in range(30):
        own, more = prose(100 + i, 80 + i, 3), prose(200 + i, 40, 2)
        parts = [[own, passage, more], [passage, own], [own, other, passage], [own, short, more], [own]][i % 5]
        rows.append((i, " ".join(parts), "en", "a"))
    rows += [(40, passage + passage, "en", "a"), (41, "é" * 900, "en", "a"), (42, "ab" * 700, "en", "a"), (43, "ha " * 500, "en", "a")]
    rows += [(50 + i, rows[4][1], "en", "a") for i in range(3)]
    rows += [(60, prose(9, 200, 1), "en", "a"), (61, "x" + prose(9, 200, 1)[: SPAN - 1] + "y", "en", "a")]
    return rows


@pytest.mark.parametrize("crowded", [20_000, 3, 0])
def test_against_brute_force(spark, crowded):
    """The same with anchors that no task may hold."""
    want = brute(planted())
    assert report(table(spark, planted()), crowded=crowded) == want
    assert sum(r[2] for r in want) > 10_000


def test_long_texts_are_worked_on_in_pieces(monkeypatch):
    """The same anchors, but that a run of starts may be cut at a piece's edge."""
    texts = [prose(i, 300, 1).encode() for i in range(5)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)

    def per_start():
        return {
            s: (t, p, g) for t, p, a, b, g in zip(*(x.tolist() for x in anchors(data, bounds)), strict=True) for s in range(a, b + 1)
        }

    whole = per_start()
    monkeypatch.setattr("roadwatch.llm.anchors.STARTS", 700)
    assert per_start() == whole
    assert len(whole) == sum(len(t) - SPAN + 1 for t in texts)


def test_edge_cases(spark):
    assert report(table(spark, edge_rows())) == brute(edge_rows())


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc", b"abcdefgh", b"\xc3\xa9a"])
def test_suffix_order(alphabet):
    pick = random.Random(alphabet)
    for _ in range(8):
        parts = [bytes(pick.choice(alphabet) for _ in range(pick.randint(SPAN, SPAN + 60))) for _ in range(6)]
        raw = END.join([*parts, b""])
        inside = [p for p in range(len(raw)) if 255 not in raw[p : p + SPAN] and p + SPAN <= len(raw)]
        wanted = np.array([p for p in inside if pick.random() < 0.8], np.int64)
        order = sort_suffixes(raw, wanted)
        assert sorted(order.tolist()) == wanted.tolist()
        strings = [raw[p : p + SPAN] for p in order]
        assert strings == sorted(strings)
        near = [strings.count(s) > 1 for s in strings]
        assert shared_spans(raw, order).tolist() == near


def test_only_smaller_suffixes_are_sorted_directly():
    data = np.frombuffer(b"banana\xff", np.uint8)
    assert smaller_than_successor(data).tolist() == [b"banana\xff"[i:] < b"banana\xff"[i + 1 :] for i in range(6)]


def test_equal_stretches_have_equal_anchors():
    passage = prose(5, 200, 1).encode()
    texts = [prose(i, 50, 1).encode() + passage + prose(50 + i, 70, 1).encode() for i in range(4)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, place, first, last, gram = anchors(np.frombuffer(b"".join(texts), np.uint8), bounds)
    per_start = {}
    for t, p, a, b, g in zip(text, place, first, last, gram, strict=True):
        for s in range(a, b + 1):
            string = b"".join(texts)[s : s + SPAN]
            assert len(string) == SPAN and s + SPAN <= bounds[t + 1]
            per_start.setdefault(string, set()).add((p - s, g))
    assert len(per_start) < (last - first + 1).sum()
    assert all(len(found) == 1 for found in per_start.values())
