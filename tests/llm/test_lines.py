import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import edge_rows, prose, table

from roadwatch.llm import line_chunks
from roadwatch.llm.line_chunks import chunks, line_report, rolled, windows, without_repeated_chunks


def runs(lines, longest=24):
    """Every run of up to so many lines, from one with words to one with words, of eight words; by its bytes."""
    for start in range(len(lines)):
        for end in range(start + 2, min(start + longest, len(lines)) + 1):
            held = [line for line in lines[start:end] if line.split()]
            if held and held[0] is lines[start] and held[-1] is lines[end - 1] and len(held) >= 2 and sum(max(len(line.split()), len(line) // 12) for line in held) >= 8:
                yield start, end, b"\n".join(lines[start:end])


def brute(rows, longest=24):
    """A line goes if a run that holds it stands earlier, by id (NULL first), Spark's hash of the text, and line."""
    texts = {(i is not None, i or 0, np.int64(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42))), t or "") for i, t, *_ in rows}
    seen, removed = set(), {}
    for known, i, _, text in sorted(texts):
        lines, gone = text.encode().split(b"\n"), set()
        for start, end, piece in runs(lines, longest):
            if piece in seen:
                gone.update(range(start, end))
            seen.add(piece)
        removed[known, i, text] = gone
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        gone = removed[i is not None, i or 0, text or ""]
        kept = "\n".join(line for n, line in enumerate(lines) if n not in gone)
        out.append((i, len(lines) if text else 0, len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def report(frame):
    return sorted((tuple(r) for r in line_report(frame).collect()), key=repr)


def shared_passages():
    """Documents with passages of many lines at other places, and copies."""
    passage, other = prose(500, 200, 20), prose(501, 100, 10)
    rows = []
    for i in range(40):
        own = prose(600 + i, 60, 1 + i % 9)
        parts = [own, passage] if i % 3 == 0 else [passage, own, other] if i % 3 == 1 else [own]
        rows.append((i, "\n".join(parts), "en", "a"))
    rows += [(100 + i, rows[0][1], "en", "a") for i in range(5)]
    return rows


def test_against_brute_force(spark):
    rows = shared_passages()
    want = brute(rows)
    assert report(table(spark, rows)) == want
    assert sum(r[2] for r in want) > 300


def test_edge_cases(spark):
    rows = edge_rows()
    assert report(table(spark, rows)) == brute(rows)


@pytest.mark.parametrize("n_lines", [2, 3, 4, 5, 8, 12, 20])
def test_every_short_passage_goes(spark, n_lines):
    """Passages of lines of eight words, each in the middle of two otherwise different documents."""
    rows = []
    for i in range(60):
        passage = prose(10_000 + i, 8 * n_lines, n_lines)
        rows.append((i, "\n".join([prose(2 * i, 40, 4), passage, prose(2 * i + 1, 40, 4)]), "en", "a"))
        rows.append((100 + i, "\n".join([prose(5000 + i, 60, 5), passage, prose(6000 + i, 30, 3)]), "en", "a"))
    result = {r["doc_id"]: r for r in without_repeated_chunks(table(spark, rows)).collect()}
    for i, text, *_ in rows:
        lines = text.split("\n")
        left = lines if i < 100 else lines[:5] + lines[5 + n_lines :]
        assert result[i]["text"].split("\n") == left


def test_short_blank_and_unspaced_lines(spark):
    """Runs of few lines out of a small alphabet: blank lines, single words, long words without spaces."""
    pick = random.Random(3)
    choices = ["", " ", "one", "two words", "a line of five words here", "\u65e5\u672c\u8a9e" * 12, "the same line again and again"]
    rows = [(i, "\n".join(pick.choice(choices) + pick.choice(["", "", "!"]) for _ in range(pick.randint(1, 9))), "en", "a") for i in range(80)]
    assert report(table(spark, rows)) == brute(rows)


def test_windows_cover_every_run():
    pick = random.Random(5)
    for _ in range(300):
        sizes = np.array([pick.choice([0, 1, 1, 2, 5, 9]) for _ in range(pick.randint(1, 14))])
        found = list(zip(*(side.tolist() for side in windows(sizes)), strict=True))
        assert all((sizes[s:e] > 0).sum() >= 2 and sizes[s:e].sum() >= 8 for s, e in found)
        for start in range(len(sizes)):
            for end in range(start + 2, len(sizes) + 1):
                if (sizes[start:end] > 0).sum() >= 2 and sizes[start:end].sum() >= 8:
                    covered = {n for s, e in found if start <= s and e <= end for n in range(s, e)}
                    assert covered >= {n for n in range(start, end) if sizes[n]}


def test_different_chunks_of_one_hash(spark):
    """With a hash that tells nothing apart the bytes decide."""
    rows = shared_passages()
    listed = table(spark, rows)
    keyed = line_chunks._keyed(line_chunks.texts(listed)).collect()
    made = []
    for k in keyed:
        lines = k["text"].encode().split(b"\n")
        for s, e in zip(*(side.tolist() for side in chunks(k["text"].encode())[:2]), strict=True):
            weak = bytes([len(b"\n".join(lines[s:e])) % 2]) * 16
            made.append((k["doc_id"], k["key_1"], k["key_2"], s, e, bytearray(weak)))
    layout = "doc_id long, key_1 long, key_2 long, start int, end int, digest binary"
    removed = line_chunks.later_occurrences(line_chunks.texts(listed), spark.createDataFrame(made, layout))
    got = defaultdict(set)
    for r in removed.collect():
        got[r["doc_id"]].update(range(r["start"], r["end"]))
    assert {i: len(n) for i, n in got.items()} == {r[0]: r[2] for r in brute(rows) if r[2]}


def test_rolling_hashes_shift_with_the_text():
    hashes = np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)
    starts, ends = np.arange(490), np.arange(490) + 2 + np.arange(490) % 8
    plain = rolled(hashes, starts, ends)
    for lead in (1, 2, 7):
        shifted = rolled(np.concatenate([hashes[-lead:], hashes]), starts + lead, ends + lead)
        assert shifted == plain
    assert len({plain[i : i + 16] for i in range(0, len(plain), 16)}) == 490


def test_other_columns_and_unchanged_texts(spark):
    frame = table(spark, edge_rows())
    result = without_repeated_chunks(frame)
    assert result.columns == [c for c in frame.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert result.filter("doc_id = 2").first()["text"] is None
