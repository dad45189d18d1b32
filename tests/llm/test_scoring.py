import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import edge_rows, prose, table

from roadwatch.llm import lattice, piece_model, scoring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MODEL = piece_model.parse(open(scoring.MODEL_PATH, "rb").read())


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def chance(word, chances, longest):
    """The sum over all spellings by plain recursion from the left, in ordinary numbers."""
    sums = [1.0]
    for end in range(1, len(word) + 1):
        sums.append(sum(sums[a] * chances.get(word[a:end], 0.0) for a in range(max(0, end - longest), end)))
    return sums


def brute(rows, rounds):
    names, weights = lattice.spellings(MODEL)
    longest = max(map(len, names))
    training = Counter(w.encode() for i, t, *_ in rows if not held_out(i) for w in words(t))
    end = sum(1 for i, *_ in rows if not held_out(i))
    prior = {n: w * len(names) * scoring.PRIOR for n, w in zip(names, weights.tolist(), strict=True)}
    prior[None] = scoring.PRIOR
    chances = {n: v / sum(prior.values()) for n, v in prior.items()}
    for _ in range(rounds):
        found = defaultdict(float, {None: end})
        for word, times in training.items():
            word = b" " + word
            left = chance(word, chances, longest)
            right = chance(word[::-1], {n[::-1]: c for n, c in chances.items() if n}, longest)[::-1]
            for a in range(len(word)):
                for b in range(a + 1, min(len(word), a + longest) + 1):
                    if word[a:b] in chances:
                        found[word[a:b]] += times * left[a] * chances[word[a:b]] * right[b] / left[-1]
        total = sum(found.values()) + sum(prior.values())
        chances = {n: (found[n] + v) / total for n, v in prior.items()}
    n_train, n_distinct = sum(training.values()) + end, len(training) + (end > 0)
    whole = n_train + 0.5 * (n_distinct + 1)
    out = []
    for i, text, *_ in rows:
        own = [w.encode() for w in words(text)]
        base = sum(math.log10((training[w] + 0.5) / whole) for w in own) + math.log10((end + 0.5) / whole)
        score = sum(math.log10(chance(b" " + w, chances, longest)[-1]) for w in own) + math.log10(chances[None])
        known = sum(training[w] > 0 for w in own) + (end > 0)
        out.append((i, held_out(i), len(own) + 1, known, n_train, base, score))
    return sorted(out, key=repr)


def check(result, rows, rounds):
    got = sorted((tuple(row) for row in result.collect()), key=repr)
    want = brute(rows, rounds)
    assert [row[:5] for row in got] == [row[:5] for row in want]
    # Expected numbers are kept in 65,536ths.
    for column, exact in ((5, 1e-12), (6, 1e-5)):
        assert [row[column] for row in got] == pytest.approx([row[column] for row in want], rel=exact)


def short(rows):
    return [row for row in rows if len(row[1] or "") < 3000]


@pytest.mark.parametrize("rounds", [0, 1])
def test_edge_cases(spark, rounds):
    rows = short(edge_rows()) + [(100 + i, prose(i % 7, 12), "en", "a") for i in range(20)]
    check(scoring.text_scores(table(spark, rows), rounds=rounds), rows, rounds)


def test_small_runs_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(scoring, "RUN_WORDS", 20)
    monkeypatch.setattr(scoring, "PACKED", 7)
    monkeypatch.setattr(scoring, "PIECE", 16)
    monkeypatch.setattr(scoring, "TOGETHER", 3)
    monkeypatch.setattr(scoring, "ANSWERS", 5)
    rows = short(edge_rows()) + [(100 + i, prose(i % 7, 12), "en", "a") for i in range(20)]
    check(scoring.text_scores(table(spark, rows).repartition(3), rounds=1), rows, 1)


def test_long_words_and_texts(spark):
    result = {row.doc_id: row for row in scoring.text_scores(table(spark, edge_rows()), rounds=1).collect()}
    assert len(edge_rows()) == sum(1 for _ in scoring.text_scores(table(spark, edge_rows()), rounds=1).collect())
    assert all(math.isfinite(row.score) and row.score < 0 for row in result.values())


def test_no_rows(spark):
    assert scoring.text_scores(table(spark, edge_rows()).limit(0)).count() == 0


def test_long_strings_equal_short_ones(monkeypatch):
    names, weights = lattice.spellings(MODEL)
    reader = lattice.Lattice(names, np.log(weights))
    strings, times = [b" the" * 20 + b"xyz", b" a", b"\xff\x00" * 30], np.array([3, 1, 2])
    together = reader.read(strings, times)
    monkeypatch.setattr(lattice, "LONG", 0)
    monkeypatch.setattr(lattice, "WINDOW", 7)
    alone = reader.read(strings, times)
    assert together[0] == pytest.approx(alone[0])
    assert np.abs(together[1] - alone[1]).max() <= 2


def test_chances_add_up():
    """Over a tiny vocabulary the chances of all strings of a length equal those of their spellings."""
    names, logs = [b"a", b"b", b"ab"], np.log([0.3, 0.3, 0.2])
    strings = [bytes(s) for s in np.array(np.meshgrid(*[[97, 98]] * 4)).T.reshape(-1, 4).astype(np.uint8)]
    chances, _ = lattice.Lattice(names, logs).read(strings)
    # Spellings of four bytes: 0 to 2 pairs among single bytes.
    assert np.exp(chances).sum() == pytest.approx(0.6**4 + 3 * 0.2 * 0.6**2 + 0.2**2)


def test_estimation_helps_held_out_texts(spark):
    rows = [(i, prose(i, 40), "en", "a") for i in range(150)]
    before, after = (scoring.text_scores(table(spark, rows), rounds=r).filter("held_out").collect() for r in (0, 2))
    assert len(before) > 10
    assert sum(row.score for row in after) > sum(row.score for row in before)
