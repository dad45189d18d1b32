import bisect
import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import sentencepiece
from cases import edge_rows, plain, prose, table
from tokenizers import Tokenizer

from roadwatch.llm import align, piece_model

PIECE = open(align.PIECE_PATH, "rb").read()
BYTE = open(align.BYTE_PATH, "rb").read()


@pytest.fixture(scope="module")
def sides():
    whole = Tokenizer.from_file(align.BYTE_PATH)
    whole.encode_special_tokens = True
    names = piece_model.piece_bytes(piece_model.parse(PIECE))
    return whole, sentencepiece.SentencePieceProcessor(model_proto=PIECE), names


def groups(sides, text):
    """Whole text by whole text, token by token."""
    whole, piece, names = sides
    if not text:
        return []
    raw = (" " + text).encode()
    back = align._printed_bytes()
    a = [(i, bytes(back[c] for c in whole.id_to_token(i))) for i in whole.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, names[i]) for i in piece.encode(text)]
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return []
    ends = []
    for side in (a, b):
        at, found = 0, []
        for i, token in side:
            at += len(token)
            found.append((at, i))
        ends.append(found)
    common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    out = [([], []) for _ in common]
    for side, found in enumerate(ends):
        for end, i in found:
            out[bisect.bisect_left(common, end)][side].append(i)
    return out


def brute(sides, rows):
    links = [Counter((a, b) for left, right in groups(sides, t) for a in left for b in right) for _, t, *_ in rows]
    counts = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, text, *_), found in zip(rows, links, strict=True):
        own = groups(sides, text)
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((
            doc_id, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(found.values()),
            sum(n for pair, n in found.items() if counts[pair] == most[pair[0]]),
            sum(n * counts[pair] for pair, n in found.items()), sha256(written.encode()).hexdigest() if own else "",
        ))
    return sorted(out, key=repr)


ODD = [
    " leading", "one ", "▁ ",  "trailing  ", "  ", "a  b   c\t\n d", "x<|endoftext|>y <s> </s> <unk> <0x41>", "▁ marker", "a▁b",
    "l'été d'où", "12345 67,8", "\U0001f642\U0001f642", "日本語のテキスト", "a\x00b", "word\x1c next\x85 z\xa0w", "﻿bom",
    "don't we'll", "x" * 300, "= = = ===", "ａｂｃ ﬁ Ⅳ", "​zero 　wide", "é combining", "\r\n\r\n \r",
]


def rows_of(texts):
    return [(i, text, "en", "a") for i, text in enumerate(texts)]


def test_edge_cases(spark, sides):
    rows = edge_rows() + [(100 + i, text, None, "a") for i, text in enumerate(ODD)]
    result = align.token_alignment(table(spark, rows))
    assert result.columns[-3:] == ["n_best", "count_sum", "groups_sha256"]
    assert plain(result) == brute(sides, rows)


def test_small_runs_windows_and_groups(spark, sides, monkeypatch):
    """Runs, windows and radixes that end all the time, and groups counted by distinct ids."""
    monkeypatch.setattr(align, "RUN_PARTS", 30)
    monkeypatch.setattr(align, "WINDOW", 50)
    monkeypatch.setattr(align, "WIDE_GROUP", 2)
    monkeypatch.setattr(align, "HELD", 3)
    monkeypatch.setattr(align, "LONG_WORD", 6)
    rows = edge_rows()[:6] + rows_of(prose(i % 25, 40) for i in range(60)) + rows_of(ODD)
    rows = [row for row in rows if len(row[1] or "") < 1000]
    assert plain(align.token_alignment(table(spark, rows).repartition(3))) == brute(sides, rows)


def test_one_pair_in_all_documents(spark, sides):
    rows = rows_of(["the same words here"] * 200 + [f"the word{i}" for i in range(100)])
    assert plain(align.token_alignment(table(spark, rows))) == brute(sides, rows)


def test_no_rows(spark):
    assert align.token_alignment(table(spark, edge_rows()).limit(0)).count() == 0


def test_parts_are_encoded_as_in_whole_texts(sides):
    """Random mixes of characters: cutting and the quick encoder change no id."""
    both, pick = align.Tokenizers(BYTE, PIECE), random.Random(5)
    assert both.in_parts and both.quick
    alphabet = ["  ", " ", " ", "\n", "\t", "\x1c", "\xa0", "'s", "'ll", "ab", "the", "E", "9", "...", "é", "日", "▁", "_", "-"]
    for _ in range(2000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 30)))
        found = both.encode(align.CUT.split(" " + text))
        assert [i for ids in found[0] for i in ids] == sides[0].encode(" " + text, add_special_tokens=False).ids
        assert [i for ids in found[1] for i in ids] == sides[1].encode(text)
