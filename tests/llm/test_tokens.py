import random

import pytest
import sentencepiece
from cases import WORDS, edge_rows, table

from roadwatch.llm import piece_model
from roadwatch.llm.tokens import MODEL_PATH, Encoder, decode, encode


@pytest.fixture(scope="module")
def data():
    with open(MODEL_PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(data):
    return sentencepiece.SentencePieceProcessor(model_proto=data)


ODD = [
    "",
    " ",
    "  two  spaces ",
    "\n\nfoo\tbar\r\n",
    "▁x ▁",
    "日本語 テスト",
    "\U0001f642\U0001f642a",
    "<s> </s> <0x0A> <unk>",
    "aaaa" * 50,
    " " * 40,
    "é̀x",
    "\x00 \x01",
    "1234567890 3.14",
]


def test_parse(data, library):
    model = piece_model.parse(data)
    n = library.get_piece_size()
    assert model.pieces == [library.id_to_piece(i) for i in range(n)]
    assert model.scores == pytest.approx([library.get_score(i) for i in range(n)])
    assert (model.kind, model.byte_fallback, model.dummy_prefix, model.trim_spaces) == (piece_model.BPE, True, True, False)


def test_ids_equal_the_library(spark, library):
    pick = random.Random(4)
    texts = [*ODD, *["".join(pick.choice([*WORDS, " ", "\n", ",", "é", "ß", "  "]) for _ in range(200)) for _ in range(40)]]
    frame = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    result = {r["doc_id"]: r for r in encode(frame).collect()}
    for i, text in enumerate(texts):
        assert result[i]["ids"] == library.encode(text)
        assert result[i]["n_tokens"] == len(result[i]["ids"])
        assert result[i]["n_byte_tokens"] == sum(library.is_byte(t) for t in result[i]["ids"])
        assert result[i]["round_trip"]
    assert sum(r["parity"] for r in result.values()) >= len(texts) - 2


def test_ids_come_from_the_tokenizers_library(data, library, monkeypatch):
    """Parts that only the tokenizers library is asked for have its ids, those that it gets wrong the model's own."""
    encoder = Encoder(data)
    space, ids = piece_model.SPACE, encoder.core.encode(f"{piece_model.SPACE}the").ids
    got, same = encoder._compare([f"{space}the", f"{space}of"])
    assert got == [ids, library.encode("of")] and same == [True, True]
    whole = encoder.core

    class Wrong:
        def encode_batch_fast(self, parts, **more):
            found = whole.encode_batch_fast(parts, **more)
            return [type("Ids", (), {"ids": e.ids if i else [0]}) for i, e in enumerate(found)]

    encoder.core = Wrong()
    got, same = encoder._compare([f"{space}the", f"{space}of"])
    assert got == [ids, library.encode("of")] and same == [False, True]


def test_twin_of_whole_texts(data, library):
    """The rebuilt tokenizer, normaliser and marker included, without any cutting of ours."""
    twin = piece_model.backend(piece_model.parse(data))
    texts = [t for t in ODD if t.strip(" ")]
    assert [e.ids for e in twin.encode_batch(texts, add_special_tokens=False)] == [library.encode(t) for t in texts]


def test_forgetting_changes_nothing(data, library, monkeypatch):
    monkeypatch.setattr("roadwatch.llm.tokens.REMEMBERED", 5)
    encoder = Encoder(data)
    for begin in range(0, 60, 6):
        batch = [" ".join(WORDS[k % len(WORDS)] + str(k) for k in range(b, b + 9)) for b in range(begin, begin + 6)]
        ids, counts, _, whole = encoder.encode_checked(batch)
        assert ids.tolist() == [i for t in batch for i in library.encode(t)]
        assert counts.tolist() == [len(library.encode(t)) for t in batch] and whole.all()


@pytest.mark.parametrize("limit", [1, 7, 50])
def test_long_texts_are_worked_on_in_runs(data, library, monkeypatch, limit):
    monkeypatch.setattr("roadwatch.llm.tokens.LONGEST_RUN", limit)
    encoder = Encoder(data)
    texts = [*ODD, " ".join(WORDS * 4), "\n".join(WORDS * 3), "x" * 200, "a  b   c\n\n d" * 9]
    ids, counts, _, whole = encoder.encode_checked(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode(t)]
    assert counts.tolist() == [len(library.encode(t)) for t in texts] and whole.all()


def test_decode(spark):
    frame = table(spark, edge_rows())
    texts = sorted(((r["doc_id"], r["text"]) for r in decode(encode(frame)).collect()), key=repr)
    assert texts == sorted(((r[0], r[1] or "") for r in edge_rows()), key=repr)
    missing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in decode(missing).collect()) == [(1, None), (2, "")]


def varint(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def unigram_model():
    """A tiny unigram model file with byte fallback, written by hand."""
    import struct

    def piece(text, score, kind):
        raw = text.encode()
        body = b"\x0a" + varint(len(raw)) + raw + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind)
        return b"\x0a" + varint(len(body)) + body

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("▁a", -3.5, 1), ("ab", -4.0, 1), ("▁ab", -5.2, 1), ("ba", -4.4, 1)]
    trainer = b"\x18\x01" + varint(35 << 3) + b"\x01"
    normal = b"\x0a\x08identity" + b"\x18\x01" + b"\x20\x00" + b"\x28\x01"
    body = b"".join(piece(*p) for p in pieces)
    return body + b"\x12" + varint(len(trainer)) + trainer + b"\x1a" + varint(len(normal)) + normal


def test_unigram_scores(spark, tmp_path):
    data = unigram_model()
    (tmp_path / "u.model").write_bytes(data)
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab ba", "abba abab a b", "x ab", "", "aé b"]
    frame = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    result = {r["doc_id"]: r for r in encode(frame, str(tmp_path / "u.model")).collect()}
    assert [result[i]["ids"] for i in range(len(texts))] == [own.encode(t) for t in texts]
    assert all(r["round_trip"] and r["parity"] for r in result.values())
