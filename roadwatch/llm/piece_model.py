"""A SentencePiece model file, rebuilt for the tokenizers library.

The file is a protobuf message. Only its wire format is read here: numbered
fields that hold a whole number, a float or bytes. The field numbers are the public ones
of the format.
"""

import struct
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

SPACE = "▁"

# Fixed values of the model format: kinds of a piece, kinds of a model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    pieces: list = field(default_factory=list)
    scores: list = field(default_factory=list)
    kinds: list = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self):
        return self.kinds.index(UNKNOWN)


def _varint(data, at):
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data):
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = struct.unpack("<d" if wire == 1 else "<f", data[at : at + size])[0], at + size
        else:
            raise ValueError(f"not a SentencePiece model: wire type {wire}")
        yield number, value


def parse(data):
    """The parts of a model file that encoding needs."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(piece.get(1, b"").decode())
            model.scores.append(piece.get(2, 0.0))
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.char_map = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.trim_spaces = bool(spec.get(4, 1))
            model.escape_spaces = bool(spec.get(5, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


class Joints:
    """Which characters a piece has next to each other; between all others texts can be cut.

    What holds for every piece holds for every merge and every path, so the parts between cuts
    can be encoded apart.
    """

    def __init__(self, model):
        kinds = zip(model.pieces, model.kinds, strict=True)
        pieces = [piece for piece, kind in kinds if kind in (NORMAL, USER_DEFINED)]
        alphabet = sorted({c for piece in pieces for c in piece})
        self.classes = np.zeros(0x110001, np.int16)
        numbers = {c: i for i, c in enumerate(alphabet, 1)}
        for c, i in numbers.items():
            self.classes[ord(c)] = i
        self.size = len(alphabet) + 1
        self.joined = np.zeros(self.size * self.size, bool)
        for piece in pieces:
            for left, right in pairwise(piece):
                self.joined[numbers[left] * self.size + numbers[right]] = True
        # A character of no piece stands alone; after it nothing depends on what was before.
        self.stranger = next((c for c in "\n\t\x01\ufffe" if c not in numbers), None)

    def cuts(self, points):
        """For code points, whether a part begins at each; the first always does."""
        begins = np.ones(len(points), bool)
        if len(points) > 1:
            kinds = self.classes[points].astype(np.int32)
            begins[1:] = ~self.joined[kinds[:-1] * self.size + kinds[1:]]
        return begins


def cuts_at_spaces(model):
    """Whether no piece goes on after a character with a space."""
    return not any(SPACE in piece.lstrip(SPACE) for piece in model.pieces)


def _merges(model, ids):
    """All ways to join two pieces into a third, in the order in which the model prefers them."""
    joinable = {p for p, kind in zip(model.pieces, model.kinds, strict=True) if kind in (NORMAL, USER_DEFINED)}
    for piece in sorted(joinable, key=lambda p: -model.scores[ids[p]]):
        for cut in range(1, len(piece)):
            if piece[:cut] in joinable and piece[cut:] in joinable:
                yield piece[:cut], piece[cut:]


def normalizer(model):
    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.trim_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if model.escape_spaces else " "))
    return normalizers.Sequence(steps)


def core(model):
    """The model alone as a tokenizer, for text that is normalised already."""
    ids = {piece: i for i, piece in enumerate(model.pieces)}
    if model.kind == UNIGRAM:
        scored = list(zip(model.pieces, model.scores, strict=True))
        return Tokenizer(models.Unigram(scored, unk_id=model.unknown, byte_fallback=model.byte_fallback))
    merges = list(_merges(model, ids))
    unknown = model.pieces[model.unknown]
    # Callers remember parts themselves; the library's cache would stay with its threads.
    bpe = models.BPE(ids, merges, unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback, cache_capacity=0)
    return Tokenizer(bpe)


def backend(model):
    """The tokenizers-library twin of the model; parts are split before spaces where that is exact."""
    twin = core(model)
    twin.normalizer = normalizer(model)
    if cuts_at_spaces(model):
        twin.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    return twin


def piece_bytes(model):
    """What each id stands for, as bytes: spaces for markers, nothing for control pieces."""
    texts = []
    for piece, kind in zip(model.pieces, model.kinds, strict=True):
        if kind == BYTE:
            texts.append(bytes([int(piece[3:5], 16)]))
        elif kind == CONTROL:
            texts.append(b"")
        elif kind == UNKNOWN:
            texts.append(" ⁇ ".encode())
        else:
            texts.append(piece.replace(SPACE, " ").encode())
    return texts
