"""Anchors: places in a text that equal stretches of it share, wherever they stand; used inside tasks.

A start is a place from which SPAN bytes follow. Its anchor is the place of the least hash of GRAM
bytes within them, the first of several. The anchor depends on those bytes alone, so equal stretches
have the same gram at the same distance. Consecutive starts mostly share their anchor.
"""

import numpy as np

from roadwatch.llm.shingles import mix

SPAN = 400
GRAM = 64
WIDTH = SPAN - GRAM + 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
# Low bits of a sort key hold the place; a piece of text is below 2^30 bytes.
_PLACE = np.uint64((1 << 30) - 1)

_tables = {}


def _powers(base, count):
    held = _tables.get(int(base))
    if held is None or len(held) < count:
        filled = np.full(max(count, 1 << 16), base, np.uint64)
        filled[0] = 1
        with np.errstate(over="ignore"):
            held = np.cumprod(filled, dtype=np.uint64)
        _tables[int(base)] = held
    return held[:count]


def gram_hashes(data):
    """Hash of the GRAM bytes from each place that has so many."""
    count = len(data) - GRAM + 1
    if count <= 0:
        return np.array([], np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
        return mix((sums[GRAM:] - sums[:count]) * _powers(_INVERSE, count))


def _least_in_window(values, width):
    """Least of each run of `width` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


# Starts that are worked on at a time, so that a very long text needs no more memory than others.
STARTS = 2_000_000


def _places(data, bounds):
    """(text, start, anchor's place, hash) of each start, a bounded number of starts at a time."""
    for begin in range(0, len(data), STARTS):
        piece = data[begin : begin + STARTS + SPAN - 1]
        hashes = gram_hashes(piece)
        if len(hashes) < WIDTH:
            continue
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (_least_in_window(keys, WIDTH) & _PLACE).astype(np.int64)
        # Only starts whose SPAN bytes lie in one text.
        first = np.maximum(bounds[:-1] - begin, 0)
        counts = np.maximum(np.minimum(bounds[1:] - begin - SPAN + 1, len(place)) - first, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        starts = np.arange(len(text)) + np.repeat(first - (np.cumsum(counts) - counts), counts)
        yield text, starts + begin, place[starts] + begin, hashes[place[starts]]


def anchors(data, bounds):
    """Anchors of concatenated texts: (text, anchor's place, first start, last start, hash), as arrays.

    Places count from the beginning of `data`; `bounds` are the texts' ends, beginning with 0.
    """
    found = []
    for text, starts, place, hashes in _places(data, bounds):
        if len(starts):
            new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(starts)]]) - 1
            found.append((text[first], place[first], starts[first], starts[last], hashes[first]))
    if not found:
        return (np.array([], np.int64),) * 4 + (np.array([], np.uint64),)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))
