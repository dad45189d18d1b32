"""Sets of word shingles as 64-bit hashes, for whole batches of texts at a time; used inside tasks."""

import numpy as np

WORDS_PER_SHINGLE = 5

# White space of the word rule: space, and tab to carriage return.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(values):
    """Spread 64-bit values: the finaliser of a common hash family, a bijection."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _powers(base, count):
    powers = np.full(count, base, np.uint64)
    powers[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(powers, dtype=np.uint64)


def word_hashes(data, bounds):
    """Hash of each word of lower-cased bytes, and each text's number of words.

    `bounds` are the texts' ends in `data`, beginning with 0. A word's hash is a polynomial of
    its bytes, a difference of running sums that is shifted to the word's end, and its length.
    """
    if not len(data):
        return np.array([], np.uint64), np.zeros(len(bounds) - 1, np.int64)
    inside = ~_BLANK[data]
    # A text's end also ends a word.
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    lowered = _LOWER[data]
    # Words are short: one step per place in a word, over the words that are as long.
    left = np.arange(len(starts))
    with np.errstate(over="ignore"):
        place = 0
        while len(left):
            hashes[left] = hashes[left] * _BASE + lowered[starts[left] + place].astype(np.uint64) + np.uint64(1)
            place += 1
            left = left[lengths[left] > place]
            if place >= 64 and len(left):
                for word in left.tolist():
                    value = int(hashes[word])
                    for byte in lowered[starts[word] + place : ends[word]].tolist():
                        value = (value * int(_BASE) + byte + 1) & 0xFFFFFFFFFFFFFFFF
                    hashes[word] = value
                break
    first = np.searchsorted(starts, bounds)
    return mix(hashes ^ lengths.astype(np.uint64)), np.diff(first)


def shingle_sets(data, bounds):
    """Per text a sorted array of distinct shingle hashes: (flat hashes, ends beginning with 0).

    A text with fewer words than a shingle has its whole sequence as one; one without words none.
    """
    words, counts = word_hashes(data, bounds)
    n = WORDS_PER_SHINGLE
    first = np.concatenate([[0], np.cumsum(counts)])
    parts, ends = [], [0]
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            rolled = rolled * _SHINGLE_BASE + words[k : k + len(rolled)]
        rolled = mix(rolled)
        for i, count in enumerate(counts.tolist()):
            begin = first[i]
            if count >= n:
                parts.append(np.unique(rolled[begin : begin + count - n + 1]))
            elif count:
                value = np.uint64(count)
                for word in words[begin : begin + count]:
                    value = value * _SHINGLE_BASE + word
                parts.append(mix(np.array([value], np.uint64)))
            ends.append(ends[-1] + (len(parts[-1]) if count else 0))
    flat = np.concatenate(parts) if parts else np.array([], np.uint64)
    return flat, np.array(ends, np.int64)


def signatures(flat, ends, n_coordinates, seed=0):
    """Minwise tokens: per text, coordinate j is the least of the set's hashes under function j."""
    counts = np.diff(ends)
    rows = np.flatnonzero(counts)
    out = np.zeros((len(counts), n_coordinates), np.uint64)
    if not len(rows):
        return out
    starts = ends[:-1][rows]
    keys = mix(np.arange(1, n_coordinates + 1, dtype=np.uint64) + np.uint64(seed * 1000003))
    with np.errstate(over="ignore"):
        for j in range(n_coordinates):
            value = (flat ^ keys[j]) * (keys[j] | np.uint64(1))
            value ^= value >> np.uint64(32)
            out[rows, j] = np.minimum.reduceat(value * _BASE, starts)
    return out
