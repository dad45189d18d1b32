"""All ways to spell a byte string with a vocabulary, weighed by unigram scores.

A lattice has the byte places of a string as nodes and each occurrence of a spelling as an arc. The
forward recursion adds up, in logarithms, the weights of all paths; with the backward one it tells how
often each spelling is expected. Many short strings are worked on together, place by place.
"""

import math

import numpy as np

from roadwatch.llm import piece_model

# Strings beyond this many bytes are worked on one by one, in windows of places.
LONG, WINDOW = 128, 100_000


def spellings(model):
    """Distinct byte strings of a model's pieces, and the weights of its scores, which add up to 1.

    Scores of a unigram model are logarithms of chances. Those of a BPE model only rank its pieces: the
    n-th gets the weight 1/n. Bytes for themselves come after all others, so that every string has a path.
    """
    found = {}
    names = zip(model.pieces, piece_model.piece_bytes(model), model.scores, model.kinds, strict=True)
    whole = [(score, text) for _, text, score, kind in names if kind in (piece_model.NORMAL, piece_model.USER_DEFINED)]
    whole.sort(key=lambda entry: (-entry[0], entry[1]))
    for n, (score, text) in enumerate(whole, 1):
        found[text] = found.get(text, 0.0) + (math.exp(score) if model.kind == piece_model.UNIGRAM else 1 / n)
    least = min(found.values(), default=1.0)
    for byte in range(256):
        found[bytes([byte])] = found.get(bytes([byte]), 0.0) + least
    weights = np.array(list(found.values()))
    return list(found), weights / weights.sum()


def _add(x, y):
    """The logarithm of the sum of two numbers given by theirs; the second is finite."""
    return y + math.log1p(math.exp(x - y)) if x < y else x + math.log1p(math.exp(y - x))


class Lattice:
    """The vocabulary as a tree of bytes, with the logarithm of each spelling's chance."""

    def __init__(self, names, logs):
        self.logs = np.asarray(logs)
        children, self.spelling, size = {}, [-1], 1
        for i, name in enumerate(names):
            node = 0
            for byte in name:
                key = node << 8 | byte
                node = children.get(key, 0)
                if not node:
                    node = children[key] = size
                    self.spelling.append(-1)
                    size += 1
            self.spelling[node] = i
        self.keys = np.array(sorted(children), np.int64)
        self.child = np.array([children[key] for key in self.keys.tolist()], np.int64)
        self.spelling = np.array(self.spelling)

    def arcs(self, flat, ends, begin=0, stop=None):
        """(place, length, spelling) of each spelling in `flat`; `ends`: where each place's string ends."""
        place = np.arange(begin, len(flat) if stop is None else stop)
        node, length, found = np.zeros(len(place), np.int64), 0, []
        while len(place):
            key = node << 8 | flat[place + length]
            spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[spot] == key
            place, node, length = place[there], self.child[spot[there]], length + 1
            spelled = self.spelling[node]
            full = spelled >= 0
            found.append((place[full], np.full(full.sum(), length), spelled[full]))
            more = place + length < ends[place]
            place, node = place[more], node[more]
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def read(self, strings, times=None):
        """Logarithms of the chances of byte strings; with `times`, also the expected number of each spelling.

        Expected numbers are added up as whole 65,536ths, so that their sum does not hang on any order.
        """
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        chances, expected = np.zeros(len(strings)), np.zeros(len(self.logs), np.int64)
        short = np.flatnonzero(sizes <= LONG)
        if len(short):
            own = None if times is None else times[short]
            chances[short], more = self._together(b"".join([strings[i] for i in short]), sizes[short], own)
            expected += more
        for i in np.flatnonzero(sizes > LONG):
            chances[i], more = self._alone(np.frombuffer(strings[i], np.uint8), None if times is None else int(times[i]))
            expected += more
        return chances, expected

    def _together(self, joined, sizes, times):
        flat = np.frombuffer(joined, np.uint8).astype(np.int64)
        string = np.repeat(np.arange(len(sizes)), sizes)
        begins = np.cumsum(sizes) - sizes
        place, length, spelled = self.arcs(flat, (begins + sizes)[string])
        # Each string has one node more than bytes.
        node, offset = place + string[place], place - begins[string[place]]
        order = np.lexsort((length, offset))
        place, node, length, spelled, offset = (a[order] for a in (place, node, length, spelled, offset))
        logs = self.logs[spelled]
        step = offset * (LONG + 1) + length
        cuts = np.flatnonzero(np.diff(step, prepend=-1, append=-1))
        steps = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        first = begins + np.arange(len(sizes))
        forward = np.full(len(flat) + len(sizes), -np.inf)
        forward[first] = 0.0
        for a, b in steps:
            to = node[a:b] + length[a:b]
            forward[to] = np.logaddexp(forward[to], forward[node[a:b]] + logs[a:b])
        chances, expected = forward[first + sizes], np.zeros(len(self.logs), np.int64)
        if times is not None:
            backward = np.full(len(forward), -np.inf)
            backward[first + sizes] = 0.0
            for a, b in reversed(steps):
                at = node[a:b]
                backward[at] = np.logaddexp(backward[at], logs[a:b] + backward[at + length[a:b]])
            share = np.exp(forward[node] + logs + backward[node + length] - chances[string[place]])
            np.add.at(expected, spelled, np.rint(share * times[string[place]] * 65536).astype(np.int64))
        return chances, expected

    def _alone(self, flat, times):
        """A long string: arcs are found window by window, only the nodes' figures are kept."""
        flat, n = flat.astype(np.int64), len(flat)
        ends, forward = np.broadcast_to(n, n), [-math.inf] * (n + 1)
        forward[0] = 0.0
        for begin in range(0, n, WINDOW):
            for place, length, _, log in self._sorted_arcs(flat, ends, begin):
                forward[place + length] = _add(forward[place + length], forward[place] + log)
        expected = np.zeros(len(self.logs), np.int64)
        if times is not None:
            backward = [-math.inf] * (n + 1)
            backward[n] = 0.0
            for begin in reversed(range(0, n, WINDOW)):
                for place, length, spelled, log in reversed(self._sorted_arcs(flat, ends, begin)):
                    value = log + backward[place + length]
                    backward[place] = _add(backward[place], value)
                    share = math.exp(min(forward[place] + value - forward[n], 0.0))
                    expected[spelled] += round(share * times * 65536)
        return forward[n], expected

    def _sorted_arcs(self, flat, ends, begin):
        place, length, spelled = self.arcs(flat, ends, begin, min(begin + WINDOW, len(flat)))
        order = np.lexsort((length, place))
        columns = (place[order], length[order], spelled[order], self.logs[spelled[order]])
        return list(zip(*(column.tolist() for column in columns), strict=True))
