"""Two-stage suffix sorting of many short strings at once; used inside tasks.

Suffixes smaller than their successors are sorted directly. All others follow by scanning the
buckets of first bytes in order: the predecessor of a suffix, if larger, takes the next free
place in its own bucket. Suffixes are compared by their first SPAN bytes.
"""

import numpy as np

from roadwatch.llm.anchors import SPAN

# A byte that UTF-8 never has, larger than all it has, ends each string.
END = b"\xff"


def smaller_than_successor(data):
    """For each place but the last whether its suffix is smaller than the next one."""
    step = data[1:].astype(np.int16) - data[:-1]
    # In a run of one byte what follows the run decides.
    places = np.arange(len(step))
    deciding = np.where(step != 0, places, len(step))
    deciding = np.minimum.accumulate(deciding[::-1])[::-1]
    padded = np.append(step, 1)
    return padded[deciding] > 0


def with_successors(wanted, smaller):
    """Wanted places and those after them up to the first that can be sorted directly."""
    member = np.zeros(len(smaller) + 1, bool)
    member[wanted] = True
    edge = wanted
    while len(edge):
        edge = edge[~smaller[edge]] + 1
        edge = edge[~member[edge]]
        member[edge] = True
    return member


def _sorted_directly(raw, data, places):
    """Places in the order of their suffixes, bucket by bucket of the first two bytes."""
    if not len(places):
        return places
    head = data[places].astype(np.int32) * 256 + data[np.minimum(places + 1, len(data) - 1)]
    places = places[np.argsort(head, kind="stable")]
    head.sort()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(head)) + 1, [len(places)]])
    out = []
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        bucket = places[begin:end].tolist()
        if len(bucket) > 1:
            keys = [raw[p : p + SPAN] for p in bucket]
            bucket = [bucket[k] for k in sorted(range(len(bucket)), key=keys.__getitem__)]
        out.append(bucket)
    return np.array([p for bucket in out for p in bucket], np.int64)


def sort_suffixes(raw, wanted):
    """The wanted places of `raw` in the order of their suffixes.

    `raw` is a concatenation of strings, each ended by END; `wanted` are places in them.
    """
    data = np.frombuffer(raw, np.uint8)
    smaller = np.append(smaller_than_successor(data), True)
    member = with_successors(wanted, smaller)[: len(data)]
    direct = _sorted_directly(raw, data, np.flatnonzero(member & smaller))
    first = data[direct]
    bounds = np.searchsorted(first, np.arange(257))
    larger = member & ~smaller
    waiting = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        induced = waiting[byte]
        if not induced and bounds[byte] == bounds[byte + 1]:
            continue
        # Inside the bucket a suffix may bring in its predecessor of the same byte, after all before it.
        done = 0
        while done < len(induced):
            before = induced[done] - 1
            before = before[(before >= 0)]
            before = before[larger[before] & (data[before] == byte)]
            if len(before):
                induced.append(before)
            done += 1
        bucket = np.concatenate([*induced, direct[bounds[byte] : bounds[byte + 1]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (data[before] > byte)]
        if len(before):
            before = before[np.argsort(data[before], kind="stable")]
            cuts = np.flatnonzero(np.diff(data[before])) + 1
            for run in np.split(before, cuts):
                waiting[data[run[0]]].append(run)
    chosen = np.zeros(len(data), bool)
    chosen[wanted] = True
    full = np.concatenate(order) if order else np.array([], np.int64)
    return full[chosen[full]]


def shared_spans(raw, order):
    """Whether each suffix of the order has its first SPAN bytes in common with a neighbour.

    All wanted suffixes have as many bytes before their string's end.
    """
    shared = np.zeros(len(order), bool)
    if len(order) < 2:
        return shared
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), 8)
    equal = np.arange(len(order) - 1)
    # Eight bytes at a time; pairs drop out with the first difference.
    for offset in range(0, SPAN, 8):
        left = windows[order[equal] + offset].copy().view(np.uint64).ravel()
        right = windows[order[equal + 1] + offset].copy().view(np.uint64).ravel()
        equal = equal[left == right]
        if not len(equal):
            break
    shared[equal] = True
    shared[equal + 1] = True
    return shared
