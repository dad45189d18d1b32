"""Runs: what one task has read, in compressed pieces that can be shuffled and merged."""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext


def pack(*arrays):
    """Whole-number arrays in one zstd frame."""
    arrays = [np.asarray(array, "<i8") for array in arrays]
    sizes = np.array([len(arrays), *map(len, arrays)], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in [sizes, *arrays]))


def unpack(frame):
    """The arrays of a frame."""
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "<i8")
    return np.split(flat[1 + flat[0] :], np.cumsum(flat[1 : flat[0]]))


def first_run():
    """The number of a task's first run; the ones after it follow. No two tasks share any."""
    return TaskContext.get().partitionId() << 32


def spread(array, sizes, picked):
    """The pieces of `array`, cut by `sizes`, that `picked` names, one after the other."""
    starts, lengths = (np.cumsum(sizes) - sizes)[picked], sizes[picked]
    ends = np.cumsum(lengths)
    steps = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
    return array[np.repeat(starts, lengths) + steps]


def sums(values, sizes):
    """The sum of each piece of `values`, cut by `sizes`; empty pieces have 0."""
    totals = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return totals[ends] - totals[ends - sizes]


def one_list(array):
    """An Arrow array as the only entry of a list column."""
    return pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
