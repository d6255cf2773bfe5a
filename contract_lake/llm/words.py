"""Words of whole Arrow columns: distinct ones once, their occurrences as
numbers, so that per-word work is done once a batch and per-occurrence work is
numpy's."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are looked up together.
TOGETHER = 4 << 20
#: A space between words, with nothing but one-byte signs behind it.
CUT_AT = re.compile(rb"(?<=[^ ]) (?=[!-~])")
#: How far back from a cut's latest place it is looked for.
BACK = 1 << 16


def _cut(octets: bytes, at: int, size: int) -> int:
    """Where to cut a text's bytes, at a space between words: the last place
    within ``size`` bytes from ``at``, or the first beyond, or the end."""
    if len(octets) - at <= size:
        return len(octets)
    end = -1
    for found in CUT_AT.finditer(octets, max(at + 1, at + size - BACK), at + size):
        end = found.start()
    if end < 0:
        found = CUT_AT.search(octets, at + size - 1)
        end = found.start() if found else len(octets)
    return end


def slices(texts: pa.Array, size: int = TOGETHER) -> Iterator[tuple[int, pa.Array]]:
    """``texts`` (without nulls) in runs of about ``size`` bytes: (row of the
    first, texts). A longer text comes in several runs, the single space
    between two left out, or whole where it has no such space."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    start = 0
    while start < len(texts):
        if lengths[start] > size:
            octets, at = texts[start].as_buffer().to_pybytes(), 0
            while at < len(octets):
                end = _cut(octets, at, size)
                yield start, pa.array([octets[at:end]], pa.binary()).cast(texts.type)
                at = end + 1
            start += 1
            continue
        end = start + max(1, int(np.searchsorted(np.cumsum(lengths[start:start + 65536]), size, side="right")))
        long = np.flatnonzero(lengths[start:end] > size)
        end = start + int(long[0]) if len(long) else end
        yield start, texts.slice(start, end - start)
        start = end


def numbered(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, number of each occurrence, offsets of the rows) of a
    list column of words."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def gathered(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The values of each of ``which`` in turn, where item k has the
    ``lengths[k]`` values that follow those of the items before it."""
    starts, n = np.cumsum(lengths) - lengths, lengths[which]
    total = int(n.sum())
    return values[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(total)]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each row."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[offsets])
