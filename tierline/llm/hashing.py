"""64-bit hashes of words and of runs of words, on whole columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

STEPS = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64
)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of a number over all others."""
    for step in (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(33))) * step
    return h ^ (h >> np.uint64(33))


def run_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, wrapping as unsigned numbers do; empty runs give 0."""
    out = np.zeros((len(lengths), *values.shape[1:]), values.dtype)
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[full], axis=0)
    return out


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A hash of each word; every distinct word is hashed once."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    encoded = flat.dictionary_encode()
    distinct = encoded.dictionary
    table = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return mixed(table)[encoded.indices.to_numpy(zero_copy_only=False)]


def windows(hashes: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words of a text, and how many runs each text has.

    A text with fewer words is one run of all its words; one without words has none.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    counts = np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)
    first = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    stop = np.repeat(ends - 1, counts)
    out = np.repeat(np.minimum(lengths, size).astype(np.uint64), counts)
    for k in range(size):
        at = first + k
        out += np.where(at <= stop, hashes[np.minimum(at, stop)] * STEPS[k], np.uint64(0))
    return mixed(out), counts
