"""What the operators of this package share: the two input columns, batches of bounded size, token units."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes worked on at once inside a task; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null is empty), and the named columns. All others are left behind, so none can clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_bucket(buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % buckets


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words after lower-casing A-Z, parted by ASCII white space: all words in a row, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        owner = np.repeat(np.arange(len(lengths)), lengths)[full]
        lengths = np.bincount(owner, minlength=len(texts))
        flat = flat.filter(pa.array(full))
    return flat, lengths.astype(np.int64)


def coded(values: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A number for each value, and the distinct values that the numbers stand for."""
    encoded = values.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of ``lengths`` values; empty runs give 0."""
    totals = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return totals[ends] - totals[ends - lengths]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all ``texts`` (no nulls) in a row, and the limits of each text in them. Nothing is copied."""
    texts = texts.cast(pa.string())
    limits = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[limits[0] : limits[-1]], limits - limits[0]


def cut_at(data: np.ndarray, limits: np.ndarray, cut: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Units of text: cut before each byte where ``cut`` is true and between texts. Also how many units each text has."""
    cut[limits[limits < len(data)]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(data)).astype(np.int32)
    counts = np.diff(np.searchsorted(starts, limits))
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)), counts


class Ragged:
    """Rows of unsigned integers by text key, kept for the life of a Python worker.

    ``rows_of(keys)`` is asked once for all keys of a slice that are not known yet. All is forgotten when there are
    ``limit`` keys or when keys and rows hold ``limit_bytes``. A slice is bounded, so what is held is at most that and
    one slice's, whatever the texts: where they have no blanks, a key is as long as a text and is never met again.
    """

    def __init__(
        self, rows_of: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_500_000, limit_bytes: int = 64 << 20
    ):
        self.rows_of, self.limit, self.limit_bytes = rows_of, limit, limit_bytes
        self._empty()

    def _empty(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int32)
        self.used = 0

    def numbers(self, keys: pa.Array) -> np.ndarray:
        """The row number of each key; valid until the next call."""
        if len(self.known) > self.limit or self.known.nbytes + 4 * self.used > self.limit_bytes:
            self._empty()
        found = pc.index_in(keys, value_set=self.known)
        if not found.null_count:
            return found.to_numpy(zero_copy_only=False)
        unknown = keys.filter(found.is_null())
        new = unknown.unique()
        values, lengths = self.rows_of(new.to_pylist())
        first, n = len(self.known), len(new)
        self._reserve(first + n, self.used + len(values))
        self.flat[self.used : self.used + len(values)] = values
        self.lengths[first : first + n] = lengths
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(values)
        self.known = pa.concat_arrays([self.known, new])
        numbers = found.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        numbers[numbers < 0] = first + pc.index_in(unknown, value_set=new).to_numpy(zero_copy_only=False)
        return numbers

    def _reserve(self, rows: int, values: int) -> None:
        if rows > len(self.starts):
            more = max(rows - len(self.starts), len(self.starts) // 2)
            self.starts = np.concatenate([self.starts, np.zeros(more, np.int64)])
            self.lengths = np.concatenate([self.lengths, np.zeros(more, np.int32)])
        if values > len(self.flat):
            more = max(values - len(self.flat), len(self.flat) // 2)
            self.flat = np.concatenate([self.flat, np.zeros(more, np.uint32)])

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The rows of ``numbers``, one after the other."""
        lengths = self.lengths[numbers].astype(np.int64)
        ends = np.cumsum(lengths)
        shift = self.starts[numbers] - (ends - lengths)
        return self.flat[np.repeat(shift, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
