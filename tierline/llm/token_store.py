"""Token ids of documents in a binary format with random access to every token.

A segment holds the ids of consecutive documents as directly addressable codes. An id is split into 8-bit chunks,
lowest first. Level k stores chunk k of every id that has one, a continuation bitmap (bit set: the id goes on in the
next level) and a rank directory (set bits before each 512-bit block). Token i starts at place i of level 0; its place
in the next level is the number of continuation bits before it. Nothing before it is decoded.

Segment layout, little-endian::

    magic "DAC8" | uint32 levels | uint64 tokens
    per level: uint64 n | n chunk bytes | ceil(n/8) bitmap bytes, lowest bit first | uint32 rank per 512 bits
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import slices, texts
from tierline.llm.units import unit_encoder
from tierline.session import fresh_path

MAGIC = b"DAC8"
CHUNK, BLOCK = 8, 512
#: A segment is closed by the document that brings it to this many ids.
SEGMENT_TOKENS = 1 << 20
SEGMENT_SCHEMA = (
    "file_no int, file_offset bigint, doc_ids array<bigint>, doc_lengths array<bigint>, n_tokens bigint, codes binary"
)
DOCUMENT_SCHEMA = "doc_id bigint, file_no int, local_start bigint, n_tokens bigint, ids_crc32 bigint"


def pack_codes(ids: np.ndarray) -> bytes:
    """The segment bytes of ``ids``."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        goes_on = rest >> CHUNK != 0
        bits = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK)) if len(rest) else np.zeros(0)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        levels.append(b"".join([struct.pack("<Q", len(rest)), rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]))
        if not goes_on.any():
            return b"".join([MAGIC, struct.pack("<IQ", len(levels), len(ids)), *levels])
        rest = rest[goes_on] >> CHUNK


class Codes:
    """Reads a segment: single tokens by random access, ranges by unpacking the chunks they need."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        count, self.n = struct.unpack_from("<IQ", data, 4)
        place, self.levels = 16, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", data, place)
            sizes = (n, (n + 7) // 8, 4 * ((n + BLOCK - 1) // BLOCK))
            at = np.cumsum([place + 8, *sizes])
            parts = [np.frombuffer(data, kind, (b - a) // np.dtype(kind).itemsize, a) for a, b, kind in zip(at, at[1:], (np.uint8, np.uint8, "<u4"), strict=False)]
            self.levels.append(parts)
            place = int(at[-1])

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, place: int) -> int:
        """Set bits before ``place``."""
        if place >= 8 * len(bits) or place // BLOCK >= len(ranks):
            return int(ranks[-1]) + int(np.bitwise_count(bits[(len(ranks) - 1) * BLOCK // 8 :]).sum()) if len(ranks) else 0
        block = place // BLOCK
        whole = bits[block * BLOCK // 8 : place // 8]
        part = bits[place // 8] & ((1 << place % 8) - 1)
        return int(ranks[block]) + int(np.bitwise_count(whole).sum()) + int(part).bit_count()

    def token(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i // 8] >> i % 8 & 1:
                return value
            i, shift = self._rank(bits, ranks, i), shift + CHUNK
        raise ValueError("an id goes on after the last level")

    def tokens(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids from ``begin`` up to ``end``."""
        end = self.n if end is None else min(end, self.n)
        out, shift = np.zeros(max(0, end - begin), np.uint32), 0
        places = np.arange(len(out))
        for chunks, bits, ranks in self.levels:
            if begin >= end:
                break
            out[places] |= chunks[begin:end].astype(np.uint32) << np.uint32(shift)
            first = begin // 8
            goes_on = np.unpackbits(bits[first : (end + 7) // 8], bitorder="little")[begin - 8 * first :][: end - begin]
            places, shift = places[goes_on.astype(bool)], shift + CHUNK
            begin = self._rank(bits, ranks, begin)
            end = begin + len(places)
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encodes every text (null: empty), appends ``end_id`` and writes segments in ascending ``doc_id`` order to ``path``.

    One range shuffle on the id puts the texts in order; each task streams its range and closes a segment when it
    is full. A segment knows how many ids of its file came before it. Rows with the same id go by text; null ids
    come first.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no, file_offset = TaskContext.get().partitionId(), 0
        doc_ids, lengths, parts, size = [], [], [], 0
        encoder = unit_encoder(tokenizer, spaced=True)

        def segment() -> pa.RecordBatch:
            all_ids, all_lengths = np.concatenate(parts), np.concatenate(lengths)
            values = [file_no], [file_offset], [pa.concat_arrays(doc_ids).to_pylist()], [all_lengths], [len(all_ids)], [pack_codes(all_ids)]
            kinds = pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()
            names = [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")]
            return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in slices(batches):
            ids, counts = encoder.encode(batch.column("text"))
            parts.append(np.insert(ids, np.cumsum(counts), end_id))
            doc_ids.append(batch.column("doc_id"))
            lengths.append(counts + 1)
            size += len(parts[-1])
            if size >= segment_tokens:
                yield segment()
                file_offset += size
                doc_ids, lengths, parts, size = [], [], [], 0
        if size:
            yield segment()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, SEGMENT_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document: its place among all ids, how many it has and the crc32 of its ids, read back from the segments.

    Files are numbered in id order, so a document starts at the ids of all files before its own, plus those before it
    in its file. There is one row per file in the running sum: as many as the write had partitions, which also bounds
    the broadcast.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Codes(row["codes"]).tokens().astype("<u4")
                lengths = np.array(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                view = memoryview(ids).cast("B")
                crcs = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths, strict=True)]
                values = row["doc_ids"], [row["file_no"]] * len(lengths), row["file_offset"] + ends - lengths, lengths, crcs
                kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
                names = [f.split()[0] for f in DOCUMENT_SCHEMA.split(", ")]
                yield pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    segments = spark.read.parquet(path)
    files = segments.groupBy("file_no").agg(F.sum("n_tokens").alias("file_tokens"))
    base = files.selectExpr(
        "file_no", "sum(file_tokens) over (order by file_no) - file_tokens as file_start"
    )
    return (
        segments.mapInArrow(read, DOCUMENT_SCHEMA)
        .join(F.broadcast(base), "file_no")
        .select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_store(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes the ids of ``docs`` below the shared folder and describes every document from what was written.

    An empty table gives an empty result; an empty or null text has the end id alone.
    """
    path = fresh_path(docs.sparkSession, "token-store")
    write_tokens(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
