"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph hashes to a vector; a document's fingerprint is the sum of its paragraphs' vectors, each lane modulo a
power of two. Order doesn't matter, and paragraphs can be added and taken away without reading the rest.

The first lanes are uniform (modulo 2^64): they decide equality. The other lanes (modulo 2^32, more than a text has
triples) are sums of +1 and -1 hashed from the paragraph's word triples, so they add up the same way and the angle
between two documents' lanes estimates how much text they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import slices, text_bytes, texts
from tierline.llm.hashing import STEPS, mixed, run_sums, windows, word_hashes

#: Uniform 64-bit lanes, and 32-bit lanes of signs.
WIDE, SIGNS = 2, 128
#: Words in one feature of a paragraph; a shorter paragraph is one feature.
TRIPLE = 3
#: Text bytes that one range of ids is meant to hold when neighbours are brought together.
RANGE_BYTES = 16 << 20
PAIR_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_NUMBER = np.dtype([("wide", "<u8", WIDE), ("signs", "<u4", SIGNS)])


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text, as records of ``wide`` and ``signs`` lanes; paragraphs are the lines of the text."""
    lines = pc.split_pattern(texts, "\n")
    per_text = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    paragraphs = lines.flatten()
    lists = pc.split_pattern(paragraphs, " ")
    per_line = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = word_hashes(lists.flatten())
    ends = np.cumsum(per_line)
    begins = ends - per_line
    # a paragraph's key rolls over its words in order, with their places: equal keys for equal paragraphs
    place = (np.arange(len(hashes)) - np.repeat(begins, per_line)).astype(np.uint64)
    key = mixed(run_sums(mixed(hashes + place * STEPS[0]), per_line) + per_line.astype(np.uint64))
    wide = np.stack([mixed(key * m) for m in _MULTIPLIERS], 1)
    # triples of words inside a paragraph, or the whole of a shorter one
    features, counts = windows(hashes, per_line, TRIPLE)
    out = np.zeros(len(texts), _NUMBER)
    out["wide"] = run_sums(wide, per_text)
    per_text_features = np.add.reduceat(np.append(counts, 0), np.cumsum(per_text) - per_text) if len(per_text) else counts
    out["signs"] = _signed_sums(features, per_text_features)
    return out


def _signed_sums(features: np.ndarray, lengths: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """For each run, the lanes' sums of +1 and -1; bits are unpacked ``step`` features at a time."""
    out = np.zeros((len(lengths), SIGNS), np.int64)
    ends = np.cumsum(lengths)
    for begin in range(0, len(features), step):
        part = features[begin : begin + step]
        bits = np.concatenate([mixed(part + m).view(np.uint8).reshape(-1, 8) for m in _MULTIPLIERS], 1)
        signs = np.unpackbits(bits, axis=1).astype(np.int16)
        i = int(np.searchsorted(ends, begin, "right"))
        j = int(np.searchsorted(ends, begin + len(part), "left"))
        limits = np.clip(ends[i:j] - begin, 0, len(part))
        runs = np.diff(np.concatenate([[0], limits, [len(part)]]))
        rows = np.arange(i, i + len(runs))
        keep = runs > 0
        out[rows[keep]] += 2 * run_sums(signs, runs[keep]).astype(np.int64) - runs[keep][:, None]
    return out.astype(np.uint32)


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """The fingerprint of both multisets together, or with ``sign`` -1 of ``a`` without the paragraphs of ``b``."""
    out = np.zeros(np.broadcast(a, b).shape, _NUMBER)
    for lanes in ("wide", "signs"):
        out[lanes] = a[lanes] + b[lanes] if sign > 0 else a[lanes] - b[lanes]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints, else the cosine of the sign lanes, not below 0."""
    x, y = (f["signs"].astype(np.int32).astype(np.float64) for f in (a, b))
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.clip((x * y).sum(1) / np.where(size > 0, size, 1), 0, 1)
    return np.where(a == b, 1.0, cosine)


def _hex(f: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes().hex() for x in f], pa.string())


def _edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _ranges(docs: DataFrame) -> list[int]:
    """Ids that begin a range of about RANGE_BYTES, descending; only ids and text lengths are read.

    The first is the largest id. There is one id for each range, so the list is as long as the table has ranges.
    """
    stats = docs.agg(F.max("doc_id").alias("largest"), F.count("doc_id").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    if stats.largest is None:
        return []
    parts = max(1, -(-(stats.size or 0) // RANGE_BYTES))
    shares = [i / parts for i in range(1, parts)]
    inner = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("at")).first()["at"] if shares else []
    return sorted({stats.largest, *inner}, reverse=True)


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint and that of its edited text: its last half replaced by the beginning of the next
    document in descending id order (after the last comes the first), with the likeness to both.

    Ids are cut into ranges by ids that occur. A range is one key of the only shuffle; the document that begins the
    next range is sent along, so each range holds the neighbours of all its documents. Rows of equal id go by text.
    A null id comes last; a single document is its own neighbour; null text counts as empty.
    """
    docs = texts(docs)
    begins = _ranges(docs)
    spans = np.array(begins[::-1], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id")
            value = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            # range k has the ids up to begins[k] and above begins[k + 1]
            part = len(spans) - 1 - np.minimum(np.searchsorted(spans, value), len(spans) - 1) if len(spans) else np.zeros(len(value), np.int64)
            begin = np.isin(value, spans) if len(spans) else value == value.max()
            before = (part - 1) % max(1, len(spans))
            for at, range_no, halo in ((np.arange(len(value)), part, False), (np.flatnonzero(begin), before, True)):
                if len(at):
                    rows = batch.take(pa.array(at))
                    columns = [pa.array(range_no[at], pa.int64()), pa.array(np.full(len(at), halo)), rows.column("doc_id"), rows.column("text")]
                    yield pa.record_batch(columns, ["part", "halo", "doc_id", "text"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        for batch in slices(batches):
            rows = batch if waiting is None else pa.concat_batches([waiting, batch])
            waiting = rows.slice(rows.num_rows - 1)
            if rows.num_rows > 1:
                yield from _paired(rows)

    schema = "part bigint, halo boolean, doc_id bigint, text string"
    dealt = docs.mapInArrow(deal, schema).repartition("part")
    ordered = dealt.sortWithinPartitions("part", "halo", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(pair, PAIR_SCHEMA)


def _paired(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Results of the own documents among ``rows``, each with the row after it as its neighbour.

    A range ends with its halo, and only the first row of the halo has an own document before it.
    """
    own = np.flatnonzero(~rows.column("halo").to_numpy(zero_copy_only=False)[:-1])
    if not len(own):
        return
    text = rows.column("text")
    values, ids = text.to_pylist(), rows.column("doc_id").take(pa.array(own))
    edited = pa.array([_edited(values[i], values[i + 1]) for i in own], pa.string())
    made, of_edited = fingerprints(text), fingerprints(edited)
    data, limits = text_bytes(edited)
    data = data.tobytes()
    sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(limits[:-1], limits[1:], strict=True)]
    yield pa.record_batch(
        [
            ids, pa.array([len(values[i]) for i in own], pa.int64()), pa.array(sha), _hex(made[own]), _hex(of_edited),
            pa.array(likeness(made[own], of_edited)), pa.array(likeness(made[own], made[own + 1])),
        ],
        [f.split()[0] for f in PAIR_SCHEMA.split(", ")],
    )
