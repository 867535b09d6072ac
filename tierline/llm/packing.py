"""Packing of token pieces into sequences of fixed size by bin completion, for any number of pieces.

Only the lengths matter for the packing, and there are no more different lengths than a sequence has tokens. So the
plan is made on the histogram of lengths: a pattern is one filling of a sequence, used as often as the counts allow.
Pieces then find their sequence by their number among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import slices, texts
from tierline.llm.units import unit_encoder
from tierline.session import materialise

SEQUENCE_TOKENS = 4096
#: Fillings tried for one pattern before the best one so far is taken.
SEARCH_NODES = 4000
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLAN_SCHEMA = "length bigint, rank_from bigint, times bigint, copies bigint, first_sequence bigint, offset bigint"


@dataclass
class Pattern:
    """One filling: copies of each length, longest first, and how many sequences have it."""

    filling: list[tuple[int, int]]
    times: int


def _best_fit(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """Fills ``room`` by always taking as many as fit of the longest length that fits."""
    filling, place = [], bisect_right(lengths, room)
    while room and place:
        place -= 1
        length = lengths[place]
        if copies := min(counts[length], room // length):
            filling.append((length, copies))
            room -= copies * length
            place = min(place, bisect_right(lengths, room))
    return filling


def complete(counts: dict[int, int], lengths: list[int], room: int, nodes: int = SEARCH_NODES) -> list[tuple[int, int]]:
    """The filling of ``room`` with least waste; of equal waste, the one found first by longest lengths first.

    ``counts`` may not be changed while this runs; ``lengths`` are its keys in ascending order. Depth-first search
    over copies of each length, longest first: fewer and longer pieces dominate the same sum made of shorter ones,
    which stay free to complete later sequences. A branch ends when all that may still be taken can't reduce the
    waste below the incumbent's, which is the best-fit filling at first.
    """
    best = _best_fit(counts, lengths, room)
    waste = room - sum(n * k for n, k in best)
    below = np.concatenate([[0], np.cumsum([n * min(counts[n], room // n) for n in lengths])]).tolist()
    stack: list[tuple[int, int, list[tuple[int, int]]]] = [(bisect_right(lengths, room), room, [])]
    while stack and waste and nodes:
        nodes -= 1
        place, left, chosen = stack.pop()
        if left < waste:
            best, waste = chosen, left
        place = min(place, bisect_right(lengths, left))
        if not place or left - below[place] >= waste:
            continue
        length = lengths[place - 1]
        stack.extend(
            (place - 1, left - k * length, [*chosen, (length, k)] if k else chosen)
            for k in range(min(counts[length], left // length) + 1)
        )
    return best


def plan_sequences(histogram: dict[int, int], capacity: int = SEQUENCE_TOKENS) -> list[Pattern]:
    """Patterns that hold each length as often as ``histogram`` says.

    The longest piece left opens a sequence and is completed to the least waste. The pattern is repeated while the
    counts last, so each step uses up a length or nearly so, and the number of steps doesn't follow the number of
    pieces. Best fit over the whole histogram is the incumbent; it stays if it needs no more sequences.
    """
    plans = [_plan(histogram, capacity, search) for search in (True, False)]
    return min(plans, key=lambda p: sum(x.times for x in p))


def _plan(histogram: dict[int, int], capacity: int, search: bool) -> list[Pattern]:
    counts = {n: k for n, k in sorted(histogram.items()) if k}
    lengths, patterns = list(counts), []
    while lengths:
        longest = lengths[-1]
        counts[longest] -= 1
        fill = (complete if search else _best_fit)(counts, lengths, capacity - longest)
        counts[longest] += 1
        merged = dict(fill)
        merged[longest] = merged.get(longest, 0) + 1
        filling = sorted(merged.items(), reverse=True)
        times = min(counts[n] // k for n, k in filling)
        patterns.append(Pattern(filling, times))
        for n, k in filling:
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        lengths = list(counts)
    return patterns


def plan_rows(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan by length: which of its pieces, counted from 0, go to which sequences and to which place there."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for p in patterns:
        offset = 0
        for n, k in p.filling:
            rows.append((n, used.get(n, 0), p.times, k, first, offset))
            used[n] = used.get(n, 0) + k * p.times
            offset += n * k
        first += p.times
    return rows


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Each document's ids and the end id, cut every ``capacity`` tokens; ``with_ids`` keeps the ids themselves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(tokenizer, spaced=False)
        for batch in slices(batches):
            ids, counts = encoder.encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            view = memoryview(ids).cast("B")
            sizes = counts + 1
            per_doc = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), per_doc)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            start = piece * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            at = (np.cumsum(sizes) - sizes)[owner] + start
            crcs = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at, length, strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crcs, pa.int64()),
            ]
            names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
            if with_ids:
                offsets = pa.array(np.append(at, len(ids)), pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.record_batch(columns, names)

    return texts(docs).mapInArrow(cut, PIECE_SCHEMA + (", ids array<int>" if with_ids else ""))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """All pieces with the sequence they go to and their place in it.

    The histogram has at most ``capacity`` rows and the plan a few times that, whatever the size of ``docs``; these
    are all that the driver sees and broadcasts. Numbers among pieces of equal length come from the counts of
    (task, length) pairs, so no task gathers a frequent length. Null and empty texts are pieces with the end id alone;
    repeated rows are packed as often as they occur; an empty table has no pieces.
    """
    spark = docs.sparkSession
    cut = cut_pieces(docs, tokenizer, end_id, capacity, with_ids).withColumn("task", F.spark_partition_id())
    pieces = materialise(cut, "pieces")
    counts = materialise(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_rows(plan_sequences(histogram, capacity)), PLAN_SCHEMA).withColumnRenamed("length", "of_length")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "task").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("nth", F.row_number().over(inside) - 1).join(bases, ["length", "task"])
    rank = F.col("nth") + F.col("base")
    within = F.col("rank") - F.col("rank_from")
    fits = (F.col("length") == F.col("of_length")) & (within >= 0) & (within < F.col("times") * F.col("copies"))
    return numbered.withColumn("rank", rank).join(F.broadcast(plan), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(within / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("offset") + within % F.col("copies") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
