"""Near duplicates by one-permutation hashing, banded buckets and confirmation on whole shingle sets.

A document is the set of its five-word shingles. Documents with the same set are one node. A node's shingles are dealt
over bins by their hash's first bits; a bin keeps its least hash, and an empty bin takes that of a bin drawn by a hash
of its number and the attempt (optimal densification). Runs of bins are bands; nodes that share a band are a bucket.

In a bucket every node is paired with its hub only: the node that shares most buckets with others, which in a group of
edited copies is close to all of them. When the confirmed links have been joined into components, a bucket whose nodes
are not all in one component has outsiders: those outside its largest one. Only these are compared with the others, in
blocks: a task gets two blocks of a bucket with shortened shingles, counts what their sets have in common at most, and
gives the pairs that may be alike. Two nodes inside the largest component need no comparison, so no link between
components is missed. All links are confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import slices, texts, words
from tierline.llm.components import components
from tierline.llm.exact_dedup import keep_ids
from tierline.llm.hashing import STEPS, mixed, run_sums, windows, word_hashes
from tierline.session import materialise

SHINGLE, PERCENT = 5, 75
#: 32 bands of 4 bins: of pairs at the threshold, five in a million share no band.
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: A pair is confirmed on its sets if so many of its 128 bins agree; of pairs at the threshold 96 do, 64 are 6.5
#: standard deviations below.
LEAST_BINS = BINS // 2
#: Members of a bucket in one block, shingles up to which a set is cut to 16 bits, and cells of a table in a comparison.
BLOCK, SHORT_SET, CELLS = 256, 2000, 1_000_000
#: Text bytes hashed at once; hashes of shingles take several times as much.
SLICE = 1 << 20
SET_KEY = ["set_a", "set_b", "n_shingles"]
SIGNED_SCHEMA = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, bins binary"

_DRAWS = (mixed(np.arange(4096 * BINS, dtype=np.uint64) + np.uint64(1)) % np.uint64(BINS)).astype(np.int64).reshape(-1, BINS)
_STARTS = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - (BINS - 1).bit_length())


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, all in a row, and how many each text has."""
    flat, lengths = words(texts)
    hashes, counts = windows(word_hashes(flat), lengths, SHINGLE)
    ends = np.cumsum(counts)
    sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends, counts, strict=True)]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def set_keys(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set: two sums of its mixed hashes."""
    return tuple(run_sums(mixed(flat * step), lengths).view(np.int64) for step in STEPS[:2])


def signature(own: np.ndarray) -> np.ndarray:
    """The least hash of each bin of a set that isn't empty, with empty bins densified."""
    first = np.searchsorted(own, _STARTS)
    last = np.append(first[1:], len(own))
    full = last > first
    out = own[np.minimum(first, len(own) - 1)]
    empty = np.flatnonzero(~full)
    step = 0
    while len(empty):
        draws = _DRAWS[step : step + 64, empty] if step < len(_DRAWS) else np.full((1, len(empty)), np.flatnonzero(full)[0])
        hit = full[draws]
        done = hit.any(0)
        out[empty[done]] = own[first[draws[hit.argmax(0), np.arange(len(empty))][done]]]
        empty, step = empty[~done], step + 64
    return out


def signed(docs: DataFrame) -> DataFrame:
    """Every row with the size and key of its set, its bands and the low byte of each bin; no text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(BANDS, dtype=np.uint64) * STEPS[4]
        for batch in slices(batches, limit=SLICE):
            flat, lengths = shingle_sets(batch.column("text"))
            ends = np.cumsum(lengths)
            made = [signature(flat[e - n : e]) if n else None for e, n in zip(ends, lengths, strict=True)]
            bands = [None if s is None else mixed((s.reshape(BANDS, ROWS) * STEPS[:ROWS]).sum(1, dtype=np.uint64) + numbers).view(np.int64) for s in made]
            low = [None if s is None else s.astype(np.uint8).tobytes() for s in made]
            a, b = set_keys(flat, lengths)
            columns = [batch.column("doc_id"), pa.array(lengths), pa.array(a), pa.array(b), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())]
            yield pa.record_batch(columns, [f.split()[0] for f in SIGNED_SCHEMA.split(", ")])

    return texts(docs).mapInArrow(sign, SIGNED_SCHEMA)


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (``a`` < ``b``) of which enough bins agree."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("x", "y"))
                keep = pa.array((x == y).sum(1) >= LEAST_BINS)
                yield batch.select(["a", "b"]).filter(keep)

    both = pairs.join(nodes.selectExpr("node as a", "bins as x"), "a").join(nodes.selectExpr("node as b", "bins as y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(agree, "a bigint, b bigint")


def _node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and its whole ``shingles`` for the nodes ``wanted``, read again from the text of one of their documents.

    An id may stand for several texts, so a text's set must have the key of the node.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            flat, lengths = shingle_sets(batch.column("text"))
            a, b = set_keys(flat, lengths)
            same = (a == batch.column("set_a").to_numpy()) & (b == batch.column("set_b").to_numpy())
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))
            yield pa.record_batch([batch.column("node"), lists], ["node", "shingles"]).filter(pa.array(same))

    keyed = wanted.select("node", F.col("rep").alias("doc_id"), "set_a", "set_b")
    return texts(docs).join(keyed, "doc_id").select("node", "set_a", "set_b", "text").mapInArrow(sets, "node bigint, shingles array<bigint>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are alike enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                alike.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    both = pairs.join(sets.selectExpr("node as b", "shingles as y"), "b").join(sets.selectExpr("node as a", "shingles as x"), "a")
    return both.select("a", "b", "x", "y").mapInArrow(confirm, "a bigint, b bigint")


def _labels(members: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket members with the root of their component, which is the node itself where it has no link."""
    roots = materialise(components(links), "roots")
    return members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))


def _mixed_members(labelled: DataFrame) -> DataFrame:
    """Members of the buckets in which some pair is still open, with the root of the bucket's largest component.

    In a bucket of two the only pair is that with the hub.
    """
    sizes = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")
    )
    buckets = materialise(buckets.where("parts > 1 and n > 2").select("bucket", "largest", "n"), "mixed-buckets")
    return labelled.join(buckets, "bucket")


def _short(own: np.ndarray) -> bytes:
    """A set's shingles cut to 16 bits, or to 32 in a large set, and after them one byte that tells which."""
    wide = len(own) > SHORT_SET
    return np.unique(own.astype(np.uint32 if wide else np.uint16)).tobytes() + bytes([wide])


def _long(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[-1] else np.uint16, (len(data) - 1) // (4 if data[-1] else 2))


def common_at_most(short: list[bytes], sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each of ``rows`` and each set, a number that their common shingles can't exceed.

    Cut shingles that differ stand for shingles that differ. Those that a set loses because they are cut to the same
    value are added again. Sets of both widths are compared on 16 bits.
    """
    values = [_long(x) for x in short]
    if len({v.dtype for v in values}) > 1:
        values = [np.unique(v.astype(np.uint16)) for v in values]
    lengths = np.array([len(v) for v in values])
    owner = np.repeat(np.arange(len(values)), lengths)
    _, column, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    renumbered = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], renumbered[column[keep]]
    out = np.zeros((len(rows), len(values)), np.float32)
    columns = int(renumbered[-1]) + 1 if len(renumbered) else 0
    step = max(1, min(columns, CELLS // len(values)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, columns, step):
        i, j = np.searchsorted(column, (begin, begin + step))
        held = np.zeros((len(values), step), np.float32)
        held[owner[i:j], column[i:j] - begin] = 1
        out += held[rows] @ held.T
    lost = sizes - lengths
    return out + np.minimum(lost[rows][:, None], lost[None, :])


def _outsider_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of a bucket's nodes outside its largest component with its nodes of other components that may be alike.

    A bucket's members are dealt over blocks of about BLOCK; each two blocks, and each with itself, are one group.
    """

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.values.to_numpy().view(np.uint64) for x in batch.column("shingles")]
            columns = [batch.column("node"), pa.array([len(x) for x in own], pa.int64()), pa.array(map(_short, own), pa.binary())]
            yield pa.record_batch(columns, ["node", "size", "short"])

    def compare(group: pa.Table) -> pa.Table:
        node, root, size = (group.column(c).to_numpy() for c in ("node", "root", "size"))
        outside = root != group.column("largest").to_numpy()
        block, lo, hi = (group.column(c).to_numpy() for c in ("block", "lo", "hi"))
        rows = np.flatnonzero(outside)
        pairs = np.zeros((0, 2), np.int64)
        if len(rows):
            common = common_at_most(group.column("short").to_pylist(), size, rows)
            both = size[rows][:, None] + size[None, :]
            alike = (100 + PERCENT) * common >= PERCENT * both
            alike &= root[rows][:, None] != root[None, :]
            alike &= (block[rows][:, None] != block[None, :]) | (lo[0] == hi[0])
            i, j = np.nonzero(alike)
            found = np.stack([node[rows[i]], node[j]], 1)
            pairs = np.unique(np.sort(found, 1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    short = materialise(sets.mapInArrow(shorten, "node bigint, size bigint, short binary"), "short-sets")
    blocks = F.ceil(F.col("n") / BLOCK)
    dealt = (
        members.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .join(short, "node")
    )
    found = dealt.select("bucket", "lo", "hi", "block", "node", "root", "largest", "size", "short").groupBy("bucket", "lo", "hi")
    return found.applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row the size of its shingle set, the smallest id of its component and whether it is that.

    Rows without words (null, empty, blank) have an empty set, are linked with nothing and stay. Rows of equal sets
    are linked. Rows that repeat an id with another text are linked each by its own text. A row without an id takes no
    part: its component is null and it stays.
    """
    rows = materialise(signed(docs), "signed")
    linkable = rows.where("doc_id is not null and n_shingles > 0")
    classes = linkable.groupBy(*SET_KEY).agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("bins").alias("bins")
    )
    nodes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    entries = nodes.select(F.explode("bands").alias("bucket"), "node")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = materialise(entries.join(materialise(shared, "buckets"), "bucket"), "members")
    central = materialise(held.groupBy("node").agg(F.sum("n").alias("company")), "company")
    hubs = held.join(central, "node").groupBy("bucket").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    stars = held.join(materialise(hubs, "hubs"), "bucket").where("node != hub")
    stars = materialise(stars.selectExpr("least(hub, node) as a", "greatest(hub, node) as b").distinct(), "stars")
    likely = materialise(_promising(stars, nodes), "likely")
    sets = _sets_of(docs, nodes, likely.selectExpr("explode(array(a, b)) as node").distinct())
    links = materialise(_confirmed(likely, sets), "confirmed")

    labelled = materialise(_labels(held.select("bucket", "node"), links), "labelled")
    members = materialise(_mixed_members(labelled), "mixed")
    open_sets = _sets_of(docs, nodes, members.select("node").distinct())
    more = materialise(_outsider_pairs(members, open_sets), "more")
    links = links.union(_confirmed(more.join(stars, ["a", "b"], "left_anti"), open_sets))

    roots = components(links)
    of_node = nodes.join(roots, "node", "left").select(*SET_KEY, "rep", F.coalesce("root", "node").alias("root"))
    of_node = materialise(of_node, "node-roots")
    least = materialise(of_node.groupBy("root").agg(F.min("rep").alias("component_id")), "component-ids")
    labels = materialise(of_node.join(least, "root").select(*SET_KEY, "component_id"), "set-components")
    found = rows.select("doc_id", *SET_KEY).join(labels, SET_KEY, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _sets_of(docs: DataFrame, nodes: DataFrame, ids: DataFrame) -> DataFrame:
    wanted = nodes.select("node", "rep", "set_a", "set_b").join(ids, "node", "left_semi")
    return materialise(_node_sets(docs, wanted), "sets")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component left: the one with the smallest id.

    All rows without an id stay; where an id repeats, all its rows stay if one of them does.
    """
    return keep_ids(docs, near_duplicates(docs).where("kept").select("doc_id"))
