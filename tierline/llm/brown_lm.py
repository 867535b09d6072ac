"""Scores of texts by a class-based bigram model.

A text is its words and one end. Words belong to classes, found by exchange clustering; a token's probability is that
of its class after the class before it, times that of the word in its class. Every word seen at least twice is
clustered by itself, however many there are. The others are clustered by form, as groups of words with equal last
bytes, so every word, known or not, has a class. All counts are taken over the whole training corpus.

The clustering starts from one of the most frequent words and the groups, unit by unit on one machine. Then all words
move, in parallel against the table of classes, each by how often it stands before and after every class.

The probability of a word in its class is (count + 1) / (class tokens + class words + 1), so a known word's share
follows its count and unknown words share what is left.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import segment_sums, slices, texts, words
from tierline.llm.hashing import word_hashes
from tierline.session import materialise

#: Words that the clustering starts from, and groups of the others by form.
SINGLES, FORMS = 1000, 256
#: Bytes at a word's end that make its form.
FORM_BYTES = 3
CLASSES, SWEEPS = 64, 12
#: A word that is seen so often is clustered by itself.
OWN_CLASS = 2
#: Sweeps end when one adds less than this share to the likelihood.
LEAST_GAIN = 5e-4
#: Tokens counted at once in a task, and words whose neighbours are added up at once.
STEP_TOKENS, BUCKET_WORDS = 1 << 21, 50_000
#: At most so many of the most frequent words have their counts carried to the tasks; all others are joined.
CARRIED = 200_000
#: Added to each count of one class after another.
TRANSITION = 0.5
#: How the end of a text is written among the words; no word is empty.
END = ""
UNITS = SINGLES + FORMS + 1
END_UNIT = UNITS - 1
PART_SCHEMA = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, tokens array<int>, "
    "rare array<string>, times array<int>"
)


def form_unit(word: str) -> int:
    """The unit, at the start, of a word that the clustering doesn't start from."""
    return SINGLES + zlib.crc32(word.encode()[-FORM_BYTES:]) % FORMS


class Units:
    """Units of words at the start, given the words that the clustering starts from."""

    def __init__(self, singles: list[str]):
        self.singles = {w: i for i, w in enumerate(singles)}

    def of(self, distinct: list[str]) -> np.ndarray:
        known = self.singles
        return np.fromiter((known[w] if w in known else form_unit(w) for w in distinct), np.int64, len(distinct))


class Vocabulary:
    """Numbers of words: the place among the sorted 64-bit hashes of the words clustered, or after them the form's."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.end = len(hashes) + FORMS

    def of(self, distinct: pa.Array) -> np.ndarray:
        wanted = word_hashes(distinct)
        at = np.searchsorted(self.hashes, wanted)
        hit = at < len(self.hashes)
        hit[hit] = self.hashes[at[hit]] == wanted[hit]
        rest = np.flatnonzero(~hit)
        shift = len(self.hashes) - SINGLES
        at[rest] = [shift + form_unit(w) for w in distinct.take(pa.array(rest)).to_pylist()]
        return at


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts; the empty word is the end of a text. Combined in the tasks, then by word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, _ = words(batch.column("text"))
            encoded = flat.dictionary_encode()
            n = np.bincount(encoded.indices.to_numpy(zero_copy_only=False), minlength=len(encoded.dictionary))
            yield pa.record_batch([pa.concat_arrays([encoded.dictionary, pa.array([END])]), pa.array(np.append(n, batch.num_rows))], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for each unit, moving one at a time to where the likelihood of the class bigrams is highest.

    The end, the last unit, is class 0 by itself. Units start in turn by frequency; sweeps go by frequency as well and
    stop when nothing moves.
    """

    def phi(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)

    n = len(pairs)
    order = np.argsort(-pairs.sum(1)[:-1], kind="stable")
    own = np.zeros(n, np.int64)
    own[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), own] = 1
    between = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not pairs[u].any() and not pairs[:, u].any():
                continue
            to, loop = np.bincount(own, pairs[u], classes), pairs[u, u]
            by = np.bincount(own, pairs[:, u], classes)
            home = own[u]
            to[home] -= loop
            by[home] -= loop
            between[home] -= to
            between[:, home] -= by
            between[home, home] -= loop
            left, right = between.sum(1) + by, between.sum(0) + to
            total_to, total_by = to.sum() + loop, by.sum() + loop
            row, column = phi(between + to) - phi(between), phi(between + by[:, None]) - phi(between)
            diagonal = np.diagonal(between)
            gain = row.sum(1) - np.diagonal(row) + column.sum(0) - np.diagonal(column)
            gain += phi(diagonal + to + by + loop) - phi(diagonal)
            gain -= phi(left + total_to) - phi(left) + phi(right + total_by) - phi(right)
            gain[0] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[home] + 1e-9:
                best = home
            between[best] += to
            between[:, best] += by
            between[best, best] += loop
            own[u] = best
            moved += best != home
        if not moved:
            break
    return own


def likelihood(between: np.ndarray) -> float:
    """The log-likelihood of the class bigrams, up to what no clustering changes."""
    parts = (between, between.sum(0), between.sum(1))
    whole, to, by = (float((x * np.log(np.maximum(x, 1))).sum()) for x in parts)
    return whole - to - by


def best_classes(near: np.ndarray, home: np.ndarray, between: np.ndarray) -> np.ndarray:
    """The class that explains a word's neighbours best, for each row of ``near``: how often each class comes after the
    word, then how often each comes before it. A word moves for a gain only, and never to the end's class."""
    smooth = between + TRANSITION
    logs, to, by = np.log(smooth), near[:, :CLASSES], near[:, CLASSES:]
    value = to @ logs.T + by @ logs
    value -= to.sum(1)[:, None] * np.log(smooth.sum(1)) + by.sum(1)[:, None] * np.log(smooth.sum(0))
    value[:, 0] = -np.inf
    best = value.argmax(1)
    rows = np.arange(len(near))
    return np.where(value[rows, best] > value[rows, home] + 1e-9, best, home)


def pair_counts(tokens: DataFrame, group_of: Broadcast, groups: int) -> DataFrame:
    """How often a word of one group follows one of another, over all texts, given the group of each number.

    A text ends with the end, so read as a ring, what comes before its first word is an end. At most ``groups`` times
    ``groups`` rows, and so many from each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(groups * groups, np.int64)
        for batch in batches:
            own = group_of.value[batch.column("tokens").flatten().to_numpy(zero_copy_only=False)].astype(np.int32)
            if len(own):
                pairs += np.bincount(own[:-1] * groups + own[1:], minlength=len(pairs))
                pairs[int(own[-1]) * groups + own[0]] += 1
        full = np.flatnonzero(pairs)
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array(pairs[full])], ["pair", "n"])

    return tokens.mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def class_pairs(tokens: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """How often one class follows another."""
    shared = tokens.sparkSession.sparkContext.broadcast(class_of)
    between = np.zeros(CLASSES * CLASSES)
    for r in pair_counts(tokens, shared, CLASSES).collect():
        between[r.pair] = r.n
    shared.destroy()
    return between.reshape(CLASSES, CLASSES)


def moved(tokens: DataFrame, class_of: np.ndarray, between: np.ndarray, half: int) -> np.ndarray:
    """The classes after every second number, odd or even as ``half`` says, went where its neighbours are best explained.

    Neighbours that move at the same time could undo each other's gain, so half of them stand still. Tasks send counts
    of (word, side, class); those of a bucket of words meet in one task as a table of BUCKET_WORDS rows at most.
    """
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast((class_of, between))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(class_of) // (2 * BUCKET_WORDS) + 1)
    width = 2 * CLASSES

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ring = batch.column("tokens").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            own = shared.value[0][ring].astype(np.int64)
            after, before = np.roll(own, -1), np.roll(own, 1)
            for i in range(0, len(ring), STEP_TOKENS):
                part = ring[i : i + STEP_TOKENS]
                at = np.flatnonzero(part % 2 == half)
                rank = part[at] // 2
                # the bucket is the highest digit, so sorted keys are in order of buckets
                high = (rank % parts << 40) + rank // parts * width
                keys, n = np.unique(np.concatenate([high + after[i + at], high + CLASSES + before[i + at]]), return_counts=True)
                bucket, first = np.unique(keys >> 40, return_index=True)
                limits = pa.array(np.append(first, len(keys)), pa.int32())
                low = pa.ListArray.from_arrays(limits, pa.array(keys & ((1 << 40) - 1)))
                yield pa.record_batch([pa.array(bucket, pa.int32()), low.cast(pa.list_(pa.int32())), pa.ListArray.from_arrays(limits, pa.array(n, pa.int32()))], ["bucket", "at", "n"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pairs = shared.value
        now, near = -1, np.zeros(0)

        def done() -> pa.RecordBatch:
            number = 2 * (now + np.arange(len(near) // width) * parts) + half
            best = best_classes(near.reshape(-1, width), own[number], pairs)
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([best.astype(np.uint8).tobytes()], pa.binary())], ["bucket", "own"])

        for batch in batches:
            lists, times = batch.column("at"), batch.column("n")
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                if bucket != now:
                    if now >= 0:
                        yield done()
                    now, near = bucket, np.zeros(len(range(2 * bucket + half, len(own), 2 * parts)) * width)
                near[lists[i].values.to_numpy()] += times[i].values.to_numpy()
        if now >= 0:
            yield done()

    sent = tokens.mapInArrow(send, "bucket int, at array<int>, n array<int>")
    out = class_of.copy()
    for r in sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(settle, "bucket int, own binary").collect():
        out[2 * r.bucket + half :: 2 * parts] = np.frombuffer(r.own, np.uint8)
    out[-1] = 0  # the end
    shared.destroy()
    return out


def refine(tokens: DataFrame, class_of: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all numbers, and their pairs, after parallel sweeps from ``class_of``; none lowers the likelihood."""
    between = class_pairs(tokens, class_of)
    for sweep in range(sweeps):
        other = moved(tokens, class_of, between, sweep % 2)
        pairs = class_pairs(tokens, other)
        gain = likelihood(pairs) - likelihood(between)
        if gain > 0:
            class_of, between = other, pairs
        if sweep % 2 and gain <= LEAST_GAIN * abs(likelihood(between)):
            break
    return class_of, between


def _by_frequency(counts: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Two parts of ``counts``: the highest whole classes of counts that hold ``words`` words at most, and with the next class.

    Sizes of count classes, a thousand at most, tell where to cut. So only what is asked for comes to the driver, and not
    the most frequent words of every task.
    """
    size = F.floor(F.log2("n") * 16)
    fitting, within, beyond = 0, None, 0
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["size"]):
        fitting += r.words
        if fitting > words:
            beyond = r["size"]
            break
        within = r["size"]
    return counts.where(F.lit(False) if within is None else size >= within), counts.where(size >= beyond)


def _singles(counts: DataFrame) -> list[str]:
    """The words that the clustering starts from: the most frequent ones, equal counts by word."""
    _, enough = _by_frequency(counts, SINGLES)
    return [r.word for r in enough.orderBy(F.desc("n"), "word").limit(SINGLES).collect()]


@dataclass
class Lexicon:
    """What the words of a corpus are, before they have classes: counts of the words carried, numbers of all words clustered
    with their units at the start, words in each form, and totals."""

    carried: list[str]
    counts: np.ndarray
    hashes: np.ndarray
    unit_of: np.ndarray
    per_number: np.ndarray
    tokens: int
    distinct: int
    end_count: int


def lexicon(train: DataFrame) -> tuple[Lexicon, DataFrame]:
    """The lexicon of the texts in ``train``, and the counts of all their words as a table.

    The driver sees the words carried, and hash and unit of all words clustered.
    """
    counts = materialise(word_counts(train), "word-counts")
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words"),
        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("n"))), F.lit(0)).alias("ends"),
    ).first()
    in_texts = counts.where(F.col("word") != END)
    singles = _singles(in_texts)
    carried = sorted(_by_frequency(in_texts, CARRIED)[0].collect(), key=lambda r: (-r.n, r.word))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(singles)
        for batch in batches:
            word = batch.column("word")
            own = units.of(word.to_pylist()).astype(np.int16)
            yield pa.record_batch([pa.array(word_hashes(word).view(np.int64)), pa.array(own)], ["hash", "own"])

    def form_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(FORMS, np.int64)
        for batch in batches:
            n += np.bincount([form_unit(w) - SINGLES for w in batch.column("word").to_pylist()], minlength=FORMS)
        yield pa.record_batch([pa.array(np.arange(FORMS, dtype=np.int32)), pa.array(n)], ["form", "n"])

    # 10 bytes of each word clustered come to the driver, and 9 go to the tasks
    found = in_texts.where(F.col("n") >= OWN_CLASS).select("word").mapInArrow(unit, "hash bigint, own smallint").toArrow()
    hashes, first = np.unique(found["hash"].to_numpy().view(np.uint64), return_index=True)
    unit_of = np.concatenate([found["own"].to_numpy()[first], np.arange(SINGLES, UNITS)]).astype(np.int16)
    per_number = np.ones(len(unit_of))
    per_number[len(hashes) :] = 0
    rare = in_texts.where(F.col("n") < OWN_CLASS).select("word").mapInArrow(form_words, "form int, n bigint")
    for r in rare.groupBy("form").agg(F.sum("n").alias("n")).collect():
        per_number[len(hashes) + r.form] = r.n
    per_number[-1] = 1 if total.words else 0
    words_of = [r.word for r in carried], np.array([r.n for r in carried], np.int64)
    return Lexicon(*words_of, hashes, unit_of, per_number, total.tokens, total.words, total.ends), counts


@dataclass
class Model:
    """The lexicon, the classes of all numbers, log10 probabilities of one class after another, and log10 sizes of classes."""

    lexicon: Lexicon
    class_of: np.ndarray
    transition: np.ndarray
    class_size: np.ndarray


def numbered(docs: DataFrame, known: Lexicon, held_out: Column | None = None) -> DataFrame:
    """Every text once split into its words: their numbers, and what its score under single words needs.

    Tasks add up what concerns words carried to them and list the rare words of each text. Rows get a number when they
    are written, so repeated or null ids do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)  # CARRIED words and 8 bytes of each word clustered

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = {w: i for i, w in enumerate(m.carried)}
        vocabulary = Vocabulary(m.hashes)
        for batch in slices(batches):
            flat, lengths = words(batch.column("text"))
            encoded = flat.dictionary_encode()
            codes, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()
            at = np.fromiter((place.get(w, -1) for w in distinct), np.int64, len(distinct))
            n = np.where(at >= 0, m.counts[at] if len(m.counts) else 0, 0)
            logs = segment_sums(np.log10(n + 1.0)[codes], lengths)
            hits = segment_sums((n > 0)[codes].astype(np.int64), lengths)
            own = np.insert(vocabulary.of(encoded.dictionary)[codes], np.cumsum(lengths), vocabulary.end)
            limits = pa.array(np.append(0, np.cumsum(lengths + 1)), pa.int32())
            rare, times, sizes = _rare(codes, at < 0, lengths)
            offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            columns = [
                batch.column("doc_id"), batch.column("held_out"), pa.array(lengths + 1), pa.array(hits), pa.array(logs),
                pa.ListArray.from_arrays(limits, pa.array(own, pa.int32())),
                pa.ListArray.from_arrays(offsets, encoded.dictionary.take(pa.array(rare))), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
            ]
            yield pa.record_batch(columns, [f.split()[0] for f in PART_SCHEMA.split(", ")])

    out = (F.lit(False) if held_out is None else held_out).alias("held_out")
    parts = texts(docs, out).mapInArrow(part, PART_SCHEMA)
    return materialise(parts.withColumn("row", F.monotonically_increasing_id()), "word-numbers")


def cluster(tokens: DataFrame, known: Lexicon) -> Model:
    """The class model of the numbered texts in ``tokens``."""

    def start(pairs: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((UNITS, UNITS))
        table.ravel()[pairs["pair"]] = pairs["n"]
        return pd.DataFrame({"own": [exchange(table)]})

    shared = tokens.sparkSession.sparkContext.broadcast(known.unit_of)
    found = pair_counts(tokens, shared, UNITS).groupBy().applyInPandas(start, "own array<bigint>").collect()
    shared.destroy()
    first = np.array(found[0].own) if found else np.ones(UNITS, np.int64)
    own = first[known.unit_of].astype(np.uint8)
    own[-1] = 0  # the end
    own, between = refine(tokens, own)
    smooth = between + TRANSITION
    return Model(
        known, own, np.log10(smooth / smooth.sum(1, keepdims=True)),
        np.log10(between.sum(0) + np.bincount(own, known.per_number, CLASSES) + 1),
    )


def learn(train: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts in ``train``, and the counts of all their words as a table.

    An empty ``train`` gives a model in which all words are unknown.
    """
    train = texts(train)
    known, counts = lexicon(train)
    return cluster(numbered(train, known).select("tokens"), known), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, held_out: Column | None = None) -> DataFrame:
    """log10 probabilities of every whole text (null: empty) under single words and under the class model."""
    return score_numbered(numbered(docs, model.lexicon, held_out), model, counts)


def learn_and_score(docs: DataFrame, held_out: Column) -> DataFrame:
    """The scores of all texts by what is learned from those that are not ``held_out``; each text is split once to be
    counted and once to be numbered."""
    known, counts = lexicon(texts(docs.where(~held_out)))
    parts = numbered(docs, known, held_out)
    return score_numbered(parts, cluster(parts.where(~F.col("held_out")).select("tokens"), known), counts)


def score_numbered(parts: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """The scores of numbered texts.

    Both scores need the sum of log10(count + 1) over a text's tokens. The rare words of each text meet their counts in
    one join by word; no rare word is frequent enough to weigh on a task.
    """
    shared = parts.sparkSession.sparkContext.broadcast((model.class_of, model.transition, model.class_size))
    kept = ("doc_id", "held_out", "n_tokens", "n_known", "logs", "row")

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, transition, class_size = shared.value
        for batch in batches:
            own = class_of[batch.column("tokens").flatten().to_numpy(zero_copy_only=False)]
            before = np.concatenate([own[-1:], own[:-1]])
            lengths = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            class_part = segment_sums(transition[before, own] - class_size[own], lengths)
            yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(class_part)], [*kept, "class_part"])

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, row bigint, class_part double"
    classed = parts.select(*kept, "tokens").mapInArrow(classes, schema)
    entries = parts.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))))
    sums = (
        entries.join(counts, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_logs"), F.sum("times").alias("rare_known"))
    )
    known = model.lexicon
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(math.log10(known.end_count + 1.0))
    return classed.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(known.end_count > 0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(known.tokens + known.distinct + 1)).alias("base_score"),
        (logs + F.col("class_part")).alias("score"),
    )


def _rare(codes: np.ndarray, rare: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the distinct words that are ``rare``, how often it has them, and how many there are."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    mine = rare[codes]
    keys, times = np.unique(owner[mine] * max(1, len(rare)) + codes[mine], return_counts=True)
    return keys % max(1, len(rare)), times, np.bincount(keys // max(1, len(rare)), minlength=len(lengths))
