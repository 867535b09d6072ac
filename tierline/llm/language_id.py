"""Language identification by character models with interpolated Kneser-Ney smoothing.

A text is read as its words, letters only, lower case, each between two blanks; a model gives the probability of each
letter after up to four before it. All models share sorted arrays of n-gram hashes: for an n-gram that some language
has, its probability in every language, and for a context its back-off weights. A language's cross-entropy is the mean
of minus log2 of the probabilities; the lowest wins. A text that even the winner finds too unlikely, by limits taken
from labelled texts kept out of training, is rejected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import Ragged, segment_sums, slices, texts, words

ORDER = 5
#: Probability of any letter where nothing is known.
UNSEEN = 1 / 4096
UNDETERMINED = "und"
#: The labelled sample that models are fitted on: so many texts of a language and so many characters, whichever is
#: reached first. Every fifth text sets the limits of rejection instead.
SAMPLE_TEXTS, SAMPLE_CHARS, CALIBRATION = 1500, 4_000_000, 5
#: A label set larger than this is taken for an error: all models are held in memory together.
MOST_LANGUAGES = 400
#: Share of the kept-out texts of a language that its limit covers, the room above its usual bits that it has at least
#: (as a share of these), and the deviations of the mean of a text's letters that a short text may need more.
COVERED, LEAST_ROOM, DEVIATIONS = 0.99, 0.5, 4
#: Bits above the highest of its learned texts that a language gets that has no kept-out texts.
SLACK_BITS = 2.5
#: At most so many letters count as evidence in the score, which keeps it apart from 1 for texts that are unclear.
EVIDENCE = 40
PREDICTION_SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, bits double, rejected boolean"
_PRIME, _MIX = np.uint64(1099511628211), np.uint64(0x9E3779B97F4A7C15)


def letters(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalpha())


def _positions(kept: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words between blanks, the place of each in its word, and the number of its word."""
    text = "".join(f" {w} " for w in kept)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, kept), np.int64, len(kept)) + 2
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return points, place, np.repeat(np.arange(len(kept)), sizes)


def _hashes(points: np.ndarray) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that ends at each code point; order 0 is one value everywhere."""
    out, rolled = [np.zeros(len(points), np.uint64)], np.zeros(len(points), np.uint64)
    for order in range(1, ORDER + 1):
        rolled = np.concatenate([[np.uint64(0)], rolled[:-1]]) * _PRIME + points
        mixed = (rolled + np.uint64(order)) * _MIX
        out.append(mixed ^ (mixed >> np.uint64(29)))
    return out


@dataclass
class Fitted:
    """One language: per order, n-gram hashes with context, suffix and probability; contexts with back-off weight."""

    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]


def fit(counts: dict[str, int]) -> Fitted:
    """A model of words and how often they occur. Below the highest order an n-gram counts once for each letter
    before it, or as often as it begins a word; one discount for each order."""
    kept = list(counts)
    points, place, owner = _positions(kept)
    weight = np.fromiter(counts.values(), np.float64, len(counts))[owner]
    hashes = _hashes(points)
    before = [np.concatenate([[np.uint64(0)], h[:-1]]) for h in hashes]
    probability = np.full(len(points), UNSEEN)
    fitted = Fitted([], [])
    for order in range(1, ORDER + 1):
        at = np.flatnonzero((place >= 1) & (place >= order - 1))
        grams, first, which = np.unique(hashes[order][at], return_index=True, return_inverse=True)
        if order == ORDER:
            count = np.bincount(which, weight[at], len(grams))
        else:
            starts = place[at] == order - 1
            count = np.bincount(which[starts], weight[at][starts], len(grams))
            inner = np.flatnonzero(~starts)
            _, seen = np.unique(hashes[order + 1][at[inner]], return_index=True)
            count += np.bincount(which[inner[seen]], minlength=len(grams))
        ones, twos = np.count_nonzero(count == 1), np.count_nonzero(count == 2)
        discount = ones / (ones + 2 * twos) if ones else 0.5
        context = before[order - 1][at[first]] if order > 1 else np.zeros(len(grams), np.uint64)
        contexts, of = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(of, count), np.bincount(of)
        backoff = discount * kinds / total
        own = np.maximum(count - discount, 0) / total[of] + backoff[of] * probability[at[first]]
        probability[at] = own[which]
        fitted.grams.append((grams, context, hashes[order - 1][at[first]], own))
        fitted.contexts.append((contexts, backoff))
    return fitted


@dataclass
class Models:
    """All languages in common sorted arrays, and each language's limit of bits a letter for long texts and their spread."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    limit: np.ndarray
    spread: np.ndarray

    def bits(self, kept: list[str]) -> np.ndarray:
        """Minus log2 of the probability of each word in each language."""
        out = np.zeros((len(kept), len(self.languages)))
        if not kept:
            return out
        points, place, owner = _positions(kept)
        hashes = _hashes(points)
        open_at = np.flatnonzero(place >= 1)
        acc = np.zeros((len(open_at), len(self.languages)), np.float32)
        total = np.zeros((len(points), len(self.languages)), np.float32)
        for order in range(ORDER, 0, -1):
            keys, values = self.grams[order - 1]
            able = place[open_at] >= order - 1
            wanted = hashes[order][open_at]
            if not len(keys):  # no word is long enough for this order
                continue
            found = np.searchsorted(keys, wanted)
            hit = able & (keys[np.minimum(found, len(keys) - 1)] == wanted)
            total[open_at[hit]] = acc[hit] + values[found[hit]]
            open_at, acc, able = open_at[~hit], acc[~hit], able[~hit]
            keys, values = self.contexts[order - 1]
            wanted = hashes[order - 1][open_at - 1] if order > 1 else np.zeros(len(open_at), np.uint64)
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            known = np.flatnonzero(able & (keys[found] == wanted))
            acc[known] += values[found[known]]
        total[open_at] = acc + np.float32(-np.log2(UNSEEN))
        np.add.at(out, owner, total)
        return out


def join_models(fitted: dict[str, Fitted], limit: dict[str, float], spread: dict[str, float]) -> Models:
    """Common arrays: a probability that a language lacks is its back-off weight times that of the shorter n-gram."""
    languages, grams, contexts = sorted(fitted), [], []
    for order in range(1, ORDER + 1):
        own = [fitted[x].contexts[order - 1] for x in languages]
        keys = np.unique(np.concatenate([k for k, _ in own]))
        weights = np.zeros((len(keys), len(languages)))
        for column, (k, w) in enumerate(own):
            weights[np.searchsorted(keys, k), column] = -np.log2(w)
        contexts.append((keys, weights.astype(np.float32)))
        parts = [fitted[x].grams[order - 1] for x in languages]
        all_keys, all_contexts, all_suffixes = (np.concatenate([p[i] for p in parts]) for i in range(3))
        sorted_keys, first = np.unique(all_keys, return_index=True)
        values = weights[np.searchsorted(keys, all_contexts[first])]
        if order == 1:
            values = values - np.log2(UNSEEN)
        else:
            shorter, known = grams[-1]
            values = values + known[np.searchsorted(shorter, all_suffixes[first])]
        for column, p in enumerate(parts):
            values[np.searchsorted(sorted_keys, p[0]), column] = -np.log2(p[3])
        grams.append((sorted_keys, values.astype(np.float32)))
    return Models(languages, grams, contexts, np.array([limit[x] for x in languages]), np.array([spread[x] for x in languages]))


def text_limit(means: np.ndarray, spreads: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """The limit of bits a letter for long texts, and the spread of one letter; a text of n letters gets DEVIATIONS
    times the spread over the root of n more. From kept-out texts: bits a letter, spread and letters of each.

    The limit is a quantile taken from below, so the few oddest texts, or a single one, don't set it.
    """
    usual, spread = float(np.median(means)), float(np.median(spreads))
    above = np.quantile(means - usual - DEVIATIONS * spread / np.sqrt(n), COVERED, method="lower")
    return usual + max(float(above), LEAST_ROOM * usual), spread


def _words_of(text: str) -> list[str]:
    return [w for w in map(letters, text.split()) if w]


def sample(labelled: DataFrame) -> DataFrame:
    """``lang`` and ``text`` of a bounded sample, the texts of each language in the order of a hash of their ids.

    Ranks are limited in the map tasks before any language meets in one place, and carry no text.
    """
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ids = (
        labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("draw"), F.length("text").alias("chars"))
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= SAMPLE_TEXTS)
        .withColumn("before", F.sum("chars").over(order) - F.col("chars"))
        .where(F.col("before") < SAMPLE_CHARS)
        .select("doc_id", "lang", "nth")
    )
    # at most SAMPLE_TEXTS ids of each language
    return labelled.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])


def learn(labelled: DataFrame) -> Models | None:
    """Models of all ``lang`` values in ``labelled`` (``doc_id``, ``text``, ``lang``); None if there are no words at all."""

    def train(texts_of: pd.DataFrame) -> pd.DataFrame:
        counts: dict[str, int] = {}
        ordered = texts_of.sort_values(["nth", "text"])
        calibrating = ordered["nth"] % CALIBRATION == 0
        for text in ordered["text"][~calibrating]:
            for w in _words_of(text):
                counts[w] = counts.get(w, 0) + 1
        if not counts:
            return pd.DataFrame({"lang": [], "kind": [], "ints": [], "reals": []})
        fitted = fit(counts)
        lang = texts_of["lang"].iloc[0]
        alone = join_models({lang: fitted}, {lang: 0.0}, {lang: 0.0})

        def judged(chosen: pd.Series) -> np.ndarray:
            """Bits a letter, spread and letters of each text that has any."""
            found = []
            for kept in filter(None, map(_words_of, chosen)):
                n, bits = np.array([len(w) + 1 for w in kept]), alone.bits(kept)[:, 0]
                mean = bits.sum() / n.sum()
                found.append((mean, np.sqrt(((bits - mean * n) ** 2).sum() / n.sum()), n.sum()))
            return np.array(found).reshape(-1, 3).T

        kept_out = judged(ordered["text"][calibrating])
        if kept_out.size:
            limit, spread = text_limit(*kept_out)
        else:
            means, spreads, _ = judged(ordered["text"])
            limit, spread = means.max() + SLACK_BITS, np.median(spreads)
        rows = [("limits", np.zeros(0, np.int64), np.array([limit, spread]))]
        for order in range(ORDER):
            grams, context, suffix, p = fitted.grams[order]
            rows.append((f"g{order}", np.concatenate([grams, context, suffix]).view(np.int64), p))
            keys, weight = fitted.contexts[order]
            rows.append((f"c{order}", keys.view(np.int64), weight))
        return pd.DataFrame({"lang": lang, "kind": [r[0] for r in rows], "ints": [r[1] for r in rows], "reals": [r[2] for r in rows]})

    schema = "lang string, kind string, ints array<bigint>, reals array<double>"
    fitted, limit, spread = {}, {}, {}
    for r in sample(labelled).groupBy("lang").applyInPandas(train, schema).collect():
        own = fitted.setdefault(r.lang, Fitted([None] * ORDER, [None] * ORDER))
        ints, reals = np.array(r.ints, np.int64).view(np.uint64), np.array(r.reals)
        if r.kind == "limits":
            limit[r.lang], spread[r.lang] = reals
        elif r.kind[0] == "g":
            own.grams[int(r.kind[1:])] = (*np.split(ints, 3), reals)
        else:
            own.contexts[int(r.kind[1:])] = ints, reals
    if len(fitted) > MOST_LANGUAGES:
        raise ValueError(f"{len(fitted)} languages; at most {MOST_LANGUAGES} models are held together")
    return join_models(fitted, limit, spread) if fitted else None


class Judge:
    """Scores texts in a Python worker; bits of words it has met are kept."""

    def __init__(self, models: Models):
        self.models, self.width = models, len(models.languages) + 1
        self.known = Ragged(self._rows, limit=6_000_000 // self.width)

    def _rows(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        kept = [letters(w) for w in distinct]
        table = np.zeros((len(kept), self.width), np.float32)
        full = [i for i, w in enumerate(kept) if w]
        table[full, :-1] = self.models.bits([kept[i] for i in full])
        table[:, -1] = [len(w) + 1 if w else 0 for w in kept]
        return table.view(np.uint32).ravel(), np.full(len(kept), self.width)

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: letters counted, the best language's number, score, bits a letter, whether it is rejected."""
        flat, lengths = words(texts)
        numbers = self.known.numbers(flat)
        table = self.known.flat[: self.known.used].view(np.float32).reshape(-1, self.width)
        sums = np.stack([segment_sums(table[numbers, i].astype(np.float64), lengths) for i in range(self.width)], 1)
        n = sums[:, -1]
        bits = sums[:, :-1] / np.maximum(n, 1)[:, None]
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        score = 1 / np.exp2(-(bits - least[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(1)
        m = self.models
        limit = m.limit[best] + DEVIATIONS * m.spread[best] / np.sqrt(np.maximum(n, 1))
        return n, best, np.where(n > 0, score, 0.0), least, (n == 0) | (least > limit)


_judges: dict[str, Judge] = {}


def _judge(key: str, models: Models) -> Judge:
    """The judge of this Python worker for one set of models."""
    if key not in _judges:
        _judges.clear()
        _judges[key] = Judge(models)
    return _judges[key]


def identify(docs: DataFrame, models: Models | None, held_out: Column | None = None) -> DataFrame:
    """The language of every row: ``und`` if the text is null or has no letter (or nothing was learned), else the best.

    ``rejected`` is true for texts without a letter and for texts above the limit of their language; without models
    nothing is. ``held_out`` is carried along. Empty tables give empty results; rows are judged one by one.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(models)  # as large as the sample lets it be
    key = uuid.uuid4().hex

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            size = batch.num_rows
            n, best, score, bits, rejected = (
                _judge(key, known).judge(batch.column("text")) if known is not None
                else (np.zeros(size), np.zeros(size, int), np.zeros(size), np.zeros(size), np.zeros(size, bool))
            )
            names = np.array([*(known.languages if known is not None else []), UNDETERMINED], object)
            chosen = names[np.where(n > 0, best, len(names) - 1)]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(chosen, pa.string()), pa.array(score), pa.array(bits), pa.array(rejected)]
            yield pa.record_batch(columns, [f.split()[0] for f in PREDICTION_SCHEMA.split(", ")])

    return texts(docs, (F.lit(False) if held_out is None else held_out).alias("held_out")).mapInArrow(predict, PREDICTION_SCHEMA)


def keep_identified(docs: DataFrame, models: Models | None) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected. Without models only texts that are null or have no
    letter go. Rows pass through tasks as they are; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    key = uuid.uuid4().hex

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            text = pc.fill_null(batch.column("text"), "")
            if known is None:
                gone = np.array([not letters(x) for x in text.to_pylist()])
            else:
                gone = _judge(key, known).judge(text)[-1]
            yield batch.filter(pa.array(~gone))

    return docs.mapInArrow(keep, docs.schema)


def labelled(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those with a label."""
    return texts(docs, F.col("lang").alias("lang")).where(F.col("lang").isNotNull())
