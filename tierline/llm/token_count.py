"""Token counts by byte-pair merging, without making any ids.

A word's symbols are a linked list, its adjacent pairs that form a piece are a heap ordered by score and place. The
best pair is merged again and again. The count is the number of symbols at first minus the number of merges; a
character that is no piece counts once per UTF-8 byte, as byte fallback writes it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tierline.llm.common import Ragged, cut_at, segment_sums, slices, text_bytes, texts

#: Fixed value: how the vocabulary writes a blank.
BLANK = "▁"
COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces and scores of a byte-pair model of the sentencepiece library, and where its texts can be cut.

    Only models that keep text as it is but for blanks, put a blank before it and fall back to bytes are taken.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (
            train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix or not norm.escape_whitespaces or train.treat_whitespace_as_suffix
            or kinds - {1, 2, 3, 6}
        ):
            raise ValueError("this model normalises text or has pieces of a kind that is not handled")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.byte_ids = [next(i for i, p in enumerate(model.pieces) if p.piece == f"<0x{b:02X}>") for b in range(256)]
        self.joined = self._neighbours()
        self.counts = Ragged(self._counts)

    def _neighbours(self) -> np.ndarray:
        """For two ASCII bytes: may a merge span the place between them? Not if no piece has them side by side."""
        joined = np.zeros((256, 256), bool)
        joined[128:] = joined[:, 128:] = True
        joined[128:, ord(" ")] = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        code = lambda c: ord(" ") if c == BLANK else ord(c)
        for piece in self.ids:
            for a, b in zip(map(code, piece), map(code, piece[1:]), strict=False):
                if a < 128 and b < 128:
                    joined[a, b] = True
        return joined

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Stretches that no merge leaves, and how many each text has. The blank before a text is not in them."""
        data, limits = text_bytes(texts)
        cut = np.zeros(len(data), bool)
        cut[1:] = ~self.joined[data[:-1], data[1:]]
        for i in np.flatnonzero(pc.match_substring(texts, BLANK).to_numpy(zero_copy_only=False)):
            cut[limits[i] + 1 : limits[i + 1]] = False  # a text with the mark itself stays whole
        return cut_at(data, limits, cut)

    def _counts(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        count = self.count
        return np.fromiter((count(u.replace(" ", BLANK)) for u in units), np.uint32, len(units)), np.ones(len(units), np.int64)

    def count(self, symbols: str) -> int:
        """Tokens of a marked text, by a heap of adjacent pairs over a linked list of symbols."""
        scores, n = self.scores, len(symbols)
        if symbols in scores and n == 1:
            return 1
        text: list[str | None] = list(symbols)
        total = n
        for c in symbols:
            if c not in scores:
                total += len(c.encode()) - 1
        heap = []
        for i in range(n - 1):
            pair = symbols[i : i + 2]
            if pair in scores:
                heap.append((-scores[pair], i, pair))
        if not heap:
            return total
        heapq.heapify(heap)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = text[i]
            j = following[i]
            if left is None or j >= n or len(left) + len(text[j]) != len(pair) or left + text[j] != pair:
                continue  # one of the two has been merged with another meanwhile
            text[i], text[j] = pair, None
            total -= 1
            k = following[i] = following[j]
            if k < n:
                previous[k] = i
                if (new := pair + text[k]) in scores:
                    heapq.heappush(heap, (-scores[new], i, new))
            if (h := previous[i]) >= 0 and (new := text[h] + pair) in scores:
                heapq.heappush(heap, (-scores[new], h, new))
        return total

    def token_counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. A text's first unit is counted with the blank that the model puts before it."""
        units, counts = self.units(texts)
        numbers = self.counts.numbers(units)
        values = self.counts.flat[self.counts.starts[numbers]].astype(np.int64)
        first = np.flatnonzero(counts)
        places = (np.cumsum(counts) - counts)[first]
        for place, unit in zip(places, units.take(pa.array(places)).to_pylist(), strict=True):
            values[place] = self.count(BLANK + unit.replace(" ", BLANK))
        return segment_sums(values, counts)


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this Python worker."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """UTF-8 bytes and tokens of every whole text, and whether it has more than ``limit`` tokens. No shuffle.

    Null and empty texts have no tokens; rows are counted one by one, so ties and repeats need no rule.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model)
        for batch in slices(batches):
            text = batch.column("text")
            tokens = known.token_counts(text)
            sizes = np.diff(text_bytes(text)[1]).astype(np.int64)
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(count, COUNT_SCHEMA)
