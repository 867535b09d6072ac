"""Encoding to and decoding from sentence pieces, with one forward pass over a trie of distinct words.

The units of a slice that are not known yet are sorted, which puts them in depth-first order of their trie. Going from
one to the next, the forward states of their common prefix are kept; only the rest is extended, character by character.

A state is the best path to a place: its last piece, where that starts, and its score. The vocabulary is a byte-pair
one, so an arc may follow a piece only if merging the two texts gives these two pieces again. Then exactly one path
to each place is left, and it is the one that the merges give, so ids equal the library's.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierline.llm.common import Ragged, segment_sums, slices, text_bytes, texts
from tierline.llm.token_count import BLANK, Vocabulary, vocabulary

ENCODED_SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, decoded_equal boolean"
#: Remembered answers about pairs of pieces; all are forgotten when there are more.
KNOWN_PAIRS = 700_000

_coders: dict[str, PieceCoder] = {}


class PieceCoder:
    """Ids of texts and texts of ids for one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.follows: dict[tuple[str, str], bool] = {}
        # pieces that merges make at all, and the length of the longest by last character
        self.made = {p: s for p, s in vocab.scores.items() if self.merged(p) == [p]}
        self.longest: dict[str, int] = defaultdict(lambda: 1)
        for piece in self.made:
            self.longest[piece[-1]] = max(self.longest[piece[-1]], len(piece))
        self.units = Ragged(self._unit_ids)
        size = max(*vocab.ids.values(), *vocab.byte_ids) + 1
        spelled = [b""] * size
        for piece, i in vocab.ids.items():
            spelled[i] = piece.replace(BLANK, " ").encode()
        for b, i in enumerate(vocab.byte_ids):
            spelled[i] = bytes([b])
        self.byte_lengths = np.array([len(x) for x in spelled])
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)

    def merged(self, symbols: str) -> list[str]:
        """The pieces of a short text by merging the best pair again and again."""
        scores, parts = self.vocab.scores, list(symbols)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: scores.get(parts[i] + parts[i + 1], -np.inf))
            if (new := parts[best] + parts[best + 1]) not in scores:
                break
            parts[best : best + 2] = [new]
        return parts

    def may_follow(self, left: str, right: str) -> bool:
        pair = left, right
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) >= KNOWN_PAIRS:
                self.follows.clear()
            known = self.follows[pair] = self.merged(left + right) == [left, right]
        return known

    def paths(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each of the sorted ``words``; a character that is no piece stands for itself.

        Arcs are tried from the longest. The first that the merge order allows is the only one, so its score is the
        best: there is nothing left to compare it with.
        """
        made, longest, follows, may_follow = self.made, self.longest, self.follows, self.may_follow
        # the last piece ("" after a character that is no piece), where it starts, and the score of the path
        pieces, begins, scores, last = [""], [0], [0.0], ""
        for word in words:
            shared = len(commonprefix((last, word))) + 1
            del pieces[shared:], begins[shared:], scores[shared:]
            for end in range(len(pieces), len(word) + 1):
                for begin in range(max(0, end - longest[word[end - 1]]), end):
                    piece = word[begin:end]
                    if piece in made:
                        before = pieces[begin]
                        allowed = not before or follows.get((before, piece))
                        if allowed is None:
                            allowed = may_follow(before, piece)
                        if allowed:
                            pieces.append(piece)
                            begins.append(begin)
                            scores.append(scores[begin] + made[piece])
                            break
                else:
                    pieces.append("")
                    begins.append(end - 1)
                    scores.append(scores[end - 1])
            last, place, path = word, len(word), []
            while place:
                begin = begins[place]
                path.append(pieces[place] or word[begin:place])
                place = begin
            yield path[::-1]

    def _ids(self, path: list[str]) -> list[int]:
        ids, out = self.vocab.ids, []
        for piece in path:
            if piece in ids:
                out.append(ids[piece])
            else:
                out.extend(self.vocab.byte_ids[b] for b in piece.encode())
        return out

    def _unit_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marked = [u.replace(" ", BLANK) for u in units]
        order = sorted(range(len(marked)), key=marked.__getitem__)
        rows: list[list[int]] = [[]] * len(units)
        for place, path in zip(order, self.paths([marked[i] for i in order]), strict=True):
            rows[place] = self._ids(path)
        return np.fromiter((i for r in rows for i in r), np.uint32), np.fromiter(map(len, rows), np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and how many each text has."""
        units, counts = self.vocab.units(texts)
        first = np.flatnonzero(counts)
        places = (np.cumsum(counts) - counts)[first]
        # the model puts a blank before a text
        begun = pa.array([" " + u for u in units.take(pa.array(places)).to_pylist()], pa.string())
        codes = np.arange(len(units))
        codes[places] = len(units) + np.arange(len(places))
        both = pa.concat_arrays([units, begun]).take(pa.array(codes))
        numbers = self.units.numbers(both)
        return self.units.gather(numbers), segment_sums(self.units.lengths[numbers], counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids, without the blank that encoding puts before it."""
        lengths = self.byte_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = self.spelling[np.repeat(self.byte_starts[ids] - (ends - lengths), lengths) + np.arange(total)].tobytes()
        limits = np.cumsum(segment_sums(lengths, counts))
        return [data[a + 1 : b] if b > a else b"" for a, b in zip(np.append(0, limits[:-1]), limits, strict=True)]


def piece_coder(model: str) -> PieceCoder:
    """The coder of this Python worker."""
    if model not in _coders:
        _coders[model] = PieceCoder(vocabulary(model))
    return _coders[model]


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text again. No shuffle.

    Null and empty texts have no ids and decode to the empty text. Rows are coded one by one, so ties and repeats
    need no rule; an empty table gives an empty result.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for batch in slices(batches):
            text = batch.column("text")
            ids, counts = coder.encode(text)
            data, limits = text_bytes(text)
            data = data.tobytes()
            equal = [x == data[a:b] for x, a, b in zip(coder.decode(ids, counts), limits[:-1], limits[1:], strict=True)]
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(equal)]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "decoded_equal"])

    return texts(docs).mapInArrow(encode, ENCODED_SCHEMA)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; null ids give null."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            flat = np.fromiter((i for r in rows for i in r or ()), np.int64)
            decoded = coder.decode(flat, np.array([len(r or ()) for r in rows], np.int64))
            values = [None if r is None else x.decode("utf-8", "replace") for r, x in zip(rows, decoded, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(values, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
