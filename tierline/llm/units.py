"""Ids of whole texts from the tokenizers library, asked once per distinct unit of text instead of once per occurrence.

A unit is a stretch of text that the library's pre-tokenizers never join with its neighbours, so a text's ids are the
ids of its units in order. Cuts are made on bytes, between ASCII characters only:

* before white space that follows another character;
* after a single line break or tab that other characters follow;
* before a punctuation mark that follows an ASCII letter and ends a word.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierline.llm.common import Ragged, cut_at, segment_sums, text_bytes

#: White space beyond ASCII. Texts that hold any are left to the library as they are.
FOREIGN_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A word of Latin letters that no normaliser changes but for case.
PLAIN = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)")
#: The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, others follow at 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _marked(*codes: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(codes)] = True
    return table


_BLANK = _marked(*range(9, 14), 32)
_BREAK = _marked(*range(9, 14))
_LETTER = _marked(*range(65, 91), *range(97, 123))
_STOP = _marked(*b".,!?;:")

_encoders: dict[tuple[str, bool], UnitEncoder] = {}


def _byte_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(_LETTERS)


def unit_cuts(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Where units begin, by the rules above."""
    blank = _BLANK[data]
    # a text's first byte never counts as following the text before it, as every text's start is a cut anyway
    before = np.concatenate([[True], blank[:-1]])
    cut = blank & ~before
    single_break = _BREAK[data] & ~before
    cut[1:] |= single_break[:-1] & ~blank[1:]
    after = np.append(blank[1:], True)
    inner = limits[1:-1]
    after[inner[inner > 0] - 1] = True
    cut[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]] & after[1:]
    return cut


class UnitEncoder:
    """Ids of texts by a tokenizers file; ``spaced`` when blanks belong to the tokens after them."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.units = Ragged(self._ids)

    def _ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each unit. A plain word is one pre-token, so it goes straight to the library's model."""
        tokenize, rows, others = self.tokenizer.model.tokenize, [], []
        for place, unit in enumerate(units):
            if word := PLAIN.fullmatch(unit):
                letters = unit if self.spaced else word[2].lower()
                rows.append([t.id for t in tokenize(_byte_letters(letters))])
            else:
                rows.append([])
                others.append(place)
        encoded = self.tokenizer.encode_batch_fast([units[i] for i in others], add_special_tokens=False)
        for place, e in zip(others, encoded, strict=True):
            rows[place] = e.ids
        return np.fromiter(itertools.chain.from_iterable(rows), np.uint32), np.fromiter(map(len, rows), np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and how many each text has."""
        foreign = np.flatnonzero(pc.match_substring_regex(texts, FOREIGN_SPACE).to_numpy(zero_copy_only=False))
        if len(foreign):
            return self._encode_apart(texts, foreign)
        data, limits = text_bytes(texts)
        units, counts = cut_at(data, limits, unit_cuts(data, limits))
        numbers = self.units.numbers(units)
        return self.units.gather(numbers), segment_sums(self.units.lengths[numbers], counts)

    def _encode_apart(self, texts: pa.Array, foreign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = np.setdiff1d(np.arange(len(texts)), foreign)
        ids, lengths = self.encode(texts.take(pa.array(rest)))
        rows: list = [None] * len(texts)
        for place, own in zip(rest, np.split(ids, np.cumsum(lengths)[:-1]) if len(rest) else [], strict=True):
            rows[place] = own
        for place in foreign:
            ids = self.tokenizer.encode(texts[int(place)].as_py(), add_special_tokens=False).ids
            rows[place] = np.array(ids, np.uint32)
        return np.concatenate(rows), np.array([len(r) for r in rows])


def unit_encoder(path: str, spaced: bool) -> UnitEncoder:
    """The encoder of this Python worker."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = UnitEncoder(path, spaced)
    return _encoders[path, spaced]
