"""Token operators against the libraries themselves."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierline.llm.packing import complete, pack, plan_rows, plan_sequences
from tierline.llm.queries import BYTE_BPE, PIECES, WORD_BPE
from tierline.llm.sentence_pieces import decode_pieces, encode_pieces
from tierline.llm.token_count import token_counts
from tierline.llm.token_store import Codes, pack_codes, read_documents, token_store, write_tokens


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_counts_equal_the_library(docs, rows, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted((-1 if i is None else i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, _ in rows)
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, token_counts(docs, PIECES).collect())) == want
    assert token_counts(nothing, PIECES).count() == 0


def test_pieces_equal_the_library_and_decode(docs, rows, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = encode_pieces(docs, PIECES)
    want = sorted((-1 if i is None else i, library.encode(t or "")) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in encoded.collect()) == want
    # the vocabulary writes a blank and its own mark alike
    assert all(r.decoded_equal for r in encoded.collect() if r.doc_id != 1009)
    back = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in decode_pieces(encoded, PIECES).collect())
    assert back == sorted((-1 if i is None else i, (t or "").replace("▁", " ")) for i, t, _ in rows)
    assert encode_pieces(nothing, PIECES).count() == 0


def test_stored_tokens_equal_the_library(spark, docs, rows, nothing, folder):
    library = Tokenizer.from_file(BYTE_BPE)
    start, want = 0, []
    for i, t in sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        want.append((start, i, len(ids), crc(ids)))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store(docs, BYTE_BPE).collect()) == want
    small = folder("small-segments")
    write_tokens(docs, small, BYTE_BPE, 0, segment_tokens=500)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_documents(spark, small).collect()) == want
    assert token_store(nothing, BYTE_BPE).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65536, 2**32 - 1, 7], list(range(0, 70000, 13))])
def test_every_token_has_an_address(ids):
    codes = Codes(pack_codes(np.array(ids, np.uint32)))
    assert codes.tokens().tolist() == ids
    assert [codes.token(i) for i in range(len(ids))] == ids
    for begin in range(0, len(ids), 997):
        assert codes.tokens(begin, begin + 700).tolist() == ids[begin : begin + 700][: max(0, codes.n - begin)] or begin + 700 > codes.n
    with pytest.raises(IndexError):
        codes.token(len(ids))


def test_packing_places_every_token_once(docs, rows, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    want, total = [], 0
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        want += [(-1 if i is None else i, k // 4096, k, len(ids[k : k + 4096]), crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)]
    placed = pack(docs, WORD_BPE).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == sorted(want)
    sequences = {}
    for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 4096 and len(sequences) <= math.ceil(total / 4096) + 1
    assert pack(nothing, WORD_BPE).count() == 0


def test_ids_travel_with_their_pieces(docs):
    for r in pack(docs.limit(20), WORD_BPE, with_ids=True).collect():
        assert len(r.ids) == r.length and crc(r.ids) == r.ids_crc32


@pytest.mark.parametrize("seed", range(6))
def test_plans_cover_the_histogram(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randrange(1, 101): rnd.choice([1, 2, 50, 10**9]) for _ in range(rnd.choice([1, 5, 60]))}
    plan = plan_sequences(histogram, 100)
    used = {}
    for p in plan:
        assert sum(n * k for n, k in p.filling) <= 100
        for n, k in p.filling:
            used[n] = used.get(n, 0) + k * p.times
    assert used == histogram
    rows = plan_rows(plan)
    assert sum(times * copies for _, _, times, copies, _, _ in rows) == sum(histogram.values())


@pytest.mark.parametrize("seed", range(20))
def test_a_filling_wastes_as_little_as_any(seed):
    rnd = random.Random(seed)
    counts = dict(sorted((rnd.randrange(2, 60), rnd.randrange(1, 4)) for _ in range(8)))
    room = rnd.randrange(1, 200)
    reachable = {0}
    for n, k in counts.items():
        reachable = {r + n * j for r in reachable for j in range(k + 1) if r + n * j <= room}
    assert sum(n * k for n, k in complete(counts, list(counts), room, nodes=10**6)) == max(reachable)
