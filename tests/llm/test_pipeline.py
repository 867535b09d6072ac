"""The stages one after the other, and that nothing else needs this package."""

from __future__ import annotations

import os
import subprocess
import sys

import zlib

import numpy as np
import __spark_entry__ as contract
import corpus_pipeline
from test_dedup import near_by_hand
from test_scans_and_models import all_spans
from tokenizers import Tokenizer

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_columns_and_pack_what_is_left(spark, docs, rows, nothing):
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, corpus_pipeline.materialise(stage(spark, left, ""), name)
        assert left.columns == before.columns and left.count() <= before.count()
    texts = [r.text for r in left.collect()]
    # a row that repeats both id and text is the same document; 1006 is the only one
    assert len(texts) == len(set(texts)) + 1 and left.where("doc_id = 1006").count() == 2
    packed = corpus_pipeline.packing(spark, left, "")
    assert packed.where("piece = 0").count() == len(texts)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0


def redacted(text):
    out, at = "", 0
    for begin, _, end, _ in all_spans(text):
        if begin >= at:
            out += text[at:begin] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_the_whole_run_equals_its_stages_in_plain_python(spark, folder):
    """All texts of the tables are of learned languages, so of the first stage only what has no letter goes.

    Rows are added with secrets in long texts, with the text of another row, and without a letter.
    """
    sf_dir = folder("corpus")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    longest = sorted(given.where("text is not null").collect(), key=lambda r: (-len(r.text), r.doc_id))
    secret = " password=hunter22 user: alice1 key " + "aB3" * 14
    added = [(9000 + k, r.text + secret, r.lang, r.source, r.n_chars) for k, r in enumerate(longest[:3])]
    added += [(9100, longest[5].text, longest[5].lang, "s", 1), (9101, "12 34 !", None, None, None)]
    given.unionByName(spark.createDataFrame(added, given.schema)).write.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    assert any(redacted(t) != t for _, t in rows)
    newest = {}
    for i, t in rows:
        newest[t] = max(i, newest.get(t, i))
    rows = [(i, t, None) for t, i in newest.items()]
    kept = {i for i, _, _, stays in near_by_hand(rows) if stays}
    tokenizer, want = Tokenizer.from_file(corpus_pipeline.WORD_BPE), []
    for i, t, _ in rows:
        if i in kept:
            ids = [*tokenizer.encode(redacted(t), add_special_tokens=False).ids, 1]
            for piece, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at : at + 4096]
                want.append((i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    assert len(kept) < len(rows)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *[o + n for o, n in sorted(parts)]]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096


def test_all_operators_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_the_rest_imports_without_this_package():
    code = (
        "import sys; sys.modules['tierline.llm'] = None; sys.modules['corpus_pipeline'] = None; "
        "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') for n in e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)
