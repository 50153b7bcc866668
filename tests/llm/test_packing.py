"""Packing: every id in exactly one piece, gapless windows, ids equal to the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pytest

from retailflow.llm.packing import Encoder, Packer, pack

TEXTS = [
    None, "", "word", " lead", "trail ", "two  spaces", "tab\t x", "line\n next", "line \nnext", "a\n\nb c", "it's 12 x",
    "<|endoftext|> is text", "naïve größe 中文  x", "x " * 3000, "é" * 5000, "a.b,c;d", "  ", "\n", "\x1c y \x85 z",
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def check_pieces(rows: pd.DataFrame, ids: dict, room: int = 1024) -> None:
    for doc, pieces in rows.groupby("doc_id"):
        at = 0
        for p in pieces.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids[doc])
            part = np.array(ids[doc][at:at + p.length], dtype="<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            at += p.length
        assert at == len(ids[doc])
    assert set(rows.doc_id) == set(ids)
    for _, window in rows.sort_values("offset").groupby("sequence_id"):
        assert list(window.offset) == [0, *window.length.cumsum()[:-1]]
        assert window.length.sum() <= room


def test_encoder_equals_library(library):
    encode = Encoder(remembered=3)
    for text in TEXTS:
        assert encode(text or "") == library(text or ""), text


def test_pieces_of_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack(docs.repartition(3)).toPandas()
    ids = {r.doc_id: [*library(r.text or ""), 0] for r in docs.toPandas().itertuples()}
    check_pieces(rows, ids)
    assert rows.length.sum() > 0.985 * 1024 * rows.sequence_id.nunique()


def test_edge_texts_and_clashing_columns(spark, library):
    data = [(i, t, i, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(data, "doc_id int, text string, start int, part string")
    check_pieces(pack(docs).toPandas(), {i: [*library(t or ""), 0] for i, t in enumerate(TEXTS)})


def test_empty_table_null_ids_and_repeats(spark):
    schema = "doc_id long, text string"
    assert pack(spark.createDataFrame([], schema)).count() == 0
    rows = pack(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], schema)).toPandas()
    assert len(rows) == 3 and rows.doc_id.isna().sum() == 1 and rows.length.eq(3).all()


def test_open_windows_are_bounded():
    packer = Packer(0, 100, 4, 5)
    out, total = [], 0
    rng = np.random.default_rng(1)
    for doc in range(500):
        ids = np.arange(rng.integers(1, 300), dtype="<u4")
        total += len(ids)
        out += packer.add(doc, ids)
        assert len(packer.open) <= 4
    out += packer.finish()
    assert sum(r[2] for r in out) == total and sum(r[7] is not None for r in out) >= 0
    assert total > 0.97 * 100 * len({r[5] for r in out})
