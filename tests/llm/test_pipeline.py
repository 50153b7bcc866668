"""Each stage of the pipeline against brute force on what the stage before it kept."""

from __future__ import annotations

import pandas as pd
import pytest

import corpus_pipeline
from test_decontaminate import brute as brute_passages
from test_line_dedup import brute as brute_lines
from test_minhash import brute as brute_links

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.toPandas()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        result = stage(spark, docs, FOLDER)
        if i < 4:
            assert result.dtypes == docs.dtypes
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_quality_keeps_rows_as_they_are(stages):
    before, after = stages[0].set_index("doc_id"), stages[1].set_index("doc_id")
    assert 0 < len(after) < len(before)
    pd.testing.assert_frame_equal(after.sort_index(), before.loc[after.index].sort_index())
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet").set_index("doc_id")
    good = labels[(labels.quality == 1) & (labels.toxic == 0)].index.intersection(before.index)
    assert good.isin(after.index).mean() > 0.9


def test_lines(stages):
    rows = list(zip(stages[1].doc_id, stages[1].text))
    want = {d: t for d, _, lost, t in brute_lines(rows) if not lost or t}
    assert dict(zip(stages[2].doc_id, stages[2].text)) == want
    assert (stages[2].n_chars == stages[2].text.str.len()).all()


def test_near_copies(stages):
    links = brute_links(list(zip(stages[2].doc_id, stages[2].text)), width=5)
    assert set(stages[3].doc_id) == {d for d, (_, _, kept) in links.items() if kept}


def test_passages(stages):
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    hit = {r[0] for r in brute_passages(list(zip(stages[3].doc_id, stages[3].text)), list(zip(items.item_id, items.text)))
           if r[5]}
    assert set(stages[4].doc_id) == set(stages[3].doc_id) - hit


def test_pieces_cover_what_was_kept(stages):
    pieces = stages[5]
    assert set(pieces.doc_id) == set(stages[4].doc_id)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
