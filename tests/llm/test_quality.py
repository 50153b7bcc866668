"""The ordinal model on held-out labels, its gradient-free properties, and edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from retailflow.llm import quality

DOCS = "doc_id long, text string, row int, kept string"


def test_held_out_labels(spark):
    """Fitted on two thirds of the rated documents of a given table, judged on the rest."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rated = quality.ratings_of(spark.read.parquet(f"{folder}/labels.parquet"))
    model = quality.train(docs, rated.where("doc_id % 3 <> 0"), 4000)
    assert (np.diff(model.cuts) > 0).all()
    graded = quality.grade(docs.where("doc_id % 3 = 0"), model).select("row.doc_id", "kept", "expected_grade").join(rated, "doc_id")
    got = graded.groupBy("grade").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept"), F.avg("expected_grade").alias("mean")).toPandas()
    got = got.set_index("grade")
    share = got["kept"] / got["n"]
    assert share[2] > 0.97 and share[1] < 0.1
    assert got["mean"][1] < got["mean"][2]


def test_fit_separates_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 600)
    slots = [[*range(quality.DENSE), quality.DENSE + 10 + g] if g < 2 else [*range(quality.DENSE)] for g in grades.tolist()]
    model = quality.fit(slots, [[0.0] * quality.DENSE + [1.0] * (len(s) - quality.DENSE) for s in slots], grades, 2)
    scores = np.array([model.weights[quality.DENSE + 10 + g] if g < 2 else 0.0 for g in range(3)])
    expected, top = model.grades(scores)
    assert (np.diff(expected) > 0.7).all() and top[2] > 0.9 > 0.1 > top[1]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1, "x"), (1, None, 1, "x"), (None, "", 1, "x"), (2, "w " * 50_000, 1, "x")], DOCS)
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert none is None
    assert [r.kept for r in quality.grade(docs, none).collect()] == [True] * 4
    rated = spark.createDataFrame([(1, 0), (1, None), (2, 1), (None, 1), (9, 0)], "doc_id long, grade int")
    model = quality.train(docs, rated)
    rows = quality.grade(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.expected_grade <= 1 for r in rows) and rows[0].row.kept == "x"
    assert quality.grade(spark.createDataFrame([], DOCS), model).count() == 0
