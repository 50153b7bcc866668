"""From raw documents to packed training windows: a chain of the text operators.

Each stage reads what the one before it kept and returns the columns of ``documents``; the last returns pieces of
windows.  Between stages the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import decontaminate, line_dedup, minhash, packing, quality
from retailflow.llm.common import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(rows: DataFrame, like: DataFrame, text: str) -> DataFrame:
    """The columns of ``like`` from ``row``, with another text and its length."""
    changed = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in like.columns))


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier grades good; fitted on the rated ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, quality.ratings_of(labels))
    return quality.grade(docs, model).where("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line that an earlier document holds goes; a document that had text and has none left goes with them."""
    rows = line_dedup.dedup_lines(docs).where("n_dropped = 0 or kept_text <> ''")
    return _with_text(rows, docs, "kept_text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies: five words, similarity 0.8."""
    linked = minhash.link_documents(docs, width=5, percent=80)
    gone = linked.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == F.col("gone_id"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("n_hit > 0").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == F.col("gone_id"), "left_anti")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", select_quality),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_windows),
]

#: No SQL: the classifier is trained.  tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
