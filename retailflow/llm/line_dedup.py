"""Line dedup over a whole corpus, with DataFrame functions only.

Every line becomes a 128-bit hash with its document and position.  The hashes are range-partitioned together
with a slice of the document ids, so that a line found in a third of all documents is spread over many ranges;
within a range, rows are sorted by document and position and the first occurrence is streamed by a window.
First occurrences of all slices are then reduced to one per hash (partial aggregates first).  The result is not
text but one sparse keep bitmap per document, applied in a single join.

Defined results: a null or empty text is one empty line and stays; a document without an id takes no part and
stays whole; repeated rows (same id and text) get the same bitmap; rows that share an id but not the text are one
document for the rule "smallest document keeps its lines"; other columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import WHITE, lower_ascii, saved


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def occurrences(documents: DataFrame, min_length: int) -> DataFrame:
    """``h1, h2, doc_id, version, pos`` of every line whose key has ``min_length`` code points or more."""
    lines = (
        documents.where("doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
                F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_length)
    )
    # Two hashes with independent seeds: 128 bits.
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"),
                        "doc_id", "version", "pos")


def keep_bitmaps(documents: DataFrame, min_length: int = 10, slice_width: int = 1024) -> DataFrame:
    """Compressed keep bitmaps: ``doc_id, version, words`` for documents that lose lines.

    ``words`` holds, for each run of 64 lines that loses any, its number and the bits of the lost lines.
    ``slice_width`` document ids share a range of one hash, which bounds the rows sorted and streamed together.
    """
    rows = saved(occurrences(documents, min_length), "lines")
    by_slice = Window.partitionBy("h1", "h2", "slice").orderBy("doc_id", "pos")
    rows = (
        rows.withColumn("slice", F.floor(F.col("doc_id") / F.lit(slice_width)))
        .repartitionByRange("h1", "h2", "slice")
        .withColumn("first_doc", F.first("doc_id").over(by_slice))
    )
    heads = rows.where("doc_id = first_doc")
    firsts = saved(
        heads.groupBy("h1", "h2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        .where("keeper < last").drop("last"), "firsts")
    lost = rows.where("doc_id > first_doc").select("doc_id", "version", "pos").unionByName(
        heads.join(firsts, ["h1", "h2"]).where("doc_id > keeper").select("doc_id", "version", "pos"))
    return (
        lost.groupBy("doc_id", "version", F.expr("cast(pos div 64 as int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(pos % 64 as int)))").alias("bits"))
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    )


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (the document as it was), ``n_lines``, ``n_dropped``, ``kept_text``."""
    docs = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                            F.xxhash64("text").alias("version"))
    marks = bitmaps.withColumnRenamed("doc_id", "b_id").withColumnRenamed("version", "b_version")
    # The side with the bitmaps is hashed, so the texts need no sort.
    joined = docs.join(
        marks.hint("shuffle_hash"), (F.col("doc_id") == F.col("b_id")) & (F.col("version") == F.col("b_version")),
        "left")
    joined = joined.withColumn("lines", lines_of(F.col("row.text"))).withColumn(
        "bitmap", F.map_from_entries("words"))
    kept = F.expr("""
        filter(lines, (x, i) -> (shiftright(coalesce(element_at(bitmap, cast(i div 64 as int)), 0L),
                                            cast(i % 64 as int)) & 1L) = 0L)""")
    return joined.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.expr("aggregate(words, 0L, (n, w) -> n + bit_count(w.bits))"), F.lit(0).cast("long"))
        .alias("n_dropped"),
        F.when(F.col("words").isNull(), F.coalesce(F.col("row.text"), F.lit("")))
        .otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def dedup_lines(documents: DataFrame, min_length: int = 10, slice_width: int = 1024) -> DataFrame:
    """Documents with the lines that an earlier document holds taken out; see ``apply_bitmaps`` for columns."""
    return apply_bitmaps(documents, keep_bitmaps(documents, min_length, slice_width))
