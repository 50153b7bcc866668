"""Search keyword segmentation with built-in expressions.

Letters and digits of any script but Han form words by themselves.  Runs of Han characters are matched against a
word table at every position, which gives all overlapping words; a character that no word covers is a word of its
own, and without a table every Han character is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A word of letters, marks and digits outside the Han script; a run and a character of it.
LETTER_RUN = r"[\p{L}\p{N}&&[^\p{IsHan}]][\p{L}\p{M}\p{N}&&[^\p{IsHan}]]*"
HAN_CHARACTER = r"\p{IsHan}"
HAN_RUN = r"\p{IsHan}+"

# Characters of a Han run that are cut into words together; a substring is counted off from its slice's beginning.
SLICE = 64
# Tasks per core that cut the distinct runs.
TASKS = 4


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def letter_words(text: Column) -> Column:
    """Lower-case letter and digit runs of a text, as an array."""
    return _all(F.lower(text), LETTER_RUN)


def han_runs(text: Column) -> Column:
    return _all(text, HAN_RUN)


def han_run_words(runs: DataFrame, words: DataFrame, run: str = "run") -> DataFrame:
    """Words of each run: ``run_id``, ``word``, one row per occurrence.  ``runs`` holds each run once, with its id.

    Only the lengths that the word table holds are tried; these few numbers are read first.  A run is cut into slices
    first, so that the work and the rows are in proportion to its length.  The words found come back to their slices, also to
    those they reach over into, one row per slice; there the characters that none covers are read off.
    """
    table = words.filter(F.col("word").rlike(f"^{HAN_RUN}$")).select("word").distinct()
    sizes = sorted(row.size for row in table.select(F.length("word").alias("size")).distinct().collect())
    sliced = runs.select(
        "run_id", run, F.explode(F.sequence(F.lit(1), F.length(run), F.lit(SLICE))).alias("_from")
    ).select(
        "run_id", "_from", F.substring(F.col(run), F.col("_from"), F.lit(SLICE - 1 + max(sizes, default=1))).alias("_text")
    )

    def slice_of(place: Column) -> Column:
        return place - F.pmod(place - 1, F.lit(SLICE))

    def last_of(hit: Column) -> Column:
        return hit["start"] + F.length(hit["word"]) - 1

    size = F.col("_size")
    last = F.least(F.lit(SLICE), F.length("_text") - size + 1)
    cut = F.transform(F.sequence(F.lit(1), last), lambda at: F.struct(
        (at + F.col("_from") - 1).alias("start"), F.substring(F.col("_text"), at, size).alias("word")))
    grams = sliced.withColumn("_size", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>"))).select(
        "run_id", F.explode(F.when(last >= 1, cut)).alias("_hit")).select("run_id", "_hit", "_hit.word")
    hit = F.col("_hit")
    found = grams.join(table, "word", "left_semi").select("run_id", "_hit", F.explode(
        F.sequence(slice_of(hit["start"]), slice_of(last_of(hit)), F.lit(SLICE))).alias("_from"))
    # At most SLICE words of each length begin in a slice, and fewer reach into it.
    per_slice = found.groupBy("run_id", "_from").agg(F.collect_list("_hit").alias("_hits"))
    hits = F.coalesce("_hits", F.array().cast("array<struct<start:int,word:string>>"))
    own = F.transform(F.filter(hits, lambda h: h["start"] >= F.col("_from")), lambda h: h["word"])
    places = F.sequence(F.col("_from"), F.col("_from") + F.least(F.lit(SLICE), F.length("_text")) - 1)
    covered = F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], last_of(h))))
    singles = F.transform(
        F.array_except(places, covered), lambda at: F.substring(F.col("_text"), at - F.col("_from") + 1, F.lit(1)))
    return sliced.join(per_slice, ["run_id", "_from"], "left").select(
        "run_id", F.explode(F.concat(own, singles)).alias("word"))


def explode_words(df: DataFrame, text: str, words: DataFrame | None = None, word: str = "word") -> DataFrame:
    """One row per word of ``text``; a text without a word (or null) yields no row.

    With a word table Han runs are segmented, once per distinct run, so a keyword that fills a third of the log is
    segmented once; its words are then joined back to the rows.  A stream uses a word table inside `foreachBatch`;
    without one the function works on streams directly.
    """
    others = [c for c in df.columns if c != text]
    if words is None:
        found = _all(F.lower(F.col(text)), f"{HAN_CHARACTER}|{LETTER_RUN}")
        return df.select(*others, F.explode(found).alias(word))
    letters = df.select(*others, F.explode(letter_words(F.col(text))).alias(word))
    rows = df.select(*others, F.explode(han_runs(F.col(text))).alias("_run"))
    # Few bytes are much work here, and adaptive execution, which goes by bytes, leaves a number given alone.
    runs = rows.select(F.col("_run").alias("run")).distinct().withColumn("run_id", F.unhex(F.md5("run"))).repartition(
        TASKS * df.sparkSession.sparkContext.defaultParallelism, "run_id")
    per_run = han_run_words(runs, words).select(F.col("run_id").alias("_id"), F.col("word").alias(word))
    han = rows.select(*others, F.unhex(F.md5("_run")).alias("_id")).join(per_run, "_id")
    return letters.unionByName(han.select(*others, word))
