"""Text records and what is parsed from them, in batch and as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retailflow import schemas


def topic_lines(
    spark: SparkSession, servers: str, topic: str, stream: bool = True,
    per_trigger: int = 1_000_000, positions: bool = False, **options: str,
) -> DataFrame:
    """Records of a topic as a ``value`` column; a record without payload becomes an empty text.

    Needs Spark's Kafka package on the class path.  A stream resumes from its checkpoint; ``per_trigger``
    bounds what one micro-batch, and so one key of it, can hold.  ``positions`` adds the record's
    ``partition`` and ``offset``, which order changes of the same second.
    """
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    if stream:
        settings.setdefault("maxOffsetsPerTrigger", str(per_trigger))
        reader = spark.readStream
    else:
        reader = spark.read
    return payload(
        reader.format("kafka").options(**settings).load(), ("partition", "offset") if positions else ()
    )


def payload(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text of topic records."""
    return records.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), *keep)


def file_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int = 1000
) -> DataFrame:
    """Text files as records, one per line."""
    if stream:
        return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return spark.read.text(path)


def json_table(lines: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """Declared columns of JSON records; text that does not parse gives a row of nulls.

    Other columns of ``lines`` are kept behind the declared ones.
    """
    others = [c for c in lines.columns if c != value]
    return lines.select(F.from_json(value, schema).alias("_row"), *others).select("_row.*", *others)


def changelog_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """Database change rows of JSON records."""
    return json_table(lines, schemas.CHANGELOG, value)
