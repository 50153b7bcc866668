"""Slowly changing tables next to the streams: dictionary, dimension configuration, stored facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailflow import schemas


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The code dictionary from Parquet, as it stands now.

    A running stream that joins this frame keeps the files listed here; `streaming.jobs.dictionary_writer` reads the
    dictionary anew in every micro-batch.
    """
    return spark.read.schema(schemas.DICTIONARY).parquet(path)


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a relational database: dictionary, configuration or a dimension kept there.

    For a table too large for one connection pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def dimension_config(spark: SparkSession, path: str) -> DataFrame:
    """Dimension configuration: read at the start of each micro-batch, so later rules count from then on."""
    return spark.read.schema(schemas.DIM_CONFIG).json(path)


def stored_rows(spark: SparkSession, path: str, schema, stream: bool = False, bytes_per_trigger: int = 10 * 2**30) -> DataFrame:
    """Rows of a fact written by another job, all versions, in batch or as a stream.

    A stream over a backlog takes at most about ``bytes_per_trigger`` in one micro-batch.
    """
    if not stream:
        return spark.read.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)


def land_changes(changes: DataFrame, path: str) -> None:
    """Store change rows in one folder per source table, so that each fact reads only its own folders.

    Every task writes its rows where they belong: there is no shuffle, and a table that makes up most of the
    topic is as spread out as the topic was.
    """
    changes.write.mode("append").partitionBy("table").parquet(path)
