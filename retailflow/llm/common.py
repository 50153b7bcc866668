"""What several operators share: the shared folder, ASCII lower case, Arrow batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that ends a word, and the letters that are lower-cased.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for a single local process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if "root" not in _local:
        _local["root"] = tempfile.mkdtemp(prefix="retailflow-llm-")
    return _local["root"]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str = "zstd", **options: int | str) -> DataFrame:
    """Write a frame to the shared folder and read it again: the lineage ends there, and any executor can go.

    ``options`` are those of Spark's Parquet writer.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does the same on pure ASCII, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from tuples; an empty input gives one empty batch."""
    held: list[tuple] = []
    sent = False
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held, sent = [], True
    if held or not sent:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)
