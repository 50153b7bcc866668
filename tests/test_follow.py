"""A followed table: every row of the snapshot and of the changes after it once, restarts included."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql.types import StructType

from retailflow.sinks.tables import keyed_table, write_batch
from retailflow.sources.follow import FeedReader, follow
from retailflow.streaming import jobs

ROWS = "id STRING, version LONG, amount DECIMAL(16, 2), at TIMESTAMP, data MAP<STRING, STRING>"
AT = dt.datetime(2024, 3, 1, 12)


def batch(spark, *pairs):
    return spark.createDataFrame(
        [(i, v, Decimal(v) / 4, AT + dt.timedelta(microseconds=v), {"v": str(v)}) for i, v in pairs], ROWS)


def taken(spark, root, number):
    """Rows that one more start of the same query takes."""
    out = root / f"out{number}"
    jobs.start(follow(spark, str(root / "table"), ROWS), "follow",
               lambda df, n: write_batch(df, str(out), n), checkpoints=str(root / "check")).awaitTermination()
    if not any(out.glob("*/*.parquet")):
        return Counter()
    return Counter((r.id, r.version, r.amount, r.at, r.data["v"]) for r in spark.read.schema(ROWS).parquet(str(out)).collect())


def expected(*pairs):
    return Counter((i, v, Decimal(v) / 4, AT + dt.timedelta(microseconds=v), str(v)) for i, v in pairs)


def test_snapshot_then_changes_over_restarts(spark, tmp_path):
    table = keyed_table(str(tmp_path / "table"), "id", "version", schema=ROWS)
    table.merge(batch(spark, ("a", 1), ("b", 1)), 0)
    table.merge(batch(spark, ("a", 2)), 1)
    table.compact(spark)
    table.merge(batch(spark, ("c", 3)), 2)
    # The snapshot holds the latest of batches 0 and 1; batch 2 follows it.
    assert taken(spark, tmp_path, 0) == expected(("a", 2), ("b", 1), ("c", 3))
    assert taken(spark, tmp_path, 1) == Counter()
    table.merge(batch(spark, ("b", 4)), 3)
    table.compact(spark)
    table.merge(batch(spark, ("d", 5), ("a", 6)), 4)
    # A newer snapshot is no news for a query that is under way.
    assert taken(spark, tmp_path, 2) == expected(("b", 4), ("d", 5), ("a", 6))


def test_from_the_first_batch_of_an_empty_table(spark, tmp_path):
    table = keyed_table(str(tmp_path / "table"), "id", "version", schema=ROWS)
    assert taken(spark, tmp_path, 0) == Counter()
    table.merge(batch(spark, ("a", 1)), 0)
    # A batch that is not finished is not read.
    (tmp_path / "table" / "changes" / "batch=1").mkdir(parents=True)
    assert taken(spark, tmp_path, 1) == expected(("a", 1))
    table.merge(batch(spark, ("a", 2)), 1)
    assert taken(spark, tmp_path, 2) == expected(("a", 2))


def test_a_range_that_is_read_again_gives_the_same_files(spark, tmp_path):
    table = keyed_table(str(tmp_path / "table"), "id", "version", schema=ROWS)
    table.merge(batch(spark, ("a", 1)), 0)
    table.compact(spark)
    table.merge(batch(spark, ("a", 2)), 1)
    reader = FeedReader(StructType.fromDDL(ROWS), str(tmp_path / "table"))
    start, end = reader.initialOffset(), reader.latestOffset()
    before = sorted(p.path for p in reader.partitions(start, end))
    table.merge(batch(spark, ("b", 3)), 2)
    table.compact(spark)
    again = FeedReader(StructType.fromDDL(ROWS), f"file://{tmp_path}/table")
    assert sorted(p.path for p in again.partitions(start, end)) == before and len(before) >= 2
    assert all("batch=1" in p.path or "batch=0" in p.path for p in again.partitions(start, end))
