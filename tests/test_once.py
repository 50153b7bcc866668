"""Append-only targets under repeated, broken and retried batches; the targets are folders that only take appends."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retailflow.session import checkpoint_root
from retailflow.sinks.once import NAMES, AppendOnce, drop_repeats, keyed_records, settled

SCHEMA = "id LONG, v STRING"


class Target:
    """A folder of appended rows and its ledger; the first appends asked to fail do so with half of their rows written."""

    def __init__(self, root, failing=0, lose_entry=False):
        self.rows, self.ledger, self.failing, self.lose_entry = f"{root}/rows", f"{root}/ledger", failing, lose_entry

    def append(self, df):
        if self.failing:
            self.failing -= 1
            df.filter(F.col("id") % 2 == 0).write.mode("append").parquet(self.rows)
            raise RuntimeError("lost")
        df.write.mode("append").parquet(self.rows)

    def enter(self, df):
        df.write.mode("append").parquet(self.ledger)
        if self.lose_entry:
            self.lose_entry = False
            raise RuntimeError("lost after the entry")

    def read(self, spark, entered=True):
        rows = spark.read.parquet(self.rows)
        got = settled(rows, spark.read.parquet(self.ledger)) if entered else rows
        return sorted(tuple(r) for r in got.select("id", "v").collect())


def frame(spark, ids):
    return spark.createDataFrame([(i, "x") for i in ids], SCHEMA)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    target = Target(tmp_path / "t")
    sink = AppendOnce("w", str(tmp_path / "stage"), target.append, target.enter)
    # Equal rows are rows of their own.
    sink(frame(spark, [1, 1, 2]), 0)
    sink(frame(spark, [1, 1, 2]), 0)
    sink(frame(spark, []), 1)
    sink(frame(spark, [1]), 2)
    assert target.read(spark) == target.read(spark, entered=False) == [(1, "x")] * 3 + [(2, "x")]


def test_half_written_and_twice_entered_batches(spark, tmp_path):
    target = Target(tmp_path / "t", failing=2, lose_entry=True)
    sink = AppendOnce("w", str(tmp_path / "stage"), target.append, target.enter)
    other = AppendOnce("other", str(tmp_path / "stage-2"), target.append, target.enter)
    target_rows = range(10)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="lost$"):
            sink(frame(spark, target_rows), 0)
    with pytest.raises(RuntimeError, match="entry"):
        sink(frame(spark, target_rows), 0)
    # The repeat finds the staged rows, so it appends the same ones even if its input came in another order.
    sink(frame(spark, reversed(target_rows)), 0)
    other(frame(spark, [99]), 0)
    assert len(target.read(spark, entered=False)) == 5 + 5 + 10 + 10 + 1
    assert target.read(spark) == [(i, "x") for i in [*target_rows, 99]]
    assert not list((tmp_path / "stage" / "rows").glob("batch=*"))


def test_rows_of_a_batch_not_entered_are_not_seen(spark, tmp_path):
    target = Target(tmp_path / "t")
    sink = AppendOnce("w", str(tmp_path / "stage"), target.append, target.enter)
    sink(frame(spark, [1]), 0)
    target.failing = 1
    with pytest.raises(RuntimeError):
        sink(frame(spark, [2, 4]), 1)
    assert target.read(spark) == [(1, "x")]


def test_topic_keys_are_shared_by_repeats(spark, tmp_path):
    topic = str(tmp_path / "topic")
    lost = [False, True]

    def append(rows):
        keyed_records(rows).withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(topic)
        if lost.pop():
            raise RuntimeError("the answer was lost")

    sink = AppendOnce("w", str(tmp_path / "stage"), append)
    with pytest.raises(RuntimeError):
        sink(frame(spark, [1, 1, 2]), 0)
    sink(frame(spark, [1, 1, 2]), 0)
    records = spark.read.parquet(topic)
    assert records.count() == 6
    want = ['{"id":1,"v":"x"}'] * 2 + ['{"id":2,"v":"x"}']
    assert sorted(r.value for r in drop_repeats(records).collect()) == want
    stream = drop_repeats(spark.readStream.schema(records.schema).parquet(topic), "timestamp")
    query = stream.writeStream.format("memory").queryName("once_records").option(
        "checkpointLocation", f"{tmp_path}/records").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.value for r in spark.table("once_records").collect()) == want


def test_a_stream_that_breaks_and_starts_again(spark, tmp_path):
    source = str(tmp_path / "in")
    target = Target(tmp_path / "t", failing=1)
    sink = AppendOnce("w", str(tmp_path / "stage"), target.append, target.enter)

    def run():
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = rows.writeStream.option("checkpointLocation", f"{checkpoint_root(spark)}/once-{tmp_path.name}").foreachBatch(
            sink).trigger(availableNow=True).start()
        query.awaitTermination()

    frame(spark, range(6)).coalesce(1).write.parquet(source)
    frame(spark, range(6, 9)).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert target.read(spark) == [(i, "x") for i in range(9)]
    assert len(target.read(spark, entered=False)) > 9
    assert set(NAMES) <= set(spark.read.parquet(target.rows).columns)
