"""First visits in buckets: right rows, and what a batch reads does not grow with the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from retailflow.sinks.first_visits import FirstVisits, device_hash
from retailflow.sinks.tables import numbered_folders

DAY = dt.date(2024, 3, 1)
GROUP = 500
DEVICES = "mid STRING, first_day DATE"


def devices(spark, *names):
    return spark.createDataFrame([(n, DAY) for n in names], DEVICES)


def filled(spark, path, size):
    table = FirstVisits(str(path), rows_per_bucket=5_000, rows_per_group=GROUP, lookups=50)
    table.add(spark.range(size).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("mid"),
        F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int")).alias("first_day")), 0)
    table.compact(spark)
    return table


def scanned(df):
    """Files and rows that the scan of a frame read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    metrics = leaf.metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_a_batch_reads_only_what_it_asks_for(spark, tmp_path):
    asked = devices(spark, "m7", "m4999", "m19000", "new1", "new2")
    reads = []
    for size in (20_000, 160_000):
        table = filled(spark, tmp_path / str(size), size)
        assert {(r.mid, r.first_day) for r in table.known(asked, 1).collect()} == {
            (f"m{i}", DAY + dt.timedelta(i % 300)) for i in (7, 4999, 19000)}
        reads.append(scanned(table.touched(asked)))
        (path,) = (tmp_path / str(size) / "snapshots").glob("batch=0")
        assert numbered_folders(spark, str(path), "buckets") == [size // 5_000]
        many = devices(spark, *(f"m{i * 37}" for i in range(40)))
        assert table.known(many, 1).count() == 40
        reads.append(scanned(table.touched(many)))
    # A group for each known device, and a few more where a Bloom filter errs: no more in a table eight times as large.
    (_, small), (_, small_many), (_, large), (_, large_many) = reads
    assert max(small, large) <= 6 * GROUP and max(small_many, large_many) <= 50 * GROUP, reads


def test_a_large_batch_reads_the_buckets_it_touches(spark, tmp_path):
    table = filled(spark, tmp_path, 20_000)
    asked = spark.range(0, 40_000, 4).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("mid"))
    assert table.known(asked, 1).count() == 5_000
    first = asked.where(F.pmod(device_hash(F.col("mid")), F.lit(4)) == 2)
    files, rows = scanned(table.touched(first))
    assert first.count() > table.lookups and files == 1 and 4_000 < rows < 6_000


def test_batches_before_and_after_a_snapshot(spark, tmp_path):
    table = FirstVisits(str(tmp_path))
    assert table.read(spark).count() == 0 and table.known(devices(spark, "a"), 5).count() == 0
    table.compact(spark)
    table.add(devices(spark, "a", "b"), 0)
    table.add(devices(spark).limit(0), 1)
    table.compact(spark)
    table.add(devices(spark, "c", ""), 2)

    def known(before):
        return sorted(r.mid for r in table.known(devices(spark, "a", "c", "x", ""), before).collect())

    assert known(2) == ["a"] and known(3) == ["", "a", "c"]
    table.compact(spark)
    assert known(3) == ["", "a", "c"] and sorted(r.mid for r in table.read(spark).collect()) == ["", "a", "b", "c"]
