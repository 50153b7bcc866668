"""The first day of every device ever seen, stored so that a micro-batch reads only what it asks for.

A snapshot is cut into buckets by a hash of the device, as many as keep a bucket at about ``rows_per_bucket`` rows.  A
bucket is one file, sorted by that hash, in groups of ``rows_per_group`` rows with a Bloom filter each.  A batch reads the
buckets its devices fall into; if it has at most ``lookups`` devices, their hashes are pushed into the scan as well, and
Parquet reads only groups whose Bloom filter does not deny all of them: about one group per device known, and none for a
device never seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailflow.sinks.tables import BATCH, finished_batches, numbered_folders, write_batch

BUCKETS, BUCKET = "buckets", "bucket"
CHANGE_ROWS = "mid STRING, first_day DATE"
SNAPSHOT_ROWS = f"{CHANGE_ROWS}, hash LONG, {BUCKETS} INT, {BUCKET} INT"


def device_hash(mid: Column) -> Column:
    return F.xxhash64(mid)


@dataclass(frozen=True)
class FirstVisits:
    """``mid, first_day``, each device once, stored by the batch that saw it first.

    Between two snapshots the rows of the batches are read whole; `compact` from time to time keeps them few.
    """

    root: str
    rows_per_bucket: int = 200_000
    rows_per_group: int = 10_000
    lookups: int = 2_000

    @property
    def _changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def _snapshots(self) -> str:
        return f"{self.root}/snapshots"

    def _newest(self, spark: SparkSession) -> tuple[int, str | None]:
        done = finished_batches(spark, self._snapshots)
        return (done[-1], f"{self._snapshots}/{BATCH}={done[-1]}") if done else (-1, None)

    def _snapshot(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(SNAPSHOT_ROWS).parquet(path)

    def _recent(self, spark: SparkSession, after: int, before: int | None = None) -> DataFrame:
        numbers = [b for b in finished_batches(spark, self._changes) if b > after and (before is None or b < before)]
        if not numbers:
            return spark.createDataFrame([], CHANGE_ROWS)
        return spark.read.schema(CHANGE_ROWS).parquet(*[f"{self._changes}/{BATCH}={b}" for b in numbers])

    def touched(self, devices: DataFrame) -> DataFrame | None:
        """Rows of the newest snapshot that may belong to ``devices`` (``mid``, each once); None without a snapshot."""
        spark = devices.sparkSession
        _, path = self._newest(spark)
        if path is None:
            return None
        (count,) = numbered_folders(spark, path, BUCKETS)
        hashes = devices.select(device_hash(F.col("mid")).alias("hash"))
        # No more numbers than there are buckets.
        asked = [r[0] for r in hashes.select(F.pmod("hash", F.lit(count)).cast("int")).distinct().collect()]
        rows = self._snapshot(spark, path).where(F.col(BUCKET).isin(asked))
        few = [r.hash for r in hashes.limit(self.lookups + 1).collect()]
        return rows.where(F.col("hash").isin(few)) if len(few) <= self.lookups else rows

    def known(self, devices: DataFrame, before: int) -> DataFrame:
        """``mid, first_day`` of those ``devices`` that earlier batches have stored."""
        spark = devices.sparkSession
        recent = self._recent(spark, self._newest(spark)[0], before)
        stored = self.touched(devices)
        rows = recent if stored is None else stored.select("mid", "first_day").unionByName(recent)
        return rows.join(devices.select("mid"), "mid", "left_semi")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows.select("mid", "first_day"), self._changes, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        upto, path = self._newest(spark)
        recent = self._recent(spark, upto)
        return recent if path is None else self._snapshot(spark, path).select("mid", "first_day").unionByName(recent)

    def compact(self, spark: SparkSession) -> None:
        """Write a snapshot of everything up to the newest finished batch, in as many buckets as it needs now."""
        batches = finished_batches(spark, self._changes)
        if not batches or batches[-1] == self._newest(spark)[0]:
            return
        rows = self.read(spark).withColumn("hash", device_hash(F.col("mid")))
        count, size = 1, rows.count()
        while count * self.rows_per_bucket < size:
            count *= 2
        cut = rows.withColumn(BUCKETS, F.lit(count)).withColumn(BUCKET, F.pmod("hash", F.lit(count)).cast("int"))
        cut.repartition(count, BUCKET).sortWithinPartitions(BUCKET, "hash").write.mode("overwrite").partitionBy(
            BUCKETS, BUCKET
        ).options(**{
            "parquet.bloom.filter.enabled#hash": "true",
            "parquet.bloom.filter.expected.ndv#hash": str(self.rows_per_group),
            "parquet.enable.dictionary#hash": "false",
            "parquet.block.row.count.limit": str(self.rows_per_group),
        }).parquet(f"{self._snapshots}/{BATCH}={batches[-1]}")
