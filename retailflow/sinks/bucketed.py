"""Large dimensions stored by key, so that a lookup moves the facts only.

A snapshot of the dimension is a table bucketed and sorted by its key: a join on that key takes its buckets as they lie,
and Spark shuffles just the other side (or neither, when the facts are grouped by the key already).  Rows that changed
since the snapshot are few; they are joined apart and win over it.  So the cost of a lookup in a table of billions of rows
is one read of the columns asked for, without an exchange or a sort.

Adaptive execution does not split a hot key here, as one side of the join is not shuffled.  Group facts by the key first, so
that a key is one row; facts that must stay single and have a hot key are better off with `lookup.dimension_join`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow.operators.ordered import first_per_key
from retailflow.sinks.tables import BATCH, KeyedTable

UPTO = "retailflow.upto"


@dataclass(frozen=True)
class BucketedDimension:
    """Snapshot ``table`` (in the session's catalog) of a keyed table with one key column.

    ``buckets`` is fixed with the table: about as many as the shuffle partitions of the joins that use it.  A snapshot
    is a table of its own, named by the batch it goes up to and marked when it is whole, so a lookup that runs meanwhile reads
    the one before.  Files lie in the warehouse, or under ``path``.
    """

    source: KeyedTable
    table: str
    buckets: int
    path: str | None = None

    @property
    def key(self) -> str:
        (key,) = self.source.keys
        return key

    def snapshots(self, spark: SparkSession) -> list[int]:
        """Batch numbers up to which finished snapshots go; an unfinished one lacks the property."""
        prefix = f"{self.table}_"
        names = [t.name for t in spark.catalog.listTables(pattern=f"{prefix}*") if t.name[len(prefix):].isdigit()]
        done = [n for n in names if UPTO in _properties(spark, n)]
        return sorted(int(n[len(prefix):]) for n in done)

    def refresh(self, spark: SparkSession) -> None:
        """Write a snapshot of everything stored; the one before the last is dropped."""
        rows = self.source.rows(spark)
        if rows is None:
            return
        upto = rows.agg(F.max(BATCH)).first()[0]
        before = self.snapshots(spark)
        if upto is None or upto in before:
            return
        name = f"{self.table}_{upto}"
        self._drop(spark, upto)
        # One task per bucket, hence one file per bucket: files of one bucket need no merging to be in order.
        writer = self.source.read(spark).repartition(self.buckets, self.key).write.bucketBy(
            self.buckets, self.key).sortBy(self.key).format("parquet")
        if self.path is not None:
            writer = writer.option("path", f"{self.path}/{name}")
        writer.saveAsTable(name)
        spark.sql(f"ALTER TABLE `{name}` SET TBLPROPERTIES ('{UPTO}' = '{upto}')")
        for old in before[:-1]:
            self._drop(spark, old)

    def _drop(self, spark: SparkSession, number: int) -> None:
        name = f"{self.table}_{number}"
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        if self.path is not None:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def join(self, facts: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
        """`lookup.dimension_join` with this dimension: ``fields`` maps its columns to output names, unknown keys get null."""
        spark = facts.sparkSession
        snapshots = self.snapshots(spark)
        if not snapshots:
            raise FileNotFoundError(f"no snapshot of {self.table}; call refresh")
        upto = snapshots[-1]
        stored = spark.table(f"`{self.table}_{upto}`").select(
            F.col(self.key).alias("_key"), *[F.col(c).alias(f"_old_{n}") for c, n in fields.items()])
        out = facts.join(stored, F.col(key) == F.col("_key"), "left").drop("_key")
        recent = self._recent(spark, upto, list(fields))
        if recent is None:
            return out.select(*facts.columns, *[F.col(f"_old_{n}").alias(n) for n in fields.values()])
        out = out.join(recent, F.col(key) == F.col("_key"), "left")
        newer = F.col("_key").isNotNull()
        return out.select(*[out[c] for c in facts.columns], *[
            F.when(newer, F.col(f"_new.`{c}`")).otherwise(F.col(f"_old_{n}")).alias(n) for c, n in fields.items()])

    def _recent(self, spark: SparkSession, upto: int, columns: Sequence[str]) -> DataFrame | None:
        """Current row of each key changed since the snapshot; a deleted key has null columns."""
        rows = self.source.rows(spark)
        if rows is None:
            return None
        changed = rows.filter(F.col(BATCH) > upto)
        if changed.isEmpty():
            return None
        # A versioned table may have been sent an older version since: all stored rows of the changed keys compete.
        rivals = rows.join(changed.select(self.key).distinct(), self.key, "left_semi") if self.source.versioned else changed
        order = list(self.source.order or self.source.keys)
        names = [*order, BATCH] if self.source.versioned else [BATCH, *order]
        latest = first_per_key(rivals, [self.key], [F.col(c).desc_nulls_last() for c in names])
        gone = F.coalesce(F.col(self.source.deleted), F.lit(False)) if self.source.deleted else F.lit(False)
        return latest.select(F.col(self.key).alias("_key"), F.when(~gone, F.struct(*columns)).alias("_new"))


def _properties(spark: SparkSession, table: str) -> set[str]:
    return {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES `{table}`").collect()}
