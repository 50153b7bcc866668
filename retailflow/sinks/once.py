"""Appending sinks that a repeated micro-batch does not change.

A store that only takes appends (a topic, a table of a relational store) cannot replace what a failed try left behind.  So
a batch is first written to a folder of its own, where each row gets a number that stays; what is appended is read from
there, and every try appends equal rows under equal names: the writer, the batch, the row.  When all rows are there the batch
is entered into a ledger.  A batch in the ledger is not appended again, and readers (`settled`, `drop_repeats`) see the
rows of entered batches, each once, whatever a lost executor or a stopped query has appended twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailflow.sinks.shape import positional, with_write_time
from retailflow.sinks.tables import BATCH, is_finished, numbered_folders, write_batch

WRITER, NUMBER, ROW = "_writer", "_batch", "_row"
NAMES = (WRITER, NUMBER, ROW)
Append = Callable[[DataFrame], None]


@dataclass(frozen=True)
class AppendOnce:
    """Batch writer, for `foreachBatch`, into a store that only appends.

    ``writer`` names the query; several may share a target.  ``stage`` is a folder every executor can reach; it holds
    the rows of the batch not yet entered and, in ``done``, an empty folder per entered one.  ``append`` puts rows with the
    columns `NAMES` into the target.  ``enter``, if the target can hold a ledger too, appends its one-row frame (writer and
    batch) after all rows; a stop between the two enters a batch twice, which readers do not notice.
    """

    writer: str
    stage: str
    append: Append
    enter: Append | None = None

    @property
    def _done(self) -> str:
        return f"{self.stage}/done"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if is_finished(spark, self._done, batch_id):
            return
        rows = f"{self.stage}/rows"
        if not is_finished(spark, rows, batch_id):
            write_batch(df.withColumn(ROW, F.monotonically_increasing_id()), rows, batch_id)
        staged = spark.read.schema(df.withColumn(ROW, F.lit(0).cast("bigint")).schema).parquet(f"{rows}/{BATCH}={batch_id}")
        name, number = F.lit(self.writer).alias(WRITER), F.lit(batch_id).cast("bigint").alias(NUMBER)
        self.append(staged.select(name, number, ROW, *df.columns))
        entry = spark.range(1).select(name, number)
        if self.enter is not None:
            self.enter(entry)
        write_batch(entry.limit(0), self._done, batch_id)
        self._forget(spark, batch_id)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the staged rows of entered batches; a query never asks for these again."""
        for number in numbered_folders(spark, f"{self.stage}/rows", BATCH):
            if number <= batch_id:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.stage}/rows/{BATCH}={number}")
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(rows: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Each row once, of entered batches only when the target holds a ledger; the columns `NAMES` are taken off."""
    if ledger is not None:
        rows = rows.join(ledger.select(WRITER, NUMBER), [WRITER, NUMBER], "left_semi")
    return rows.dropDuplicates(list(NAMES)).drop(*NAMES)


def drop_repeats(records: DataFrame, ts: str | None = None, horizon: str = "1 hour", key: str = "key") -> DataFrame:
    """Records of a topic by `topic_once`, each once.

    A stream gives ``ts``, the time at which the topic took the record, and remembers keys for ``horizon``: a repeat must
    not come later than that.
    """
    if ts is None:
        return records.dropDuplicates([key])
    return records.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def keyed_records(rows: DataFrame) -> DataFrame:
    """``key`` (writer/batch/row) and ``value`` (JSON) of named rows."""
    value = F.to_json(F.struct(*[c for c in rows.columns if c not in NAMES]))
    return rows.select(F.concat_ws("/", *NAMES).alias("key"), value.alias("value"))


def topic_once(writer: str, stage: str, servers: str, topic: str) -> AppendOnce:
    """JSON records under keys that repeats share; needs Spark's Kafka package.  Readers use `drop_repeats`."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return AppendOnce(writer, stage, lambda rows: keyed_records(rows).write.format("kafka").options(**options).save())


def jdbc_once(
    writer: str, stage: str, url: str, table: str, ledger: str, hidden: Sequence[str] = (), **options: str
) -> Callable[[DataFrame, int], None]:
    """Window results in a relational table and its ledger table; readers join the two, as `settled` does."""

    def into(name: str) -> Append:
        return lambda df: df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()

    sink = AppendOnce(writer, stage, into(table), into(ledger))
    return lambda df, batch_id: sink(with_write_time(positional(df, hidden)), batch_id)
