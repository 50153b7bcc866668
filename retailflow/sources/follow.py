"""A keyed table as a stream: its newest snapshot first, then the batches after it.

What a change-capture reader does on its first start: take the table as it stands, hand over to the changes at exactly that
point, and go on from the changes after a restart.  Register once with ``spark.dataSource.register(TableFeed)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from retailflow.sinks.tables import BATCH


class StoredFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class FeedReader(DataSourceStreamReader):
    """Offsets: the newest finished batch that was read, and the snapshot a first read starts from.

    The first range covers a snapshot's files and the batches after that snapshot; each later one only batches.  Which
    snapshot it was stands in the logged end of the first range, so a repeated range gives the same files although the table
    may have been folded again meanwhile.
    """

    def __init__(self, schema: StructType, root: str):
        self.columns = to_arrow_schema(schema)
        self.files, self.root = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (
            fs.LocalFileSystem(), root)

    def _listed(self, path: str, recursive: bool = False) -> list[fs.FileInfo]:
        return self.files.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=recursive))

    def _finished(self, folder: str) -> list[int]:
        names = [f.base_name for f in self._listed(f"{self.root}/{folder}") if f.base_name.startswith(f"{BATCH}=")]
        marks = self.files.get_file_info([f"{self.root}/{folder}/{n}/_SUCCESS" for n in names])
        return sorted(int(n.split("=")[1]) for n, mark in zip(names, marks) if mark.type == fs.FileType.File)

    def initialOffset(self) -> dict:
        return {"snapshot": -1, "batch": -1, "begun": False}

    def latestOffset(self) -> dict:
        snapshot = max(self._finished("snapshots"), default=-1)
        newest = max(self._finished("changes"), default=-1)
        return {"snapshot": snapshot, "batch": max(snapshot, newest), "begun": max(snapshot, newest) >= 0}

    def partitions(self, start: dict, end: dict) -> list[StoredFile]:
        first = not start["begun"]
        after = end["snapshot"] if first else start["batch"]
        folders = [f"changes/{BATCH}={b}" for b in self._finished("changes") if after < b <= end["batch"]]
        if first and end["snapshot"] >= 0:
            folders.append(f"snapshots/{BATCH}={end['snapshot']}")
        return [StoredFile(f.path) for folder in folders for f in self._listed(f"{self.root}/{folder}", True)
                if f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", "."))]

    def read(self, partition: StoredFile) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=self.columns.names):
                by_name = {name: batch.column(name).cast(kind) if name in batch.schema.names else pa.nulls(batch.num_rows, kind)
                           for name, kind in zip(self.columns.names, self.columns.types)}
                yield pa.RecordBatch.from_arrays(list(by_name.values()), schema=self.columns)

    def commit(self, end: dict) -> None:
        pass


class TableFeed(DataSource):
    """Format ``table_feed``; option ``path`` is the keyed table's folder, the schema must be given."""

    @classmethod
    def name(cls) -> str:
        return "table_feed"

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(schema, self.options["path"])


def follow(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """Stream of a `KeyedTable`'s rows: the newest snapshot's once, then those of every later batch.

    Nothing is lost or doubled where the snapshot ends and the changes begin, nor over a restart.  A row may follow an
    older one of its key, so readers keep the latest.  One trigger takes all there is; a file is one task's work, read in
    batches.  A batch that is finished must not be written anew with other rows.  Columns by which the table is
    partitioned are not in its files and come as nulls; columns a file lacks do too.
    """
    spark.dataSource.register(TableFeed)
    return spark.readStream.format(TableFeed.name()).schema(schema).option("path", root).load()
