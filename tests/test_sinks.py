from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from retailflow.session import checkpoint_root, settings
from retailflow.sinks.shape import json_lines, positional
from retailflow.sinks.tables import append_lines, keyed_table, result_writer
from retailflow.sources.records import changelog_rows, json_table, payload


def test_payload_without_value_is_empty_text(spark):
    records = spark.createDataFrame([(b"a", 1), (None, 2)], "value BINARY, offset INT")
    got = payload(records, ["offset"]).orderBy("offset").collect()
    assert [tuple(r) for r in got] == [("a", 1), ("", 2)]


def test_json_table_keeps_other_columns(spark):
    lines = spark.createDataFrame([('{"a":"1"}', 7), ("bad", 8)], "value STRING, offset INT")
    got = json_table(lines, "a STRING").orderBy("offset").collect()
    assert [tuple(r) for r in got] == [("1", 7), (None, 8)]


def test_changelog_round_trip(spark):
    line = json.dumps({"database": "d", "table": "t", "type": "update", "data": {"id": 1, "x": None},
                       "old": {"x": "2"}, "ts": 5, "other": [1]})
    row = changelog_rows(spark.createDataFrame([(line,)], "value STRING")).first()
    assert (row["data"], row["old"], row["ts"]) == ({"id": "1", "x": None}, {"x": "2"}, "5")


def test_result_writer_is_positional_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "result")
    df = spark.createDataFrame([("s", "e", ["o"], 2)], "stt STRING, edt STRING, orderIdSet ARRAY<STRING>, n INT")
    write = result_writer(path, hidden=["orderIdSet"])
    write(df, 0)
    write(df, 0)
    stored = spark.read.parquet(path)
    assert stored.drop("batch").columns == ["stt", "edt", "n", "ts"]
    assert stored.count() == 1
    now = spark.range(1).select(F.unix_millis(F.current_timestamp())).first()[0]
    assert abs(stored.first()["ts"] - now) < 600_000
    assert positional(df, ["n"]).columns == ["stt", "edt", "orderIdSet"]


def test_lines_are_repeatable(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([("a", 1)], "x STRING, y INT")
    append_lines(df, path, 3)
    append_lines(df, path, 3)
    assert [r["value"] for r in spark.read.text(path).collect()] == ['{"x":"a","y":1}']
    assert json_lines(df).columns == ["value"]


def test_keyed_table(spark, tmp_path):
    table = keyed_table(str(tmp_path / "keyed"), "id", "v")
    with pytest.raises(FileNotFoundError):
        table.read(spark)

    def batch(number, *rows_):
        table.merge(spark.createDataFrame(list(rows_), "id STRING, v INT, name STRING"), number)

    def current():
        return sorted(tuple(r) for r in table.read(spark).collect())

    batch(0, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"))
    batch(1, ("a", 1, "older version, later batch"))
    assert current() == [("a", 1, "older version, later batch"), ("b", 1, "z")]
    table.compact(spark)
    batch(2, ("c", 1, "new"))
    assert current() == [("a", 1, "older version, later batch"), ("b", 1, "z"), ("c", 1, "new")]
    batch(2, ("c", 5, "again"))
    assert current()[-1] == ("c", 5, "again")


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert settings(7)["spark.sql.shuffle.partitions"] == "7"


def test_keyed_table_without_rows(spark, tmp_path):
    table = keyed_table(str(tmp_path / "empty"), "id", "v", ["part"], "id STRING, v INT, part STRING")
    table.merge(spark.createDataFrame([], "id STRING, v INT, part STRING"), 0)
    assert table.read(spark).collect() == []
    table.compact(spark)
    table.merge(spark.createDataFrame([("a", 1, "p")], "id STRING, v INT, part STRING"), 1)
    assert [tuple(r) for r in table.read(spark).select("id", "v", "part").collect()] == [("a", 1, "p")]
