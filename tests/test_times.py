from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from retailflow.functions import columns, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text_to_millis_uses_the_shop_offset(spark):
    assert one(spark, times.text_millis(F.lit("2022-04-01"))) == 1648742400000
    assert one(spark, times.text_millis(F.lit("2022-04-01 00:00:01"))) == 1648742401000
    assert one(spark, times.text_millis(F.lit("2022-04-01"), "+00:00")) == 1648771200000
    assert one(spark, times.text_millis(F.lit("not a date"))) is None


def test_millis_to_text(spark):
    ms = F.lit(1648742400123)
    assert one(spark, times.millis_text(ms)) == "2022-04-01 00:00:00"
    assert one(spark, times.millis_date(ms)) == "2022-04-01"
    assert one(spark, times.millis_wall(ms)) == dt.datetime(2022, 4, 1, 0, 0, 0, 123000)
    assert one(spark, times.whole_seconds(ms)) == 1648742400000
    assert one(spark, times.millis_text(ms, "-05:30")) == "2022-03-31 10:30:00"


def test_wall_millis_reverses_millis_wall(spark):
    ms = F.lit(1648742400123)
    assert one(spark, times.wall_millis(times.millis_wall(ms, "+00:00"))) == 1648742400123


def test_compare_instants(spark):
    def compare(a, b):
        return one(spark, times.compare_instants(F.lit(a), F.lit(b)))

    assert compare("2022-04-01 11:10:55.04Z", "2022-04-01 11:10:55.040Z") == 0
    assert compare("2022-04-01 11:10:55.041Z", "2022-04-01 11:10:55.04Z") == 1
    assert compare("2022-04-01 11:10:54Z", "2022-04-01 11:10:55.04Z") == -1
    assert compare("2022-04-01 11:10:55Z", "2022-04-01 11:10:55.000Z") == 0


def test_days_of_text(spark):
    assert one(spark, times.text_day(F.lit("2022-04-01 10:00:00"))) == "2022-04-01"
    assert one(spark, times.date_id(F.lit("2022-04-01 10:00:00"))) == "2022-04-01"
    assert one(spark, times.date_id(F.lit("x"))) is None


def test_keep_keys_is_exact(spark):
    data = F.create_map(F.lit("id"), F.lit("1"), F.lit("name"), F.lit("a"), F.lit(" b"), F.lit("c"))
    assert one(spark, columns.keep_keys(data, F.split(F.lit("id, b,nam"), ","))) == {"id": "1", " b": "c"}


def test_snake_to_camel(spark):
    df = spark.createDataFrame([(1, 2, 3)], "source_table INT, id INT, a_b_c INT")
    assert columns.snake_to_camel(df).columns == ["sourceTable", "id", "aBC"]


def test_money_is_exact_and_lenient(spark):
    df = spark.createDataFrame([("0.1",), ("0.2",), ("x",), (None,)], "amount STRING")
    assert str(df.select(columns.sum_money("amount").alias("s")).first()["s"]) == "0.3000"
