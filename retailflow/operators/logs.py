"""Application log operators: parsing, the dirty output and the five typed outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from retailflow import schemas
from retailflow.operators.ordered import order_key



# Objects and lists of objects inside a record.
_PARTS = "common MAP<STRING, STRING>, page MAP<STRING, STRING>, displays ARRAY<MAP<STRING, STRING>>, actions ARRAY<MAP<STRING, STRING>>"


def _whole(text: Column) -> Column:
    """Whether the text is exactly one JSON object.

    The parser stops after the first complete value.  So the text is put into an array in front of a number that
    depends on it: other text behind the record, or a second record, moves that number away.  A value that begins with
    a brace is an object.
    """
    mark = F.xxhash64(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    return F.try_variant_get(both, "$[1]", "bigint").eqNullSafe(mark) & F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def _numbers(text: Column) -> Column:
    """Whole part of a number, whether written plain, in quotes or with decimals; null for other text."""
    return text.try_cast("decimal(38,9)").try_cast("bigint")


def _part(record: Column, fields: T.StructType) -> Column:
    """A nested object: its named fields, and under ``more`` all others."""
    names = fields.names
    known = [_numbers(record[f.name]) if isinstance(f.dataType, T.LongType) else record[f.name] for f in fields]
    more = F.map_filter(record, lambda key, _: ~key.isin(names))
    return F.when(record.isNotNull(), F.struct(*[c.alias(n) for c, n in zip(known, names)], more.alias("more")))


def _texts(lines: DataFrame, value: str) -> DataFrame:
    return lines.select(*[c for c in lines.columns if c != value], F.explode(F.array(F.col(value))).alias("value"))


def parse_logs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse log text into the log columns; the text stays as ``value`` and ``dirty`` marks bad text.

    Text is dirty if it is not exactly one JSON object; a field of another type than usual does not make it so.  A
    number may stand in quotes or have decimals, and a part of a wrong kind is null.  Fields that the schema does
    not name are kept as text: in ``common.more``, ``page.more`` and, for the record itself, ``more``.
    The text and the parsed record pass through generators, which keep the optimizer from copying what made the text
    into the parsers, and the parsers into every filter above them: each text is made and parsed once.
    """
    others = [c for c in lines.columns if c != value]
    text = F.col("value")
    found = _texts(lines, value).select(*others, "value", F.inline(F.array(F.struct(
        F.coalesce(_whole(text), F.lit(False)).alias("whole"), F.from_json(text, "MAP<STRING, STRING>").alias("record"),
        F.from_json(text, _PARTS).alias("parts")))))
    typed = {
        "common": _part(F.col("parts.common"), schemas.LOG["common"].dataType),
        "page": _part(F.col("parts.page"), schemas.LOG["page"].dataType),
        "start": F.col("record")["start"], "displays": F.col("parts.displays"), "actions": F.col("parts.actions"),
        "err": F.col("record")["err"], "ts": _numbers(F.col("record")["ts"]),
        "more": F.map_filter("record", lambda key, _: ~key.isin(schemas.LOG.names)),
    }
    return found.select(*others, "value", (~F.col("whole")).alias("dirty"), *[
        F.when(F.col("whole"), column).alias(name) for name, column in typed.items()])


def land_logs(parsed: DataFrame, path: str) -> DataFrame:
    """Store parsed logs and read them back: the text is parsed once, and each output reads its own columns."""
    parsed.write.parquet(path)
    return parsed.sparkSession.read.schema(parsed.schema).parquet(path)


def bad_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Dirty texts alone: they are judged without being taken apart."""
    return _texts(lines, value).select("value").filter(~F.coalesce(_whole(F.col("value")), F.lit(False)))


def dirty_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("dirty").select("value")


def clean_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("dirty")).drop("dirty", "value")


def first_visit_order(ts: Column, new: Column) -> Column:
    """One number that orders the records of a device: by time, then those not flagged new first."""
    return F.coalesce(ts.cast("decimal(20,0)"), F.lit(2**63 - 1)) * 2 + new.cast("int")


def repair_new_visitor(
    df: DataFrame,
    key: Column,
    is_new: Column,
    day: Column,
    order: Sequence[str],
) -> DataFrame:
    """Add ``repaired_is_new``: a device flagged new on a later day than its first visit is not new.

    The first row of a device in ``order`` fixes its first day for ever: its own day if it is flagged
    new, else the day before.  That is one small aggregate per device, joined back to the rows.  The
    join, unlike a window over the device, lets adaptive execution split a hot device.
    """
    flagged = df.withColumn("_key", key).withColumn("_new", is_new.eqNullSafe("1")).withColumn("_day", day)
    first = flagged.groupBy("_key").agg(
        F.min_by(F.when(F.col("_new"), F.col("_day")).otherwise(F.date_sub("_day", 1)),
                 order_key(order)).alias("_first_day")
    )
    not_new = F.col("_new") & (F.col("_day") != F.col("_first_day"))
    return (
        flagged.join(first, "_key", "left")
        .withColumn("repaired_is_new", F.when(not_new, F.lit("0")).otherwise(is_new))
        .drop("_key", "_new", "_day", "_first_day")
    )


def repair_logs(logs: DataFrame, day: Column) -> DataFrame:
    """`repair_new_visitor` on parsed logs: ``common.is_new`` is replaced in place.

    Of two records of one device with equal time the one not flagged new counts as the earlier; records without a
    time come last.
    """
    new = F.col("common.is_new").eqNullSafe("1")
    ordered = logs.withColumn("_order", first_visit_order(F.col("ts"), new))
    repaired = repair_new_visitor(ordered, F.col("common.mid"), F.col("common.is_new"), day, ["_order"]).drop("_order")
    return repaired.withColumn(
        "common", F.col("common").withField("is_new", F.col("repaired_is_new"))
    ).drop("repaired_is_new")


def error_log(logs: DataFrame) -> DataFrame:
    """Records with an error, whole; they also go on to the start or page output."""
    return logs.filter(F.col("err").isNotNull())


def start_log(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("start").isNotNull()).drop("err")


def _page_records(logs: DataFrame) -> DataFrame:
    # A record with neither start nor page reaches the error output only.
    return logs.filter(F.col("start").isNull() & F.col("page").isNotNull())


def page_log(logs: DataFrame) -> DataFrame:
    return _page_records(logs).drop("err", "start", "displays", "actions")


def display_log(logs: DataFrame) -> DataFrame:
    """One row per displayed item with the record's ``common``, page id and time."""
    return _page_records(logs).select(
        F.explode("displays").alias("display"), "common", F.col("page.page_id").alias("page_id"), "ts"
    )


def action_log(logs: DataFrame) -> DataFrame:
    """One row per action with the record's ``common`` and page id; an action carries its own time."""
    return _page_records(logs).select(
        F.explode("actions").alias("action"), "common", F.col("page.page_id").alias("page_id")
    )


def split_logs(logs: DataFrame) -> dict[str, DataFrame]:
    """The five outputs of one log frame, by name."""
    return {
        "error": error_log(logs),
        "start": start_log(logs),
        "display": display_log(logs),
        "action": action_log(logs),
        "page": page_log(logs),
    }


def page_columns(pages: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """Flatten a page log to the columns the visit operators use, and those to ``keep``."""
    named = [f"{part}.{name}" for part in ("common", "page") for name in schemas.LOG[part].dataType.names]
    return pages.select(*named, "ts", *keep)
