"""Clock conversions that do not depend on the session time zone.

The shop's text timestamps carry no zone; a zone offset is an argument with the shop's offset as default.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: offset of the shop's clock.
SHOP_OFFSET = "+08:00"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _offset_minutes(offset: str) -> int:
    sign = -1 if offset.startswith("-") else 1
    hours, minutes = offset.lstrip("+-").split(":")
    return sign * (int(hours) * 60 + int(minutes))


def wall_millis(ts: Column) -> Column:
    """Milliseconds between 1970-01-01 00:00 and a zone-less timestamp, both on the same wall clock."""
    since = (ts.cast("timestamp_ntz") - F.expr(_EPOCH)).cast("interval second")
    return (since.cast("decimal(20,6)") * 1000).cast("bigint")


def text_millis(text: Column, offset: str = SHOP_OFFSET) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` text; null when it does not parse."""
    full = F.when(F.length(text) <= 10, F.concat(text, F.lit(" 00:00:00"))).otherwise(text)
    return F.unix_millis(F.concat(full, F.lit(offset)).try_cast("timestamp"))


def millis_wall(millis: Column, offset: str = SHOP_OFFSET) -> Column:
    """Wall-clock timestamp (no zone) of epoch milliseconds."""
    seconds = (millis.cast("decimal(20,0)") / 1000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(_offset_minutes(offset)), seconds
    )


def millis_text(millis: Column, offset: str = SHOP_OFFSET) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of epoch milliseconds (fraction dropped)."""
    return wall_text(millis_wall(whole_seconds(millis), offset))


def millis_date(millis: Column, offset: str = SHOP_OFFSET) -> Column:
    """``yyyy-MM-dd`` text of epoch milliseconds."""
    return day_text(millis_wall(millis, offset))


def whole_seconds(millis: Column) -> Column:
    """Epoch milliseconds with the part below one second dropped."""
    return millis - millis % 1000


def wall_text(ts: Column) -> Column:
    """Text of a timestamp that falls on a whole second, as the result tables write it."""
    return ts.cast("string")


def day_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def text_day(text: Column) -> Column:
    """Date part of a text timestamp: everything before the first blank."""
    return F.substring_index(text, " ", 1)


def date_id(text: Column) -> Column:
    """``yyyy-MM-dd`` of a text timestamp; null when it does not parse."""
    return text.try_cast("date").cast("string")


def text_wall(text: Column) -> Column:
    """Zone-less timestamp of text; null when it does not parse."""
    return text.try_cast("timestamp_ntz")


def compare_instants(left: Column, right: Column) -> Column:
    """Order of two ``yyyy-MM-dd HH:mm:ss[.fraction]Z`` texts: -1, 0 or 1 at millisecond precision.

    ``.04Z`` and ``.040Z`` are the same instant.
    """
    a = F.unix_millis(left.try_cast("timestamp"))
    b = F.unix_millis(right.try_cast("timestamp"))
    return F.signum((a - b).cast("double")).cast("int")
