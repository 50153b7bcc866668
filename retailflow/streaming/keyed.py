"""Keyed state for streams: what the batch forms do with a whole history, kept per key between batches.

First rows of a day are an aggregate inside the JVM.  What needs more than an aggregate runs in stateful processors with
typed state and timers, fed with the few columns they read: the last day of a user, the pages a device still waits on, the newest
version of an id.  A processor is called once per key and batch, and what it holds is bounded by days, by the watermark
delay, or by one row.  The output of the processors carries no watermark, but for `visits_and_jumps`, so it is written
to a table and the windows read it from there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from retailflow.functions.columns import as_list
from retailflow.operators.visits import BOUNCE_SECONDS

# Fixed value.
HOLD_MILLIS = 5000
# A little over a day, so that the day before the newest one stays open where clocks change.
DAY_DELAY = "26 hours"

VISITOR, BOUNCE = "visitor", "bounce"

_ONE_TEXT = StructType([StructField("value", StringType())])


def day_firsts(df: DataFrame, key: str | Sequence[str], ts: str, keep: Sequence[str]) -> DataFrame:
    """Earliest row of each key and day within the micro-batch that sees this key on this day first.

    An aggregate with map-side partial results, so a hot key sends one row per task.  Its state holds one row per key and
    day, and a day goes when the newest day is two days later.  A group is sent in the batch that made it and never
    again: the batch's time, which Spark fixes per batch and logs for a repeated one, tells.

    Start the query with output mode ``update``.  Output: the ``keep`` columns and ``day``.
    """
    keys = as_list(key)
    rows = df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.date_trunc("day", ts).alias("_day"),
        F.col(ts).alias("_ts"), F.struct(*keep).alias("_row"), F.current_timestamp().alias("_seen"),
    ).withWatermark("_day", DAY_DELAY)
    firsts = rows.groupBy(*[f"_k{i}" for i in range(len(keys))], "_day").agg(
        F.min_by("_row", "_ts").alias("_row"), F.min("_seen").alias("_seen"))
    return firsts.filter(F.col("_seen") == F.current_timestamp()).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep], F.col("_day").cast("date").alias("day"))


class _PreviousDay(StatefulProcessor):
    """State: a key's newest day and the one before it."""

    def __init__(self, keep: Sequence[str]):
        self.keep = list(keep)

    def init(self, handle) -> None:
        self.days = handle.getValueState("days", "newest date, earlier date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest, earlier = self.days.get() or (None, None)
        for row in sorted(rows, key=lambda r: r["day"]):
            day = row["day"]
            if newest is None or day > newest:
                previous, newest, earlier = newest, day, newest
            else:
                # A day that comes late: the key is known, and how long it had been away then is not.
                previous = earlier if earlier is not None and earlier < day else day
            yield Row(**{c: row[c] for c in self.keep}, previous_day=previous)
        self.days.update((newest, earlier))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.days.update((initialState["day"], None))

    def close(self) -> None:
        pass


def with_previous_day(firsts: DataFrame, key: str, keep: Sequence[str], history: DataFrame | None = None) -> DataFrame:
    """Add the previous active day of each key to stored `day_firsts`: null for a key never seen, which is never forgotten.

    ``firsts`` has at most one row per key and day, so a call for a key sees a handful of rows.  ``history``, ``key``
    and ``day``, is what a new query starts from: the newest day of each key in earlier results.  It is read
    when a checkpoint is made, and not when a query goes on from one.
    """
    output = StructType([*firsts.select(*keep).schema.fields, StructField("previous_day", DateType())])
    start = None
    if history is not None:
        start = history.groupBy(key).agg(F.max("day").alias("day")).groupBy(key)
    return firsts.select(*dict.fromkeys([key, *keep, "day"])).groupBy(key).transformWithState(
        _PreviousDay(keep), output, "append", "None", start)


class _FirstDay(StatefulProcessor):
    """State: the first day of a key, which never expires."""

    def __init__(self, is_new: str, keep: Sequence[str]):
        self.is_new, self.keep = is_new, list(keep)

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", "day date")

    def _repaired(self, row, day) -> Row:
        late = row[self.is_new] == "1" and row["_day"] != day
        return Row(**{c: row[c] for c in self.keep}, repaired_is_new="0" if late else row[self.is_new])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.first.get()
        if known is None:
            # Only the batch that brings a key has its rows looked at twice.
            rows = list(rows)
            known = (min(rows, key=lambda r: r["_ms"])["_first"],)
            self.first.update(known)
        for row in rows:
            yield self._repaired(row, known[0])

    def close(self) -> None:
        pass


def repair_new_visitor(df: DataFrame, key: str, is_new: str, ts: str, keep: Sequence[str]) -> DataFrame:
    """Every row with ``repaired_is_new``; the first day of a key is stored once and never expires."""
    keep = list(keep)
    day = F.col(ts).cast("date")
    clocked = df.withColumn("_ms", F.unix_millis(F.col(ts))).withColumn("_day", day).withColumn(
        "_first", F.when(F.col(is_new) == "1", day).otherwise(F.date_sub(day, 1))
    ).select(*dict.fromkeys([key, is_new, *keep]), "_ms", "_day", "_first")
    output = StructType([*clocked.select(*keep).schema.fields, StructField("repaired_is_new", StringType())])
    return clocked.groupBy(key).transformWithState(_FirstDay(is_new, keep), output, "append", "None")


def _row_text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def _rows_of_text(texts: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows back from their text, with the types they had in ``df``."""
    schema = StructType([f for name in columns for f in df.schema.fields if f.name == name])
    return texts.select(F.from_json("value", schema).alias("row")).select("row.*")


class _Jumps(StatefulProcessor):
    """State: rows the watermark has not passed, in order of arrival, and the entry whose successor is not known yet.

    One timer a key, at the earliest time at which something can be judged.  A batch appends to the list; the
    list is read and written anew only when the timer fires, and then holds what lies behind the watermark, so a row is
    moved as often as batches fit into the watermark delay.
    """

    def __init__(self, span: int):
        self.span = span

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms long, entry boolean, row string")
        self.pending = handle.getValueState("pending", "wake long, ms long, row string")

    def _wake(self, old: int | None, new: int | None, ms: int | None, row: str | None) -> None:
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is None:
            self.pending.clear()
        else:
            if old != new:
                self.handle.registerTimer(new)
            self.pending.update((new, ms, row))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [(r["_ms"], r["_entry"], r["_row"]) for r in rows]
        self.waiting.appendList(arrived)
        wake, ms, row = self.pending.get() or (None, None, None)
        first = min(a[0] for a in arrived)
        if wake is None or first < wake:
            self._wake(wake, first, ms, row)
        return iter(())

    def seen(self, ms: int, row: str) -> Iterator[Row]:
        """What an entry gives when its turn in event time comes."""
        return iter(())

    def bounce(self, ms: int, row: str) -> Row:
        return Row(value=row)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        _, ms, row = self.pending.get()
        due, later = [], []
        for item in self.waiting.get():
            (due if item[0] <= watermark else later).append(item)
        due.sort(key=lambda item: item[0])
        for at, entry, text in due:
            if ms is not None and (entry or at - ms >= self.span):
                yield self.bounce(ms, row)
            if entry:
                yield from self.seen(at, text)
            ms, row = (at, text) if entry else (None, None)
        if ms is not None and ms + self.span <= watermark:
            yield self.bounce(ms, row)
            ms, row = None, None
        if due and later:
            self.waiting.put(later)
        elif due:
            self.waiting.clear()
        ahead = [item[0] for item in later] + ([] if ms is None else [ms + self.span])
        # The timer that fired is gone already.
        self._wake(None, min(ahead) if ahead else None, ms, row)

    def close(self) -> None:
        pass


def user_jumps(
    df: DataFrame, key: str, ts: str, entry: Column, keep: Sequence[str],
    span_seconds: int = BOUNCE_SECONDS,
) -> DataFrame:
    """Session entries without another page of the same key inside the span.

    ``ts`` carries the watermark.  Rows wait in state until the watermark has passed them, so they are
    judged in event-time order even when they arrive out of order; an entry with no successor is judged
    when the watermark reaches the end of its span.
    """
    keep = list(keep)
    is_entry = F.coalesce(entry, F.lit(False))
    pages = df.select(
        key, ts, F.unix_millis(F.col(ts)).alias("_ms"), is_entry.alias("_entry"), F.when(is_entry, _row_text(keep)).alias("_row"))
    judged = pages.groupBy(key).transformWithState(_Jumps(span_seconds * 1000), _ONE_TEXT, "append", "EventTime")
    return _rows_of_text(judged, df, keep)


class _Visits(_Jumps):
    """Bounces, and the first entry of each day; both come with the end of the entry's span as their event time.

    An entry is judged at the first watermark at or after its span's end, or earlier, so that time is never behind
    the watermark that a chained operator goes by.
    """

    def init(self, handle) -> None:
        super().init(handle)
        self.day = handle.getValueState("day", "day string")

    def _row(self, kind: str, ms: int, row: str) -> Row:
        return Row(due=datetime.fromtimestamp((ms + self.span) / 1000, timezone.utc), kind=kind, value=row)

    def seen(self, ms: int, row: str) -> Iterator[Row]:
        day = (json.loads(row)["_day"],)
        if self.day.get() != day:
            self.day.update(day)
            yield self._row(VISITOR, ms, row)

    def bounce(self, ms: int, row: str) -> Row:
        return self._row(BOUNCE, ms, row)


def visits_and_jumps(
    df: DataFrame, key: str, ts: str, entry: Column, keep: Sequence[str], span_seconds: int = BOUNCE_SECONDS
) -> DataFrame:
    """First entries of a day and bounces as ``kind``, the ``keep`` columns, and ``due``: event time plus the span.

    One stateful step, whose output carries its watermark on ``due``, so that another stateful operator may follow in the
    same query.  ``ts`` carries the watermark; both kinds are judged in event-time order.
    """
    keep = list(keep)
    is_entry = F.coalesce(entry, F.lit(False))
    day = F.date_format(ts, "yyyy-MM-dd").alias("_day")
    pages = df.select(key, ts, F.unix_millis(F.col(ts)).alias("_ms"), is_entry.alias("_entry"),
                      F.when(is_entry, F.to_json(F.struct(*keep, day))).alias("_row"))
    output = StructType([StructField("due", TimestampType()), StructField("kind", StringType()), *_ONE_TEXT.fields])
    judged = pages.groupBy(key).transformWithState(
        _Visits(span_seconds * 1000), output, "append", "EventTime", eventTimeColumnName="due")
    schema = StructType([f for name in keep for f in df.schema.fields if f.name == name])
    return judged.select("due", "kind", F.from_json("value", schema).alias("row")).select("due", "kind", "row.*")


class _Latest(StatefulProcessor):
    """State: the newest version of a key and its row; a timer sends it."""

    def __init__(self, hold: int):
        self.hold = hold

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "version long, row string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.held.get()
        best = before
        for r in rows:
            if best is None or r["_version"] >= best[0]:
                best = (r["_version"], r["_row"])
        if best != before:
            self.held.update(best)
        if before is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.hold)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.held.get()
        self.held.clear()
        yield Row(value=held[1])

    def close(self) -> None:
        pass


def keep_latest(
    df: DataFrame, key: str, version: str, keep: Sequence[str], hold_millis: int = HOLD_MILLIS
) -> DataFrame:
    """Newest version of each key, sent once, ``hold_millis`` after the key's first row.

    Equal versions are decided by later arrival.  After sending, the key is forgotten, so a row that comes
    later is sent again.  ``version`` is a timestamp; null is older than any.  The hold is measured in processing time:
    a query that stops earlier keeps its rows and timers, and sends them after it is started again.  `jobs.drain` ends
    a query when everything held has been sent.
    """
    keep = list(keep)
    packed = df.select(
        key, F.coalesce(F.unix_micros(F.col(version)), F.lit(-2**63)).alias("_version"), _row_text(keep).alias("_row")
    )
    sent = packed.groupBy(key).transformWithState(_Latest(hold_millis), _ONE_TEXT, "append", "ProcessingTime")
    return _rows_of_text(sent, df, keep)
