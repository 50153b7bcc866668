"""Streaming jobs: the batch operators and keyed state put together per output.

A job is a function from streaming frames to a streaming frame, plus a starter that names sink and
checkpoint.  Jobs are chained through stored tables, as the topics chain them in production.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from retailflow.operators import logs, visits, windows
from retailflow.plans import dims
from retailflow.session import checkpoint_root
from retailflow.sinks.first_visits import FirstVisits
from retailflow.sinks.tables import KeyedTable, append_lines, is_finished, keyed_table, write_batch
from retailflow.streaming import keyed

# Event-time delays. The rollup waits for the bounce span.
DELAY = "2 seconds"
ROLLUP_DELAY = "14 seconds"
DEDUP_HORIZON = "5 seconds"
# Columns of stored dimension rows, as `dims.route_dimensions` makes them.
DIMENSION_ROWS = (
    "sink_table STRING, sink_pk STRING, pk STRING, type STRING, data MAP<STRING, STRING>, ts STRING,"
    " version DECIMAL(20, 0)"
)

BatchWriter = Callable[[DataFrame, int], None]


def start(
    df: DataFrame, name: str, write: BatchWriter, every: str | None = None,
    checkpoints: str | None = None, mode: str = "append",
) -> StreamingQuery:
    """Run a streaming frame into a batch writer; frames of `keyed.day_firsts` need ``mode="update"``.

    Without ``every`` the query takes what is there now and stops; its checkpoint lies under the
    session's ``spark.checkpoint.dir``, so the next start resumes.
    """
    root = checkpoint_root(df.sparkSession, checkpoints)
    writer = (
        df.writeStream.queryName(name).outputMode(mode)
        .option("checkpointLocation", f"{root}/{name}").foreachBatch(write)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(query: StreamingQuery, seconds: float = 600, pause: float = 0.2) -> None:
    """Wait until a query on a repeating trigger has read its input and holds no state, then stop it.

    For queries with processing-time timers: these run a batch at every trigger, so they never end by themselves and
    never count as having processed all.
    """
    deadline = time.monotonic() + seconds
    try:
        while time.monotonic() < deadline:
            if query.exception() is not None:
                raise query.exception()
            last = query.lastProgress
            if last and not last["numInputRows"] and all(o["numRowsTotal"] == 0 for o in last["stateOperators"]):
                return
            time.sleep(pause)
        raise TimeoutError(f"{query.name} still holds rows")
    finally:
        query.stop()


def table_writer(path: str, partition_by: Sequence[str] = ()) -> BatchWriter:
    """Writer of one folder per batch.

    A batch that is written whole is not written again, so readers that follow the folders as a stream see its files
    once.  Batch numbers start anew with a new checkpoint, which therefore needs a new folder.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if not is_finished(df.sparkSession, path, batch_id):
            write_batch(df, path, batch_id, partition_by)

    return write


def store(
    df: DataFrame, name: str, path: str, every: str | None = None, checkpoints: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Run a streaming frame into a Parquet table that another stream may read.

    Spark's file sink keeps a log of the files of each finished batch, and its readers follow that log: after a
    failure nothing comes twice.
    """
    root = checkpoint_root(df.sparkSession, checkpoints)
    writer = (
        df.writeStream.queryName(name).outputMode("append").format("parquet").partitionBy(*partition_by)
        .option("checkpointLocation", f"{root}/{name}").option("path", path)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def dictionary_writer(
    fact: Callable[[DataFrame, DataFrame], DataFrame], read_dictionary: Callable[[], DataFrame], write: BatchWriter
) -> BatchWriter:
    """Batch writer of ``fact(rows, dictionary)`` with the dictionary as it stands at the batch's start.

    A code added while the stream runs is found by the next batch.  For facts without state, such as cart
    additions, favourites and comments.
    """
    return lambda rows, batch_id: write(fact(rows, read_dictionary()), batch_id)


# --- log split --------------------------------------------------------------------------------------


def first_visit_table(path: str, **sizes: int) -> FirstVisits:
    """First day of each device.  Every device is stored once, by the batch that saw it first."""
    return FirstVisits(path, **sizes)


def log_splitter(first_visits: FirstVisits, outputs: str, value: str = "value", fold_every: int | None = None) -> BatchWriter:
    """Batch writer that parses log text, repairs the new-visitor flag and writes the six outputs.

    A batch asks ``first_visits`` for its own devices only and adds those never seen before; ``first_visits.compact`` folds
    the batches from time to time, here after every ``fold_every`` batches.  Outputs are folders ``dirty``, ``error``,
    ``start``, ``display``, ``action`` and ``page``.
    """

    def write(lines: DataFrame, batch_id: int) -> None:
        # Parsed once for all outputs; a lost executor's blocks are recomputed from the batch.
        parsed = logs.parse_logs(lines, value).persist()
        kept = [parsed]
        try:
            clean = logs.clean_logs(parsed).withColumn(
                "_day", F.timestamp_millis("ts").cast("date")
            ).withColumn("_mid", F.col("common.mid"))
            is_new = F.col("common.is_new").eqNullSafe("1")
            seen = clean.filter("_mid is not null").groupBy(F.col("_mid").alias("mid")).agg(
                F.min_by(F.when(is_new, F.col("_day")).otherwise(F.date_sub("_day", 1)),
                         logs.first_visit_order(F.col("ts"), is_new)).alias("first_day")
            ).persist()
            kept.append(seen)
            # Only earlier batches count as known, so a repeated batch gives the same rows.
            known = first_visits.known(seen, batch_id).select(
                "mid", F.col("first_day").alias("_stored"), F.lit(True).alias("_known"))
            first_days = seen.join(known, "mid", "left").select(
                F.col("mid").alias("_mid"), F.when(F.col("_known"), F.col("_stored")).otherwise(F.col("first_day"))
                .alias("first_day"), F.col("_known").isNull().alias("_added")).persist()
            kept.append(first_days)
            first_visits.add(first_days.filter("_added").withColumnRenamed("_mid", "mid"), batch_id)
            late = is_new & (F.col("_day") != F.col("first_day"))
            repaired = clean.join(first_days.drop("_added"), "_mid", "left").withColumn(
                "common", F.col("common").withField(
                    "is_new", F.when(late, F.lit("0")).otherwise(F.col("common.is_new")))
            ).drop("_mid", "_day", "first_day").persist()
            kept.append(repaired)
            logs.dirty_lines(parsed).write.mode("overwrite").text(f"{outputs}/dirty/batch={batch_id}")
            for name, df in logs.split_logs(repaired).items():
                append_lines(df, f"{outputs}/{name}", batch_id)
        finally:
            for frame in kept:
                frame.unpersist()
        if fold_every and (batch_id + 1) % fold_every == 0:
            first_visits.compact(lines.sparkSession)

    return write


# --- visits -----------------------------------------------------------------------------------------


def page_stream(pages: DataFrame) -> DataFrame:
    """Flat page rows with an event time, from a stored page log stream."""
    return logs.page_columns(pages).withColumnRenamed("ts", "ms").withColumn(
        "ts", F.timestamp_millis("ms")
    )


def unique_visitors(pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    """First session entry of each device and day; output mode ``update``."""
    return keyed.day_firsts(pages.filter(visits.is_entry()), "mid", "ts", keep).drop("day")


def user_jumps(pages: DataFrame, keep: Sequence[str], span_seconds: int = visits.BOUNCE_SECONDS) -> DataFrame:
    return keyed.user_jumps(
        pages.withWatermark("ts", DELAY), "mid", "ts", visits.is_entry(), keep, span_seconds
    )


def traffic(pages: DataFrame, span_seconds: int = visits.BOUNCE_SECONDS, width: str = windows.WINDOW) -> DataFrame:
    """Traffic rollup in one query: visitors and bounces from keyed state, chained with the window aggregate.

    Both sides of the union go by ``due``, the event time plus the span, which is when a bounce can be known; windows are
    laid so that they are those of the event time.  The watermark is the lesser of the two sides', so a window is sent once
    all of its bounces were judged.  Pages without a time are in no window.
    """
    pages = pages.filter("ts is not null")
    span = F.make_interval(secs=F.lit(span_seconds))
    counted = windows.page_counters(pages.withColumn("due", F.col("ts") + span).withWatermark("due", DELAY), "due")
    seen = keyed.visits_and_jumps(
        pages.withWatermark("ts", DELAY), "mid", "ts", visits.is_entry(), ["vc", "ch", "ar", "is_new"], span_seconds)
    seen = windows.traffic_counters(
        seen, "due", uv=F.col("kind") == keyed.VISITOR, uj=F.col("kind") == keyed.BOUNCE)
    return windows.traffic_rollup(counted.unionByName(seen), "due", width, span_seconds)


def home_detail_visitors(pages: DataFrame) -> DataFrame:
    """0/1 counters of the first home and first detail page of each device and day; output mode ``update``."""
    seen = pages.filter(F.col("page_id").isin(visits.HOME_PAGE, visits.DETAIL_PAGE))
    firsts = keyed.day_firsts(seen, ["mid", "page_id"], "ts", ["page_id", "ts"])
    return firsts.select(
        "ts",
        (F.col("page_id") == visits.HOME_PAGE).cast("bigint").alias("home"),
        (F.col("page_id") == visits.DETAIL_PAGE).cast("bigint").alias("detail"),
    )


# Columns of stored first rows of a day, as `daily_logins` and `daily_users` make them.
USER_DAYS = "user STRING, ts TIMESTAMP, day DATE"


def daily_users(df: DataFrame, user: str, ts: str) -> DataFrame:
    """First row of each user and day, as ``user``, ``ts``, ``day``; output mode ``update``."""
    rows = df.select(F.col(user).alias("user"), F.col(ts).alias("ts"))
    return keyed.day_firsts(rows, "user", "ts", ["user", "ts"])


def daily_logins(pages: DataFrame) -> DataFrame:
    """First login of each user and day; output mode ``update``."""
    return daily_users(pages.filter(visits.is_login()), "uid", "ts")


def login_visitors(firsts: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Counters of stored `daily_logins`; ``history`` (``user``, ``day``) is what earlier results hold."""
    logins = keyed.with_previous_day(firsts, "user", ["ts", "day"], history)
    gap = F.date_diff("day", "previous_day")
    return logins.select(
        "ts", F.lit(1).cast("bigint").alias("unique_user"),
        F.coalesce((gap >= visits.RETURN_DAYS).cast("bigint"), F.lit(0)).alias("back"),
    )


def paying_users(firsts: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Counters of stored `daily_users` of payments or orders; ``history`` as in `login_visitors`."""
    known = keyed.with_previous_day(firsts, "user", ["ts"], history)
    return known.select(
        "ts", F.lit(1).cast("bigint").alias("unique_user"),
        F.col("previous_day").isNull().cast("bigint").alias("new_user"),
    )


def text_time(df: DataFrame, column: str, name: str = "ts") -> DataFrame:
    """Event time from the shop's text time; the session zone is the shop's."""
    return df.withColumn(name, F.col(column).try_cast("timestamp"))


def cart_users(carts: DataFrame) -> DataFrame:
    """First cart addition of each user and day, from a cart fact stream; output mode ``update``."""
    timed = carts.withColumn("_time", F.coalesce("operate_time", "create_time"))
    return daily_users(text_time(timed, "_time"), "user_id", "ts").drop("day")


def latest_payments(paid: DataFrame) -> DataFrame:
    """One row per paid order detail: its newest version, from a payment fact stream."""
    return keyed.keep_latest(paid, "order_detail_id", "row_op_ts", ["user_id", "callback_time"])


def payment_users(latest: DataFrame) -> DataFrame:
    """First payment of each user and day, from stored `latest_payments`; output mode ``update``."""
    return daily_users(text_time(latest, "callback_time"), "user_id", "ts")


def latest_details(details: DataFrame) -> DataFrame:
    """One row per order detail: its newest version, with what the province window reads."""
    columns = ["id", "order_id", "province_id", "split_total_amount", "create_time"]
    return keyed.keep_latest(details, "id", "row_op_ts", columns)


# --- windows over stored rows -----------------------------------------------------------------------


def watermarked(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    return df.withWatermark(ts, delay)


def first_details(details: DataFrame, horizon: str = DEDUP_HORIZON, ts: str = "ts") -> DataFrame:
    """First row of each order detail id within a fixed event-time horizon."""
    return details.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(["id"])


def order_rows(details: DataFrame, users: DataFrame, ts: str = "ts") -> DataFrame:
    """Amount rows of order details and first-of-day rows of users in one schema."""
    amounts = windows.order_amounts(details)
    zero = F.lit(0).cast("bigint")
    amount_rows = details.select(
        ts, zero.alias("unique_user"), zero.alias("new_user"),
        *[c.cast("decimal(38,4)").alias(n) for n, c in amounts.items()],
    )
    user_rows = users.select(
        ts, "unique_user", "new_user",
        *[F.lit(0).cast("decimal(38,4)").alias(name) for name in amounts],
    )
    return amount_rows.unionByName(user_rows)


def order_window(rows: DataFrame, ts: str = "ts", width: str = windows.WINDOW) -> DataFrame:
    """Streaming form of the order window over `order_rows`."""
    names = ["orderActivityReduceAmount", "orderCouponReduceAmount", "orderOriginalTotalAmount"]
    return windows.tumble(
        rows, ts, [],
        [
            F.sum("unique_user").alias("orderUniqueUserCount"),
            F.sum("new_user").alias("orderNewUserCount"),
            *[F.sum(name).cast("double").alias(name) for name in names],
        ],
        width,
    )


# --- dimensions -------------------------------------------------------------------------------------


def dimension_store(root: str, ties: Sequence[str] = (), tie_type: str = "BIGINT") -> KeyedTable:
    """Keyed table of all dimensions: one row per dimension and key, one folder per dimension and batch."""
    schema = ", ".join([DIMENSION_ROWS, *[f"`{tie}` {tie_type}" for tie in ties]])
    return keyed_table(root, ["sink_table", "pk"], ["version", *ties], ["sink_table"], schema)


def dimension_writer(
    read_config: Callable[[], DataFrame], table: KeyedTable, ties: Sequence[str] = ()
) -> BatchWriter:
    """Batch writer that routes change rows by the configuration as it stands at the batch's start.

    Rows without a key are kept apart, in the folder ``rejected`` of the table.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        routed = dims.route_dimensions(changes, read_config(), ties)
        table.merge(routed.filter("pk is not null"), batch_id)
        write_batch(dims.without_key(routed), f"{table.root}/rejected", batch_id)

    return write
