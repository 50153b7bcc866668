"""Archives: an exact round trip, and revisits against brute force."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

from pyspark.sql import functions as F

from retailflow.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, value int"
LONG = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60


def test_round_trip_and_revisits(spark, tmp_path):
    rows = [(1, "http://a/x y", LONG), (5, "http://b/\r\nq", LONG), (3, None, LONG), (2, "u", "short"), (4, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", LONG + "z"), (8, "v", "x" * 1000), (9, "w", "x" * 1000),
            (9, "w", "x" * 1000), (10, "é", "y" * 999), (11, "é", "y" * 999)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA)
    got = {r.metadata.page_id: r for r in warc.round_trip(pages, path=str(tmp_path / "w")).collect()}
    assert set(got) == {r[0] for r in rows}
    for page, url, html in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        owner = max(same, default=page) if len(payload) >= 1000 else page
        row = got[page]
        measured = row.response if row.response.kind == "response" else row.original
        assert (measured.payload_bytes, measured.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert row.response.kind == ("response" if owner == page else "revisit")
        assert (row.original.page_id if row.original else None) == (None if owner == page else owner)
        assert row.request.kind == "request" and row.capture_id == row.response.record_id
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "w").glob("part-*"))
    kinds = [h["WARC-Type"] for h, _ in warc.parse_archive(text)]
    assert kinds.count("request") == kinds.count("metadata") == len(rows)


def test_repeated_rows_are_captures_of_their_own(spark, tmp_path):
    rows = [(1, "u", LONG)] * 3 + [(2, "u", LONG)] * 2 + [(None, None, LONG)] * 2 + [(3, "u", "x")] * 4
    rows += [(4, None, "y"), (4, "-", "y")]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(3)
    got = warc.round_trip(pages, path=str(tmp_path / "r")).collect()
    assert sorted((str(r.metadata.page_id), r.response.kind, r.original.page_id if r.original else None)
                  for r in got) == sorted([("1", "revisit", 2)] * 3 + [("2", "response", None)] * 2 + [
                      ("None", "revisit", 2)] * 2 + [("3", "response", None)] * 4 + [("4", "response", None)] * 2)
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "r").glob("part-*"))
    ids = [h["WARC-Record-ID"] for h, _ in warc.parse_archive(text)]
    assert len(ids) == len(set(ids)) == 3 * len(rows)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_are_bounded(spark, tmp_path):
    pages = spark.range(100).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("h").alias("html"))
    warc.write_archive(pages.coalesce(1), str(tmp_path / "b"), records_per_file=30)
    assert len(list((tmp_path / "b").glob("part-*"))) == 10
