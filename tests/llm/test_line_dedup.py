"""Line dedup against a brute-force reading of its contract."""

from __future__ import annotations

from collections import defaultdict

from retailflow.llm import line_dedup
from retailflow.llm.common import LOWER, UPPER, WHITE

SCHEMA = "doc_id long, text string, pos string, word int, row int"
TABLE = str.maketrans(UPPER, LOWER)


def brute(rows: list[tuple], least: int = 10) -> list[tuple]:
    holders = defaultdict(set)
    key = lambda line: line.strip(WHITE).translate(TABLE)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(key(x)) < least or min(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    got = line_dedup.dedup_lines(docs, **options).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted(map(tuple, got), key=str)


def test_edges(spark):
    rows = [
        (5, "  Shared line one \nown five\nSHARED LINE ONE"), (3, "shared line one\t"), (9, None), (8, ""), (7, "\n\n"),
        (None, "shared line one"), (4, "ÀSHARED É line\nshort\nshort"), (6, "àshared é line\nshort"), (2, "Straße ist lang\r"),
        (1, "straße ist lang"), (11, " shared line one"), (12, "twice in one\ntwice in one"), (12, "another text of it"),
        (13, "twice in one\nx"), (13, "twice in one\nx"), (14, "nine chars"[:9]), (15, "nine chars"[:9]), (16, "ten chars!"),
        (17, "ten chars!"),
    ]
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_hot_line_over_many_slices(spark):
    rows = [(i, "\n".join(["a line that all share"] * (i % 3) + [f"line number {i // 2:06d}"] + ["x"] * 130
                          + ["another shared line"])) for i in range(300)]
    assert result(spark, rows, slice_width=7) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_and_bitmaps_only(spark):
    docs = spark.createDataFrame([(1, "a line to keep", "x", 1, 2), (2, "a line to keep\nb", "x", 1, 2)], SCHEMA)
    bitmaps = line_dedup.keep_bitmaps(docs)
    assert bitmaps.columns == ["doc_id", "version", "words"]
    assert [tuple(w) for w in bitmaps.first().words] == [(0, 1)]
    plan = line_dedup.apply_bitmaps(docs, bitmaps)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
