"""Texts cut and put together again against brute force, and edges."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from retailflow.llm import fill_middle as fm

SCHEMA = "doc_id long, text string, n long, form string, output int"


def brute(doc, text, rate=100, share=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < share:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}"


def check(spark, texts, **settings):
    rows = spark.createDataFrame([(d, t, 1, "x", 1) for d, t in texts], SCHEMA)
    parts = fm.taken_apart(F.col("output"), F.col("form"))
    out = fm.fill_middle(rows, rate=settings.get("rate", 100), spm_share=settings.get("share", 50)).withColumn("parts", parts)
    got = out.withColumn("back", fm.restored(F.col("output"), F.col("form"), F.col("parts"))).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n, r.form, r.output) == brute(r.row.doc_id, r.row.text, **settings)
        assert r.back == (r.row.text or "") and (r.parts is None) == (r.form == "plain")
        assert (r.row.n, r.row.form, r.row.output) == (1, "x", 1)
    return got


def test_equals_brute_force(spark):
    odd = ["a\nb\nc\n", "a\nb", None, "", "\n", "\n\n\n", "x<P>y", "<M>", "é😀\r\n z\nq", "$1\\ \n<\nP>\n<S", "{2}+\n)(\n", "\u2028a\u0085\nb"]
    texts = [(i, t) for i, t in enumerate(odd)] + [(100 + i, "".join(f"line {j}\n" for j in range(i % 9)) + "end" * (i % 2))
                                                   for i in range(200)]
    got = check(spark, texts + [(None, "a\nb\n")] * 3 + [(1, "a\nb")] * 2)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    check(spark, [(1, "x" * 3_000_000), (2, "ab\n" * 400_000), (3, "y\n" * 300_001 + "z"), (4, "\n" * 500_000)])


def test_shares(spark):
    texts = [(i, f"{i}\nb\n") for i in range(300)]
    forms = [r.form for r in check(spark, texts, rate=40, share=10)]
    assert 150 < forms.count("plain") < 210 and forms.count("spm") < forms.count("psm")


def test_markers():
    with pytest.raises(ValueError):
        fm.Markers("<<P>", "<S>", "<M>")
    with pytest.raises(ValueError):
        fm.Markers("<P>", "<P>", "<M>")
    assert fm.Markers("{a$}", "{b\\}", "{c.}")


def test_other_markers_are_taken_as_they_are(spark):
    marks = fm.Markers("{a$1}", "{b\\}", "{c.}")
    rows = spark.createDataFrame([(i, "l1\nl2\nl3\n") for i in range(40)], "doc_id long, text string")
    out = fm.fill_middle(rows, markers=marks)
    back = fm.restored(F.col("output"), F.col("form"), fm.taken_apart(F.col("output"), F.col("form"), marks))
    assert {r[0] for r in out.select(back).collect()} == {"l1\nl2\nl3\n"}
    assert all("{a$1}" in r.output for r in out.collect())


def test_no_shuffle_no_python_and_empty_table(spark):
    out = fm.fill_middle(spark.createDataFrame([], SCHEMA))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and out.count() == 0
