"""Formatted conversations: an exact round trip, the order of turns, and edges."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from retailflow.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, segment int, state string"
CONTROLS = cf.Template().controls


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(turns):
    whole = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), whole, len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_escape_is_undone_and_hides_controls():
    rng = random.Random(3)
    escaper = cf.Escaper(CONTROLS)
    pieces = [*CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "a", "\n", "é😀"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        hidden = escaper.escape(text)
        assert escaper.unescape(hidden) == text
        assert not any(c in hidden for c in CONTROLS)


def test_round_trip(spark):
    rng = random.Random(4)
    pieces = [*CONTROLS, "\\", "<", "[", "é😀", "\n", " word"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["system", "user", "assistant", "tool", None, "[INST]", "a\\b"])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choice(pieces) for _ in range(9))])))
    rng.shuffle(rows)
    segments = cf.format_conversations(frame(spark, rows))
    stored = spark.createDataFrame(segments.collect(), segments.schema)
    for read in (cf.read_back(segments, in_order=True), cf.read_back(stored.repartition(5, F.rand(1)))):
        got = {r.conv_id: r for r in read.collect()}
        assert len(got) == 60
        for conv, row in got.items():
            turns = [(r[2], r[3]) for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
            assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == brute(turns)
    text = {}
    for r in sorted(segments.collect(), key=lambda r: (r.conv_id, r.segment)):
        text[r.conv_id] = text.get(r.conv_id, "") + r.text
    assert {c: len(t) for c, t in text.items()} == {c: r.formatted_chars for c, r in got.items()}
    assert all(not r.loss or r.segment % 3 == 1 for r in segments.collect())


@pytest.mark.parametrize("roles, valid, complete", [
    ("ua", True, True), ("sua", True, True), ("uaua", True, True), ("u", True, False), ("su", True, False), ("s", True, False),
    ("a", False, False), ("uu", False, False), ("uaa", False, False), ("usa", False, False), ("xua", False, False)])
def test_order_of_turns(spark, roles, valid, complete):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "other"}
    row = cf.read_back(cf.format_conversations(frame(spark, [(1, i, names[r], "t") for i, r in enumerate(roles)]))).first()
    assert (row.valid, row.complete) == (valid, complete)


def test_ties_nulls_and_long_texts(spark):
    long = "[INST]\\x" * 200_000
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"),
            (1, None, "system", "first"), (2, 0, "assistant", long), (2, 0, "assistant", long)]
    for in_order in (True, False):
        got = cf.read_back(cf.format_conversations(frame(spark, rows)), in_order=in_order).collect()
        assert sorted((str(r.conv_id), r.n_turns) for r in got) == [("1", 3), ("2", 2), ("None", 1), ("None", 1), ("None", 1)]
        by = {r.conv_id: r for r in got}
        assert by[1].turns_sha256 == brute([("system", "first"), ("user", "a"), ("user", "b")])[1]
        assert by[2].loss_chars == 2 * len(long)
    assert cf.read_back(cf.format_conversations(frame(spark, []))).count() == 0


def test_templates_that_cannot_be_read_back_are_refused():
    for opening in ("<s", "[INST]", "x<y>", "\\x"):
        with pytest.raises(ValueError):
            cf.Template(roles={"user": cf.Turn("[INST]", "[/INST]"), "assistant": cf.Turn(opening, "</s>", True)}, other=("<r>", "<t>", "<s>x<"))
