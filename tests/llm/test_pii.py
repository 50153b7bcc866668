"""Base spans against the plain patterns; the field on documents it was not trained on."""

from __future__ import annotations

import hashlib
import random
import re

import pandas as pd

from retailflow.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
SCHEMA = "doc_id long, text string, spans int, n_ip string"


def plain(text: str) -> list[tuple]:
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in pii.CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_on_random_and_given_texts():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("a@.-_+1234 (") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain(text), text
    for text in pd.read_parquet("/root/testdata/sf0.01/documents.parquet").text:
        assert pii.base_spans(text) == plain(text)


def test_long_texts_take_linear_time():
    for text, n in (("1" * 300_000, 0), ("a" * 300_000, 0), ("@" * 300_000, 0), ("1." * 150_000, 37_500),
                    ("a@" * 100_000, 0), ("+1" * 100_000, 0)):
        assert len(pii.base_spans(text)) == n
        assert sum(len(r) for _, r in pii.runs_of(text)) in (0, len(text))


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_viterbi_equals_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    k = len(pii.LABELS)
    field = pii.Field(rng.normal(size=((1 << pii.BITS) + 1, k)), rng.normal(size=(k, k)) + pii._allowed())
    field.emit[-1] = 0
    rows = [rng.integers(0, 1 << pii.BITS, (n, 8)) for n in (1, 4, 2)]
    for slots, got in zip(rows, field.decode(rows)):
        scores = field.emit[slots].sum(axis=1)

        def value(path):
            start = -1e4 if pii.LABELS[path[0]][0] == "I" else 0
            return (start + sum(scores[i, x] for i, x in enumerate(path))
                    + sum(field.step[a, b] for a, b in itertools.pairwise(path)))

        assert tuple(got) == max(itertools.product(range(k), repeat=len(slots)), key=value)


def test_held_out_spans_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = pii.train(docs.where("doc_id % 2 = 0"), sample=600)
    texts = docs.where("doc_id % 2 = 1").toPandas().text
    found = field.spans(list(texts))
    base = [set(plain(t)) for t in texts]
    hits = sum(len(b & set(f)) for b, f in zip(base, found))
    assert hits >= 0.97 * sum(map(len, base)) and hits >= 0.97 * sum(map(len, found))
    assert [(k, a) for a, k, _ in field.spans(["ring (489) 555-7686 now"])[0]] == [(3, 5)]

    rows = [(1, "a@b.co, 1.2.3.4"), (2, None), (2, None), (None, ""), (3, "no data " * 20_000), (4, "(489) 555-7686"),
            (5, "in 2024 for 12.50 or v1.2.3")]
    got = sorted(pii.find(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), field).collect(), key=str)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].spans == "email:0:6,ip:8:15" and by[1].n_added == 0
    assert by[1].base_sha256 == hashlib.sha256(b"email:0:6,ip:8:15").hexdigest()
    assert by[4].spans == "phone:0:14" and by[4].n_phone == 0 and by[4].n_added == 1
    assert by[2].spans == by[3].spans == by[5].spans == by[None].spans == ""


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.train(empty) is None and pii.find(empty, None).count() == 0
    one = spark.createDataFrame([(1, "a 5 b", 1, "x")], SCHEMA)
    assert pii.train(one) is None and pii.find(one, None).first().spans == ""
