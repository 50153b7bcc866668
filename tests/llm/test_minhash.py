"""Components against brute force over all pairs of full sets."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd

from retailflow.llm import minhash, queries

SCHEMA = "doc_id long, text string, n string, component int"
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=2):
    words = [w for w in (text or "").translate(TABLE).translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    if not words:
        return frozenset()
    n = min(width, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(docs, width=2, percent=80):
    """Pairs that share a shingle are all compared."""
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    classes = {}
    for doc, text in docs:
        s = shingles(text, width)
        if s:
            classes.setdefault(s, []).append(doc)
    for same in classes.values():
        for d in same:
            a, b = sorted((root(d), root(same[0])))
            parent[b] = a
    where, sets = {}, list(classes)
    for i, s in enumerate(sets):
        counts = {}
        for x in s:
            for j in where.setdefault(x, []):
                counts[j] = counts.get(j, 0) + 1
            where[x].append(i)
        for j, common in counts.items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = sorted((root(classes[s][0]), root(classes[sets[j]][0])))
                parent[b] = a
    return {d: (len(shingles(t, width)), root(d), root(d) == d) for d, t in docs}


def check(spark, docs, **options):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.link_documents(frame, **options).collect()}
    assert got == brute(docs, options.get("width", 2), options.get("percent", 80))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op6_minhash(spark, folder).collect()}
    assert got == brute(list(zip(docs.doc_id, docs.text)))


def test_chains_groups_and_edges(spark):
    rng = random.Random(4)
    docs = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\ttwo "), (8, "één"), (9, "ÉÉN"),
            (10, "a a a a"), (11, "a a")]
    number = 100
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((6, 30, 200)))]
        # A chain: each copy changes the one before it a little more.
        for _ in range(12):
            docs.append((number, " ".join(words)))
            number += 1
            words = list(words)
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    base = [f"b{i}" for i in range(60)]
    for _ in range(150):  # a large group of near copies around one text
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"y{rng.randrange(10**6)}"
        docs.append((number, " ".join(words)))
        number += 1
    docs += [(number + i, "the same text in many rows") for i in range(50)]
    rng.shuffle(docs)
    check(spark, docs)
    check(spark, docs, block=4)
    check(spark, docs, width=5)


def test_null_ids_repeats_and_empty(spark):
    rows = [(None, "a b c", "x", 1), (None, "a b c", "x", 1), (1, "a b c", "x", 1), (1, "a b c", "x", 1), (2, "a b c", "x", 1)]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in
                 minhash.link_documents(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.link_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_close(spark):
    rng = np.random.default_rng(0)
    rows = []
    for common in (0, 30, 60, 80, 100):
        a = rng.integers(0, 2**63, 100).astype(np.uint64)
        b = np.concatenate([a[:common], rng.integers(0, 2**63, 100 - common).astype(np.uint64)])
        factors = minhash.constants(11, minhash.LANES)
        row = [minhash.packed(minhash.minima(x, factors)) for x in (a, b)]
        rows.append((common / (200 - common), *[tuple(x) for x in row]))
    kind = "struct<s0:long,s1:long,s2:long,s3:long>"
    frame = spark.createDataFrame(rows, f"true double, a {kind}, b {kind}")
    for r in frame.select("true", minhash.estimate("a", "b").alias("guess")).collect():
        assert abs(r.true - r.guess) < 0.2
