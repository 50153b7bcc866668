"""Clusters over subvector dictionaries against plain integer arithmetic, and edges."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

import __spark_entry__ as entry_module
from retailflow.llm import code_clusters as cc

SCHEMA = "vec_id long, embedding array<double>, cluster int, ids string"
OUT = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256 for x in v]) for i, v in rows if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(c) // len(members) for c in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {}
    for _, d, j in found:
        total[j] = total.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    fit = lambda x: x if x <= cc.LONG else None
    return sorted(((i, j, fit(d), fit(total[j]), fit(sum(total.values())), digest[j]) for i, d, j in found), key=str)


def run(spark, rows, parts=3, **settings):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r[c] for c in OUT) for r in cc.cluster(df, **settings).collect()), key=str)


@pytest.mark.parametrize("width, most", [(1, 7), (2, 50), (3, 1000)])
def test_equals_plain_arithmetic(spark, width, most):
    rng = np.random.default_rng(width)
    rows = [(i, (rng.normal(size=8) / 3).tolist()) for i in range(150)] + [(1000 + i, [0.5] * 8) for i in range(80)]
    rows += [(3, [0.25] * 8), (3, [0.25] * 8), (None, [-0.1] * 8), (None, [0.3] * 8)]
    assert run(spark, rows, k=6, rounds=4, dims=8, width=width, most=most) == brute(rows, 6, 4, 8)


def test_large_numbers_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([1, 1e6, 1e12, 1e30, 1e300]) for _ in range(4)]) for i in range(40)]
    rows += [(100 + i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    # Sums of squares up to 10^605 do not fit in a long; ids and clusters still must be right.
    assert [r[:2] for r in run(spark, rows, k=5, rounds=3, dims=4)] == [r[:2] for r in brute(rows, 5, 3, 4)]
    mid = [(i, [rng.uniform(-1, 1) * 2**21 for _ in range(4)]) for i in range(60)]
    assert run(spark, mid, k=5, rounds=3, dims=4) == brute(mid, 5, 3, 4)


def test_what_takes_no_part(spark):
    bad = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None, 1.0, 1.0]), (5, [float("nan")] * 4), (6, [float("inf")] + [0.0] * 3),
           (7, [1.0] * 5)]
    assert run(spark, bad, dims=4) == []
    good = [(8, [1.0] * 4), (9, [2.0] * 4)]
    assert run(spark, bad + good, dims=4) == brute(bad + good, dims=4) and len(run(spark, good, dims=4)) == 2
    assert cc.cluster(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = entry_module.queries()["op13_code_clusters"](spark, folder)
    assert got.columns == OUT
    # The same by matrix arithmetic in integers, as the plain form is slow on a whole table.
    kept = np.floor(np.array([v for _, v in rows if v and len(v) == 64], float) * 256).astype(np.int64)
    ids = [i for i, v in rows if v and len(v) == 64]
    order = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest())[:40]
    centroids = kept[order].copy()
    for turn in range(6):
        apart = ((kept[:, None] - centroids[None]) ** 2).sum(2)
        nearest = apart.argmin(1)
        if turn < 5:
            for c in set(nearest.tolist()):
                centroids[c] = kept[nearest == c].sum(0) // (nearest == c).sum()
    expected = sorted(zip(ids, nearest.tolist(), apart.min(1).tolist()))
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect()) == expected
