"""Quality classifier: a cumulative-link (ordinal logistic) model of graded ratings over hashed text.

All grades share one weight per hashed feature; ordered thresholds cut the score into grades.  A document gets its
expected grade and the probability that its grade is the highest, which selects it.  The model is fitted on at
most ``sample`` rated documents, the ones whose hashed ids are smallest, in one task; scoring maps over all.

Features are (logarithms of) counts of a text's distinct words that share a hash: the word without the punctuation around it, its
first 4, 5 and 6 bytes (stems with many endings), the punctuation behind it if there is more than one mark, and whether it is in capitals; next to these stand a few
shares over the whole text.

Defined results: a null text is empty; a document without an id is scored like any other; repeated rows are scored
each on its own; unrated or null-rated rows are not fitted on; without ratings of two grades nothing can be told,
so grade and probability are null and every document is kept; other columns are carried along.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
DENSE = 5
PREFIXES = (4, 5, 6)
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def word_slots(word: bytes) -> list[int]:
    """Hashed features of one raw word; their own range follows the dense ones."""
    core = word.strip(PUNCTUATION)
    tail = word[len(word.rstrip(PUNCTUATION)):]
    lower = core.lower()
    names = [b"w" + lower, *(b"%d" % n + lower[:n] for n in PREFIXES if len(lower) >= n)]
    if len(tail) > 1:
        names.append(b"t" + tail)
    if len(core) > 2 and core.isupper():
        names.append(b"capitals")
    return [DENSE + (zlib.crc32(n) & ((1 << BITS) - 1)) for n in names]


def dense(text: str, words: list[bytes], distinct: int) -> list[float]:
    n = max(1, len(words))
    marks = len(text.encode().translate(None, delete=bytes(set(range(256)) - set(PUNCTUATION))))
    return [1.0 / (1 + len(words)), math.log1p(len(words)) / 10, distinct / n, marks / max(1, len(text)),
            sum(map(bytes.isupper, words)) / n]


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts
        self._known: dict[bytes, list[int]] = {}

    def score(self, text: str | None) -> float:
        words = (text or "").encode().split()
        distinct = set(words)
        total = float(np.dot(dense(text or "", words, len(distinct)), self.weights[:DENSE]))
        known, counts = self._known, Counter()
        for w in distinct:
            slots = known.get(w)
            if slots is None:
                slots = [i for i in word_slots(w) if self.weights[i]]
                if len(known) < 500_000:
                    known[w] = slots
            if slots:
                counts.update(slots)
        return total + sum(float(self.weights[i]) * math.log2(1 + n) for i, n in counts.items())

    def grades(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the highest grade."""
        above = 1 / (1 + np.exp(np.clip(self.cuts[None, :] - scores[:, None], -60, 60)))
        return above.sum(axis=1), above[:, -1]


def telling(slots: np.ndarray, doc: np.ndarray, grades: np.ndarray, top: int, least: float = 3.5,
            ratio: float = 3.0, documents: int = 5) -> np.ndarray:
    """Slots that mark a lower grade: found in ``documents`` rated texts or more, and below some threshold of the
    grades ``ratio`` times as often as above it, by at least ``least`` standard errors.

    What long texts merely have more of is left out, so it cannot outweigh the marks of a low grade.
    """
    size = DENSE + (1 << BITS)
    everywhere = np.bincount(slots, minlength=size).astype(float)
    n = len(grades)
    best = np.zeros(size)
    for k in range(top):
        low = grades <= k
        n_low = max(1, int(low.sum()))
        in_low = np.bincount(slots[low[doc]], minlength=size)
        share = everywhere / n
        error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n_low + 1 / max(1, n - n_low)))
        below, above = in_low / n_low, (everywhere - in_low + 0.5) / max(1, n - n_low)
        best = np.maximum(best, np.where(below >= ratio * above, (below - above) / error, 0))
    chosen = (best >= least) & (everywhere >= documents)
    chosen[:DENSE] = True
    return chosen


def fit(rows: list[list[int]], values: list[list[float]], grades: np.ndarray, top: int, steps: int = 500,
        rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Maximum likelihood over the telling features with weight decay, by full-batch Adam steps."""
    lengths = np.array([len(r) for r in rows])
    slots = np.concatenate([np.array(r, np.int64) for r in rows])
    vals = np.concatenate([np.array(v, np.float64) for v in values])
    doc = np.repeat(np.arange(len(rows)), lengths)
    chosen = telling(slots, doc, grades, top)[slots]
    doc, vals = doc[chosen], vals[chosen]
    used, slots = np.unique(slots[chosen], return_inverse=True)
    # Parameters: weights, first threshold, logarithms of the gaps between thresholds.
    x = np.zeros(len(used) + top)
    share = np.clip([(grades <= k).mean() for k in range(top)], 1e-3, 1 - 1e-3)
    logits = np.log(share / (1 - share))
    x[len(used)] = logits[0]
    x[len(used) + 1:] = np.log(np.maximum(np.diff(logits), 1e-2))
    first, second = np.zeros_like(x), np.zeros_like(x)
    n = len(grades)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, steps + 1):
        w, gaps = x[:len(used)], np.exp(x[len(used) + 1:])
        cuts = x[len(used)] + np.concatenate([[0], np.cumsum(gaps)])
        f = np.bincount(doc, vals * w[slots], minlength=n)
        ends = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = sig(ends[grades + 1] - f), sig(ends[grades] - f)
        hi[grades == top], lo[grades == 0] = 1, 0
        p = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
        g = np.zeros_like(x)
        g[:len(used)] = np.bincount(slots, vals * (up - down)[doc], minlength=len(used)) / n + decay * w
        by_cut = -np.bincount(grades, up, minlength=top + 1)[:top] + np.bincount(grades, down, minlength=top + 1)[1:]
        g[len(used)] = by_cut.sum() / n
        g[len(used) + 1:] = gaps * np.cumsum(by_cut[::-1])[::-1][1:] / n
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        x -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DENSE + (1 << BITS), np.float32)
    weights[used] = x[:len(used)]
    return Model(weights, x[len(used)] + np.concatenate([[0], np.cumsum(np.exp(x[len(used) + 1:]))]))


def train(documents: DataFrame, ratings: DataFrame, sample: int = 10_000) -> Model | None:
    """Fit on at most ``sample`` rated documents; ``ratings`` has ``doc_id`` and an integer ``grade`` from 0."""
    chosen = (
        ratings.where("doc_id is not null and grade is not null")
        .groupBy(F.col("doc_id").cast("long").alias("rated_id")).agg(F.max("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("rated_id"), "rated_id").limit(sample)
    )
    # At most ``sample`` rows of two numbers: small enough to broadcast by its own bound.
    rated = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")).select("doc_id", "text", "grade")

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for doc, text, grade in zip(part["doc_id"], part["text"], part["grade"]):
                words = (text or "").encode().split()
                distinct = set(words)
                slots, counts = np.unique(np.array([s for w in distinct for s in word_slots(w)], np.int64),
                                          return_counts=True)
                out.append((doc, [*range(DENSE), *slots.tolist()],
                            [*dense(text or "", words, len(distinct)), *np.log2(1 + counts).tolist()], grade))
            yield pd.DataFrame(out, columns=["doc_id", "slots", "vals", "grade"])

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
        grades = rows["grade"].to_numpy()
        if len(np.unique(grades)) < 2:
            return pd.DataFrame({"weights": [], "cuts": []})
        model = fit(list(rows["slots"]), list(rows["vals"]), grades, int(grades.max()))
        return pd.DataFrame({"weights": [model.weights.tobytes()], "cuts": [model.cuts.tobytes()]})

    fitted = (
        rated.mapInPandas(features, "doc_id long, slots array<long>, vals array<double>, grade int")
        .withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "weights binary, cuts binary").collect()
    )
    return Model(np.frombuffer(fitted[0][0], np.float32), np.frombuffer(fitted[0][1])) if fitted else None


def grade(documents: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """``row`` (the document as it was), ``expected_grade``, ``top_probability``, ``kept``."""
    rows = documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("graded_text"))
    if model is None:
        return rows.select("row", F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("top_probability"), F.lit(True).alias("kept"))
    sent = documents.sparkSession.sparkContext.broadcast((model.weights, model.cuts))

    def run(parts):
        here = Model(*sent.value)
        for part in parts:
            scores = np.array([here.score(t.as_py()) for t in part.column(1)], float)
            expected, top = here.grades(scores)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(expected), pa.array(top), pa.array(top >= least)],
                names=["row", "expected_grade", "top_probability", "kept"])

    schema = rows.select("row", F.lit(0.0).alias("expected_grade"), F.lit(0.0).alias("top_probability"),
                         F.lit(True).alias("kept")).schema
    return rows.mapInArrow(run, schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from the given labels: 0 harmful, 1 poor, 2 good.

    Harm is the lowest grade, so that more marks of it only lower the score further.
    """
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))
