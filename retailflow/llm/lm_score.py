"""Score texts with a logistic mixture of hashed-context bit predictors.

A text is a row of words (A-Z lower-cased) and an end, and is scored bit by bit in its order.  Words of a dictionary (those that
training texts hold at least twice, the ``frequent`` most frequent at most) are coded as in ``lm_text``: their bits are predicted
in contexts of the words before them, over the whole text.  So is the sign that a word is none of these, which is then spelled.

Spelling: each byte bit by bit, with a space behind the word, from counts in several hashed contexts: nothing, the last one, two,
three and five bytes of the word, and the whole word so far.  A gate (how much three of the contexts know) picks the weights that
mix the predictions in the logistic domain; an adaptive table then refines the mixed probability by what came of it before.
The spelling needs only the word, so each distinct word is spelled once and joined to the texts that hold it.  It is mixed with the
word's own share of the training words outside the dictionary, by the weight under which these, each with one occurrence left out,
are likeliest; words unseen in training have the probability of being so and that of their spelling.

``score`` is the log10 probability of the whole text: of every word in its place, spelled ones to their last bit.

Learning: word counts over all training documents; from these the speller's context counts of every word, however rare, and from the
texts those of ``lm_text``; then the weights of both, learned online over all words and all texts with each bit's own occurrence left
out, and averaged.  Counts are taken before any text is scored, and scoring changes none.  The context tables have a fixed
size, so what is broadcast does not grow.  Words longer than ``PIECE`` bytes are coded piece by piece, each with contexts of its
own, all pieces at once.

Defined results: a null or empty text is the end alone; every row is scored for itself, also rows that share an id or
have none; without training documents every bit is even; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm import lm_text
from retailflow.llm.common import saved
from retailflow.llm.lm_text import FINE, SQUASHED, STEP, cell, held_out, received, shipped, squash, tokens_of

# Bytes of context of each predictor (-1: the whole word so far) and the bits of its table.
ORDERS = (0, 1, 2, 3, 5, -1)
HASHED = 20
BITS = (8, 16, HASHED, HASHED, HASHED, HASHED)
GATED = (3, 4, 5)
LEVELS = (1, 8, 256)
SETS = (len(LEVELS) + 1) ** len(GATED)
BUCKETS = 33
# Logits that a slot can lean to, and those of the bytes of a table, which hold the level as well.
LEANS = np.linspace(-9.6, 9.6, 64, dtype=np.float32)
VALUE = np.tile(LEANS, len(LEVELS) + 1)
LEVEL = np.repeat(np.arange(len(LEVELS) + 1), len(LEANS))
# Weights before learning: the longer contexts lead; the last one belongs to a constant input.
START = np.array([0.0, 0.0, 0.1, 0.2, 0.4, 0.5, 0.0])
BLOCK = 1 << 16
# Bytes of a word that are coded in one go, and distinct words of one shard.
PIECE = 96
SHARD = 100_000
END = 0x20


def count_words(documents: DataFrame, entries: int = 400_000) -> DataFrame:
    """``word, c`` over all documents: occurrences in training documents, 0 for words of others."""
    def summed(held: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return pa.table({"word": found["word"], "c": found["c_sum"]})

    def run(parts):
        held = []
        for part in parts:
            for rows, tokens, sizes in lm_text.groups(part, 0, 1, False):
                trains = np.array([not held_out(d) for d in part.column(0).take(pa.array(rows)).to_pylist()], np.int64)
                held.append(summed([pa.table({"word": tokens, "c": np.repeat(trains, sizes)})]))
                if sum(map(len, held)) > entries:
                    yield from summed(held).to_batches(20_000)
                    held = []
        if held:
            yield from summed(held).to_batches(20_000)

    counted = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "word binary, c long")
    return saved(counted.groupBy("word").agg(F.sum("c").alias("c")), "words")


def pieces_of(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Pieces of the words, the word each belongs to, and whether the word ends with it.

    A piece of full length is never the last one: behind it comes another, empty if the word ends there.
    """
    sizes = np.array([len(w) // PIECE + 1 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    if len(owner) == len(words):
        return words, owner, np.ones(len(words), bool)
    pieces = [w[at:at + PIECE] for w in words for at in range(0, len(w) + 1, PIECE)]
    last = np.zeros(len(owner), bool)
    last[np.cumsum(sizes) - 1] = True
    return pieces, owner, last


def coded(pieces: list[bytes], last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces, a space behind each last one, as one padded array, and their lengths."""
    sizes = np.array([len(w) for w in pieces], np.int64)
    lengths = sizes + last
    out = np.full((len(pieces), int(lengths.max(initial=1))), END, np.uint8)
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
    return out, lengths


def events(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each byte and bit: the words it belongs to (one may come several times), its contexts' slots, and the bit."""
    words, owner, last = pieces_of(words)
    data, lengths = coded(words, last)
    order = np.argsort(-lengths, kind="stable")
    data, lengths = data[order], lengths[order]
    whole = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    multiply, shifted = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xD6E8FEB86659FD93 * 256 % 2**64)
    for at in range(data.shape[1]):
        n = int(np.searchsorted(-lengths, -at, side="left"))  # words longer than ``at``
        here = data[:n, at].astype(np.uint64)
        contexts = []
        for size in ORDERS:
            if size < 0:
                contexts.append(whole[:n])
            elif size != 0:
                h = np.zeros(n, np.uint64)
                for back in range(1, size + 1):
                    b = data[:n, at - back].astype(np.uint64) if at >= back else np.full(n, END, np.uint64)
                    h = h * np.uint64(257) + b + np.uint64(1)
                contexts.append(h)
        # The last byte has a slot of its own for each node; the longer contexts are hashed.
        byte = (contexts[0] & np.uint64(255)) << np.uint64(8)
        hashed = np.stack(contexts[1:]) * shifted
        node, rows = np.ones(n, np.uint64), owner[order[:n]]
        for bit in range(7, -1, -1):
            slots = np.empty((len(ORDERS), n), np.uint64)
            slots[0] = node
            np.bitwise_or(byte, node, out=slots[1])
            if bit % 4 == 3:  # four bits share a line of each hashed table
                line = hashed + node * multiply
                line ^= line >> np.uint64(29)
                line *= multiply
                line >>= np.uint64(64 - HASHED)
                way = np.ones(n, np.uint64)
            np.bitwise_xor(line, way, out=slots[2:])
            y = (here >> np.uint64(bit)) & np.uint64(1)
            yield rows, slots.view(np.int64), y.view(np.int64)
            node, way = node * np.uint64(2) + y, way * np.uint64(2) + y
        whole[:n] = (whole[:n] ^ (here + np.uint64(1))) * multiply
        whole[:n] ^= whole[:n] >> np.uint64(31)


class Mixer:
    """Context counts, gated weights and the refining table."""

    def __init__(self, counts: list[np.ndarray], weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        self.counts = counts  # one (2, slots) table per context
        self.weights = np.tile(START, (SETS, 1)) if weights is None else weights
        self.steps = np.full(self.weights.shape, 1e-4)  # squared steps so far, for the learning rate of each weight
        # Outcomes seen near each bucket of the mixed logit, for each node of the byte's bits: ones, all.
        self.refine = np.zeros((2, 256, BUCKETS)) if refine is None else refine
        self.looked_up: dict[bool, list[np.ndarray]] = {}
        self.made: tuple | None = None

    def shipped(self, own: bool) -> bytes:
        """As it is broadcast: with the bytes of its slots, without the counts that they come from."""
        self.tables(own)
        return shipped(self)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counts": None}

    def tables(self, own: bool) -> list[np.ndarray]:
        """A byte for every slot of each predictor: which way its counts lean, and how many there are.

        With ``own`` there are two side by side, for a bit that is 0 and for one that is 1: the bit's own occurrence is left out.
        """
        if own not in self.looked_up:
            out = []
            for zero, one in self.counts:
                sides = [(np.maximum(zero - 1, 0), one), (zero, np.maximum(one - 1, 0))] if own else [(zero, one)]
                rows = []
                for a, b in sides:
                    logit = np.clip(np.log((b + np.float32(0.02)) / (a + np.float32(0.02))), LEANS[0], LEANS[-1])
                    lean = np.rint((logit - LEANS[0]) / (LEANS[1] - LEANS[0])).astype(np.uint8)
                    rows.append(lean + sum((a + b >= x).astype(np.uint8) for x in LEVELS) * np.uint8(len(LEANS)))
                out.append(np.stack(rows, 1).reshape(-1))
            self.looked_up[own] = out
        return self.looked_up[own]

    def learn(self, words: list[bytes], counts: np.ndarray, rate: float) -> None:
        """Each bit as if its own occurrence had not been counted."""
        for rows, slots, y in events(words):
            weight = counts.take(rows).astype(np.float32)
            x = np.full((len(ORDERS) + 1, len(y)), 0.3, np.float32)
            gate = np.zeros(len(y), np.int64)
            for k, table in enumerate(self.tables(True)):
                state = table.take((slots[k] << 1) + y, mode="clip")
                VALUE.take(state, out=x[k], mode="clip")
                if k in GATED:
                    gate *= len(LEVELS) + 1
                    gate += LEVEL.take(state)
            logit = np.einsum("kn,kn->n", self.weights.T.astype(np.float32).take(gate, axis=1, mode="clip"), x)
            x *= weight * (y.astype(np.float32) - SQUASHED.take(cell(logit), mode="clip"))
            mass = np.bincount(gate, weight, minlength=SETS) + float(weight.mean()) * 20
            for k in range(x.shape[0]):
                step = np.bincount(gate, x[k], minlength=SETS) / mass
                self.steps[:, k] += step * step
                self.weights[:, k] += rate * step / np.sqrt(self.steps[:, k])
            # The nearer bucket of the mixed logit.  Nodes of one depth are neighbours, so only their part of the table is touched.
            least = 1 << (int(slots[0][0]).bit_length() - 1)
            place = (np.clip(logit, -8, 8) + np.float32(8)) * np.float32((BUCKETS - 1) / 16) + np.float32(0.5)
            place = (((slots[0] - least) * BUCKETS + place.astype(np.int64)) << 1) + y
            seen = np.bincount(place, weight, minlength=2 * least * BUCKETS).reshape(least, BUCKETS, 2)
            self.refine[0, least:2 * least] += seen[:, :, 1]
            self.refine[1, least:2 * least] += seen.sum(2)

    def prepared(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """What scoring looks up: each predictor's part of the mixed logit by gate and state, the constant's by gate, and log10 of
        the final probability by node, logit and bit."""
        weights = self.weights.astype(np.float32)
        at = (np.arange(FINE) + 0.5) / STEP - FINE / 2 / STEP
        refined = (self.refine[0] + 50 * squash(np.linspace(-8, 8, BUCKETS))) / (self.refine[1] + 50)
        where = (np.clip(at, -8, 7.999) + 8) * ((BUCKETS - 1) / 16)
        low, part = where.astype(int), where % 1
        p = np.clip(0.5 * squash(at) + 0.5 * ((1 - part) * refined[:, low] + part * refined[:, low + 1]), 1e-6, 1 - 1e-6)
        final = np.log10(np.stack([1 - p, p], 2)).astype(np.float32)
        return [np.outer(w, VALUE).reshape(-1) for w in weights.T[:-1]], weights[:, -1] * np.float32(0.3), final.reshape(-1)

    def score(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's probability."""
        if self.made is None:
            self.made = self.prepared()
        parts, rest, final = self.made
        out = np.zeros(len(words))
        for rows, slots, y in events(words):
            states = [table.take(slots[k], mode="clip") for k, table in enumerate(self.tables(False))]
            gate = np.zeros(len(y), np.int64)
            for k in GATED:
                gate *= len(LEVELS) + 1
                gate += LEVEL.take(states[k])
            logit = rest.take(gate, mode="clip")
            gate <<= 8
            for part, state in zip(parts, states):
                logit += part.take(gate + state, mode="clip")
            place = ((slots[0] * FINE + cell(logit)) << 1) + y
            out += np.bincount(rows, final.take(place, mode="clip"), minlength=len(words))
        return out


def _chunks(words: list[bytes], size: int = 20_000) -> Iterator[slice]:
    """Slices of about ``size`` pieces and at least one word."""
    ends = np.cumsum([len(w) // PIECE + 1 for w in words])
    at = 0
    while at < len(words):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield slice(at, upto)
        at = upto


def context_counts(words: DataFrame, shards: int) -> list[np.ndarray]:
    """Counts of zeros and ones of every context over all training words."""

    def partial(parts):
        tables = [np.zeros(2 << b) for b in BITS]  # zeros and ones of a slot side by side
        for part in parts:
            part = part.iloc[part["word"].str.len().argsort(kind="stable")]
            names, counts = [bytes(w) for w in part["word"]], part["c"].to_numpy(float)
            for at in _chunks(names):
                for rows, slots, y in events(names[at]):
                    weight = counts[at][rows]
                    for k, table in enumerate(tables):
                        np.add.at(table, (slots[k] << 1) + y, weight)
        yield pd.DataFrame(
            [(k, i, zlib.compress(table[2 * i:2 * (i + BLOCK)].astype(np.float32).reshape(-1, 2).T.tobytes(), 1))
             for k, table in enumerate(tables) for i in range(0, len(table) // 2, BLOCK)],
            columns=["table", "block", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(d), np.float32).astype(float) for d in rows["data"])
        return pd.DataFrame({"table": rows["table"].iloc[:1], "block": rows["block"].iloc[:1],
                             "data": [zlib.compress(total.astype(np.float32).tobytes(), 1)]})

    kind = "table int, block int, data binary"
    summed = words.where("c > 0").repartition(shards).mapInPandas(partial, kind).groupBy("table", "block").applyInPandas(
        add, kind)
    tables = [np.zeros((2, 1 << b), np.float32) for b in BITS]
    for r in summed.toLocalIterator():
        data = np.frombuffer(zlib.decompress(r.data), np.float32).reshape(2, -1)
        tables[r.table][:, r.block:r.block + data.shape[1]] = data
    return tables


def train(words: DataFrame, shards: int, rate: float = 0.05) -> Mixer:
    """Context counts, then weights learned online over every shard of the words and averaged by their tokens."""
    spark = words.sparkSession
    tables = context_counts(words, shards)
    sent = spark.sparkContext.broadcast(Mixer(tables).shipped(True))

    def learn(parts):
        mixer, mass = received(sent.value), 0
        for part in parts:
            # Words of all frequencies in each step.
            part = part.sample(frac=1, random_state=1)
            names, counts = [bytes(w) for w in part["word"]], part["c"].to_numpy()
            mass += int(counts.sum())
            for at in _chunks(names, 16_000):
                mixer.learn(names[at], counts[at], rate)
        yield pd.DataFrame({"mass": [mass], "weights": [(mixer.weights * mass).tobytes()],
                            "refine": [mixer.refine.tobytes()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        summed = {name: [sum(map(np.frombuffer, rows[name])).tobytes()] for name in ("weights", "refine")}
        return pd.DataFrame({"mass": [int(rows["mass"].sum())], **summed})

    # Shards are summed in groups first, so that the driver gets a few rows however many shards there are.
    kind = "mass long, weights binary, refine binary"
    learned = words.where("c > 0").repartition(shards).mapInPandas(learn, kind).groupBy(
        F.spark_partition_id() % 16).applyInPandas(add, kind).collect()
    sent.unpersist()
    mass = sum(r.mass for r in learned)
    if not mass:
        return Mixer(tables)
    return Mixer(tables, sum(np.frombuffer(r.weights) for r in learned).reshape(SETS, -1) / mass,
                 sum(np.frombuffer(r.refine) for r in learned).reshape(2, 256, BUCKETS))


def score_words(words: DataFrame, mixer: Mixer, shards: int) -> DataFrame:
    """``word, c, score`` for every word."""
    sent = words.sparkSession.sparkContext.broadcast(mixer.shipped(False))

    def run(parts):
        here = received(sent.value)
        for part in parts:
            part = part.iloc[part["word"].str.len().argsort(kind="stable")].reset_index(drop=True)
            names = [bytes(w) for w in part["word"]]
            part["score"] = np.concatenate([here.score(names[at]) for at in _chunks(names)] or [np.zeros(0)])
            yield part[["word", "c", "score"]]

    return saved(words.repartition(shards).mapInPandas(run, "word binary, c long, score double"), "scored")


def finish_words(scored: DataFrame, recurring: int) -> DataFrame:
    """Probabilities of words outside the dictionary, given that it is one: spelled, mixed with the word's own share.

    ``recurring``: occurrences of words that are in the dictionary with two, which tell how often a word seen once comes again.
    """
    bits = F.pow(F.lit(10.0), "score")
    shares = (0.98, 0.95, 0.9, 0.8, 0.5, 0.0)
    n, once = scored.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") == 1, 1))).first()
    likely = scored.where("c > 1").agg(
        *(F.sum(F.col("c") * F.log(x * (F.col("c") - 1) / max(1, n) + (1 - x) * bits)).alias(str(x)) for x in shares)).first()
    share = max(shares, key=lambda x: (likely[str(x)] is not None, likely[str(x)] or 0.0)) if n else 0.0
    unseen = min(max((once + 1) / (once + max(recurring, n - once) + 2), 1e-9), 0.99)
    known = math.log10(1 - unseen) + F.log10(share * F.col("c") / max(1, n) + (1 - share) * bits)
    return scored.select("word", "c", F.when(F.col("c") > 0, known).otherwise(F.col("score") + math.log10(unseen)).alias("spelled"))


def score_documents(documents: DataFrame, frequent: int = 200_000) -> DataFrame:
    """Per row: whether it was held out, token counts, base and model log10 probability, bits per byte."""
    words = count_words(documents)
    n, v, n_words = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count("*")).first()
    # The dictionary: words seen at least twice, so that those seen once teach where unseen ones are to be expected.
    top = words.where("c > 1").orderBy(F.desc("c"), "word").limit(frequent).select("word", "c").toArrow()
    known, counts = top.column("word").to_pylist(), top.column("c").to_pylist()
    outside = F.lit(True)
    if known:
        outside = (F.col("c") < counts[-1]) | ((F.col("c") == counts[-1]) & (F.col("word") > F.lit(known[-1])))
    code = lm_text.Code(known, counts, n - sum(counts))
    mixer = lm_text.train(documents, code)
    shards = max(12, math.ceil(n_words / SHARD))
    speller = train(words, shards)
    rare = finish_words(score_words(words.where(outside), speller, shards), 2 * counts.count(2))
    sent = documents.sparkSession.sparkContext.broadcast(shipped(mixer))
    whole = math.log10(n + v + 1)
    sums = ("n_tokens", "n_known", "n_bytes", "base_score", "score")
    kind = "row long, doc_id long, word binary, times long, n_tokens long, n_known long, n_bytes long, " \
           "base_score double, score double"

    def looked_up(part: pa.RecordBatch, rows: np.ndarray, tokens: pa.Array, sizes: np.ndarray, mixer: lm_text.TextMixer,
                  index: pa.Array, shares: np.ndarray) -> pa.RecordBatch:
        """One record per text with what the code of its words comes to, and one per text and word outside the dictionary."""
        ids, contexts = lm_text.encoded(tokens, sizes, index, mixer.code.hashes)
        starts = np.cumsum(sizes) - sizes
        texts = part.column(2).take(pa.array(rows))
        own = [sizes, np.add.reduceat((ids < len(index)).astype(np.int64), starts),
               pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64),
               np.add.reduceat(shares[ids], starts), np.add.reduceat(mixer.score(ids, contexts), starts)]
        others = np.flatnonzero(ids == len(index))
        found = pa.table({"at": np.repeat(rows, sizes)[others], "word": tokens.take(pa.array(others))}).group_by(
            ["at", "word"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        n = len(found)
        row = part.column(0).take(pa.concat_arrays([*found["at"].chunks, pa.array(rows)]))
        doc = pa.concat_arrays([pa.nulls(n, pa.int64()), part.column(1).take(pa.array(rows))])
        columns = [pa.concat_arrays([pa.nulls(n, c.type), c]) for c in map(pa.array, own)]
        # A text's own record has a word that holds a space, different in each, and so joins nothing and is no hot key.
        marks = pa.array([b" %d" % r for r in row[n:].to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [row, doc, pa.concat_arrays([*found["word"].chunks, marks]),
             pa.concat_arrays([*found["count_all"].chunks, pa.array(np.zeros(len(rows), np.int64))]), *columns],
            names=["row", "doc_id", "word", "times", *sums])

    def run(parts):
        mixer = received(sent.value)
        index, shares = mixer.code.index(), np.append(np.log10(mixer.code.counts + 1) - whole, 0.0)
        for part in parts:
            for rows, tokens, sizes in lm_text.groups(part, 1, 2, False):
                yield looked_up(part, rows, tokens, sizes, mixer, index, shares)

    # The number of a row is fixed by its place in the table's files, also when a task is repeated.
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(run, kind)
    count, none = F.coalesce(F.col("c"), F.lit(0)), F.lit(0.0)
    extra = {
        "n_known": F.when(count > 0, F.col("times")).otherwise(0),
        "base_score": F.when(F.col("times") > 0, F.col("times") * (F.log10(count + 1) - F.lit(whole))).otherwise(0.0),
        "score": F.col("times") * F.coalesce("spelled", none)}
    joined = rows.join(rare, "word", "left").groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(
        F.sum(F.coalesce(F.col(c), F.lit(0)) + extra.get(c, F.lit(0))).alias(c) for c in sums))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return joined.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", F.col("score").alias("spelled_score"),
        (-F.col("score") / math.log10(2) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))
