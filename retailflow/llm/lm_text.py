"""Bit predictors over the words of a text in their order, mixed in the logistic domain.

Each word of a dictionary, and one sign for all others, has a Huffman code by its count in training texts.  A text is coded
word by word and each word bit by bit.  A bit is predicted from counts in several contexts: the node of the code alone, and the
node hashed with the word before, with the two and the three words before, and with the second word before.  Contexts run on over the
whole text; words outside the dictionary are contexts like any other, by their hash.  How much is known of the one and of the two words before is the gate that
picks the weights; a refining table then corrects the mixed probability by what came of it in training.

Bits are worked on in lines, up to four of one code that begin at the same node: a line is hashed once for each context and its
slots lie side by side, one for each way through it.  The last line of a code may be shorter; what it lacks counts nowhere.

The hashed tables have a fixed size.  A slot is a byte for its counts: how many there are and which way they lean.
"""

from __future__ import annotations

import heapq
import math
import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Which of the preceding words make up each hashed context, and the bits of its table.
BEFORE = ((1,), (1, 2), (1, 2, 3), (2,))
SLOTS = 22
# Least counts of each level of knowledge, and the logits that a slot can lean to.
LEVELS = np.array([1, 2, 3, 5, 9, 17, 65, 513])
LEANS = np.linspace(-8.1, 8.1, 28, dtype=np.float32)
KNOWN = len(LEVELS) + 1
VALUE = np.zeros(256, np.float32)
VALUE[1:1 + len(LEVELS) * len(LEANS)] = np.tile(LEANS, len(LEVELS))
LEVEL = np.zeros(256, np.int64)
LEVEL[1:1 + len(LEVELS) * len(LEANS)] = np.repeat(np.arange(1, KNOWN), len(LEANS))
SETS = KNOWN * KNOWN
# Weights before learning: the node alone, the hashed contexts, a constant input.
START = np.array([0.4, 0.3, 0.3, 0.2, 0.1, 0.0], np.float32)
DEPTHS, BUCKETS = 32, 33
BLOCK = 1 << 16
# What marks a bit that a line lacks.
LACKING = DEPTHS << 5
# Logits at which the final probability is worked out, and how many there are in one.
FINE, STEP = 768, 32
# Bytes of text that are read together (a longer text is one group), and tokens coded in one go: few enough for a core's own cache.
GROUP, SLICE = 1 << 23, 1 << 10
MULTIPLY = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc: int | None) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def tokens_of(text: str | None) -> list[bytes]:
    """Words, then the end as an empty word."""
    return [*(text or "").encode().lower().split(), b""]


def split(texts: pa.Array) -> pa.ListArray:
    """The same for all texts at once."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(texts, " ", ""))
    return pc.ascii_split_whitespace(texts)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -18, 18)))


def shipped(model: object) -> bytes:
    """A model as it is broadcast; tables that few words have filled compress well."""
    return zlib.compress(pickle.dumps(model), 1)


def received(data: bytes):
    return pickle.loads(zlib.decompress(data))


class Code:
    """Huffman codes of the dictionary's words and, as the last symbol, of all words outside it."""

    def __init__(self, words: list[bytes], counts: list[int], outside: int):
        self.words, self.counts = words, np.array(counts, np.int64)
        size = len(words) + 1
        heap = [(c, i) for i, c in enumerate([*counts, max(1, outside)])]
        heapq.heapify(heap)
        parent, side = np.full(2 * size - 1, -1), np.zeros(2 * size - 1, np.uint8)
        self.ones, self.zeros = np.zeros(size - 1, np.float32), np.zeros(size - 1, np.float32)
        for node in range(size - 1):
            zero, one = heapq.heappop(heap), heapq.heappop(heap)
            parent[zero[1]] = parent[one[1]] = size + node
            side[one[1]] = 1
            self.zeros[node], self.ones[node] = zero[0], one[0]
            heapq.heappush(heap, (zero[0] + one[0], size + node))
        # From the leaves up, all symbols at once.
        symbols, at, up = np.arange(size), np.arange(size), []
        while len(symbols := symbols[parent[at] >= 0]):
            at = at[parent[at] >= 0]
            up.append((symbols, parent[at] - size, side[at]))
            at = parent[at]
        self.lengths = np.zeros(size, np.int64)
        for symbols, _, _ in up:
            self.lengths[symbols] += 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        path, taken = np.zeros((2, int(self.lengths.sum())), np.int64)
        for step, (symbols, nodes, bits) in enumerate(up):
            place = self.starts[symbols] + self.lengths[symbols] - 1 - step
            path[place], taken[place] = nodes, bits
        self.path, self.taken = path, taken
        # Per line: the node where it begins, and for each of its bits the node, and its depth with the way behind it (one bit
        # more than the way to it), in one number.
        self.lines = (self.lengths + 3) >> 2
        self.firsts = np.cumsum(self.lines) - self.lines
        first = np.arange(int(self.lines.sum())) - np.repeat(self.firsts, self.lines)
        left = np.repeat(self.lengths, self.lines) - 4 * first
        at = np.repeat(self.starts, self.lines) + 4 * first
        self.begins = path[at].astype(np.uint64)
        self.steps, self.at = np.full((len(at), 4), LACKING, np.uint16), np.zeros((len(at), 4), np.int32)
        way = np.ones(len(at), np.int64)
        for bit in range(4):
            has = np.flatnonzero(left > bit)
            way[has] = way[has] * 2 + taken[at[has] + bit]
            self.steps[has, bit] = np.minimum(4 * first[has] + bit, DEPTHS - 1) << 5 | way[has]
            self.at[has, bit] = path[at[has] + bit]
        self.hashes = np.array([zlib.crc32(w) for w in words] + [0], np.uint64)

    def __getstate__(self) -> dict:
        """Tasks need the lines only."""
        return {k: v for k, v in self.__dict__.items() if k not in ("path", "taken", "words")} | {"known": self.index()}

    @property
    def nodes(self) -> np.ndarray:
        return self.path

    @property
    def bits(self) -> np.ndarray:
        return self.taken

    def index(self) -> pa.Array:
        return self.known if hasattr(self, "known") else pa.array(self.words, pa.binary())

    def alone(self, own: bool) -> np.ndarray:
        """Logit of each line's bits by their nodes alone; with ``own`` the bit itself is left out."""
        def logit(less_zeros, less_ones):
            return np.log((np.maximum(self.ones - less_ones, 0) + 0.4) / (np.maximum(self.zeros - less_zeros, 0) + 0.4)).astype(np.float32)

        if not len(self.zeros):  # all words have the one sign, and there is no bit to ask for
            return np.zeros(self.at.shape, np.float32)
        if own:
            return np.where(self.steps & 1, logit(0, 1)[self.at], logit(1, 0)[self.at])
        return logit(0, 0)[self.at]


def hashed_words(words: pa.Array) -> np.ndarray:
    """A hash of each word's bytes and length."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, MULTIPLY))
    summed = np.zeros(len(place) + 1, np.uint64)
    np.cumsum((joined(words).astype(np.uint64) + np.uint64(1)) * powers[place], out=summed[1:])
    found = (summed[starts + sizes] - summed[starts]) * MULTIPLY
    return found ^ found >> np.uint64(32)


def joined(words: pa.Array) -> np.ndarray:
    """The bytes of all words, one after the other."""
    if not len(words) or words.buffers()[2] is None:
        return np.zeros(0, np.uint8)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]


def encoded(tokens: list[bytes] | pa.Array, sizes: list[int] | np.ndarray, index: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the tokens of several texts, and a hash of each context of each token; contexts end where a text begins."""
    tokens, other = pa.array(tokens, pa.binary()) if isinstance(tokens, list) else tokens, len(index)
    ids = pc.fill_null(pc.index_in(tokens, value_set=index), other).to_numpy(zero_copy_only=False).astype(np.int64)
    own = hashes[ids]
    rare = np.flatnonzero(ids == other)
    own[rare] = hashed_words(tokens.take(pa.array(rare)))
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = {}
    for back in {b for order in BEFORE for b in order}:
        before[back] = np.full(len(ids), 0x9E3779B97F4A7C15, np.uint64)
        before[back][back:] = own[:max(0, len(ids) - back)]
        before[back][place < back] = 0x9E3779B97F4A7C15
    contexts = np.empty((len(BEFORE), len(ids)), np.uint64)
    for k, order in enumerate(BEFORE):
        contexts[k] = 2 * k + 1
        for back in order:
            contexts[k] += before[back]
            contexts[k] *= MULTIPLY
            contexts[k] ^= contexts[k] >> np.uint64(29)
    return ids, contexts


def bitwise(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The entries of the bits of the lines at these places, four for each; a line of the table is read as one number."""
    whole = np.uint64 if table.dtype.itemsize == 2 else np.complex128
    return table.view(whole).reshape(-1).take(place).view(table.dtype)


def lines(ids: np.ndarray, contexts: np.ndarray, code: Code, sides: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line of the tokens' codes: its token, its place in the code, and its slot in each hashed table.

    The way to a bit changes the slot's last four digits; ``sides``: where a table has two entries for each slot.
    """
    many = code.lines.take(ids)
    token = np.repeat(np.arange(len(ids)), many)
    place = (code.firsts.take(ids) - (np.cumsum(many) - many)).take(token)
    place += np.arange(len(token))
    begins = code.begins.take(place, mode="clip")
    hashed = np.empty((len(contexts), len(token)), np.uint64)
    for row, context in zip(hashed, contexts):
        context.take(token, out=row, mode="clip")
        row += begins
    hashed *= MULTIPLY
    hashed >>= np.uint64(64 - SLOTS)
    if sides:
        hashed <<= np.uint64(1)
    return token, place, hashed.view(np.int64)


def cell(logit: np.ndarray) -> np.ndarray:
    """Which of the ``FINE`` logits is the nearest."""
    place = logit * np.float32(STEP)
    place += np.float32(FINE / 2)
    np.clip(place, 0, FINE - 1, out=place)
    return place.astype(np.int64)


# The chance of a one at each of them.
SQUASHED = squash((np.arange(FINE) + 0.5) / STEP - FINE / 2 / STEP).astype(np.float32)


def states(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A byte for each slot's counts."""
    level = np.searchsorted(LEVELS, zeros + ones, side="right")
    logit = np.clip(np.log((ones + 0.02) / (zeros + 0.02)), LEANS[0], LEANS[-1])
    lean = np.rint((logit - LEANS[0]) / (LEANS[1] - LEANS[0])).astype(np.int64)
    return np.where(level > 0, (level - 1) * len(LEANS) + lean + 1, 0).astype(np.uint8)


class Counts:
    """Counts of a hashed table, zeros and ones of a slot side by side."""

    def __init__(self):
        self.seen = np.zeros(2 << SLOTS, np.uint32)

    def add(self, places: np.ndarray) -> None:
        np.add.at(self.seen, places, np.uint32(1))

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """First slot and packed counts of each block that holds any."""
        for at in range(0, len(self.seen), 2 * BLOCK):
            counts = self.seen[at:at + 2 * BLOCK]
            if counts.any():
                # A byte for each count, and apart from these the few that need more.
                large = np.flatnonzero(counts > 0xFF)
                yield at // 2, pickle.dumps((pa.compress(counts.astype(np.uint8), "zstd", asbytes=True), large, counts[large]))

    @staticmethod
    def unpacked(data: bytes) -> np.ndarray:
        """Zeros and ones, a row for each slot."""
        low, large, values = pickle.loads(data)
        counts = np.frombuffer(pa.decompress(low, 2 * BLOCK, "zstd", asbytes=True), np.uint8).astype(np.int64)
        counts[large] = values
        return counts.reshape(-1, 2)



class TextMixer:
    """Context states, gated weights and the refining table."""

    def __init__(self, code: Code, tables: list[np.ndarray], weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        # A table has a state for each slot; for learning two side by side: a zero taken away, and a one taken away.
        self.code, self.tables = code, tables
        self.weights = np.tile(START[:, None], SETS).astype(float) if weights is None else weights
        self.steps = np.full(self.weights.shape, 1e-4)
        self.refine = np.zeros((2, DEPTHS * KNOWN * BUCKETS)) if refine is None else refine
        self.outcomes: list[np.ndarray] = []
        self.made: dict[str, object] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": {}}

    def learn(self, ids: np.ndarray, contexts: np.ndarray, rate: float) -> None:
        """Each bit as if its own occurrence had not been counted."""
        _, place, begins = lines(ids, contexts, self.code, True)
        if "alone" not in self.made:
            self.made["alone"] = self.code.alone(True)
        step = bitwise(self.code.steps, place)
        has = np.flatnonzero(step != LACKING)
        way = (step & np.uint16(31)).astype(np.int64)
        x = np.empty((len(START), len(has)), np.float32)
        x[-1] = 0.3
        bitwise(self.made["alone"], place).take(has, out=x[0], mode="clip")
        known = []
        for k, table in enumerate(self.tables):
            state = table.take((np.repeat(begins[k], 4) ^ way).take(has, mode="clip"), mode="clip")
            VALUE.take(state, out=x[k + 1], mode="clip")
            if k < 2:
                known.append(LEVEL.take(state))
        gate = known[0] * KNOWN + known[1]
        step = step.take(has, mode="clip").astype(np.int64)
        y = step & 1
        logit = np.einsum("kn,kn->n", self.weights.astype(np.float32).take(gate, axis=1, mode="clip"), x)
        wrong = y.astype(np.float32) - SQUASHED.take(cell(logit), mode="clip")
        mass = np.bincount(gate, minlength=SETS) + 20
        x *= wrong
        for k in range(len(x)):
            turn = np.bincount(gate, x[k], minlength=SETS) / mass
            self.steps[k] += turn * turn
            self.weights[k] += rate * turn / np.sqrt(self.steps[k])
        # The nearer bucket of the mixed logit.
        np.clip(logit, -8, 8, out=logit)
        logit += np.float32(8)
        logit *= np.float32((BUCKETS - 1) / 16)
        logit += np.float32(0.5)
        row = (step >> 5) * KNOWN + known[1]
        row *= BUCKETS
        row += logit.astype(np.int64)
        row <<= 1
        row += y
        self.outcomes.append(row)
        if len(self.outcomes) >= 32:
            self.settle()

    def settle(self) -> None:
        """Enter what was learned for the refining table."""
        if self.outcomes:
            seen = np.bincount(np.concatenate(self.outcomes), minlength=2 * self.refine.shape[1]).reshape(-1, 2)
            self.refine[0] += seen[:, 1]
            self.refine[1] += seen.sum(1)
            self.outcomes = []

    def prepared(self) -> tuple:
        """What scoring looks up: each predictor's part of the mixed logit by gate and state, and log10 of the final probability."""
        if "score" not in self.made:
            weights = self.weights.astype(np.float32)
            gates = ((LEVEL[:, None] * KNOWN + LEVEL) << 8).astype(np.int32).reshape(-1)
            first = weights[1][gates >> 8] * np.repeat(VALUE, 256) + weights[2][gates >> 8] * np.tile(VALUE, 256)
            first += weights[-1][gates >> 8] * np.float32(0.3)
            others = [np.outer(w, VALUE).reshape(-1) for w in weights[3:-1]]
            at = (np.arange(FINE) + 0.5) / STEP - FINE / 2 / STEP
            base = np.tile(squash(np.linspace(-8, 8, BUCKETS)), DEPTHS * KNOWN)
            refined = ((self.refine[0] + 50 * base) / (self.refine[1] + 50)).reshape(-1, BUCKETS)
            where = (np.clip(at, -8, 7.999) + 8) * ((BUCKETS - 1) / 16)
            low, part = where.astype(int), where % 1
            p = np.clip(0.5 * squash(at) + 0.5 * ((1 - part) * refined[:, low] + part * refined[:, low + 1]), 1e-5, 1 - 1e-5)
            final = np.zeros(((DEPTHS + 1) * KNOWN, FINE, 2), np.float32)  # a lacking bit costs nothing
            final[:DEPTHS * KNOWN] = np.log10(np.stack([1 - p, p], 2))
            self.made["score"] = self.code.alone(False), weights[0], gates, first, others, final.reshape(-1)
        return self.made["score"]

    def score(self, ids: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the ones before it."""
        alone, lead, gates, first, others, final = self.prepared()
        out = np.zeros(len(ids))
        for at in range(0, len(ids), SLICE):
            here = slice(at, at + SLICE)
            token, place, begins = lines(ids[here], contexts[:, here], self.code)
            step = bitwise(self.code.steps, place).astype(np.int64)
            way = (step >> 1) & 15
            state = [table.take(np.repeat(begins[k], 4) ^ way, mode="clip") for k, table in enumerate(self.tables)]
            both = state[0].astype(np.int64)
            both <<= 8
            both += state[1]
            gate = gates.take(both, mode="clip")
            logit = lead.take(gate >> 8, mode="clip")
            logit *= bitwise(alone, place)
            logit += first.take(both, mode="clip")
            for part, more in zip(others, state[2:]):
                logit += part.take(gate + more, mode="clip")
            row = LEVEL.take(state[1])
            row += (step >> 5) * KNOWN
            row *= FINE
            row += cell(logit)
            row <<= 1
            row += step & 1
            out[here] = np.bincount(token, final.take(row, mode="clip").reshape(-1, 4) @ np.ones(4, np.float32), minlength=len(ids[here]))
        return out


def groups(part: pa.RecordBatch, doc: int, text: int, training: bool) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Rows of a batch with the tokens of their texts, one after the other, and how many each has."""
    rows = np.arange(part.num_rows)
    if training:
        rows = np.flatnonzero([not held_out(d) for d in part.column(doc).to_pylist()])
    texts = part.column(text).take(pa.array(rows))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP, side="right")))
        found = split(texts.slice(at, upto - at))
        sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
        yield rows[at:upto], found.flatten().cast(pa.binary()), sizes
        at = upto


def _slices(parts: Iterable[pa.RecordBatch], code: Code) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and contexts of the training texts."""
    index = code.index()
    for part in parts:
        for _, tokens, sizes in groups(part, 0, 1, True):
            ids, contexts = encoded(tokens, sizes, index, code.hashes)
            for at in range(0, len(ids), SLICE):
                yield ids[at:at + SLICE], contexts[:, at:at + SLICE]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def context_states(documents: DataFrame, sent) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """States of every context over all training texts, and those without each bit itself; ``sent`` is a broadcast code."""
    schema = pa.schema([("table", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])

    def partial(parts):
        code = received(sent.value)
        tables = [Counts() for _ in BEFORE]
        for ids, contexts in _slices(parts, code):
            _, place, begins = lines(ids, contexts, code, True)
            step = bitwise(code.steps, place)
            has, way = np.flatnonzero(step != LACKING), (step & np.uint16(31)).astype(np.int64)
            for k, table in enumerate(tables):
                table.add((np.repeat(begins[k], 4) ^ way).take(has, mode="clip"))
        for k, table in enumerate(tables):
            for at, block in table.blocks():
                yield pa.RecordBatch.from_pylist([{"table": k, "block": at, "data": block}], schema)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        zero, one = sum(Counts.unpacked(d) for d in rows["data"]).T
        sides = np.stack([states(np.maximum(zero - 1, 0), one), states(zero, np.maximum(one - 1, 0))], 1)
        return pd.DataFrame({"table": rows["table"].iloc[:1], "block": rows["block"].iloc[:1],
                             "whole": [states(zero, one).tobytes()], "sides": [sides.tobytes()]})

    kind, packed = "table int, block int, data binary", "table int, block int, whole binary, sides binary"
    whole, sides = ([np.zeros(size << SLOTS, np.uint8) for _ in BEFORE] for size in (1, 2))
    for r in _texts(documents).mapInArrow(partial, kind).groupBy("table", "block").applyInPandas(add, packed).toLocalIterator():
        whole[r.table][r.block:r.block + BLOCK] = np.frombuffer(r.whole, np.uint8)
        sides[r.table][2 * r.block:2 * (r.block + BLOCK)] = np.frombuffer(r.sides, np.uint8)
    return whole, sides


def train(documents: DataFrame, code: Code, rate: float = 0.02) -> TextMixer:
    """Context counts, then weights learned online over every part of the training texts and averaged by their tokens."""
    context = documents.sparkSession.sparkContext
    sent = context.broadcast(shipped(code))
    tables, sides = context_states(documents, sent)
    model = context.broadcast(shipped(sides))
    del sides
    schema = pa.schema([("mass", pa.int64()), ("weights", pa.binary()), ("refine", pa.binary())])

    def learn(parts):
        code = received(sent.value)
        mixer, mass = TextMixer(code, received(model.value)), 0
        for ids, contexts in _slices(parts, code):
            mixer.learn(ids, contexts, rate)
            mass += len(ids)
        mixer.settle()
        yield pa.RecordBatch.from_pylist([{"mass": mass, "weights": (mixer.weights.astype(float) * mass).tobytes(),
                                           "refine": mixer.refine.tobytes()}], schema)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        summed = {name: [sum(map(np.frombuffer, rows[name])).tobytes()] for name in ("weights", "refine")}
        return pd.DataFrame({"mass": [int(rows["mass"].sum())], **summed})

    # Parts are summed in groups first, so that the driver gets a few rows however many there are.
    kind = "mass long, weights binary, refine binary"
    learned = _texts(documents).mapInArrow(learn, kind).groupBy(F.spark_partition_id() % 16).applyInPandas(add, kind).collect()
    sent.unpersist()
    model.unpersist()
    mass = sum(r.mass for r in learned)
    if not mass:
        return TextMixer(code, tables)
    return TextMixer(code, tables, sum(np.frombuffer(r.weights) for r in learned).reshape(len(START), SETS) / mass,
                     sum(np.frombuffer(r.refine) for r in learned).reshape(2, -1))
