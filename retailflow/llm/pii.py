"""Personal data in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

The base spans come from patterns and checks alone and always stay.  The field reads runs of marked words (those
with a digit or an @), cut into runs of letters, runs of digits and single marks, with features of their shapes; it
is trained on a small table of labelled runs and decoded by Viterbi over padded numpy batches.  A word without a
mark can carry no label, so runs are independent of each other and whole texts of any length are covered.

A run of the field is added when it touches no base span.  The labelled table holds runs from at most ``sample``
documents, labelled by the base rules, and looser spellings of the labelled runs (a phone without its plus sign).

Defined results: a null or empty text has no spans; repeated rows each give a row; a null id is carried as null;
an empty table gives no rows, and without labelled runs the field adds nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import WHITE, batches

# Kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
BITS = 13
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
PIECE = re.compile(r"[^\W\d_]+|[0-9]+|[\x20\x09-\x0D]+|.", re.S)

Span = tuple[int, int, int]  # start, kind's number, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: what stands before it, then the host."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = free + len(text[free:at].rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if begin < at else None
        if host:
            yield begin, host.end()
            free = host.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns that pass their checks, by start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def runs_of(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of each longest run of marked words parted by single white space."""
    at, begin, end = 0, -1, -1
    m = MARK.search(text)
    while m:
        i = m.start()
        low = max(text.rfind(c, at, i) for c in WHITE) + 1 or at
        stop = SPACE.search(text, i)
        stop = stop.start() if stop else len(text)
        if begin >= 0 and low - end == 1:
            end = stop
        else:
            if begin >= 0:
                yield begin, text[begin:end]
            begin, end = low, stop
        at = stop
        m = MARK.search(text, stop)
    if begin >= 0:
        yield begin, text[begin:end]


def _shape(piece: str) -> str:
    c = piece[0]
    if c.isdigit() and c.isascii():
        n = len(piece)
        kind = f"9{min(n, 20)}"
        if 14 <= n <= 19:
            return kind + "L"[:luhn(piece)]
        return kind + "s"[:n <= 3 and int(piece) <= 255]
    if c.isalpha():
        return ("A" if piece.isupper() else "a") + ("+" if len(piece) > 1 else "")
    return "_" if c in WHITE else c


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


def features(run: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Places of the pieces, and the hashed features of each (a fixed number)."""
    places, shapes = [], ["<<", "<"]
    for m in PIECE.finditer(run):
        places.append(m.span())
        shapes.append(_shape(m[0]))
    shapes += [">", ">>"]
    slots = [
        [_slot(n) for n in ("0" + b, "-1" + a, "+1" + c, f"-10{a} {b}", f"0+1{b} {c}", f"-1+1{a} {b} {c}",
                            f"-2{shapes[i - 2]} {a} {b}", f"+2{b} {c} {shapes[i + 2]}")]
        for i in range(2, len(shapes) - 2) for a, b, c in [shapes[i - 1:i + 2]]
    ]
    return places, np.array(slots, np.int32).reshape(-1, 8)


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slots as one array (runs, longest, 8); what is beyond a run's end points at an empty slot."""
    lengths = np.array([len(r) for r in rows])
    out = np.full((len(rows), lengths.max(initial=1), 8), 1 << BITS, np.int32)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out, lengths


def _allowed() -> np.ndarray:
    """An inside label follows its own kind only."""
    n = len(LABELS)
    ok = np.zeros((n, n))
    for a in range(n):
        for b in range(1, n):
            if LABELS[b][0] == "I" and LABELS[a][2:] != LABELS[b][2:]:
                ok[a, b] = -1e4
    return ok


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each run, by Viterbi over all runs at once."""
        slots, lengths = padded(rows)
        scores = self.emit[slots].sum(axis=2)
        n, longest, k = scores.shape
        first = np.where([x[0] == "I" for x in LABELS], -1e4, 0.0)
        best, back = scores[:, 0] + first, np.zeros((longest, n, k), np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + self.step[None]
            back[t] = through.argmax(axis=1)
            # Past its end a run keeps its last state.
            on = (t < lengths)[:, None]
            best = np.where(on, through.max(axis=1) + scores[:, t], best)
            back[t] = np.where(on, back[t], np.arange(k))
        labels = np.zeros((n, longest), np.int8)
        labels[:, -1] = best.argmax(axis=1)
        for t in range(longest - 1, 0, -1):
            labels[:, t - 1] = back[t][np.arange(n), labels[:, t]]
        return [labels[i, :m] for i, m in enumerate(lengths)]

    def spans(self, texts: list[str], size: int = 512) -> list[list[Span]]:
        """Spans the field finds in each text."""
        where, places, rows = [], [], []
        for number, text in enumerate(texts):
            for begin, run in runs_of(text):
                p, s = features(run)
                where.append((number, begin))
                places.append(p)
                rows.append(s)
        out: list[list[Span]] = [[] for _ in texts]
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            # Runs of like length together, and less of them the longer they are.
            group = order[at:at + size]
            group = group[:max(1, 200_000 // max(1, len(rows[group[-1]])))]
            at += len(group)
            for i, labels in zip(group, self.decode([rows[i] for i in group])):
                number, begin = where[i]
                kind = -1
                for (a, b), label in zip(places[i], labels):
                    if label and label % 2 == 0 and kind == (label - 1) // 2:
                        last = out[number][-1]
                        out[number][-1] = (last[0], last[1], begin + b)
                    elif label:
                        kind = (int(label) - 1) // 2
                        out[number].append((begin + a, kind, begin + b))
                    else:
                        kind = -1
        return out


def fit(rows: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, rate: float = 0.1,
        decay: float = 2e-4) -> Field:
    """Maximum conditional likelihood by full-batch Adam steps; forward and backward run over all runs at once."""
    slots, lengths = padded(rows)
    n, longest, _ = slots.shape
    k = len(LABELS)
    gold = np.zeros((n, longest), np.int64)
    for i, x in enumerate(labels):
        gold[i, :len(x)] = x
    on = np.arange(longest)[None] < lengths[:, None]
    ban = _allowed()
    first = np.where([x[0] == "I" for x in LABELS], -1e4, 0.0)
    emit, step = np.zeros(((1 << BITS) + 1, k)), np.zeros((k, k))
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (gold[:, :-1][on[:, 1:]], gold[:, 1:][on[:, 1:]]), 1)
    onehot = np.eye(k)[gold] * on[:, :, None]
    state = [np.zeros_like(x) for x in (emit, step, emit, step)]
    flat = slots.reshape(n * longest, -1)

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    for turn in range(1, steps + 1):
        scores, move = emit[slots].sum(axis=2), step + ban
        fore, aft = np.zeros((longest, n, k)), np.zeros((longest, n, k))
        fore[0] = scores[:, 0] + first
        for t in range(1, longest):
            now = total(fore[t - 1][:, :, None] + move[None], 1) + scores[:, t]
            fore[t] = np.where(on[:, t, None], now, fore[t - 1])
        z = total(fore[-1], 1)
        pairs = np.zeros((k, k))
        for t in range(longest - 2, -1, -1):
            inner = scores[:, t + 1] + aft[t + 1]
            now = total(move[None] + inner[:, None, :], 2)
            aft[t] = np.where(on[:, t + 1, None], now, aft[t + 1])
            p = np.exp(fore[t][:, :, None] + move[None] + inner[:, None, :] - z[:, None, None])
            pairs += p[on[:, t + 1]].sum(axis=0)
        marginal = np.exp(fore + aft - z[None, :, None]).transpose(1, 0, 2) * on[:, :, None]
        wrong = (marginal - onehot).reshape(n * longest, k)
        g_emit = np.zeros_like(emit)
        for c in range(k):
            g_emit[:, c] = np.bincount(flat.ravel(), np.repeat(wrong[:, c], flat.shape[1]), minlength=len(emit))
        for x, g, m, v in ((emit, g_emit / n + decay * emit, state[0], state[2]),
                           (step, (pairs - seen_pairs) / n + decay * step, state[1], state[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * m / (1 - 0.9**turn) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        emit[-1] = 0
    return Field(emit, step + ban)


def labelled_runs(text: str) -> list[tuple[str, list[Span]]]:
    """Runs of a text with the base spans in them, and looser spellings of the same."""
    found = base_spans(text)
    out = []
    for begin, run in runs_of(text):
        spans = [(a - begin, k, b - begin) for a, k, b in found if begin <= a and b <= begin + len(run)]
        out.append((run, spans))
        if len(spans) == 1 and spans[0][1] == 3:
            a, _, b = spans[0]
            bare = re.sub(r"^\+[0-9]+[\x20-]?", "", run[a:b])
            if bare.startswith("("):
                out.append((bare, [(0, 3, len(bare))]))
    return out


def labels_of(run: str, spans: list[Span]) -> np.ndarray:
    places, _ = features(run)
    labels = np.zeros(len(places), np.int8)
    for a, kind, b in spans:
        inside = [i for i, (x, y) in enumerate(places) if a <= x and y <= b]
        if inside and not labels[inside].any():
            labels[inside] = 2 * kind + 2
            labels[inside[0]] = 2 * kind + 1
    return labels


def train(documents: DataFrame, sample: int = 2000, longest: int = 60, copies: int = 20) -> Field | None:
    """Fit on the runs of at most ``sample`` documents that have a mark.

    Runs of more than ``longest`` pieces are not learned from, and of runs with the same shapes and labels at most
    ``copies`` are, which keeps the table small.
    """
    chosen = documents.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]")) \
        .orderBy(F.xxhash64("text"), F.length("text")).limit(sample)

    def table(parts):
        for part in parts:
            rows = [(run, [x for s in spans for x in s]) for text in part["text"] for run, spans in labelled_runs(text)
                    if len(run) <= 8 * longest]
            yield pd.DataFrame(rows, columns=["run", "spans"])

    seen: dict[tuple, int] = {}
    rows, labels = [], []
    for r in sorted(chosen.mapInPandas(table, "run string, spans array<int>").collect()):
        spans = [tuple(r.spans[i:i + 3]) for i in range(0, len(r.spans), 3)]
        _, slots = features(r.run)
        gold = labels_of(r.run, spans)
        key = (slots.tobytes(), gold.tobytes())
        seen[key] = seen.get(key, 0) + 1
        if 0 < len(slots) <= longest and seen[key] <= copies:
            rows.append(slots)
            labels.append(gold)
    return fit(rows, labels) if any(x.any() for x in labels) else None


def apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that touch no base span."""
    starts = [a for a, _, _ in base]
    ends = list(accumulate((b for _, _, b in base), max))
    # The last base span that starts before a span ends, and the furthest end up to there.
    return [x for x in spans if not (i := bisect_left(starts, x[2])) or ends[i - 1] <= x[0]]


def plausible(kind: int, piece: str) -> bool:
    """What any spelling of a kind has; the field's spans without it are not added."""
    digits = sum(c.isdigit() for c in piece)
    return ("@" in piece[1:-1], len(re.findall("[0-9]+", piece)) == 4, digits >= 14, digits >= 7)[kind]


FOUND = pa.schema([
    ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
    ("n_added", pa.int64()),
])
FOUND_SQL = ("doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
             + ", base_sha256 string, spans string, n_added long")


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(documents: DataFrame, field: Field | None) -> DataFrame:
    """Per document: base counts per kind, digest of the base spans, all spans, and how many the field added."""
    sent = documents.sparkSession.sparkContext.broadcast((field.emit, field.step) if field else None)

    def run(parts):
        here = Field(*sent.value) if sent.value else None

        def rows():
            for part in parts:
                texts = [t.as_py() or "" for t in part.column(1)]
                more = here.spans(texts) if here else [[] for _ in texts]
                for doc, text, extra in zip(part.column(0).to_pylist(), texts, more):
                    base = base_spans(text)
                    extra = [x for x in apart(extra, base) if plausible(x[1], text[x[0]:x[2]])]
                    counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                    yield (doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + extra),
                           len(extra))

        yield from batches(rows(), FOUND)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND_SQL)
