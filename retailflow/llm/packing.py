"""Pack token ids into training windows with a bounded number of open windows per partition.

A document's whole windows leave at once; its remainder goes to the open window it fits best.  If none has room
and no more may be opened, the fullest is filled with the head of the remainder (documents may be cut anywhere)
and emitted.  What a partition still holds at its end is strung together into full windows and one remainder;
the remainders of all partitions, one each, are merged best-fit, 256 partitions at a time.

Defined results: a null or empty text is the end id alone; repeated rows are packed each on its own; a null id is
carried as null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import batches, saved

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()),
])
PIECES_SQL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, part long")


class _Chunks(dict):
    """Ids of a chunk of text; at most ``limit`` chunks are remembered, the others are encoded each time."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk: str) -> list[int]:
        ids = self.encode(chunk)
        if len(self) < self.limit:
            self[chunk] = ids
        return ids


class Encoder:
    """The ids of ``<vocabulary>.json`` without special tokens added.

    The vocabulary's pattern never joins what two single spaces between other characters keep apart, so such a
    text is cut there and each chunk (with its space) is encoded once and remembered.  Texts with white space
    next to a space are encoded whole; texts with the special token's own string go to the ``tokenizers`` library,
    which gives that string its id.
    """

    def __init__(self, vocabulary: str = VOCABULARY, remembered: int = 300_000):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self._json = public_tokenizers.path(f"{vocabulary}.json")
        self._whole = None
        self._chunks = _Chunks(self._bpe.encode_ordinary, remembered)
        self._runs = re.compile(r"\s | \s")

    def __call__(self, text: str) -> list[int]:
        if SPECIAL in text:
            if self._whole is None:
                from tokenizers import Tokenizer

                self._whole = Tokenizer.from_file(self._json)
            return self._whole.encode(text, add_special_tokens=False).ids
        if not text or self._runs.search(text):
            return self._bpe.encode_ordinary(text)
        first, *rest = text.split(" ")
        return list(chain(self._bpe.encode_ordinary(first),
                          chain.from_iterable(map(self._chunks.__getitem__, [" " + x for x in rest]))))


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(vocabulary)


class _Window:
    __slots__ = ("free", "pieces")

    def __init__(self, room: int):
        self.free, self.pieces = room, []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.free -= len(piece[2])


class Packer:
    """Bounded-space best fit over one partition; rows leave as soon as their window does."""

    def __init__(self, part: int, room: int, windows: int, least: int):
        self.part, self.room, self.windows, self.least = part, room, windows, least
        self.open: list[_Window] = []
        self.sent = 0

    def _emit(self, pieces: list[tuple], full: bool = True) -> Iterator[tuple]:
        at = 0
        number = (self.part << 36) | self.sent
        self.sent += 1
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, number, at, None if full else self.part
            at += len(ids)

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        whole = total - total % self.room
        for start in range(0, whole, self.room):
            yield from self._emit([(doc, start, ids[start:start + self.room], total)])
        if whole < total:
            yield from self._place((doc, whole, ids[whole:], total))

    def _place(self, piece: tuple) -> Iterator[tuple]:
        doc, start, ids, total = piece
        size = len(ids)
        best = min((w for w in self.open if w.free >= size), key=lambda w: w.free, default=None)
        if best is None and len(self.open) >= self.windows:
            best = min(self.open, key=lambda w: w.free)
            gap = best.free
            self.open.remove(best)
            if gap >= self.least and size - gap >= self.least:
                best.add((doc, start, ids[:gap], total))
                yield from self._emit(best.pieces)
                yield from self._place((doc, start + gap, ids[gap:], total))
                return
            yield from self._emit(best.pieces)
            best = None
        if best is None:
            best = _Window(self.room)
            self.open.append(best)
        best.add(piece)
        if not best.free:
            self.open.remove(best)
            yield from self._emit(best.pieces)

    def finish(self) -> Iterator[tuple]:
        """String what is open together; the last window, if not full, is this partition's remainder."""
        now, free = [], self.room
        for doc, start, ids, total in chain.from_iterable(w.pieces for w in self.open):
            while len(ids):
                head = ids[:free]
                now.append((doc, start, head, total))
                start, ids, free = start + len(head), ids[len(head):], free - len(head)
                if not free:
                    yield from self._emit(now)
                    now, free = [], self.room
        if now:
            yield from self._emit(now, full=False)
        self.open = []


def pack(documents: DataFrame, room: int = 1024, windows: int = 64, least: int = 16, end_id: int = 0,
         vocabulary: str = VOCABULARY, merged: int = 256) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``windows`` are open at once in a partition, ``least`` is the smallest piece cut to fill a gap, and the
    remainders of ``merged`` partitions are merged together.
    """

    def run(parts):
        encode = encoder(vocabulary)
        packer = Packer(TaskContext.get().partitionId(), room, windows, least)

        def rows():
            for part in parts:
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = encode(text.as_py() or "")
                    ids.append(end_id)
                    yield from packer.add(doc, np.array(ids, dtype="<u4"))
            yield from packer.finish()

        yield from batches(rows(), PIECES)

    pieces = saved(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                   .mapInArrow(run, PIECES_SQL), "pieces")

    def merge(left: pd.DataFrame) -> pd.DataFrame:
        """Best fit, largest first, of one remainder per partition."""
        group = int(left["part"].iloc[0]) // merged
        used = left.groupby("part")["length"].sum().sort_values(ascending=False, kind="stable")
        filled: list[int] = []
        place = {}
        for part, size in used.items():
            at = max((i for i, x in enumerate(filled) if x + size <= room), key=filled.__getitem__, default=None)
            if at is None:
                at = len(filled)
                filled.append(0)
            place[part] = (at, filled[at])
            filled[at] += size
        left["sequence_id"] = [(1 << 62) | (group << 36) | place[p][0] for p in left["part"]]
        left["offset"] = left["offset"] + [place[p][1] for p in left["part"]]
        return left

    rest = pieces.where("part is not null").groupBy(F.expr(f"part div {merged}").alias("group")).applyInPandas(
        merge, PIECES_SQL)
    return pieces.where("part is null").unionByName(rest).drop("part")
