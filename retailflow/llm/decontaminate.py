"""Find benchmark passages in a corpus with a positional inverted index.

The corpus is cut into shards of bounded size.  A shard's row in the stored index holds the postings of all its
terms: sorted positions over the whole shard, one gap between documents.  Shards are written in row groups of a few
and searched one at a time, so that a task holds few of them however many its partition has.  Benchmark windows are
sent to every shard in blocks of bounded size (a stated query set against all rows).  In a shard, a window starts from the
postings of its rarest term, shifted by the term's offset, and is intersected with the shifted postings of the
next rarest, until nothing is left or all terms agree: an exact phrase match.  With ``slop`` each term may stand
that many words away from its place: a proximity match.

Defined results: a null text has no words; a text without words has no windows and is never hit; an item shorter
than a window is one window; repeated rows each give a row; a null doc_id is carried as null; benchmark rows with a
null item_id hit words like others but are not among the items; an empty benchmark or corpus gives no hits or no
rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import batches, saved

# Fixed value: words are runs of 0-9, a-z (after lower-casing A-Z) and everything beyond ASCII.
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))

SHARDS = pa.schema([
    ("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("terms", pa.binary()), ("ends", pa.binary()), ("positions", pa.binary()),
])
SHARDS_SQL = "shard long, doc_ids array<long>, sizes array<int>, terms binary, ends binary, positions binary"
# Shards written or read at once; Parquet goes by bytes only once a row group has a hundred rows.
GROUP = 4
HITS = pa.schema([
    ("shard", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())),
])
HITS_SQL = ("shard long, ordinal long, doc_id long, n_words long, spans array<struct<begin:int,end:int>>, "
            "items array<string>")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], width: int) -> Iterator[bytes]:
    """Each run of ``width`` words; fewer words, but not none, are one window."""
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield b" ".join(words[i:i + width])


def build_index(documents: DataFrame, shard_words: int = 500_000) -> DataFrame:
    """One row per shard of about ``shard_words`` words: documents, terms and the positions of each term."""

    def shard_row(number: int, ids: list, sizes: list[int], words: list[bytes]) -> tuple:
        if words:
            coded = pa.array(words, pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy()
            terms = coded.dictionary.to_pylist()
        else:
            codes, terms = np.zeros(0, np.int32), []
        # A document begins one place after the one before it ends, so no phrase runs over.
        places = np.arange(len(words), dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes, minlength=len(terms))).astype(np.int32)
        return number, ids, sizes, b" ".join(terms), ends.tobytes(), places[order].astype(np.int32).tobytes()

    def run(parts):
        part = TaskContext.get().partitionId()

        def rows():
            ids, sizes, words, number = [], [], [], 0
            for batch in parts:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = words_of(text.as_py())
                    ids.append(doc)
                    sizes.append(len(found))
                    words += found
                    if len(words) + len(ids) >= shard_words:
                        yield shard_row((part << 32) | number, ids, sizes, words)
                        ids, sizes, words, number = [], [], [], number + 1
            if ids:
                yield shard_row((part << 32) | number, ids, sizes, words)

        yield from batches(rows(), SHARDS, size=GROUP)

    return saved(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                 .mapInArrow(run, SHARDS_SQL), "index", **{"parquet.block.row.count.limit": GROUP})


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``window, item``: every window of every item once; the item of a row without an id is null."""
    schema = pa.schema([("window", pa.binary()), ("item", pa.string())])

    def run(parts):
        yield from batches(
            ((w, item) for batch in parts
             for item, text in zip(batch.column(0).to_pylist(), batch.column(1))
             for w in dict.fromkeys(windows_of(words_of(text.as_py()), width))), schema)

    return benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "window binary, item string").distinct()


class Queries:
    """A block of windows, with their words coded, ready to be run against shards."""

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        items: dict[bytes, list[str]] = {}
        for window, item in pairs:
            items.setdefault(window, []).extend([] if item is None else [item])
        self.items = list(items.values())
        code: dict[bytes, int] = {}
        codes, ends = array("i"), array("q", [0])
        for window in items:
            codes.extend(code.setdefault(t, len(code)) for t in window.split(b" "))
            ends.append(len(codes))
        self.terms, self.codes, self.ends = list(code), np.array(codes, np.int32), ends

    def search(self, terms: list[bytes], ends: np.ndarray, positions: np.ndarray, slop: int = 0):
        """``(window number, starts)`` for each window that occurs in the shard."""
        at = {t: i for i, t in enumerate(terms)}
        place = [at.get(t, -1) for t in self.terms]
        lists = [positions[ends[i - 1] if i else 0:ends[i]] if i >= 0 else positions[:0] for i in place]
        sizes = np.array([len(x) for x in lists])
        for number in range(len(self.items)):
            window = self.codes[self.ends[number]:self.ends[number + 1]]
            counts = sizes[window]
            if not counts.all():
                continue
            rarest, *others = np.argsort(counts, kind="stable")
            starts = lists[window[rarest]] - rarest
            for o in others:
                there = lists[window[o]]
                i = np.searchsorted(there, starts + (o - slop))
                inside = i < len(there)
                starts = starts[inside][there[i[inside]] <= starts[inside] + o + slop]
                if not len(starts):
                    break
            else:
                yield number, starts, len(window)


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"begin": begin, "end": end})
    return out


def search_index(index: DataFrame, pairs: list[tuple[bytes, str | None]], slop: int = 0) -> DataFrame:
    """One row per document and block: merged word spans that windows hit, and the items the windows belong to."""
    sent = index.sparkSession.sparkContext.broadcast(pickle.dumps(pairs))

    def run(parts):
        queries = Queries(pickle.loads(sent.value))

        def rows():
            for batch in parts:
                for at in range(batch.num_rows):
                    [r] = batch.slice(at, 1).to_pylist()
                    sizes = np.array(r["sizes"], np.int64)
                    begins = np.cumsum(sizes + 1) - sizes - 1
                    spans, items = defaultdict(list), defaultdict(set)
                    for number, starts, width in queries.search(
                            r["terms"].split(b" "), np.frombuffer(r["ends"], np.int32), np.frombuffer(r["positions"], np.int32), slop):
                        docs = np.searchsorted(begins, starts, side="right") - 1
                        for doc, begin in zip(docs.tolist(), (starts - begins[docs]).tolist()):
                            spans[doc].append((max(0, begin), min(begin + width, int(sizes[doc]))))
                            items[doc].update(queries.items[number])
                    for i, doc in enumerate(r["doc_ids"]):
                        yield (r["shard"], i, doc, int(sizes[i]), _merged(spans[i]) if i in spans else [],
                               sorted(items[i]) if i in items else [])

        yield from batches(rows(), HITS)

    return index.mapInArrow(run, HITS_SQL)


def find_passages(documents: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 0,
                  block_windows: int = 200_000, shard_words: int = 500_000) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, spans, items`` (items sorted as strings).

    Windows go to the shards in blocks of about ``block_windows``, each collected and broadcast on its own.
    """
    spark = documents.sparkSession
    windows = saved(item_windows(benchmark, width), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    index = build_index(documents, shard_words)
    found = None
    for block in range(blocks):
        pairs = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block)
        hits = search_index(index, [(bytes(w), i) for w, i in pairs.toLocalIterator()], slop)
        found = hits if found is None else found.unionByName(hits)
    hits = found.groupBy("shard", "ordinal", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Each span counts from where the spans before it have ended.
    n_hit = F.expr("""aggregate(spans, named_struct('n', 0L, 'upto', 0),
        (a, s) -> named_struct('n', a.n + greatest(0, s.end - greatest(s.begin, a.upto)),
                               'upto', greatest(s.end, a.upto)), a -> a.n)""")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")
