"""Centroid clustering of integer vectors over subvector dictionaries, exact in every step.

Vectors are quantised to integers and cut into blocks of ``width`` dimensions.  Chunks of vectors are dictionary-encoded
once: per block the distinct subvectors and a code per vector, nothing lost.  In every round a task computes, per chunk and block,
the squared distances of the dictionary's entries to all centroids once and sums these by the vectors' codes;
the sums of a cluster's members come from the counts of codes per cluster.  What leaves a task is one row per cluster
and dimension, summed exactly over all its chunks, so no key is shuffled with its members and a cluster or value that
holds most rows costs no more than another.  Only the ``k`` centroids pass through the driver.

Chunks are written to the shared folder, so a lost executor's work is read again from there.

Arithmetic: 64-bit integers where all numbers of a chunk and the centroids are below 2^27 in magnitude (then no sum of
64 squares overflows), Python's unbounded integers otherwise.

Defined results: a vector takes part if it has exactly ``dims`` components, none null or not finite; the others give no
row.  Rows that share an id are rows of their own; a null id is hashed as an empty text.  Starting vectors with equal hash
are ordered by their components.  Fewer vectors than ``k`` give as many centroids; no vectors give no rows.  A distance
or sum that a long cannot hold is null.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import saved

SMALL = 2**27
LONG = 2**63 - 1


def usable(vector: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null or not finite."""
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == dims) & F.coalesce(fits, F.lit(False))


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x) / scale`` for a power of two: exact in doubles, and so is the integer it stands for."""
    with np.errstate(over="ignore"):
        return np.where(np.abs(x) < 2.0**60, np.floor(x * scale) / scale, x)


def whole(x: np.ndarray, scale: int, small: bool) -> np.ndarray:
    """The integers ``scale * x`` of quantised numbers, as int64 or as Python's."""
    if small:
        return (x * scale).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 2.0**60 else int(v * scale) for v in x.ravel().tolist()], object).reshape(x.shape)


class Chunk:
    """Vectors as codes into the distinct subvectors of each block."""

    def __init__(self, ids: list[int | None], codes: np.ndarray, books: list[np.ndarray]):
        self.ids, self.codes, self.books = ids, codes, books

    @classmethod
    def encoded(cls, ids: list[int | None], vectors: np.ndarray, width: int) -> Chunk:
        codes, books = [], []
        for at in range(0, vectors.shape[1], width):
            block = np.ascontiguousarray(vectors[:, at:at + width])
            book, code = np.unique(block, axis=0, return_inverse=True)
            books.append(book)
            codes.append(code.reshape(-1))
        return cls(ids, np.array(codes, np.uint32), books)

    def row(self) -> tuple:
        """Codes and dictionaries as bytes; a dictionary of small numbers is stored as 32-bit floats, which hold them exactly."""
        narrow = all(np.array_equal(b, b.astype(np.float32)) for b in self.books)
        kind = np.float32 if narrow else np.float64
        return (self.ids, self.codes.astype(np.uint16 if self.codes.max() < 2**16 else np.uint32).tobytes(),
                [b.astype(kind).tobytes() for b in self.books], narrow)

    @classmethod
    def read(cls, ids: list[int | None], codes: bytes, books: list[bytes], narrow: bool, width: int, dims: int) -> Chunk:
        blocks = len(books)
        kind = np.uint16 if len(codes) == 2 * blocks * len(ids) else np.uint32
        widths = [min(width, dims - at) for at in range(0, dims, width)]
        return cls(ids, np.frombuffer(codes, kind).reshape(blocks, len(ids)),
                   [np.frombuffer(b, np.float32 if narrow else np.float64).astype(np.float64).reshape(-1, w) for b, w in zip(books, widths)])


class Assigner:
    """Nearest centroids of chunks, and the sums of the clusters' members."""

    def __init__(self, centroids: list[list[int]], width: int, scale: int):
        self.centroids, self.width, self.scale = centroids, width, scale
        self.small = all(abs(v) < SMALL for c in centroids for v in c)

    def values(self, chunk: Chunk) -> tuple[list[np.ndarray], np.ndarray]:
        small = self.small and all(np.abs(b).max(initial=0.0) * self.scale < SMALL for b in chunk.books)
        return [whole(b, self.scale, small) for b in chunk.books], np.array(self.centroids, np.int64 if small else object)

    def nearest(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Cluster and squared distance of each vector, and the chunk's dictionaries as integers."""
        books, centroids = self.values(chunk)
        total = np.zeros((len(chunk.ids), len(centroids)), centroids.dtype)
        for b, book in enumerate(books):
            part = np.zeros((len(book), len(centroids)), centroids.dtype)
            for i in range(book.shape[1]):
                apart = book[:, i, None] - centroids[None, :, b * self.width + i]
                part += apart * apart
            total += part[chunk.codes[b]]
        cluster = np.argmin(total, axis=1)  # the first of equal ones: the smaller number
        return cluster, total[np.arange(len(cluster)), cluster], books

    def sums(self, chunk: Chunk) -> tuple[list[int], list[list[int]]]:
        """Members and componentwise sums of each cluster, by counting codes."""
        cluster, _, books = self.nearest(chunk)
        k = len(self.centroids)
        sums: list[list[int]] = [[] for _ in range(k)]
        for b, book in enumerate(books):
            counts = np.bincount(cluster * len(book) + chunk.codes[b], minlength=k * len(book)).reshape(k, len(book))
            for c, total in enumerate((counts.astype(book.dtype) @ book).tolist()):
                sums[c].extend(total)
        return np.bincount(cluster, minlength=k).tolist(), sums


CHUNK = pa.schema([("ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("books", pa.list_(pa.binary())), ("narrow", pa.bool_())])


def _batch(row: tuple, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def encode(vectors: DataFrame, dims: int, scale: int, width: int, most: int) -> DataFrame:
    """Chunks of at most ``most`` rows of ``vec_id, vector``, encoded and stored."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        held: list[np.ndarray] = []
        for part in parts:
            ids.extend(part.column(0).to_pylist())
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            held.append(quantised(flat.reshape(-1, dims), scale))
            while len(ids) >= most:
                rows = np.concatenate(held)
                yield _batch(Chunk.encoded(ids[:most], rows[:most], width).row(), CHUNK)
                ids, held = ids[most:], [rows[most:]]
        if ids:
            yield _batch(Chunk.encoded(ids, np.concatenate(held), width).row(), CHUNK)

    return saved(vectors.mapInArrow(run, "ids array<long>, codes binary, books array<binary>, narrow boolean"), "chunks")


def _chunks(parts: Iterator[pa.RecordBatch], width: int, dims: int) -> Iterator[Chunk]:
    for part in parts:
        for i in range(part.num_rows):
            yield Chunk.read(part.column(0)[i].as_py(), part.column(1)[i].as_py(), part.column(2)[i].as_py(),
                             part.column(3)[i].as_py(), width, dims)


def moved(chunks: DataFrame, centroids: list[list[int]], width: int, dims: int, scale: int) -> list[list[int]]:
    """The centroids after one round; one row per cluster and dimension leaves each task."""
    schema = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("n", pa.int64()), ("total", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(centroids, width, scale)
        members = [0] * len(centroids)
        totals = [[0] * dims for _ in centroids]
        for chunk in _chunks(parts, width, dims):
            n, sums = assigner.sums(chunk)
            for c, count in enumerate(n):
                if count:
                    members[c] += count
                    totals[c] = [a + b for a, b in zip(totals[c], sums[c])]
        rows = [(c, d, members[c], str(v)) for c, values in enumerate(totals) if members[c] for d, v in enumerate(values)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(map(list, zip(*rows)), schema)], schema=schema)

    # Totals are text because they may be longer than any number type; tasks' totals are added by the digits they share.
    tasks = chunks.mapInArrow(run, "cluster int, dim int, n long, total string")
    number = F.col("total").try_cast("decimal(38,0)")
    summed = tasks.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(number, F.lit(0))).alias("total"),
        F.collect_list(F.when(number.isNull(), F.col("total"))).alias("long_totals"))
    out = [list(c) for c in centroids]
    for row in summed.collect():  # at most k * dims rows
        out[row.cluster][row.dim] = (int(row.total) + sum(map(int, row.long_totals))) // row.n
    return out


def first_centroids(vectors: DataFrame, k: int, scale: int) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest hashes, in that order."""
    digest = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()
    return [whole(quantised(np.array(r.vector, float), scale), scale, False).tolist() for r in rows]


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, width: int = 2,
            most: int = 16_384) -> DataFrame:
    """Per vector ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    ``scale`` is a power of two; ``width`` is the number of dimensions of a block and ``most`` the rows of a chunk.
    """
    vectors = embeddings.where(usable(F.col("embedding"), dims)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    centroids = first_centroids(vectors, k, scale)
    chunks = encode(vectors, dims, scale, width, most)
    if centroids:
        for _ in range(rounds):
            centroids = moved(chunks, centroids, width, dims, scale)
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(centroids, width, scale)
        for chunk in _chunks(parts, width, dims):
            found, distance, _ = assigner.nearest(chunk)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.ids, pa.int64()), pa.array(found.astype(np.int32)),
                 pa.array([d if d <= LONG else None for d in distance.tolist()], pa.int64())], schema=schema)

    assigned = saved(chunks.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    # One row per cluster: k rows at most, whatever the table.
    wide = F.max(F.col("distance").isNull())
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    stats = assigned.groupBy("cluster").agg(F.when(~wide, total).alias("total")).collect()
    whole_sum = None if any(r.total is None for r in stats) else sum(int(r.total) for r in stats)
    facts = [(r.cluster, _long(r.total), _long(whole_sum),
              hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in stats]
    by_cluster = embeddings.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(by_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(value) -> int | None:
    return int(value) if value is not None and int(value) <= LONG else None
