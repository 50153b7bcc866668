"""Near-duplicate documents: b-bit MinHash for candidates, full shingle sets for the decision.

A document's distinct word shingles are hashed to 64 bits.  Documents with equal sets are one class; only its
smallest document goes on.  Bands of full minima make buckets; of the minima themselves only the low two bits are
kept, packed into four longs.  In every bucket each member is compared with the bucket's smallest document.  A
comparison first estimates the similarity from the count of equal two-bit fields, corrected for those that agree by
chance, and is dropped only when it lies far below the threshold; the rest are decided on the full sets.  Linked
documents are then contracted.

Buckets that still hold several components hold texts near the threshold, mostly below it.  There a shingle is called
rare if at most ``rare`` of these texts hold it.  A pair either shares a rare shingle, and is found through it, in a
number of pairs bounded by ``rare`` per shingle; or its intersection lies within the other shingles of both, which
bounds the similarity by their numbers: a member whose bound lies below the threshold for every size in its bucket
meets nobody, and the rest meet in salted blocks under the bound of the pair.  Both ways are exact, so no pair that
shares a bucket and could change a component is left out, and no group is expanded into all its pairs.

With the defaults a pair at the threshold shares no bucket with probability (1 - 0.8^4)^28, under one in a million.

Defined results: a text without words has an empty set and is linked with nothing; a document without an id is
linked with nothing, its component is null and it is kept; rows that share an id are one node with several sets;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import batches, saved

LANES = 112  # two-bit fields in four longs, 28 of them in each
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashed shingle sets; ids of words are remembered up to a limit."""

    def __init__(self, width: int, limit: int = 300_000):
        self.width, self.limit = width, limit
        self.known: dict[bytes, int] = {}

    def _id(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            if len(self.known) < self.limit:
                self.known[word] = found
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        ids = np.fromiter(map(self._id, words), np.uint64, len(words))
        n = min(self.width, len(ids))
        out = np.full(len(ids) - n + 1, n, np.uint64)
        for i in range(n):
            out = _mixed(out * _STEP + ids[i:len(ids) - n + 1 + i])
        return np.unique(out)


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP + np.uint64(seed)) | np.uint64(1)


def minima(hashes: np.ndarray, factors: np.ndarray, block: int = 1024) -> np.ndarray:
    """32-bit minima of a set under each factor."""
    best = np.full(len(factors), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(hashes), block):
        part = (hashes[at:at + block, None] * factors[None]) >> np.uint64(32)
        np.minimum(best, part.min(axis=0), out=best)
    return best


def packed(low: np.ndarray) -> list[int]:
    """Two low bits of each minimum, 28 fields to a long."""
    low = low.reshape(4, 28) & np.uint64(3)
    longs = (low << (np.uint64(2) * np.arange(28, dtype=np.uint64))[None]).sum(axis=1, dtype=np.uint64)
    return longs.astype(np.int64).tolist()


def signatures(documents: DataFrame, width: int, rows: int) -> DataFrame:
    """``doc_id, n, set_key, s0..s3, bands`` for every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()),
                        *((f"s{i}", pa.int64()) for i in range(4)), ("bands", pa.list_(pa.int64()))])

    def run(parts):
        shingles, factors = Shingles(width), constants(11, LANES)
        salts = constants(12, LANES // rows)

        def out():
            for part in parts:
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    hashes = shingles(text.as_py())
                    if not len(hashes):
                        yield doc, 0, None, None, None, None, None, None
                        continue
                    low = minima(hashes, factors)
                    bands = salts.copy()
                    for column in low.reshape(-1, rows).T:
                        bands = _mixed(bands * _STEP + column)
                    yield (doc, len(hashes), hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), *packed(low),
                           bands.astype(np.int64).tolist())

        yield from batches(out(), schema, 5_000)

    return saved(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, set_key binary, s0 long, s1 long, s2 long, s3 long, bands array<long>"), "signatures")


def estimate(a: str, b: str) -> Column:
    """Similarity from the share of equal two-bit fields, of which a quarter agree by chance."""
    differ = None
    for i in range(4):
        x = F.expr(f"{a}.s{i} ^ {b}.s{i}")
        lanes = F.bit_count((x.bitwiseOR(F.shiftright(x, 1))).bitwiseAND(F.lit(0x55555555555555)))
        differ = lanes if differ is None else differ + lanes
    return ((1 - differ / LANES) - 0.25) / 0.75


def possible(a: str, b: str, percent: int, margin: float) -> Column:
    """Neither the sizes of the sets nor the estimate rule the link out."""
    smaller, larger = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * smaller >= percent * larger) & (estimate(a, b) >= percent / 100 - margin)


def shingle_sets(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc, hashes`` of the documents whose ids are given."""

    def run(parts):
        shingles = Shingles(width)
        schema = pa.schema([("doc", pa.int64()), ("hashes", pa.list_(pa.int64()))])
        yield from batches(((doc, shingles(text.as_py()).astype(np.int64)) for part in parts
                            for doc, text in zip(part.column(0).to_pylist(), part.column(1))), schema, 1_000)

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).join(
        ids.hint("shuffle_hash"), "doc", "left_semi")
    return saved(chosen.mapInArrow(run, "doc long, hashes array<long>"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of which some sets have ``100 * intersection >= percent * union``."""
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return saved(both.where(100 * common >= percent * union).select("a", "b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """``doc, component``: the smallest document reachable, by alternating star contractions.

    Each turn ties every node to the smallest one near it, first its larger neighbours, then itself and its smaller
    ones.  The links only move downwards, and what is left is a star around each smallest document.
    """
    def star(edges: DataFrame, larger: bool) -> DataFrame:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
        least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        tied = ends.join(least, "a")
        if larger:
            out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return out.where("a > b").distinct()

    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = saved(edges, "stars")
    before = None
    while True:
        edges = saved(star(star(edges, True), False), "stars")
        # A fixed point has the same links; their number and a sum of hashes tell.
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            return edges.toDF("doc", "component")
        before = now


def shared_rare(sets: DataFrame, rare: int) -> tuple[DataFrame, DataFrame]:
    """Per document ``rep, core``: how many of its shingles more than ``rare`` of the documents hold; and all pairs
    ``a > b`` of documents that share one of the others.  An id with several sets is not bounded: all it has is core."""
    held = sets.select(F.col("doc").alias("rep"), F.explode("hashes").alias("h"))
    few = held.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= rare)
    rarely = saved(held.join(few, "h"), "rare")
    sizes = sets.groupBy(F.col("doc").alias("rep")).agg(F.max(F.size("hashes")).alias("n"), F.count(F.lit(1)).alias("sets"))
    own = F.when(F.col("sets") == 1, F.coalesce("rare", F.lit(0))).otherwise(0)
    core = sizes.join(rarely.groupBy("rep").agg(F.count(F.lit(1)).alias("rare")), "rep", "left").select(
        "rep", (F.col("n") - own).alias("core"))
    twice = rarely.where("df > 1").select("h", "rep")
    pairs = twice.withColumnRenamed("rep", "a").join(twice.withColumnRenamed("rep", "b"), "h").where("a > b")
    return core, pairs.select("a", "b").distinct()


def link_documents(documents: DataFrame, width: int = 2, percent: int = 80, rows: int = 4, margin: float = 0.3,
                   block: int = 256, rare: int = 32) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``."""
    every = signatures(documents, width, rows)
    known = every.where("doc_id is not null and n > 0")
    first = F.min_by(F.struct("n", "s0", "s1", "s2", "s3", "bands"), "doc_id")
    reps = saved(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), first.alias("x"))
                 .select("set_key", "rep", "x.*"), "classes")
    copies = known.join(reps.select("set_key", "rep"), "set_key").where("doc_id > rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    members = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last"),
                                           F.count(F.lit(1)).alias("size")).where("pivot < last")
    members = saved(members.join(shared.select("bucket", "pivot", "size"), "bucket"), "buckets")
    facts = reps.select("rep", "n", "s0", "s1", "s2", "s3", "bands")

    def with_facts(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(facts.select(F.col("rep").alias(end), F.struct("n", "s0", "s1", "s2", "s3").alias(f"f{end}")), end)
        return pairs.where(possible("fa", "fb", percent, margin))

    pairs = saved(with_facts(members.where("rep > pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
                             .distinct()).select("a", "b"), "pairs")
    sets = shingle_sets(documents, pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), width)
    links = confirmed(pairs, sets, percent)
    tied = components(links)

    # Buckets that hold more than one component: links between these are still to be found.
    label = F.coalesce(F.col("component"), F.col("rep"))
    members = members.join(tied.withColumnRenamed("doc", "rep"), "rep", "left").withColumn("component", label)
    members = members.join(facts, "rep")
    open_buckets = members.groupBy("bucket").agg(
        F.min_by("component", "rep").alias("first"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("n").alias("least_n"),
    ).where("low < high").select("bucket", "first", "least_n")
    members = saved(members.join(open_buckets, "bucket"), "open")
    sets = shingle_sets(documents, members.select(F.col("rep").alias("doc")).distinct(), width)
    core, sharing = shared_rare(sets, rare)

    nodes = saved(members.select("rep", "component", "n", "s0", "s1", "s2", "s3").distinct(), "open-nodes")
    ends = [nodes.select(F.col("rep").alias(e), F.struct("component", "n", "s0", "s1", "s2", "s3").alias(f"f{e}")) for e in "ab"]
    by_rare = sharing.join(ends[0], "a").join(ends[1], "b").where(
        (F.col("fa.component") != F.col("fb.component")) & possible("fa", "fb", percent, margin)).select("a", "b")

    # All that a member without rare shingles in common can share with another is its core.
    live = members.join(core, "rep").where((100 + percent) * F.col("core") >= percent * (F.col("n") + F.col("least_n")))
    node = F.struct("rep", "component", "n", "core", "s0", "s1", "s2", "s3", "bands")
    blocks = F.ceil(F.col("size") / block).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = live.select("bucket", "first", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("own"), node.alias("node"))
    left = dealt.where("node.component <> first").select(
        "bucket", F.col("own").alias("i"), every_block.alias("j"), F.col("node").alias("p"))
    right = dealt.select("bucket", "first", every_block.alias("i"), F.col("own").alias("j"), F.col("node").alias("q"))
    other = F.col("p.component") != F.col("q.component")
    # Of two members outside the first component one order is enough.
    once = (F.col("q.rep") < F.col("p.rep")) | (F.col("q.component") == F.col("first"))
    bounded = (100 + percent) * F.least("p.core", "q.core") >= percent * (F.col("p.n") + F.col("q.n"))
    # A pair that shares several buckets, all of them open, is made in the first of these only.
    first_shared = F.array_intersect("p.bands", "q.bands")[0] == F.col("bucket")
    near = possible("p", "q", percent, margin)
    by_core = left.join(right, ["bucket", "i", "j"]).where(other & once & bounded & near & first_shared).select(
        F.greatest("p.rep", "q.rep").alias("a"), F.least("p.rep", "q.rep").alias("b"))
    more = saved(by_rare.unionByName(by_core).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        links = links.unionByName(confirmed(more, sets, percent))
    reached = components(links.unionByName(copies))
    out = every.join(reached.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
