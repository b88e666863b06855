"""Helpers shared by the operators: scratch tables, arrow batches, hashing, components."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.scalar import kept as materialize
from strandline.operators.scalar import shared_folder as scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """df, its session set to Arrow batches of BATCH_ROWS rows at most: Spark's own bound counts rows, not bytes, and
    ten thousand long texts at once in each task are too much for a small executor."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def give_back() -> None:
    """Hands memory that a worker no longer uses back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


#: What operators remember in a worker between tasks, by operator, and how to forget it.
remembered: dict[str, Callable[[], None]] = {}


def text_chunks(batches: Iterator[pa.RecordBatch], size: int = 1 << 20, operator: str = "") -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about `size` characters each from batches of (id, text); null texts are empty. What other
    operators than this one have remembered in the worker is forgotten."""
    for other in [o for o in remembered if o != operator]:
        remembered.pop(other)()
    ids: list = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for at in range(0, len(batch), 256):  # so that not all of a batch is held twice
            part = batch.slice(at, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or "")
                held += len(texts[-1])
                if held >= size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts
    del ids, texts
    give_back()


# ------------------------------------------------------------------ vectorised words
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n; a worker keeps its longest tables."""
    if not _tables or len(_tables[0]) < n:
        made = []
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            power = np.full(n + n // 8, base, np.uint64)
            power[0] = 1
            made.append(np.cumprod(power, out=power))
        _tables[:] = made
    return _tables


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Words:
    """White-space words of a chunk of texts, A-Z lower-cased: `hash` (64 bits), `last` (hash of the last two bytes)
    and `first[k]:first[k+1]`, the words of text k."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        a = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        space = _SPACE[a]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        up, down = _powers(len(a))
        with np.errstate(over="ignore"):
            total = np.zeros(len(a) + 1, np.uint64)
            total[1:] = a
            total[1:] += np.uint64(1)
            total[1:] *= up[: len(a)]
            np.cumsum(total, out=total)
            self.hash = mix((total[end] - total[start]) * down[start])
        tail = a[end - 1].astype(np.int64) * 257
        two = end - start > 1
        tail[two] += a[end[two] - 2]
        self.last = tail
        offset = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
        self.first = np.searchsorted(start, offset)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-word shingles, as sorted 64-bit hashes; fewer words than n make one shingle, no words none."""
    if not len(words):
        return words
    n = min(n, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + words[k : len(words) - n + 1 + k])
    return np.unique(h)


class HashIndex:
    """Where 64-bit hashes stand in an ascending array of them."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(1, int(len(known)).bit_length() - 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(known >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.first).max()) if len(known) else 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The index of each hash, -1 where it is unknown."""
        out = np.full(len(hashes), -1, np.int64)
        bucket = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        rest = np.flatnonzero(at < end)
        at, end, want = at[rest], end[rest], hashes[rest]
        for _ in range(self.longest):
            if not len(rest):
                break
            hit = self.known[at] == want
            out[rest[hit]] = at[hit]
            go = ~hit & (at + 1 < end)
            rest, at, end, want = rest[go], at[go] + 1, end[go], want[go]
        return out


# ------------------------------------------------------------------ grouped streaming
def by_group(keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """A mapInArrow function over batches sorted by `keys` that calls fn with the whole rows of each key."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
            rows = list(zip(*cols, strict=True))
            at = 0
            for i, r in enumerate(rows):
                if r != key:
                    if i > at:
                        held.append(batch.slice(at, i - at))
                    if held:
                        yield from fn(pa.Table.from_batches(held))
                    held, key, at = [], r, i
            if len(rows) > at:
                held.append(batch.slice(at))
        if held:
            yield from fn(pa.Table.from_batches(held))
        held = []
        give_back()

    return run


def map_groups(df: DataFrame, keys: list[str], fn, schema: str, order: list[str] | None = None) -> DataFrame:
    """Like applyInArrow, without its cost for each of many small groups. A group must fit in memory."""
    spread = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))
    return spread.mapInArrow(by_group(keys, fn), schema)


# ------------------------------------------------------------------ connected components
def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) with the same components as the edges a-b."""
    ids, inv = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(ids))
    while True:
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        new = root.copy()
        np.minimum.at(new, rx, low)
        np.minimum.at(new, ry, low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(ids))
    return ids[keep], ids[root[keep]]


#: Edges that a task holds at once, and edges that are few enough for one task to unite them all, however many rounds they
#: would take: some megabytes.
FOREST_EDGES, LAST_EDGES = 1 << 22, 1 << 18


def _local_forest(batches):
    held, n = [], 0

    def flush():
        x, y = forest(*(np.concatenate(c).astype(np.int64) for c in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]])
        n += len(batch)
        if n >= FOREST_EDGES:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


#: Rows of one key that a join leaves in one task, and the share of all rows from which a key counts as hot.
HOT_ROWS, HOT_SHARE = 1024, 1000


def hot_count(rows: int) -> int:
    return max(HOT_ROWS, rows // HOT_SHARE)


def keyed_join(rows: DataFrame, per_key: DataFrame, keys: list[str], total: int, count: str = "count") -> DataFrame:
    """rows joined with per_key, which has a row per key with the number of its rows, of `total` in all: hot keys, of which
    there are max(1, HOT_SHARE) at most, are broadcast, so that their rows stay where they are, all others shuffled.
    Both frames are read twice."""
    is_hot = F.col(count) > hot_count(total)
    hot = per_key.where(is_hot).drop(count)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(per_key.where(~is_hot).drop(count), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable over edges (a, b); only nodes with a link to
    another node are listed. Large-star and small-star rounds until LAST_EDGES or fewer are left, each written to the shared folder; a node's neighbours
    are never gathered: their minimum is aggregated and joined back, a hub's by broadcast, so that its rows stay spread."""
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    e = materialize(e.mapInArrow(_local_forest, "a long, b long").where("a <> b").distinct())
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            break
        if mark["n"] <= LAST_EDGES:
            e = materialize(e.repartition(1).mapInArrow(_local_forest, "a long, b long"))
            break
        seen = mark
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("count")).select("a", F.least("a", "m").alias("m"), "count"))
        large = keyed_join(both.where("b > a"), low, ["a"], 2 * mark["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = materialize(large.where("a <> b").distinct())
        low = materialize(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("count")))
        small = keyed_join(down, low, ["a"], mark["n"]).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = materialize(small.where("a <> b").distinct().mapInArrow(_local_forest, "a long, b long").distinct())
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
