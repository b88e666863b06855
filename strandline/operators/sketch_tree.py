"""A pruning index of sketches: a tree whose nodes know what their subtree holds, as distinct hashes or as counts of a
counting filter that has as many buckets for each of its sequences on all levels.

Sequences are numbered in the order of their least hashes, so that similar ones are neighbours, and the node above number i
on level l is i // fanout^l. A level is the level below grouped by its nodes above and by key; a node's hashes or counts
are rows, never one value, so no task holds a large subtree. A search goes down level by level: a node is entered if what
it holds of a query reaches the wanted share. Both kinds never hold less than a sequence below them, so a pruned search
finds what a comparison with all finds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.scalar import kept, running_sums
from strandline.operators.sequences import HASHES

FANOUT, BUCKETS = 16, 4096


@dataclass(frozen=True)
class SketchTree:
    """levels[l]: (node, key, count), level 0 the sequences; names: (node, id). buckets: 0 for hashes themselves."""

    levels: tuple[DataFrame, ...]
    names: DataFrame
    fanout: int
    buckets: int


def _bucket(hash_: str, buckets: int, size: int) -> Column:
    """The bucket of a hash in a filter of `size` sequences: a filter has `buckets` for each of them, so that one of a large
    subtree is as sparse as one of a sequence."""
    return F.pmod(hash_, F.lit(min(buckets * size, HASHES)).cast("long"))


def _keys(rows: DataFrame, name: str, buckets: int, size: int = 1) -> DataFrame:
    """(name, key, count) of rows (name, sketch): hashes, or how many of them a bucket has."""
    hashes = rows.select(name, F.explode(F.array_distinct("sketch")).alias("h"))
    if not buckets:
        return hashes.select(name, F.col("h").alias("key"), F.lit(1).cast("long").alias("count"))
    return hashes.groupBy(name, _bucket("h", buckets, size).alias("key")).agg(F.count("*").alias("count"))


def build(sketches: DataFrame, fanout: int = FANOUT, buckets: int = 0) -> SketchTree:
    """The tree of sketches (id, sketch); null and empty sketches are left out, as they contain nothing."""
    if fanout < 2:
        raise ValueError("a node has two children at least")
    rows = sketches.where(F.size("sketch") > 0).select("id", "sketch", F.array_min("sketch").alias("least"), F.lit(1).cast("long").alias("one"))
    numbered = kept(running_sums(kept(rows), [F.asc("least"), F.asc("id")], node="one").select("node", "id", "sketch"))
    hashes = _keys(numbered, "node", 0)
    levels, n = [kept(_keys(numbered, "node", buckets))], numbered.count()
    while n > fanout:
        if buckets:  # counts of more buckets don't follow from those of fewer
            size = fanout ** len(levels)
            above = hashes.groupBy(F.expr(f"node div {size}").alias("node"), _bucket("key", buckets, size).alias("key"))
            levels.append(kept(above.agg(F.count("*").alias("count"))))
        else:
            levels.append(kept(levels[-1].groupBy(F.expr(f"node div {fanout}").alias("node"), "key").agg(F.max("count").alias("count"))))
        n = -(-n // fanout)
    return SketchTree(tuple(levels), numbered.select("node", "id", "sketch"), fanout, buckets)


def visited(tree: SketchTree, queries: DataFrame, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """((query, node) of the sequences that remain, the nodes (query, node) entered on each level, top first)."""
    sizes = queries.select("query", F.size(F.array_distinct("sketch")).alias("n"))
    same = None if tree.buckets else kept(_keys(queries.select("query", "sketch"), "query", 0).join(sizes, "query"))
    entered: list[DataFrame] = []
    for depth, level in reversed(list(enumerate(tree.levels))):
        asked = same or kept(_keys(queries.select("query", "sketch"), "query", tree.buckets, tree.fanout**depth).join(sizes, "query"))
        rows = level.select("node", "key", F.col("count").alias("held"))
        if entered:
            wanted = asked.join(entered[-1].withColumnRenamed("node", "above"), "query")
            both = wanted.join(rows.withColumn("above", F.expr(f"node div {tree.fanout}")), ["above", "key"])
        else:
            both = asked.join(rows, "key")
        shared = both.groupBy("query", "node", "n").agg(F.sum(F.least("count", "held")).alias("shared"))
        entered.append(kept(shared.where(F.col("shared") >= threshold * F.col("n")).select("query", "node")))
    return entered[-1], entered


def contained(tree: SketchTree, queries: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(query, id, shared, containment) of queries (query, sketch) of which a sequence of the tree holds `threshold` or more;
    empty queries are held by none, repeated ones once."""
    queries = kept(queries.where(F.size("sketch") > 0).select("query", "sketch").distinct())
    left, _ = visited(tree, queries, threshold)
    named = left.join(tree.names, "node").withColumnRenamed("sketch", "held").join(queries, "query")
    shared = F.size(F.array_intersect("sketch", "held"))
    rows = named.select("query", "id", shared.cast("long").alias("shared"), F.size(F.array_distinct("sketch")).alias("n"))
    return rows.where(F.col("shared") >= threshold * F.col("n")).select("query", "id", "shared", (F.col("shared") / F.col("n")).alias("containment"))
