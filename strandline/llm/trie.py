"""Prefix trie of rebuilt conversations (12) by smallest-member ownership.

A node is a distinct sequence of first turns. It is owned by its smallest member; as the members of a deeper node are
among those of the nodes above, each conversation owns a suffix of its path. So no subtree is walked: what a node's
subtree sums is a sum over its members, of what each has from there on, less what each owns from there on. Windows over
a conversation's turns make running sums of its tokens and its prefix keys; each node's smallest member marks where a
conversation's owned suffix begins; and one grouping by prefix sums tokens that aren't owned, owned leaves and owned
children.

A prefix key is the exclusive or of two 64-bit hashes of (depth, role, text) of its turns. One sort by conversation and
turn, dealt by ranges, orders turns, so a conversation of very many turns lies in several parts, each with sums of its
own; nodes and conversations that many rows share are joined by broadcast of their one row. The ids that end at a node
are joined in order, piece by piece, and hashed as a stream.

Turns are ordered by turn, null first, then role, then text; null role or text is empty; repeated rows are repeated
turns. Rows without conv_id take no part. No conversations make no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import keyed_join, materialize, table

#: A conversation takes less than HEADS turns of the first of its FAMILY.
HEADS, FAMILY = 6, 100
#: Ids of one node that are joined to one piece at most.
PIECE_IDS = 1 << 16
_NODE = ["p1", "p2", "depth"]
_BLOCK = ["conv_id", "part"]


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, pos, k1, k2, n): turns with their place, from 0, in their conversation; part is the range of the
    whole order that they lie in."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("at"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("at")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    hashed = ordered.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "role").alias("k2"), F.length("text").cast("long").alias("n"))
    hashed = materialize(hashed)
    parts = hashed.groupBy(*_BLOCK).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return hashed.join(parts.select(*_BLOCK, "first", before.alias("before")), _BLOCK).select(*_BLOCK, (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "k1", "k2", "n")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (conv_id, turns, part), and their turns (conv_id, turns, part, depth, k1, k2, n)."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"), F.min("part").alias("part"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = sizes.select("conv_id", "size", "part", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    shared = F.least("taken", F.coalesce("base_size", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("shared", shared)
    convs = materialize(convs.withColumn("turns", F.col("shared") + F.greatest(F.col("size") - F.col("taken"), F.lit(0))))
    heads = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), (F.col("pos") + 1).alias("depth"), "k1", "k2", "n")
    cols = ["conv_id", "turns", "part", "depth", "k1", "k2", "n"]
    first = convs.where("shared > 0").join(heads, "base").where(F.col("depth") <= F.col("shared")).select(*cols)
    own = keyed_join(turns, convs.select("conv_id", "taken", "shared", "turns", F.col("size").alias("count")), ["conv_id"], turns.count())
    own = own.where(F.col("pos") >= F.col("taken")).withColumn("depth", F.col("pos") - F.col("taken") + F.col("shared") + 1).select(*cols)
    return convs, first.unionByName(own)


def _prefixes(turns: DataFrame) -> DataFrame:
    """turns with the key of the prefix that they end (p1, p2) and its code points (cum): running values within a block
    on top of those of the conversation's blocks before."""
    x = {"x1": F.xxhash64("depth", "k1", "k2"), "x2": F.xxhash64("k2", "k1", "depth")}
    rows = turns.withColumns(x).drop("k1", "k2")
    inner = Window.partitionBy(*_BLOCK).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"p1": F.bit_xor("x1").over(inner), "p2": F.bit_xor("x2").over(inner), "cum": F.sum("n").over(inner)})
    blocks = turns.withColumns(x).groupBy(*_BLOCK).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n").alias("n"))
    outer = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    blocks = blocks.select(*_BLOCK, zero(F.bit_xor("x1").over(outer)).alias("b1"), zero(F.bit_xor("x2").over(outer)).alias("b2"), zero(F.sum("n").over(outer)).alias("before"))
    both = rows.join(blocks, _BLOCK)
    return both.select("conv_id", "turns", "depth", F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("b2")).alias("p2"), "n", (F.col("cum") + F.col("before")).alias("cum"))


def _id_pieces(size: int):
    """Ids of one node after one another, joined by commas, `size` at most, from rows sorted by node and id."""

    def run(batches):
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in range(3)]
            ids = batch.column(3).to_numpy()
            if not len(ids):
                continue
            new = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], 0))))
            begins = [b for low, high in zip(new, [*new[1:], len(ids)], strict=True) for b in range(low, high, size)]
            joined = [",".join(map(str, ids[b:e].tolist())) for b, e in zip(begins, [*begins[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[begins]) for k in key), pa.array(ids[begins]), pa.array(joined)], [*_NODE, "first", "joined"])

    return run


def _digests(batches):
    """The SHA-256 of each node's pieces, from rows sorted by node and first id; a digest holds none of them."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *node, _, joined in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(joined.encode())
        yield _digest_batch(out)
    if key is not None:
        yield _digest_batch([(*key, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()], strict=True)], [*_NODE, "ends_sha256"])


def _ends(rows: DataFrame, piece_ids: int) -> DataFrame:
    """(node, ends_sha256) of nodes at which conversations end: ids are dealt by ranges, so those of one node are joined
    in several tasks; only the pieces meet."""
    order = [*_NODE, "conv_id"]
    ends = rows.where("depth = turns").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ends.mapInArrow(_id_pieces(piece_ids), "p1 long, p2 long, depth long, first long, joined string")
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_digests, "p1 long, p2 long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """A row per node of the trie of conversations (conv_id, turn, role, text): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = _rebuilt(materialize(_numbered(conversations)))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", "turns", *(zero.alias(c) for c in ("depth", "p1", "p2", "n", "cum")))
    rows = materialize(_prefixes(materialize(turns)).unionByName(roots).withColumn("depth", F.col("depth").cast("long")))
    total = rows.count()

    nodes = materialize(rows.groupBy(*_NODE).agg(F.min("conv_id").alias("owner"), F.max("turns").alias("deepest"), F.count("*").alias("count")))
    held = keyed_join(rows, nodes, _NODE, total)
    owns = F.col("owner") == F.col("conv_id")
    leaf = owns & (F.col("depth") == F.col("turns")) & (F.col("deepest") == F.col("turns"))
    paths = held.groupBy("conv_id").agg(
        F.min(F.when(owns, F.col("depth"))).alias("own_from"), F.coalesce(F.max(F.when(~owns, F.col("cum"))), zero).alias("not_owned"),
        F.max(F.when(~owns, F.struct("depth", "owner")))["owner"].alias("above"), F.max(leaf).cast("long").alias("leaf"), F.count("*").alias("count"))
    rows = keyed_join(rows, materialize(paths), ["conv_id"], total)
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("own_from"), F.col("conv_id")).otherwise(F.col("above"))
    child = F.coalesce((F.col("own_from") <= F.col("depth") + 1) & (F.col("depth") < F.col("turns")), F.lit(False))
    trie = rows.groupBy(*_NODE).agg(
        F.min(F.struct("conv_id", parent.alias("parent"))).alias("owner"), F.count("*").alias("n_convs"), F.sum(child.cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("not_owned") - F.col("cum") + F.col("n"), zero)).alias("saved_tokens"))
    out = trie.join(_ends(rows, piece_ids), _NODE, "left")
    return out.select("owner.conv_id", "depth", F.col("owner.parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list({'r': r, 't': t} ORDER BY pos) AS l FROM t GROUP BY conv_id),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS step, CAST(4294967295 AS BIGINT) AS c FROM lists
  UNION ALL
  SELECT conv_id, s, step + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)
  FROM (SELECT conv_id, s, step, CASE WHEN step % 8 = 0 THEN xor(c, CAST(ascii(substr(s, step // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE step < 8 * length(s))),
taken AS (SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 6 AS h FROM crc WHERE step = 8 * length(s)),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.l[1:taken.h], []), a.l[taken.h + 1:]) AS l
  FROM lists a JOIN taken ON taken.conv_id = a.conv_id LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 100),
paths AS (SELECT conv_id, len(l) AS turns, d, l[1:d] AS p, CASE WHEN d = 0 THEN 0 ELSE length(l[d].t) END AS n FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
nodes AS (
  SELECT p, d, min(conv_id) AS owner, count(*) AS n_convs, max(turns) AS deepest, max(n) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends
  FROM paths GROUP BY p, d),
sums AS (
  SELECT a.p, a.d, sum((x.n_convs - 1) * x.n) AS saved, count(*) FILTER (x.deepest = x.d) AS leaves, count(*) FILTER (x.d = a.d + 1) AS children
  FROM nodes x JOIN paths a ON a.conv_id = x.owner AND a.d <= x.d GROUP BY a.p, a.d)
SELECT y.owner AS conv_id, y.d AS depth, u.owner AS parent_conv_id, y.n_convs, sums.children AS n_children, sums.leaves AS n_leaves,
  CAST(sums.saved AS BIGINT) AS saved_tokens, y.ends AS ends_sha256
FROM nodes y JOIN sums ON sums.p = y.p AND sums.d = y.d LEFT JOIN nodes u ON u.d = y.d - 1 AND y.d > 0 AND u.p = y.p[1:y.d - 1]
"""
