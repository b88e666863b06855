"""Hard-negative mining (11): exact integer top lists by an orthogonal PCA rotation.

Vectors become integers, floor(256 * x). A rotation fitted on a sample of each length's vectors turns them so that leading
components hold most of a product. Anchors and rows are dealt to blocks, and every block of anchors meets every block of
rows of its length once per search. There, products of leading components are summed step by step: what is left of a
product is bounded by the norms of what is left of both vectors, plus slack for rounding. A pair whose bound falls below
the anchor's worst row so far, or whose range of products misses the wanted one, is dropped; products of the survivors are
taken anew in integers, and only these are ranked. Whatever the rotation, no row that belongs to a list is lost.

The first search finds an anchor's positives, the second the rows of other labels in the ranges that they set. Each task
keeps no more than a list per range, and lists of an anchor's tasks are merged in order.

Rows with a null vec_id, label or vector, or a null or non-finite component, take no part, nor do vectors whose integer
squares sum to 2^62 or more, as their products don't fit a long. Vectors of different lengths have no product. Equal rows
are one; several vectors of one vec_id are rows of their own, but none is a positive of another. Anchors without positives
and positives without negatives give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.ann import _matrix
from strandline.llm.common import keyed_join, map_groups, materialize, table

POSITIVES, NEGATIVES, EVERY, SCALE = 5, 10, 100, 256
#: Percent of a positive's score that a negative's must reach, and must not exceed.
LOWEST, HIGHEST = 30, 90
#: Rows and anchors of a block, and vectors of each length that the rotation is fitted on.
ROWS, ANCHORS, SAMPLE = 8192, 1024, 4096
#: Components of the first step; each step doubles their number. Rows that are compared at once, at first and at most.
LEADING, FIRST_ROWS, MOST_ROWS = 8, 32, 2048
#: Pairs whose vectors are gathered at once.
PAIRS = 1 << 16
_NONE, _ALL = -(1 << 62), 1 << 62


def fitted(z: np.ndarray) -> np.ndarray:
    """The orthogonal matrix onto the principal directions of z (about the origin, as products aren't centred), widest
    first."""
    x = z.astype(np.float64)
    x /= max(1.0, float(np.abs(x).max(initial=0)))
    _, directions = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(directions[:, ::-1])


class Rotated:
    """Integer vectors, their rotated components as 32-bit floats, and the norms of what follows each step's components."""

    def __init__(self, z: np.ndarray, rotation: np.ndarray):
        self.z = z
        y = z.astype(np.float64) @ rotation
        d = z.shape[1]
        self.steps = [s for s in (LEADING << k for k in range(d.bit_length())) if s < d] + [d]
        left = np.concatenate((np.cumsum((y * y)[:, ::-1], 1)[:, ::-1], np.zeros((len(y), 1))), 1)
        # a little more than the norms, so that rounding to 32 bits doesn't lower them
        self.rest = {s: (np.sqrt(left[:, s]) * (1 + 1e-6)).astype(np.float32) for s in self.steps}
        self.norm = (np.sqrt(left[:, 0]) * (1 + 1e-6)).astype(np.float32)
        self.y = y.astype(np.float32)

    def slack(self) -> float:
        """Most of what rounding adds to a product, as a share of both norms' product."""
        return (self.z.shape[1] + 8) * 2.0**-22


def survivors(a: Rotated, b: Rotated, rows: slice, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, product) of allowed pairs of a's vectors and b's `rows` whose product can be within least[i] and most[i];
    products are exact."""
    first, slack = a.steps[0], a.slack()
    part = a.y[:, :first] @ b.y[rows, :first].T
    reach = a.rest[first][:, None] * b.rest[first][rows] + slack * (a.norm[:, None] * b.norm[rows])
    i, j = np.nonzero(allowed & (part + reach >= least[:, None]) & (part - reach <= most[:, None]))
    part, j = part[i, j], j + rows.start
    out = []
    for at in range(0, len(i), PAIRS):
        x, y, p = i[at : at + PAIRS], j[at : at + PAIRS], part[at : at + PAIRS]
        for low, high in zip(a.steps, a.steps[1:]):
            p = p + np.einsum("nd,nd->n", a.y[x, low:high], b.y[y, low:high])
            reach = a.rest[high][x] * b.rest[high][y] + slack * a.norm[x] * b.norm[y]
            can = (p + reach >= least[x]) & (p - reach <= most[x])
            x, y, p = x[can], y[can], p[can]
        out.append((x, y, np.einsum("nd,nd->n", a.z[x], b.z[y])))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (i, j, np.zeros(0, np.int64))


class Lists:
    """The first `size` rows of each target: highest score first, then smallest vec_id, then smallest node."""

    def __init__(self, targets: int, size: int):
        self.size, self.rows, self.last = size, np.zeros((4, 0), np.int64), np.full(targets, _NONE)

    def add(self, target: np.ndarray, score: np.ndarray, vec: np.ndarray, node: np.ndarray) -> None:
        if not len(target):
            return
        rows = np.concatenate((self.rows, np.stack((target, score, vec, node))), 1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        begin = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        rank = np.arange(rows.shape[1]) - np.repeat(begin, np.diff([*begin, rows.shape[1]]))
        self.rows = rows[:, rank < self.size]
        self.last[rows[0, rank == self.size - 1]] = rows[1, rank == self.size - 1]


def mined(a: Rotated, b: Rotated, a_labels, b_labels, a_vecs, b_vecs, b_nodes, owner: np.ndarray, low: np.ndarray, high: np.ndarray, size: int, same: bool) -> np.ndarray:
    """(target, score, vec_id, node) lists of the targets: owner is the number of a target's anchor; scores lie within
    low and high. Rows are of the anchor's label and other ids where `same`, of other labels otherwise."""
    lists, at, width = Lists(len(owner), size), 0, FIRST_ROWS
    by_anchor = np.argsort(owner, kind="stable")
    begin = np.searchsorted(owner[by_anchor], np.arange(len(a.z) + 1))
    count = np.diff(begin)
    most = np.full(len(a.z), float(_NONE))
    np.maximum.at(most, owner, high.astype(np.float64))
    while at < len(b.z):
        rows = slice(at, min(at + width, len(b.z)))
        least = np.full(len(a.z), float(_ALL) * 2)
        np.minimum.at(least, owner, np.maximum(low, lists.last).astype(np.float64))
        equal = a_labels[:, None] == b_labels[rows]
        allowed = equal & (a_vecs[:, None] != b_vecs[rows]) if same else ~equal
        i, j, score = survivors(a, b, rows, allowed, least, most)
        n = count[i]
        pair = np.repeat(np.arange(len(i)), n)
        target = by_anchor[np.repeat(begin[i], n) + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)]
        i, j, score = i[pair], j[pair], score[pair]
        within = (score >= np.maximum(low, lists.last)[target]) & (score <= high[target])
        lists.add(target[within], score[within], b_vecs[j[within]], b_nodes[j[within]])
        at, width = rows.stop, min(2 * width, MOST_ROWS)
    return lists.rows


_TARGET = "struct<no:int,id:long,score:long>"
_FOUND = "anchor long, anchor_id long, no int, positive_id long, positive_score long, score long, vec_id long, node long"


def _search(size: int, same: bool):
    """Of a group's rows by side: the rotation, the block of anchors, the block of rows."""

    def run(group: pa.Table) -> Iterator[pa.RecordBatch]:
        side = group["side"].to_numpy()
        cut = np.searchsorted(side, [0, 1, 2, 3])
        if np.diff(cut).min() == 0:
            return
        anchors, rows = group.slice(cut[1], cut[2] - cut[1]), group.slice(cut[2])
        d = group["dim"][0].as_py()
        rotation = np.frombuffer(group["rotation"][0].as_py(), np.float64).reshape(d, d)
        a, b = (Rotated(_matrix(t["vector"], np.int64), rotation) for t in (anchors, rows))
        column = lambda t, c: t[c].to_numpy()
        targets = [(k, t["no"], t["id"], t["score"]) for k, ts in enumerate(anchors["targets"].to_pylist()) for t in ts]
        if not targets:
            return
        owner, no, ids, scores = zip(*targets, strict=True)
        low = np.array([_NONE if s is None else -(-LOWEST * s // 100) for s in scores])
        high = np.array([_ALL if s is None else HIGHEST * s // 100 for s in scores])
        t, score, vec, node = mined(a, b, column(anchors, "label"), column(rows, "label"), column(anchors, "vec_id"), column(rows, "vec_id"), column(rows, "node"), np.array(owner), low, high, size, same)
        own = np.array(owner)[t]
        cols = [column(anchors, "node")[own], column(anchors, "vec_id")[own], [no[k] for k in t], [ids[k] for k in t], [scores[k] for k in t], score, vec, node]
        kinds = [pa.int32() if c == 2 else pa.int64() for c in range(8)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [f.split()[0] for f in _FOUND.split(", ")])

    return run


def _first(found: DataFrame, size: int) -> DataFrame:
    """Each target's first rows of all tasks' lists, with their rank."""
    order = Window.partitionBy("anchor", "no").orderBy(F.desc("score"), "vec_id", "node")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, vector) of the rows of vectors (vec_id, embedding, label) that take part."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) != float("inf")), F.lit(False)))
    squares = F.aggregate("x", F.lit(0.0), lambda s, e: s + F.pow(F.floor(e * SCALE).cast("double"), F.lit(2.0)))
    valid = base.where("vec_id is not null and label is not null and x is not null").where(finite).where(squares < float(1 << 62))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return valid.select("vec_id", moved.alias("label"), F.size("x").alias("dim"), F.transform("x", lambda e: F.floor(e * SCALE)).alias("vector"))


def hard_negatives(vectors: DataFrame, rows: int = ROWS, anchors: int = ANCHORS, sample: int = SAMPLE, every: int = EVERY) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label):
    for each anchor, a row whose vec_id `every` divides, and each of its positives, the hardest negatives."""
    whole = integer_vectors(vectors).where("dim > 0").distinct()
    nodes = materialize(whole.withColumn("node", F.monotonically_increasing_id()))
    is_anchor = F.col("vec_id") % every == 0
    sizes = nodes.groupBy("dim").agg(F.count("*").alias("count"), F.sum(is_anchor.cast("long")).alias("anchors")).where("anchors > 0")
    sizes = materialize(sizes.select("dim", "count", F.ceil(F.col("count") / rows).cast("int").alias("rs"), F.ceil(F.col("anchors") / anchors).cast("int").alias("as")))
    dealt = materialize(keyed_join(nodes, sizes, ["dim"], nodes.count()))
    # a task ranks its own rows before any meet, so the sample's ranking is of a few rows from each
    drawn = dealt.withColumn("drawn", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "node"))).where(F.col("drawn") <= sample)

    def fit(part: pa.Table) -> pa.Table:
        return pa.table([part["dim"][:1], pa.array([fitted(_matrix(part["vector"], np.int64)).tobytes()], pa.binary())], ["dim", "rotation"])

    rotations = materialize(drawn.select("dim", "vector").groupBy("dim").applyInArrow(fit, "dim int, rotation binary"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n)).cast("int")
    null = lambda kind: F.lit(None).cast(kind)
    cols = ["dim", "a", "r", "side", "node", "vec_id", "label", "vector", "targets", "rotation"]
    turn = rotations.join(sizes, "dim").withColumn("a", upto("as")).withColumn("r", upto("rs"))
    turn = turn.withColumns({"side": F.lit(0), "node": null("long"), "vec_id": null("long"), "label": null("long"), "vector": null("array<long>"), "targets": null(f"array<{_TARGET}>")}).select(*cols)
    searched = dealt.withColumns({"r": block("rs", 1), "a": upto("as"), "side": F.lit(2), "targets": null(f"array<{_TARGET}>"), "rotation": null("binary")}).select(*cols)
    asking = dealt.where(is_anchor)

    def found(asked: DataFrame, size: int, same: bool) -> DataFrame:
        asked = asked.withColumns({"a": block("as", 2), "r": upto("rs"), "side": F.lit(1), "rotation": null("binary")}).select(*cols)
        both = turn.unionByName(asked).unionByName(searched)
        return _first(map_groups(both, ["dim", "a", "r"], _search(size, same), _FOUND, ["side", "node"]), size)

    one = F.array(F.struct(F.lit(0).alias("no"), null("long").alias("id"), null("long").alias("score")))
    positives = materialize(found(asking.withColumn("targets", one), POSITIVES, True))
    targets = positives.groupBy(F.col("anchor").alias("node")).agg(F.collect_list(F.struct(F.col("rank").alias("no"), F.col("vec_id").alias("id"), "score")).alias("targets"))
    negatives = found(asking.join(targets, "node"), NEGATIVES, False)
    return negatives.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.z, b.z) AS BIGINT) AS s
  FROM v a JOIN v b ON len(a.z) = len(b.z) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT a, b, s FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
neg AS (
  SELECT pos.a, pos.b, pos.s AS ps, p.b AS n, p.s AS ns, row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) AS rank
  FROM pos JOIN p ON p.a = pos.a AND NOT p.same AND 30 * pos.s <= 100 * p.s AND 100 * p.s <= 90 * pos.s)
SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM neg WHERE rank <= 10
"""
