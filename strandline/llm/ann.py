"""Embedding near-dedup (1): hierarchical navigable small-world graphs per shard.

Equal vectors of a label are one node. Nodes are dealt by hash into shards of one label (and one length). Each shard gets
a graph: every node has a level drawn from its id's hash; layers are filled by batches, each batch's vectors searching
the graph so far and comparing with one another, and keep their nearest neighbours that aren't nearer to a neighbour
already kept; parts of a layer that don't hang together are joined by their nearest nodes. Every shard's nodes then
search every shard of their label, QUERIES of them in a task: greedily through the upper layers, by a beam on the lowest.
A query whose whole beam qualifies searches again by a doubled one. A sample of a task's queries is audited against
brute force, all their partners counted. Where links are rare a sample has few partners, so PARTNERS queries more are
planted: vectors of the shard, turned by chance until they are as far away as a partner may be. While any partner of either
is missed, the beam doubles, and where BEAM_LIMIT doesn't find all of them either, or a shard has too few vectors to plant
from, all the task's queries are compared with the whole shard in blocks. `search_links` returns the audits.

What is found makes groups, and every pair of a group is verified by cosines in double precision, whichever shards it
lies in: groups are dealt by blocks of VERIFIED nodes. That also counts links that a search passed over. Links unite
into components.

Vectors that are null, empty, zero or hold null or non-finite components, and those without label or vec_id, link with
nothing; a null vec_id has a null component. Rows with one vec_id are one vector of the components, and n_links counts
the different other ids that any of them links with; each row gets a row. Labels may be of any type; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import by_group, components, forest, keyed_join, materialize, mix, table

SHARD, LINKS, BEAM, BUILD_BEAM, AUDITED, AUDIT_RECALL = 16_384, 12, 24, 24, 128, 1.0
#: Partners that an audit must have seen, planted ones among them, before a graph is trusted.
PARTNERS = 512
#: Queries of a task, the widest beam that is tried for all of them, nodes of a block, links that join parts of a layer.
QUERIES, BEAM_LIMIT, VERIFIED, BRIDGES = 8192, 192, 1024, 4
#: A beam this share of a shard's size isn't worth more than comparing the query with all of it.
WHOLE = 64


class Graph:
    """neighbours[layer]: rows of neighbour numbers, -1 where there is none; rows of the layer's nodes only are set."""

    def __init__(self, x: np.ndarray, keys: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM):
        self.x = x.astype(np.float32)
        u = (mix(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        level = np.minimum((-np.log(u + 1e-18) / np.log(links)).astype(int), 8)
        self.neighbours: list[np.ndarray] = []
        self.entry = int(level.argmax())
        for layer in range(int(level.max()) + 1):
            nodes = np.flatnonzero(level >= layer)
            self.neighbours.append(self._layer(nodes, links * (2 if layer == 0 else 1), beam))

    def _layer(self, nodes: np.ndarray, width: int, beam: int) -> np.ndarray:
        near = np.full((len(self.x), width), -1, np.int32)
        done = 1
        while done < len(nodes):
            batch = nodes[done : done + max(32, min(done, 2048))]
            found, sim = search(self.x, near, self.x[batch], np.full(len(batch), nodes[0]), beam)
            for b in range(0, len(batch), VERIFIED):  # the batch's own, which the graph doesn't hold yet
                own = self.x[batch[b : b + VERIFIED]] @ self.x[batch].T
                own[np.arange(len(own)), b + np.arange(len(own))] = -2
                top = np.argpartition(-own, min(beam, own.shape[1] - 1), 1)[:, :beam] if own.shape[1] > 1 else np.zeros((len(own), 0), int)
                s = np.take_along_axis(own, top, 1)
                both = np.concatenate((found[b : b + VERIFIED], np.where(s > -2, batch[top], -1)), 1)
                sims = np.concatenate((sim[b : b + VERIFIED], s), 1)
                near[batch[b : b + VERIFIED]] = self._chosen(both, sims, width // 2)
            self._back(near, batch, width)
            done += len(batch)
        return self._joined(near, nodes)

    def _joined(self, near: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """near with up to BRIDGES more links a node, between parts of the layer that weren't linked: in rounds, a part's
        first node and the nearest node outside the part."""
        bridges = np.full((len(near), BRIDGES), -1, np.int32)
        while True:
            both = np.concatenate((near, bridges), 1)
            rows, cols = np.nonzero(both[nodes] >= 0)
            part = np.arange(len(near))
            node, root = forest(nodes[rows].astype(np.int64), both[nodes][rows, cols].astype(np.int64))
            part[node] = root
            heads = np.unique(part[nodes])
            if len(heads) < 2:
                return both
            new = 0
            for h in heads[1:]:  # the first part is linked to by the others
                sims = self.x[nodes] @ self.x[h]
                sims[(part[nodes] == h) | (bridges[nodes] >= 0).all(1)] = -3
                to = nodes[int(sims.argmax())]
                free, back = np.flatnonzero(bridges[h] < 0), np.flatnonzero(bridges[to] < 0)
                if sims.max() > -3 and len(free):
                    bridges[h, free[0]] = to
                    bridges[to, back[0]] = h
                    new += 1
            if not new:
                return np.concatenate((near, bridges), 1)

    def _chosen(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, nearest first, those that aren't nearer to one already chosen; then the nearest of
        the rest."""
        order = np.argsort(-np.where(ids >= 0, sims, -3), 1, kind="stable")[:, : 2 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(ids, 0)]
        among = v @ v.transpose(0, 2, 1)
        take = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            crowded = (take & (among[:, k] > sims[:, k, None])).any(1)
            take[:, k] = (ids[:, k] >= 0) & ~crowded
        rank = np.argsort(np.where(ids < 0, 2, np.where(take, 0, 1)), 1, kind="stable")[:, :most]
        out = np.full((len(ids), 2 * most), -1, np.int32)
        out[:, : rank.shape[1]] = np.take_along_axis(ids, rank, 1)
        return out

    def _back(self, near: np.ndarray, batch: np.ndarray, width: int) -> None:
        """Links back from the batch's neighbours; a full row keeps the best of its old and new links."""
        rows, cols = np.nonzero(near[batch] >= 0)
        to, back = near[batch][rows, cols], batch[rows]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        most = min(int(count.max(initial=0)), 4 * width)
        slot = np.arange(len(to)) - np.repeat(first, count)
        new = np.full((len(targets), most), -1, np.int32)
        fits = slot < most
        new[np.repeat(np.arange(len(targets)), count)[fits], slot[fits]] = back[fits]
        for b in range(0, len(targets), VERIFIED):
            t = targets[b : b + VERIFIED]
            both = np.concatenate((near[t], new[b : b + VERIFIED]), 1)
            both = np.where((both[:, :, None] == both[:, None, :]).argmax(2) == np.arange(both.shape[1]), both, -1)  # once each
            sims = (self.x[np.maximum(both, 0)] @ self.x[t][:, :, None])[:, :, 0]
            full = (both >= 0).sum(1) > width
            keep = np.argsort(both < 0, 1, kind="stable")[:, :width]
            near[t] = np.take_along_axis(both, keep, 1)
            if full.any():
                chosen = np.full((int(full.sum()), width), -1, np.int32)
                got = self._chosen(both[full], sims[full], width)[:, :width]
                chosen[:, : got.shape[1]] = got
                near[t[full]] = chosen

    def find(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        q = queries.astype(np.float32)
        at = np.full(len(q), self.entry)
        for near in self.neighbours[:0:-1]:
            ids, sim = search(self.x, near, q, at, 4)
            at = ids[np.arange(len(q)), np.where(ids >= 0, sim, -3).argmax(1)]
        return search(self.x, self.neighbours[0], q, at, beam)


def search(x: np.ndarray, near: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int, chunk: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of a beam search for each query at once, in steps that expand each query's best open node."""
    ids = np.full((len(q), beam), -1, np.int32)
    sims = np.full((len(q), beam), -2, np.float32)
    for c in range(0, len(q), chunk):
        qs = q[c : c + chunk]
        n = len(qs)
        bid, bsim, opened = np.full((n, beam), -1, np.int32), np.full((n, beam), -2, np.float32), np.ones((n, beam), bool)
        bid[:, 0], opened[:, 0] = entry[c : c + chunk], False
        bsim[:, 0] = np.einsum("nd,nd->n", qs, x[bid[:, 0]])
        seen = np.zeros((n, (len(x) + 7) // 8), np.uint8)  # a bit for each node
        seen[np.arange(n), bid[:, 0] >> 3] |= (1 << (bid[:, 0] & 7)).astype(np.uint8)
        live = np.arange(n)
        while len(live):
            best = np.where(opened[live], -3, bsim[live]).argmax(1)
            go = ~opened[live, best]
            live, best = live[go], best[go]
            if not len(live):
                break
            opened[live, best] = True
            new = near[bid[live, best]]
            known = (new < 0) | (seen[live[:, None], np.maximum(new, 0) >> 3] >> (np.maximum(new, 0) & 7).astype(np.uint8) & 1).astype(bool)
            rows, cols = np.nonzero(~known)
            nodes = new[rows, cols]
            np.bitwise_or.at(seen, (live[rows], nodes >> 3), (1 << (nodes & 7)).astype(np.uint8))
            s = np.full(new.shape, -2, np.float32)
            s[rows, cols] = np.einsum("nd,nd->n", qs[live[rows]], x[nodes])
            all_ids, all_s = np.concatenate((bid[live], np.where(known, -1, new)), 1), np.concatenate((bsim[live], s), 1)
            all_open = np.concatenate((opened[live], known), 1)
            top = np.argpartition(-all_s, beam - 1, 1)[:, :beam]
            bid[live], bsim[live], opened[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_s, top, 1), np.take_along_axis(all_open, top, 1)
        ids[c : c + chunk], sims[c : c + chunk] = bid, bsim
    return ids, sims


def unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows or vanishes."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def partners(graph: Graph, queries: np.ndarray, beam: int, least: float, whole: int = WHOLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of similarity near `least` or more, block by block, by beams that are wider than the partners found."""
    open_, least = np.arange(len(queries)), least - 1e-3
    while len(open_) and whole * beam < len(graph.x):
        full = []
        for b in range(0, len(open_), chunk := max(16, 1024 * BEAM // beam)):
            own = open_[b : b + chunk]
            ids, sims = graph.find(queries[own], beam)
            hit = (ids >= 0) & (sims >= least)
            full.append(own[hit.all(1)])
            rows, cols = np.nonzero(hit)
            yield own[rows], ids[rows, cols]
        open_, beam = np.concatenate(full), 2 * beam
    for b in range(0, len(open_), 128):
        own = open_[b : b + 128]
        rows, cols = np.nonzero(queries[own].astype(np.float32) @ graph.x.T >= least)
        yield own[rows], cols


def planted(x: np.ndarray, least: float, n: int) -> np.ndarray:
    """n unit vectors, each turned away from one of x (unit vectors, evenly chosen) to a cosine of `least` and a little more,
    in a direction drawn at random; the same for the same x."""
    own = x[np.linspace(0, len(x) - 1, n).astype(int)].astype(np.float64)
    away = np.random.default_rng(len(x)).normal(size=own.shape)
    away -= (away * own).sum(1, keepdims=True) * own
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    near = min(least + 1e-3, 1.0)
    return (near * own + np.sqrt(1 - near * near) * away).astype(np.float32)


def audited(graph: Graph, queries: np.ndarray, own: np.ndarray | None, least: float, whole: int = WHOLE) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(query, node, audit): links that join what the candidate links join, nodes numbered after the queries, by a beam
    as wide as the audit asks for or by comparison with all. own: each query's own node in the graph, if they are of one
    shard. The audit is (own queries in the sample, the recall of all partners, the beam, whether all were
    compared, the partners seen, planted ones among them)."""
    sample = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
    asked = np.concatenate((queries[sample].astype(np.float32), planted(graph.x, least, PARTNERS)))
    true = asked @ graph.x.T
    if own is not None:
        true[np.arange(len(sample)), own[sample]] = -2
    linked = true >= least
    beam, passed, recall = BEAM, False, 0.0
    while not passed and beam <= BEAM_LIMIT and whole * beam < len(graph.x):
        got = np.zeros(true.shape, bool)
        for rows, cols in partners(graph, asked, beam, least, whole):
            got[rows, cols] = True
        recall = float((got & linked).sum() / max(1, linked.sum()))
        passed = recall >= AUDIT_RECALL and linked.sum() >= PARTNERS
        beam *= 1 if passed else 2
    # a beam as wide as the shard compares with all of it
    found = partners(graph, queries, beam if passed else len(graph.x), least, whole)
    edges = [forest(rows, cols.astype(np.int64) + len(queries)) for rows, cols in found if len(rows)]
    audit = (len(sample), recall if passed else 1.0, beam if passed else 0, not passed, int(linked.sum()))
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), audit
    return *forest(*(np.concatenate(e) for e in zip(*edges, strict=True))), audit


def _matrix(column: pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy().astype(kind)
    return flat.reshape(len(column), -1)


_SHARD = "label string, dim int, shard int, shards int, ids binary, vectors binary, graph array<binary>, entry int"
_FOUND = "a long, b long, i int, j int, sampled int, recall double, beam int, compared boolean, partners int"


def _build(group: pa.Table) -> pa.Table:
    group = group.sort_by([("node", "ascending")])
    x = unit(_matrix(group["vector"]))
    g = Graph(x, group["node"].to_numpy())
    cols = [group[c][:1] for c in ("label", "dim", "shard", "shards")]
    graph = pa.array([[n.tobytes() for n in g.neighbours]], pa.list_(pa.binary()))
    return pa.table([*cols, pa.array([group["node"].to_numpy().tobytes()]), pa.array([g.x.tobytes()]), graph, pa.array([g.entry], pa.int32())], ["label", "dim", "shard", "shards", "ids", "vectors", "graph", "entry"])


def _search(least: float, whole: int):
    def run(group: pa.Table) -> pa.Table:
        q, r = sorted(group.to_pylist(), key=lambda row: row["graph"] is not None)
        ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(q["ids"], np.int64)
        g = Graph.__new__(Graph)
        g.x, g.entry = np.frombuffer(r["vectors"], np.float32).reshape(len(ids), -1), r["entry"]
        g.neighbours = [np.frombuffer(n, np.int32).reshape(len(ids), -1) for n in r["graph"]]
        own = np.searchsorted(ids, qids) if q["i"] == q["j"] else None
        x, y, audit = audited(g, np.frombuffer(q["vectors"], np.float32).reshape(len(qids), -1), own, least, whole)
        names = np.concatenate((qids, ids))
        a, b = names[x], names[y]
        a, b = a[a != b], b[a != b]
        n = len(a) + 1
        rest = [np.full(n, v) for v in (q["i"], q["j"], *audit)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), pa.int32()]
        return pa.table([pa.array([*c.tolist(), None] if k < 2 else c, t) for k, (c, t) in enumerate(zip((a, b, *rest), kinds, strict=True))], [f.split()[0] for f in _FOUND.split(", ")])

    return run


def search_links(nodes: DataFrame, least: float, shard: int = SHARD, whole: int = WHOLE) -> tuple[DataFrame, DataFrame]:
    """Of nodes (node, label, dim, vector): (a, b), links that join all that was found near `least` or nearer, and the audits
    (shards i and j, queries sampled, partners seen, recall, beam, and whether all queries were compared with the whole shard)."""
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("count")).withColumn("shards", F.ceil(F.col("count") / shard).cast("int"))
    dealt = keyed_join(nodes, sizes, ["label", "dim"], nodes.count()).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    graphs = materialize(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, _SHARD))
    size, other = F.octet_length("ids") / 8, F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    parts = F.explode(F.sequence(F.lit(0), F.ceil(size / QUERIES).cast("int") - 1))
    asked = graphs.withColumn("part", parts).select("label", "dim", F.col("shard").alias("i"), other.alias("j"), "part", F.expr(f"substring(ids, part * {8 * QUERIES} + 1, {8 * QUERIES})").alias("ids"), F.expr(f"substring(vectors, part * dim * {4 * QUERIES} + 1, dim * {4 * QUERIES})").alias("vectors"))
    ranges = graphs.select("label", "dim", F.col("shard").alias("i"), parts.alias("part"))
    held = graphs.select("label", "dim", F.col("shard").alias("j"), other.alias("i"), "ids", "vectors", "graph", "entry").join(ranges, ["label", "dim", "i"])
    rows = asked.withColumns({"graph": F.lit(None).cast("array<binary>"), "entry": F.lit(None).cast("int")}).unionByName(held)
    found = materialize(rows.groupBy("label", "dim", "i", "j", "part").applyInArrow(_search(least, whole), _FOUND))
    return found.where("a is not null").select("a", "b"), found.where("a is null").drop("a", "b")


def _verify(least: float):
    def run(group: pa.Table):
        group = group.sort_by([("side", "ascending"), ("node", "ascending")])
        split = int((group["side"].to_numpy() == 0).sum())
        node, weight, several = (group[c].to_numpy(zero_copy_only=False) for c in ("node", "weight", "several"))
        x = unit(_matrix(group["vector"]))
        same = group["i"][0].as_py() == group["j"][0].as_py()
        left, right = np.arange(split), np.arange(0 if same else split, len(node))
        hit = x[left] @ x[right].T >= least
        if same:
            np.fill_diagonal(hit, False)
        n = [hit @ weight[right]] + ([] if same else [weight[left] @ hit])
        a, b = np.nonzero(hit)
        a, b = node[left][a], node[right][b]
        told = several[left][:, None] | several[right][None, :]
        ta, tb = np.nonzero(hit & told)
        ta, tb = node[left][ta], node[right][tb]
        fa, fb = forest(a, b) if len(a) else (a, b)
        kinds = np.repeat([0, 1, 2, 2], [len(node), len(fa), len(ta), len(ta)]).astype(np.int32)
        cols = [np.concatenate((node, fa, ta, tb)), np.concatenate((node, fb, tb, ta)), np.concatenate((*n, np.zeros(len(kinds) - len(node), np.int64))), kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "n", "kind"])

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, shard: int = SHARD, whole: int = WHOLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per row of vectors (vec_id, embedding, label). Cosines are taken
    between vectors of one label and length."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    finite = F.forall("vector", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) != float("inf")), F.lit(False)))
    valid = base.where("vec_id is not null and label is not null").where(finite & F.exists("vector", lambda e: e != 0))
    valid = materialize(valid.groupBy("vec_id", "label", "vector").agg(F.lit(1)).select("vec_id", "label", F.size("vector").alias("dim"), "vector"))
    total = valid.count()
    nodes = materialize(valid.groupBy("label", "dim", "vector").agg(F.count("*").alias("count")).withColumn("node", F.monotonically_increasing_id()))
    members = materialize(keyed_join(valid, nodes, ["label", "dim", "vector"], total).select("vec_id", "node"))
    # ids with several vectors: what links with them is told apart id by id
    several = materialize(members.groupBy("vec_id").count().where("count > 1").select("vec_id", F.lit(True).alias("several")))
    marked = members.join(several, "vec_id", "left").select("vec_id", "node", F.coalesce("several", F.lit(False)).alias("several"))
    weights = materialize(marked.groupBy("node").agg(F.sum((~F.col("several")).cast("long")).alias("weight"), F.max("several").alias("several")))

    links, _ = search_links(nodes.select("node", "label", "dim", "vector"), least, shard, whole)
    groups = components(links)
    groups = groups.select("node", F.col("component").alias("group")).unionByName(groups.select(F.col("component").alias("node"), F.col("component").alias("group")).distinct())
    held = materialize(nodes.select("node", "vector").join(groups, "node").join(weights, "node"))
    sizes = materialize(held.groupBy("group").agg(F.count("*").alias("count"))).withColumn("blocks", F.ceil(F.col("count") / VERIFIED).cast("int"))
    dealt = keyed_join(held, sizes, ["group"], held.count()).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    dealt = dealt.select("group", "i", "j", (F.col("block") != F.col("i")).cast("int").alias("side"), "node", "weight", "several", "vector")
    keys = ["group", "i", "j"]
    found = materialize(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_group(keys, _verify(least)), "a long, b long, n long, kind int"))

    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = components(found.where("kind = 1"))
    per = nodes.select("node", "count").join(weights, "node").join(counts, "node", "left").join(parts, "node", "left")
    per = materialize(per.select("node", "count", (F.coalesce("n", F.lit(0)) + F.col("weight")).alias("n"), F.coalesce("component", "node").alias("part")))
    placed = materialize(keyed_join(members, per, ["node"], total))
    low = materialize(placed.groupBy("part").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("count")))
    placed = keyed_join(placed, low, ["part"], total).select("vec_id", "n", "component_id")
    if several.first() is None:
        rows = placed.select("vec_id", (F.col("n") - 1).alias("n_links"), "component_id")
    else:
        one = components(placed.select(F.col("vec_id").alias("a"), F.col("component_id").alias("b"))).withColumnRenamed("node", "vec_id")
        near = found.where("kind = 2").select("a", "b").unionByName(weights.where("several").select(F.col("node").alias("a"), F.col("node").alias("b"))).distinct()
        pairs = near.join(marked.select(F.col("node").alias("a"), F.col("vec_id").alias("v"), F.col("several").alias("s")), "a").join(marked.select(F.col("node").alias("b"), F.col("vec_id").alias("u"), F.col("several").alias("t")), "b")
        told = pairs.where("v <> u and (s or t)").select(F.col("v").alias("vec_id"), "u").distinct().groupBy("vec_id").agg(F.count("*").alias("told"))
        rows = placed.groupBy("vec_id").agg(F.max("n").alias("n")).join(several, "vec_id", "left").join(told, "vec_id", "left").join(one, "vec_id", "left")
        n = F.when(F.col("several"), F.lit(0)).otherwise(F.col("n") - 1) + F.coalesce("told", F.lit(0))
        rows = rows.select("vec_id", n.alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    out = base.select("vec_id").join(rows, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(vec_id, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, p.b FROM r JOIN p ON p.a = r.reach),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT embeddings.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, embeddings.vec_id = c.component_id AS kept
FROM embeddings JOIN c ON c.vec_id = embeddings.vec_id LEFT JOIN n ON n.vec_id = embeddings.vec_id
"""
