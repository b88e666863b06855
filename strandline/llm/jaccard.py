"""N-gram Jaccard join (8): vertical partitioning of a global shingle order.

Every text's set of 3-word shingles is put in one global order, rarest first. How rare a shingle is comes from counts of
the whole corpus, kept on a logarithmic scale in tables of fixed size: neither it nor any of its words can be more
frequent than its counter, so the least of them ranks it. Counters shared by chance only shape the order, never what links.

Equal sets are one node from the start. Texts that can reach the threshold share one of the first n - ceil(0.9 n) + 1
shingles, so linking the neighbours (by set size) of each such shingle gives clusters outside which no link can be; the
lists of very frequent shingles are dealt in SALTS parts.

Such clusters chain texts that only have a passage in common, the more the larger the corpus. So each set has a parity
bitmap, a few bytes for each hundred shingles: two sets differ by at least as many shingles as their bitmaps by bits. Pairs
of a cluster that their bitmaps allow to link make the clusters that are compared; no full set is sent before.

Within those the global order is cut at FRAGMENTS - 1 points: each fragment counts the shared shingles of its pairs by
matrix products over blocks of BLOCK nodes, the counts are summed per pair and tested exactly, and links become
components. Large clusters are dealt by pairs of blocks, so no task holds a whole cluster.

Null and empty texts have no set and link with nothing; a null doc_id links with nothing and has a null component;
rows with one doc_id are one node with the links of all of them, and each gets a row. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import Words, components, forest, hot_count, keyed_join, map_groups, materialize, mix, small_batches, table, text_chunks

#: Counters of words and of shingles (powers of two, a byte each), the parts they are merged in, and steps of a doubling.
WORD_BITS, SHINGLE_BITS, RANGES, STEPS = 21, 22, 96, 8
#: Characters of a chunk of texts that a task works on at once.
CHUNK = 1 << 18
#: Fragments of the order, nodes of a block, parts of the list of a very frequent shingle.
FRAGMENTS, BLOCK, SALTS = 4, 256, 64
#: Bits of a parity bitmap at most, and parts at most in which the bitmaps of one size class of a cluster are dealt.
MOST_BITS, PARTS = 1 << 15, 64
#: Ids that are broadcast at most (some 20 MB) to leave texts out before they are shuffled.
BROADCAST_IDS = 1 << 20


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Removes the shuffle files of a job when it is done, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles, of all words as one if they are fewer."""
    if not len(words):
        return words
    n = min(n, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + words[k : len(words) - n + 1 + k])
    return h


def _slots(words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (words >> np.uint64(64 - WORD_BITS)).astype(np.int64), (hashes >> np.uint64(64 - SHINGLE_BITS)).astype(np.int64) + (1 << WORD_BITS)


def frequency_levels(docs: DataFrame, n: int) -> np.ndarray:
    """STEPS * log2 of how often words, then shingles, occur over all texts, by the top bits of their hashes: some MB."""
    size = (1 << WORD_BITS) + (1 << SHINGLE_BITS)
    width = -(-size // RANGES)

    def count(batches):
        total, some = np.zeros(size, np.uint32), False  # of a task, whose texts have fewer words than that
        for _, texts in text_chunks(batches, CHUNK):
            w, some = Words(texts), True
            for slots in _slots(w.hash, _hashes(w.hash, n)):  # shingles across texts are few and only shape the order
                slot, times = np.unique(slots, return_counts=True)
                total[slot] += times.astype(np.uint32)
        for r in range(RANGES if some else 0):
            own = total[r * width : (r + 1) * width].astype(np.int64)
            large = np.flatnonzero(own > 255)
            row = [r, np.minimum(own, 255).astype(np.uint8).tobytes(), large.astype(np.int64).tobytes(), (own[large] - 255).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["r", "n", "large", "more"])

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, n_, large, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(n_, np.uint8)
                total = sums.setdefault(r, np.zeros(len(own), np.int64))
                total += own
                total[np.frombuffer(large, np.int64)] += np.frombuffer(more, np.int64)
        for r, total in sums.items():
            level = np.minimum(STEPS * np.log2(total + 1.0), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r]), pa.array([level.tobytes()])], ["r", "levels"])

    counted = docs.select(F.lit(0).alias("i"), "text").mapInArrow(count, "r long, n binary, large binary, more binary")
    rows = counted.repartition("r").mapInArrow(merge, "r long, levels binary").toArrow()
    out = np.zeros(width * RANGES, np.uint8)
    for r, levels in zip(rows["r"].to_pylist(), rows["levels"].to_pylist(), strict=True):
        own = np.frombuffer(levels, np.uint8)
        out[r * width : r * width + len(own)] = own
    return out[:size]


def _ordered(words: np.ndarray, n: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, the same as places in the global order, ascending): the level in the top byte, the hash below."""
    h = _hashes(words, n)
    distinct, first = np.unique(h, return_index=True)
    word, shingle = (levels[s] for s in _slots(words, h))
    m = len(words) - len(h) + 1
    rare = np.min([shingle, *(word[j : len(word) - m + 1 + j] for j in range(m))], axis=0) if m >= n else np.full(len(h), word.min())
    return distinct, np.sort(rare[first].astype(np.uint64) << np.uint64(56) | distinct >> np.uint64(8))


def _node(distinct: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(distinct.tobytes())
    return (d & (1 << 64) - 1) - (1 << 63), (d >> 64) - (1 << 63)


def _parities(distinct: np.ndarray, percent: int) -> bytes:
    """A parity bitmap: of each value of the hashes' low bits whether an odd number of shingles has it. Its bits are a power
    of two, five times as many as sets of this size that link may differ by; it is folded by halves to fit a smaller one."""
    apart = 2 * len(distinct) * (100 - percent) // (100 + percent)
    bits = min(MOST_BITS, max(64, 1 << (5 * apart).bit_length()))
    odd = np.bincount((distinct & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


_SETS = "doc_id long, n int, node long, more long, prefix array<long>, parts array<long>, bits binary"


def shingle_sets(docs: DataFrame, n: int, percent: int, levels) -> DataFrame:
    """(doc_id, n, node, more, prefix, parts, bits), a row per document: the size of its set, the two halves of the set's
    digest, its first shingles in the order, where the order cuts it in FRAGMENTS equal parts, and its parity bitmap."""

    def run(batches):
        for ids, texts in text_chunks(batches, CHUNK):
            w = Words(texts)
            rows = []
            for k in range(len(texts)):
                words = w.hash[w.first[k] : w.first[k + 1]]
                if not len(words):
                    rows.append((0, *[None] * 5))
                    continue
                distinct, order = _ordered(words, n, levels.value)
                m = len(order)
                parts = [int(order[m * q // FRAGMENTS] >> np.uint64(1)) for q in range(1, FRAGMENTS)]
                rows.append((m, *_node(distinct), order[: m - -(-percent * m // 100) + 1].view(np.int64), parts, _parities(distinct, percent)))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n", "node", "more", "prefix", "parts", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, _SETS)


def _rebatched(batches, rows: int = 1 << 17):
    """Columns of many rows at once, as numpy arrays."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            held, n = [], 0
    if n:
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


# ------------------------------------------------------------------ candidates
def neighbours(postings: DataFrame, percent: int, hot_level: int) -> DataFrame:
    """(a, b): of each list of nodes that share a shingle every node and the one next in size, if near enough, from postings
    (s, n, node): these connect all that could link over it. Spanning edges of what a task has. Lists of very frequent
    shingles are dealt in SALTS parts; of each part the first node of each size class (sizes that differ by less than the
    threshold, so that a part links all of a class) makes a list, in which all of a class and of the next one are linked."""

    def run(batches, parts: bool):
        last = None
        for s, salt, n, node in _rebatched(batches):
            if last:
                s, salt, n, node = (np.append(x, v) for x, v in zip(last, (s, salt, n, node), strict=True))
            same = (s[1:] == s[:-1]) & (salt[1:] == salt[:-1])
            kind = np.floor(np.log(n) / math.log(100 / percent) + 1e-9) if percent < 100 else n
            close = 100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64) if parts else np.diff(kind) <= 1
            near = np.flatnonzero(same & close)
            a, b = forest(node[near], node[near + 1]) if len(near) else (node[:0], node[:0])
            top = np.flatnonzero((salt > 0) & np.append(True, ~same | (np.diff(kind) > 0)))
            cols = [np.concatenate((a, node[top])), np.concatenate((b, node[top])), np.concatenate((np.zeros(len(a), np.int64), s[top])), np.concatenate((np.zeros(len(a), np.int32), n[top]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "s", "n"])
            last = s[-1:], salt[-1:], n[-1:], node[-1:]

    def once(rows: DataFrame, parts: bool) -> DataFrame:
        spread = rows.select("s", "salt", "n", "node").repartition("s", "salt").sortWithinPartitions("s", "salt", "n", "node")
        return spread.mapInArrow(lambda batches: run(batches, parts), "a long, b long, s long, n int")

    salt = F.when(F.shiftrightunsigned("s", 56) >= hot_level, 1 + F.pmod(F.col("node"), F.lit(SALTS))).otherwise(0)
    found = materialize(once(postings.withColumn("salt", salt.cast("int")), True))
    firsts = found.where("a = b").select("s", F.lit(0).alias("salt"), "n", F.col("a").alias("node")).distinct()
    return found.where("a <> b").select("a", "b").unionByName(once(firsts, False).where("a <> b").select("a", "b"))


# ------------------------------------------------------------------ bitmaps
def _folded(bitmaps: list[bytes], words: int) -> np.ndarray:
    """Bitmaps of one length as rows of so many 64-bit words."""
    out = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)
    while out.shape[1] > words:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def _may_link(a: list[bytes], na: np.ndarray, b: list[bytes], nb: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and in b of all pairs that may link by their sizes and bitmaps."""
    la, lb = (np.array([len(x) for x in side]) for side in (a, b))
    for long in np.unique(la):
        x = np.flatnonzero(la == long)
        for other in np.unique(lb):
            y = np.flatnonzero(lb == other)
            if 100 * na[x].max() < percent * nb[y].min() or 100 * nb[y].max() < percent * na[x].min():
                continue
            words = int(min(long, other)) // 8
            left, right = _folded([a[k] for k in x], words), np.ascontiguousarray(_folded([b[k] for k in y], words).T)
            step = max(1, (1 << 15) // len(y))
            for low in range(0, len(x), step):
                some = x[low : low + step]
                differ = np.zeros((len(some), len(y)), np.uint16)  # MOST_BITS at most
                for w in range(words):
                    differ += np.bitwise_count(left[low : low + step, w, None] ^ right[w])
                m, n = na[some][:, None], nb[y][None, :]
                i, j = np.nonzero(((100 + percent) * differ.astype(np.int64) <= (100 - percent) * (m + n)) & (100 * np.minimum(m, n) >= percent * np.maximum(m, n)))
                yield some[i], y[j]


def resembling(nodes: DataFrame, clusters: DataFrame, percent: int, total: int) -> DataFrame:
    """(a, b): edges that connect, within each cluster (node, component), all pairs of nodes (node, n, bits) that may link by
    their sizes and bitmaps. Clusters of more than BLOCK nodes are dealt by size classes and pairs of blocks of these; a
    class is compared with itself and with the next one. total: how many nodes there are."""

    def run(group: pa.Table):
        side, node, n = (group[c].to_numpy() for c in ("side", "node", "n"))
        bits, n = group["bits"].to_pylist(), n.astype(np.int64)
        alone = not group["up"][0].as_py() and group["i"][0].as_py() == group["j"][0].as_py()
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if alone else 1))
        if not len(x) or not len(y):
            return
        edges = []
        for i, j in _may_link([bits[k] for k in x], n[x], [bits[k] for k in y], n[y], percent):
            p, q = node[x[i]], node[y[j]]
            if (apart := p != q).any():
                edges.append(forest(p[apart], q[apart]))
        if edges:
            a, b = forest(*(np.concatenate(c) for c in zip(*edges, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    # components() lists all nodes of a cluster but the least, which names it
    listed = clusters.unionByName(clusters.select(F.col("component").alias("node"), "component").distinct())
    large = listed.groupBy("component").agg(F.count("*").alias("count")).where(F.col("count") > BLOCK).select("component", F.lit(True).alias("large"))
    kind = F.floor(F.log("n") / F.lit(math.log(100 / percent)) + 1e-9) if percent < 100 else F.col("n")
    member = nodes.select("node", "n", "bits").join(listed, "node").join(F.broadcast(large), "component", "left")
    member = materialize(member.select(F.col("component").alias("cluster"), F.when(F.col("large"), kind).otherwise(-1).cast("int").alias("kind"), "node", "n", "bits"))
    blocks = F.least(F.ceil(F.col("count") / BLOCK), F.lit(PARTS)).cast("int")
    counts = materialize(member.groupBy("cluster", "kind").agg(F.count("*").alias("count")))
    beside = [counts.select("cluster", (F.col("kind") + step).alias("kind"), blocks.alias(name)) for step, name in ((-1, "above"), (1, "below"))]
    per = counts.withColumn("blocks", blocks)
    for other in beside:
        per = per.join(other, ["cluster", "kind"], "left")
    per = materialize(per.fillna(0, ["above", "below"]).where("count > 1 or above > 0 or below > 0"))
    dealt = keyed_join(member, per, ["cluster", "kind"], total).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    each = lambda n: F.slice(F.sequence(F.lit(0), F.col(n)), F.lit(1), F.col(n))  # noqa: E731  0 to n - 1
    pair = lambda kind, up, i, j, side: F.struct(kind.alias("kind"), F.lit(up).alias("up"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    own = F.transform(each("blocks"), lambda o: pair(F.col("kind"), 0, F.least("block", o), F.greatest("block", o), F.col("block") > o))
    above = F.transform(each("above"), lambda o: pair(F.col("kind"), 1, F.col("block"), o, F.lit(0)))
    below = F.transform(each("below"), lambda o: pair(F.col("kind") - 1, 1, o, F.col("block"), F.lit(1)))
    pieces = dealt.select("cluster", F.explode(F.concat(own, above, below)).alias("p"), "node", "n", "bits").select("cluster", "p.*", "node", "n", "bits")
    return map_groups(pieces, ["cluster", "kind", "up", "i", "j"], run, "a long, b long")


# ------------------------------------------------------------------ comparison
def segments(texts: DataFrame, n: int, levels, cuts: list[int]) -> DataFrame:
    """The fragments of each set (doc_id, text, node, cluster, block, blocks), for each pair of blocks that its own belongs to."""
    edges = np.array(cuts, np.uint64)

    def run(batches):
        for batch in batches:
            meta, at = batch.drop_columns(["text"]).to_pylist(), 0
            for _, some in text_chunks(iter([batch.select(["doc_id", "text"])]), CHUNK):
                w = Words(some)
                rows = []
                for k in range(len(some)):
                    m, words = meta[at + k], w.hash[w.first[k] : w.first[k + 1]]
                    if not len(words):
                        continue
                    distinct, order = _ordered(words, n, levels.value)
                    if _node(distinct)[0] != m["node"]:  # another text of this doc_id
                        continue
                    bounds = [0, *np.searchsorted(order >> np.uint64(1), edges).tolist(), len(order)]
                    pieces = [order[b:e].tobytes() for b, e in zip(bounds, bounds[1:])]
                    for other in range(m["blocks"]):
                        i, j = sorted((m["block"], other))
                        rows += [(m["cluster"], i, j, q, m["node"], len(order), int(m["block"] != i), p) for q, p in enumerate(pieces)]
                at += len(some)
                for low in range(0, len(rows), 500):
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[low : low + 500], strict=True), kinds, strict=True)], ["cluster", "i", "j", "fragment", "node", "n", "side", "ids"])

    return texts.mapInArrow(run, "cluster long, i int, j int, fragment int, node long, n long, side int, ids binary")


def shared_counts(sets: list[bytes], split: int) -> np.ndarray:
    """How many ids each of the first `split` sets shares with each of the others (with each of all, if split is all)."""
    ids = [np.frombuffer(s, np.uint64) for s in sets]
    who = np.repeat(np.arange(len(ids)), [len(s) for s in ids])
    _, token, df = np.unique(np.concatenate(ids), return_inverse=True, return_counts=True)
    keep = df[token] > 1
    who, (_, token) = who[keep], np.unique(token[keep], return_inverse=True)
    rows, cols = split, len(sets) - split or split
    out = np.zeros((rows, cols), np.float32)
    width = 8192
    order = np.argsort(token, kind="stable")
    who, token = who[order], token[order]
    top = int(token[-1]) + 1 if len(token) else 0
    for low in range(0, top, width):
        b, e = np.searchsorted(token, (low, low + width))
        m = np.zeros((len(sets), min(width, top - low)), np.float32)
        m[who[b:e], token[b:e] - low] = 1
        out += m[:split] @ m[split if split < len(sets) else 0 :].T
    return out.astype(np.uint32)


def _partial(group: pa.Table):
    group = group.sort_by([("side", "ascending"), ("node", "ascending")])
    node, side = group["node"].to_numpy(), group["side"].to_numpy()
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))  # without repeated rows
    group, node, side = group.take(pa.array(first)), node[first], side[first]
    split = int((side == 0).sum())
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    if i != j and split in (0, len(side)):
        return
    n = group["n"].to_numpy()
    shared = shared_counts(group["ids"].to_pylist(), split)
    b = slice(split, None) if i != j else slice(None)
    row = [group["cluster"][0].as_py(), i, j, node[:split], node[b], n[:split], n[b], shared.tobytes()]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["cluster", "i", "j", "a", "b", "na", "nb", "shared"])


def _links(percent: int):
    def run(group: pa.Table):
        a, b, na, nb = (np.array(group[c][0].as_py(), np.int64) for c in ("a", "b", "na", "nb"))
        total = np.sum([np.frombuffer(x, np.uint32) for x in group["shared"].to_pylist()], axis=0, dtype=np.int64).reshape(len(a), len(b))
        x, y = np.nonzero(100 * total >= percent * (na[:, None] + nb[None, :] - total))
        keep = a[x] != b[y]
        if keep.any():
            a, b = forest(a[x][keep], b[y][keep])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _once(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """texts (doc_id, text), of ids that very many rows have each different text once."""
    counts = sets.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("count"))
    hot = materialize(counts.where(F.col("count") > hot_count(sets.count())).select("doc_id"))  # few, by what makes them hot
    some = texts.join(F.broadcast(hot), "doc_id", "left_semi").groupBy("doc_id", F.xxhash64("text").alias("t")).agg(F.first("text").alias("text"))
    return texts.join(F.broadcast(hot), "doc_id", "left_anti").unionByName(some.select("doc_id", "text"))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): a row per document; documents whose sets have 100 * intersection >=
    percent * union link, component_id is the smallest doc_id reachable by links."""
    with _without_shuffle_files(docs.sparkSession):
        return _components(docs, n, percent)


def _components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = spark.sparkContext.broadcast(frequency_levels(docs, n))
    sets = materialize(shingle_sets(docs, n, percent, levels).withColumn("row", F.monotonically_increasing_id()))
    # equal sets, repeated rows among them: the least id of each part of a group, and of the group
    rows = sets.where("doc_id is not null and n > 0").select("doc_id", "row", "node", "more", F.pmod(F.col("row"), F.lit(SALTS)).alias("salt"))
    parts = materialize(rows.groupBy("node", "more", "salt").agg(F.min(F.struct("doc_id", "row")).alias("m")).select("node", "more", "salt", "m.*").withColumnRenamed("doc_id", "least"))
    groups = parts.groupBy("node", "more").agg(F.min(F.struct("least", "row")).alias("m")).select("node", "more", F.col("m.least").alias("doc_id"), "m.row")
    copies = rows.drop("row").join(parts.drop("row"), ["node", "more", "salt"]).where("doc_id <> least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    copies = copies.unionByName(parts.join(groups.drop("row"), ["node", "more"]).where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")))
    # one row for each set
    nodes = sets.join(groups.select("node", "more", "row"), ["node", "more", "row"], "left_semi")
    prefixes = nodes.select(F.explode("prefix").alias("s"), "n", "node")  # large, used once
    nodes = materialize(nodes.select("node", "doc_id", "n", "parts", "bits"))
    stats = nodes.agg(F.count("*").alias("n"), *(F.percentile_approx(F.col("parts")[q], 0.5).alias(f"p{q}") for q in range(FRAGMENTS - 1))).first()
    cuts = [stats[f"p{q}"] or 0 for q in range(FRAGMENTS - 1)]
    hot_level = int(STEPS * math.log2(hot_count(stats["n"]) + 1))
    # clusters outside which nothing links, dealt by pairs of blocks
    clusters = components(neighbours(prefixes, percent, hot_level))
    clusters = components(resembling(nodes, clusters, percent, stats["n"]))
    member = nodes.select("node", "doc_id").join(clusters, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("cluster"))
    member = materialize(member)
    sizes = materialize(member.groupBy("cluster").agg(F.count("*").alias("count")).where("count > 1")).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    dealt = keyed_join(member, sizes, ["cluster"], stats["n"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = docs.where("text is not null")
    if (sizes.agg(F.sum("count")).first()[0] or 0) <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(dealt.select("doc_id")), "doc_id", "left_semi")
    pieces = segments(_once(texts, sets).join(dealt, "doc_id"), n, levels, cuts)
    partial = map_groups(pieces, ["cluster", "i", "j", "fragment"], _partial, "cluster long, i int, j int, a array<long>, b array<long>, na array<long>, nb array<long>, shared binary")
    links = map_groups(partial, ["cluster", "i", "j"], _links(percent), "a long, b long")
    # components of sets as the least of their documents
    member = member.select("node", "doc_id").join(components(links), "node", "left")
    member = materialize(member.select("doc_id", F.coalesce("component", "node").alias("component")))
    least = materialize(member.groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("count")).where("count > 1"))
    joined = keyed_join(member, least, ["component"], member.count()).where("doc_id <> least").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    found = components(joined.unionByName(copies)).withColumnRenamed("node", "doc_id")
    out = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    return out.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))) END AS sh
  FROM w),
e AS (SELECT doc_id, unnest(sh) AS g, len(sh) AS n FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.reach)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = s.doc_id
"""
