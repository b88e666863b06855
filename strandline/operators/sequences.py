"""Sequences: duplicates, samples, offsets, length statistics, sketches and redundancy."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.scalar import kept, running_sums, with_row


def duplicate_clusters(reads: DataFrame, prefix: int = 70, columns: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(representative, read_id): reads with the same first bases, in both mates if there are two, and the first of them
    by `ord`. Ids are aggregated, not windowed, so a hot prefix is counted before it is shuffled."""
    key = [F.substring(c, 1, prefix).alias(f"__k{i}") for i, c in enumerate(columns)]
    rows = reads.select("read_id", "ord", *key)
    names = [f"__k{i}" for i in range(len(columns))]
    first = rows.groupBy(*names).agg(F.min_by("read_id", "ord").alias("representative"))
    return rows.join(first, names).select("representative", "read_id")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy(F.col("representative").alias("read_id")).agg(F.count("*").alias("size"))


def expand_clusters(reads: DataFrame, clusters: DataFrame) -> DataFrame:
    """Every member of the clusters that reads represent."""
    return clusters.join(reads.select(F.col("read_id").alias("representative")), "representative", "left_semi")


def nonhost_reads(reads: DataFrame, headers: DataFrame, clusters: DataFrame) -> DataFrame:
    """reads (read_id, mate and others) whose fragment an annotated header (header) names, or whose duplicate one names;
    clusters (representative, read_id) tell. Mate suffixes don't count."""
    bare = lambda c: F.regexp_replace(c, "/[12]$", "")
    named = headers.select(bare(F.element_at(F.split("header", ":"), -1)).alias("read_id")).distinct()
    wanted = expand_clusters(named, clusters).select("read_id").unionByName(named).distinct()
    return reads.join(wanted.withColumnRenamed("read_id", "__id"), bare("read_id") == F.col("__id"), "left_semi")


def unique_ids(reads: DataFrame) -> DataFrame:
    """reads themselves; the job fails if two have one read_id."""
    twice = reads.groupBy("read_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("__most"), F.max_by("read_id", "n").cast("string").alias("__which"))
    fine = F.when(F.coalesce("__most", F.lit(1)) == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("repeated read id: "), F.col("__which"))).cast("boolean"))
    return with_row(reads, twice).where(fine).drop("__most", "__which")


def sorted_by_id(reads: DataFrame) -> DataFrame:
    """reads in the order of their ids' bytes."""
    return reads.orderBy("read_id", *(c for c in ("header", "seq") if c in reads.columns))


def masked(sequence: Column, breadth: float, start: Column) -> Column:
    """A sequence of which only the share `breadth` is left: the rest, one stretch from `start` on, wrapping at the end, is N."""
    n = F.length(sequence)
    away = F.floor(n * F.lit(1 - breadth)).cast("int")
    first = F.least(away, n - start)
    body = F.overlay(sequence, F.repeat(F.lit("N"), first), start + 1, first)
    return F.when(away <= 0, sequence).otherwise(F.when(away > first, F.overlay(body, F.repeat(F.lit("N"), away - first), F.lit(1), away - first)).otherwise(body))


def reduplicate(kept: DataFrame, clusters: DataFrame, originals: DataFrame) -> DataFrame:
    """kept with the records of all duplicates of the representatives among it."""
    members = expand_clusters(kept, clusters).where("read_id <> representative").select("read_id")
    return kept.unionByName(originals.join(members, "read_id", "left_semi").select(*kept.columns))


def subsample(fragments: DataFrame, n: int, seed: int, key: str = "read_id") -> DataFrame:
    """n fragments picked by a hash of their id and the seed: mates, whose ids are the same, are picked together."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    chosen = fragments.select(key).distinct().orderBy(order, key).limit(n)
    return fragments.join(chosen, key, "left_semi")


def truncated(fragments: DataFrame, n: int, ordinal: str = "ord") -> DataFrame:
    """Fragments of the first n ordinals, counted from 0."""
    return fragments.where(F.col(ordinal) < n)


def distinct_sequences(*frames: DataFrame) -> DataFrame:
    """One record (read_id, seq) per distinct sequence of all frames, the one of the first frame and of the least id."""
    rows = [f.select("read_id", "seq", F.lit(k).alias("__source")) for k, f in enumerate(frames)]
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    return union.groupBy("seq").agg(F.min(F.struct("__source", "read_id")).alias("m")).select("m.read_id", "seq")


def length_metrics(reads: DataFrame, length: str) -> DataFrame:
    """Median, mode (the smallest on ties), mean absolute deviation, extremes, mean and population deviation."""
    counts = reads.where(F.col(length).isNotNull()).groupBy(F.col(length).alias("v")).agg(F.count("*").alias("c"))
    stats = reads.agg(F.percentile(length, F.lit(0.5)).alias("median"), F.min(length).alias("min"), F.max(length).alias("max"), F.avg(length).alias("mean"), F.stddev_pop(length).alias("stddev"))
    spread = with_row(counts, stats)
    mad = F.sum(F.abs(F.col("v") - F.col("mean")) * F.col("c")) / F.sum("c")
    return spread.groupBy(*stats.columns).agg(mad.alias("mad"), F.min_by("v", F.struct(-F.col("c"), F.col("v"))).alias("mode"))


def length_buckets(reads: DataFrame, length: str) -> DataFrame:
    bucket = F.when(F.col(length) < 50, "<50").when(F.col(length) < 500, "50-500").when(F.col(length) < 10_000, "500-10000").otherwise("10000+")
    return reads.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def n50(contigs: DataFrame, length: str, *keys: str) -> DataFrame:
    """Contigs, total bases and N50 of each key: the length at which the running sum of lengths, longest first, reaches
    half the total. Lengths are counted before they are ordered."""
    counts = contigs.groupBy(*keys, F.col(length).alias("l")).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys).orderBy(F.desc("l")).rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumns({"cum": F.sum(F.col("l") * F.col("c")).over(w), "total": F.sum(F.col("l") * F.col("c")).over(Window.partitionBy(*keys))})
    return run.groupBy(*keys).agg(F.sum("c").alias("n_contigs"), F.max("total").alias("total"), F.max(F.when(F.col("cum") * 2 >= F.col("total"), F.col("l"))).alias("n50"))


def byte_ranges(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, first_byte, last_byte, n) of each key's records (size) in a file sorted by key and then by order. Sizes are
    summed per key first, so only a row per key is ordered as a whole."""
    per = running_sums(records.groupBy(key).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), [F.asc(key)], first_byte="bytes")
    return per.select(key, "first_byte", (F.col("first_byte") + F.col("bytes") - 1).alias("last_byte"), "n")


def offsets(records: DataFrame, group: str, order: list[str]) -> DataFrame:
    """records (size) with the byte at which each begins in a file sorted by group and then by order. The file is dealt by
    ranges, so that a large group is in several."""
    return running_sums(records, [F.asc(group), *map(F.asc, order)], offset="size")


# ------------------------------------------------------------------ sketches
HASHES = 1 << 52
_COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")


def _portable_hashes(text: str, k: int, seed: int, dna: bool) -> np.ndarray:
    """52 bits of the MD5 digests of the k-mers, of DNA of the lesser strands': the same on any engine, but slower than
    rolling hashes."""
    if not dna:
        return _block_hashes([text], k, seed)[0]
    seen = {min(x, x.translate(_COMPLEMENT)[::-1]) for x in (text[i : i + k] for i in range(len(text) - k + 1))}
    return np.array([int.from_bytes(hashlib.md5(f"{seed}:{x}".encode(), usedforsecurity=False).digest()[:8], "big") >> 12 for x in seen], np.int64)


#: The shifts of MD5's rounds, its constants, and which word of a block a step takes.
_SHIFTS = [s for quarter in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in quarter * 4]
_SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
_WORDS = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_heads(words: np.ndarray) -> np.ndarray:
    """The first 52 bits of the MD5 digests of messages of one block, which are the columns of 16 rows of 32-bit words; words
    that all messages have as zero are not added."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in _START)
    filled = [bool(row.any()) for row in words]
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += np.uint32(_SINES[i])
        if filled[_WORDS[i]]:
            f += words[_WORDS[i]]
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=g)
        f <<= np.uint32(_SHIFTS[i])
        f |= g
        f += b
        a, b, c, d, f = d, f, b, c, a  # what was a is written over next
    first, second = ((x + np.uint32(v)).byteswap().astype(np.uint64) for x, v in ((a, _START[0]), (b, _START[1])))
    return ((first << np.uint64(32) | second) >> np.uint64(12)).astype(np.int64)


_AT_ONCE = 1 << 15


def _block_hashes(texts: list[str], k: int, seed: int) -> list[np.ndarray]:
    """The first 52 bits of the MD5 digests of all k-mers of each text, many at once, whatever texts they are of; those that
    aren't one block of MD5 one by one."""
    whole, head = "".join(texts), f"{seed}:".encode()
    raw = whole.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, np.uint8)
    begins = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(raw))  # of letters
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(lengths - k + 1, 0)
    letter = np.repeat(np.cumsum(lengths) - lengths - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())  # that a k-mer begins with
    room = 56 - len(head)
    windows = np.lib.stride_tricks.sliding_window_view(np.append(codes, np.zeros(room, np.uint8)), room)
    out = np.zeros(len(letter), np.int64)
    for at in range(0, len(letter), _AT_ONCE):
        some = letter[at : at + _AT_ONCE]
        first, length = begins[some], begins[some + k] - begins[some]
        fits = length < room
        if not fits.all():
            for x in np.flatnonzero(~fits).tolist():
                mer = whole[some[x] : some[x] + k].encode("utf-8", "surrogatepass")
                out[at + x] = int.from_bytes(hashlib.md5(head + mer, usedforsecurity=False).digest()[:8], "big") >> 12
            first, length = first[fits], length[fits]
        if not len(first):
            continue
        blocks = np.zeros((len(first), 64), np.uint8)
        blocks[:, : len(head)] = np.frombuffer(head, np.uint8)
        letters = blocks[:, len(head) : 56]
        same = int(length.max())
        letters[:, :same] = windows[first, :same]
        if length.min() < same:
            letters[np.arange(room) >= length[:, None]] = 0
        letters[np.arange(len(first)), length] = 0x80
        words = blocks.view("<u4").T.copy()
        words[14] = 8 * (length + len(head))
        out[at : at + _AT_ONCE][fits] = _md5_heads(words)
    return np.split(out, np.cumsum(counts)[:-1])


def _rolling_hashes(text: str, k: int, seed: int, dna: bool) -> np.ndarray:
    """52 bits of polynomial hashes modulo 2^64 of all k-mers, from prefix sums; of DNA the lesser of both strands'."""
    n = len(text) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    base = (0x9E3779B97F4A7C15 ^ seed << 1) | 1
    up, down = (np.full(len(text), b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)

    def windows(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * powers)))
        return total[k:] - total[:-k]

    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(12)

    codes = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    with np.errstate(over="ignore"):
        h = mixed(windows(codes(text), up) * down[:n])
        if dna:
            h = np.minimum(h, mixed(windows(codes(text.translate(_COMPLEMENT)), down) * up[:n] * up[k - 1]))
    return h.astype(np.int64)


def sketch(sequence: Column, k: int = 31, scaled: int = 1000, seed: int = 42, dna: bool = True, portable: bool = False) -> Column:
    """Scaled MinHash: the distinct 52-bit hashes of k-mers below 1/scaled of all, ascending; of DNA a k-mer and its
    reverse complement are one. An Arrow function, as Spark's substring walks a text from its beginning for each k-mer.
    Null and shorter sequences have an empty sketch."""
    hashes = _portable_hashes if portable else _rolling_hashes

    @F.pandas_udf("array<bigint>")
    def sketched(s: pd.Series) -> pd.Series:
        least = lambda h: np.unique(h[h < HASHES // scaled])
        if dna or not portable:
            return s.map(lambda text: least(hashes(text or "", k, seed, dna)))
        out, texts, letters = [], [], 0
        for text in s:
            texts.append(text or "")
            letters += len(texts[-1])
            if letters >= 4 * _AT_ONCE:
                out += map(least, _block_hashes(texts, k, seed))
                texts, letters = [], 0
        return pd.Series(out + [least(h) for h in (_block_hashes(texts, k, seed) if texts else ())], dtype=object)

    return sketched(sequence)


def containment(a: Column, b: Column) -> Column:
    """Share of a that b holds; of an empty sketch none."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(a)), F.lit(0.0))


def group_key(group: Column) -> Column:
    """A string that is equal for equal groups and never null, so that sequences without group can be joined too."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.to_json(F.struct(group.alias("g")))))


#: Holders of a hash, the earliest first, that a sequence is compared with in the first round; later rounds take more.
HEADS = 8


def _held(first: DataFrame, threshold: float) -> DataFrame | None:
    """(grp, id) of the sequences (grp, id, ord, sketch), of different sketches, that the greedy walk drops, or None.

    Pairs aren't listed, as a hash that many hold makes very many. A sequence of which earlier ones hold too few hashes, all
    taken together, stays. Others ask, by the rarest of their hashes that earlier ones hold, as many as a holder can't all
    lack, for the first few holders of each that are left. One that a holder sure to stay contains goes; one that has seen
    all earlier holders of these hashes, and that none contains, stays. What goes is no holder in the next round, which
    takes more of the rest."""
    pair = ["grp", "h"]
    own, posting = Window.partitionBy("grp", "id"), Window.partitionBy(*pair).orderBy("ord")
    need = F.greatest(F.ceil(F.lit(threshold) * F.size("sketch")), F.lit(1)).cast("int")
    rows = first.select("grp", "id", "ord", need.alias("need"), F.explode("sketch").alias("h"))
    begins = lambda held: held.groupBy(*pair).agg(F.min("ord").alias("begin"), F.count("*").alias("f"))

    def asked(some: DataFrame, held: DataFrame) -> DataFrame:
        """Rows of which an earlier sequence has the hash, of sequences of which earlier ones have enough, rarest first."""
        old = some.join(begins(held).where("f > 1"), pair).where("begin < ord").withColumn("older", F.count("*").over(own)).where("older >= need")
        return old.withColumn("k", F.row_number().over(own.orderBy("f", "h"))).withColumn("prefix", F.col("k") <= F.col("older") - F.col("need") + 1).drop("begin", "k", "older")

    asks = kept(asked(rows, rows))
    open_ = asks.select("grp", "id", F.lit(True).alias("open")).distinct()
    held = rows.drop("need").join(asks.select(*pair).distinct(), pair, "left_semi").join(open_, ["grp", "id"], "left")
    held = kept(held.withColumn("open", F.coalesce("open", F.lit(False))))
    gone, most = None, HEADS
    while asks.first() is not None:
        heads = kept(held.withColumn("j", F.row_number().over(posting)).where(F.col("j") <= most).drop("j"))
        last = heads.groupBy(*pair).agg(F.max("ord").alias("last"))
        prefix = asks.where("prefix")
        seen = prefix.join(last, pair).groupBy("grp", "id").agg(F.min((F.col("f") <= most) | (F.col("last") >= F.col("ord"))).alias("all"))
        holder = heads.select(*pair, F.col("id").alias("b"), F.col("ord").alias("ob"), "open")
        near = kept(prefix.join(holder, pair).where("ob < ord").select("grp", "id", "need", "b", "open").distinct())
        ha = asks.groupBy("grp", "id").agg(F.collect_list("h").alias("ha"))
        hb = held.withColumnRenamed("id", "b").join(near.select("grp", "b").distinct(), ["grp", "b"], "left_semi").groupBy("grp", "b").agg(F.collect_list("h").alias("hb"))
        edges = near.join(ha, ["grp", "id"]).join(hb, ["grp", "b"]).where(F.size(F.array_intersect("ha", "hb")) >= F.col("need"))
        edges = edges.groupBy("grp", "id").agg(F.min("open").alias("waits"))  # false: one that stays contains it
        fate = F.when(~F.col("waits"), "goes").when(F.col("waits").isNull() & F.col("all"), "stays")
        fates = kept(seen.join(edges, ["grp", "id"], "left").select("grp", "id", fate.alias("fate")))
        new = fates.where("fate = 'goes'").select("grp", "id")
        gone = new if gone is None else gone.unionByName(new)
        left = held.join(new, ["grp", "id"], "left_anti")
        rest = asks.select("grp", "id", "ord", "need", "h").join(fates.where("fate is null"), ["grp", "id"], "left_semi")
        asks = kept(asked(rest, left))
        open_ = asks.select("grp", "id", F.lit(True).alias("open")).distinct()
        held = left.drop("open").join(asks.select(*pair).distinct(), pair, "left_semi").join(open_, ["grp", "id"], "left")
        held = kept(held.withColumn("open", F.coalesce("open", F.lit(False))))
        most *= 4
    return gone


def reduce_redundant(sequences: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Greedy reduction of each group (grp, id, length, sketch), longest first: a sequence goes if one that stays holds
    `threshold` of its sketch. Of equal sketches the first stands for all: the others go, whether it stays or not. All is
    decided in rounds of joins. Empty sketches are held by nothing; sequences without group are a group of their own."""
    sequences = kept(sequences.withColumnRenamed("grp", "__grp").withColumn("grp", group_key(F.col("__grp"))))  # sketches are costly
    empty = sequences.where(F.coalesce(F.size("sketch"), F.lit(0)) <= 0)
    first = sequences.where(F.size("sketch") > 0).groupBy("grp", "sketch").agg(F.min(F.struct((-F.col("length")).alias("l"), "id")).alias("ord"))
    first = kept(first.select("grp", F.col("ord.id").alias("id"), "ord", "sketch"))
    gone = _held(first, threshold)
    left = first.select("grp", "id")
    if gone is not None:
        left = left.join(gone, ["grp", "id"], "left_anti")
    return sequences.join(left, ["grp", "id"], "left_semi").unionByName(empty).drop("grp").withColumnRenamed("__grp", "grp")


#: Sequences of a group from which on it is cut.
LARGE = 9_500_000


def cut_groups(sequences: DataFrame, large: int = LARGE) -> DataFrame:
    """sequences (grp, id, length and others) with `part`: null in groups of `large` or fewer, else (first, of): where the
    part begins in the order of lengths, and the number among the parts of one length."""
    key = group_key(F.col("grp"))
    classes = sequences.groupBy(key.alias("__key"), F.col("length").alias("__length")).agg(F.count("*").alias("n"))
    group = Window.partitionBy("__key")  # a row for each length
    before = F.coalesce(F.sum("n").over(group.orderBy(F.desc_nulls_last("__length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = classes.withColumns({"before": before, "total": F.sum("n").over(group)}).where(F.col("total") > large)
    classes = classes.select("__key", "__length", F.expr(f"before div {large}").alias("first"), F.ceil(F.col("n") / large).cast("long").alias("of"))
    classes = classes.withColumnRenamed("__key", "__of")
    same = (F.col("__key") == F.col("__of")) & F.col("length").eqNullSafe(F.col("__length"))
    cut = sequences.withColumn("__key", key).join(classes, same, "left")
    part = F.when(F.col("first").isNotNull(), F.struct("first", F.pmod(F.xxhash64("id"), F.col("of")).alias("of")))
    return cut.withColumn("part", part).select(*sequences.columns, "part")


def reduce_all(sequences: DataFrame, threshold: float = 0.5, large: int = LARGE) -> DataFrame:
    """reduce_redundant() of groups (grp, id, length, sketch) of any size. A group of more than `large` sequences is cut
    first: lengths, longest first, are dealt to parts of about that many sequences by the running count of sequences per
    length, so only a row for each length is ordered, never a group's sequences; a length that alone has more is dealt in
    parts by a hash of the id. Parts are reduced each on its own, and what is left of a group's parts together."""
    cut = kept(cut_groups(sequences, large))
    columns = sequences.columns
    giant = cut.where("part is not null")
    if giant.first() is None:
        return reduce_redundant(cut.select(*columns), threshold)
    parts = giant.withColumns({"__whole": F.col("grp"), "grp": F.struct(F.col("grp").alias("g"), "part")}).drop("part")
    left = reduce_redundant(parts, threshold).withColumn("grp", F.col("__whole")).select(*columns)
    return reduce_redundant(cut.where("part is null").select(*columns).unionByName(left), threshold)


# ------------------------------------------------------------------ pairs
def sync_pairs(one: DataFrame, two: DataFrame, max_fraction: float = 0.0) -> DataFrame:
    """Fragments with both mates, joined by id; the job fails if more than max_fraction of all are broken."""
    both = kept(one.withColumn("__1", F.lit(1)).join(two.withColumn("__2", F.lit(1)), "read_id", "full_outer"))
    broken = both.agg(F.avg((F.col("__1").isNull() | F.col("__2").isNull()).cast("double"))).first()[0]
    if (broken or 0.0) > max_fraction:
        raise ValueError(f"{broken:.4f} of all fragments lack a mate; {max_fraction} may")
    return both.where("__1 = 1 and __2 = 1").drop("__1", "__2")


def locators(records: DataFrame, fields: list[str]) -> DataFrame:
    """(field, taxid, first_byte, last_byte, n): byte ranges of each taxon in a copy of the records (size and taxids)
    sorted by each field; one pass makes all copies' sums."""
    item = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("taxid")) for f in fields)))
    per = records.select("size", item.alias("x")).groupBy("x.field", "x.taxid").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("field").orderBy("taxid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.select("field", "taxid", before.alias("first_byte"), (before + F.col("bytes") - 1).alias("last_byte"), "n")


def length_order(reads: DataFrame, group: str) -> DataFrame:
    """reads with their place in their group, longest first, equal lengths by id."""
    return reads.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.length("seq")), "read_id")))


def shuffled(reads: DataFrame, seed: int) -> DataFrame:
    """reads in an order that depends on their id and the seed alone."""
    return reads.orderBy(F.xxhash64(F.lit(seed), "read_id"), "read_id")


def by_taxon(reads: DataFrame, accessions: DataFrame) -> DataFrame:
    """reads with the taxid of their accession, 0 where unknown: for a write partitioned by taxid."""
    one = accessions.groupBy("accession").agg(F.min("taxid").alias("taxid"))
    return reads.withColumn("accession", F.substring_index("read_id", ".", 1)).join(one, "accession", "left").withColumn("taxid", F.coalesce("taxid", F.lit(0)))


def containing_sequence(needle: Column, key: Column, k: int, total_kmers: int, containment: float, seed: int = 42) -> Column:
    """A sequence of total_kmers * k letters that begins with `containment` of the needle, as far as both reach, and goes on by
    chance: letters follow from MD5 of seed, key and place, so they are the same wherever they are made. Of the needle's
    k-mers it holds that share but for those that the cut parts, fewer than k, and those that chance repeats."""
    n = k * total_kmers
    letter = lambda i: F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key, i)), 2, 1)  # noqa: E731  # its last two bits tell
    drawn = F.translate(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), letter), ""), "0123456789abcdef", "ACTG" * 4)
    taken = F.least(F.round(F.length(needle) * containment).cast("int"), F.lit(n))
    return F.concat(F.substring(needle, F.lit(1), taken), F.substring(drawn, taken + 1, F.lit(n)))


def concatenated(*references: DataFrame) -> DataFrame:
    """References (read_id, seq and others) of several sets, such as a host and its spike-ins, in the order of the sets; the
    job fails where two sets name one read_id."""
    union = references[0].withColumn("set", F.lit(0))
    for number, more in enumerate(references[1:], 1):
        union = union.unionByName(more.withColumn("set", F.lit(number)))
    return unique_ids(union)
