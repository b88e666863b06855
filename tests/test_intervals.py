"""Disjoint alignments against a comparison with all kept before, and pairs of very many alignments."""

import random
import time

from pyspark.sql import functions as F

from strandline.operators import hits as H


def by_comparison(begins, ends, most=0.1):
    kept = []
    for k, (b, e) in enumerate(zip(begins, ends, strict=True)):
        if not any(max(0, min(ends[j], e) - max(begins[j], b)) > most * min(ends[j] - begins[j], e - b) for j in kept):
            kept.append(k)
    return kept


def test_neighbours_decide_as_all_do():
    rng = random.Random(11)
    for width in (3, 30, 300):
        for most in (0.0, 0.1, 0.5):
            begins = [rng.randrange(400) for _ in range(500)]
            ends = [b + rng.randrange(width) for b in begins]
            assert H.disjoint(begins, ends, min(most, 0.1)) == by_comparison(begins, ends, min(most, 0.1))
    assert H.disjoint([1, 5], [5, 9]) == [0, 1] and H.disjoint([], []) == []


def test_a_pair_of_very_many_alignments(spark):
    n = 100_000
    rows = spark.range(n).select(
        F.lit("q").alias("qseqid"), F.lit("s").alias("sseqid"), (F.col("id") % 7 + 1).cast("double").alias("bitscore"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("qstart"), F.col("id").alias("ord")).withColumn("qend", F.col("qstart") + F.col("ord") % 90)
    rows = rows.unionByName(rows.limit(1).withColumn("qseqid", F.lit("alone")))
    began = time.time()
    got = {r["qseqid"]: r for r in H.hsp_covers(rows).collect()}
    assert time.time() - began < 60
    begins, ends = zip(*((r["qstart"], r["qend"]) for r in rows.where("qseqid = 'q'").orderBy("ord").collect()), strict=True)
    kept = H.disjoint(list(begins), list(ends))
    assert [x["ord"] for x in got["q"]["cover"]] == kept and 5000 < len(kept) < n
    assert got["q"]["score"] == sum(k % 7 + 1 for k in kept) and len(got["alone"]["cover"]) == 1
    some = random.Random(12).sample(range(n), 200)
    inside = set(kept)
    for k in some:  # what went clashes with something kept before it, what stayed with nothing
        clash = any(min(ends[j], ends[k]) - max(begins[j], begins[k]) > 0.1 * min(ends[j] - begins[j], ends[k] - begins[k]) for j in kept if j < k)
        assert clash != (k in inside)
