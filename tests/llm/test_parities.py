"""Parity bitmaps of sets: which clusters are compared at all. Shuffle files of what is done."""

import glob
import random
import time

import numpy as np
import pytest

from strandline.llm import jaccard
from strandline.llm.jaccard import jaccard_components

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_texts_that_only_share_passages_are_not_compared(spark, monkeypatch, n, percent):
    """Each text shares a rare passage with the next, so all are one cluster of neighbours, in which only two link."""
    rng = random.Random(percent)
    word = lambda: f"w{rng.randrange(10**6)}"
    passages = [" ".join(word() for _ in range(12)) for _ in range(601)]
    often = [" ".join(word() for _ in range(7)) for _ in range(1000)]  # so all other shingles of a text are less rare
    texts = [" and so it is ".join([passages[k], *rng.sample(often, 25 + k % 3), passages[k + 1]]) for k in range(600)]
    texts.append(texts[300] + " and more")
    seen, before = [], jaccard.segments
    monkeypatch.setattr(jaccard, "segments", lambda rows, *more: seen.append(sorted((r["doc_id"], r["blocks"]) for r in rows.collect())) or before(rows, *more))
    got = jaccard_components(spark.createDataFrame(list(enumerate(texts)), SCHEMA), n, percent)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {k: k for k in range(600)} | {600: 300}
    assert seen == [[(300, 1), (600, 1)]]


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_bitmaps_keep_all_that_may_link(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for size in (1, 2, 7, 30, 200, 1000, 9000):
        base = rng.integers(0, 1 << 63, size).astype(np.uint64)
        for changed in (0, 1, size // 20, size // 10, size // 5):
            new = base.copy()
            new[: changed // 2] = rng.integers(0, 1 << 63, changed // 2)
            sets.append(np.unique(new[: size - changed // 2]))
    bits, n = [jaccard._parities(s, percent) for s in sets], np.array([len(s) for s in sets])
    kept = {(int(i), int(j)) for x, y in jaccard._may_link(bits, n, bits, n, percent) for i, j in zip(x, y, strict=True)}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert 100 * both < percent * (len(a) + len(b) - both) or (i, j) in kept
    assert not any(i // 5 != j // 5 for i, j in kept if min(n[i], n[j]) > 20) or percent == 50


def test_large_clusters_by_size_classes(spark, monkeypatch):
    """A cluster of several blocks and classes of sizes: the pairs that may link are those of a comparison with all."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "PARTS", 3)
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, rng.integers(20, 400)).astype(np.uint64)
        for _ in range(4):
            sets.append(np.unique(base[rng.integers(0, max(1, len(base) // 12)) :]))
    n = np.array([len(s) for s in sets])
    bits = [jaccard._parities(s, 80) for s in sets]
    nodes = spark.createDataFrame([(k, int(n[k]), bits[k]) for k in range(len(sets))], "node long, n int, bits binary")
    clusters = spark.createDataFrame([(k, 0) for k in range(1, 150)] + [(k, 150) for k in range(151, 155)], "node long, component long")
    of = lambda a, b: jaccard.forest(np.array(a), np.array(b))
    want = [(i, j) for x, y in jaccard._may_link(bits, n, bits, n, 80) for i, j in zip(x, y, strict=True) if i < j and (j < 150 or 150 <= i and j < 155)]
    got = jaccard.resembling(nodes, clusters, 80, len(sets)).collect()
    a, b = of(*zip(*want, strict=True)), of([r["a"] for r in got], [r["b"] for r in got])
    assert {*zip(*a, strict=True)} == {*zip(*b, strict=True)} and len(a[0]) > 60


def test_no_shuffle_files_stay_when_clusters_are_made(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dirs = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}
    was, before = spark.conf.get(key), files()
    jaccard_components(spark.createDataFrame([(k, f"a b c d {k} " * 20) for k in range(50)], SCHEMA))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == was
