"""Symmetric DUST against all intervals of all windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import dust as D
from strandline.operators import filters as FL


def by_intervals(text, window=D.WINDOW, limit=D.SCORE):
    known = set("ACGTacgt")
    t = [text[i : i + 3].upper() if set(text[i : i + 3]) <= known else None for i in range(len(text) - 2)]
    score = {}
    for i in range(len(t)):
        for j in range(i + 1, min(i + window - 2, len(t))):
            if None in t[i : j + 1]:
                break
            part = t[i : j + 1]
            score[i, j] = sum(part.count(x) * (part.count(x) - 1) // 2 for x in set(part)) / (j - i)
    out = [False] * len(text)
    for (i, j), s in score.items():
        if s > limit and all(score.get((a, b), 0) <= s for a in range(i, j + 1) for b in range(a + 1, j + 1)):
            out[i : j + 3] = [True] * (j + 3 - i)
    return out


def sequences(rng, n):
    for _ in range(n):
        unit = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 5)))
        text = "".join(rng.choice(["A", "C", "G", "T", unit * rng.randrange(1, 9), "N", "a"]) for _ in range(rng.randrange(1, 22)))
        yield text[:70]


def test_masks_are_those_of_all_intervals():
    rng = random.Random(5)
    texts = [*sequences(rng, 120), "", "A", "AC", "ACG", "A" * 70, "ACGT" * 16, "NNNN"]
    for window in (64, 12):
        for t, m in zip(texts, D._marks(texts, window, D.SCORE), strict=True):
            assert m.tolist() == by_intervals(t, window), t


def test_masks_are_the_same_on_both_strands():
    text = "".join(random.Random(6).choice("AACGT") for _ in range(4000)) + "AT" * 30 + "GATTACA" * 9
    turned = text.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    one, two = (D.marked(np.frombuffer(t.encode(), np.uint8)) for t in (text, turned))
    assert one.any() and (one == two[::-1]).all()


def test_columns(spark):
    rows = [(0, "ACGTTGCA" * 2), (1, "A" * 40), (2, ""), (3, None), (4, "AAAC" * 10 + "GATCCTGACTAGCTTAGCGTACCATGCAAGT"), (5, "GGGGéGGGG"), (6, "aaaaaaaaaaaaNtttttttttttt")]
    frame = spark.createDataFrame(rows, "id int, seq string").repartition(2)
    got = {r["id"]: r for r in frame.select("id", D.unmasked_share(F.col("seq")).alias("share"), D.masked(F.col("seq")).alias("seq"), D.window_score(F.col("seq")).alias("score"), D.neighbour_share(F.col("seq")).alias("near")).collect()}
    for i, t in rows:
        marks = by_intervals(t or "")
        assert got[i]["share"] == pytest.approx(1 - sum(marks) / len(marks) if marks else 0.0)
        assert got[i]["seq"] == (t and "".join("N" if m else c for c, m in zip(t, marks, strict=True)))
        assert got[i]["near"] == pytest.approx(sum(a != b for a, b in zip(t, t[1:])) / (len(t) - 1) if t and len(t) > 1 else 0.0)
    assert got[1]["score"] == pytest.approx(38 * 37 / 2 / 37) and got[2]["score"] is None
    assert {r["id"] for r in FL.dust_filter(frame).collect()} == {i for i, t in rows if t and sum(by_intervals(t)) <= 0.4 * len(t)}


def test_long_sequences_and_presets(spark):
    rng = random.Random(7)
    long = "".join(rng.choice("ACGT") for _ in range(200_000))
    rows = [("long", long, "I" * 200_000), ("run", "A" * 400, "I" * 400), ("short", "ACGTTGCATG" * 4, "I" * 40), ("poor", long[:400], "!" * 400), ("two", "AT" * 100, "I" * 200)]
    frame = spark.createDataFrame(rows, "read_id string, seq string, quality string")
    assert {r["read_id"] for r in FL.long_read_quality(frame).collect()} == {"long", "two"}
    assert "long" in {r["read_id"] for r in FL.short_read_quality(frame).collect()}
    assert not {"run", "two", "poor"} & {r["read_id"] for r in FL.short_read_quality(frame).collect()}
