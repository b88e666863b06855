"""Hard negatives against integer products of all pairs."""

import math

import numpy as np
import pytest

from strandline.llm.negatives import Rotated, fitted, hard_negatives, survivors

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_comparison(rows):
    valid = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(e is None or not math.isfinite(e) for e in x) or not x:
            continue
        valid[(i, tuple(math.floor(256 * e) for e in x), (label + 1) % 10 if i % 7 == 0 else label)] = None
    out = []
    for i, z, label in valid:
        if i % 100:
            continue
        near = [(-sum(a * b for a, b in zip(z, y, strict=True)), j, same == label) for j, y, same in valid if len(y) == len(z)]
        for s, j in sorted((s, j) for s, j, same in near if same and j != i)[:5]:
            fit = sorted((t, k) for t, k, same in near if not same and 30 * -s <= 100 * -t <= 90 * -s)[:10]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fit)]
    return sorted(out)


def check(spark, table, **how):
    got = hard_negatives(spark.createDataFrame(table, SCHEMA).repartition(3), **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == by_comparison(table)


def clusters(rng, n, d, labels=4, spread=0.4):
    centres = rng.normal(size=(labels, d))
    label = rng.integers(0, labels, n)
    x = centres[label % 2] + spread * rng.normal(size=(n, d))
    return [(i, (v / np.linalg.norm(v)).tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]


@pytest.mark.parametrize("d, rows, anchors", [(3, 64, 2), (20, 100, 5), (64, 4096, 1024)])
def test_lists_are_those_of_all_pairs(spark, d, rows, anchors):
    check(spark, clusters(np.random.default_rng(d), 900, d), rows=rows, anchors=anchors, sample=50)


def test_ties_equal_vectors_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = clusters(rng, 500, 8)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(300)]  # a third are one vector
    rows += [(2000 + i, [0.5 * e for e in rows[0][1]], (rows[0][2] + 1) % 4) for i in range(60)]
    rows += rows[:120]
    check(spark, rows, rows=128, anchors=2)


def test_nulls_zeros_lengths_and_large_values(spark):
    rng = np.random.default_rng(2)
    rows = clusters(rng, 300, 6)
    rows += [(None, [1.0] * 6, 1), (400, None, 1), (500, [1.0] * 6, None), (600, [1.0, None] * 3, 1), (700, [float("nan")] + [1.0] * 5, 1), (800, [float("inf")] * 6, 2)]
    rows += [(900, [0.0] * 6, 1), (1000, [0.3, 0.4], 1), (1001, [0.3, 0.5], 1), (1002, [0.2, 0.2], 2), (1100, [], 1), (1200, [-1.0] * 6, 3)]
    rows += [(1300, [3e6] * 6, 1), (1301, [3e6] * 5 + [2.9e6], 1), (1302, [1.5e6] * 6, 2), (1400, [1e300] * 6, 1)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == by_comparison([r for r in rows if r[0] != 1400])


def test_empty_and_clashing_columns(spark):
    rows = [(*r, 1, "x", 2) for r in clusters(np.random.default_rng(3), 250, 4)]
    frame = spark.createDataFrame(rows, SCHEMA + ", node int, side string, score int")
    assert sorted(tuple(r) for r in hard_negatives(frame).collect()) == by_comparison([r[:3] for r in rows])
    assert not hard_negatives(frame.limit(0)).collect()


def test_bounds_drop_pairs_but_none_that_qualify():
    rng = np.random.default_rng(4)
    z = np.floor(256 * rng.normal(size=(3000, 64)) * np.linspace(1, 0.05, 64)).astype(np.int64) @ np.linalg.qr(rng.normal(size=(64, 64)))[0]
    z = np.floor(z).astype(np.int64)
    turn = fitted(z[:500])
    assert np.allclose(turn.T @ turn, np.eye(64))
    a, b = Rotated(z[:50], turn), Rotated(z, turn)
    exact = z[:50] @ z.T
    least = np.sort(exact, 1)[:, -20].astype(float)
    i, j, s = survivors(a, b, slice(0, 3000), np.ones((50, 3000), bool), least, np.full(50, 2.0**62))
    assert (s == exact[i, j]).all() and (s >= least[i]).sum() == (exact >= least[:, None]).sum()
    assert len(s) < 0.05 * exact.size
