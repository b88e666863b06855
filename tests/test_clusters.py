"""Average linkage in rounds against one merge after another."""

import numpy as np
import pandas as pd

from strandline.operators import reports


def one_by_one(pdf, height, least):
    names = sorted(set(pdf["a"]) | set(pdf["b"]))
    at = {n: i for i, n in enumerate(names)}
    m = np.ones((len(names), len(names)))
    np.fill_diagonal(m, 0)
    for a, b, x in zip(pdf["a"], pdf["b"], pdf["distance"], strict=True):
        if x == x:
            m[at[a], at[b]] = m[at[b], at[a]] = x
    points = 1 - m
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    members = {i: [i] for i in range(len(names))}
    while len(members) > 1:
        keys = list(members)
        mean = {(p, q): d[np.ix_(members[p], members[q])].mean() for i, p in enumerate(keys) for q in keys[i + 1 :]}
        (p, q), best = min(mean.items(), key=lambda kv: (kv[1], kv[0]))
        if best > height:
            break
        members[p] += members.pop(q)
    groups = sorted(sorted(names[i] for i in m) for m in members.values() if len(m) >= least)
    return [(n, k) for k, g in enumerate(groups) for n in g]


def test_rounds_cut_the_same_tree(spark):
    rng = np.random.default_rng(15)
    rows = []
    for g in ("x", "y", "z"):
        where = rng.random((24, 2)) * [3, 1] // 1 + 0.08 * rng.random((24, 2))
        for i in range(24):
            for j in range(i):
                d = float(min(1.0, np.abs(where[i] - where[j]).sum()))
                rows.append((g, f"s{i:02}", f"s{j:02}", d if rng.random() < 0.97 else None))
    frame = spark.createDataFrame(rows, "grp string, a string, b string, distance double")
    for height in (0.16, 0.5):
        got = {}
        for r in reports.sample_clusters(frame, height).collect():
            got.setdefault(r["grp"], []).append((r["sample"], r["cluster"]))
        for g in ("x", "y", "z"):
            pdf = pd.DataFrame([r[1:] for r in rows if r[0] == g], columns=["a", "b", "distance"]).astype({"distance": float})
            want = one_by_one(pdf, height, 3)
            assert sorted(got.get(g, [])) == sorted(want) and (height < 0.5 or want)


def test_matrices_are_square(spark):
    frame = spark.createDataFrame([("g", "a", "b", 0.25), ("g", "c", "a", None), ("h", "d", "d", 0.5)], "grp string, a string, b string, distance double")
    got = {tuple(r) for r in reports.distance_matrix(frame).collect()}
    assert got == {("g", x, y, 0.0 if x == y else 0.25 if {x, y} == {"a", "b"} else 1.0) for x in "abc" for y in "abc"} | {("h", "d", "d", 0.0)}
    assert reports.sample_clusters(frame.limit(0)).collect() == []
