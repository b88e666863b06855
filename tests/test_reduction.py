"""Reductions of groups of any size against the greedy walk, sequence by sequence."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import reduction as R
from strandline.operators import sequences as S


def greedy(rows, threshold):
    """Ids that stay of one group (id, length, sketch)."""
    stay = []
    for i, n, sketch in sorted(rows, key=lambda r: (-r[1], r[0])):
        if not sketch or not any(len(set(sketch) & set(other)) >= threshold * len(sketch) for _, _, other in stay):
            stay.append((i, n, sketch))
    return stay


def by_parts(rows, threshold, large, part):
    out = {}
    for g in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == g]
        if len(own) > large:
            parts = {}
            for r in own:
                parts.setdefault(part[r[0]], []).append(r)
            own = [r for p in parts.values() for r in greedy(p, threshold)]
        out[g] = sorted(r[0] for r in greedy(own, threshold))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    base = [rng.sample(range(10_000), 40) for _ in range(9)]
    out = []
    for i in range(600):
        sketch = sorted({*rng.sample(base[i % 9], rng.randrange(0, 40)), *rng.sample(range(10_000), rng.randrange(0, 12))})
        out.append((rng.choice(["a", "a", "a", "b", None]), i, len(sketch) * 3 + i % 5 if i % 3 else 60, sketch))
    return out


@pytest.mark.parametrize("large", [10_000, 50])
def test_cut_and_reduced_in_two_steps(spark, rows, large):
    frame = spark.createDataFrame(rows, "grp string, id long, length int, sketch array<long>").repartition(3)
    cut = S.cut_groups(frame, large).collect()
    part = {r["id"]: r["part"] and tuple(r["part"]) for r in cut}
    assert all((p is None) == (sum(r[0] == g for r in rows) <= large) for g, i, *_ in rows for p in [part[i]])
    for g in ("a", "b", None):
        own = [(part[r[1]], r[2]) for r in rows if r[0] == g and part[r[1]]]
        sizes = {p: sum(q == p for q, _ in own) for p, _ in own}
        assert all(n <= 2.5 * large for n in sizes.values())
        begins = sorted({(p[0], n) for p, n in own})  # longer sequences lie in earlier parts
        assert all(x[1] >= y[1] for x in begins for y in begins if x[0] < y[0])
    got = {}
    for r in S.reduce_all(frame, 0.5, large).collect():
        got.setdefault(r["grp"], []).append(r["id"])
    assert {g: sorted(v) for g, v in got.items()} == by_parts(rows, 0.5, large, part)


def test_sequences_without_group_or_letters_stay_apart(spark):
    rows = [(None, 1, 30, [1, 2, 3]), (None, 2, 20, [1, 2]), (None, 3, 5, []), ("x", 4, 20, [1, 2]), ("", 5, 9, [1]), ("null", 6, 9, [1]), ("x", 7, 1, None)]
    frame = spark.createDataFrame(rows, "grp string, id long, length int, sketch array<long>")
    got = S.reduce_redundant(frame, 0.5)
    assert got.columns == ["id", "length", "sketch", "grp"] or set(got.columns) == {"grp", "id", "length", "sketch"}
    assert sorted(r["id"] for r in got.collect()) == [1, 3, 4, 5, 6, 7]


def test_runs_by_taxon_and_unsplit(spark):
    rng = random.Random(10)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    one, two = letters(900), letters(900)
    reads = [("A1.1", one), ("A2.1", one[:600]), ("B1.1", one[:700]), ("B2.1", two), ("U1.1", two[100:700]), ("U2.1", letters(10)), ("U3.1", None)]
    frame = spark.createDataFrame(reads, "read_id string, seq string")
    accessions = spark.createDataFrame([("A1", 7), ("A2", 7), ("B1", 8), ("B2", 8)], "accession string, taxid long")
    how = {"k": 15, "scaled": 4}
    got = R.compressed_by_taxon(frame, accessions, **how)
    assert [r["read_id"] for r in got.collect()] == [r["read_id"] for r in got.collect()]
    assert {(r["read_id"], r["taxid"]) for r in got.collect()} == {("A1.1", 7), ("B1.1", 8), ("B2.1", 8), ("U1.1", 0), ("U2.1", 0), ("U3.1", 0)}
    assert {r["read_id"] for r in R.compressed_unsplit(frame, **how).collect()} == {"A1.1", "B2.1", "U2.1", "U3.1"}


def test_no_task_sees_a_whole_group(spark):
    frame = spark.range(4000).select(F.lit("g").alias("grp"), "id", (F.col("id") % 37).cast("int").alias("length"), F.array(F.xxhash64("id")).alias("sketch"))
    plan = S.cut_groups(frame, 500)._jdf.queryExecution().optimizedPlan().toString()
    assert "percent_rank" not in plan and "row_number" not in plan
    per = {tuple(r["part"]): r["n"] for r in S.cut_groups(frame, 500).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert len(per) >= 7 and max(per.values()) <= 700
