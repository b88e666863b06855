"""Searches of sketch trees against comparisons with all."""

import random

import pytest

from strandline.operators import sketch_tree as ST


def sketches(rng, n, families=12):
    base = [rng.sample(range(1 << 20), 30) for _ in range(families)]
    for i in range(n):
        if i % 17 == 0:
            yield i, []
        else:
            own = rng.sample(base[i % families], rng.randrange(3, 30)) + rng.sample(range(1 << 20), rng.randrange(0, 9))
            yield i, sorted(set(own))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = list(sketches(rng, 400))
    return out + [(1000 + k, s) for k, (_, s) in enumerate(out[:40])] + [(2000, None)]


@pytest.mark.parametrize("fanout, buckets, threshold", [(2, 0, 0.9), (16, 0, 0.3), (5, 64, 0.3), (16, 4096, 0.9), (1000, 0, 0.5)])
def test_searches_find_what_comparisons_find(spark, rows, fanout, buckets, threshold):
    frame = spark.createDataFrame(rows, "id long, sketch array<long>").repartition(3)
    queries = frame.where("id % 7 = 0").withColumnRenamed("id", "query")
    tree = ST.build(frame, fanout, buckets)
    got = ST.contained(tree, queries.unionByName(queries.limit(5)), threshold).collect()
    want = {}
    for q, a in rows:
        if q % 7 == 0 and a:
            for i, b in rows:
                n = len(set(a) & set(b or []))
                if n >= threshold * len(a):
                    want[q, i] = (n, n / len(a))
    assert {(r["query"], r["id"]): (r["shared"], r["containment"]) for r in got} == want and len(got) == len(want)


def test_searches_enter_few_nodes_and_levels_are_bounded(spark, rows):
    frame = spark.createDataFrame([r for r in rows if r[1]], "id long, sketch array<long>")
    n = frame.count()
    tree = ST.build(frame, 4)
    assert len(tree.levels) == 5 and all(level.groupBy("node").count().count() == -(-n // 4**k) for k, level in enumerate(tree.levels))
    queries = frame.where("id % 50 = 3").withColumnRenamed("id", "query")
    _, entered = ST.visited(tree, queries, 0.9)
    assert sum(e.count() for e in entered) < 0.5 * n * queries.count()


def test_empty_tree(spark):
    none = spark.createDataFrame([], "id long, sketch array<long>")
    tree = ST.build(none)
    assert not ST.contained(tree, spark.createDataFrame([(1, [5])], "query long, sketch array<long>")).collect()


def test_filters_of_large_subtrees_are_sparse(spark):
    """What the upper levels enter doesn't grow with what else they hold."""
    rng = random.Random(5)
    frame = spark.createDataFrame([(i, sorted(rng.sample(range(1 << 40), 30))) for i in range(600)], "id long, sketch array<long>")
    queries = frame.where("id % 60 = 0").withColumnRenamed("id", "query")
    _, entered = ST.visited(ST.build(frame, 4, 64), queries, 0.9)
    assert [e.count() for e in entered] == [10] * 5
