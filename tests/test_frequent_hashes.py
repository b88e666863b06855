"""Hashes that very many sequences have: rows as the greedy walk leaves them, without a row for each pair of holders."""

import random

from test_reduction import greedy

from strandline.operators import sequences as S


def test_frequent_hashes_make_no_row_for_each_pair(spark, monkeypatch):
    rng = random.Random(13)
    hot = range(12)
    rows = [("g", i, 1000 - i % 7, [*rng.sample(hot, 3), *range(100 + 30 * i, 130 + 30 * i)]) for i in range(300)]
    for i in range(300, 1500):
        own = [10_000 + 3 * i + j for j in range(rng.randrange(3))]
        rows.append(("g", i, rng.randrange(20, 60), sorted({*rng.sample(hot, rng.randrange(1, 6)), *own})))
    frame = spark.createDataFrame(rows, "grp string, id long, length int, sketch array<long>")
    written, kept = [], S.kept

    def counted(df):
        out = kept(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(S, "kept", counted)
    got = sorted(r["id"] for r in S.reduce_redundant(frame, 0.5).collect())
    first = {}
    for _, i, n, sketch in sorted(rows, key=lambda r: (-r[2], r[1])):
        first.setdefault(tuple(sorted(sketch)), (i, n, sketch))
    assert got == sorted(i for i, *_ in greedy(list(first.values()), 0.5)) and 300 < len(got) < 1400
    assert max(written) < 3 * sum(len(r[3]) for r in rows)


def test_thresholds_and_chains(spark):
    rng = random.Random(14)
    chain = [("c", i, 100 - i, [i, i + 1, 1000 + i]) for i in range(5)]  # each holds a third of the next
    some = [(f"x{i % 2}", i, rng.randrange(5), sorted(rng.sample(range(30), rng.randrange(1, 9)))) for i in range(80)]
    frame = spark.createDataFrame(chain + some, "grp string, id long, length int, sketch array<long>")
    for threshold in (0.3,):
        want = []
        for g in ("c", "x0", "x1"):
            first = {}
            for _, i, n, sketch in sorted((r for r in chain + some if r[0] == g), key=lambda r: (-r[2], r[1])):
                first.setdefault(tuple(sketch), (i, n, sketch))
            want += [(g, i) for i, *_ in greedy(list(first.values()), threshold)]
        assert sorted((r["grp"], r["id"]) for r in S.reduce_redundant(frame, threshold).collect()) == sorted(want)
