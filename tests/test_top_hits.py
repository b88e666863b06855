"""Top hits against a walk over the pairs of each query, and that covers are made once."""

import random

from test_intervals import by_comparison

from strandline.operators import hits as H

M8 = "qseqid long, sseqid string, pident double, length long, evalue double, qstart long, qend long, bitscore double, ord long"


def test_top_hits_of_queries_with_pairs_of_one_and_of_several(spark):
    rng = random.Random(15)
    rows = []
    for k in range(900):
        q = rng.randrange(150)
        b, n = rng.randrange(60), rng.randrange(5, 30)
        rows.append((q, f"A{rng.randrange(3 if q % 2 else 300)}.1", 95.0, 50, 0.0, b, b + n, rng.choice([None, 1.0, 2.0, 3.0]) if k % 40 == 0 else float(rng.randrange(1, 4)), k))
    rows.append((999, "A1.1", 95.0, 50, 0.0, 1, 9, None, 2000))
    acc = spark.createDataFrame([(f"A{i}", i) for i in range(0, 300, 3)], "accession string, taxid long")
    lineage = spark.createDataFrame([(i, i if i % 2 else None, 1 if i % 5 else None, None) for i in range(0, 300, 3)], "taxid long, species long, genus long, family long")
    spec = lambda s: (lambda i: 99 if i % 3 else 0 if i % 2 else 1 if i % 5 else 99)(int(s[1:-2]))
    pairs = {}
    for r in rows:
        pairs.setdefault((r[0], r[1]), []).append(r)
    best = []
    for q in {r[0] for r in rows}:
        own = []
        for (a, s), hsps in pairs.items():
            if a == q:
                cover = [hsps[k] for k in by_comparison([h[5] for h in hsps], [h[6] for h in hsps])]
                own.append((spec(s), None if any(h[7] is None for h in cover) else sum(h[7] for h in cover), cover))
        own = [x[1:] for x in own if x[0] == min(y[0] for y in own)]
        best += [c for x, c in own if x is not None and x == max(y for y, _ in own if y is not None)]
    n = {s: sum(c[0][1] == s for c in best) for s in {c[0][1] for c in best}}
    want = []
    for q in {c[0][0] for c in best}:
        want += [(h[0], h[1], h[8]) for h in min((c for c in best if c[0][0] == q), key=lambda c: (-n[c[0][1]], c[0][8]))]
    out = H.top_hit_nt(spark.createDataFrame(rows, M8), acc, lineage)
    assert sorted((r["qseqid"], r["sseqid"], r["ord"]) for r in out.collect()) == sorted(want)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()  # it was twice, over all pairs
