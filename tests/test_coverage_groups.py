"""Groups of hits against one made hit by hit."""

import math
import random

from strandline.operators import coverage as V

SCHEMA = "key string, length long, is_contig boolean, subject_start long, subject_end long, alignment_length long, percent_id double, mismatches long, gaps long, num_reads long, first_byte long, last_byte long"


def hit_by_hit(rows, max_bins):
    groups = {}
    for k, r in enumerate(rows):
        key, length, contig, s, t = r[:5]
        size = length / min(length, max_bins)
        low, high = min(s, t) - 1, max(s, t)
        groups.setdefault((key, ("alone", k) if high - low >= size else ("bin", math.floor((low + high) / 2 / size))), []).append(r)
    out = []
    for (key, (kind, _)), own in groups.items():
        contigs, seen = [r for r in own if r[2]], {}
        for r in contigs:
            seen.setdefault((r[10], r[11]), r[9])
        first, last = min(min(r[3:5]) for r in own), max(max(r[3:5]) for r in own)
        size = own[0][1] / min(own[0][1], max_bins)
        means = [round(sum(r[c] for r in own) / len(own), 9) for c in (5, 6, 7, 8)]
        out.append((key, kind == "alone", len(contigs), len(own) - len(contigs), sum(seen.values()), first, last, *means, math.floor((first - 1 + last) / 2 / size), sorted(seen)))
    return sorted(out)


def test_groups(spark):
    rng = random.Random(14)
    rows = []
    for _ in range(800):
        key = rng.choice("abc")
        length = {"a": 1000, "b": 37, "c": 5}[key]
        s = rng.randrange(1, length)
        t = min(length, s + rng.choice([0, 3, 9, 49, 50, 51, 200]))  # bins of "a" have 50 bases
        contig = rng.random() < 0.4
        b = rng.randrange(6) * 100
        rows.append((key, length, contig, *((s, t) if rng.random() < 0.5 else (t, s)), t - s + 1, 90.0 + rng.randrange(10), rng.randrange(4), rng.randrange(2), b // 100 + 1 if contig else None, b if contig else None, b + 99 if contig else None))
    rows.append(("none", 0, False, 1, 2, 2, 99.0, 0, 0, None, None, None))
    got = V.coverage_groups(spark.createDataFrame(rows, SCHEMA).repartition(3), 20)
    plain = [(r["key"], r["alone"], r["n_contigs"], r["n_reads"], r["contig_reads"], r["first"], r["last"], *(round(r[c], 9) for c in V.AVERAGED), r["bin"], [tuple(x) for x in r["byte_ranges"]]) for r in got.collect()]
    assert sorted(plain) == hit_by_hit(rows[:-1], 20)
