"""Compression runs shuffle no texts but those that are left, and tell rows of one id apart as before."""

import random

from strandline.operators import reduction as R
from strandline.operators import sequences as S


def test_texts_are_not_carried_through_the_reduction(spark, monkeypatch):
    rng = random.Random(16)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    one, two = letters(400), letters(400)
    reads = [("A1.1", one), ("A2.1", one[:200]), ("B1.1", two), ("B1.1", two), ("B2.1", two[:300]), ("U1.1", letters(5)), ("U2.1", None), (None, None)]
    frame = spark.createDataFrame(reads, "read_id string, seq string")
    accessions = spark.createDataFrame([("A1", 7), ("A2", 7), ("B1", 8), ("B2", 8)], "accession string, taxid long")
    columns, kept = [], S.kept
    monkeypatch.setattr(S, "kept", lambda df: columns.append(df.columns) or kept(df))
    got = R.compressed_by_taxon(frame, accessions, k=15, scaled=4)
    assert got.columns == ["read_id", "seq", "accession", "taxid"] and columns and not any("seq" in c for c in columns)
    want = [("A1.1", one, 7), ("B1.1", two, 8), ("B1.1", two, 8), ("U1.1", reads[5][1], 0), ("U2.1", None, 0), (None, None, 0)]
    assert sorted(((r["read_id"], r["seq"], r["taxid"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert R.compressed_unsplit(frame, k=15, scaled=4).columns == ["read_id", "seq"]
