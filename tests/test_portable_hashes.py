"""MD5 of k-mers many at once against hashlib."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import sequences as S


def _plain(text, k, seed):
    return {int.from_bytes(hashlib.md5(f"{seed}:{text[i : i + k]}".encode()).digest()[:8], "big") >> 12 for i in range(len(text) - k + 1)}


@pytest.mark.parametrize("k, seed", [(1, 7), (20, 42), (52, 42), (53, 42), (60, 123456)])
def test_many_texts_at_once(k, seed):
    rng = random.Random(k)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "aé", "a日𝄞") for n in (0, 1, 19, 20, 21, 52, 53, 400, 40_000)]
    rng.shuffle(texts)
    for text, got in zip(texts, S._block_hashes(texts, k, seed), strict=True):
        assert set(got.tolist()) == _plain(text, k, seed)


def test_digests_are_not_taken_one_by_one(spark, monkeypatch):
    """Of texts whose k-mers are one block of MD5, hashlib sees none."""

    def refused(*_, **__):
        raise AssertionError("one by one")

    text = "words of a text, " * 50
    want = sorted(h for h in _plain(text, 20, 42) if h < S.HASHES // 50)
    monkeypatch.setattr(S.hashlib, "md5", refused)
    assert np.unique(S._portable_hashes(text, 20, 42, False)).tolist()[: len(want)] == want
    rows = spark.createDataFrame([(text,), (None,), ("short",)], "t string")
    assert [r["s"] for r in rows.select(S.sketch(F.col("t"), 20, 50, dna=False, portable=True).alias("s")).collect()] == [want, [], []]
