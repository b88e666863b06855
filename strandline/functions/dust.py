"""Symmetric DUST: low-complexity stretches of sequences by their repeated triplets.

An interval of triplets scores the pairs of equal triplets in it per triplet but one. It is perfect if it scores more than
SCORE and no interval within it scores more. What perfect intervals cover, in windows of WINDOW bases, is masked; letters
other than ACGT part a sequence. The mask doesn't depend on where a window begins, nor on the strand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW, SCORE = 64, 2.0
#: Letters that are searched at once.
_CHUNK = 1 << 16

_CODE = np.full(256, 4, np.int16)
for _k, _letter in enumerate("ACGT"):
    _CODE[ord(_letter)] = _CODE[ord(_letter.lower())] = _k


def window_score(sequence: Column) -> Column:
    """The score of a whole sequence as one interval, for sequences of a window's length; null below four letters. Letters
    are taken as they are."""
    triplets = F.transform(F.sequence(F.lit(1), F.length(sequence) - 2), lambda i: F.substring(sequence, i, F.lit(3)))
    same = lambda x: F.size(F.filter(triplets, lambda y: y == x)).cast("long")
    pairs = F.aggregate(F.array_distinct(triplets), F.lit(0).cast("long"), lambda n, x: n + (same(x) * (same(x) - 1) / 2).cast("long"))
    return F.when(F.length(sequence) >= 4, pairs / (F.length(sequence) - 3))


def marked(letters: np.ndarray, window: int = WINDOW, score: float = SCORE) -> np.ndarray:
    """Which letters (bytes) are masked. Interval sizes grow one by one, each for all begins at once: pairs follow from those
    of one triplet less, and the best score within from the two intervals of one triplet less."""
    code, n = _CODE[letters], len(letters)
    out = np.zeros(n + 1, np.int32)
    m = n - 2
    if m < 2:
        return out[:n] > 0
    known = (code[:-2] < 4) & (code[1:-1] < 4) & (code[2:] < 4)
    triplet = code[:-2] * 16 + code[1:-1] * 4 + code[2:]
    stop = np.where(known, m, np.arange(m))  # the first unknown triplet from here on
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    pairs, equal, best = np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m)
    for size in range(2, min(window - 2, m) + 1):
        d = size - 1
        equal[d:] += triplet[d:] == triplet[:-d]
        k = m - d
        pairs = pairs[:k] + equal[d:]
        here = np.where(stop[:k] >= np.arange(size, k + size), pairs / d, -1.0)
        inner = np.maximum(best[:k], best[1 : k + 1])
        begin = np.flatnonzero((here > score) & (here >= inner))
        np.add.at(out, begin, 1)
        np.add.at(out, begin + size + 2, -1)
        best = np.maximum(inner, here)
    return np.cumsum(out)[:n] > 0


def _marks(texts: list[str], window: int, score: float) -> Iterator[np.ndarray]:
    """The mask of each text; several short ones are searched together, parted by letters that part sequences."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= _CHUNK):
            held += len(texts[end]) + 1
            end += 1
        raw = "\n".join(texts[at:end]).encode("ascii", "replace")
        mask = marked(np.frombuffer(raw, np.uint8), window, score)
        begin = 0
        for t in texts[at:end]:
            yield mask[begin : begin + len(t)]
            begin += len(t) + 1
        at = end


def unmasked_share(sequence: Column, window: int = WINDOW, score: float = SCORE) -> Column:
    """The share of a sequence that isn't masked; 0 of an empty sequence and of null."""

    @F.pandas_udf("double")
    def share(s: pd.Series) -> pd.Series:
        texts = s.fillna("").tolist()
        return pd.Series([1 - m.sum() / len(m) if len(m) else 0.0 for m in _marks(texts, window, score)], dtype="float64")

    return share(sequence)


def masked(sequence: Column, window: int = WINDOW, score: float = SCORE) -> Column:
    """sequence with N for its masked letters; null remains null."""

    @F.pandas_udf("string")
    def mask(s: pd.Series) -> pd.Series:
        texts = s.fillna("").tolist()
        out = ["".join(np.where(m, "N", list(t))) if m.any() else t for t, m in zip(texts, _marks(texts, window, score), strict=True)]
        return pd.Series(out, dtype="object").where(s.notna().to_numpy(), None)

    return mask(sequence)


def neighbour_share(sequence: Column) -> Column:
    """The share of letters that differ from the next one, by which long reads are judged; 0 of fewer than two letters and
    of null. A run of equal letters counts its length but one, so no letter is looked at alone."""
    runs = F.aggregate(F.regexp_extract_all(sequence, F.lit(r"((.)\2+)"), F.lit(1)), F.lit(0), lambda n, r: n + F.length(r) - 1)
    return F.when(F.length(sequence) > 1, (F.length(sequence) - 1 - runs) / (F.length(sequence) - 1)).otherwise(F.lit(0.0))
