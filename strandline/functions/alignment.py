"""Columns over alignments: scores, coordinates, flags."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the scoring model: lambda, K, and the size of the searched database.
LAMBDA, K, DATABASE = 1.58, 0.1, 832_400_799_511
SMALLEST_EVALUE = 2.0**-1022


def _raw_score(alen: Column, mismatches: Column) -> Column:
    return alen - 2 * mismatches


def bitscore(alen: Column, mismatches: Column) -> Column:
    return F.bround((_raw_score(alen, mismatches) * LAMBDA - math.log(K)) / math.log(2), 3)


def evalue(alen: Column, mismatches: Column) -> Column:
    return K * alen * DATABASE * F.exp(-LAMBDA * F.greatest(_raw_score(alen, mismatches), F.lit(0)))


def gap_openings(cigar: Column) -> Column:
    return F.length(F.regexp_replace(cigar, "[^ID]", "")).cast("long")


def log10_evalue(e: Column) -> Column:
    return F.log10(F.greatest(e, F.lit(SMALLEST_EVALUE)))


def valid(length: Column, pident: Column, e: Column, min_length: int = 0, min_pident: float = -0.25, max_evalue: float = 1.0) -> Column:
    return (length >= min_length) & (pident > min_pident) & (pident < 100.25) & ~F.isnan(e) & (e <= max_evalue)


def has_flags(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(mask) == mask


def lacks_flags(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(mask) == 0


def clip_percent(cigar: Column, length: Column) -> Column:
    """Clipped share of a read, in percent; hard clips aren't part of the stored length."""
    front = F.regexp_extract(cigar, r"^(\d+)[SH]", 1).try_cast("long")
    end = F.regexp_extract(cigar, r"(\d+)[SH]$", 1).try_cast("long")
    hard_front = F.regexp_extract(cigar, r"^(\d+)H", 1).try_cast("long")
    hard_end = F.regexp_extract(cigar, r"(\d+)H$", 1).try_cast("long")
    zero = F.lit(0)
    total = length + F.coalesce(hard_front, zero) + F.coalesce(hard_end, zero)
    return F.try_divide(F.coalesce(front, zero) + F.coalesce(end, zero), total) * 100


def normal(start: Column, end: Column) -> tuple[Column, Column]:
    return F.least(start, end), F.greatest(start, end)


def linear(x: Column, from_low: Column, from_high: Column, to_low: Column, to_high: Column) -> Column:
    """x of one interval carried over to another."""
    return to_low + F.try_divide((x - from_low) * (to_high - to_low), from_high - from_low)


def round_adaptive(x: Column) -> Column:
    """Fewer decimals the larger x is: 3 below 0.1, 2 below 1, otherwise 1."""
    return F.when(x < 0.1, F.bround(x, 3)).when(x < 1, F.bround(x, 2)).otherwise(F.bround(x, 1))
