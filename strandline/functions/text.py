"""Columns over ids, headers and sequences, and the one function that Spark lacks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def read_id(header: Column) -> Column:
    """First word of a header, without > or @ and without a mate suffix."""
    return F.regexp_replace(F.regexp_extract(header, r"^[>@]?(\S*)", 1), r"/[12]$", "")


def annotated_read_id(header: Column) -> Column:
    """The id at the end of an annotated header NT:acc:NR:acc:id."""
    return F.element_at(F.split(header, ":", 5), -1)


def header_taxid(header: Column, field: str) -> Column:
    return F.regexp_extract(header, rf"(?:^|:){field}:(-?\d+)", 1).try_cast("long")


def gene_id(transcript: Column) -> Column:
    found = F.regexp_extract(transcript, r"(^|\|)(ENSG.*?)(\||$)", 2)
    return F.when(found == "", transcript).otherwise(found)


def guard_cell(text: Column) -> Column:
    """Text that a spreadsheet takes for no formula: ' is put before anything that begins with no letter or digit."""
    return F.when(text.rlike("^[A-Za-z0-9]"), text).otherwise(F.concat(F.lit("'"), text))


def unguard_cell(text: Column) -> Column:
    return F.regexp_replace(text, "^'", "")


def repair_header(header: Column) -> Column:
    """Each \\x01-separated part of a header without a comma right behind its accession."""
    return F.array_join(F.transform(F.split(header, "\x01"), lambda p: F.regexp_replace(p, r"^(\S+?),(?=\s|$)", "$1")), "\x01")


def called_share(sequence: Column) -> Column:
    return 1 - F.try_divide(F.length(sequence) - F.length(F.translate(sequence, "Nn", "")), F.length(sequence))


def low_quality_share(quality: Column, least: int, offset: int = 33) -> Column:
    """Share of bases whose phred score is below `least`."""
    scores = F.filter(F.split(quality, ""), lambda c: c != "")
    return F.try_divide(F.size(F.filter(scores, lambda c: F.ascii(c) - offset < least)), F.size(scores))


#: Fixed values of the length correction of the complexity score.
SLOPE, INTERCEPT = -0.113148, 1.043456


def complexity(sequence: Column, threshold_length: int = 150, cutoff: float = 0.45) -> Column:
    """Codes of a Lempel-Ziv-Welch compression per base; sequences longer than threshold_length are corrected for
    their length; empty ones and nulls score 0."""

    @F.pandas_udf("double")
    def score(s: pd.Series) -> pd.Series:
        def one(text: str | None) -> float:
            if not text:
                return 0.0
            text = text.upper()
            letters = text.encode("utf-32-le", "surrogatepass")
            longer: dict[int, int] = {}  # phrase and next letter -> phrase; phrases of one letter are that letter
            step, phrase, last = longer.get, -1, 0x110000
            for base in memoryview(letters).cast("I"):
                known = base if phrase < 0 else step(phrase << 21 | base)
                if known is None:
                    longer[phrase << 21 | base] = last
                    phrase, last = base, last + 1
                else:
                    phrase = known
            share = (len(longer) + 1) / len(text)
            return share if len(text) <= threshold_length else share + cutoff - (SLOPE * math.log(len(text)) + INTERCEPT)

        scores = {t: one(t) for t in s.unique()}  # equal texts once
        return s.map(scores)

    return score(sequence)


def stringified(*columns: str) -> list[Column]:
    """Columns as strings, numbers as Spark writes them and nulls as they are: how dimensions of metrics are given."""
    return [F.col(c).cast("string").alias(c) for c in columns]
