"""Whole compression runs of a reference: sequences by taxon, longest first, reduced taxon by taxon, and shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import sequences as S


def sketched(reads: DataFrame, group: str | None, k: int = 31, scaled: int = 1000, seed: int = 42, dna: bool = True) -> DataFrame:
    """reads (read_id, seq and others) as sequences with their sketches, of one group where `group` is None."""
    grp = F.lit(0) if group is None else F.col(group)
    return reads.select(*(c for c in reads.columns if c not in ("grp", "id", "length", "sketch")), grp.alias("grp"), F.col("read_id").alias("id"), F.coalesce(F.length("seq"), F.lit(0)).alias("length"), S.sketch(F.col("seq"), k, scaled, seed, dna).alias("sketch"))


def _whole(reads: DataFrame, left: DataFrame, *more: str) -> DataFrame:
    """The reads that are left (read_id, __text and `more`), with `more`. Reductions carry a hash of the text instead of it, so
    that texts are shuffled once."""
    ids = left.select(F.col("read_id").alias("__id"), F.col("__text").alias("__same"), *more).distinct()
    same = F.col("read_id").eqNullSafe(F.col("__id")) & (F.xxhash64("seq") == F.col("__same"))
    return reads.join(ids, same).select(*reads.columns, *more)


def _without_text(rows: DataFrame) -> DataFrame:
    return rows.select("read_id", F.xxhash64("seq").alias("__text"), "grp", "id", "length", "sketch")


def compressed_unsplit(reads: DataFrame, threshold: float = 0.5, large: int = S.LARGE, **how) -> DataFrame:
    """reads reduced all together, whatever taxa they are of."""
    return _whole(reads, S.reduce_all(_without_text(sketched(reads, None, **how)), threshold, large))


def compressed_by_taxon(reads: DataFrame, accessions: DataFrame, threshold: float = 0.5, large: int = S.LARGE, shuffle: int | None = 42, **how) -> DataFrame:
    """reads reduced within their taxa (those of unknown accessions are one), with accession and taxid, in an order that
    depends on their ids and the seed `shuffle` alone, or in none."""
    rows = S.by_taxon(_without_text(sketched(reads, None, **how)), accessions).withColumn("grp", F.col("taxid"))
    left = _whole(reads, S.reduce_all(rows, threshold, large), "accession", "taxid")
    return left if shuffle is None else S.shuffled(left, shuffle)
