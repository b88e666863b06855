"""Columns for accessions and lineages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.schemas import ARTIFICIAL, NULL_FAMILY, NULL_GENUS, NULL_SPECIES


def strip_version(accession: Column) -> Column:
    return F.substring_index(accession, ".", 1)


def bump_version(accession: Column) -> Column:
    """The next version of an accession; one without a version gets 1."""
    base, version = strip_version(accession), F.regexp_extract(accession, r"\.(\d+)$", 1)
    return F.concat(base, F.lit("."), (F.coalesce(version.try_cast("int"), F.lit(0)) + 1).cast("string"))


def with_nulls(species: Column, genus: Column, family: Column) -> tuple[Column, Column, Column]:
    return F.coalesce(species, F.lit(NULL_SPECIES)), F.coalesce(genus, F.lit(NULL_GENUS)), F.coalesce(family, F.lit(NULL_FAMILY))


def fill_lineage(species: Column, genus: Column, family: Column) -> tuple[Column, Column, Column]:
    """Missing ranks below a known one become artificial taxids: minus (level * 1e8 + nearest known ancestor)."""

    def missing(c: Column) -> Column:
        return (c < 0) & (c > -ARTIFICIAL)

    g = F.when(missing(genus) & (family >= 0), -2 * ARTIFICIAL - family).otherwise(genus)
    s = F.when(missing(species) & (genus >= 0), -ARTIFICIAL - genus).when(missing(species) & (family >= 0), -ARTIFICIAL - family).otherwise(species)
    return s, g, family


def specificity(species: Column, genus: Column, family: Column, none: int = 99) -> Column:
    """Index of the first rank that is known, from species up."""
    return F.when(species > 0, 0).when(genus > 0, 1).when(family > 0, 2).otherwise(none)


def is_phage(family: Column, name: Column, phage_families: list[str]) -> Column:
    return F.coalesce(family.isin(phage_families), F.lit(False)) | F.coalesce(name.rlike(r"(?i)\bphage\b"), F.lit(False))
