"""Whole analyses as one lazy plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import counts, hits, merge, taxonomy


def side_counts(m8: DataFrame, acc2tax: DataFrame, lineage: DataFrame, count_type: str, min_length: int, clusters: DataFrame | None = None, allow: DataFrame | None = None, deny: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(called hits, taxon counts) of one reference database."""
    called = hits.call_hits(m8, acc2tax, lineage, min_length, allow, deny).withColumnRenamed("qseqid", "read_id")
    return called, counts.taxon_counts(called, lineage, count_type, clusters, allow, deny)


def short_read(nt: DataFrame, nr: DataFrame, acc2tax: DataFrame, lineage: DataFrame, read2contig: DataFrame, nt_top: DataFrame, nr_top: DataFrame, clusters: DataFrame | None = None) -> dict[str, DataFrame]:
    """Alignments of reads to both databases, refined by their contigs' top hits (contig_id, taxa, pident, length, evalue),
    and merged: counts of each and of both. Reads on contigs count with their contig's alignment, also those without an own."""
    out: dict[str, DataFrame] = {}
    sides = {}
    for name, m8, top, least in (("NT", nt, nt_top, 36), ("NR", nr, nr_top, 0)):
        called, out[name] = side_counts(m8, acc2tax, lineage, name, least, clusters)
        refined = merge.refine_hits(called, read2contig, top).drop("source")
        by_contig = F.col("contig_id").isNotNull()
        own = merge.refined_m8(called.select("read_id", "pident", "length", "evalue"), refined, read2contig, top.select("contig_id", "pident", "length", "evalue"))
        sides[name] = refined.join(own, "read_id", "left").withColumn("contig_species_taxid", F.when(by_contig, F.col("species_taxid")))
    merged = merge.merge_nt_nr(sides["NT"], sides["NR"])
    out["merged_NT_NR"] = counts.taxon_counts(merged, lineage, "merged_NT_NR", clusters)
    return out


def long_read(m8: DataFrame, read2contig: DataFrame, acc2tax: DataFrame, lineage: DataFrame) -> DataFrame:
    """Contigs and loose reads aligned together: top hits, one alignment each, carried to the reads."""
    top = hits.contig_synthesis(hits.top_hit_nt(m8, acc2tax, lineage))
    placed = hits.with_lineage(hits.with_taxid(top, acc2tax), lineage)
    return merge.contig_fanout(placed, read2contig)


def index(nodes: DataFrame, names: DataFrame, previous: DataFrame, version: str) -> dict[str, DataFrame]:
    """Taxonomy dumps and the previous release to lineages, their versions and what has changed."""
    paths = taxonomy.lineage_paths(nodes)
    wide = taxonomy.wide_lineages(paths)
    scientific = names.where("name_class = 'scientific name'").select("tax_id", F.col("name_txt").alias("name"))
    current = wide.select(F.col("tax_id").alias("taxid"), "species", "genus", "family")
    common = names.where("name_class = 'genbank common name'").groupBy("tax_id").agg(F.min("name_txt").alias("common_name"))
    named = taxonomy.name_ranks(wide, scientific, ("species", "genus", "family")).join(common, "tax_id", "left").fillna("", ["common_name"])
    return {"lineages": wide, "named": named, "versions": taxonomy.version_lineages(previous, current, version), "changes": taxonomy.lineage_changes(previous, current, ["family", "genus", "species"])}
