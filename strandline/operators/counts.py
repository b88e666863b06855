"""Counts of reads and bases by taxon and contig."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alignment as A
from strandline.functions import lineage as L
from strandline.operators.filters import taxon_filter
from strandline.operators.scalar import with_row

MIN_CONTIG_READS = 4


def _cluster_sizes(reads: DataFrame, clusters: DataFrame | None, read: str = "read_id") -> DataFrame:
    """reads with `cluster_size`: that of its id or of its id without /1 or /2; without clusters 1; the job fails for a
    read that is in none."""
    if clusters is None:
        return reads.withColumn("cluster_size", F.lit(1).cast("long"))
    exact = clusters.select(F.col("read_id").alias("__id"), F.col("size").alias("__size"))
    bare = clusters.select(F.col("read_id").alias("__bare"), F.col("size").alias("__bare_size"))
    out = reads.join(exact, F.col(read) == F.col("__id"), "left").join(bare, F.regexp_replace(read, "/[12]$", "") == F.col("__bare"), "left")
    size = F.coalesce("__size", "__bare_size", F.raise_error(F.concat(F.lit("read in no cluster: "), F.col(read))).cast("long"))
    return out.withColumn("cluster_size", size).drop("__id", "__size", "__bare", "__bare_size")


def taxon_counts(hits: DataFrame, lineage: DataFrame, count_type: str, clusters: DataFrame | None = None, allow: DataFrame | None = None, deny: DataFrame | None = None, drop_human: bool = True) -> DataFrame:
    """Counts by species, genus and family from called hits (read_id, taxid, pident, length, evalue, and, if there are
    any, base_count and source_count_type): one rollup of the filled lineage. The lists see the whole lineage, so a read
    counts at all its ranks or at none; human ones at none unless drop_human is false. Protein alignments are three times as long in merged counts."""
    rows = _cluster_sizes(hits, clusters)
    ranks = lineage.select(F.col("taxid").alias("__taxid"), "species", "genus", "family")
    rows = rows.join(ranks, F.col("taxid") == F.col("__taxid"), "left").drop("__taxid")
    s, g, f = L.with_nulls(F.col("species"), F.col("genus"), F.col("family"))
    rows = rows.withColumns({"species": s, "genus": g, "family": f})
    s, g, f = L.fill_lineage(F.col("species"), F.col("genus"), F.col("family"))
    rows = taxon_filter(rows.withColumns({"species": s, "genus": g, "family": f}), ["species", "genus", "family"], allow, deny, drop_human)
    source = F.col("source_count_type") if "source_count_type" in hits.columns else F.lit(None).cast("string")
    bases = F.col("base_count") if "base_count" in hits.columns else F.lit(0).cast("long")
    length = F.when((source == "NR") & F.lit(count_type == "merged_NT_NR"), F.col("length") * 3).otherwise(F.col("length"))
    rows = rows.withColumns({"__length": length, "__source": source, "__bases": bases, "__e": A.log10_evalue(F.col("evalue"))})
    counts = rows.rollup("family", "genus", "species").agg(
        F.grouping_id().alias("gid"), F.count("*").alias("unique_count"), F.sum("cluster_size").alias("nonunique_count"), F.sum("__bases").alias("base_count"),
        F.avg("pident").alias("percent_identity"), F.avg("__length").alias("alignment_length"), F.avg("__e").alias("e_value"), F.array_sort(F.collect_set("__source")).alias("source_count_type"),
    )
    level = F.when(F.col("gid") == 0, 1).when(F.col("gid") == 1, 2).otherwise(3)
    counts = counts.where("gid < 7").withColumn("tax_level", level)
    return counts.select(
        F.coalesce("species", "genus", "family").alias("tax_id"), "tax_level", F.coalesce("genus", F.lit(-200)).alias("genus_taxid"), F.col("family").alias("family_taxid"),
        F.col("nonunique_count").alias("count"), "nonunique_count", "unique_count", (F.col("nonunique_count") / F.col("unique_count")).alias("dcr"),
        "percent_identity", "alignment_length", "e_value", F.lit(count_type).alias("count_type"), "base_count", "source_count_type",
    )


def contig_summary(hits: DataFrame, read2contig: DataFrame, contig_lineage: DataFrame, db_type: str, clusters: DataFrame | None = None, min_reads: int = MIN_CONTIG_READS, allow: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """(taxid, tax_level, contig, n): reads per taxon and contig, at species (1) and genus (2). A read on a contig of
    known lineage counts for that lineage, any other for its own and for contig *. Contigs with fewer than min_reads
    unique reads are left out, * included; n counts duplicates too."""
    contigs = contig_lineage.select("contig_id", F.col("species").alias("__s"), F.col("genus").alias("__g"))
    placed = hits.join(read2contig.select("read_id", "contig_id"), "read_id", "left").join(contigs, "contig_id", "left")
    on = F.col("__s").isNotNull() & (F.col("contig_id") != "*")
    rows = placed.select("read_id", F.when(on, F.col("contig_id")).otherwise("*").alias("contig"), F.when(on, F.col("__s")).otherwise(F.col("species_taxid")).alias("species"), F.when(on, F.col("__g")).otherwise(F.col("genus_taxid")).alias("genus"))
    rows = _cluster_sizes(taxon_filter(rows, ["species", "genus"], allow, deny), clusters)
    both = rows.select("contig", "cluster_size", F.explode(F.array(F.struct(F.lit(1).alias("tax_level"), F.col("species").alias("taxid")), F.struct(F.lit(2).alias("tax_level"), F.col("genus").alias("taxid")))).alias("t"))
    counts = both.groupBy("t.taxid", "t.tax_level", "contig").agg(F.count("*").alias("__unique"), F.sum("cluster_size").alias("n"))
    return counts.where(F.col("__unique") >= min_reads).select("taxid", "tax_level", F.lit(db_type.upper()).alias("count_type"), "contig", "n")


def merge_contig_summaries(nt: DataFrame, nr: DataFrame) -> DataFrame:
    """Both summaries as one by taxid, protein contigs that the nucleotide summary has anywhere left out."""
    rest = nr.join(nt.select("contig").distinct(), "contig", "left_anti").select("taxid", "tax_level", "contig", "n")
    both = nt.select("taxid", "tax_level", "contig", "n").unionByName(rest)
    return both.groupBy("taxid", "tax_level", "contig").agg(F.sum("n").alias("n")).withColumn("count_type", F.lit("merged_NT_NR"))


def reads_per_contig(sam: DataFrame, clusters: DataFrame | None = None, min_reads: int = MIN_CONTIG_READS) -> DataFrame:
    """(contig_id, n_reads, n_unique, n_bases) over the first record of each read."""
    first = sam.withColumn("__k", F.row_number().over(Window.partitionBy("qname").orderBy("ord"))).where("__k = 1")
    rows = _cluster_sizes(first.select(F.col("qname").alias("read_id"), F.col("rname").alias("contig_id"), F.length("seq").cast("long").alias("bases")), clusters)
    counts = rows.groupBy("contig_id").agg(F.sum("cluster_size").alias("n_reads"), F.count("*").alias("n_unique"), F.sum("bases").alias("n_bases"))
    return counts.where(F.col("n_unique") >= min_reads)


def tally_lengths(hits: DataFrame, alignments: DataFrame, reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Species and genus by aligned and sequenced length: hits (read_id, contig_id, species, genus), alignments (read_id,
    length), reads and contigs (id, length). A read's longest alignment counts, a contig counts once."""
    longest = alignments.groupBy("read_id").agg(F.max("length").alias("aln"))
    rows = hits.join(longest, "read_id").join(reads.select(F.col("id").alias("read_id"), F.col("length").alias("read_length")), "read_id")
    rows = rows.join(contigs.select(F.col("id").alias("contig_id"), F.col("length").alias("contig_length")), "contig_id", "left")
    on = F.col("contig_id").isNotNull() & (F.col("contig_id") != "*")
    unit = F.when(on, F.concat(F.lit("c:"), F.col("contig_id").cast("string"))).otherwise(F.concat(F.lit("r:"), F.col("read_id").cast("string")))
    units = rows.groupBy(unit.alias("unit"), "species", "genus").agg(F.max("aln").alias("aln"), F.max(F.when(on, F.col("contig_length")).otherwise(F.col("read_length"))).alias("seq"))
    both = units.select("aln", "seq", F.explode(F.array(F.struct(F.lit("species").alias("level"), F.col("species").alias("taxid")), F.struct(F.lit("genus").alias("level"), F.col("genus").alias("taxid")))).alias("t"))
    return both.groupBy("t.level", "t.taxid").agg(F.coalesce(F.sum("aln"), F.lit(0)).alias("alignment_length"), F.coalesce(F.sum("seq"), F.lit(0)).alias("sequence_length"))


def per_million(counts: DataFrame, column: str, taxid: str = "tax_id") -> DataFrame:
    """counts of known taxa with `rpm`, at least 1, by the total of all rows, unknown taxa included."""
    total = counts.agg(F.sum(column).alias("__total"))
    rpm = F.greatest(F.lit(1.0), F.bround(F.col(column) * 1e6 / F.col("__total")))
    return with_row(counts, total).where(F.col(taxid) >= 0).withColumn("rpm", rpm).drop("__total")


def read_totals(reads: DataFrame, files: int = 1, clusters: DataFrame | None = None) -> DataFrame:
    """(reads, bases, fragments): reads (read_id, seq) of `files` mate files, counted with their duplicates if clusters
    (read_id, size) are given; a read that is in no cluster fails the job."""
    rows = _cluster_sizes(reads, clusters)
    return rows.agg(F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("reads"), F.coalesce(F.sum(F.length("seq") * F.col("cluster_size")), F.lit(0)).alias("bases"), F.coalesce(F.expr(f"sum(cluster_size) div {files}"), F.lit(0)).alias("fragments"))


def alignment_time(runs: DataFrame) -> DataFrame:
    """(sample, n_chunks, total) of runs (sample, chunk, seconds): the mean time of a chunk by the number of chunks."""
    return runs.groupBy("sample").agg(F.count("*").alias("n_chunks"), (F.avg("seconds") * F.count("*")).alias("total"))


def by_abundance(counts: DataFrame, reads: str = "unique_count", length: str = "alignment_length") -> DataFrame:
    """counts in descending order of reads and then of length."""
    return counts.orderBy(F.desc(reads), F.desc(length))


def all_counts(*frames: DataFrame) -> DataFrame:
    """The rows of all count lists."""
    return reduce(DataFrame.unionByName, frames)


def spike_in_counts(alignments: DataFrame) -> DataFrame:
    """Reads per spike-in target."""
    return alignments.where(F.col("rname").startswith("ERCC-")).groupBy(F.col("rname").alias("target")).agg(F.count("*").alias("n"))


def accessions_per_taxon(accessions: DataFrame) -> DataFrame:
    return accessions.groupBy("taxid").agg(F.count("*").alias("n"))
