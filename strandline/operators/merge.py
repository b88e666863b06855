"""Contig results carried to reads, and the merge of nucleotide and protein results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contig_fanout(hits: DataFrame, read2contig: DataFrame) -> DataFrame:
    """A row for each read of a hit's contig, with its id as read_id; a contig without reads stands for itself."""
    members = read2contig.where("contig_id <> '*'").select(F.col("contig_id").alias("qseqid"), F.col("read_id").alias("__read"))
    return hits.join(members, "qseqid", "left").withColumn("read_id", F.coalesce("__read", F.col("qseqid").cast("string"))).drop("__read")


def refine_hits(hits: DataFrame, read2contig: DataFrame, contig_top: DataFrame) -> DataFrame:
    """Reads' hits (read_id, taxid, accession_id, species_taxid, genus_taxid, family_taxid) updated by their contigs' top
    hits (contig_id and the same columns). A read on a contig takes its contig's taxa; one that had none is added; one on
    a contig without top hit, or on none, keeps its own."""
    ranks = ("taxid", "accession_id", "species_taxid", "genus_taxid", "family_taxid")
    contigs = contig_top.select("contig_id", *(F.col(c).alias(f"contig_{c}") for c in ranks), F.lit(True).alias("__hit"))
    placed = read2contig.where("contig_id <> '*'").select("read_id", "contig_id").join(contigs, "contig_id")
    out = hits.withColumn("__own", F.lit(True)).join(placed, "read_id", "full_outer")
    on = F.coalesce("__hit", F.lit(False))
    pick: dict[str, Column] = {c: F.when(on, F.col(f"contig_{c}")).otherwise(F.col(c)) for c in ranks}
    source = F.when(on & F.col("__own").isNull(), "added").when(on, "from_assembly").otherwise("read")
    return out.select("read_id", "contig_id", *(v.alias(c) for c, v in pick.items()), source.alias("source"))


def refined_m8(m8: DataFrame, hits: DataFrame, read2contig: DataFrame, contig_m8: DataFrame) -> DataFrame:
    """Alignments of reads (read_id and others) with those of their contigs in their place: a read on a contig takes the
    row of contig_m8 (contig_id and the same others), also one that only refined hits (read_id) have; any other its own."""
    values = [c for c in m8.columns if c != "read_id"]
    contigs = contig_m8.select("contig_id", F.struct(*values).alias("__contig"))
    placed = read2contig.where("contig_id <> '*'").select("read_id", "contig_id").join(contigs, "contig_id").select("read_id", "__contig")
    rows = hits.select("read_id").join(m8.select("read_id", F.struct(*values).alias("__own")), "read_id", "left").join(placed, "read_id", "left")
    return rows.select("read_id", F.coalesce("__contig", "__own").alias("m")).select("read_id", "m.*")


def hits_with_m8(hits: DataFrame, m8: DataFrame) -> DataFrame:
    """Hit summary and alignments side by side (both with read_id, each read once); the job fails for a read that only one
    of them has, or that either has twice."""
    once = lambda df, name: df.groupBy("read_id").agg(F.count("*").alias(f"__n_{name}"), F.first(F.struct(*[c for c in df.columns if c != "read_id"])).alias(name))
    both = once(hits, "__h").join(once(m8, "__m"), "read_id", "full_outer")
    fine = F.coalesce((F.col("__n___h") == 1) & (F.col("__n___m") == 1), F.lit(False))
    checked = F.when(fine, F.col("read_id")).otherwise(F.raise_error(F.concat(F.lit("read without its row: "), F.col("read_id").cast("string"))).cast(hits.schema["read_id"].dataType))
    return both.select(checked.alias("read_id"), "__h.*", "__m.*")


def merge_nt_nr(nt: DataFrame, nr: DataFrame) -> DataFrame:
    """One row per read of either result (read_id, contig_species_taxid, species_taxid and others): the nucleotide row if
    it has a contig hit, or if it has a read hit and the protein row has no contig hit; otherwise the protein row. Null
    is no hit; artificial taxids are hits."""
    a = nt.select("read_id", F.struct(*[c for c in nt.columns if c != "read_id"]).alias("__nt"))
    b = nr.select("read_id", F.struct(*[c for c in nt.columns if c != "read_id"]).alias("__nr"))
    both = a.join(b, "read_id", "full_outer")
    has = lambda side, c: F.col(side).isNotNull() & F.col(f"{side}.{c}").isNotNull()
    use_nt = has("__nt", "contig_species_taxid") | (has("__nt", "species_taxid") & ~has("__nr", "contig_species_taxid"))
    use_nt = use_nt | F.col("__nr").isNull()
    best = F.when(use_nt, F.col("__nt")).otherwise(F.col("__nr"))
    return both.select("read_id", best.alias("r"), F.when(use_nt, "NT").otherwise("NR").alias("source_count_type")).select("read_id", "r.*", "source_count_type")


def annotate_reads(reads: DataFrame, nt: DataFrame, nr: DataFrame) -> DataFrame:
    """reads (read_id, seq) with their accessions of both results, an annotated header and whether they are mapped."""
    one = nt.groupBy("read_id").agg(F.min("accession_id").alias("nt_accession"))
    two = nr.groupBy("read_id").agg(F.min("accession_id").alias("nr_accession"))
    out = reads.join(one, "read_id", "left").join(two, "read_id", "left")
    none = F.lit("")
    header = F.concat(F.lit("NR:"), F.coalesce("nr_accession", none), F.lit(":NT:"), F.coalesce("nt_accession", none), F.lit(":"), F.col("read_id").cast("string"))
    return out.withColumns({"header": header, "mapped": F.coalesce("nt_accession", "nr_accession").isNotNull()})


def taxid_headers(reads: DataFrame, nt_hits: DataFrame, nr_hits: DataFrame) -> DataFrame:
    """reads (read_id, header) with the lineages of both results put before the header; null ranks as -100, -200, -300."""
    out = reads
    for side, hits in (("nr", nr_hits), ("nt", nt_hits)):
        out = out.join(hits.select("read_id", *(F.col(f"{r}_taxid").alias(f"__{r}_{side}") for r in ("family", "genus", "species"))), "read_id", "left")
    parts = [F.concat(F.lit(f"{r}_{side}:"), F.coalesce(F.col(f"__{r}_{side}"), F.lit(null)).cast("string")) for r, null in (("family", -300), ("genus", -200), ("species", -100)) for side in ("nr", "nt")]
    return out.select(*reads.columns, F.concat_ws(":", *parts, "header").alias("taxid_header"))


def unmapped_reads(reads: DataFrame, read2contig: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads that are in hits neither themselves nor by their contig (hits.id)."""
    rest = reads.join(read2contig.select("read_id", "contig_id"), "read_id", "left")
    rest = rest.join(hits.select(F.col("id").alias("__id")), F.col("read_id") == F.col("__id"), "left_anti")
    return rest.join(hits.select(F.col("id").alias("__id")), F.col("contig_id") == F.col("__id"), "left_anti").select(*reads.columns)


def step_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """(step, a, b): the counts of two runs side by side, null where a run lacks the step."""
    return a.select("step", F.col("count").alias("a")).join(b.select("step", F.col("count").alias("b")), "step", "full_outer")


def table_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, change): keys that were added, removed or have other values; rows are compared by digest."""
    digest = lambda df: F.md5(F.to_json(F.struct(*sorted(c for c in df.columns if c != key)), {"ignoreNullFields": "false"}))
    both = a.select(key, digest(a).alias("__a")).join(b.select(key, digest(b).alias("__b")), key, "full_outer")
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed")
    return both.select(key, change.alias("change")).where("change is not null")


def last_wins(key: str, *frames: DataFrame) -> DataFrame:
    """The rows of all frames, of each key those of the last frame that has it."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f.select(key).distinct(), key, "left_anti").unionByName(f)
    return out


def lost_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids of before that after lacks, as often as they were there."""
    return before.join(after.select("id").distinct(), "id", "left_anti")


def relabelled(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """rows with `column` replaced by the name that names (id, name) has for it, if any."""
    known = names.select(F.col("id").alias("__id"), F.col("name").alias("__name"))
    return rows.join(known, F.col(column) == F.col("__id"), "left").withColumn(column, F.coalesce("__name", column)).drop("__id", "__name")


def changed_taxa_report(report: DataFrame, changes: DataFrame, fields: list[str]) -> DataFrame:
    """Taxa of a report whose lineage changed in one of the fields."""
    return report.join(changes.where(F.col("field").isin(fields)), "taxid")
