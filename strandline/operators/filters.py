"""Filters of alignments, taxa and reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import alignment as A
from strandline.functions import dust as D
from strandline.functions import text as X
from strandline.operators.scalar import kept, with_row
from strandline.schemas import HUMAN


def valid_alignments(m8: DataFrame, min_length: int = 0) -> DataFrame:
    return m8.where(A.valid(F.col("length"), F.col("pident"), F.col("evalue"), min_length))


def nucleotide_hsps(m8: DataFrame, min_length: int = 36, min_pident: float = 80.0, max_evalue: float = 1.0) -> DataFrame:
    return m8.where((F.col("length") >= min_length) & (F.col("pident") >= min_pident) & ~F.isnan("evalue") & (F.col("evalue") <= max_evalue))


def taxon_filter(df: DataFrame, columns: list[str], allow: DataFrame | None = None, deny: DataFrame | None = None, drop_human: bool = True) -> DataFrame:
    """Rows of which some taxid in columns is on the allow list, if there is one, and none is denied, or human unless
    drop_human is false; negative and null taxids match no list. The lists are one-column frames; they are joined, so they may be of any size."""
    known = [F.when(F.col(c) >= 0, F.col(c)) for c in columns]
    human = reduce(lambda a, b: a | b, (F.coalesce(k.isin(*HUMAN), F.lit(False)) for k in known))
    out = df.where(~human) if drop_human else df
    if deny is not None:
        ids = deny.select(F.col(deny.columns[0]).alias("__taxid")).where("__taxid >= 0").distinct()
        for c in columns:
            out = out.join(ids, F.col(c) == F.col("__taxid"), "left_anti")
    if allow is not None:
        ids = allow.select(F.col(allow.columns[0]).alias("__taxid")).where("__taxid >= 0").distinct()
        flags = []
        for k, c in enumerate(columns):
            flag = f"__allowed{k}"
            out = out.join(ids.withColumnRenamed("__taxid", f"__t{k}").withColumn(flag, F.lit(True)), F.col(c) == F.col(f"__t{k}"), "left").drop(f"__t{k}")
            flags.append(flag)
        out = out.where(F.coalesce(*flags, F.lit(False))).drop(*flags)
    return out


def clipped_to_unmapped(sam: DataFrame, max_percent: float = 20.0) -> DataFrame:
    """Alignments clipped by max_percent or more become unmapped records of the same read."""
    bad = A.clip_percent(F.col("cigar"), F.length("seq").cast("long")) >= max_percent
    keep: dict[str, Column] = {"flag": F.lit(4), "rname": F.lit("*"), "pos": F.lit(0), "mapq": F.lit(0), "cigar": F.lit("*"), "rnext": F.lit("*"), "pnext": F.lit(0), "tlen": F.lit(0)}
    bad = F.coalesce(bad, F.lit(False))
    return sam.withColumns({c: F.when(bad, v).otherwise(F.col(c)).cast(sam.schema[c].dataType) for c, v in keep.items()})


def unmapped_singles(sam: DataFrame) -> DataFrame:
    return sam.where("flag = 4").select(F.col("qname").alias("read_id"), "seq", "qual")


def unmapped_pairs(sam: DataFrame) -> DataFrame:
    """A row per fragment of which neither mate is mapped; mates are joined by id."""
    one = sam.where("flag = 77").select(F.col("qname").alias("read_id"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    two = sam.where("flag = 141").select(F.col("qname").alias("read_id"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return one.join(two, "read_id")


def interleaved(pairs: DataFrame) -> DataFrame:
    """Both mates of each fragment as rows, their ids with /1 and /2."""
    mate = F.explode(F.array(F.struct(F.lit("/1").alias("suffix"), F.col("seq1").alias("seq")), F.struct(F.lit("/2").alias("suffix"), F.col("seq2").alias("seq"))))
    return pairs.select("read_id", mate.alias("m")).select(F.concat("read_id", "m.suffix").alias("read_id"), "m.seq")


def by_length(df: DataFrame, column: str, low: int, high: int | None = None) -> DataFrame:
    n = F.length(column)
    return df.where(n.between(low, high) if high is not None else n >= low)


def complexity_filter(reads: DataFrame, score: str, cutoffs: list[float]) -> DataFrame:
    """Reads above the highest cut-off that any read exceeds, and up to the next higher one, as that one has none. The
    scored reads are kept, so that they are scored once."""
    reads = kept(reads)
    best = reads.agg(*(F.max((F.col(score) > c).cast("int")).alias(f"c{k}") for k, c in enumerate(sorted(cutoffs, reverse=True))))
    chosen = F.coalesce(*(F.when(F.col(f"c{k}") == 1, F.lit(c)) for k, c in enumerate(sorted(cutoffs, reverse=True))))
    return with_row(reads, best.select(chosen.alias("__cut"))).where(F.col(score) > F.col("__cut")).drop("__cut")


def line_violations(lines: DataFrame, max_length: int = 10_000) -> DataFrame:
    """(error, first_line, n) of one file's lines (line_no, value): unprintable characters, too long lines."""
    bad = F.when(F.length("value") > max_length, "long").when(F.col("value").rlike(r"[^\x20-\x7F\x01\x09]"), "character")
    return lines.select("line_no", bad.alias("error")).where("error is not null").groupBy("error").agg(F.min("line_no").alias("first_line"), F.count("*").alias("n"))


def record_violations(lines: DataFrame, multiple: int = 4) -> DataFrame:
    """(error, first_line, n): a row if a file's number of lines is no multiple of the lines of a record."""
    n = lines.agg(F.count("*").alias("n"), F.max("line_no").alias("last"))
    return n.where(F.col("n") % multiple != 0).select(F.lit("incomplete").alias("error"), F.col("last").alias("first_line"), F.lit(1).cast("long").alias("n"))


def quality_filter(reads: DataFrame, min_length: int = 35, phred: int = 17, max_low: float = 0.15, max_unknown: int = 15) -> DataFrame:
    """reads (seq, quality) of min_length or more with at most max_unknown N and a share of max_low bases below phred."""
    unknown = F.length("seq") - F.length(F.translate("seq", "Nn", ""))
    return reads.where((F.length("seq") >= min_length) & (unknown <= max_unknown) & (F.coalesce(X.low_quality_share(F.col("quality"), phred), F.lit(1.0)) <= max_low))


def dust_filter(reads: DataFrame, least: float = 60.0) -> DataFrame:
    """reads (seq) of which symmetric DUST leaves `least` percent or more unmasked; empty ones have none."""
    return reads.where(100 * D.unmasked_share(F.col("seq")) >= least)


def short_read_quality(reads: DataFrame, least: float = 60.0) -> DataFrame:
    """reads (seq, quality) that pass what short reads must: length, qualities, unknown letters and complexity."""
    return dust_filter(quality_filter(reads), least)


def long_read_quality(reads: DataFrame, min_length: int = 100, phred: int = 9, max_low: float = 0.4, max_unknown: int = 5, least: float = 30.0) -> DataFrame:
    """reads (seq, quality) that pass what long reads must; complexity is the percentage of letters that differ from the
    next."""
    good = quality_filter(reads, min_length, phred, max_low, max_unknown)
    return good.where(100 * D.neighbour_share(F.col("seq")) >= least)


def called_filter(reads: DataFrame, min_called: float = 0.9, min_good: float = 0.85, phred: int = 17) -> DataFrame:
    """reads (seq, quality) with min_called of their bases known and min_good of them of at least phred; if no read is left
    that way, the quality isn't asked for."""
    known = kept(reads.where(X.called_share(F.col("seq")) >= min_called).withColumn("__good", F.coalesce(1 - X.low_quality_share(F.col("quality"), phred) >= min_good, F.lit(False))))
    some = known.agg(F.coalesce(F.max("__good"), F.lit(False)).alias("__some"))
    return with_row(known, some).where("__good or not __some").drop("__good", "__some")


def short_reads_only(reads: DataFrame, most: int = 500) -> DataFrame:
    """reads themselves; the job fails at the first whose sequence is longer than short-read machines give."""
    return reads.where(F.when(F.length("seq") <= most, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("read longer than short reads are: "), F.col("read_id").cast("string"))).cast("boolean")))


def reference_alphabet(references: DataFrame) -> DataFrame:
    """References whose sequence holds anything but the letters of nucleotides and their ambiguities."""
    return references.where(F.col("seq").rlike("[^ACGTURYKMSWBDHVNacgturykmswbdhvn-]"))


def contigs_with_reads(contigs: DataFrame, read2contig: DataFrame) -> DataFrame:
    """Contigs (contig_id) that own a read."""
    return contigs.join(read2contig.where("contig_id <> '*'").select("contig_id"), "contig_id", "left_semi")


def contigs_of_taxa(contigs: DataFrame, hits: DataFrame, taxa: DataFrame, rank: str = "species_taxid") -> DataFrame:
    """Contigs whose hit (contig_id, rank) is one of the taxa (taxid)."""
    wanted = hits.join(taxa.select(F.col("taxid").alias(rank)), rank, "left_semi")
    return contigs.join(wanted.select("contig_id"), "contig_id", "left_semi")


def accession_subset(accessions: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows of an accession map (accession, taxid) whose accession, without version, a FASTA header (header) names; headers
    may hold several names, parted by \\x01."""
    named = headers.select(F.explode(F.split("header", "\x01")).alias("h")).select(F.substring_index(F.regexp_extract("h", r"^>?(\S+)", 1), ".", 1).alias("accession"))
    return accessions.join(named.where("accession <> ''"), "accession", "left_semi")


def require_rows(df: DataFrame, least: int) -> DataFrame:
    """df itself; the job fails where it has fewer rows."""
    if df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows")
    return df


def classified(reads: DataFrame, taxid: int) -> DataFrame:
    """Reads whose header names the taxon that a classifier found."""
    return reads.where(F.col("header").rlike(rf"kraken:taxid\|{taxid}(\s|$)"))


def without_large_references(references: DataFrame, most: int = 100_000_000) -> DataFrame:
    return references.where((F.coalesce("header_length", F.lit(0)) + F.col("sequence_length")) <= most)


def has_rank(records: DataFrame, ancestors: str, ranks: list[str]) -> DataFrame:
    """Records of whose ancestors (an array of structs with rank) one has any of the ranks."""
    return records.where(F.exists(ancestors, lambda a: a["rank"].isin(ranks)))


def lineages_of_phyla(lineages: DataFrame, names: tuple[str, ...] = ("Chordata", "Echinodermata", "Hemichordata")) -> DataFrame:
    """Lineages that name one of the phyla in any column."""
    return lineages.where(F.concat_ws(",", *lineages.columns).rlike("|".join(names)))
