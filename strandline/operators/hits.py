"""Best hits: hit calling per read, top hits per contig, synthesis of split alignments."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import lineage as L
from strandline.operators.filters import nucleotide_hsps, taxon_filter, valid_alignments
from strandline.operators.scalar import kept


def with_taxid(m8: DataFrame, acc2tax: DataFrame) -> DataFrame:
    """m8 with the taxid of its accession, null where unknown; of an accession with several the smallest."""
    one = acc2tax.groupBy("accession").agg(F.min("taxid").alias("taxid"))
    return m8.withColumn("accession", L.strip_version(F.col("sseqid"))).join(one, "accession", "left")


def with_lineage(df: DataFrame, lineage: DataFrame, taxid: str = "taxid") -> DataFrame:
    """df with species, genus and family of its taxid, the null lineage where unknown."""
    ranks = lineage.select(F.col("taxid").alias("__taxid"), "species", "genus", "family")
    out = df.join(ranks, F.col(taxid) == F.col("__taxid"), "left").drop("__taxid")
    s, g, f = L.with_nulls(F.col("species"), F.col("genus"), F.col("family"))
    return out.withColumns({"species": s, "genus": g, "family": f})


def call_hits(m8: DataFrame, acc2tax: DataFrame, lineage: DataFrame, min_length: int = 0, allow: DataFrame | None = None, deny: DataFrame | None = None, drop_human: bool = True) -> DataFrame:
    """A row per read: its best alignment and the taxon called from all its alignments of the best score.

    The species that most of those name wins (the smaller taxid on ties), then that species' accession that occurs most
    (the first by `ord` on ties), then its first alignment. Without any species the level and all taxids are -1. Lists
    apply to the winner only, so a read whose winner is denied, or human unless drop_human is false, is lost. One shuffle by read serves all windows where the
    dimensions are small enough to be broadcast.
    """
    read = Window.partitionBy("qseqid")
    best = valid_alignments(m8, min_length).withColumn("__best", F.max("bitscore").over(read)).where("bitscore = __best")
    best = with_lineage(with_taxid(best, acc2tax), lineage)  # of the best alignments alone
    known = F.col("species") >= 0
    best = best.withColumns({
        "__n_taxon": F.when(known, F.count("*").over(Window.partitionBy("qseqid", "species"))),
        "__n_accession": F.count("*").over(Window.partitionBy("qseqid", "species", "sseqid")),
        "__first": F.min("ord").over(Window.partitionBy("qseqid", "species", "sseqid")),
    })
    order = [F.desc_nulls_last("__n_taxon"), F.when(known, F.col("species")), F.when(known, -F.col("__n_accession")), F.when(known, F.col("__first")), "ord"]
    called = best.withColumn("__k", F.row_number().over(read.orderBy(*order))).where("__k = 1")
    minus = lambda c: F.when(known, F.col(c)).otherwise(F.lit(-1))
    out = called.select(*m8.columns, F.when(known, 1).otherwise(-1).alias("level"), minus("species").alias("called"), F.when(known, F.col("sseqid")).alias("accession_id"), *(minus(c).alias(f"{c}_taxid") for c in ("species", "genus", "family")))
    return taxon_filter(out, ["called"], allow, deny, drop_human).withColumnRenamed("called", "taxid")


def _fitting(rows: DataFrame, keys: Column | str, score: str) -> DataFrame:
    """Rows of the lowest specificity of each query, and of these the best scored."""
    query = Window.partitionBy(keys)
    rows = rows.withColumn("spec", L.specificity(F.col("species"), F.col("genus"), F.col("family")))
    rows = rows.withColumn("__spec", F.min("spec").over(query)).where("spec = __spec").drop("__spec")
    return rows.withColumn("__score", F.max(score).over(query)).where(f"{score} = __score").drop("__score")


def _most_frequent(rows: DataFrame, first: str) -> DataFrame:
    """Of each query's rows the one whose accession most rows of all queries name, the first on ties."""
    rows = kept(rows)  # both are made from them
    counts = rows.groupBy("sseqid").agg(F.count("*").alias("__n"))
    ranked = rows.join(counts, "sseqid")
    return ranked.withColumn("__k", F.row_number().over(Window.partitionBy("qseqid").orderBy(F.desc("__n"), first))).where("__k = 1").drop("__k", "__n")


def top_hit_nr(m8: DataFrame, acc2tax: DataFrame, lineage: DataFrame, max_evalue: float = 1.0) -> DataFrame:
    """Protein search: a query's best alignment among those of its most specific taxa."""
    rows = with_lineage(with_taxid(m8.where(F.col("evalue") <= max_evalue), acc2tax), lineage)
    return _most_frequent(_fitting(rows, "qseqid", "bitscore"), "ord").select(*m8.columns)


def disjoint(begins: list[int], ends: list[int], most: float = 0.1) -> list[int]:
    """The numbers of the intervals, in their order, that share no more than `most` of the shorter one's length with any
    kept before. Kept intervals lie in an index by their begin: of those of any length none holds another, so their ends
    are in order too, and only the neighbours of a new one that reach into it are asked."""
    chosen, low, high = [], [], []
    for k, (b, e) in enumerate(zip(begins, ends, strict=True)):
        at = bisect_right(low, b)
        clashes = False
        for step, j in ((-1, at - 1), (1, at)):
            while not clashes and 0 <= j < len(low) and (high[j] > b if step < 0 else low[j] < e):
                clashes = min(high[j], e) - max(low[j], b) > most * min(high[j] - low[j], e - b)
                j += step
        if not clashes:
            chosen.append(k)
            if e > b:  # what has no length shares nothing
                low.insert(at, b)
                high.insert(at, e)
    return chosen


def disjoint_hsps(hsps: Column, max_overlap: float = 0.1) -> Column:
    """Of alignments (ord, b, e, ...) in their order those whose query interval overlaps none kept before by more than
    max_overlap of the shorter of the two."""

    @F.pandas_udf("array<int>")
    def chosen(begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else disjoint(b.tolist(), e.tolist(), max_overlap) for b, e in zip(begins, ends, strict=True)])

    several = lambda c: F.when(F.size(hsps) > 1, F.transform(hsps, lambda x: x[c]))  # noqa: E731  # most pairs have one
    return F.when(F.size(hsps) == 1, hsps).otherwise(F.transform(chosen(several("b"), several("e")), lambda k: hsps[k]))


def _hsp(columns: list[str]) -> Column:
    low, high = F.least("qstart", "qend").alias("b"), F.greatest("qstart", "qend").alias("e")
    return F.struct("ord", low, high, *(F.col(c) for c in columns if c not in ("ord", "qseqid", "sseqid")))


def hsp_covers(m8: DataFrame) -> DataFrame:
    """(qseqid, sseqid, cover, score, first): the greedy disjoint alignments of each pair, in order of `ord`."""
    pairs = m8.groupBy("qseqid", "sseqid").agg(F.array_sort(F.collect_list(_hsp(m8.columns))).alias("hsps"))
    covered = pairs.select("qseqid", "sseqid", disjoint_hsps(F.col("hsps")).alias("cover"))
    return covered.withColumns({"score": F.aggregate("cover", F.lit(0.0), lambda a, x: a + x["bitscore"]), "first": F.col("cover")[0]["ord"]})


def top_hit_nt(m8: DataFrame, acc2tax: DataFrame, lineage: DataFrame, min_length: int = 36, min_pident: float = 80.0, max_evalue: float = 1.0) -> DataFrame:
    """Nucleotide search: every alignment of a query's best disjoint cover among those of its most specific taxa.

    Taxa are looked up first, so that covers are made of pairs that may win alone, and only for queries that have a pair of
    several alignments: of others the best scored alignment is the best cover. One shuffle and one sort by query serve all
    windows."""
    hsps = nucleotide_hsps(m8, min_length, min_pident, max_evalue)
    rows = with_lineage(with_taxid(hsps, acc2tax), lineage)
    rows = rows.select(*m8.columns, L.specificity(F.col("species"), F.col("genus"), F.col("family")).alias("__spec"), (F.lit(0.0) + F.col("bitscore")).alias("__score")).repartition("qseqid")
    query = Window.partitionBy("qseqid")
    rows = rows.withColumn("__n", F.count("*").over(Window.partitionBy("qseqid", "sseqid"))).withColumn("__least", F.min("__spec").over(query)).where("__spec = __least")
    rows = rows.withColumns({"__most": F.max("__n").over(query), "__top": F.max("__score").over(query)}).where("__most > 1 or __score = __top")
    rows = kept(rows.select(*m8.columns, "__score", "__most"))
    single = rows.where("__most = 1").select("qseqid", "sseqid", F.array(_hsp(m8.columns)).alias("cover"), F.col("__score").alias("score"), F.col("ord").alias("first"))
    covers = hsp_covers(rows.where("__most > 1").select(*m8.columns)).withColumn("__top", F.max("score").over(query)).where("score = __top").drop("__top")
    best = _most_frequent(single.unionByName(covers), "first").select("qseqid", "sseqid", F.explode("cover").alias("h"))
    return best.select(*(F.col(c) if c in ("qseqid", "sseqid") else F.col(f"h.{c}") for c in m8.columns))


def hsp_summary(m8: DataFrame, *keys: str) -> DataFrame:
    """Alignments of a key as one: lengths and scores summed, identity weighted by length, outermost coordinates."""
    total = F.greatest(F.sum("length"), F.lit(1))
    return m8.groupBy(*keys).agg(
        total.alias("length"), (F.sum(F.col("pident") * F.col("length")) / total).alias("pident"), F.sum("bitscore").alias("bitscore"),
        F.min(F.least("qstart", "qend")).alias("qstart"), F.max(F.greatest("qstart", "qend")).alias("qend"),
        (total / F.max("qlen")).alias("qcov"), F.count("*").alias("hsp_count"),
    )


def contig_synthesis(m8: DataFrame) -> DataFrame:
    """One alignment per query from its parts: means weighted by length, sums, outermost coordinates; the accession of
    the first part."""
    n = F.sum("length")
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("length")), n).alias(c)
    return m8.groupBy("qseqid").agg(
        F.min_by("sseqid", "ord").alias("sseqid"), mean("pident"), n.alias("length"), *(F.sum(c).alias(c) for c in ("mismatch", "gapopen")),
        F.min("qstart").alias("qstart"), F.max("qend").alias("qend"), F.min("sstart").alias("sstart"), F.max("send").alias("send"), mean("evalue"), F.sum("bitscore").alias("bitscore"),
    )


def genus_accessions(hits: DataFrame, min_reads: int) -> DataFrame:
    """Genera with min_reads reads and more than one species, with their accessions."""
    rows = hits.where("genus_taxid > 0").groupBy("genus_taxid").agg(F.count("*").alias("n_reads"), F.countDistinct("species_taxid").alias("n_species"), F.array_sort(F.collect_set("accession_id")).alias("accessions"))
    return rows.where((F.col("n_reads") >= min_reads) & (F.col("n_species") > 1))
