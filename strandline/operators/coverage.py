"""Depth and breadth of coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def covered_length(intervals: DataFrame, *keys: str) -> DataFrame:
    """Length of the union of half-open intervals (b, e) of each key."""
    before = Window.partitionBy(*keys).orderBy("b", "e").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("e").over(before), F.col("b"))
    return intervals.withColumn("__new", F.greatest(F.lit(0), F.col("e") - F.greatest("b", reach))).groupBy(*keys).agg(F.sum("__new").alias("covered"))


def islands(intervals: DataFrame, *keys: str) -> DataFrame:
    """The union of each key's half-open intervals (b, e) as disjoint stretches that don't touch."""
    before = Window.partitionBy(*keys).orderBy("b", "e").rowsBetween(Window.unboundedPreceding, -1)
    new = (F.coalesce(F.max("e").over(before), F.lit(None)) < F.col("b")) | F.max("e").over(before).isNull()
    marked = intervals.withColumn("__new", new.cast("int"))
    marked = marked.withColumn("__island", F.sum("__new").over(Window.partitionBy(*keys).orderBy("b", "e").rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "__island").agg(F.min("b").alias("b"), F.max("e").alias("e")).drop("__island")


def index_quantiles(values: DataFrame, key: str, value: str) -> DataFrame:
    """Coverage statistics of each key's depths: quantiles are the sorted value at position int(q * n); shares of
    depths above twice the average, and of 0, 1 and 2. Depths are counted first, so that a key has a row per distinct one."""
    counts = values.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    own = Window.partitionBy(key)
    upto = F.sum("__c").over(own.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    run = counts.withColumns({"__upto": upto, "__n": F.sum("__c").over(own), "__avg": F.sum(F.col("__v") * F.col("__c")).over(own) / F.sum("__c").over(own)})
    at = lambda q: F.min(F.when(F.col("__upto") > F.least(F.floor(F.lit(q) * F.col("__n")), F.col("__n") - 1), F.col("__v")))
    share = lambda keep: F.sum(F.when(keep, F.col("__c")).otherwise(0)) / F.max("__n")
    return run.groupBy(key).agg(
        F.max("__n").alias("n"), F.max("__avg").alias("avg"), F.min("__v").alias("p0"), at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), F.max("__v").alias("p100"),
        share(F.col("__v") > 2 * F.col("__avg")).alias("avg2xcnt"), *(share(F.col("__v") == k).alias(f"cnt{k}") for k in range(3)),
    )


def bin_of(position: Column, length: Column, bins: Column) -> Column:
    """The bin of a position, by whole numbers."""
    return F.floor(position * bins / length).cast("long")


def bin_coverage(intervals: DataFrame, max_bins: int = 500) -> DataFrame:
    """(key, bin, depth, breadth, n) of half-open intervals (key, length, b, e): covered bases per base of a bin, the
    covered share of the bin, and how many intervals reach it. An accession has as many bins as bases, max_bins at most,
    which bounds the rows that an interval makes. Accessions of no length are left out."""
    rows = intervals.where("length > 0 and e > b").withColumns({"b": F.greatest("b", F.lit(0)), "e": F.least("e", "length")}).where("e > b")
    rows = rows.withColumn("bins", F.least(F.col("length"), F.lit(max_bins).cast("long")))
    first, last = F.expr("(b * bins) div length"), F.expr("(e * bins - 1) div length")
    hit = rows.withColumn("bin", F.explode(F.sequence(first, last)))
    low, high = F.col("bin") * F.col("length") / F.col("bins"), (F.col("bin") + 1) * F.col("length") / F.col("bins")
    hit = hit.withColumns({"x": F.greatest(F.col("b").cast("double"), low), "y": F.least(F.col("e").cast("double"), high), "w": high - low})
    depth = hit.groupBy("key", "bin").agg((F.sum(F.col("y") - F.col("x")) / F.max("w")).alias("depth"), F.count("*").alias("n"), F.max("w").alias("w"))
    union = covered_length(hit.select("key", "bin", F.col("x").alias("b"), F.col("y").alias("e")), "key", "bin")
    return depth.join(union, ["key", "bin"]).select("key", "bin", "depth", (F.col("covered") / F.col("w")).alias("breadth"), "n")


def hit_groups(hits: DataFrame, max_bins: int = 500) -> DataFrame:
    """Hits (key, length, b, e, mismatch) as long as a bin or longer each alone, others grouped by the bin of their middle;
    alone ones of equal places are one row."""
    rows = hits.where("length > 0").withColumn("bins", F.least(F.col("length"), F.lit(max_bins).cast("long")))
    alone = (F.col("e") - F.col("b")) * F.col("bins") >= F.col("length")
    middle = F.expr("least(((b + e) * bins) div (2 * length), bins - 1)")
    return rows.groupBy("key", F.when(alone, F.lit(-1)).otherwise(middle).alias("bin"), F.when(alone, F.col("b")).alias("alone_b"), F.when(alone, F.col("e")).alias("alone_e")).agg(
        F.count("*").alias("n"), F.min("b").alias("b"), F.max("e").alias("e"), F.avg(F.col("mismatch") / (F.col("e") - F.col("b"))).alias("prop_mismatch")
    )


#: Of each hit, what its group has the mean of.
AVERAGED = ["alignment_length", "percent_id", "mismatches", "gaps"]


def coverage_groups(hits: DataFrame, max_bins: int = 500) -> DataFrame:
    """(key, alone, n_contigs, n_reads, contig_reads, first, last, the means of AVERAGED, bin, byte_ranges) of hits (key, length,
    is_contig, subject_start, subject_end, AVERAGED, and of contigs num_reads, first_byte, last_byte) on accessions of `length`
    bases, cut in max_bins bins, or as many as there are bases.

    A hit as long as a bin or longer is a group by itself, however many others lie alike; shorter ones are grouped by the
    bin that their middle is in, reads and contigs together. Ends may come in either order and count from 1. contig_reads and
    byte_ranges take each byte range of a group once, as alignments of one contig share theirs; ranges are in their order.
    `bin` is that of the group's middle; what lies beyond the end is in the last bin. Accessions of no length have no groups; means are over all hits of a group."""
    low, high = F.least("subject_start", "subject_end"), F.greatest("subject_start", "subject_end")
    rows = hits.where("length > 0").withColumns({"first": low, "last": high, "bins": F.least(F.col("length"), F.lit(max_bins)).cast("long")})
    at = F.expr("greatest(least(((first - 1 + last) * bins) div (2 * length), bins - 1), 0)")
    is_alone = (F.col("last") - F.col("first") + 1) * F.col("bins") >= F.col("length")
    place = F.when(F.col("is_contig"), F.struct("first_byte", "last_byte"))
    ranges = F.when(F.col("is_contig"), F.array(place)).otherwise(F.array().cast("array<struct<first_byte:long,last_byte:long>>"))
    flag = lambda c: F.col("is_contig") == c
    single = rows.where(is_alone).select(
        "key", F.lit(True).alias("alone"), flag(True).cast("long").alias("n_contigs"), flag(False).cast("long").alias("n_reads"), F.when(flag(True), F.col("num_reads")).otherwise(0).cast("long").alias("contig_reads"),
        "first", "last", *(F.col(c).cast("double").alias(c) for c in AVERAGED), at.alias("bin"), ranges.alias("byte_ranges"))
    some = rows.where(~is_alone).withColumns({"__at": at, "__place": place})
    # one row for each contig of a bin, and one for its reads
    per = some.groupBy("key", "length", "bins", "__at", "__place").agg(
        F.count("*").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("num_reads").alias("num_reads"), *(F.sum(F.col(c).cast("double")).alias(c) for c in AVERAGED))
    contig = F.col("__place").isNotNull()
    group = per.groupBy("key", "length", "bins", "__at").agg(
        F.sum(F.when(contig, F.col("n")).otherwise(0)).alias("n_contigs"), F.sum(F.when(contig, 0).otherwise(F.col("n"))).alias("n_reads"), F.coalesce(F.sum(F.when(contig, F.col("num_reads"))), F.lit(0)).alias("contig_reads"),
        F.min("first").alias("first"), F.max("last").alias("last"), *((F.sum(c) / F.sum("n")).alias(c) for c in AVERAGED), F.array_sort(F.collect_set("__place")).alias("byte_ranges"))
    return single.unionByName(group.withColumn("bin", at).withColumn("alone", F.lit(False)).select(*single.columns))


def position_depth(intervals: DataFrame, *keys: str) -> DataFrame:
    """Runs (b, e, depth) of equal positive depth of half-open intervals, from their ends alone: no row per position."""
    ends = intervals.select(*keys, F.explode(F.array(F.struct(F.col("b").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("e").alias("pos"), F.lit(-1).alias("d")))).alias("x")).groupBy(*keys, "x.pos").agg(F.sum("x.d").alias("d"))
    ends = ends.where("d <> 0")
    w = Window.partitionBy(*keys).orderBy("pos")
    runs = ends.select(*keys, F.col("pos").alias("b"), F.lead("pos").over(w).alias("e"), F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return runs.where("depth > 0")


def gene_coverage(ranges: DataFrame, genes: DataFrame) -> DataFrame:
    """Covered share of each gene (gene, length), in percent, by ranges (gene, start, end) that may run backwards; ends
    don't belong to them. Genes without a range, or of no length, have 0."""
    rows = ranges.select("gene", F.when(F.col("start") <= F.col("end"), F.col("start")).otherwise(F.col("end") + 1).alias("b"), F.when(F.col("start") <= F.col("end"), F.col("end")).otherwise(F.col("start") + 1).alias("e")).where("e > b")
    found = genes.join(covered_length(rows, "gene"), "gene", "left")
    covered = F.coalesce("covered", F.lit(0))
    return found.select("gene", covered.alias("covered"), "length", F.coalesce(F.round(F.try_divide(covered * 100.0, F.col("length")), 4), F.lit(0.0)).alias("percent"))


def depth_quantiles(values: DataFrame, key: str, value: str, shares: tuple[int, ...] = (10, 25, 50, 100)) -> DataFrame:
    """Mean, interpolated quartiles and the shares of values of at least the given depths."""
    return values.groupBy(key).agg(F.avg(value).alias("mean"), *(F.percentile(value, F.lit(q)).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)), *(F.avg((F.col(value) >= s).cast("double")).alias(f"share_{s}") for s in shares))


def fractional_bins(depths: DataFrame, bins: int) -> DataFrame:
    """(key, bin, depth) of depths (key, pos from 0, length, depth) over equal bins, a position that two bins share
    counting for each by its part."""
    width = F.col("length") / F.lit(bins)
    rows = depths.where("length > 0").withColumn("w", width)
    rows = rows.withColumn("bin", F.explode(F.sequence(F.floor(F.col("pos") / F.col("w")), F.least(F.ceil((F.col("pos") + 1) / F.col("w")) - 1, F.lit(bins - 1)))))
    part = F.least(F.col("pos") + 1, (F.col("bin") + 1) * F.col("w")) - F.greatest(F.col("pos").cast("double"), F.col("bin") * F.col("w"))
    return rows.groupBy("key", "bin").agg((F.sum(F.col("depth") * part) / F.max("w")).alias("depth"))


def consensus_counts(sequences: DataFrame) -> DataFrame:
    """Bases of a consensus by sort: called, missing (N), gap and ambiguous."""
    n = F.length("seq")
    without = lambda chars: n - F.length(F.translate("seq", chars, ""))
    acgt, missing, gap = without("ACGTacgt"), without("Nn"), without("-")
    return sequences.select("key", n.alias("length"), acgt.alias("called"), missing.alias("missing"), gap.alias("gaps"), (n - acgt - missing - gap).alias("ambiguous"))


def variant_classes(vcf: DataFrame) -> DataFrame:
    """(class, n) of variants (ref, alt): snp and mnp if all alleles are as long as the reference, otherwise indel."""
    lengths = F.array_distinct(F.transform(F.split("alt", ","), lambda a: F.length(a)))
    same = (F.size(lengths) == 1) & (lengths[0] == F.length("ref"))
    return vcf.groupBy(F.when(same & (F.length("ref") == 1), "snp").when(same, "mnp").otherwise("indel").alias("class")).agg(F.count("*").alias("n"))


def best_accessions(scores: DataFrame, n: int = 10) -> DataFrame:
    """Accessions (taxon, accession, score, n_contigs) worth showing: all with contigs, filled up to n by score."""
    w = Window.partitionBy("taxon").orderBy(F.desc("score"), "accession")
    with_contig = F.col("n_contigs") > 0
    ranked = scores.withColumn("__k", F.sum((~with_contig).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(with_contig | (F.col("__k") <= n))
    # in the same order, so that rows are sorted once
    ranked = ranked.withColumn("__total", F.sum(with_contig.cast("int")).over(Window.partitionBy("taxon")))
    return ranked.where(with_contig | (F.col("__k") <= n - F.col("__total"))).drop("__total", "__k")


def longest_reads(reads: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n longest distinct sequences of each key."""
    distinct = reads.groupBy(*keys, "seq").agg(F.min("read_id").alias("read_id"))
    w = Window.partitionBy(*keys).orderBy(F.desc(F.length("seq")), "read_id")
    return distinct.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def accession_stats(hits: DataFrame) -> DataFrame:
    """Per key of hits (key, length, b, e, mismatch): longest hit, bases per base, covered share, mean mismatch share."""
    rows = hits.where("length > 0")
    inside = rows.select("key", "b", F.least("e", "length").alias("e")).where("e > b")
    size = F.col("e") - F.col("b")
    per = rows.groupBy("key").agg(F.count("*").alias("n"), F.max(size).alias("max_aligned_length"), (F.sum(size) / F.max("length")).alias("depth"), F.avg(F.col("mismatch") / size).alias("prop_mismatch"), F.max("length").alias("__length"))
    out = per.join(covered_length(inside, "key"), "key", "left")
    return out.withColumn("breadth", F.coalesce("covered", F.lit(0)) / F.col("__length")).drop("covered", "__length")


def alignment_context(positions: DataFrame, references: DataFrame, around: int = 100, longest: int = 6000) -> DataFrame:
    """positions (accession, pos from 1) with the reference bases around them, null for references that aren't there, and
    a note instead of the bases if more than `longest` were asked for."""
    begin = F.greatest(F.col("pos") - around, F.lit(1))
    n = F.col("pos") - begin + around + 1
    context = F.when(n > longest, F.lit("too long to show")).otherwise(F.substring("seq", begin, n))
    return positions.join(references.select("accession", "seq"), "accession", "left").withColumn("context", context).drop("seq")
