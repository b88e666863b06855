"""Gene reports, accuracy against a truth set, clusters of distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.scalar import kept, running_sums, with_row


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join in which null keys match each other; other columns must differ in name."""
    l = left.select(*(F.col(c).alias(f"__l_{c}") if c in keys else F.col(c) for c in left.columns))  # noqa: E741
    r = right.select(*(F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns))
    on = [F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    both = l.join(r, on, "full_outer")
    return both.select(*(F.coalesce(f"__l_{k}", f"__r_{k}").alias(k) for k in keys), *(c for c in left.columns if c not in keys), *(c for c in right.columns if c not in keys))


def joined_set(column: Column) -> Column:
    """Distinct values, sorted and joined by ;"""
    return F.array_join(F.array_sort(F.collect_set(column)), ";")


def gene_report(hits: DataFrame) -> DataFrame:
    """A row per gene of hits (gene, drug_class with parts separated by "; ", mechanism, percent, identity, nudged):
    sets joined, best and mean figures; genes without drug class are left out."""
    rows = hits.where("drug_class is not null and drug_class <> ''")
    classes = rows.select("gene", F.explode(F.split("drug_class", "; ")).alias("c")).groupBy("gene").agg(joined_set(F.col("c")).alias("drug_classes"))
    rest = rows.groupBy("gene").agg(joined_set(F.col("mechanism")).alias("mechanisms"), F.max("percent").alias("max_percent"), F.avg("identity").alias("mean_identity"), F.count("*").alias("n_hits"), F.max(F.when(F.col("nudged"), "Nudged").otherwise("Strict")).alias("cut_off"))
    return classes.join(rest, "gene")


def ontology_classes(hits: DataFrame, ontology: DataFrame) -> DataFrame:
    """hits (aro, drug_class) with the classes that the ontology (accession, drug_class) has for ARO:<aro> put to their own:
    sets, sorted and joined by ; """
    known = ontology.select(F.col("accession").alias("__a"), F.col("drug_class").alias("__more"))
    both = hits.join(known, F.concat(F.lit("ARO:"), F.col("aro").cast("string")) == F.col("__a"), "left").drop("__a")
    parts = F.array_union(F.split(F.coalesce("drug_class", F.lit("")), "; "), F.split(F.coalesce("__more", F.lit("")), "; "))
    return both.withColumn("drug_class", F.array_join(F.array_sort(F.array_remove(parts, "")), ";")).drop("__more")


def contig_genes(hits: DataFrame) -> DataFrame:
    """(gene, contig) of hits (gene, orf): the contig of a predicted gene is its name without the last _n."""
    return hits.select("gene", F.regexp_replace("orf", r"_\d+$", "").alias("contig")).distinct()


def _running_precision(scores: DataFrame) -> DataFrame:
    """(score, precision, recall) at each distinct score, highest first, with those of the score before it as p0 and r0."""
    by = scores.where("score is not null").groupBy("score").agg(F.sum("truth").alias("tp"), F.count("*").alias("n"))
    run = running_sums(by, [F.desc("score")], tp0="tp", n0="n")
    total = scores.agg(F.sum("truth").alias("__p"))
    tp, n = F.col("tp0") + F.col("tp"), F.col("n0") + F.col("n")
    return with_row(run, total).select("score", (tp / n).alias("precision"), F.try_divide(tp, F.col("__p")).alias("recall"), F.try_divide(F.col("tp0"), F.col("n0")).alias("p0"), F.coalesce(F.try_divide(F.col("tp0"), F.col("__p")), F.lit(0.0)).alias("r0"))


def precision_recall(scores: DataFrame) -> DataFrame:
    """(score, precision, recall) at each distinct score, highest first, of scores (score, truth); rows that are true
    but have no score are missed."""
    return _running_precision(scores).select("score", "precision", "recall")


def aupr(scores: DataFrame) -> DataFrame:
    """Area under the precision-recall curve by trapezes, from recall 0 at the first precision, to recall 1 at precision
    0 where truth is missed."""
    part = (F.col("recall") - F.col("r0")) * (F.col("precision") + F.coalesce("p0", "precision")) / 2
    ends = _running_precision(scores).agg(F.sum(part).alias("area"), F.min_by("precision", "score").alias("p1"), F.min_by("recall", "score").alias("r_last"))
    return ends.select((F.col("area") + (1 - F.col("r_last")) * F.col("p1") / 2).alias("aupr"))


def l2_distance(a: DataFrame, b: DataFrame) -> DataFrame:
    """Euclidean distance of two abundance tables (taxid, abundance)."""
    both = a.select("taxid", F.col("abundance").alias("x")).join(b.select("taxid", F.col("abundance").alias("y")), "taxid", "full_outer")
    return both.agg(F.sqrt(F.sum(F.pow(F.coalesce("x", F.lit(0.0)) - F.coalesce("y", F.lit(0.0)), 2))).alias("l2"))


def spearman(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation, ties sharing their mean rank. Pairs are counted first, so that a value that most rows share is as
    many rows as it has partners; ranks are of distinct values, and joined to the counted pairs. The mean of all ranks is
    known, so deviations from it are summed."""
    counted = kept(pairs.where(f"{x} is not null and {y} is not null").groupBy(x, y).agg(F.count("*").alias("__w")))
    out = with_row(counted, counted.agg(F.sum("__w").alias("__total")))
    for c in (x, y):
        ranks = running_sums(counted.groupBy(c).agg(F.sum("__w").alias("__n")), [F.asc(c)], __before="__n")
        out = out.join(ranks.select(c, (F.col("__before") + (F.col("__n") + 1) / 2).alias(f"__r_{c}")), c)
    dx, dy = (F.col(f"__r_{c}") - (F.col("__total") + 1) / 2 for c in (x, y))
    product = lambda a, b: F.sum(F.col("__w") * a * b)
    return out.agg((product(dx, dy) / F.nullif(F.sqrt(product(dx, dx)) * F.sqrt(product(dy, dy)), F.lit(0.0))).alias("spearman"))


def distance_matrix(distances: DataFrame) -> DataFrame:
    """(grp, a, b, distance) for every two samples of a group, both ways and with themselves, of distances given for either
    order or both, of which the least counts; a missing distance is 1, that of a sample with itself 0."""
    both = distances.select("grp", "a", "b", "distance").unionByName(distances.select("grp", F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    known = both.where("distance is not null and not isnan(distance) and a <> b").groupBy("grp", "a", "b").agg(F.min("distance").alias("distance"))
    names = both.select("grp", "a").distinct()
    square = names.join(names.withColumnRenamed("a", "b"), "grp").join(known, ["grp", "a", "b"], "left")
    return square.select("grp", "a", "b", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.coalesce("distance", F.lit(1.0))).alias("distance"))


def sample_clusters(distances: DataFrame, height: float = 0.16, least: int = 3) -> DataFrame:
    """(grp, sample, cluster): average-linkage clusters, cut at height, with at least `least` samples, of each group's
    distances (grp, a, b, distance). As the method has it, the rows of 1 - distance are the points that are linked; a
    missing distance counts as 1.

    Two clusters that are nearest to one another merge, all such pairs of all groups in one round: with means that gives the
    same tree as merging one pair after another. Sums of distances and their numbers are kept for each pair of clusters, so
    a merge relabels and adds them up. Ties go to the smaller names. A matrix has a row for each two samples of a run."""
    points = distance_matrix(distances).select("grp", "a", F.col("b").alias("k"), (1 - F.col("distance")).alias("p"))
    left, right = points.withColumnRenamed("p", "x"), points.select("grp", F.col("a").alias("b"), "k", F.col("p").alias("y"))
    squares = left.join(right, ["grp", "k"]).where("a < b").groupBy("grp", "a", "b").agg(F.sum(F.pow(F.col("x") - F.col("y"), 2)).alias("s"))
    pairs = kept(squares.select("grp", "a", "b", F.sqrt("s").alias("total"), F.lit(1).cast("long").alias("n")))
    member = kept(points.select("grp", F.col("a").alias("sample")).distinct().withColumn("cluster", F.col("sample")))
    while True:
        mean = F.named_struct(F.lit("mean"), F.col("total") / F.col("n"), F.lit("a"), F.col("a"), F.lit("b"), F.col("b"))
        ends = pairs.select("grp", mean.alias("m"), F.explode(F.array("a", "b")).alias("c")).groupBy("grp", "c").agg(F.min("m").alias("m"))
        merged = ends.where(F.col("m.mean") <= height).groupBy("grp", "m.a", "m.b").agg(F.count("*").alias("sides")).where("sides = 2")
        merged = kept(merged.select("grp", F.col("b").alias("gone"), F.col("a").alias("into")))
        if merged.first() is None:
            break
        put = lambda df, c: df.join(merged.select("grp", F.col("gone").alias(c), "into"), ["grp", c], "left").withColumn(c, F.coalesce("into", c)).drop("into")  # noqa: B023,E731
        member = kept(put(member, "cluster"))
        moved = put(put(pairs, "a"), "b").where("a <> b").withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")})
        pairs = kept(moved.groupBy("grp", F.col("low").alias("a"), F.col("high").alias("b")).agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    large = member.groupBy("grp", "cluster").agg(F.count("*").alias("size")).where(F.col("size") >= least)
    numbered = large.select("grp", "cluster", (F.row_number().over(Window.partitionBy("grp").orderBy("cluster")) - 1).cast("long").alias("number"))
    return member.join(numbered, ["grp", "cluster"]).select("grp", "sample", F.col("number").alias("cluster"))
