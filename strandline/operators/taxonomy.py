"""The taxonomy: lineages from parent pointers, names, versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.scalar import kept, with_row
from strandline.schemas import NULL_RANKS, RANKS


def lineage_paths(nodes: DataFrame, root: int = 1) -> DataFrame:
    """(tax_id, ancestor, rank, depth): every node with all its ancestors below the root and itself, by pointer doubling:
    as many joins as the logarithm of the tree's depth, each on keys; each round is kept."""
    parent = kept(nodes.select("tax_id", F.col("parent_tax_id").alias("up")).where(F.col("tax_id") != root))
    reach = parent.select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(0).alias("depth"))
    step, size = parent, 1
    while step.first() is not None:
        above = step.select(F.col("tax_id").alias("ancestor"), "up")
        reach = kept(reach.unionByName(reach.join(above, "ancestor").where(F.col("up") != root).select("tax_id", F.col("up").alias("ancestor"), (F.col("depth") + size).alias("depth"))))
        again = step.select(F.col("tax_id").alias("up"), F.col("up").alias("up2"))
        step = kept(step.join(again, "up").select("tax_id", F.col("up2").alias("up")).where(F.col("up") != root))
        size *= 2
    return reach.join(nodes.select(F.col("tax_id").alias("ancestor"), "rank"), "ancestor").select("tax_id", "ancestor", "rank", "depth")


def numbered_ranks(paths: DataFrame) -> DataFrame:
    """paths with repeated ranks of a node told apart from the root down: "no rank", "no rank1", ..."""
    k = F.row_number().over(Window.partitionBy("tax_id", "rank").orderBy(F.desc("depth"))) - 1
    return paths.withColumn("rank", F.when(k == 0, F.col("rank")).otherwise(F.concat("rank", k.cast("string"))))


def wide_lineages(paths: DataFrame, ranks: tuple[str, ...] = RANKS) -> DataFrame:
    """A row per node with the taxid of each rank, the rank's null taxid where it has none."""
    cols = [F.coalesce(F.max(F.when(F.col("rank") == r, F.col("ancestor"))), F.lit(NULL_RANKS[r])).alias(r) for r in ranks]
    return paths.groupBy("tax_id").agg(*cols)


def name_ranks(lineages: DataFrame, names: DataFrame, ranks: tuple[str, ...]) -> DataFrame:
    """lineages (tax_id and taxids of ranks) with <rank>_name, empty where unknown: all ranks in one join."""
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("rank"), F.col(r).alias("id")) for r in ranks)))
    long = lineages.select("tax_id", pairs.alias("p")).select("tax_id", "p.rank", "p.id")
    named = long.join(names.select(F.col("tax_id").alias("id"), "name"), "id", "left")
    wide = named.groupBy("tax_id").agg(*(F.coalesce(F.max(F.when(F.col("rank") == r, F.col("name"))), F.lit("")).alias(f"{r}_name") for r in ranks))
    return lineages.join(wide, "tax_id")


def version_lineages(previous: DataFrame, current: DataFrame, version: str, key: str = "taxid") -> DataFrame:
    """Slowly changing lineages: rows of previous (key, values, version_start, version_end) brought up to `version` by
    current (key, values). Latest rows that are unchanged are extended; changed and deprecated ones stay as they are, the
    changed ones with a new row after them; older rows are kept; new keys get a row."""
    values = [c for c in current.columns if c != key]
    latest = previous.agg(F.max("version_end").alias("__latest"))
    old = with_row(previous, latest)
    live, past = old.where("version_end = __latest").drop("__latest"), old.where("version_end <> __latest or __latest is null").drop("__latest")
    now = current.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in values), F.lit(True).alias("__now"))
    both = live.withColumn("__old", F.lit(True)).join(now, F.col(key) == F.col("__key"), "full_outer")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in values)) & F.col("__old").isNotNull() & F.col("__now").isNotNull()
    kept = both.where("__old").select(key, *values, "version_start", F.when(same, F.lit(version)).otherwise(F.col("version_end")).alias("version_end"))
    new = both.where(F.col("__now") & ~F.coalesce(same, F.lit(False))).select(F.col("__key").alias(key), *(F.col(f"__{c}").alias(c) for c in values), F.lit(version).alias("version_start"), F.lit(version).alias("version_end"))
    return past.select(key, *values, "version_start", "version_end").unionByName(kept).unionByName(new)


def lineage_changes(previous: DataFrame, current: DataFrame, ranks: list[str], key: str = "taxid") -> DataFrame:
    """(key, change, field, old_value, new_value): new and deleted keys, and of changed ones the first field that differs
    in the order of ranks."""
    a = previous.select(F.col(key).alias("__a"), *(F.col(c).cast("string").alias(f"a_{c}") for c in ranks))
    b = current.select(F.col(key).alias("__b"), *(F.col(c).cast("string").alias(f"b_{c}") for c in ranks))
    both = a.join(b, F.col("__a") == F.col("__b"), "full_outer")
    first = F.coalesce(*(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").alias("old_value"), F.col(f"b_{c}").alias("new_value"))) for c in ranks))
    change = F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "deleted").when(first.isNotNull(), "changed")
    only = lambda f: F.when(change == "changed", first[f]).alias(f)
    return both.select(F.coalesce("__a", "__b").alias(key), change.alias("change"), only("field"), only("old_value"), only("new_value")).where("change is not null")
