"""Best accessions sort their rows once, and fill up by score."""

from pyspark.sql import functions as F

from strandline.operators import coverage as V


def test_best_accessions_sort_once(spark):
    scores = spark.range(400).select((F.col("id") % 5).alias("taxon"), F.col("id").alias("accession"), (F.col("id") * 7 % 31).alias("score"), F.when(F.col("id") % 5 < 3, (F.col("id") % 40 == 1).cast("long")).otherwise(F.col("id") % 2).alias("n_contigs"))
    out = V.best_accessions(scores.repartition(3), 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1, plan
    want = []
    for t in range(5):
        own = [r for r in scores.collect() if r["taxon"] == t]
        named = [r for r in own if r["n_contigs"] > 0]
        others = sorted((r for r in own if r["n_contigs"] == 0), key=lambda r: (-r["score"], r["accession"]))
        want += [(t, r["accession"]) for r in named + others[: max(0, 10 - len(named))]]
    assert sorted((r["taxon"], r["accession"]) for r in out.collect()) == sorted(want)
