"""Readers of small files, observed counts, made sequences, sets of references."""

import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import sequences as S
from strandline.plans.observed import StepCounts, with_sizes
from strandline.sources import tables


def test_failures_of_assemblers(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "warnings").mkdir()
    log = "start\n== Error ==  out of memory\nmore\n=== Stack Trace ===\nframe 1\nframe 2\n\nafter\n== Error ==  twice\n"
    (tmp_path / "logs" / "a.log").write_text(log)
    (tmp_path / "logs" / "b.log").write_text("fine\n=== Stack Trace ===\nno end")
    (tmp_path / "warnings" / "a.txt").write_text("careful\n")
    (tmp_path / "warnings" / "c.txt").write_text("alone\n")
    rows = {r["run"]: r.asDict() for r in tables.assembler_failures(spark, str(tmp_path / "logs"), str(tmp_path / "warnings")).collect()}
    assert rows["a"] == {"run": "a", "log_present": True, "errors": "*  out of memory\n*  twice\n", "stack_trace": "=== Stack Trace ===\nframe 1\nframe 2\n", "warnings_present": True, "warnings": "careful\n"}
    assert rows["b"]["errors"] is None and rows["b"]["stack_trace"] is None and not rows["b"]["warnings_present"]
    assert not rows["c"]["log_present"] and rows["c"]["warnings"] == "alone\n"
    assert tables.assembler_failures(spark, str(tmp_path / "logs")).count() == 2


def test_summaries_and_ontologies(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"species_taxid": 5, "genus_taxid": 6, "family_taxid": 7, "count_type": "NT", "contig_counts": {"c1": 3, "*": 9}}, {"species_taxid": 8, "contig_counts": {}}]))
    assert {tuple(r) for r in tables.contig_summaries(spark, str(tmp_path / "s.json")).collect()} == {(5, 6, 7, "NT", "c1", 3), (5, 6, 7, "NT", "*", 9)}
    (tmp_path / "o.json").write_text(json.dumps({"ARO:1": {"label": "x", "drugClasses": ["a", "b"]}, "ARO:2": {"label": "y"}}))
    assert {tuple(r) for r in tables.ontology(spark, str(tmp_path / "o.json")).collect()} == {("ARO:1", "a"), ("ARO:1", "b")}


@pytest.mark.parametrize("share", [0.0, 0.3, 0.8, 1.0])
def test_made_sequences_have_the_set_containment(spark, share):
    k, n = 21, 4000
    needle = S.containing_sequence(F.lit(""), F.lit("needle"), k, n // k, 0.0, 1)
    row = spark.range(1).select(needle.alias("a")).withColumn("b", S.containing_sequence(F.col("a"), F.lit("b"), k, n // k + 50, share)).first()
    kmers = lambda t: {t[i : i + k] for i in range(len(t) - k + 1)}
    a, b = kmers(row["a"]), kmers(row["b"])
    assert len(row["b"]) == k * (n // k + 50) and set(row["b"]) == set("ACGT")
    assert abs(len(a & b) / len(a) - share) <= 2 * k / len(a)


def test_sets_of_references(spark):
    one, two = (spark.createDataFrame([(f"{p}{k}", "ACGT") for k in range(3)], "read_id string, seq string") for p in "ab")
    assert {(r["read_id"], r["set"]) for r in S.concatenated(one, two).collect()} == {(f"{p}{k}", s) for s, p in enumerate("ab") for k in range(3)}
    with pytest.raises(Exception, match="repeated read id"):
        S.concatenated(one, two, one).collect()


def test_steps_are_counted_by_the_plans_own_action(spark, tmp_path):
    reads = spark.createDataFrame([(f"r{k}", k) for k in range(100)], "read_id string, n int").repartition(4)
    sizes = spark.createDataFrame([(f"r{k}", 3) for k in range(0, 100, 2)], "read_id string, size long")
    steps = StepCounts()
    rows = steps.add("in", with_sizes(reads, sizes), "size")
    rows = steps.add("kept", rows.where("n < 10"), "size")
    none = steps.add("none", rows.where("n < 0"))
    rows.unionByName(none).write.parquet(str(tmp_path / "out"))
    got = dict((s, (n, m)) for s, n, m in steps.counts())
    assert got["kept"][0] in (10, 20) and got["none"] == (0, 0)  # a step in two branches is counted in both
    alone = StepCounts()
    alone.add("in", with_sizes(reads, sizes), "size").write.parquet(str(tmp_path / "alone"))
    assert alone.counts() == [("in", 100, 200)]
    with pytest.raises(ValueError, match="two steps"):
        alone.add("in", reads)


def test_costly_rows_are_dealt_to_all_cores(spark):
    from strandline.queries import QUERIES

    import strandline.format_queries  # noqa: F401

    assert QUERIES["containing_sequences"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
