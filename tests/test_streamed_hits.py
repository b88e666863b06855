"""Streamed hit calling against the batch."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandline import roles as R
from strandline.operators import hits as H
from strandline.streaming import hits as SH

SF = "/root/testdata/sf0.001"


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    SH.use_rocksdb(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _rows(df):
    return sorted(tuple(r) for r in df.select("qseqid", "sseqid", "bitscore", "ord", "level", "taxid", "accession_id", "species_taxid", "genus_taxid", "family_taxid").collect())


def test_out_of_order_batches_and_a_restart_end_as_the_batch(spark, tmp_path, rocksdb):
    m8 = R.alignments(spark, SF).withColumn("bitscore", F.round(F.col("bitscore") / 10)).where("qseqid <= 400")  # many ties
    acc, lin = R.accessions(spark, SF), R.lineage(spark, SF)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    parts = [m8.where(F.pmod(F.xxhash64("ord"), F.lit(5)) == k) for k in (3, 1, 4, 0, 2)]  # each has alignments of most reads
    stream = lambda: SH.streamed_calls(spark.readStream.schema(m8.schema).option("maxFilesPerTrigger", 1).parquet(source), acc, lin, 10)
    for p in parts[:3]:
        p.coalesce(1).write.mode("append").parquet(source)
    SH.run_available(stream(), out, checkpoint)
    some = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert _rows(SH.last_calls(spark, out)) == _rows(H.call_hits(some, acc, lin, 10))
    for p in parts[3:]:
        p.coalesce(1).write.mode("append").parquet(source)
    SH.run_available(stream(), out, checkpoint)
    got = SH.last_calls(spark, out)
    want = H.call_hits(m8, acc, lin, 10)
    # lists apply to the winner, and the batch drops human ones
    assert _rows(got.join(want.select("qseqid"), "qseqid", "left_semi")) == _rows(want)
    assert got.count() == m8.where(F.col("length") >= 10).select("qseqid").distinct().count()
    batches = spark.read.parquet(out).select("batch").distinct().count()
    assert batches == 5


def test_idle_reads_are_closed_and_forgotten(spark, tmp_path, rocksdb):
    m8 = R.alignments(spark, SF).where("qseqid <= 40")
    acc, lin = R.accessions(spark, SF), R.lineage(spark, SF)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    m8.coalesce(1).write.parquet(source)
    ids = {r["qseqid"] for r in m8.select("qseqid").distinct().collect()}
    calls = SH.streamed_calls(spark.readStream.schema(m8.schema).parquet(source), acc, lin, 0, idle=1)
    running = SH.written(calls, out, checkpoint).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            done = Path(out).exists() and {r["qseqid"] for r in spark.read.schema(SH.CALLED).parquet(out).where("closed").select("qseqid").distinct().collect()}
            if done == ids:
                break
    finally:
        running.stop()
    assert done == ids
    assert _rows(SH.last_calls(spark, out)) == _rows(H.call_hits(m8, acc, lin))


def test_calls_of_ties_have_no_state_in_python(spark):
    rng = random.Random(3)
    data = [(rng.randrange(40), rng.choice("ABCDEN") + ".1", 99.0, 50, 0.0, float(rng.randrange(2)), i) for i in range(900)] + [(99, "N.1", 99.0, 50, 0.0, 1.0, 1000), (98, "A.1", 99.0, 50, 0.0, None, 1001)]
    m8 = spark.createDataFrame(data, "qseqid long, sseqid string, pident double, length long, evalue double, bitscore double, ord long")
    acc = spark.createDataFrame([("A", 1), ("B", 1), ("C", 2), ("D", 3), ("N", 4)], "accession string, taxid long")
    lin = spark.createDataFrame([(1, 1, 10, 100), (2, 2, 10, 100), (3, 3, 30, 300), (4, None, 10, 100)], "taxid long, species long, genus long, family long")
    calls = SH.streamed_calls(m8, acc, lin)
    assert "Python" not in calls._jdf.queryExecution().toString() and "InPandas" not in calls._jdf.queryExecution().toString()
    assert _rows(calls.na.fill("", ["accession_id"])) == _rows(H.call_hits(m8, acc, lin).na.fill("", ["accession_id"]))
