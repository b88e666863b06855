import random

import pytest
from pyspark.sql import functions as F

from strandline import schemas
from strandline.plans import classification
from strandline.sources import fastx, sinks, tables
from strandline.streaming import hits as streaming


def write(path, text):
    path.write_text(text)
    return str(path)


M8 = "r1\tA.1\t99.0\t50\t0\t0\t1\t50\t1\t50\t1e-5\t90\n# note\nr2\tB.1\t99.0\t20\t0\t0\t1\t50\t1\t50\t0\t90\nr3\tB.1\t99.0\t50\t0\t0\t1\t50\t1\t50\tNaN\t90\nr4\tB.1\t101.0\t50\t0\t0\t1\t50\t1\t50\t0\t90\n"


def test_m8(spark, tmp_path):
    path = write(tmp_path / "a.m8", M8)
    assert [r["qseqid"] for r in tables.m8(spark, path, min_length=36).collect()] == ["r1"]
    wide = tables.m8(spark, path, schemas.M8_RERANKED, only_valid=False)
    assert wide.where("qlen is null").count() == 4
    with pytest.raises(Exception, match="too many fields"):
        tables.typed_tsv(spark, path, schemas.LINEAGE).collect()


def test_fasta_and_fastq(spark, tmp_path):
    fa = write(tmp_path / "a.fa", ">a one\nACGT\nAC\n>b\nTT\n")
    assert [(r["read_id"], r["seq"]) for r in fastx.fasta(spark, fa).orderBy("ord").collect()] == [("a", "ACGTAC"), ("b", "TT")]
    fq = write(tmp_path / "a.fq", "@a x\nACGT\n+\nII\n@b\nAC\nGT\n+b\nIIII\n")
    assert [(r["read_id"], r["seq"], r["quality"]) for r in fastx.fastq(spark, fq).orderBy("ord").collect()] == [("a", "ACGT", "IIII"), ("b", "ACGT", "IIII")]  # filled up with the last letter


def parsed(text):
    """FASTQ records by the rule that a + line ends the sequence and only a first quality line may begin with @, + or >."""
    lines, at, out = text.split("\n"), 0, []
    while at < len(lines) and lines[at]:
        head, at, seq = lines[at], at + 1, ""
        while lines[at][:1] not in ("@", "+", ">"):
            seq, at = seq + lines[at], at + 1
        quality, at = lines[at + 1], at + 2
        while at < len(lines) and lines[at] and lines[at][0] not in "@+>":
            quality, at = quality + lines[at], at + 1
        quality = (quality + quality[-1] * len(seq))[: len(seq)]
        out.append((head[1:].split()[0], seq, quality))
    return out


@pytest.mark.parametrize("split", [None, 64])
def test_fastq_of_any_qualities(spark, tmp_path, split):
    rng = random.Random(2)
    rows = []
    for k in range(200):
        n = rng.randrange(1, 30)
        seq = "".join(rng.choice("ACGTN") for _ in range(n))
        quality = rng.choice("@+>I") + "".join(rng.choice("@+>I#") for _ in range(n - 1))
        cut = rng.randrange(1, n + 1)
        rows += [f"@r{k} x", *([seq[:cut], seq[cut:]] if cut < n else [seq]), rng.choice(["+", f"+r{k}"]), quality[: rng.randrange(1, n + 1)]]
    path = write(tmp_path / "q.fq", "\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:  # records across many splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        got = [(r["read_id"], r["seq"], r["quality"]) for r in fastx.fastq(spark, path).orderBy("ord").collect()]
        numbers = [(r["line_no"], r["value"]) for r in fastx.numbered_lines(spark, path).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == parsed("\n".join(rows) + "\n") and len(got) == 200 and numbers == list(enumerate(rows, 1))


def test_files_that_are_no_records(spark, tmp_path):
    for k, text in enumerate(("@a\nAC\n+\n", "@a\n+\nII\n", "ACGT\n@a\nAC\n+\nII\n", "@a\nAC\n@b\nAC\n+\nII\n")):
        with pytest.raises(Exception, match="not a FASTQ record"):
            fastx.fastq(spark, write(tmp_path / f"{k}.fq", text)).collect()
    with pytest.raises(Exception, match="not a FASTA record"):
        fastx.fasta(spark, write(tmp_path / "x.fa", ">a\nAC\n>b\n>c\nGT\n")).collect()
    assert fastx.sniffed(spark, write(tmp_path / "s", "\n>a\nAC\n")) == "fasta" and fastx.sniffed(spark, write(tmp_path / "t", "@a")) == "fastq"
    with pytest.raises(ValueError, match="neither"):
        fastx.sniffed(spark, write(tmp_path / "u", "xyz\n"))


def test_pairs_by_place(spark, tmp_path):
    one = fastx.fastq(spark, write(tmp_path / "1.fq", "@a/1\nAC\n+\nII\n@b/1\nGG\n+\nII\n"))
    two = fastx.fastq(spark, write(tmp_path / "2.fq", "@a/2\nTT\n+\nII\n@b/2\nCC\n+\nII\n"))
    assert sorted((r["read_id"], r["seq1"], r["seq2"]) for r in fastx.paired(one, two).collect()) == [("a", "AC", "TT"), ("b", "GG", "CC")]
    with pytest.raises(Exception, match="no pair"):
        fastx.paired(one, two.where("ord = 0")).collect()


def test_paf(spark, tmp_path):
    path = write(tmp_path / "a.paf", "q\t100\t0\t90\t-\tt\t500\t10\t100\t88\t90\t60\tNM:i:2\tcg:Z:40M1I49M\n")
    row = tables.paf_to_m8(tables.paf(spark, path)).first()
    assert (row["qstart"], row["sstart"], row["send"], row["gapopen"], row["mismatch"]) == (1, 100, 11, 1, 2)


def test_small_tables(spark, tmp_path):
    dmp = write(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\tx\t|\n5\t|\t1\t|\tgenus\t|\t\t|\n")
    assert [tuple(r) for r in tables.taxdump(spark, dmp, schemas.NODES).collect()] == [(1, 1, "no rank"), (5, 1, "genus")]
    acc = write(tmp_path / "acc", "accession\taccession.version\ttaxid\tgi\nX1\tX1.1\t7\t0\n")
    full = write(tmp_path / "full", "accession.version\ttaxid\nX2.3\t8\n")
    assert [tuple(r) for p in (acc, full) for r in tables.accession_map(spark, p).collect()] == [("X1", 7), ("X2", 8)]
    stats = write(tmp_path / "s", "SN\traw total sequences:\t10\t# n\nFFQ\t1\n")
    assert [tuple(r) for r in tables.samtools_stats(spark, stats).collect()] == [("raw total sequences", 10.0)]
    with pytest.raises(Exception, match="not a species"):
        tables.truth(spark, write(tmp_path / "t", "7\t_\t0.5\tgenus\tx\n")).collect()


def test_fetch_sequence_tries_the_next_version(spark):
    wanted = spark.createDataFrame([("A.1",), ("B.1",), ("C.1",)], "accession string")
    nt, nr = (spark.createDataFrame(rows, "accession string, seq string") for rows in ([("B.2", "b2"), ("A.1", "nt")], [("A.1", "nr")]))
    assert sorted(tuple(r) for r in tables.fetch_sequence(wanted, nt, nr).collect()) == [("A.1", "nt"), ("B.1", "b2")]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, None)], "x string, y long")
    sinks.typed_tsv(df, str(tmp_path / "t"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect())
    assert lines == ["\t", "a\t1"]
    sinks.taxon_counts_json(df, str(tmp_path / "j"))
    assert tables.taxon_counts(spark, str(tmp_path / "j")).count() == 2
    sinks.key_value_table(df.where("x is not null"), "kv_test", "x", 2)
    assert spark.table("kv_test").count() == 1


def test_running_best_over_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("r", "A", 5.0, 0), ("r", "B", 9.0, 1), ("r", "C", 9.0, 2)], "qseqid string, sseqid string, bitscore double, ord long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = streaming.running_best(stream).writeStream.outputMode("complete").format("memory").queryName("best").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [tuple(r) for r in spark.table("best").collect()] == [("r", "B", 9.0, 3)]


def test_short_read_analysis(spark):
    al = lambda rows: spark.createDataFrame([(r, a, 99.0, 50, 0.0, s, i) for i, (r, a, s) in enumerate(rows)], "qseqid string, sseqid string, pident double, length long, evalue double, bitscore double, ord long")
    acc = spark.createDataFrame([("A", 1), ("B", 2)], "accession string, taxid long")
    lin = spark.createDataFrame([(1, 1, 10, 100), (2, 2, 10, 100)], "taxid long, species long, genus long, family long")
    r2c = spark.createDataFrame([("r1", "c1"), ("r2", "*")], "read_id string, contig_id string")
    r2c = r2c.unionByName(spark.createDataFrame([("r9", "c1")], "read_id string, contig_id string"))  # in no alignment of its own
    top = spark.createDataFrame([("c1", 2, "B", 2, 10, 100, 77.0, 500, 1e-9)], "contig_id string, taxid long, accession_id string, species_taxid long, genus_taxid long, family_taxid long, pident double, length long, evalue double")
    out = classification.short_read(al([("r1", "A", 9.0), ("r2", "A", 9.0)]), al([("r3", "B", 5.0)]), acc, lin, r2c, top, top)
    merged = {(r["tax_level"], r["tax_id"]): r["count"] for r in out["merged_NT_NR"].collect()}
    assert merged == {(1, 1): 1, (1, 2): 3, (2, 10): 4, (3, 100): 4}
    # r1 and r9 with their contig's identity, r3 with its own
    assert out["merged_NT_NR"].where("tax_level = 1 and tax_id = 2").first()["percent_identity"] == pytest.approx((77 + 77 + 99) / 3)
    assert out["NT"].where(F.col("tax_level") == 1).count() == 1
