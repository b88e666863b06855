"""Records by byte ranges against the same records read in one piece, however small the ranges are."""

import gzip
import random

import pytest

from strandline.sources import fastx, records


def fastq_text(rng, n, suffix="/1", newline="\n"):
    out, want = [], []
    for k in range(n):
        seq = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 90)))
        quality = rng.choice("@+>I!") + "".join(rng.choice("@+>IJ#") for _ in range(len(seq) - 1))
        header = f"r{k}{suffix} {k}"
        if k % 3 == 0 and len(seq) > 2:
            body = [seq[: len(seq) // 2], seq[len(seq) // 2 :], "+" + (header if k % 2 else ""), quality]
        else:
            body = [seq, "+", quality]
        out.append(newline.join(["@" + header, *body]) + newline)
        want.append((f"r{k}{suffix}", header, seq, quality))
    return "".join(out), want


def fasta_text(rng, n, suffix=""):
    out, want = [], []
    for k in range(n):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 200)))
        out.append(f">r{k}{suffix} x\n" + "".join(f"{seq[i : i + 60]}\n" for i in range(0, len(seq), 60)))
        want.append((f"r{k}{suffix}", f"r{k}{suffix} x", seq, None))
    return "".join(out), want


def read(spark, path, **how):
    return [tuple(r)[3:] for r in sorted(records.records(spark, str(path), **how).collect(), key=lambda r: (r["file"], r["start"]))]


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_ranges_of_any_size_give_the_same_records(spark, tmp_path, split):
    rng = random.Random(split)
    for name, (text, want) in {"a.fq": fastq_text(rng, 60), "b.fq": fastq_text(rng, 40, newline="\r\n"), "c.fa": fasta_text(rng, 60)}.items():
        path = tmp_path / name
        path.write_bytes(text.encode())
        assert read(spark, path, split=split) == want


def test_every_begin_of_a_range(tmp_path):
    text, want = fastq_text(random.Random(1), 12)
    path = tmp_path / "x.fq"
    path.write_text(text)
    for cut in range(1, len(text)):
        got = [r for b, e in ((0, cut), (cut, len(text))) for r in records._parsed(records.Part(str(path), b, e, False, "fastq"), 100)]
        assert [r[1:] for r in got] == want


def test_packed_files_without_suffix_folders_and_places(spark, tmp_path):
    rng = random.Random(3)
    one, two = fastq_text(rng, 30), fasta_text(rng, 20)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_bytes(gzip.compress(one[0].encode()) + gzip.compress(b""))
    (tmp_path / "in" / "b").write_text(two[0])
    (tmp_path / "in" / "_c").write_text("no record")
    (tmp_path / "in" / "d").write_text("")
    got = records.records(spark, f"file://{tmp_path}/in", numbered=True, split=100).collect()
    assert [tuple(r)[3:] for r in sorted(got, key=lambda r: r["ord"])] == one[1] + two[1]
    assert sorted(r["ord"] for r in got) == list(range(50))


def test_short_qualities_long_reads_and_broken_records(spark, tmp_path):
    path = tmp_path / "x"
    path.write_text("@a\nACGTA\n+\nIJ\n\n@b\n" + "A" * 50 + "\n+\n" + "I" * 60)
    assert read(spark, path, max_length=20) == [("a", "a", "ACGTA", "IJJJJ"), ("b", "b", "A" * 20, "I" * 20)]
    for bad in ("@a\nACG\n", "@a\n+\nI\n", "junk\n@a\nA\n+\nI\n", ">a\n>b\nAC\n", ">a\nAC\n+\n"):
        path.write_text(bad)
        with pytest.raises(Exception, match="record|neither"):
            read(spark, path)
    path.write_text("")
    assert read(spark, path) == []


@pytest.mark.parametrize("split", [300, 5000])
def test_mates_in_lock_step_with_other_split_points(spark, tmp_path, split):
    """Mates of very different lengths, which ranges of one size part at other records."""
    rng = random.Random(4)
    mates = [[(f"r{k}", "".join(rng.choice("ACGT") for _ in range(n))) for k in range(400)] for n in (40, 160)]
    paths = []
    for m, rows in enumerate(mates, 1):
        paths.append(tmp_path / f"{m}.fa")
        paths[-1].write_text("".join(f">{i}/{m}\n{s}\n" for i, s in rows))
    got = records.paired_files(spark, str(paths[0]), str(paths[1]), split)
    assert got.rdd.getNumPartitions() > 3
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = sorted(got.collect(), key=lambda r: r["ord"])
    assert [(r["read_id"], r["seq1"], r["seq2"]) for r in rows] == [(i, a, b) for (i, a), (_, b) in zip(*mates, strict=True)]
    # the same by Spark's text reader, split anywhere
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        both = fastx.paired(fastx.fasta(spark, str(paths[0])), fastx.fasta(spark, str(paths[1])))
        assert sorted((r["read_id"], r["seq1"], r["seq2"]) for r in both.collect()) == sorted((r["read_id"], r["seq1"], r["seq2"]) for r in rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_mates_that_do_not_fit(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text(">x/1\nA\n>y/1\nC\n")
    b.write_text(">x/2\nA\n")
    with pytest.raises(ValueError, match="2 records, but 1 mates"):
        records.paired_files(spark, str(a), str(b))
    b.write_text(">x/2\nA\n>z/2\nC\n")
    with pytest.raises(Exception, match="no pair"):
        records.paired_files(spark, str(a), str(b)).collect()


def test_mates_in_folders_of_other_files(spark, tmp_path):
    for m, cuts in ((1, [0, 3, 9]), (2, [0, 7, 9])):
        (tmp_path / str(m)).mkdir()
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            (tmp_path / str(m) / f"p{k}").write_text("".join(f">r{i}/{m}\nACG\n" for i in range(low, high)))
    rows = records.paired_files(spark, str(tmp_path / "1"), str(tmp_path / "2"), 16).collect()
    assert sorted((r["ord"], r["read_id"], r["seq2"]) for r in rows) == [(i, f"r{i}", "ACG") for i in range(9)]


def test_small_ranges_share_tasks(spark, tmp_path):
    """Ranges far smaller than a task are read together, and no more than their bytes."""
    (tmp_path / "a.fasta").write_text("".join(f">r{k}\nACGT\n" for k in range(5000)))
    rows = records.records(spark, str(tmp_path), numbered=True, split=100)
    assert rows.rdd.getNumPartitions() == 1
    assert [(r["ord"], r["read_id"]) for r in rows.orderBy("ord").collect()] == [(k, f"r{k}") for k in range(5000)]
