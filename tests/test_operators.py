import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import alignment as A
from strandline.functions import lineage as L
from strandline.functions import text as X
from strandline.operators import counts, coverage, filters, hits, merge, reports, sequences, taxonomy


def values(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, expected", [((55, -200, 1534), (55, -200001534, 1534)), ((-100, 5888, -300), (-100005888, 5888, -300)), ((-100, -200, 1534), (-100001534, -200001534, 1534)), ((55, -200, -300), (55, -200, -300)), ((1, 2, 3), (1, 2, 3))])
def test_fill_lineage(spark, given, expected):
    row = spark.createDataFrame([given], "s long, g long, f long").select(*L.fill_lineage(F.col("s"), F.col("g"), F.col("f"))).first()
    assert tuple(row) == expected


def m8(spark, rows):
    """rows: read, accession, bitscore"""
    data = [(r, a, 99.0, 50, 0.0, float(b), i) for i, (r, a, b) in enumerate(rows)]
    return spark.createDataFrame(data, "qseqid string, sseqid string, pident double, length long, evalue double, bitscore double, ord long")


@pytest.fixture(scope="module")
def dims(spark):
    acc = spark.createDataFrame([("A", 1), ("B", 1), ("C", 2), ("D", 3), ("N", 4)], "accession string, taxid long")
    lin = spark.createDataFrame([(1, 1, 10, 100), (2, 2, 10, 100), (3, 3, 30, 300), (4, None, 10, 100)], "taxid long, species long, genus long, family long")
    return acc, lin


def test_call_hits_ties_and_unknown(spark, dims):
    rows = m8(spark, [("r1", "A.1", 50), ("r1", "B.2", 50), ("r1", "C.1", 50), ("r1", "D.1", 49), ("r2", "C.1", 9), ("r2", "A.1", 9), ("r3", "N.1", 5), ("r4", "Z.9", 5)])
    got = {r["qseqid"]: r for r in hits.call_hits(rows, *dims).collect()}
    assert (got["r1"]["taxid"], got["r1"]["accession_id"]) == (1, "A.1")  # two rows of species 1; the first accession
    assert (got["r2"]["taxid"], got["r2"]["accession_id"]) == (1, "A.1")  # a tie: the smaller taxid
    assert (got["r3"]["level"], got["r3"]["taxid"], got["r3"]["accession_id"]) == (-1, -1, None)
    assert got["r4"]["species_taxid"] == -1
    deny = spark.createDataFrame([(1,)], "taxid long")
    assert {r["qseqid"] for r in hits.call_hits(rows, *dims, deny=deny).collect()} == {"r3", "r4"}


def test_taxon_counts_rollup(spark, dims):
    rows = [("a", 1, 99.0, 10, 1e-5), ("b", 1, 97.0, 20, 0.0), ("c", 2, 90.0, 30, 1.0), ("d", 4, 90.0, 30, 1.0)]
    got = counts.taxon_counts(spark.createDataFrame(rows, "read_id string, taxid long, pident double, length long, evalue double"), dims[1], "NT")
    by = {(r["tax_level"], r["tax_id"]): r for r in got.collect()}
    assert by[1, 1]["unique_count"] == 2 and by[1, -100000010]["unique_count"] == 1
    assert by[2, 10]["unique_count"] == 4 and by[3, 100]["count"] == 4
    assert by[1, 1]["e_value"] == pytest.approx((-5 + math.log10(2.0**-1022)) / 2)


def test_cluster_sizes_fall_back_on_mates(spark, dims):
    clusters = spark.createDataFrame([("x", 3)], "read_id string, size long")
    rows = spark.createDataFrame([("x/1", 1, 99.0, 10, 0.1)], "read_id string, taxid long, pident double, length long, evalue double")
    assert counts.taxon_counts(rows, dims[1], "NT", clusters).where("tax_level = 1").first()["nonunique_count"] == 3
    lost = rows.withColumn("read_id", F.lit("y"))
    with pytest.raises(Exception, match="in no cluster"):
        counts.taxon_counts(lost, dims[1], "NT", clusters).collect()


def test_taxon_filter_lists(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (9606, 9605), (-100, 7), (None, None)], "s long, g long")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "t long")
    assert values(filters.taxon_filter(df, ["s", "g"], allow=ids(10)), "s") == [(1,), (2,)]
    assert filters.taxon_filter(df, ["s", "g"], deny=ids(1, -100)).count() == 3


def test_disjoint_cover_is_greedy_in_order(spark, dims):
    data = [("q", "A.1", 99.0, 50, b, e, 0.0, s, i) for i, (b, e, s) in enumerate([(1, 100, 5.0), (50, 150, 90.0), (96, 200, 7.0)])]
    rows = spark.createDataFrame(data, "qseqid string, sseqid string, pident double, length long, qstart long, qend long, evalue double, bitscore double, ord long")
    assert values(hits.top_hit_nt(rows, *dims), "ord", "bitscore") == [(0, 5.0), (2, 7.0)]


def test_merge_prefers_contigs_then_nt(spark):
    schema = "read_id string, contig_species_taxid long, species_taxid long"
    nt = spark.createDataFrame([("a", 1, 1), ("b", None, 2), ("c", None, 3), ("e", None, None)], schema)
    nr = spark.createDataFrame([("a", 9, 9), ("b", 9, 9), ("c", None, 9), ("d", None, 9), ("e", None, 9)], schema)
    assert values(merge.merge_nt_nr(nt, nr), "read_id", "source_count_type") == [("a", "NT"), ("b", "NR"), ("c", "NT"), ("d", "NR"), ("e", "NR")]


def test_clipped_reads_become_unmapped(spark):
    rows = spark.createDataFrame([("a", 0, "c1", 5, 60, "30S70M", "=", 1, 1, "A" * 100, "I" * 100), ("b", 0, "c1", 5, 60, "10S90M", "=", 1, 1, "A" * 100, "I" * 100)], "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string")
    assert values(filters.clipped_to_unmapped(rows), "qname", "flag", "rname") == [("a", 4, "*"), ("b", 0, "c1")]


def test_scores_of_alignments(spark):
    assert one(spark, A.bitscore(F.lit(100), F.lit(2))) == pytest.approx((96 * 1.58 - math.log(0.1)) / math.log(2), abs=1e-3)
    assert one(spark, A.gap_openings(F.lit("3M1I4M2D1M"))) == 2
    assert one(spark, A.round_adaptive(F.lit(0.0526))) == 0.053


def test_coverage_of_bins(spark):
    rows = spark.createDataFrame([("k", 10, 0, 5), ("k", 10, 2, 4), ("k", 0, 0, 4)], "key string, length long, b long, e long")
    got = {r["bin"]: (r["depth"], r["breadth"], r["n"]) for r in coverage.bin_coverage(rows, 2).collect()}
    assert got == {0: (1.4, 1.0, 2)}
    assert values(coverage.covered_length(rows, "key")) == [("k", 5)]
    assert values(coverage.position_depth(rows.where("length > 0"), "key"), "b", "e", "depth") == [(0, 2, 1), (2, 4, 2), (4, 5, 1)]
    assert values(coverage.islands(rows, "key"), "b", "e") == [(0, 5)]


def test_gene_coverage_of_reversed_ranges(spark):
    ranges = spark.createDataFrame([("g", 0, 3), ("g", 9, 7)], "gene string, start long, end long")
    genes = spark.createDataFrame([("g", 20), ("h", 5), ("z", 0)], "gene string, length long")
    assert values(coverage.gene_coverage(ranges, genes), "gene", "covered", "percent") == [("g", 5, 25.0), ("h", 0, 0.0), ("z", 0, 0.0)]


def test_variant_classes(spark):
    rows = spark.createDataFrame([("A", "C"), ("A", "C,G"), ("AC", "GT"), ("A", "AT"), ("AC", "A,GT")], "ref string, alt string")
    assert values(coverage.variant_classes(rows)) == [("indel", 2), ("mnp", 1), ("snp", 2)]


def test_best_accessions_fill_up(spark):
    rows = spark.createDataFrame([("t", "a", 1, 1), ("t", "b", 9, 0), ("t", "c", 8, 0), ("t", "d", 7, 0)], "taxon string, accession string, score long, n_contigs long")
    assert values(coverage.best_accessions(rows, 3), "accession") == [("a",), ("b",), ("c",)]


def test_complexity_score(spark):
    def score(text):
        known, phrase, codes = set(text), "", 0
        for c in text:
            if phrase + c in known:
                phrase += c
            else:
                known.add(phrase + c)
                phrase, codes = c, codes + 1
        return (codes + 1) / len(text)

    texts = ["A" * 40, "ACGTTGCATTAGC", "acgt" * 10, ""]
    got = [r["x"] for r in spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(X.complexity(F.col("t")).alias("x")).collect()]
    assert got == pytest.approx([score(t.upper()) if t else 0.0 for t in texts] + [0.0])
    long = "ACGT" * 50
    assert one(spark, X.complexity(F.lit(long), 150, 0.45)) == pytest.approx(score(long) + 0.45 - (-0.113148 * math.log(200) + 1.043456))


def test_complexity_filter_falls_back(spark):
    rows = spark.createDataFrame([("a", 0.4), ("b", 0.3)], "id string, s double")
    assert values(filters.complexity_filter(rows, "s", [0.45, 0.35, 0.1]), "id") == [("a",)]
    assert filters.complexity_filter(rows, "s", [0.9]).count() == 0


def test_subsample_keeps_pairs(spark):
    rows = spark.createDataFrame([(f"r{i}", m) for i in range(20) for m in (1, 2)], "read_id string, mate int")
    got = sequences.subsample(rows, 5, 7)
    assert got.count() == 10 and got.select("read_id").distinct().count() == 5


def test_reduplicate(spark):
    reads = spark.createDataFrame([("a", "ACGT", 0), ("b", "ACGT", 1), ("c", "TTTT", 2)], "read_id string, seq string, ord long")
    clusters = sequences.duplicate_clusters(reads)
    assert values(clusters) == [("a", "a"), ("a", "b"), ("c", "c")]
    assert values(sequences.cluster_sizes(clusters)) == [("a", 2), ("c", 1)]
    kept = reads.where("read_id = 'a'").select("read_id", "seq")
    assert values(sequences.reduplicate(kept, clusters, reads), "read_id") == [("a",), ("b",)]


def test_sketch_containment_and_reduction(spark):
    import random

    rng = random.Random(3)
    big = "".join(rng.choice("ACGT") for _ in range(3000))
    rows = spark.createDataFrame([("g", "big", 3000, big), ("g", "part", 1500, big[:1500]), ("g", "other", 1000, "".join(rng.choice("ACGT") for _ in range(1000)))], "grp string, id string, length long, seq string")
    s = rows.select("grp", "id", "length", sequences.sketch(F.col("seq"), 21, 10).alias("sketch"))
    assert values(sequences.reduce_redundant(s, 0.5), "id") == [("big",), ("other",)]
    rc = big.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert one(spark, sequences.containment(sequences.sketch(F.lit(big), 21, 10), sequences.sketch(F.lit(rc), 21, 10))) == 1.0
    assert one(spark, sequences.containment(F.array().cast("array<bigint>"), F.array(F.lit(1)).cast("array<bigint>"))) == 0.0


def test_sync_pairs(spark):
    a = spark.createDataFrame([("x",), ("y",)], "read_id string")
    assert sequences.sync_pairs(a, a).count() == 2
    with pytest.raises(ValueError, match="lack a mate"):
        sequences.sync_pairs(a, a.where("read_id = 'x'"), 0.1)


def test_lineages_from_pointers(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank"), (2, 1, "family"), (3, 2, "no rank"), (4, 3, "genus"), (5, 4, "no rank"), (6, 5, "species")], "tax_id long, parent_tax_id long, rank string")
    paths = taxonomy.lineage_paths(nodes)
    assert values(paths.where("tax_id = 6"), "ancestor", "depth") == [(2, 4), (3, 3), (4, 2), (5, 1), (6, 0)]
    assert values(taxonomy.numbered_ranks(paths).where("tax_id = 6"), "rank") == [("family",), ("genus",), ("no rank",), ("no rank1",), ("species",)]
    assert values(taxonomy.wide_lineages(paths, ("family", "genus", "species")).where("tax_id in (3, 6)")) == [(3, 2, -200, -100), (6, 2, 4, 6)]


def test_versions_of_lineages(spark):
    old = [(1, 10, "v1", "v2"), (2, 10, "v1", "v2"), (2, 9, "v0", "v0"), (3, 10, "v2", "v2"), (5, None, "v1", "v2")]
    new = [(1, 10), (2, 11), (4, 12), (5, None)]
    previous, current = spark.createDataFrame(old, "taxid long, genus long, version_start string, version_end string"), spark.createDataFrame(new, "taxid long, genus long")
    got = values(taxonomy.version_lineages(previous, current, "v3").na.fill({"genus": 0}))
    assert got == sorted([(1, 10, "v1", "v3"), (2, 10, "v1", "v2"), (2, 9, "v0", "v0"), (2, 11, "v3", "v3"), (3, 10, "v2", "v2"), (4, 12, "v3", "v3"), (5, 0, "v1", "v3")])
    first = taxonomy.version_lineages(previous.limit(0), current, "v1")
    assert first.count() == 4


def test_null_keys_match_in_reports(spark):
    a, b = spark.createDataFrame([(None, 1), (1, 2)], "k long, x long"), spark.createDataFrame([(None, 3), (2, 4)], "k long, y long")
    assert sorted((str(r["k"]), r["x"], r["y"]) for r in reports.outer_merge(a, b, ["k"]).collect() if r["k"] is None) == [("None", 1, 3)]


def test_clusters_of_samples(spark):
    near = [("g", a, b, 0.01) for i, a in enumerate("abc") for b in "abc"[i + 1 :]]
    far = [("g", a, b, 0.9) for a in "abc" for b in "xy"] + [("g", "x", "y", 0.02)]
    rows = spark.createDataFrame(near + far, "grp string, a string, b string, distance double")
    assert values(reports.sample_clusters(rows), "sample", "cluster") == [("a", 0), ("b", 0), ("c", 0)]


def test_headers(spark):
    assert one(spark, X.read_id(F.lit("@r1/2 extra"))) == "r1"
    assert one(spark, X.annotated_read_id(F.lit("NR:a:NT:b:read:1"))) == "read:1"
    assert one(spark, X.gene_id(F.lit("ENST1|ENSG7.2|x"))) == "ENSG7.2" and one(spark, X.gene_id(F.lit("x"))) == "x"
    assert one(spark, L.bump_version(F.lit("AB1.9"))) == "AB1.10"
    assert one(spark, X.guard_cell(F.lit("=1"))) == "'=1"
    assert one(spark, X.repair_header(F.lit("A1, x\x01B2, y z"))) == "A1 x\x01B2 y z"


def test_kept_frames_and_running_sums(spark):
    from strandline.operators import scalar

    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k"), F.lit(2).alias("n"))
    got = scalar.running_sums(df, [F.desc("k")], before="n").collect()
    assert {(r["k"], r["before"]) for r in got} == {(k, 2 * (999 - k)) for k in range(1000)}
    assert scalar.running_sums(df.limit(0), [F.asc("k")], before="n").count() == 0
    assert scalar.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_greedy_reduction_matches_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in range(120):
        base = set(rng.sample(range(60), rng.randrange(0, 14)))
        rows.append((k % 3, k, rng.randrange(5, 12), sorted(base)))
        if k % 4 == 0:
            rows.append((k % 3, 1000 + k, rng.randrange(5, 12), sorted(base)))
    df = spark.createDataFrame(rows, "grp int, id int, length int, sketch array<long>")
    want = []
    for g in range(3):
        stay = []
        for _, i, n, s in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])):
            if not s or not any(len(set(s) & t) >= 0.5 * len(s) for t in stay):
                stay.append(set(s))
                want.append((g, i))
    assert sorted((r["grp"], r["id"]) for r in sequences.reduce_redundant(df, 0.5).collect()) == sorted(want)
    cut = sequences.reduce_all(df, 0.5, 30).collect()
    assert len(cut) <= len(rows) and {r["grp"] for r in cut} == {0, 1, 2}


def test_complexity_matches_brute_force(spark):
    from strandline.functions import text

    def codes(t):
        known, phrase, n = set(t), "", 0
        for c in t:
            if phrase + c in known:
                phrase += c
            else:
                known.add(phrase + c)
                phrase, n = c, n + 1
        return n + 1

    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGT" if k % 2 else "aAcCé世") for _ in range(rng.randrange(1, 150))) for k in range(60)] + ["A" * 140, "", None]
    df = spark.createDataFrame([(s,) for s in seqs], "s string").select("s", text.complexity(F.col("s")).alias("x"))
    for r in df.collect():
        assert r["x"] == pytest.approx(codes(r["s"].upper()) / len(r["s"]) if r["s"] else 0.0)
