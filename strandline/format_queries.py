"""The catalogue's queries over files: each writes rows of the provided tables in a format, below the shared folder, and
answers from what its reader gives back; then queries of filters and joins over reads, contigs and references."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline import roles as R
from strandline import schemas
from strandline.functions import alignment as A
from strandline.functions import dust as D
from strandline.functions import lineage as L
from strandline.functions import text as X
from strandline.operators import counts as C
from strandline.operators import coverage as V
from strandline.operators import filters as FL
from strandline.operators import merge as M
from strandline.operators import reports as P
from strandline.operators import sequences as S
from strandline.operators import sketch_tree as ST
from strandline.operators import taxonomy as T
from strandline.operators.scalar import kept, shared_folder, spread
from strandline.plans.observed import StepCounts, with_sizes
from strandline.queries import _READS, _reads, query
from strandline.roles import M8_SQL, table
from strandline.sources import fastx, file_index, records, sinks, tables


def _written(spark, lines):
    """A file of lines, a frame of one column."""
    path = shared_folder(spark)
    lines.write.text(path)
    return path


def _line(*columns):
    return F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in columns))


# ------------------------------------------------------------------ tables of text
@query(f"WITH {M8_SQL} SELECT CAST(qseqid AS VARCHAR) AS qseqid, sseqid, length, pident, evalue, bitscore FROM m8 WHERE length >= 36 AND pident > -0.25 AND pident < 100.25 AND evalue <= 1")
def m8_file(spark, d):
    path = shared_folder(spark)
    sinks.typed_tsv(R.alignments(spark, d).select(*schemas.M8.fieldNames()), path)
    return tables.m8(spark, path, min_length=36).select("qseqid", "sseqid", "length", "pident", "evalue", "bitscore")


@query("SELECT 'r' || c_custkey AS read_id, CAST(if(c_custkey % 3 = 0, -1, 1) AS INT) AS level, CAST(c_nationkey AS BIGINT) AS taxid, if(c_custkey % 5 = 0, NULL, 'A' || c_custkey) AS accession_id, CAST(NULL AS BIGINT) AS species_taxid FROM customer")
def hit_summary_file(spark, d):
    c = table(spark, d, "customer")
    rows = c.select(F.concat(F.lit("r"), "c_custkey").alias("read_id"), F.when(F.col("c_custkey") % 3 == 0, -1).otherwise(1).alias("level"), F.col("c_nationkey").alias("taxid"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("A"), "c_custkey")).alias("accession_id"))
    path = shared_folder(spark)
    sinks.typed_tsv(rows, path)
    return tables.hit_summary(spark, path).select("read_id", "level", "taxid", "accession_id", "species_taxid")


def _sam(spark, d):
    """Orders as alignment records: every third mapped, every fifth clipped by a third; pairs of flags for the rest."""
    k = F.col("o_orderkey")
    flag = F.when(k % 3 == 0, 0).when(k % 3 == 1, 77).otherwise(141)
    seq = F.repeat(F.lit("ACGT"), 5)
    line = _line(F.concat(F.lit("q"), F.when(k % 3 == 2, k - 1).otherwise(k)), flag, F.when(k % 3 == 0, F.concat(F.lit("ref"), F.col("o_custkey") % 7)).otherwise("*"), F.col("o_custkey"), F.lit(60), F.when(k % 5 == 0, "5S15M").otherwise("20M"), F.lit("*"), F.lit(0), F.lit(0), seq, F.repeat(F.lit("I"), 20), F.lit("NM:i:1"))
    lines = table(spark, d, "orders").select(line.alias("value")).unionByName(spark.createDataFrame([("@HD\tVN:1.6",), ("@SQ\tSN:ref1\tLN:99",)], "value string"))
    return tables.sam(spark, _written(spark, lines))


_SAM = "sam AS (SELECT 'q' || if(o_orderkey % 3 = 2, o_orderkey - 1, o_orderkey) AS qname, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 77 ELSE 141 END AS flag, if(o_orderkey % 3 = 0, 'ref' || (o_custkey % 7), '*') AS rname, o_custkey AS pos, o_orderkey % 5 = 0 AS clipped FROM orders)"


@query(f"WITH {_SAM} SELECT qname, CAST(if(clipped, 4, flag) AS INT) AS flag, if(clipped, '*', rname) AS rname, CAST(if(clipped, 0, pos) AS BIGINT) AS pos FROM sam")
def sam_file_clipped(spark, d):
    return FL.clipped_to_unmapped(_sam(spark, d)).select("qname", "flag", "rname", "pos")


@query(f"WITH {_SAM} SELECT a.qname AS read_id, CAST(20 AS INT) AS n1, CAST(20 AS INT) AS n2 FROM sam a JOIN sam b ON a.qname = b.qname AND a.flag = 77 AND b.flag = 141")
def sam_unmapped_pairs(spark, d):
    return FL.unmapped_pairs(_sam(spark, d)).select("read_id", F.length("seq1").alias("n1"), F.length("seq2").alias("n2"))


@query(f"WITH {_SAM} SELECT rname AS contig_id, count(*) AS n_reads, count(*) AS n_unique, CAST(20 * count(*) AS BIGINT) AS n_bases FROM sam WHERE flag = 0 GROUP BY rname HAVING count(*) >= 4")
def sam_reads_per_contig(spark, d):
    return C.reads_per_contig(_sam(spark, d).where("flag = 0"))


@query("""SELECT 'q' || l_orderkey || '.' || l_linenumber AS qseqid, 'ref' || l_suppkey AS sseqid, CAST(l_quantity AS BIGINT) AS length, 1 + CAST(l_linenumber AS BIGINT) AS qstart,
  CAST(if(l_linenumber % 2 = 0, 900, l_partkey % 100 + 1) AS BIGINT) AS sstart, CAST(if(l_linenumber % 2 = 0, l_partkey % 100 + 1, 900) AS BIGINT) AS send, CAST(l_linenumber % 3 AS BIGINT) AS mismatch, CAST(2 AS BIGINT) AS gapopen,
  round_even((CAST(l_quantity AS BIGINT) - 2 * (l_linenumber % 3)) * 1.58 / ln(2) - ln(0.1) / ln(2), 3) AS bitscore FROM lineitem""")
def paf_file(spark, d):
    n = F.col("l_linenumber")
    line = _line(F.concat(F.lit("q"), "l_orderkey", F.lit("."), n), F.lit(200), n, n + 60, F.when(n % 2 == 0, "-").otherwise("+"), F.concat(F.lit("ref"), "l_suppkey"), F.lit(1000), F.col("l_partkey") % 100, F.lit(900), F.lit(40), F.col("l_quantity").cast("long"), F.lit(60), F.concat(F.lit("NM:i:"), n % 3), F.lit("cg:Z:9M1I5M2D4M"))
    rows = tables.paf_to_m8(tables.paf(spark, _written(spark, table(spark, d, "lineitem").select(line.alias("value")))))
    return rows.select("qseqid", "sseqid", "length", "qstart", "sstart", "send", "mismatch", "gapopen", "bitscore")


@query("SELECT CAST(n_nationkey + 100 AS BIGINT) AS tax_id, CAST(n_regionkey + 1 AS BIGINT) AS parent_tax_id, 'genus' AS rank FROM nation")
def taxdump_file(spark, d):
    line = F.concat_ws("\t|\t", F.col("n_nationkey") + 100, F.col("n_regionkey") + 1, F.lit("genus"), F.lit("x\t|"))
    return tables.taxdump(spark, _written(spark, table(spark, d, "nation").select(line.alias("value"))), schemas.NODES)


@query("SELECT 'S' || s_suppkey AS accession, CAST(s_nationkey AS BIGINT) AS taxid FROM supplier")
def accession_map_file(spark, d):
    s = table(spark, d, "supplier")
    a = F.concat(F.lit("S"), "s_suppkey")
    short = s.where("s_suppkey % 2 = 0").select(_line(F.concat(a, F.lit(".2")), "s_nationkey").alias("value")).unionByName(spark.createDataFrame([("accession.version\ttaxid",)], "value string"))
    long = s.where("s_suppkey % 2 = 1").select(_line(a, F.concat(a, F.lit(".1")), "s_nationkey", F.lit(0)).alias("value")).unionByName(spark.createDataFrame([("accession\taccession.version\ttaxid\tgi",)], "value string"))
    return tables.accession_map(spark, _written(spark, short)).unionByName(tables.accession_map(spark, _written(spark, long)))


@query("SELECT CAST(c_custkey AS BIGINT) AS taxid FROM customer WHERE c_custkey % 3 <> 0")
def id_list_file(spark, d):
    c = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "# none").otherwise(F.concat(F.lit(" "), "c_custkey")).alias("value"))
    return tables.id_list(spark, _written(spark, c))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS taxid, n_name AS genus_name, if(n_regionkey = 0, NULL, 'Chordata') AS phylum_name FROM nation WHERE n_regionkey <> 0")
def named_lineages_file(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("genus_name"), F.when(F.col("n_regionkey") != 0, "Chordata").alias("phylum_name"))
    path = shared_folder(spark)
    rows.write.option("header", True).csv(path)
    return FL.lineages_of_phyla(tables.named_lineages(spark, path))


@query("SELECT if(doc_id % 3 = 0, '=', '') || 'd' || (doc_id - doc_id % 4) AS representative, if(doc_id % 3 = 0, '=', '') || 'd' || doc_id AS read_id FROM documents")
def clusters_file(spark, d):
    name = lambda c: F.concat(F.when(F.col("doc_id") % 3 == 0, "=").otherwise(""), F.lit("d"), c)
    rows = table(spark, d, "documents").select(name(F.col("doc_id") - F.col("doc_id") % 4).alias("a"), name(F.col("doc_id")).alias("b"))
    lines = rows.select(F.concat_ws(",", X.guard_cell(F.col("a")), X.guard_cell(F.col("b"))).alias("value")).unionByName(spark.createDataFrame([("representative read id,read id",)], "value string"))
    return tables.clusters(spark, _written(spark, lines))


@query("SELECT CAST(c_nationkey AS BIGINT) AS tax_id, count(*) AS unique_count, sum(c_acctbal) AS total FROM customer GROUP BY c_nationkey")
def taxon_counts_file(spark, d):
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("tax_id")).agg(F.count("*").alias("unique_count"), F.sum("c_acctbal").alias("total"))
    path = shared_folder(spark)
    sinks.taxon_counts_json(counts, path)
    return tables.taxon_counts(spark, path).select("tax_id", "unique_count", "total")


@query("SELECT o_orderpriority AS step, count(*) AS count FROM orders GROUP BY 1")
def step_counts_file(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("step")).agg(F.count("*").alias("count"))
    entries = F.map_from_entries(F.collect_list(F.struct("step", F.col("count").cast("string"))))  # an entry per step
    return tables.step_counts(spark, _written(spark, counts.agg(F.to_json(entries).alias("value")).coalesce(1)))


@query("SELECT CAST(c_nationkey AS BIGINT) AS taxid, 'c' || c_custkey AS name FROM customer")
def per_key_json_files(spark, d):
    path = shared_folder(spark)
    sinks.per_key_json(table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("taxid"), F.concat(F.lit("c"), "c_custkey").alias("name")), path, "taxid")
    return spark.read.schema("name string, taxid long").json(path).select("taxid", "name")


@query("SELECT 'chr' || (o_orderkey % 5) AS chrom, CAST(o_custkey AS BIGINT) AS pos, 'A' AS ref, 'G' AS alt FROM orders")
def vcf_file(spark, d):
    line = _line(F.concat(F.lit("chr"), F.col("o_orderkey") % 5), "o_custkey", F.lit("."), F.lit("A"), F.lit("G"), F.lit("50"), F.lit("PASS"))
    return tables.vcf(spark, _written(spark, table(spark, d, "orders").select(line.alias("value")).unionByName(spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS",)], "value string"))))


@query("SELECT 'n ' || r_name AS name, CAST(r_regionkey + 0.5 AS DOUBLE) AS value FROM region")
def samtools_stats_file(spark, d):
    line = _line(F.lit("SN"), F.concat(F.lit("n "), "r_name", F.lit(":")), F.col("r_regionkey") + 0.5, F.lit("# note"))
    return tables.samtools_stats(spark, _written(spark, table(spark, d, "region").select(line.alias("value")).unionByName(spark.createDataFrame([("FFQ\t1\t2",)], "value string"))))


@query("SELECT CAST(s_suppkey AS BIGINT) AS taxid, s_acctbal AS abundance, s_name AS species_name FROM supplier")
def truth_file(spark, d):
    return tables.truth(spark, _written(spark, table(spark, d, "supplier").select(_line("s_suppkey", F.lit("_"), "s_acctbal", F.lit("species"), "s_name").alias("value"))))


@query("SELECT CASE o_orderkey % 3 WHEN 0 THEN 'error' ELSE 'warning' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'Error in step ' || o_orderkey ELSE 'a WARNING ' || o_orderkey END AS value FROM orders WHERE o_orderkey % 3 <> 2")
def assembler_log_file(spark, d):
    k = F.col("o_orderkey")
    line = F.when(k % 3 == 0, F.concat(F.lit("Error in step "), k)).when(k % 3 == 1, F.concat(F.lit("a WARNING "), k)).otherwise(F.concat(F.lit("fine "), k))
    return tables.assembler_log(spark, _written(spark, table(spark, d, "orders").select(line.alias("value"))))


# ------------------------------------------------------------------ sequences as files
def _sequence(key):
    return F.concat(F.repeat(F.lit("ACGT"), (key % 20 + 1).cast("int")), F.repeat(F.lit("N"), (key % 4).cast("int")))


_SEQUENCE = "repeat('ACGT', CAST({k} % 20 + 1 AS INT)) || repeat('N', CAST({k} % 4 AS INT))"


@query(f"SELECT 'c' || c_custkey AS read_id, 'c' || c_custkey || ' ' || c_nationkey AS header, {_SEQUENCE.format(k='c_custkey')} AS seq FROM customer")
def fasta_file(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), k, F.lit(" "), "c_nationkey").alias("header"), _sequence(k).alias("whole"))
    wrapped = c.select("header", F.concat_ws("\n", F.substring("whole", 1, 7), F.expr("nullif(substring(whole, 8), '')")).alias("seq"))
    path = shared_folder(spark)
    fastx.to_fasta(wrapped, path)
    return fastx.fasta(spark, path).select("read_id", "header", "seq")


def _fastq_lines(spark, d):
    """Customers as FASTQ; qualities begin with @ for every other one, and lack their last letters for every third."""
    k = F.col("c_custkey")
    quality = F.concat(F.when(k % 2 == 0, "@").otherwise("I"), F.repeat(F.chr(F.lit(40) + k % 30), (F.length("seq") - 1 - F.when(k % 3 == 0, 2).otherwise(0)).cast("int")))
    rows = table(spark, d, "customer").withColumn("seq", _sequence(k)).withColumn("quality", quality)
    return rows.select(F.concat_ws("\n", F.concat(F.lit("@c"), k, F.lit("/1 x")), F.substring("seq", 1, 3), F.expr("substring(seq, 4)"), F.lit("+"), "quality").alias("value"))


def _fastq(spark, d):
    return fastx.fastq(spark, _written(spark, _fastq_lines(spark, d)))


def _mates(spark, d):
    """Customers as two FASTA files, mates of 4 to 83 letters and of four times as many, so that ranges part them elsewhere."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.concat(F.lit("c"), k).alias("id"), _sequence(k).alias("seq"))
    paths = [shared_folder(spark), shared_folder(spark)]
    for m, path in enumerate(paths, 1):
        fastx.to_fasta(rows.select(F.concat("id", F.lit(f"/{m}")).alias("header"), F.repeat("seq", 1 if m == 1 else 4).alias("seq")), path)
    return paths


_PAIRS_SQL = f"SELECT 'c' || c_custkey AS read_id, {_SEQUENCE.format(k='c_custkey')} AS seq1, CAST(4 * length({_SEQUENCE.format(k='c_custkey')}) AS INT) AS n2 FROM customer"


@query(_PAIRS_SQL)
def fasta_pairs(spark, d):
    both = fastx.paired(*(fastx.fasta(spark, p) for p in _mates(spark, d)))
    return both.select("read_id", "seq1", F.length("seq2").alias("n2"))


@query(_PAIRS_SQL)
def lock_step_pairs(spark, d):
    both = records.paired_files(spark, *_mates(spark, d), split=20_000)
    return both.select("read_id", "seq1", F.length("seq2").alias("n2"))


_FASTQ = f"""base AS (SELECT c_custkey AS k, {_SEQUENCE.format(k='c_custkey')} AS seq FROM customer),
given AS (SELECT k, seq, if(k % 2 = 0, '@', 'I') || repeat(chr(CAST(40 + k % 30 AS INT)), CAST(length(seq) - 1 - if(k % 3 = 0, 2, 0) AS INT)) AS q FROM base),
fq AS (SELECT k, 'c' || k || '/1' AS read_id, 'c' || k || '/1 x' AS header, seq, rpad(q, CAST(length(seq) AS INT), q[-1]) AS quality FROM given)"""


@query(f"WITH {_FASTQ} SELECT read_id, header, seq, quality FROM fq")
def fastq_file(spark, d):
    return _fastq(spark, d).select("read_id", "header", "seq", "quality")


def _range_records(spark, d, compression, split):
    path = shared_folder(spark)
    _fastq_lines(spark, d).write.option("compression", compression).text(path)
    return records.records(spark, path, numbered=True, split=split).select("read_id", "header", "seq", "quality", "ord")


@query(f"WITH {_FASTQ} SELECT read_id, header, seq, quality, row_number() OVER (ORDER BY k) - 1 AS ord FROM fq")
def fastq_ranges(spark, d):
    return _range_records(spark, d, "none", 10_000)


@query(f"WITH {_FASTQ} SELECT read_id, header, seq, quality, row_number() OVER (ORDER BY k) - 1 AS ord FROM fq")
def packed_fastq(spark, d):
    return _range_records(spark, d, "gzip", 10_000)


@query(f"WITH {_FASTQ} SELECT read_id, CAST(length(seq) AS INT) AS n FROM fq WHERE length(seq) >= 35 AND length(seq) - length(replace(seq, 'N', '')) <= 2 AND len(list_filter(string_split(quality, ''), lambda c: ascii(c) - 33 < 17)) / length(seq) <= 0.15")
def quality_filtered(spark, d):
    return FL.quality_filter(_fastq(spark, d), max_unknown=2).select("read_id", F.length("seq").alias("n"))


def _repetitive(key):
    """Sixty sequences of 1 to 69 letters: a unit of up to four letters several times, then other letters."""
    k = key % 60
    unit = F.substring(F.lit("ACGTTGCA"), (k % 5 + 1).cast("int"), (k % 4 + 1).cast("int"))
    return F.concat(F.repeat(unit, (k % 13 + 1).cast("int")), F.substring(F.lit("GATTACAGCTTNCATCG"), F.lit(1), (k % 18).cast("int")))


_REPETITIVE = """c AS (SELECT c_custkey AS k, repeat(substr('ACGTTGCA', (c_custkey % 60) % 5 + 1, (c_custkey % 60) % 4 + 1), CAST((c_custkey % 60) % 13 + 1 AS INT)) || substr('GATTACAGCTTNCATCG', 1, (c_custkey % 60) % 18) AS seq FROM customer)"""


@query(f"""WITH {_REPETITIVE}, t AS (SELECT k, seq, substr(seq, p, 3) AS t, count(*) AS n FROM c, unnest(range(1, length(seq) - 1)) u(p) GROUP BY ALL)
  SELECT k AS customer, round(CAST(sum(n * (n - 1) // 2) AS BIGINT) / (length(seq) - 3), 9) AS score FROM t WHERE length(seq) >= 4 GROUP BY k, seq""")
def dust_scores(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("customer"), _repetitive(F.col("c_custkey")).alias("seq"))
    return rows.where(F.length("seq") >= 4).select("customer", F.round(D.window_score(F.col("seq")), 9).alias("score"))


@query(f"""WITH {_REPETITIVE}, s AS (SELECT DISTINCT seq, length(seq) - 2 AS m FROM c),
  iv AS (SELECT seq, i, j FROM s, unnest(range(1, m)) a(i), unnest(range(2, m + 1)) b(j) WHERE j > i AND j < i + 62 AND position('N' IN substr(seq, i, j - i + 3)) = 0),
  n AS (SELECT seq, i, j, substr(seq, p, 3) AS t, count(*) AS n FROM iv, unnest(range(i, j + 1)) u(p) GROUP BY ALL),
  sc AS (SELECT seq, i, j, CAST(sum(n * (n - 1) // 2) AS BIGINT) AS pairs, j - i AS d FROM n GROUP BY seq, i, j),
  perfect AS (SELECT * FROM sc a WHERE pairs > 2 * d AND NOT EXISTS (SELECT 1 FROM sc b WHERE b.seq = a.seq AND b.i >= a.i AND b.j <= a.j AND b.pairs * a.d > a.pairs * b.d)),
  masked AS (SELECT seq, count(DISTINCT p) AS n FROM perfect, unnest(range(i, j + 3)) u(p) GROUP BY seq)
  SELECT k AS customer, coalesce(n, 0) AS masked, length(seq) > 0 AND 100 * (length(seq) - coalesce(n, 0)) >= 60 * length(seq) AS passes FROM c LEFT JOIN masked USING (seq)""")
def dust_masked(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("customer"), _repetitive(F.col("c_custkey")).alias("seq"))
    masked = rows.withColumn("share", D.unmasked_share(F.col("seq")))
    return masked.select("customer", F.round((1 - F.col("share")) * F.length("seq")).cast("long").alias("masked"), (100 * F.col("share") >= 60).alias("passes"))


@query(f"WITH {_FASTQ} SELECT read_id FROM fq WHERE 1 - (length(seq) - length(replace(seq, 'N', ''))) / length(seq) >= 0.9 AND 1 - len(list_filter(string_split(quality, ''), lambda c: ascii(c) - 33 < 17)) / length(seq) >= 0.85")
def called_filtered(spark, d):
    return FL.called_filter(_fastq(spark, d)).select("read_id")


@query(f"WITH {_FASTQ} SELECT count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases, CAST(count(*) // 2 AS BIGINT) AS fragments FROM fq")
def read_totals(spark, d):
    return C.read_totals(_fastq(spark, d), 2)


@query(f"WITH {_FASTQ} SELECT CAST(k % 3 AS BIGINT) AS reads, k FROM fq WHERE false UNION ALL SELECT CAST(sum(1 + k % 3) AS BIGINT), CAST(sum(length(seq) * (1 + k % 3)) AS BIGINT) FROM fq".replace("AS reads, k FROM", "AS reads, CAST(k AS BIGINT) AS bases FROM"))
def read_totals_with_duplicates(spark, d):
    sizes = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("read_id"), (1 + F.col("c_custkey") % 3).alias("size"))
    return C.read_totals(_fastq(spark, d), 2, sizes).select("reads", "bases")


@query(f"WITH {_FASTQ} SELECT read_id, seq FROM fq")
def sorted_reads(spark, d):
    return S.sorted_by_id(S.unique_ids(_fastq(spark, d))).select("read_id", "seq")


@query(f"WITH {_FASTQ} SELECT read_id FROM fq WHERE length(seq) <= 500")
def short_reads(spark, d):
    return FL.short_reads_only(_fastq(spark, d)).select("read_id")


@query(f"WITH {_FASTQ} SELECT read_id, length(seq) AS n FROM fq WHERE length(seq) BETWEEN 20 AND 60")
def reads_by_length(spark, d):
    return FL.by_length(_fastq(spark, d), "seq", 20, 60).select("read_id", F.length("seq").cast("long").alias("n"))


@query("""SELECT 'character' AS error, CAST(min(n) AS BIGINT) AS first_line, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id FROM documents) WHERE doc_id % 7 = 3
  UNION ALL SELECT 'long', min(n), count(*) FROM (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id FROM documents) WHERE doc_id % 11 = 5 AND doc_id % 7 <> 3
  UNION ALL SELECT 'incomplete', count(*), 1 FROM documents HAVING count(*) % 3 <> 0""")
def line_errors(spark, d):
    k = F.col("doc_id")
    text = F.when(k % 7 == 3, F.concat(F.lit("é"), k)).when(k % 11 == 5, F.repeat(F.lit("A"), 120)).otherwise(k.cast("string"))
    path = shared_folder(spark)
    sinks.concatenated(table(spark, d, "documents").orderBy("doc_id").select(text.alias("value")), path, "none")
    lines = fastx.numbered_lines(spark, path)
    return FL.line_violations(lines, 100).unionByName(FL.record_violations(lines, 3))


@query("SELECT p_partkey AS key, {s} AS seq FROM part WHERE p_partkey % 9 = 0".format(s=_SEQUENCE.format(k="p_partkey") + " || 'E'"))
def foreign_letters(spark, d):
    k = F.col("p_partkey")
    return FL.reference_alphabet(table(spark, d, "part").select(k.alias("key"), F.concat(_sequence(k), F.when(k % 9 == 0, "E").otherwise("r")).alias("seq")))


@query("SELECT n_nationkey AS taxid, CAST(count(*) AS BIGINT) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def taxon_files(spark, d):
    path = shared_folder(spark)
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("taxid"), F.concat(F.lit(">"), "c_nationkey", F.lit(":"), "c_custkey").alias("line"))
    sinks.taxon_files(rows, path, "taxid", [])
    return spark.read.text(path).groupBy(F.regexp_extract("value", r"^>(-?\d+):", 1).cast("long").alias("taxid")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS rows, true AS within FROM orders")
def chunked_files(spark, d):
    path = shared_folder(spark)
    sinks.chunked(table(spark, d, "orders"), path, 700)
    per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows"), (F.max("n") <= 700).alias("within"))


@query("SELECT read_id, CASE WHEN away <= 0 THEN seq ELSE concat_ws('', list_transform(range(0, length(seq)), lambda i: if((i - st + length(seq)) % length(seq) < away, 'N', seq[i + 1]))) END AS seq FROM (SELECT 'c' || c_custkey AS read_id, {s} AS seq, CAST(floor(length({s}) * 0.25) AS BIGINT) AS away, c_custkey % length({s}) AS st FROM customer)".format(s=_SEQUENCE.format(k="c_custkey")).replace("concat_ws('', list_transform", "array_to_string(list_transform").replace("seq[i + 1]))) END", "seq[i + 1])), '') END"))
def masked_sequences(spark, d):
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.concat(F.lit("c"), k).alias("read_id"), _sequence(k).alias("seq"), k.alias("k"))
    return rows.select("read_id", S.masked(F.col("seq"), 0.75, (F.col("k") % F.length("seq")).cast("int")).alias("seq"))


# ------------------------------------------------------------------ contigs, hits, accessions
@query(f"WITH {_READS} SELECT 'c' || c_custkey AS contig_id FROM customer WHERE 'c' || c_custkey IN (SELECT contig_id FROM reads)")
def contigs_with_reads(spark, d):
    contigs = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("contig_id"))
    return FL.contigs_with_reads(contigs, _reads(spark, d))


@query("SELECT 'c' || c_custkey AS contig_id FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def contigs_of_taxa(spark, d):
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("contig_id"), F.col("c_nationkey").alias("species_taxid"))
    return FL.contigs_of_taxa(c.select("contig_id"), c, table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("taxid")))


@query("SELECT 'ACC' || s_suppkey AS accession, CAST(s_suppkey AS BIGINT) AS taxid FROM supplier WHERE s_suppkey % 13 <> 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_orderkey % 97 = 0 UNION SELECT l_partkey % 50 FROM lineitem WHERE l_orderkey % 97 = 0)")
def accession_subset(spark, d):
    line = table(spark, d, "lineitem").where("l_orderkey % 97 = 0")
    headers = line.select(F.concat(F.lit(">ACC"), "l_suppkey", F.lit(".1 one\x01ACC"), F.col("l_partkey") % 50, F.lit(".2 two")).alias("header"))
    return FL.accession_subset(R.accessions(spark, d).select("accession", F.col("taxid").cast("long").alias("taxid")), headers)


@query("SELECT 'd' || doc_id AS read_id, 1 + doc_id % 2 AS mate FROM documents WHERE (doc_id - doc_id % 4) % 12 = 0 OR (doc_id % 12 = 5)")
def nonhost_reads(spark, d):
    docs = table(spark, d, "documents")
    name = lambda k: F.concat(F.lit("d"), k)
    k = F.col("doc_id")
    reads = docs.select(F.concat(name(k), F.lit("/"), 1 + k % 2).alias("read_id"), (1 + k % 2).alias("mate"))
    clusters = docs.select(name(k - k % 4).alias("representative"), name(k).alias("read_id"))
    headers = docs.where("doc_id % 12 in (0, 5)").select(F.concat(F.lit("NT:A.1:NR::"), name(k), F.lit("/1")).alias("header"))
    return S.nonhost_reads(reads, headers, clusters).select(X.read_id(F.col("read_id")).alias("read_id"), "mate")


@query(f"WITH {_READS} SELECT read_id, length FROM reads WHERE CAST(read_id AS BIGINT) % 10 <> 3 AND (contig_id = '*' OR CAST(substr(contig_id, 2) AS BIGINT) % 10 <> 3)")
def unmapped_reads(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    hits = o.where("o_orderkey % 10 = 3").select(F.col("o_orderkey").cast("string").alias("id")).unionByName(c.where("c_custkey % 10 = 3").select(F.concat(F.lit("c"), "c_custkey").alias("id")))
    reads = _reads(spark, d)
    return M.unmapped_reads(reads.select("read_id", "length"), reads, hits)


@query("SELECT 'NR:' || if(o_orderkey % 3 = 0, 'P' || o_custkey, '') || ':NT:' || if(o_orderkey % 2 = 0, 'N' || o_custkey, '') || ':' || o_orderkey AS header, o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 AS mapped FROM orders")
def annotated_reads(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.col("o_custkey").alias("c"))
    side = lambda m, p: o.where(F.col("read_id") % m == 0).select("read_id", F.concat(F.lit(p), "c").alias("accession_id"))
    return M.annotate_reads(o.select("read_id"), side(2, "N"), side(3, "P")).select("header", "mapped")


@query("""SELECT 'family_nr:' || if(o_orderkey % 3 = 0, 7, -300) || ':family_nt:' || if(o_orderkey % 2 = 0, 7, -300) || ':genus_nr:' || if(o_orderkey % 3 = 0, 5, -200) || ':genus_nt:' || if(o_orderkey % 2 = 0, 5, -200)
  || ':species_nr:' || if(o_orderkey % 3 = 0, CAST(o_custkey AS BIGINT), -100) || ':species_nt:' || if(o_orderkey % 2 = 0, CAST(o_custkey AS BIGINT), -100) || ':h' || o_orderkey AS taxid_header FROM orders""")
def taxid_headers(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.concat(F.lit("h"), "o_orderkey").alias("header"), F.col("o_custkey").alias("species_taxid"))
    hits = o.select("read_id", "species_taxid", F.lit(5).alias("genus_taxid"), F.lit(7).alias("family_taxid"))
    return M.taxid_headers(o.select("read_id", "header"), hits.where("read_id % 2 = 0"), hits.where("read_id % 3 = 0")).select("taxid_header")


@query("SELECT o_orderkey AS read_id, CAST(if(o_orderkey % 4 = 0 OR o_custkey % 3 <> 0, o_totalprice, c_acctbal) AS DOUBLE) AS pident FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 5 <> 0 OR (o_orderkey % 4 <> 0 AND o_custkey % 3 = 0)")
def refined_alignments(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    m8 = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("read_id"), F.col("o_totalprice").cast("double").alias("pident"))
    placed = o.select(F.col("o_orderkey").alias("read_id"), F.when(F.col("o_orderkey") % 4 == 0, "*").otherwise(F.concat(F.lit("c"), "o_custkey")).alias("contig_id"))
    contig = c.where("c_custkey % 3 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("contig_id"), F.col("c_acctbal").cast("double").alias("pident"))
    hits = m8.select("read_id").unionByName(placed.join(contig, "contig_id").select("read_id")).distinct()
    return M.refined_m8(m8, hits, placed, contig)


@query("SELECT c_custkey AS read_id, CAST(c_nationkey AS BIGINT) AS taxid, c_acctbal AS bitscore FROM customer")
def hits_with_alignments(spark, d):
    c = table(spark, d, "customer")
    return M.hits_with_m8(c.select(F.col("c_custkey").alias("read_id"), F.col("c_nationkey").cast("long").alias("taxid")), c.select(F.col("c_custkey").alias("read_id"), F.col("c_acctbal").alias("bitscore")))


@query("SELECT o_orderpriority AS sample, count(*) AS n_chunks, avg(o_totalprice) * count(*) AS total FROM orders GROUP BY 1")
def alignment_time(spark, d):
    return C.alignment_time(table(spark, d, "orders").select(F.col("o_orderpriority").alias("sample"), F.col("o_orderkey").alias("chunk"), F.col("o_totalprice").cast("double").alias("seconds")))


@query("SELECT CAST(c_nationkey AS BIGINT) AS tax_id, count(*) AS unique_count, avg(c_acctbal) AS alignment_length FROM customer GROUP BY 1")
def abundance_order(spark, d):
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("tax_id")).agg(F.count("*").alias("unique_count"), F.avg("c_acctbal").alias("alignment_length"))
    return C.by_abundance(C.all_counts(counts.where("tax_id < 9"), counts.where("tax_id >= 9")))


@query("SELECT s_suppkey AS aro, array_to_string(list_sort(list_distinct(list_filter(['class ' || (s_suppkey % 5), if(s_suppkey % 3 = 0, 'beta', NULL), if(s_suppkey % 2 = 0, n_name, NULL)], lambda x: x IS NOT NULL))), ';') AS drug_class FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def ontology_classes(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    k = F.col("s_suppkey")
    hits = s.select(k.alias("aro"), F.concat(F.lit("class "), k % 5, F.when(k % 3 == 0, "; beta").otherwise("")).alias("drug_class"))
    return P.ontology_classes(hits, s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("ARO:"), k).alias("accession"), F.col("n_name").alias("drug_class"))).select("aro", "drug_class")


@query("SELECT DISTINCT 'g' || (o_orderkey % 11) AS gene, 'c' || o_custkey AS contig FROM orders")
def contig_genes(spark, d):
    return P.contig_genes(table(spark, d, "orders").select(F.concat(F.lit("g"), F.col("o_orderkey") % 11).alias("gene"), F.concat(F.lit("c"), "o_custkey", F.lit("_"), F.col("o_orderkey") % 3).alias("orf")))


@query("SELECT if(c_nationkey % 3 = 0, 'n' || c_nationkey, CAST(c_nationkey AS VARCHAR)) AS taxon, c_custkey AS k FROM customer")
def relabelled(spark, d):
    names = table(spark, d, "nation").where("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("id"), F.concat(F.lit("n"), "n_nationkey").alias("name"))
    return M.relabelled(table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("taxon"), F.col("c_custkey").alias("k")), names, "taxon")


@query("SELECT CAST(s_suppkey AS BIGINT) AS taxid, count(*) AS n FROM supplier WHERE s_suppkey % 13 <> 0 GROUP BY 1")
def accessions_per_taxon(spark, d):
    return C.accessions_per_taxon(R.accessions(spark, d).select("accession", F.col("taxid").cast("long").alias("taxid")))


@query("""SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS n, (100 * l_discount) // 1 AS d, CASE WHEN l_discount < 0.1 THEN round_even(l_discount, 3) ELSE round_even(l_discount, 2) END AS rounded, log10(greatest(l_tax, 2.2250738585072014e-308)) AS le,
  CAST(l_linenumber * 10 AS DOUBLE) / 70 * 100 AS lin, CAST(l_linenumber & 3 = 3 AS BOOLEAN) AS has FROM lineitem""".replace("(100 * l_discount) // 1 AS d, ", ""))
def alignment_scalars(spark, d):
    n = F.col("l_linenumber")
    line = table(spark, d, "lineitem")
    return line.select(F.col("l_orderkey").alias("k"), n.cast("int").alias("n"), A.round_adaptive(F.col("l_discount")).alias("rounded"), A.log10_evalue(F.col("l_tax")).alias("le"), A.linear(n * 10, F.lit(0), F.lit(70), F.lit(0), F.lit(100)).alias("lin"), A.has_flags(n, 3).alias("has"))


@query("SELECT p_partkey AS key FROM part WHERE p_size + p_partkey % 100 <= 90")
def moderate_references(spark, d):
    return FL.without_large_references(table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("header_length"), (F.col("p_partkey") % 100).alias("sequence_length")), 90).select("key")


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 2")
def classified_reads(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("r kraken:taxid|"), F.col("doc_id") % 7, F.lit(" x")).alias("header"))
    return FL.classified(docs, 2).select("doc_id")


@query("SELECT c_custkey AS taxid, c_nationkey AS field_value FROM customer WHERE c_custkey % 5 = 1")
def changed_taxa(spark, d):
    c = table(spark, d, "customer")
    changes = c.where("c_custkey % 5 < 2").select(F.col("c_custkey").alias("taxid"), F.when(F.col("c_custkey") % 5 == 1, "genus").otherwise("family").alias("field"))
    return M.changed_taxa_report(c.select(F.col("c_custkey").alias("taxid"), F.col("c_nationkey").alias("field_value")), changes, ["genus"]).select("taxid", "field_value")


@query("SELECT 100 + n_nationkey AS tax_id, 'no rank' AS rank, n_regionkey AS ancestor FROM nation UNION ALL SELECT 100 + n_nationkey, 'no rank1', 50 + n_nationkey FROM nation")
def repeated_ranks(spark, d):
    n = table(spark, d, "nation")
    rows = n.select((100 + F.col("n_nationkey")).alias("tax_id"), F.col("n_regionkey").alias("ancestor"), F.lit("no rank").alias("rank"), F.lit(2).alias("depth")).unionByName(n.select((100 + F.col("n_nationkey")).alias("tax_id"), (50 + F.col("n_nationkey")).alias("ancestor"), F.lit("no rank").alias("rank"), F.lit(1).alias("depth")))
    return T.numbered_ranks(rows).select("tax_id", "rank", "ancestor")


# ------------------------------------------------------------------ sketches
def _portable(rows, key, text):
    return rows.select(F.col(key).alias("id"), S.sketch(F.coalesce(F.col(text), F.lit("")), 20, 50, dna=False, portable=True).alias("sketch"))


_HASHES = """CAST('0x' || substr(md5('42:' || substr(text, CAST(i AS INT), 20)), 1, 13) AS BIGINT) AS h FROM (SELECT {id} AS id, text, unnest(range(1, length(text) - 18)) AS i FROM {table})"""
_CONTAINED = """dh AS (SELECT DISTINCT id, h FROM (SELECT id, {d}) WHERE h < 4503599627370496 // 50), qh AS (SELECT DISTINCT id, h FROM (SELECT id, {q}) WHERE h < 4503599627370496 // 50),
  n AS (SELECT id, count(*) AS n FROM qh GROUP BY id), s AS (SELECT qh.id AS query, dh.id AS id, count(*) AS shared FROM qh JOIN dh USING (h) GROUP BY 1, 2)"""
_DOC_CONTAINED = _CONTAINED.format(d=_HASHES.format(id="doc_id", table="documents"), q=_HASHES.format(id="doc_id", table="documents WHERE doc_id % 100 = 0"))
_ITEM_CONTAINED = _CONTAINED.format(d=_HASHES.format(id="doc_id", table="documents"), q=_HASHES.format(id="item_id", table="benchmark"))


def _searched(spark, d, buckets):
    rows = kept(_portable(table(spark, d, "documents"), "doc_id", "text"))
    found = ST.contained(ST.build(rows, buckets=buckets), rows.where("id % 100 = 0").withColumnRenamed("id", "query"), 0.5)
    return found.select("query", "id", "shared", F.round("containment", 9).alias("containment"))


@query(f"WITH {_DOC_CONTAINED} SELECT s.query, s.id, shared, round(shared / n, 9) AS containment FROM s JOIN n ON n.id = s.query WHERE shared >= 0.5 * n")
def sketch_tree_search(spark, d):
    return _searched(spark, d, 0)


@query(f"WITH {_DOC_CONTAINED} SELECT s.query, s.id, shared, round(shared / n, 9) AS containment FROM s JOIN n ON n.id = s.query WHERE shared >= 0.5 * n")
def counting_filter_search(spark, d):
    return _searched(spark, d, ST.BUCKETS)


@query(f"WITH {_ITEM_CONTAINED} SELECT query AS item_id, count(*) AS n_docs, max(shared) AS most, round(max(shared / n), 9) AS containment FROM s JOIN n ON n.id = s.query WHERE shared >= 0.3 * n GROUP BY query")
def benchmark_containment(spark, d):
    tree = ST.build(_portable(table(spark, d, "documents"), "doc_id", "text"))
    found = ST.contained(tree, _portable(table(spark, d, "benchmark"), "item_id", "text").withColumnRenamed("id", "query"), 0.3)
    return found.groupBy(F.col("query").alias("item_id")).agg(F.count("*").alias("n_docs"), F.max("shared").alias("most"), F.round(F.max("containment"), 9).alias("containment"))


# ------------------------------------------------------------------ references by their place in files
def _reference_file(spark, d):
    """Customers as one FASTA file, every third with a second item in its header."""
    k = F.col("c_custkey")
    header = F.concat(F.lit("c"), k, F.lit(" , customer of "), "c_nationkey", F.when(k % 3 == 0, F.concat(F.lit("\x01d"), k, F.lit(" other"))).otherwise(""))
    rows = table(spark, d, "customer").orderBy(k).select(F.concat(F.lit(">"), header, F.lit("\n"), F.substring(_sequence(k), 1, 9), F.lit("\n"), F.substring(_sequence(k), 10, 99)).alias("value"))
    path = shared_folder(spark)
    sinks.concatenated(rows, path, "none")
    return path


_REFERENCES = f"""c AS (SELECT c_custkey AS k, 'c' || c_custkey || ' , customer of ' || c_nationkey || if(c_custkey % 3 = 0, chr(1) || 'd' || c_custkey || ' other', '') AS header, {_SEQUENCE.format(k='c_custkey')} AS seq, c_nationkey AS nation FROM customer),
  placed AS (SELECT *, strlen(header) + 2 AS head, length(seq) + 2 AS body, coalesce(sum(strlen(header) + length(seq) + 4) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c)"""


@query(f"""WITH {_REFERENCES} SELECT 'c' || k AS accession, ', customer of ' || nation AS name, CAST(0 AS INT) AS nth, CAST(start AS BIGINT) AS start, head AS header_bytes, body AS body_bytes, CAST(length(seq) AS BIGINT) AS bases FROM placed
  UNION ALL SELECT 'd' || k, 'other', 1, start, head, body, length(seq) FROM placed WHERE k % 3 = 0""")
def reference_index(spark, d):
    return file_index.indexed(spark, _reference_file(spark, d), 20_000).drop("file")


@query(f"WITH {_REFERENCES} SELECT if(u = 1, 'd', 'c') || k AS accession, replace(header, ' , ', ' ') AS header, seq FROM placed, unnest([0, 1]) t(u) WHERE k % 7 = 0 AND (u = 0 OR k % 3 = 0)")
def fetched_references(spark, d):
    k = F.col("c_custkey")
    wanted = table(spark, d, "customer").where(k % 7 == 0).select(F.explode(F.array(F.concat(F.lit("c"), k), F.concat(F.lit("d"), k))).alias("accession"))
    return file_index.fetched(file_index.indexed(spark, _reference_file(spark, d), 20_000), wanted, gap=0).drop("bytes_read")


@query(f"WITH {_REFERENCES} SELECT nation, 'c' || k AS read_id, CAST(coalesce(sum(1 + length(k) + length(seq) + 3 - 0) OVER (PARTITION BY nation ORDER BY length(seq) DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset FROM placed".replace("length(k)", "strlen(CAST(k AS VARCHAR))"))
def length_files(spark, d):
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.concat(F.lit("c"), k).alias("header"), _sequence(k).alias("seq"), k.alias("ord"))
    path = shared_folder(spark)
    file_index.write_by_length(file_index.placed_by_length(rows, "nation", "ord", 2000), path, "nation")
    named = lambda c: F.regexp_extract("file", f"{c}=(\\d+)/", 1).cast("long")
    return records.records(spark, path).select(named("nation").alias("nation"), "read_id", (named("first_byte") + F.col("start")).alias("offset"))


@query("SELECT CAST(c_nationkey AS BIGINT) AS taxid, 'c' || c_custkey AS read_id, {s} AS seq FROM customer WHERE c_nationkey IN (3, 7, 8, 19)".format(s=_SEQUENCE.format(k="c_custkey")))
def taxon_ranges(spark, d):
    """Records of four taxa by the byte ranges that a locator gives for them, in files sorted by taxon."""
    k = F.col("c_custkey")
    line = F.concat(F.lit(">c"), k, F.lit(" "), "c_nationkey", F.lit("\n"), _sequence(k))
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("taxid"), line.alias("line")).withColumn("size", F.octet_length("line") + 1)
    path = shared_folder(spark)
    sinks.taxon_files(rows, path, "taxid", [])
    ranges = [(r["first_byte"], r["last_byte"]) for r in S.byte_ranges(rows, "taxid", []).where("taxid in (3, 7, 8, 19)").collect()]
    found = records.records_in_ranges(spark, path, ranges, split=1000)
    return found.select(F.split("header", " ")[1].cast("long").alias("taxid"), "read_id", "seq")


# ------------------------------------------------------------------ steps counted as they run
@query("""SELECT 'all' AS step, count(*) AS rows, CAST(sum(1 + c_custkey % 3) AS BIGINT) AS reads FROM customer UNION ALL SELECT 'long', count(*), CAST(sum(1 + c_custkey % 3) AS BIGINT) FROM customer WHERE c_custkey % 20 >= 9
  UNION ALL SELECT 'of even nations', count(*), CAST(sum(1 + c_custkey % 3) AS BIGINT) FROM customer WHERE c_custkey % 20 >= 9 AND c_nationkey % 2 = 0""")
def observed_steps(spark, d):
    k = F.col("c_custkey")
    reads = table(spark, d, "customer").select(F.concat(F.lit("c"), k).alias("read_id"), _sequence(k).alias("seq"), F.col("c_nationkey").alias("nation"))
    sizes = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.concat(F.lit("c"), k).alias("read_id"), (1 + k % 3).alias("size"))
    steps = StepCounts()
    rows = steps.add("all", with_sizes(reads, sizes), "size")
    rows = steps.add("long", rows.where(F.length(F.translate("seq", "N", "")) >= 40), "size")
    rows = steps.add("of even nations", rows.where("nation % 2 = 0"), "size")
    rows.write.parquet(shared_folder(spark))  # the plan's own action
    return spark.createDataFrame(steps.counts(), "step string, rows long, reads long")


# ------------------------------------------------------------------ look-ups, names and other small operators
@query("SELECT o_orderkey AS key, coalesce(c_name, 'unknown') AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey")
def dimension_lookup(spark, d):
    names = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return tables.lookup(table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey"), names, "o_custkey", "name", "unknown").select("key", "name")


@query("SELECT 'A' || p_partkey || '.1' AS accession, if(p_partkey % 3 = 0, p_name, 'next ' || p_name) AS seq FROM part WHERE p_partkey % 3 < 2")
def fetched_versions(spark, d):
    k, p = F.col("p_partkey"), table(spark, d, "part")
    wanted = p.select(F.concat(F.lit("A"), k, F.lit(".1")).alias("accession"))
    one = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("A"), k, F.lit(".1")).alias("accession"), F.col("p_name").alias("seq"))
    two = p.where("p_partkey % 3 < 2").select(F.concat(F.lit("A"), k, F.lit(".2")).alias("accession"), F.concat(F.lit("next "), "p_name").alias("seq"))
    return tables.fetch_sequence(wanted, one, two)


@query("SELECT s_suppkey AS taxid FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0 OR n_regionkey = 2")
def taxa_with_ranks(spark, d):
    step = lambda rank, there: F.struct(F.when(there, rank).otherwise("no rank").alias("rank"))
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = FL.require_rows(rows, 1).select(F.col("s_suppkey").alias("taxid"), F.array(step("genus", F.col("n_nationkey") % 5 != 0), step("family", F.col("n_regionkey") == 2)).alias("ancestors"))
    return FL.has_rank(rows, "ancestors", ["genus", "family"]).select("taxid")


@query("SELECT CASE WHEN p_size % 3 = (p_partkey % 3) AND p_size % 3 = 0 THEN 'snp' WHEN p_size % 3 = p_partkey % 3 THEN 'mnp' ELSE 'indel' END AS class, count(*) AS n FROM part GROUP BY 1")
def variant_classes(spark, d):
    of = lambda c: F.repeat(F.lit("A"), (F.col(c) % 3 + 1).cast("int"))
    return V.variant_classes(table(spark, d, "part").select(of("p_size").alias("ref"), F.concat_ws(",", of("p_partkey"), of("p_partkey")).alias("alt")))


@query("SELECT 'c' || c_custkey || '.1' AS read_id, 'c' || c_custkey AS accession, CAST(if(c_custkey % 4 = 0, 0, c_nationkey) AS BIGINT) AS taxid FROM customer WHERE c_custkey < 1000")
def reads_by_taxon(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    reads = S.truncated(c.select(F.concat(F.lit("c"), k, F.lit(".1")).alias("read_id"), k.alias("ord")), 1000)
    known = c.where("c_custkey % 4 <> 0").select(F.concat(F.lit("c"), k).alias("accession"), F.col("c_nationkey").cast("long").alias("taxid"))
    return S.by_taxon(S.shuffled(reads, 7), known).select("read_id", "accession", "taxid")


@query("SELECT p_partkey AS key, if(p_partkey % 2 = 0, 'ENSG' || p_partkey, 'T' || p_partkey || '|x') AS gene, p_size < 10 OR p_partkey % 7 = 0 AS phage, round((p_size % 5) / 5, 6) AS held, CAST(p_size AS VARCHAR) AS size FROM part")
def genes_and_phages(spark, d):
    k = F.col("p_partkey")
    transcript = F.when(k % 2 == 0, F.concat(F.lit("T|ENSG"), k, F.lit("|x"))).otherwise(F.concat(F.lit("T"), k, F.lit("|x")))
    family, name = F.when(F.col("p_size") < 10, "Myoviridae").otherwise("other"), F.when(k % 7 == 0, "some Phage of").otherwise("macrophages")
    held = S.containment(F.sequence(F.lit(1), F.lit(5)), F.when(F.col("p_size") % 5 > 0, F.sequence(F.lit(1), F.col("p_size") % 5)).otherwise(F.array().cast("array<int>")))
    return table(spark, d, "part").select(k.alias("key"), X.gene_id(transcript).alias("gene"), L.is_phage(family, name, ["Myoviridae"]).alias("phage"), F.round(held, 6).alias("held"), *X.stringified("p_size")).withColumnRenamed("p_size", "size")


@query(f"WITH {_FASTQ} SELECT read_id, header, seq FROM fq")
def fastq_as_fasta(spark, d):
    path = shared_folder(spark)
    fastx.to_fasta(fastx.fastq_to_fasta(_fastq(spark, d)), path)
    return fastx.fasta(spark, path).select("read_id", "header", "seq")


@query("""WITH l AS (SELECT p_partkey AS k, string_agg(substr('ACTG', CAST(CAST('0x' || substr(md5('42:' || p_partkey || ':' || i), 1, 2) AS INT) % 4 + 1 AS INT), 1), '' ORDER BY i) AS drawn, repeat('GATTACA', CAST(p_size % 9 + 1 AS INT)) AS needle FROM part, unnest(range(1, 61)) t(i) GROUP BY p_partkey, p_size)
  SELECT k AS key, substr(needle, 1, least(CAST(round(length(needle) * 0.75) AS INT), 60)) || substr(drawn, least(CAST(round(length(needle) * 0.75) AS INT), 60) + 1) AS seq FROM l""")
def containing_sequences(spark, d):
    needle = F.repeat(F.lit("GATTACA"), (F.col("p_size") % 9 + 1).cast("int"))
    return spread(table(spark, d, "part").select("p_partkey", "p_size")).select(F.col("p_partkey").alias("key"), S.containing_sequence(needle, F.col("p_partkey"), 12, 5, 0.75).alias("seq"))


@query("SELECT 'h' || c_custkey AS read_id, 0 AS set FROM customer UNION ALL SELECT 'ERCC-' || s_suppkey, 1 FROM supplier")
def concatenated_references(spark, d):
    """A host's and spike-in references as one packed file of both, read back."""
    host = table(spark, d, "customer").select(F.concat(F.lit("h"), "c_custkey").alias("read_id"), _sequence(F.col("c_custkey")).alias("seq"))
    spikes = table(spark, d, "supplier").select(F.concat(F.lit("ERCC-"), "s_suppkey").alias("read_id"), _sequence(F.col("s_suppkey")).alias("seq"))
    rows, path = S.concatenated(host, spikes), shared_folder(spark)
    sinks.concatenated(rows.select(F.concat(F.lit(">"), "read_id", F.lit(" "), "set", F.lit("\n"), "seq").alias("value")), path, "gzip")
    return records.records(spark, path).select("read_id", F.split("header", " ")[1].cast("int").alias("set"))
