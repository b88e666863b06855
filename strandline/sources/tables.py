"""Readers of the text formats. Empty and missing fields are null; rows with too many fields fail the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline import schemas
from strandline.operators.filters import valid_alignments


def _typed(fields: Column, schema: T.StructType) -> list[Column]:
    n = F.size(fields)
    ok = F.when(n <= len(schema), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("too many fields: "), n.cast("string"))).cast("boolean"))
    first, *rest = (F.nullif(F.get(fields, F.lit(i)), F.lit("")).cast(f.dataType) for i, f in enumerate(schema))
    return [F.when(ok, first).alias(schema[0].name), *(c.alias(f.name) for c, f in zip(rest, schema.fields[1:], strict=True))]


def typed_tsv(spark: SparkSession, path: str, schema: T.StructType, comment: str | None = None, header: bool = False) -> DataFrame:
    """Tab-separated rows as schema has them. Shorter rows have nulls at their end, so a wider schema reads older files."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    if comment:
        lines = lines.where(~F.startswith("value", F.lit(comment)))
    if header:
        lines = lines.where(~F.startswith("value", F.lit(schema[0].name + "\t")))
    return lines.select(*_typed(F.split("value", "\t"), schema))


def m8(spark: SparkSession, path: str, schema: T.StructType = schemas.M8, min_length: int = 0, only_valid: bool = True) -> DataFrame:
    """Alignments; `ord` is the row's place in its file."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord"))
    rows = lines.where((F.length("value") > 0) & ~F.startswith("value", F.lit("#"))).select(*_typed(F.split("value", "\t"), schema), "ord")
    return valid_alignments(rows, min_length) if only_valid else rows


def hit_summary(spark: SparkSession, path: str, merged: bool = False) -> DataFrame:
    return typed_tsv(spark, path, schemas.HITS_MERGED if merged else schemas.HITS)


def sam(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord")).where("value <> '' and not startswith(value, '@')")
    fields = F.split("value", "\t")
    return lines.select(*_typed(F.slice(fields, 1, len(schemas.SAM)), schemas.SAM), "ord")


def paf(spark: SparkSession, path: str) -> DataFrame:
    """Alignments with their tags as a map from name:type to value."""
    lines = spark.read.text(path).where("value <> ''")
    fields = F.split("value", "\t")
    n = len(schemas.PAF)
    tag = F.transform(F.slice(fields, n + 1, 10_000), lambda t: F.struct(F.substring(t, 1, 4), F.substring(t, 6, 1 << 30)))
    return lines.select(*_typed(F.slice(fields, 1, n), schemas.PAF), F.map_from_entries(tag).alias("tags"))


def paf_to_m8(rows: DataFrame) -> DataFrame:
    """PAF in the layout of m8: scores by the alignment model, coordinates from 1, swapped on the minus strand."""
    from strandline.functions import alignment as A

    nm = F.coalesce(F.col("tags")["NM:i"].try_cast("long"), F.lit(0))
    minus = F.col("strand") == "-"
    return rows.select(
        F.col("qname").alias("qseqid"), F.col("tname").alias("sseqid"), (F.try_divide(F.col("nmatch"), F.col("alen")) * 100).alias("pident"), F.col("alen").alias("length"), nm.alias("mismatch"),
        A.gap_openings(F.coalesce(F.col("tags")["cg:Z"], F.lit(""))).alias("gapopen"), (F.col("qstart") + 1).alias("qstart"), F.col("qend").alias("qend"),
        F.when(minus, F.col("tend")).otherwise(F.col("tstart") + 1).alias("sstart"), F.when(minus, F.col("tstart") + 1).otherwise(F.col("tend")).alias("send"),
        A.evalue(F.col("alen"), nm).alias("evalue"), A.bitscore(F.col("alen"), nm).alias("bitscore"), F.col("qlen"), F.col("tlen").alias("slen"),
    )


def taxdump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows separated by | and padded with tabs; fields beyond the schema are left out."""
    fields = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.regexp_replace(x, "\t", " ")))
    return spark.read.text(path).where("value <> ''").select(*_typed(F.slice(fields, 1, len(schema)), schema))


def accession_map(spark: SparkSession, path: str) -> DataFrame:
    """(accession, taxid) of both layouts: accession.version, taxid and accession, accession.version, taxid, gi."""
    fields = F.split("value", "\t")
    taxid = F.when(F.size(fields) < 3, fields[1]).otherwise(F.get(fields, F.lit(2))).try_cast("long")
    return spark.read.text(path).where("value like '%\\t%'").select(F.substring_index(fields[0], ".", 1).alias("accession"), taxid.alias("taxid")).where("taxid is not null")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").try_cast("long").alias("taxid")).where("taxid is not null")


def named_lineages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("nullValue", "").csv(path)


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """(representative, read_id) of a duplicate table, guards against spreadsheet formulas taken off."""
    from strandline.functions.text import unguard_cell

    rows = spark.read.schema("representative string, read_id string").csv(path).where("representative <> 'representative read id'")
    return rows.select(unguard_cell(F.col("representative")).alias("representative"), unguard_cell(F.col("read_id")).alias("read_id"))


def taxon_counts(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select(F.explode("pipeline_output.taxon_counts_attributes").alias("r")).select("r.*")


def step_counts(spark: SparkSession, path: str) -> DataFrame:
    """(step, count) of JSON maps."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("step", "count"))
    return rows.select("step", F.col("count").try_cast("long").alias("count"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    fields = F.split("value", "\t")
    return spark.read.text(path).where("value <> '' and not startswith(value, '#')").select(fields[0].alias("chrom"), fields[1].cast("long").alias("pos"), fields[3].alias("ref"), fields[4].alias("alt"))


def samtools_stats(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of the summary numbers."""
    got = lambda k: F.regexp_extract("value", r"^SN\t([^:]+):\t([^\t]+)", k)
    return spark.read.text(path).where("startswith(value, 'SN\\t')").select(got(1).alias("name"), got(2).try_cast("double").alias("value"))


def truth(spark: SparkSession, path: str) -> DataFrame:
    rows = typed_tsv(spark, path, schemas.TRUTH)
    species = F.when(F.col("rank") == "species", F.col("taxid")).otherwise(F.raise_error(F.concat(F.lit("not a species: "), F.coalesce("rank", F.lit("null")))).cast("long"))
    return rows.select(species.alias("taxid"), "abundance", "species_name")


def assembler_log(spark: SparkSession, path: str) -> DataFrame:
    """(kind, value) of the lines that report errors or warnings."""
    kind = F.when(F.col("value").rlike("(?i)error|exception"), "error").when(F.col("value").rlike("(?i)warn"), "warning")
    return spark.read.text(path).select(kind.alias("kind"), "value").where("kind is not null")


def lookup(df: DataFrame, dimension: DataFrame, key: str, value: str, default) -> DataFrame:
    """df with `value` of the dimension's row for its key, the smallest if there are several, default if there is none."""
    one = dimension.groupBy(key).agg(F.min(value).alias(value))
    return df.join(one, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def fetch_sequence(wanted: DataFrame, *indexes: DataFrame) -> DataFrame:
    """(accession, seq) of wanted accessions from the first index (accession, seq) that has them, after all indexes by
    the next version of the accession."""
    from strandline.functions.lineage import bump_version

    tries = [(k, "accession", i) for k, i in enumerate(indexes)] + [(len(indexes) + k, "__next", i) for k, i in enumerate(indexes)]
    rows = wanted.select("accession").distinct().withColumn("__next", bump_version(F.col("accession")))
    found = [rows.join(i.select(F.col("accession").alias("__a"), "seq"), F.col(key) == F.col("__a")).select("accession", F.struct(F.lit(k).alias("k"), "seq").alias("s")) for k, key, i in tries]
    return reduce(DataFrame.unionByName, found).groupBy("accession").agg(F.min("s").alias("s")).select("accession", "s.seq")


def contig_summaries(spark: SparkSession, path: str) -> DataFrame:
    """(species_taxid, genus_taxid, family_taxid, count_type, contig_id, n) of a JSON list of summaries, a row for each contig."""
    schema = "species_taxid long, genus_taxid long, family_taxid long, count_type string, contig_counts map<string,long>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select("species_taxid", "genus_taxid", "family_taxid", "count_type", F.explode("contig_counts").alias("contig_id", "n"))


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """(accession, drug_class) of a JSON map from accessions to objects that may list drug classes, a row for each."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<drugClasses:array<string>>>")).alias("accession", "o"))
    return rows.select("accession", F.explode(F.col("o.drugClasses")).alias("drug_class"))


def assembler_failures(spark: SparkSession, logs: str, warnings: str | None = None) -> DataFrame:
    """(run, log_present, errors, stack_trace, warnings_present, warnings): one record for each run, a file of `logs` and one of
    the same name, but for its ending, of `warnings`. Errors are the lines that an assembler marks, their mark put to *; the
    stack trace goes from its heading to the next empty line, and is null where either lacks. A log is read as a whole."""
    run = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    whole = lambda path, name: spark.read.text(path, wholetext=True).select(run.alias("run"), F.col("value").alias(name))
    nothing = lambda c: F.when(c != "", c)
    lines = F.transform(F.regexp_extract_all("log", F.lit(r"(?m)^== Error ==.*\n?"), F.lit(0)), lambda x: F.replace(x, F.lit("== Error =="), F.lit("*")))
    trace = F.regexp_extract("log", r"(?ms)^=== Stack Trace ===\n.*?(?=^\n)", 0)
    failed = whole(logs, "log").select("run", nothing(F.array_join(lines, "")).alias("errors"), nothing(trace).alias("stack_trace"), F.lit(True).alias("log_present"))
    warned = whole(warnings, "warnings") if warnings else spark.createDataFrame([], "run string, warnings string")
    both = failed.join(warned.withColumn("warnings_present", F.lit(True)), "run", "full_outer")
    present = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return both.select("run", present("log_present"), "errors", "stack_trace", present("warnings_present"), "warnings")
