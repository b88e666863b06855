"""The provided tables in the roles of classification data: lines as alignments, suppliers as species, nations as
genera, regions as families, orders as reads, customers as contigs, events as intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    length = F.col("l_quantity").cast("long")
    return line.select(
        F.col("l_orderkey").alias("qseqid"), F.concat(F.lit("ACC"), F.col("l_suppkey"), F.lit(".1")).alias("sseqid"), (100 * (1 - F.col("l_discount"))).alias("pident"), length.alias("length"),
        F.col("l_linenumber").cast("long").alias("mismatch"), F.lit(0).cast("long").alias("gapopen"), (F.col("l_linenumber") * 10).cast("long").alias("qstart"), (F.col("l_linenumber") * 10 + length).alias("qend"),
        (F.col("l_partkey") % 1000).alias("sstart"), (F.col("l_partkey") % 1000 + length).alias("send"), F.col("l_tax").alias("evalue"), F.col("l_quantity").alias("bitscore"), F.lit(200).cast("long").alias("qlen"), F.lit(2000).cast("long").alias("slen"),
        (F.col("l_linenumber").cast("long") * 10**12 + F.col("l_partkey") * 10**5 + F.col("l_suppkey")).alias("ord"), "l_returnflag",
    )


def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_suppkey % 13 <> 0").select(F.concat(F.lit("ACC"), F.col("s_suppkey")).alias("accession"), F.col("s_suppkey").alias("taxid"))


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("s_suppkey").alias("taxid"), F.expr("if(s_suppkey % 7 = 0, null, s_suppkey)").alias("species"), F.expr("if(n_nationkey % 5 = 0, null, 1000000 + n_nationkey)").cast("long").alias("genus"), F.expr("2000000 + n_regionkey").cast("long").alias("family"))


#: The same roles as SQL.
M8_SQL = """m8 AS (SELECT l_orderkey AS qseqid, 'ACC' || l_suppkey || '.1' AS sseqid, 100 * (1 - l_discount) AS pident, CAST(l_quantity AS BIGINT) AS length,
  CAST(l_linenumber AS BIGINT) AS mismatch, CAST(l_linenumber * 10 AS BIGINT) AS qstart, l_linenumber * 10 + CAST(l_quantity AS BIGINT) AS qend, l_partkey % 1000 AS sstart,
  l_partkey % 1000 + CAST(l_quantity AS BIGINT) AS send, l_tax AS evalue, l_quantity AS bitscore, 200 AS qlen, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 100000 + l_suppkey AS ord, l_returnflag FROM lineitem),
acc AS (SELECT 'ACC' || s_suppkey AS accession, s_suppkey AS taxid FROM supplier WHERE s_suppkey % 13 <> 0),
lin AS (SELECT s_suppkey AS taxid, if(s_suppkey % 7 = 0, NULL, s_suppkey) AS species, if(n_nationkey % 5 = 0, NULL, CAST(1000000 + n_nationkey AS BIGINT)) AS genus, CAST(2000000 + n_regionkey AS BIGINT) AS family
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
tax AS (SELECT m8.*, acc.taxid, coalesce(species, -100) AS species, coalesce(genus, -200) AS genus, coalesce(family, -300) AS family
  FROM m8 LEFT JOIN acc ON acc.accession = split_part(sseqid, '.', 1) LEFT JOIN lin ON lin.taxid = acc.taxid)"""
