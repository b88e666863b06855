"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated rows without header, nulls empty."""
    df.write.option("sep", "\t").option("emptyValue", "").option("nullValue", "").csv(path)


def taxon_counts_json(counts: DataFrame, path: str) -> None:
    """One object with all counts; a report has a row per taxon, so it fits in one task."""
    rows = counts.agg(F.collect_list(F.struct(*counts.columns)).alias("taxon_counts_attributes"))
    rows.select(F.to_json(F.struct(F.struct("taxon_counts_attributes").alias("pipeline_output")))).coalesce(1).write.text(path)


def taxon_files(records: DataFrame, path: str, taxid: str, order: list[str]) -> None:
    """Records (line) as text files in the order of taxid and then of `order`, ties by the whole line: the files' ranges
    follow one another, and byte_ranges() of the same records says where a taxon lies in them."""
    records.repartitionByRange(taxid, *order, "line").sortWithinPartitions(taxid, *order, "line").select("line").write.text(path)


def chunked(df: DataFrame, path: str, most: int) -> None:
    """Parquet files of at most `most` rows."""
    df.write.option("maxRecordsPerFile", most).parquet(path)


def per_key_json(df: DataFrame, path: str, key: str) -> None:
    df.write.partitionBy(key).json(path)


def key_value_table(df: DataFrame, name: str, key: str, buckets: int = 64) -> None:
    """A dimension bucketed by its key, so that joins on the key need no shuffle of it."""
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)


def concatenated(df: DataFrame, path: str, compression: str = "lz4") -> None:
    """Lines of a download, the one column of df, as one file."""
    if len(df.columns) != 1:
        raise ValueError(f"one column makes a line, not {df.columns}")
    df.select(df.columns[0]).coalesce(1).write.option("compression", compression).text(path)
