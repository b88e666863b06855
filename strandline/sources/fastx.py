"""FASTA and FASTQ as tables. Lines are read by Spark's text reader, so plain files are read in parallel; which record a
line belongs to follows from the lines just before it and from counts of the parts of the file before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators.scalar import kept

MAX_LENGTH = 10_000


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, row, value): lines in the order of row within a split, splits in the order of their offset in a file."""
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "\r$", "").alias("value"))
    return lines.select("file", "split", F.row_number().over(Window.partitionBy("file", "split").orderBy("id")).alias("row"), "value")


def _failed(message: str, *more: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), *more))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): lines numbered from 1 in each file: rows within a split on top of the splits before."""
    lines = _split_lines(spark, path)
    sizes = lines.groupBy("file", "split").agg(F.count("*").alias("n"))  # a row for each split
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(sizes.select("file", "split", before.alias("before")), ["file", "split"]).select("file", (F.col("before") + F.col("row")).alias("line_no"), "value")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, header, seq, ord): records begin at > on a line of its own; a sequence may have several lines. `ord` counts
    records within a file: rows of a split on top of those of the splits before, a row for each split. The job fails at a
    record without sequence, and at sequence lines that begin with @ or +."""
    meta = F.col("_metadata")
    split = [meta["file_path"].alias("file"), meta["file_block_start"].alias("split")]
    raw = spark.read.option("lineSep", "\n>").text(path).select(*split, F.regexp_replace("value", r"^>|\r", "").alias("value"), F.monotonically_increasing_id().alias("id")).where(F.trim("value") != "")
    parts = raw.groupBy("file", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a split's records have ids without gaps but for empty ones, which are only a file's last
    raw = raw.join(F.broadcast(parts.select("file", "split", "first", before.alias("before"))), ["file", "split"]).withColumn("ord", F.col("before") + F.col("id") - F.col("first"))
    lines = F.split("value", "\n")
    header = lines[0]
    broken = (F.size(lines) < 2) | F.col("value").rlike("\n[@+]")
    checked = F.when(~broken, header).otherwise(_failed("not a FASTA record: ", header))
    rows = raw.select(checked.alias("header"), F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), "").alias("seq"), "ord")
    return rows.select(F.regexp_extract("header", r"^(\S*)", 1).alias("read_id"), "header", "seq", "ord")


def fastq(spark: SparkSession, path: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """(read_id, header, seq, quality, ord) of records that begin with @ and part sequence and quality by a line with +.
    Sequences and qualities may have several lines, of which only the first of the quality may begin with @, + or >.
    Qualities are cut, or filled up with their last letter, to the sequence; reads are cut at max_length. `ord` counts
    records within a file. The job fails where lines are no record.

    Whether a line is a header can be told from the two lines before it: a + line not preceded by one is a separator, the
    line after it is quality whatever it begins with, and any other line with @ is a header. Each split takes the last two
    lines of the one before from a table with a row per split.
    """
    lines = kept(_split_lines(spark, path).withColumn("c", F.substring("value", 1, 1)))
    split = Window.partitionBy("file", "split").orderBy("row")
    c1, c2 = F.lag("c", 1).over(split), F.lag("c", 2).over(split)
    marked = lines.withColumns({"c1": c1, "c2": c2})
    ends = marked.groupBy("file", "split").agg(F.max(F.struct("row", "c", "c1")).alias("m")).select("file", "split", F.col("m.c").alias("e1"), F.col("m.c1").alias("e2"), (F.col("m.row") == 1).alias("single"))
    w = Window.partitionBy("file").orderBy("split")
    ends = ends.select("file", "split", F.lag("e1").over(w).alias("p1"), F.when(F.lag("single").over(w), F.lag("e1", 2).over(w)).otherwise(F.lag("e2").over(w)).alias("p2"))
    marked = marked.join(ends, ["file", "split"])
    one = F.coalesce("c1", "p1", F.lit(""))
    two = F.when(F.col("row") == 1, F.coalesce("p2", F.lit(""))).when(F.col("row") == 2, F.coalesce("p1", F.lit(""))).otherwise(F.col("c2"))
    quality = (one == "+") & (two != "+")
    kind = F.when(quality, 3).when((F.col("c") == "+") & (one != "+"), 2).when(F.col("c") == "@", 0).otherwise(1)
    kinds = kept(marked.select("file", "split", "row", "value", kind.alias("kind")))
    heads = kinds.groupBy("file", "split").agg(F.sum((F.col("kind") == 0).cast("long")).alias("n"))
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    here = F.sum((F.col("kind") == 0).cast("long")).over(split.rowsBetween(Window.unboundedPreceding, 0))
    numbered = kinds.withColumn("here", here).join(heads.select("file", "split", before.alias("before")), ["file", "split"])
    item = F.struct("split", "row", "kind", "value")
    records = numbered.groupBy("file", (F.col("before") + F.col("here")).alias("record")).agg(F.array_sort(F.collect_list(item)).alias("ls"))
    cut = F.array_position(F.transform("ls", lambda x: x["kind"]), 2).cast("int")
    text = lambda low, n: F.array_join(F.transform(F.slice("ls", low, n), lambda x: x["value"]), "")
    blank = F.forall("ls", lambda x: F.trim(x["value"]) == "")
    rows = records.where(~((F.col("record") == 0) & blank)).select("record", F.col("ls")[0]["value"].alias("first"), F.size("ls").alias("size"), cut.alias("cut"), F.filter("ls", lambda x: x["kind"] == 2).alias("seps"), "ls")
    good = (F.col("record") > 0) & (F.size("seps") == 1) & (F.col("cut") > 2) & (F.col("cut") < F.col("size"))
    header = F.when(good, F.substring("first", 2, 1 << 30)).otherwise(_failed("not a FASTQ record: ", F.col("first")))
    rows = rows.select(header.alias("header"), text(F.lit(2), F.greatest(F.col("cut") - 2, F.lit(0))).alias("seq"), text(F.greatest(F.col("cut") + 1, F.lit(1)), F.greatest(F.col("size") - F.col("cut"), F.lit(0))).alias("q"), (F.col("record") - 1).alias("ord"))
    filled = F.rpad("q", F.length("seq"), F.when(F.col("q") == "", "!").otherwise(F.right("q", F.lit(1))))
    return rows.select(F.regexp_extract("header", r"^(\S*)", 1).alias("read_id"), "header", F.substring("seq", 1, max_length).alias("seq"), F.substring(filled, 1, max_length).alias("quality"), "ord")


def paired(one: DataFrame, two: DataFrame) -> DataFrame:
    """Both files' records side by side by their place; the job fails where a place has one mate only, or mates of
    different fragments."""
    mates = [df.select("ord", *(F.col(c).alias(f"{c}{k}") for c in df.columns if c != "ord")) for k, df in ((1, one), (2, two))]
    bare = lambda c: F.regexp_replace(c, "/[12]$", "")
    both = mates[0].join(mates[1], "ord", "full_outer")
    same = F.coalesce(bare("read_id1") == bare("read_id2"), F.lit(False))
    return both.withColumn("read_id", F.when(same, bare("read_id1")).otherwise(_failed("no pair: ", F.coalesce("read_id1", "read_id2"))))


def sniffed(spark: SparkSession, path: str) -> str:
    """"fasta" or "fastq" by the first letter of the first line that isn't empty."""
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).first()
    kind = {">": "fasta", "@": "fastq"}.get(first["value"][0] if first else "")
    if kind is None:
        raise ValueError(f"neither FASTA nor FASTQ: {path}")
    return kind


def to_fasta(reads: DataFrame, path: str, header: str = "header") -> None:
    """reads (header, seq) as FASTA."""
    reads.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col("seq"))).write.text(path)


def fastq_to_fasta(reads: DataFrame) -> DataFrame:
    return reads.select("read_id", "header", "seq", "ord")
