"""References in files: an index of names, lengths and places, reads of wanted places alone, and files sorted by length
whose places are known before they are written."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators.scalar import kept, running_sums
from strandline.sources import records as RC

#: References of more bytes than this aren't fetched.
MAX_REFERENCE = 100_000_000
#: Bytes of a file sorted by length.
PART_BYTES = 128 << 20
#: Wanted places that are this near one another are read at once.
GAP = 1 << 14


def without_comma(header: Column) -> Column:
    """Each \\x01-separated item of a header without a comma that stands between its accession and its description."""
    return F.array_join(F.transform(F.split(header, "\x01"), lambda item: F.regexp_replace(item, "^([^ ]+) , *(.*)$", "$1 $2")), "\x01")


def indexed(spark: SparkSession, path: str, split: int = RC.SPLIT) -> DataFrame:
    """(accession, name, nth, file, start, header_bytes, body_bytes, bases): a row for each item of each header of a FASTA
    file or folder, nth from 0; items of one header share its sequence. Records without sequence or accession have none."""
    item = F.posexplode(F.split("header", "\x01")).alias("nth", "item")
    rows = RC.extents(spark, path, split).where("body_bytes > 0").select("file", "start", "header_bytes", "body_bytes", "bases", item)
    name = F.rtrim(F.regexp_extract("item", r"^\S* (.*)$", 1))
    return rows.select(F.regexp_extract("item", r"^(\S*)", 1).alias("accession"), name.alias("name"), "nth", "file", "start", "header_bytes", "body_bytes", "bases").where("accession <> ''")


def fetched(index: DataFrame, wanted: DataFrame, max_bytes: int = MAX_REFERENCE, gap: int = GAP) -> DataFrame:
    """(accession, header, seq, bytes_read) of the wanted accessions (accession) that the index has, references of more
    than max_bytes left out. Only the bytes of wanted records are read, with the gaps between those less than `gap` apart;
    bytes_read tells how many, the first of what was read at once bearing all. A record is read once, whichever of its
    accessions are wanted."""
    found = index.where(F.col("header_bytes") + F.col("body_bytes") <= max_bytes).join(wanted.select("accession").distinct(), "accession", "left_semi")
    places = found.groupBy("file", "start", "header_bytes", "body_bytes").agg(F.array_sort(F.collect_set("accession")).alias("accessions"))
    ordered = places.repartitionByRange("file", "start").sortWithinPartitions("file", "start")

    def runs(rows: Iterator[dict]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for r in rows:
            if held and (r["file"] != held[0]["file"] or r["start"] - (held[-1]["start"] + held[-1]["header_bytes"] + held[-1]["body_bytes"]) > gap):
                yield held
                held = []
            held.append(r)
            if r["start"] - held[0]["start"] > RC.SPLIT:
                yield held
                held = []
        if held:
            yield held

    def read(batches):
        opened, source = None, None
        for run in runs(r for batch in batches for r in batch.to_pylist()):
            if run[0]["file"] != opened:
                store, place = RC._located(run[0]["file"])
                opened, source = run[0]["file"], store.open_input_file(place)
            first, last = run[0]["start"], run[-1]["start"] + run[-1]["header_bytes"] + run[-1]["body_bytes"]
            block = source.read_at(last - first, first)
            out = []
            for k, r in enumerate(run):
                at = r["start"] - first
                header = block[at : at + r["header_bytes"]].decode().rstrip("\r\n")
                body = block[at + r["header_bytes"] : at + r["header_bytes"] + r["body_bytes"]]
                seq = b"".join(body.split()).decode()
                out.append((r["accessions"], header[1:], seq, 0 if k else last - first))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.list_(pa.string()), pa.string(), pa.string(), pa.int64()), strict=True)], ["accessions", "header", "seq", "bytes_read"])

    raw = ordered.mapInArrow(read, "accessions array<string>, header string, seq string, bytes_read long")
    nth = F.posexplode("accessions").alias("nth", "accession")
    return raw.select(nth, without_comma(F.col("header")).alias("header"), "seq", "bytes_read").select("accession", "header", "seq", F.when(F.col("nth") == 0, F.col("bytes_read")).otherwise(F.lit(0)).cast("long").alias("bytes_read"))


def placed_by_length(sequences: DataFrame, group: str, order: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """sequences (group, header, seq, order) with the part and the byte that each begins at in its group's records sorted by
    length, longest first, equal lengths in `order`: bytes are counted per length, and prefix sums over lengths place each
    length, so only a row for each length is ordered as a whole. A part holds lengths that begin within part_bytes of one
    another; a length of more bytes than that is cut into parts by running sums of its own."""
    key = F.col(group)
    rows = sequences.withColumns({"length": F.coalesce(F.length("seq"), F.lit(0)), "size": F.octet_length("header") + F.coalesce(F.octet_length("seq"), F.lit(0)) + 3})
    classes = rows.groupBy(key.alias("__group"), F.col("length").alias("__length")).agg(F.sum("size").cast("long").alias("bytes"))
    lengths = Window.partitionBy("__group").orderBy(F.desc("__length")).rowsBetween(Window.unboundedPreceding, -1)
    classes = kept(classes.withColumn("before", F.coalesce(F.sum("bytes").over(lengths), F.lit(0))))
    same = F.col("__group").eqNullSafe(key) & (F.col("__length") == F.col("length"))
    placed = rows.join(classes, same).drop("__group", "__length")
    large = running_sums(placed.where(F.col("bytes") > part_bytes), [F.asc_nulls_first(group), F.desc("length"), F.asc(order)], __run="size")
    first = Window.partitionBy(group, "length")
    large = large.withColumn("at", F.col("before") + F.col("__run") - F.min("__run").over(first)).drop("__run")
    large = large.withColumn("part", F.struct(F.expr(f"before div {part_bytes}").alias("first"), F.expr(f"1 + (at - before) div {part_bytes}").alias("sub")))
    small = placed.where(F.col("bytes") <= part_bytes).withColumn("part", F.struct(F.expr(f"before div {part_bytes}").alias("first"), F.lit(0).cast("long").alias("sub")))
    same_length = Window.partitionBy(group, "part", "length").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(same_length), F.lit(0)))
    return small.unionByName(large).select(*sequences.columns, "length", "part", F.col("at").alias("offset"))


def write_by_length(placed: DataFrame, path: str, group: str) -> None:
    """placed_by_length() as FASTA: a folder for each group, in it a file for each part, named by the byte of the group's
    records that it begins at; a file's records follow one another."""
    begin = F.min("offset").over(Window.partitionBy(group, "part"))
    line = F.concat(F.lit(">"), "header", F.lit("\n"), F.coalesce("seq", F.lit("")))
    rows = placed.withColumn("first_byte", F.lpad(begin.cast("string"), 20, "0")).select(group, "first_byte", "offset", line.alias("value"))
    rows.repartition(group, "first_byte").sortWithinPartitions(group, "first_byte", "offset").drop("offset").write.partitionBy(group, "first_byte").text(path)
