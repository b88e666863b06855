"""Benchmark decontamination (4): a prefix-filtered join of benchmark windows with documents, in DataFrame functions only.

A window is ten consecutive words of an item (all its words if fewer). The words of the benchmark are ordered by how
often documents hold them, rarest first; a document that holds a window holds its rarest word, so only that word of
each window, its prefix, is joined with the documents' words. A match fixes where the window would lie in the document:
windows that stick out of it fail the positional and length bounds, the others are compared word by word.

Both sides of the join carry at most the 2 * 10 - 1 words around the prefix word, however long the item or document. A
bitmap of FILTER_BITS bits of the prefix words' hashes, of one size whatever the benchmark's, spares the documents'
other words the join. The windows are broadcast if they have at most BROADCAST_BYTES; beyond, the same join is
shuffled, common words in SALTS parts.

Nulls and texts without words have no words and hit nothing; items without words have no window; an item whose id is
null marks words as hit, but isn't counted or named; repeated documents get a row each; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import materialize, table

WINDOW_WORDS = 10
FILTER_BITS, BROADCAST_BYTES, SALTS = 1 << 20, 32 << 20, 16


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of letters, digits and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _around(words: str, at: Column, size: int) -> Column:
    """The word at `at` with the size - 1 words on either side, and its place among them."""
    low = F.greatest(at - (size - 1), F.lit(0))
    return F.struct(at.alias("at"), (at - low).alias("here"), F.slice(words, low + 1, at - low + size).alias("near"))


def _bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FILTER_BITS))


def _in_filter(words: DataFrame) -> object:
    """A test whether a word can be among `words` (word): a bitmap as a constant of the plan, true for all of them."""
    cells = words.select(_bit(F.col("word")).alias("b")).distinct().groupBy(F.expr("b div 64").alias("c")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v"))
    found = [0] * (FILTER_BITS // 64)
    for r in cells.collect():  # FILTER_BITS / 64 rows at most
        found[r["c"]] = r["v"]
    bitmap = F.split(F.lit(" ".join(map(str, found))), " ").cast("array<bigint>")  # folded to one constant

    def test(word: Column) -> Column:
        b = _bit(word)
        return F.getbit(F.get(bitmap, F.shiftright(b, 6).cast("int")), (b % 64).cast("int")) == 1

    return test


def _windows(items: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """(word, item_id, at, here, near, low, high, length): windows of `length` words that begin at low to high hold
    `word`, at `at`, as their rarest, and near[here] is that word among those around it. All of an item's windows with
    one rarest word make one row."""
    at = F.explode(F.transform(F.sequence(F.lit(0), F.size("item_words") - 1), lambda i: _around("item_words", i, size)))
    word = items.select("item_key", "item_id", F.size("item_words").alias("words"), at.alias("w")).select("item_key", "item_id", "words", "w.*")
    word = materialize(word.withColumn("word", F.get("near", F.col("here"))).withColumn("length", F.least("words", F.lit(size))))
    # a window is there only if documents hold all its words; each word lies in at most `size` windows
    begins = F.sequence(F.greatest(F.lit(0), F.col("at") - (F.col("length") - 1)), F.least("at", F.col("words") - F.col("length")))
    known = word.join(counts, "word").select("item_key", "length", F.struct("n", "word", "at").alias("rare"), F.explode(begins).alias("low"))
    least = known.groupBy("item_key", "low").agg(F.min("rare").alias("rare"), F.count("*").alias("held"), F.first("length").alias("length")).where("held = length")
    runs = least.groupBy("item_key", F.col("rare.at").alias("at")).agg(F.min("low").alias("low"), F.max("low").alias("high"))
    return word.join(runs, ["item_key", "at"]).select("word", "item_id", "at", "here", "near", "low", "high", "length")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, item_id, begin, end): distinct stretches of document words inside windows, and the keyed documents."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"), F.xxhash64("text").alias("digest"))
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    items = materialize(items.withColumn("item_key", F.monotonically_increasing_id()))
    needed = items.select(F.explode("item_words").alias("word")).distinct()
    counts = keyed.select(F.explode("words").alias("word")).where(_in_filter(needed)(F.col("word"))).groupBy("word").agg(F.count("*").alias("n")).join(needed, "word", "left_semi")
    windows = materialize(_windows(items, counts, size))
    wanted = _in_filter(windows)
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: wanted(F.get("words", i)))
    place = keyed.where(F.size("words") > 0).select("doc_id", "digest", F.explode(F.transform(places, lambda i: _around("words", i, size))).alias("d"))
    place = place.withColumn("word", F.get("d.near", F.col("d.here")))
    total = windows.agg(F.sum(F.octet_length(F.array_join("near", " ")) + 64).alias("n")).first()["n"] or 0
    if total <= broadcast_bytes:
        found = place.join(F.broadcast(windows), "word")
    else:
        salted = windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = place.withColumn("salt", F.pmod(F.xxhash64("digest", "d.at"), F.lit(SALTS)).cast("int")).join(salted, ["word", "salt"])

    def equal(s: Column) -> Column:
        """Whether the item's window at s is the document's: `shift` words from the prefix word of either."""
        shift = s - F.col("at")
        b = F.col("d.here") + shift
        return (b >= 0) & (b + F.col("length") <= F.size("d.near")) & (F.slice("d.near", F.greatest(b, F.lit(0)) + 1, F.col("length")) == F.slice("near", F.col("here") + shift + 1, F.col("length")))

    found = found.withColumn("fits", F.filter(F.sequence("low", "high"), equal)).where(F.size("fits") > 0)
    origin = F.col("d.at") - F.col("at")
    return found.select("doc_id", "digest", "item_id", (origin + F.array_min("fits")).alias("begin"), (origin + F.array_max("fits") + F.col("length")).alias("end")).distinct(), keyed


def contamination_by_text(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """contamination() with the digest of each row's text, xxhash64(text), as rows of one doc_id may differ in text."""
    found, keyed = hits(docs, benchmark, size, broadcast_bytes)
    over = Window.partitionBy("doc_id", "digest").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(over), F.lit(0))))
    per = found.withColumn("new", new).groupBy("doc_id", "digest").agg(F.sum("new").alias("n_hit"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    per = per.withColumnsRenamed({"doc_id": "id", "digest": "d"})
    rows = keyed.select("doc_id", "digest", F.size("words").cast("long").alias("n_words"))
    joined = rows.join(per, rows["doc_id"].eqNullSafe(per["id"]) & (rows["digest"] == per["d"]), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row per document: its words, how many lie in a benchmark window, and which items occur in it."""
    return contamination_by_text(docs, benchmark, size, broadcast_bytes).drop("digest")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS w
      FROM i, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS t(s) WHERE len(ws) > 0),
z AS (SELECT DISTINCT n FROM g),
x AS (SELECT doc_id, s, z.n, array_to_string(ws[s:s + z.n - 1], ' ') AS w FROM d, z, unnest(range(1, len(ws) - z.n + 2)) AS t(s)),
h AS (SELECT x.doc_id, x.s, x.n, g.item_id FROM x JOIN g ON x.w = g.w AND x.n = g.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(item_id) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""
