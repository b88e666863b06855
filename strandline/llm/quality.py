"""Quality classifier (5): two zstandard dictionaries, of good and of bad labelled text.

A text is cut in windows of WINDOW bytes, each compressed with either dictionary; the difference of the two sizes by
their sum says which sort the text resembles. Short windows keep a text from being its own dictionary. The score is a
logistic curve over that difference alone, fitted on labelled texts that no dictionary has seen. Null and empty texts get
the score of empty text.

Only the fit is bounded: it takes at most PER_CLASS labelled texts of each class, picked by the hash of their id among
those of at most SAMPLE_CHARS characters. Labels that are null or contradict each other for one doc_id are not used; a
single class gives that class's share as every score. Repeated documents get a row each, a null doc_id isn't held out;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import small_batches, table, text_chunks

PER_CLASS, SAMPLE_CHARS, DICTIONARY_BYTES, LEVEL, WINDOW = 2000, 16_000, 112_640, 3, 256


def remainder(doc_id: Column, k: int) -> Column:
    return F.crc32(doc_id.cast("string")) % k


def difference(text: bytes, compressors) -> float:
    """The normalised difference of the sizes by the dictionary of bad and that of good texts."""
    good, bad = (sum(len(c.compress(text[k : k + WINDOW])) for k in range(0, max(1, len(text)), WINDOW)) for c in compressors)
    return (bad - good) / (good + bad)


def _compressors(dictionaries: list[bytes | None]):
    return [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, **({"dict_data": zstandard.ZstdCompressionDict(d)} if d else {})) for d in dictionaries]


def _dictionary(texts: list[bytes]) -> bytes | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few or too short texts to train on: they are the dictionary themselves
        return b"\n".join(texts)[-DICTIONARY_BYTES:] or None


def fit(sample: list[tuple[str, int]]) -> dict:
    """Dictionaries from half of the sample (text, label), weights from the other half."""
    texts = [(t.encode("utf-8", "surrogatepass"), y) for t, y in sample]
    if len({y for _, y in texts}) < 2:
        return {"constant": float(texts[0][1]) if texts else 0.5}
    by = [[t for t, y in texts if y == c] for c in (1, 0)]
    small = min(map(len, by)) < 8
    dictionaries = [_dictionary(ts if small else ts[::2]) for ts in by]
    held = [(t, y) for c, ts in ((1, by[0]), (0, by[1])) for t in (ts if small else ts[1::2]) for y in [c]]
    c = _compressors(dictionaries)
    x, y = np.array([difference(t, c) for t, _ in held]), np.array([y for _, y in held], float)
    mean, scale = x.mean(), x.std() or 1.0
    z = np.stack((np.ones(len(x)), (x - mean) / scale), 1)
    w, prior = np.zeros(2), np.diag([1e-6, 1e-2])
    sign = 2 * y - 1
    loss = lambda v: np.logaddexp(0, -sign * (z @ v)).sum() + v @ prior @ v / 2
    for _ in range(100):  # Newton steps, halved until they help
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + prior, z.T @ (y - p) - prior @ w)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return {"dictionaries": dictionaries, "slope": float(w[1] / scale), "shift": float(w[0] - w[1] * mean / scale)}


def quality_model(docs: DataFrame, labels: DataFrame, fold: int = 3, held_out: int = 1) -> dict:
    """The model of labelled documents outside the held-out fold."""
    known = labels.where(F.col("quality").isin(0, 1)).where(remainder(F.col("doc_id"), fold) != held_out).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("low"), F.max("quality").alias("quality")).where("low = quality").select("doc_id", "quality")
    lengths = docs.select("doc_id", F.length("text").alias("n")).where(F.col("n").between(1, SAMPLE_CHARS)).select("doc_id")
    some = known.join(lengths, "doc_id").distinct().withColumn("h", F.xxhash64("doc_id"))
    first = lambda c: some.where(F.col("quality") == c).orderBy("h", "doc_id").limit(PER_CLASS)
    chosen = first(0).unionByName(first(1))  # 2 * PER_CLASS rows at most, so their ids alone are joined and broadcast
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS)).join(F.broadcast(chosen), "doc_id")
    once = texts.groupBy("h", "doc_id", "quality").agg(F.min("text").alias("text"))  # however often an id is repeated
    return fit([(r["text"], r["quality"]) for r in sorted(once.toLocalIterator(), key=lambda r: (r["h"], r["doc_id"]))])


def quality_scores(docs: DataFrame, model: dict, fold: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per document."""

    def run(batches):
        c = None if "constant" in model else _compressors(model["dictionaries"])
        for ids, texts in text_chunks(batches):
            if c is None:
                scores = [model["constant"]] * len(texts)
            else:
                x = np.array([difference(t.encode("utf-8", "surrogatepass"), c) for t in texts])
                scores = 1 / (1 + np.exp(-np.clip(x * model["slope"] + model["shift"], -30, 30)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), fold) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, quality_model(docs, table(spark, sf_dir, "labels")))
