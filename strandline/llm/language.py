"""Language identification (7): Bayesian fusion of what a text, its markup, its address and its host say.

Byte-trigram counts of labelled texts give each language's likelihood of a text. What languages a host, its domain, an
address suffix and the whole table hold is counted by grouped aggregation over all rows (by each text's likeliest
language) and smoothed level by level, a level's prior being the next one's estimate. How often a language is declared for texts of each
language is counted the same way. The posterior is the product of the smoothed
host prior, the chance of the declaration, and the text's likelihood, of which EVIDENCE trigrams at most count at
full weight, as trigrams of one text are no independent witnesses.

Only training is bounded: for every label about PER_LANGUAGE texts of at most SAMPLE_CHARS characters, picked by hash; of
a label that has none so short, the beginnings of its longer ones. With more than CELLS >> BITS labels there are fewer
trigram codes, so that the model stays small. Nulls: a missing text, declaration, suffix or host is no evidence. Without
any labelled text the language is null and the confidence 0. Texts without letters are `empty`. Repeated rows get a row each.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import give_back, hot_count, materialize, small_batches, table

PER_LANGUAGE, SAMPLE_CHARS, EVIDENCE, SMOOTH, BITS = 300, 20_000, 60, 5.0, 15
#: Cells of the model (4 bytes each) beyond which it has fewer than 2 ** BITS trigram codes, and the fewest bits of a code.
CELLS, LEAST_BITS = 1 << 21, 10
BROADCAST_ROWS = 20_000
_LETTER = re.compile(r"[^\W\d_]")
_TAGS = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)


def _codes(raw: bytes, bits: int) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    return (a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA6B) ^ a[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F) >> np.uint32(32 - bits)


def plain(html: str) -> str:
    """html without markup; unclosed scripts and comments count as text."""
    return _TAGS.sub(" ", html)


def language_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each trigram code by language) from documents with text and lang."""
    place, short = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), F.length("text") <= SAMPLE_CHARS
    known = docs.where("lang is not null").where(F.length("text") > 0).select("lang", "text", place.alias("place"), short.alias("short"))
    # a row per label; its first text by hash is always in the sample
    labels = known.groupBy("lang", "short").agg(F.count("*").alias("count"), F.min("place").alias("least")).collect()
    by = {r["lang"]: r for r in sorted(labels, key=lambda r: r["short"])}
    names = sorted(by)
    bits = next((k for k in range(BITS, LEAST_BITS, -1) if len(names) << k <= CELLS), LEAST_BITS)
    if not names:
        return [], np.zeros((0, 1 << bits), np.float32)
    upto = [(v, r["short"], max(r["least"] + 1, math.ceil(min(1.0, PER_LANGUAGE / r["count"]) * (1 << 20)))) for v, r in by.items()]
    upto = F.broadcast(docs.sparkSession.createDataFrame(upto, "lang string, short boolean, upto long"))
    # rows that share a hash (repeats, rows without id) are bounded label by label
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", F.xxhash64("text")))
    sample = known.join(upto, ["lang", "short"]).where("place < upto").select("lang", "place", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    sample = sample.withColumn("rank", rank).where(F.col("rank") <= 2 * PER_LANGUAGE).select("lang", "text")
    number = {v: k for k, v in enumerate(names)}
    counts = np.full((len(names), 1 << bits), 0.05)
    for r in sample.toLocalIterator():
        raw = r["text"].lower().encode("utf-8", "surrogatepass")
        if len(raw) > 2:
            counts[number[r["lang"]]] += np.bincount(_codes(raw, bits), minlength=1 << bits)
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _likelihoods(model: np.ndarray, markup: bool):
    """Log likelihood of a text by language, less that of the likeliest, and at the end 1 for a text without letters."""
    bits = model.shape[1].bit_length() - 1

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            t = value.as_py()
            t = (plain(t or "") if markup else t or "").lower()
            raw = t.encode("utf-8", "surrogatepass")
            n = max(0, len(raw) - 2)
            # the mean over all trigrams, as EVIDENCE of them or fewer
            ll = np.bincount(_codes(raw, bits), minlength=1 << bits) @ model.T * min(n, EVIDENCE) / n if n and len(model) else np.zeros(len(model))
            out.append([*(ll - ll.max(initial=-np.inf)).tolist(), 0.0 if _LETTER.search(t) else 1.0])
        give_back()
        return pa.array(out, pa.list_(pa.float64()))

    return score


def _estimate(rows: DataFrame, key: list[str], parent: DataFrame | list[float], names: list[str]) -> DataFrame:
    """(key, p): shares of the languages, as an array in the order of names, for each value of key, smoothed by those of
    the level above; a hot value's rows are counted before they are shuffled."""
    counts = rows.groupBy(*key).agg(*(F.sum(F.col("text_lang").eqNullSafe(v).cast("double")).alias(f"c{k}") for k, v in enumerate(names)))
    got = F.array(*(F.col(f"c{k}") for k in range(len(names))))
    total = F.aggregate(got, F.lit(0.0), lambda a, x: a + x)
    if isinstance(parent, list):
        joined = counts.withColumn("up", F.array(*map(F.lit, parent)))
    else:
        joined = counts.join(parent.withColumnRenamed("p", "up"), key[:-1])
    return joined.select(*key, F.zip_with(got, "up", lambda c, p: (c + SMOOTH * p) / (total + SMOOTH)).alias("p"))


def identify(rows: DataFrame, names: list[str], model: np.ndarray, text: str, markup: bool, keep_text: bool = False) -> DataFrame:
    """rows (any columns, among them declared, suffix, domain, host and the text column), without the text unless
    keep_text, with lang, confidence (its posterior), text_lang and empty, which take the place of columns so named.
    Evidence of a host is joined by host, a hot one's by broadcast."""
    made = ("lang", "confidence", "text_lang", "empty")
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in made and (keep_text or c != text)))
    given = [F.col(c).alias(f"__{c}") for c in ("declared", "suffix", "domain", "host")]
    n = len(names)
    seen = small_batches(rows.select(row.alias("__row"), *given, F.col(f"`{text}`").alias("__text"))).withColumn("__got", _likelihoods(model, markup)("__text"))
    seen = seen.drop("__text").select("*", F.slice("__got", 1, max(n, 1)).alias("__ll"), (F.element_at("__got", -1) == 1).alias("__empty")).drop("__got")
    if not names:
        return seen.select("__row.*", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_lang"), F.col("__empty").alias("empty"))
    langs = F.array(*map(F.lit, names))
    seen = materialize(seen.withColumn("__lang", F.when(~F.col("__empty"), F.element_at(langs, F.array_position("__ll", F.array_max("__ll")).cast("int")))))
    evidence = seen.select(*(F.col(f"__{c}").alias(c) for c in ("declared", "suffix", "domain", "host")), F.col("__lang").alias("text_lang"))
    sure = evidence.where("text_lang is not null")
    counts = {r["text_lang"]: r["count"] for r in sure.groupBy("text_lang").count().collect()}  # a row per language
    whole = [(counts.get(v, 0) + 1) / (sum(counts.values()) + n) for v in names]
    by_suffix = _estimate(sure, ["suffix"], whole, names)
    by_domain = _estimate(sure, ["suffix", "domain"], by_suffix, names)
    by_host = _estimate(sure, ["suffix", "domain", "host"], by_domain, names)

    counts = sure.where("declared is not null").groupBy("declared", "text_lang").agg(F.count("*").alias("n"))
    totals = counts.groupBy("text_lang").agg(F.sum("n").alias("all"), F.count("*").alias("values"))  # a row per language
    table_ = F.map_from_entries(F.collect_list(F.struct("text_lang", ((F.col("n") + 0.5) / (F.col("all") + 0.5 * F.col("values") + 0.5)))))
    chance = counts.join(F.broadcast(totals), "text_lang").groupBy("declared").agg(table_.alias("m"))
    chance = chance.select("declared", F.transform(langs, lambda v: F.coalesce(F.col("m")[v], F.lit(1e-3))).alias("__chance"))

    def evident(of: DataFrame, keys: list[str], more: DataFrame) -> DataFrame:
        """of with what its keys say; nulls and keys without any say nothing."""
        sizes = evidence.groupBy(*keys).agg(F.count("*").alias("__count"))
        per = materialize(sizes.join(more, keys))
        per = per.withColumnsRenamed({k: f"__{k}" for k in keys})
        names_ = [f"__{k}" for k in keys]
        hot, cold = F.col("__count") > hot_count(total), F.col("__count") <= hot_count(total)
        out = of.join(F.broadcast(per.where(hot).drop("__count").withColumnsRenamed({c: f"{c}__hot" for c in per.columns if c not in names_})), names_, "left")
        value = next(c for c in per.columns if c not in (*names_, "__count"))
        rest = per.where(cold).drop("__count").withColumnsRenamed({c: f"{c}__cold" for c in per.columns if c not in names_})
        if rest.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # some MB
            out = out.join(F.broadcast(rest), names_, "left")
        else:  # rows of hot keys, and those without, aren't shuffled by them
            cold_key = F.col(f"{value}__hot").isNull() & ~reduce(lambda a, b: a | b, (F.col(c).isNull() for c in names_))
            key = F.when(cold_key, F.xxhash64(*names_)).otherwise(F.xxhash64(F.monotonically_increasing_id()))
            rest = rest.withColumn("__k", F.xxhash64(*names_)).withColumnsRenamed({c: f"{c}__r" for c in names_})
            same = [F.col("__key") == F.col("__k"), *(F.col(c) == F.col(f"{c}__r") for c in names_)]
            out = out.withColumn("__key", key).join(rest, same, "left").drop("__key", "__k", *(f"{c}__r" for c in names_))
        return out.withColumn(value, F.coalesce(f"{value}__hot", f"{value}__cold")).drop(f"{value}__hot", f"{value}__cold")

    total = seen.count()
    out = evident(seen, ["suffix", "domain", "host"], by_host.withColumnRenamed("p", "__p"))
    out = evident(out, ["declared"], chance)
    prior = F.coalesce("__p", F.array(*map(F.lit, whole)))
    logs = F.zip_with(F.zip_with("__ll", prior, lambda a, p: a + F.ln(p)), F.coalesce("__chance", F.array(*[F.lit(1.0)] * n)), lambda a, p: a + F.ln(p))
    out = out.withColumn("__post", logs)
    top = F.array_max("__post")
    mass = F.aggregate("__post", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return out.select("__row.*", F.element_at(langs, F.array_position("__post", top).cast("int")).alias("lang"), (1 / mass).alias("confidence"), F.col("__lang").alias("text_lang"), F.col("__empty").alias("empty"))


def address(url: Column) -> tuple[Column, Column, Column]:
    """(suffix, domain, host) of a web address, lower-cased; nulls and addresses without a host give empty strings."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    parts = F.split(host, r"\.")
    return F.element_at(parts, -1), F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."), host


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, host, declared, lang, confidence, text_lang) of every page."""
    names, model = language_model(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    suffix, domain, host = address(F.col("url"))
    declared = F.lower(F.nullif(F.regexp_extract("html", r"(?is)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit("")))
    rows = pages.select("page_id", suffix.alias("suffix"), domain.alias("domain"), host.alias("host"), declared.alias("declared"), "html")
    return identify(rows, names, model, "html", True).select("page_id", "host", "declared", "lang", F.round("confidence", 6).alias("confidence"), "text_lang")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs whose language is clear: texts without letters, and those whose posterior is below `least`, go; `lang` is set
    to the language found. Their source stands for the host, their lang for the declaration. Where no text is labelled, there
    is no language to find: all texts with letters stay, their lang null."""
    names, model = language_model(docs)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, "text", F.lit("").alias("suffix"), F.lit("").alias("domain"), F.coalesce("source", F.lit("")).alias("host"), F.col("lang").alias("declared"))
    found = identify(rows, names, model, "text", False)
    kept = found.where(~F.col("empty") if not names else (~F.col("empty")) & (F.col("confidence") >= least))
    return kept.select(*((F.col("lang") if c == "lang" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
