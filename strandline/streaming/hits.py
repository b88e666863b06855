"""Beyond the reference: hit calling and read pairing over streams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from strandline.operators.filters import valid_alignments
from strandline.operators.hits import with_lineage, with_taxid


def running_best(alignments: DataFrame) -> DataFrame:
    """The best alignment so far of each read, for update mode."""
    order = F.struct("bitscore", (-F.col("ord")).alias("o"))
    return alignments.groupBy("qseqid").agg(F.max_by("sseqid", order).alias("sseqid"), F.max("bitscore").alias("bitscore"), F.count("*").alias("n"))


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def paired_stream(one: DataFrame, two: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Mates (read_id, ts, ...) of two streams, each waited for as long as `late`."""
    a = one.withWatermark("ts", late).withColumnRenamed("ts", "ts1")
    b = two.withWatermark("ts", late).withColumnRenamed("ts", "ts2").withColumnRenamed("read_id", "mate_id")
    near = F.col("ts2").between(F.col("ts1") - F.expr(f"interval {late}"), F.col("ts1") + F.expr(f"interval {late}"))
    return a.join(b, (F.col("read_id") == F.col("mate_id")) & near)


# ------------------------------------------------------------------ hit calling
CALLED = "qseqid long, sseqid string, bitscore double, ord long, level int, taxid long, accession_id string, species_taxid long, genus_taxid long, family_taxid long, seen long, closed boolean"


class HitCaller(StatefulProcessor):
    """Calls by a state of each read that timers close. Of each read the best score so far, and of the alignments of that score how many name each accession, and the first of
    them by `ord`: what a call needs, whatever order alignments come in. A call is made anew whenever a read's alignments
    change; `seen` counts those of a read, so its last call has the most. With `idle`, a read that got nothing for so many
    milliseconds is called a last time, `closed`, and forgotten."""

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "score double, seen long")
        self.hits = handle.getMapState("hits", "species long, sseqid string", "n long, ord long, genus long, family long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        score, seen = self.best.get() if self.best.exists() else (-math.inf, 0)
        for part in rows:
            seen += len(part)
            top = float(part["bitscore"].max())
            if top < score:
                continue
            if top > score:
                score = top
                self.hits.clear()
            same = part[part["bitscore"] == score]
            for (species, accession), own in same.groupby(["species", "sseqid"]):
                first = own.loc[own["ord"].idxmin()]
                value = (len(own), int(first["ord"]), int(first["genus"]), int(first["family"]))
                at = (int(species), accession)
                if self.hits.containsKey(at):
                    n, order, genus, family = self.hits.getValue(at)
                    value = (n + value[0], min(order, value[1]), genus, family)
                self.hits.updateValue(at, value)
        self.best.update((score, seen))
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._called(key, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        if self.best.exists():
            yield self._called(key, True)
            self.best.clear()
            self.hits.clear()

    def _called(self, key, closed: bool) -> pd.DataFrame:
        score, seen = self.best.get()
        held = [(*at, *value) for at, value in self.hits.iterator()]
        known = [h for h in held if h[0] >= 0]
        if known:
            total: dict[int, int] = {}
            for species, _, n, *_ in known:
                total[species] = total.get(species, 0) + n
            winner = min(total, key=lambda s: (-total[s], s))
            species, accession, _, order, genus, family = min((h for h in known if h[0] == winner), key=lambda h: (-h[2], h[3]))
            row = (accession, score, order, 1, species, accession, species, genus, family)
        else:
            _, accession, _, order, *_ = min(held, key=lambda h: h[3])
            row = (accession, score, order, -1, -1, None, -1, -1, -1)
        return pd.DataFrame([(*key, *row, seen, closed)], columns=[f.split()[0] for f in CALLED.split(", ")])

    def close(self) -> None:
        pass


def _winner(hits: Column) -> Column:
    """(n, species, accession (n, ord, hit)): of the best alignments (species, sseqid, ord, genus, family) of a read the one
    that is called, n negative. One pass by species, accession and ord counts the runs of both; what it has at a run's end
    comes before what it had within the run, so the least that it ever has is the winner."""
    let = lambda value, f: F.transform(F.array(value), f)[0]
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    hit = "struct<species:bigint,sseqid:string,ord:bigint,genus:bigint,family:bigint>"
    accession = f"struct<n:bigint,ord:bigint,hit:{hit}>"
    best = f"struct<n:bigint,species:bigint,accession:{accession}>"
    none = lambda kind: F.lit(None).cast(kind)

    def counted(a: Column, x: Column) -> Column:
        species = F.coalesce(a["hit"]["species"] == x["species"], F.lit(False))
        same = species & a["hit"]["sseqid"].eqNullSafe(x["sseqid"])
        n_species, n = F.when(species, a["n_species"] + 1).otherwise(one), F.when(same, a["n"] + 1).otherwise(one)
        return F.struct(n_species.alias("n_species"), n.alias("n"), F.when(same, a["hit"]).otherwise(x).alias("hit"), F.when(species, a["accession"]).alias("accession"))

    def step(a: Column, x: Column) -> Column:
        def better(c: Column) -> Column:
            accession = F.least(c["accession"], F.struct((-c["n"]).alias("n"), c["hit"]["ord"].alias("ord"), c["hit"].alias("hit")))
            now = lambda least: F.struct((-c["n_species"]).alias("n"), c["hit"]["species"].alias("species"), least.alias("accession"))
            return let(accession, lambda least: F.struct(c["n_species"].alias("n_species"), c["n"].alias("n"), c["hit"].alias("hit"), least.alias("accession"), F.least(a["best"], now(least)).alias("best")))

        return let(counted(a, x), better)

    start = F.struct(zero.alias("n_species"), zero.alias("n"), none(hit).alias("hit"), none(accession).alias("accession"), none(best).alias("best"))
    return F.aggregate(F.array_sort(hits), start, step, lambda a: a["best"])


def _running_calls(rows: DataFrame) -> DataFrame:
    """Calls by a streaming aggregate, whose state is a read's alignments; no row of it passes through Python."""
    held = F.struct("bitscore", "species", "sseqid", "ord", "genus", "family")
    reads = rows.groupBy("qseqid").agg(F.max("bitscore").alias("score"), F.count("*").alias("seen"), F.collect_list(held).alias("held")).where("score is not null")
    top = F.transform(F.filter("held", lambda h: h["bitscore"] == F.col("score")), lambda h: F.struct(*(h[c].alias(c) for c in ("species", "sseqid", "ord", "genus", "family"))))
    reads = reads.select("qseqid", "score", "seen", top.alias("top"))
    reads = reads.withColumns({"won": _winner(F.filter("top", lambda h: h["species"] >= 0))["accession"]["hit"], "first": F.array_min(F.transform("top", lambda h: F.struct(h["ord"].alias("ord"), h["sseqid"].alias("sseqid"))))})
    known = F.col("won").isNotNull()
    either = lambda c: F.when(known, F.col(f"won.{c}")).otherwise(F.col(f"first.{c}"))
    rank = lambda c: F.when(known, F.col(f"won.{c}")).otherwise(F.lit(-1).cast("long"))
    return reads.select(
        "qseqid", either("sseqid").alias("sseqid"), F.col("score").alias("bitscore"), either("ord").alias("ord"), F.when(known, 1).otherwise(-1).alias("level"), rank("species").alias("taxid"),
        F.when(known, F.col("won.sseqid")).alias("accession_id"), *(rank(c).alias(f"{c}_taxid") for c in ("species", "genus", "family")), "seen", F.lit(False).alias("closed"))


def streamed_calls(alignments: DataFrame, acc2tax: DataFrame, lineage: DataFrame, min_length: int = 0, idle: int | None = None) -> DataFrame:
    """Calls (CALLED) of a stream of alignments, for update mode: a row whenever a read's call may have changed, of which the
    one of most `seen` is what call_hits() gives for all of them. Dimensions are joined as they are. Lists of taxa apply to
    last calls, so they are the reader's to apply. With `idle` reads have timers, so each is a call of HitCaller: the session's
    state store must be RocksDB's, and the stream has always something left to wait for, so it is for queries that run on,
    not for those of what is available now. Without, a streaming aggregate does the work, many times faster."""
    rows = with_lineage(with_taxid(valid_alignments(alignments, min_length), acc2tax), lineage)
    rows = rows.select(F.col("qseqid").cast("long").alias("qseqid"), "sseqid", F.col("bitscore").cast("double").alias("bitscore"), F.col("ord").cast("long").alias("ord"), *(F.col(c).cast("long").alias(c) for c in ("species", "genus", "family")))
    if idle is None:
        return _running_calls(rows)
    return rows.groupBy("qseqid").transformWithStateInPandas(HitCaller(idle), CALLED, "Update", "ProcessingTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Sets the session's state store to the one that streamed_calls() needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_available(calls: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream of calls over all that its source has now, from where the checkpoint left off."""
    written(calls, path, checkpoint).trigger(availableNow=True).start().awaitTermination()


def written(calls: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer that adds calls to a Parquet table, a folder for each batch; a batch that is run again writes its own folder
    again."""

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return calls.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(add)


def last_calls(spark: SparkSession, path: str) -> DataFrame:
    """The last call of each read in such a table."""
    rows = spark.read.schema(CALLED).parquet(path)
    names = [f.split()[0] for f in CALLED.split(", ")]
    return rows.groupBy("qseqid").agg(F.max_by(F.struct(*names), F.struct("seen", "closed")).alias("c")).select("c.*")
