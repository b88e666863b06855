"""Counts of steps taken while their rows pass by, without a scan of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StepCounts:
    """Observes the frames of a plan's steps. Once an action has run over the last of them, counts() has the rows of each
    step, and the reads that they stand for where duplicates were told; steps that the action didn't run aren't counted, and
    asking for them waits for one that does."""

    def __init__(self):
        self.steps: dict[str, Observation] = {}

    def add(self, name: str, rows: DataFrame, size: str | None = None) -> DataFrame:
        """rows themselves, counted as step `name`; `size`: the column of how many reads a row stands for, 1 if null."""
        if name in self.steps:
            raise ValueError(f"two steps are called {name}")
        self.steps[name] = Observation(name)
        reads = F.sum(F.coalesce(F.col(size), F.lit(1)).cast("long")) if size else F.count(F.lit(1))
        return rows.observe(self.steps[name], F.count(F.lit(1)).alias("rows"), F.coalesce(reads, F.lit(0)).alias("reads"))

    def counts(self) -> list[tuple[str, int, int]]:
        """(step, rows, reads) in the order that the steps were added."""
        return [(name, o.get["rows"], o.get["reads"]) for name, o in self.steps.items()]


def with_sizes(reads: DataFrame, sizes: DataFrame, key: str = "read_id") -> DataFrame:
    """reads with `size`, how many reads their cluster has (sizes: read_id, size), 1 where they have none."""
    return reads.join(sizes.select(F.col("read_id").alias("__id"), "size"), F.col(key) == F.col("__id"), "left").drop("__id").withColumn("size", F.coalesce("size", F.lit(1)).cast("long"))
