"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "valid_alignments", "lineage_join_fill", "hit_calling", "taxon_counts_rollup", "top_hit_protein", "top_hit_nucleotide", "contig_synthesis", "read_upsert", "nt_nr_merge", "contig_summary_merge", "tally_lengths",
    "percentile_index_stats", "covered_length", "position_depth_rle", "bin_coverage", "hit_groups", "gene_coverage", "prefix_dedup", "subsample_hash", "redup_chain", "read_metrics", "n50", "complexity_filter",
    "greedy_reduction", "lineage_tree", "lineage_versions", "gene_report", "spearman",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from strandline.operators.scalar import remove_shared
    from strandline.queries import QUERIES

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["valid_alignments"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the session
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(Path(sf_dir).name.removeprefix("sf") or 0)}))
    remove_shared(spark)
    spark.stop()


if __name__ == "__main__":
    main()
