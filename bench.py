"""Times the headline queries; prints one JSON line.

Every query starts from the Parquet files. Training is timed on its own first, for the small
and the larger vocabulary; the queries that encode find the tokenizer it wrote in the shared
folder, as they would find a tokenizer file. The one file of each table is dealt over the cores
by an explicit setting, which is off by default.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from glyphmill.plans import catalog

QUERIES = [
    "profile_documents",
    "char_frequency",
    "length_histogram",
    "word_frequency",
    "corpus_totals",
    "pair_frequency",
    "encode_documents",
    "encode_large_vocabulary",
    "token_rows",
    "token_table",
    "decode_documents",
    "occurrence_ids",
    "train_valid_split",
    "train_batches",
    "next_token_counts",
    "best_next_token",
    "complete_prompts",
    "masked_loss",
    "scorer_loss",
    "stream_word_frequency",
    "stream_tokens",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='bench-')}")
        .config(catalog.PARTITIONS, cpus)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    seconds = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    def write_out(name):
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()

    timed("train_merges", lambda: catalog.trained(spark, folder))
    timed("train_more_merges", lambda: catalog.trained(spark, folder, catalog.LARGE_VOCAB_SIZE))
    for name in QUERIES:
        timed(name, lambda: write_out(name))
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
