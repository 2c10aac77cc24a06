"""The profile, word-count and encoding jobs over files that keep arriving."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from glyphmill.functions import text as tx
from glyphmill.operators.profile import HISTOGRAM_EDGES
from glyphmill.operators.tokenizer import Tokenizer, token_rows
from glyphmill.operators.words import word_frequency
from glyphmill.session import drop_folder


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100
) -> DataFrame:
    """Files below ``path`` as they arrive, split as they lie."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The last complete result of a job that replaces its result with every batch."""
    versions = spark.read.parquet(f"{out}/versions")
    last = versions.agg({"version": "max"}).first()[0]
    return spark.read.parquet(f"{out}/result-{last}")


def _replace_each_batch(result: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write the full result of each batch as a version of its own, then list that version.

    A reader sees the last listed version at any time; the one before it stays, for those still
    reading, and older ones go. Writing a batch again gives the same table.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out}/result-{batch_id}")
        spark.createDataFrame([(batch_id,)], "version bigint").coalesce(1).write.mode("append").parquet(f"{out}/versions")
        drop_folder(spark, f"{out}/result-{batch_id - 2}")

    # Counts of many words are kept on disk, not in the executors' heap.
    conf, name = result.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return (
            result.writeStream.outputMode("complete")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(replace)
            .start()
        )
    finally:
        conf.set(name, before)


# After so many batches the log of word counts is folded into one table.
FOLDED_BATCHES = 16


def stream_word_frequency(
    stream: DataFrame, out: str, checkpoint: str, column: str = "text", folded_batches: int = FOLDED_BATCHES
) -> StreamingQuery:
    """Word counts over everything seen so far, read by :func:`word_counts`.

    Every batch writes the counts of its own words and nothing else; readers add them up. Every
    ``folded_batches`` batches the log is folded into one table, which replaces the log up to there.
    A batch that runs again overwrites what it wrote.
    """

    def log(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        word_frequency(batch, column).write.mode("overwrite").parquet(f"{out}/log/batch={batch_id}")
        if (batch_id + 1) % folded_batches:
            return
        # A table folded here before and not committed is not read: what came before makes it anew.
        base = _folded(spark, out, batch_id)
        _logged(spark, out, base, batch_id).write.mode("overwrite").parquet(f"{out}/folded-{batch_id}")
        spark.createDataFrame([(batch_id,)], "batch bigint").coalesce(1).write.mode("append").parquet(f"{out}/folds")
        if base is not None:
            for old in range(base - folded_batches + 1, base + 1):
                drop_folder(spark, f"{out}/log/batch={old}")
            drop_folder(spark, f"{out}/folded-{base - folded_batches}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(log).start()
    )


def _folded(spark: SparkSession, out: str, below: int | None = None) -> int | None:
    """The batch up to which the log was folded last, before batch ``below`` if given."""
    try:
        folds = spark.read.schema("batch bigint").parquet(f"{out}/folds")
        return folds.where(F.col("batch") < (2**62 if below is None else below)).agg({"batch": "max"}).first()[0]
    except AnalysisException:
        return None


def _logged(spark: SparkSession, out: str, base: int | None, last: int | None = None) -> DataFrame:
    """The table folded at ``base`` and the log after it, to batch ``last``, added up."""
    log = spark.read.parquet(f"{out}/log").where(F.col("batch") > (-1 if base is None else base))
    if last is not None:
        log = log.where(F.col("batch") <= last)
    rows = log.select("word", "freq")
    if base is not None:
        rows = rows.unionByName(spark.read.parquet(f"{out}/folded-{base}"))
    return rows.groupBy("word").agg(F.sum("freq").alias("freq"))


def word_counts(spark: SparkSession, out: str) -> DataFrame:
    """``(word, freq)`` of all batches that a word-count job has written so far."""
    return _logged(spark, out, _folded(spark, out))


def running_profile(df: DataFrame, column: str = "text") -> DataFrame:
    """Counts, nulls, min, max, mean and length histogram: the part of the profile whose
    state stays one small row however long the stream runs (medians are not)."""
    measured = df.select(
        F.col(column).isNull().alias("missing"),
        tx.char_count(column).alias("chars"),
        tx.word_count(column).alias("words"),
    )
    aggregates = [
        F.count("*").alias("n_rows"),
        F.count_if("missing").alias("nulls"),
        *[
            aggregate(kind).alias(f"{kind}_{name}")
            for kind in ("chars", "words")
            for name, aggregate in (("min", F.min), ("max", F.max), ("mean", F.avg))
        ],
    ]
    for lo, hi in zip(HISTOGRAM_EDGES, (*HISTOGRAM_EDGES[1:], None)):
        inside = F.col("chars") >= lo
        if hi is not None:
            inside = inside & (F.col("chars") < hi)
        aggregates.append(F.count_if(inside).alias(f"chars_from_{lo}"))
    return measured.agg(*aggregates)


def stream_profile(
    stream: DataFrame, out: str, checkpoint: str, column: str = "text"
) -> StreamingQuery:
    return _replace_each_batch(running_profile(stream, column), out, checkpoint)


def stream_tokens(
    stream: DataFrame, tokenizer: Tokenizer, out: str, checkpoint: str, *keys: str, column="text"
) -> StreamingQuery:
    """Append token rows to ``out``. Stateless, so the file sink commits each batch once."""
    return (
        token_rows(stream, tokenizer, *keys, column=column)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
