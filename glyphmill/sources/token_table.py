"""Stored token tables, found again by a fingerprint of tokenizer and source."""

from __future__ import annotations

import hashlib

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from glyphmill.operators.tokenizer import Tokenizer, token_rows


def source_fingerprint(df: DataFrame, *columns: str) -> str:
    """Identity of the rows of ``df``, independent of their order.

    Every row is hashed over ``columns`` (all by default): what is encoded decides, not the
    file it came from.
    """
    row = (
        df.select(F.xxhash64(*(columns or df.columns)).alias("h"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("h").cast("decimal(38,0)")).alias("total"),
            F.bit_xor("h").alias("mixed"),
        )
        .first()
    )
    return hashlib.md5(f"{row.n}:{row.total}:{row.mixed}".encode()).hexdigest()[:16]


def _file_facts(df: DataFrame) -> dict[str, str]:
    """Name, size and time of each file that ``df`` scans, by its name."""
    spark, facts = df.sparkSession, {}
    for name in sorted(df.inputFiles()):
        # Names come as URIs: blanks and the like are encoded.
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        facts[name] = f"{name}:{status.getLen()}:{status.getModificationTime()}"
    return facts


def files_fingerprint(df: DataFrame) -> str:
    """Identity of the files ``df`` scans, by their names, sizes and times: nothing is read.

    Rows that come from no file are identified by what they hold.
    """
    facts = _file_facts(df)
    return hashlib.md5("\n".join(facts.values()).encode()).hexdigest()[:16] if facts else source_fingerprint(df)


def token_store(
    spark: SparkSession, path: str, tokenizer: Tokenizer, folder: str, *keys: str, column: str = "text"
) -> DataFrame:
    """``token_rows`` of the Parquet files below ``path``, of which only new or changed ones are encoded.

    A part of the store is the rows of one file, known by its name, size and time; the manifest lists
    parts written to the end, and a part that is not listed is written again. Rows of files that have
    gone or changed are no longer returned. Keys must not be named ``part``.
    """
    base = f"{folder.rstrip('/')}/{tokenizer.fingerprint}-{'-'.join((*keys, column))}"
    facts = _file_facts(spark.read.parquet(path))
    parts = {name: hashlib.md5(fact.encode()).hexdigest()[:16] for name, fact in facts.items()}
    try:
        # One row per file the store has.
        listed = {r.part for r in spark.read.schema("part string, n_rows long").parquet(f"{base}/manifest").collect()}
    except AnalysisException:
        listed = set()
    new = {name: part for name, part in parts.items() if part not in listed}
    if new:
        plain = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)).toString() for name in new]
        docs = spark.read.parquet(*plain).withColumn("part", F.input_file_name())
        names = spark.createDataFrame(list(new.items()), "file string, part string")
        rows = token_rows(docs, tokenizer, *keys, "part", column=column).withColumnRenamed("part", "file")
        rows = rows.join(F.broadcast(names), "file").drop("file")
        rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("part").parquet(f"{base}/tokens")
        written = _parts(spark, base, new.values()).groupBy("part").agg(F.count("*").alias("n_rows"))
        # A file without a text has no rows, and is done all the same.
        done = names.select("part").join(written, "part", "left").fillna(0)
        done.coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return _parts(spark, base, parts.values()).drop("part")


def _parts(spark: SparkSession, base: str, parts) -> DataFrame:
    """The rows of the given parts; other parts are not read."""
    wanted = spark.createDataFrame([(p,) for p in parts], "part string")
    stored = spark.read.option("basePath", f"{base}/tokens").parquet(f"{base}/tokens")
    return stored.withColumn("part", F.col("part").cast("string")).join(F.broadcast(wanted), "part", "left_semi")


def _load(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The stored table if it was written to the end, else None."""
    try:
        expected = spark.read.parquet(f"{path}/manifest").first().n_rows
        stored = spark.read.schema(schema).parquet(f"{path}/tokens")
        return stored if stored.count() == expected else None
    except (PySparkException, Py4JJavaError, AttributeError):
        return None


def token_table(
    df: DataFrame,
    tokenizer: Tokenizer,
    folder: str,
    *keys: str,
    column: str = "text",
) -> DataFrame:
    """``token_rows`` read from ``folder`` when stored there for this tokenizer and these rows.

    The manifest is written after the table; a table without one counts as absent, and an
    unreadable one is computed again.
    """
    spark = df.sparkSession
    identity = source_fingerprint(df, *keys, column)
    path = f"{folder.rstrip('/')}/{tokenizer.fingerprint}-{identity}-{'-'.join((*keys, column))}"
    fresh = token_rows(df, tokenizer, *keys, column=column)
    stored = _load(spark, path, fresh.schema)
    if stored is not None:
        return stored
    fresh.write.mode("overwrite").parquet(f"{path}/tokens")
    written = spark.read.schema(fresh.schema).parquet(f"{path}/tokens")
    written.agg(F.count("*").alias("n_rows")).write.mode("overwrite").parquet(f"{path}/manifest")
    return written
