"""Reading a corpus: Parquet scan, text columns, file facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_corpus(
    spark: SparkSession, *paths: str, text: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Parquet files as a DataFrame; with ``text``, that column must exist and be a string.

    The scan stays as the files are split. ``partitions`` deals the rows out anew, which
    moves every text once: it is for inputs of fewer splits than there are cores.
    """
    df = spark.read.parquet(*paths)
    if partitions is not None:
        df = df.repartition(partitions)
    if text is not None:
        require_text(df, text)
    return df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def require_text(df: DataFrame, column: str) -> DataFrame:
    """``df`` itself; an unknown column is an AnalysisException, a non-string one a TypeError."""
    data_type = df.select(column).schema[0].dataType
    if not isinstance(data_type, T.StringType):
        raise TypeError(f"column {column!r} is {data_type.simpleString()}, not string")
    return df


def texts(df: DataFrame, column: str = "text", *keys: str) -> DataFrame:
    """Rows with a text (nulls dropped, empty strings kept), reduced to ``keys`` and the column."""
    return require_text(df, column).select(*keys, column).where(F.col(column).isNotNull())


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: ``ordinal``, ``name``, ``type`` and the table's row count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(fields), "n_rows")
