"""Report tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str, format: str = "parquet") -> None:
    """Store a result table as ``parquet``, ``json`` or any Spark format."""
    report.write.mode("overwrite").format(format).save(path)


def with_progress(df: DataFrame, observation, **metrics) -> DataFrame:
    """``df`` that reports row count and further aggregates to a Spark Observation when run."""
    from pyspark.sql import functions as F

    extra = [value.alias(name) for name, value in metrics.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra)
