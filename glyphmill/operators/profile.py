"""Profile of text columns: few scans, partial aggregates, long result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from glyphmill.functions import text as tx
from glyphmill.sources.corpus import require_text, text_columns

# Lower edges of the length histogram; the last bucket is open.
HISTOGRAM_EDGES = (0, 100, 500, 1000, 5000, 10000, 50000)


def text_measures(df: DataFrame, *keys: str, column: str = "text") -> DataFrame:
    """Characters, words and graphemes of every non-null text."""
    return (
        require_text(df, column)
        .where(F.col(column).isNotNull())
        .select(
            *keys,
            tx.char_count(column).alias("chars"),
            tx.word_count(column).alias("words"),
            tx.grapheme_count(column).alias("graphemes"),
        )
    )


def profile(df: DataFrame, *columns: str) -> DataFrame:
    """``(column, metric, value)`` for the given, or all, text columns.

    One scan counts the rows of each length, per column and measure; that table has a row per
    distinct length, is summed in parallel before it moves, and every metric comes from it. The
    median is the upper one: element ``n / 2`` of the sorted lengths, where the running count of
    rows first passes ``n / 2``.
    """
    columns = columns or tuple(text_columns(df))
    for name in columns:
        require_text(df, name)
    kinds = (("chars", tx.char_count), ("words", tx.word_count), ("graphemes", tx.grapheme_count))
    measures = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("kind"),
                measure(F.col(f"`{name}`")).cast("bigint").alias("size"),
            )
            for name in columns
            for kind, measure in kinds
        ]
    )
    counts = df.select(F.inline(measures)).groupBy("column", "kind", "size").agg(F.count("*").alias("rows"))
    # An empty table has metrics too.
    none = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c in columns for k, _ in kinds])
    zeros = df.sparkSession.range(1).select(F.inline(none)).select(
        "column", "kind", F.lit(None).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("rows")
    )
    counts = counts.unionByName(zeros)
    seen = F.col("size").isNotNull()
    running = Window.partitionBy("column", "kind").orderBy(F.col("size").asc_nulls_first())
    every = Window.partitionBy("column", "kind")
    placed = counts.select(
        "*",
        F.sum(F.when(seen, F.col("rows"))).over(running).alias("upto"),
        F.sum(F.when(seen, F.col("rows"))).over(every).alias("n"),
    )
    total = F.sum("rows")
    present = F.coalesce(F.sum(F.when(seen, F.col("rows"))), F.lit(0))
    sums = placed.groupBy("column", "kind").agg(
        total.alias("rows"),
        present.alias("n"),
        F.min("size").alias("min"),
        F.max("size").alias("max"),
        F.try_divide(F.sum(F.col("size") * F.col("rows")).cast("double"), present.cast("double")).alias("mean"),
        F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("size"))).alias("median"),
    )
    metrics = {
        "chars": ("rows", "nulls", "null_pct", "n", "chars_min", "chars_max", "chars_mean", "chars_median"),
        "words": ("words_min", "words_max", "words_mean", "words_median"),
        "graphemes": ("graphemes_mean",),
    }
    nulls = F.col("rows") - F.col("n")
    plain = {"rows": F.col("rows"), "nulls": nulls, "null_pct": tx.percent(nulls, F.col("rows")), "n": F.col("n")}

    def entries(kind: str) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    plain.get(m, F.col(m.rpartition("_")[2] if m not in plain else "n")).cast("double").alias("value"),
                )
                for m in metrics[kind]
            ]
        )

    chosen = F.when(F.col("kind") == "chars", entries("chars")).when(F.col("kind") == "words", entries("words"))
    return sums.select("column", F.inline(chosen.otherwise(entries("graphemes"))))


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """``(column, n_rows, nulls, null_pct)``; the percentage is of all rows."""
    columns = columns or tuple(text_columns(df))
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("n_rows"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*rows))).withColumn(
        "null_pct", tx.percent(F.col("nulls"), F.col("n_rows"))
    )


def char_frequency(
    df: DataFrame, *columns: str, sample_rows: int | None = None, key: str | None = None
) -> DataFrame:
    """``(column, char, freq, rank)``; equal counts rank by character.

    With ``sample_rows`` only the rows with the lowest ``key`` are counted. The ranking
    window sees one row per distinct character.
    """
    columns = columns or tuple(text_columns(df))
    if sample_rows is not None:
        if key is None:
            raise ValueError("sample_rows needs a key to order by")
        df = df.select(key, *columns).orderBy(key).limit(sample_rows)
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), tx.chars(f"`{c}`").alias("chars")) for c in columns]
    )
    counted = (
        df.select(F.inline(entries))
        .select("column", F.explode("chars").alias("char"))
        .groupBy("column", "char")
        .agg(F.count("*").alias("freq"))
    )
    order = Window.partitionBy("column").orderBy(F.desc("freq"), "char")
    return counted.withColumn("rank", F.row_number().over(order))


def top_chars(df: DataFrame, *columns: str, k: int = 20, **sample) -> DataFrame:
    """The ``k`` most frequent characters of each column with a printable label."""
    return (
        char_frequency(df, *columns, **sample)
        .where(F.col("rank") <= k)
        .select("column", "rank", "char", tx.char_label("char").alias("label"), "freq")
    )


def length_histogram(df: DataFrame, *columns: str, edges=HISTOGRAM_EDGES) -> DataFrame:
    """``(column, lo, hi, n, pct)`` on half-open buckets, empty ones included."""
    columns = columns or tuple(text_columns(df))
    bounds = list(zip(edges, (*edges[1:], None)))
    lengths = df.select(*[tx.char_count(f"`{c}`").alias(f"len_{i}") for i, c in enumerate(columns)])
    aggregates, rows = [], []
    for i, name in enumerate(columns):
        length = F.col(f"len_{i}")
        aggregates.append(F.count(length).alias(f"n_{i}"))
        for b, (lo, hi) in enumerate(bounds):
            inside = length >= lo if hi is None else (length >= lo) & (length < hi)
            aggregates.append(F.count_if(inside).alias(f"n_{i}_{b}"))
            rows.append(
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(lo).cast("bigint").alias("lo"),
                    F.lit(hi).cast("bigint").alias("hi"),
                    F.col(f"n_{i}_{b}").alias("n"),
                    tx.percent(F.col(f"n_{i}_{b}"), F.col(f"n_{i}")).alias("pct"),
                )
            )
    return lengths.agg(*aggregates).select(F.inline(F.array(*rows)))


def sample_texts(df: DataFrame, key: str, *columns: str, k: int = 3) -> DataFrame:
    """Previews of the first ``k`` non-null texts of each column in ``key`` order."""
    columns = columns or tuple(text_columns(df))
    samples = None
    for name in columns:
        # A limit per column plans as a top-k per partition; no full sort.
        one = (
            df.where(F.col(f"`{name}`").isNotNull())
            .orderBy(key)
            .limit(k)
            .select(F.lit(name).alias("column"), key, tx.preview(f"`{name}`").alias("preview"))
        )
        samples = one if samples is None else samples.unionByName(one)
    return samples
