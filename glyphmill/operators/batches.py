"""Fixed-length model rows and mini-batches from a token table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.functions import symbols as sy
from glyphmill.operators.ordering import shuffled_rank

MAX_SEQ_LEN = 512
BATCH_SIZE = 16
SEED = 42


def windows(tokens: DataFrame, max_seq_len: int = MAX_SEQ_LEN, truncate: bool = False) -> DataFrame:
    """``tokens`` with ``window_no`` and ``token_ids`` cut into consecutive windows.

    A window has up to ``max_seq_len + 1`` ids and begins with the last id of the one before,
    so every token and its successor are in exactly one window. A text without a successor has one
    window. ``truncate`` keeps only the first window of each text.
    """
    n_windows = F.greatest(F.ceil((F.size("token_ids") - 1) / max_seq_len), F.lit(1)).cast("int")
    numbers = F.array(F.lit(0)) if truncate else F.sequence(F.lit(0), n_windows - 1)
    others = [c for c in tokens.columns if c != "token_ids"]
    return tokens.select(*others, "token_ids", F.explode(numbers).alias("window_no")).select(
        *others,
        "window_no",
        F.slice("token_ids", F.col("window_no") * max_seq_len + 1, F.lit(max_seq_len + 1)).alias("token_ids"),
    )


def _shifted(token_ids: Column, max_seq_len: int, by: int) -> Column:
    """``max_seq_len`` ids from place ``by`` on, filled up with PAD."""
    ids = F.slice(token_ids, 1 + by, max_seq_len)
    # Most windows are full and need no filling.
    missing = max_seq_len + by - F.greatest(F.size(token_ids), F.lit(by))
    return F.when(missing <= 0, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(sy.PAD), missing)))


def model_rows(df: DataFrame, max_seq_len: int = MAX_SEQ_LEN) -> DataFrame:
    """``token_ids`` of windows replaced by ``input`` and ``target``, shifted by one."""
    return (
        df.withColumn("input", _shifted(F.col("token_ids"), max_seq_len, 0))
        .withColumn("target", _shifted(F.col("token_ids"), max_seq_len, 1))
        .drop("token_ids")
    )


def batch_windows(
    tokens: DataFrame,
    key: str,
    epoch: int | None = None,
    batch_size: int = BATCH_SIZE,
    max_seq_len: int = MAX_SEQ_LEN,
    seed: int = SEED,
    truncate: bool = False,
) -> DataFrame:
    """``(epoch, batch_id, row_in_batch, key, window_no, token_ids)`` over all windows of all texts.

    With an ``epoch`` windows are reshuffled for it; without, they keep the order of the split.
    """
    order = seed if epoch is None else f"{seed}:{epoch}"
    position = F.col("rn") - 1
    cut = windows(tokens.select(key, "token_ids"), max_seq_len, truncate)
    named = cut.withColumn(
        "window_key", F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), "window_no")
    )
    return shuffled_rank(named, "window_key", order).select(
        F.lit(epoch).cast("int").alias("epoch"),
        F.floor(position / batch_size).alias("batch_id"),
        (position % batch_size).cast("int").alias("row_in_batch"),
        key,
        "window_no",
        "token_ids",
    )


def batches(tokens: DataFrame, key: str, epoch: int | None = None, **options) -> DataFrame:
    """``(epoch, batch_id, row_in_batch, key, window_no, input, target)``; the last batch may be short."""
    return model_rows(batch_windows(tokens, key, epoch, **options), options.get("max_seq_len", MAX_SEQ_LEN))


def stacked(windows_of_batches: DataFrame, max_seq_len: int = MAX_SEQ_LEN) -> DataFrame:
    """One row per batch of ``batch_windows``, ``inputs`` and ``targets`` as matrices.

    Windows move unpadded; a group is one batch, and padding and shifting happen inside it.
    """
    ids = F.col("rows.token_ids")
    return (
        windows_of_batches.groupBy("epoch", "batch_id")
        .agg(F.sort_array(F.collect_list(F.struct("row_in_batch", "token_ids"))).alias("rows"))
        .select(
            "epoch",
            "batch_id",
            F.size("rows").alias("n_rows"),
            F.transform(ids, lambda x: _shifted(x, max_seq_len, 0)).alias("inputs"),
            F.transform(ids, lambda x: _shifted(x, max_seq_len, 1)).alias("targets"),
        )
    )


def next_token_pairs(
    tokens: DataFrame, *keys: str, max_seq_len: int | None = None
) -> DataFrame:
    """``(keys, pos, input, target)``: each token with its successor, PAD left out.

    Whole texts; ``max_seq_len`` takes the first pairs of each text instead.
    """
    ids = F.col("token_ids")
    if max_seq_len is not None:
        ids = F.slice(ids, 1, max_seq_len + 1)
    n_steps = F.greatest(F.size("ids") - 1, F.lit(0))
    # The target is exploded, its input read from the ids beside it: no array of structs is made.
    return (
        tokens.select(*keys, ids.alias("ids"))
        .select(*keys, "ids", F.posexplode(F.slice("ids", F.lit(2), n_steps)).alias("pos", "target"))
        .select(*keys, "pos", F.get("ids", F.col("pos")).alias("input"), "target")
        .where(F.col("target") != sy.PAD)
    )
