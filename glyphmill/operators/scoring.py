"""Next-token tables, completion and masked loss."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.functions import symbols as sy, text as tx
from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.session import scratch_path

MAX_NEW_TOKENS = 50


def next_token_counts(
    tokens: DataFrame, context_size: int = 1, max_seq_len: int | None = None
) -> DataFrame:
    """``(context, next, freq)`` over the input/target pairs of every text.

    The context is the last ``context_size`` ids up to the input token. ``max_seq_len``
    counts model rows instead of whole texts. Partial counts absorb hot contexts before
    the shuffle.
    """
    ids = F.col("token_ids")
    if max_seq_len is not None:
        ids = F.slice(ids, 1, max_seq_len + 1)
    context = [f"c{i}" for i in range(context_size)]
    # Short rows give no steps. A filter on their size would be pushed down and encode twice.
    n_steps = F.greatest(F.size("ids") - context_size, F.lit(0))
    # What comes next is exploded, its context read from the ids beside it: no array of structs is made.
    following = F.slice("ids", F.lit(context_size + 1), n_steps)
    return (
        tokens.select(ids.alias("ids"))
        .select("ids", F.posexplode(following).alias("pos", "next"))
        .select(*[F.get("ids", F.col("pos") + i).alias(name) for i, name in enumerate(context)], "next")
        .where(F.col("next") != sy.PAD)
        .groupBy(*context, "next")
        .agg(F.count("*").alias("freq"))
        .select(F.array(*context).alias("context"), "next", "freq")
    )


def best_next(scores: DataFrame, score: str = "freq") -> DataFrame:
    """``(context, next)`` with the highest score; equal scores go to the lower id.

    Dividing the scores by a positive temperature would pick the same token.
    """
    return scores.groupBy("context").agg(
        F.max_by("next", F.struct(F.col(score), -F.col("next"))).alias("next")
    )


def _chain(best: DataFrame) -> DataFrame:
    """One step as a relation: ``context`` -> tokens appended and the context after them."""
    return best.select(
        "context",
        F.array("next").alias("tokens"),
        F.concat(F.slice("context", F.lit(2), F.size("context") - 1), F.array("next")).alias("last"),
    )


def _follow(left: DataFrame, chain: DataFrame) -> DataFrame:
    """Append ``chain`` at ``left.last``; a row whose context is unknown stays as it is."""
    step = chain.select(
        F.col("context").alias("at"), F.col("tokens").alias("more"), F.col("last").alias("then")
    )
    kept = [c for c in left.columns if c not in ("tokens", "last")]
    return left.join(step, F.col("last") == F.col("at"), "left").select(
        *kept,
        F.when(F.col("at").isNull(), F.col("tokens"))
        .otherwise(F.concat("tokens", "more"))
        .alias("tokens"),
        F.when(F.col("at").isNull(), F.lit(None)).otherwise(F.col("then")).alias("last"),
    )


def continuations(
    prompts: DataFrame, best: DataFrame, context_size: int = 1, max_new_tokens: int = MAX_NEW_TOKENS
) -> DataFrame:
    """``prompts`` (with ``token_ids``) plus ``new_ids``: the greedy continuation.

    Steps are composed by doubling: the relation for 2, 4, 8 ... tokens is the join of the
    one before with itself, and the prompts take those that add up to ``max_new_tokens``.
    50 tokens need 8 joins instead of 50. Each relation is written to the shared folder, so
    the counts behind ``best`` are made once. It is keyed by distinct context: a join never
    multiplies rows, and a context many rows share skews the probe side only, which AQE
    splits. A prompt whose context was never seen stops there.
    """
    spark, folder = best.sparkSession, scratch_path(best.sparkSession, "steps")

    def stored(chain: DataFrame, steps: int) -> DataFrame:
        chain.write.parquet(f"{folder}/{steps}")
        return spark.read.schema(chain.schema).parquet(f"{folder}/{steps}")

    size = F.size("token_ids")
    rows = prompts.withColumn("tokens", F.array().cast("array<int>")).withColumn(
        "last",
        F.when(
            size >= context_size,
            F.slice("token_ids", size - context_size + 1, F.lit(context_size)),
        ),
    )
    chain, steps = stored(_chain(best), 1), 1
    while steps <= max_new_tokens:
        if max_new_tokens & steps:
            rows = _follow(rows, chain)
        steps *= 2
        if steps <= max_new_tokens:
            chain = stored(_follow(chain, chain), steps)
    return rows.drop("last").withColumnRenamed("tokens", "new_ids")


def complete(
    prompts: DataFrame,
    tokenizer: Tokenizer,
    best: DataFrame,
    *keys: str,
    column: str = "text",
    context_size: int = 1,
    max_new_tokens: int = MAX_NEW_TOKENS,
) -> DataFrame:
    """``(keys, prompt, new_ids, completion)`` for every prompt that is not blank, trimmed."""
    encoded = prompts.where(F.col(column).isNotNull() & ~tx.is_blank(column)).select(
        *keys, tx.trimmed(column).alias("prompt"), tokenizer.encode_prompt(column).alias("token_ids")
    )
    return continuations(encoded, best, context_size, max_new_tokens).select(
        *keys,
        "prompt",
        "new_ids",
        F.concat("prompt", tokenizer.decode("new_ids")).alias("completion"),
    )


def cross_entropy(logits: Column | str, target: Column | str) -> Column:
    """``logsumexp(logits) - logits[target]`` of one position, in doubles."""
    logits = F.col(logits) if isinstance(logits, str) else logits
    target = F.col(target) if isinstance(target, str) else target
    scores = logits.cast("array<double>")
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    own = F.get(scores, target)
    # A target that no score belongs to is an error, not a term to leave out.
    wrong = F.raise_error(F.concat(F.lit("target outside the logits: "), F.coalesce(target.cast("string"), F.lit("null"))))
    return F.ln(total) + top - F.coalesce(own, wrong.cast("double"))


def _known_loss(lse: Column | str, score: Column | str, target: Column | str) -> Column:
    """Loss of a position scored by :func:`scored_tokens`; a target without a score is an error."""
    target = F.col(target) if isinstance(target, str) else target
    wrong = F.raise_error(F.concat(F.lit("target outside the logits: "), F.coalesce(target.cast("string"), F.lit("null"))))
    return F.col(lse) - F.coalesce(F.col(score), wrong.cast("double"))


def masked_loss(scored: DataFrame, *by: str, logits: str = "logits", target: str = "target"):
    """Loss per group; PAD targets contribute nothing, a null or unknown target is an error.

    The table has all scores of a position in ``logits``, or what :func:`scored_tokens` keeps of them.
    ``loss_nonpad`` divides by the counted positions, ``loss_all`` by all of them. Terms
    are summed as decimals, so the result does not depend on the partitioning.
    """
    counted = F.coalesce(F.col(target) != sy.PAD, F.lit(True))
    whole = logits in scored.columns
    loss = cross_entropy(logits, target) if whole else _known_loss("lse", "score", target)
    term = F.when(counted, loss).cast("decimal(30,12)")
    total = F.coalesce(F.sum("term"), F.lit(0)).cast("double")
    return (
        scored.select(*by, counted.alias("counted"), term.alias("term"))
        .groupBy(*by)
        .agg(
            F.count("*").alias("n_all"),
            F.count_if("counted").alias("n_nonpad"),
            F.try_divide(total, F.count_if("counted").cast("double")).alias("loss_nonpad"),
            F.try_divide(total, F.count("*").cast("double")).alias("loss_all"),
        )
    )


def score_with(
    tokens: DataFrame,
    make_scorer: Callable[[], Callable[[pd.Series], pd.Series]],
    *keys: str,
    logits_type: str = "array<float>",
) -> DataFrame:
    """``tokens`` plus ``logits`` from the caller's model, one row of scores per sequence.

    ``make_scorer`` runs once per task, so a model is loaded where it is used.
    """
    kept = tokens.select(*keys, "token_ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for part in parts:
            yield part.assign(logits=scorer(part["token_ids"]))

    return kept.mapInPandas(run, f"{fields}, logits {logits_type}")


def log_sum_exp(blocks: Iterable[np.ndarray], targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``logsumexp`` of the scores of each place, and the score of its target (NaN if it has none).

    Scores come as blocks of consecutive ids, ``(places, ids)``; a running maximum and sum are all that
    is kept, so no place ever needs its whole row of the vocabulary.
    """
    n, at = len(targets), 0
    top, total, own = np.full(n, -np.inf), np.zeros(n), np.full(n, np.nan)
    for block in blocks:
        block = np.asarray(block, dtype=float).reshape(n, -1)
        if not block.size:
            continue
        high = np.maximum(top, block.max(axis=1))
        # A place whose scores are all minus infinity so far has no sum yet.
        shift = np.where(np.isneginf(high), 0, high)
        total = total * np.exp(np.where(np.isneginf(top), -np.inf, top - shift)) + np.exp(block - shift[:, None]).sum(axis=1)
        inside = np.flatnonzero((targets >= at) & (targets < at + block.shape[1]))
        own[inside] = block[inside, targets[inside] - at]
        top, at = high, at + block.shape[1]
    with np.errstate(divide="ignore"):
        return np.log(total) + np.where(np.isneginf(top), 0, top), own


# About so many places are given to a scorer at a time.
SCORED_PLACES = 4096


def scored_tokens(
    tokens: DataFrame,
    make_scorer: Callable[[], Callable[[pd.Series], Iterable]],
    *keys: str,
) -> DataFrame:
    """``(keys, pos, lse, score, target)``: how the caller's model scores what follows each token.

    The scorer gets the inputs of some texts, their ids but the last, and gives for each text its scores:
    one list per place, or an iterator over blocks of them, ``(places, ids)`` with consecutive ids. The
    target of a place is the next id. A place leaves the worker as the ``logsumexp`` of its scores and the
    score of its target (null if there is none), so rows do not grow with the vocabulary. This is
    the table ``masked_loss`` sums. Texts of fewer than two ids have no places.
    """
    kept = tokens.select(*keys, "token_ids").where(F.size("token_ids") > 1)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "token_ids")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for part in parts:
            start = 0
            sizes = part["token_ids"].map(len).to_numpy() - 1
            while start < len(part):
                stop = max(start + 1, int(np.searchsorted(np.cumsum(sizes[start:]), SCORED_PLACES, "right")) + start)
                some, start = part.iloc[start:stop], stop
                targets = [np.asarray(ids[1:], np.int64) for ids in some["token_ids"]]
                given = scorer(some["token_ids"].map(lambda ids: list(ids[:-1])).reset_index(drop=True))
                found = [
                    log_sum_exp(scores if isinstance(scores, Iterator) else [np.asarray(list(scores), dtype=float)], t)
                    for scores, t in zip(given, targets)
                ]
                n = [len(t) for t in targets]
                rows = some[list(keys)].loc[some.index.repeat(n)].reset_index(drop=True)
                score = pd.Series(np.concatenate([own for _, own in found]))
                yield rows.assign(
                    pos=np.concatenate([np.arange(k) for k in n]).astype(np.int32),
                    lse=np.concatenate([lse for lse, _ in found]),
                    score=score.astype(object).where(score.notna(), None),
                    target=np.concatenate(targets).astype(np.int32),
                )

    return kept.mapInPandas(run, f"{fields}, pos int, lse double, score double, target int")


def continue_with(
    prompts: DataFrame,
    make_scorer: Callable[[], Callable[[pd.Series], pd.Series]],
    *keys: str,
    max_new_tokens: int = MAX_NEW_TOKENS,
    stop_at_end: bool = False,
) -> DataFrame:
    """``(keys, new_ids)``: greedy completion of ``token_ids`` by the caller's model.

    Each step scores the open sequences of a batch and appends the best id after their last
    place, of equal scores the lowest. Every sequence takes ``max_new_tokens`` steps; with
    ``stop_at_end`` it closes with EOS, which is left out. An empty sequence gets nothing.
    """
    end = sy.EOS if stop_at_end else None
    kept = prompts.select(*keys, "token_ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "token_ids")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for part in parts:
            ids = [list(x) for x in part["token_ids"]]
            new, live = [[] for _ in ids], [i for i, x in enumerate(ids) if x]
            for _ in range(max_new_tokens):
                if not live:
                    break
                scores = scorer(pd.Series([ids[i] for i in live]))
                best = {i: int(np.argmax(np.asarray(s[-1], dtype=float))) for i, s in zip(live, scores)}
                live = [i for i in live if best[i] != end]
                for i in live:
                    ids[i].append(best[i])
                    new[i].append(best[i])
            yield part[list(keys)].assign(new_ids=new)

    return kept.mapInPandas(run, f"{fields}, new_ids array<int>")
