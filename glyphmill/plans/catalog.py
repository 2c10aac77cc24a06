"""The operators as named queries over the tables of one folder.

Array columns leave as space-separated text, so results compare by value anywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glyphmill.functions import symbols as sy, text as tx
from glyphmill.operators import batches as bt, ordering, profile as pf, scoring as sc, words as wd
from glyphmill.operators.tokenizer import (
    Tokenizer,
    encode_words,
    occurrence_ids,
    round_trip,
    token_rows,
)
from glyphmill.operators.training import learn_merges, train_tokenizer
from glyphmill.plans.corpus import build_training_set, complete_prompts, train_on_chunks
from glyphmill.session import scratch_path, shared_folder
from glyphmill.sources import tokenizer_files as tf
from glyphmill.sources.corpus import describe_schema, read_corpus
from glyphmill.sources.report import write_report
from glyphmill.sources.token_table import files_fingerprint, token_store, token_table
from glyphmill.streaming import jobs

MERGES = 24
VOCAB_SIZE = sy.FIRST_MERGE_ID + MERGES
COMPLETION_STEPS = sc.MAX_NEW_TOKENS
LARGE_VOCAB_SIZE = sy.FIRST_MERGE_ID + 300
SAMPLE_ROWS = 50
# A session setting: deal the rows of every scan out anew. Unset, scans stay as files are split.
PARTITIONS = "spark.glyphmill.scanPartitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    partitions = spark.conf.get(PARTITIONS, None)
    return read_corpus(spark, f"{folder}/{name}.parquet", partitions=partitions and int(partitions))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def trained(spark: SparkSession, folder: str, vocab_size: int = VOCAB_SIZE) -> Tokenizer:
    """The tokenizer of the folder's documents, found by their files or learned.

    Merges are kept in the shared folder; files of other names, sizes or times have others.
    """
    docs = documents(spark, folder)
    kept = f"{shared_folder(spark)}/glyphmill-tokenizers/{files_fingerprint(docs)}-{vocab_size}"
    return train_tokenizer(docs, vocab_size=vocab_size, folder=kept)


def _ids(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(column.cast("array<string>"), " ")


def _with_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: _ids(c) for c in columns or ("token_ids",)})


def _tokens(spark, folder) -> DataFrame:
    return token_rows(documents(spark, folder), trained(spark, folder), "doc_id")


# -- scans and profile ---------------------------------------------------------


def null_counts(spark, folder):
    out = None
    for name in ("documents", "conversations", "pages", "benchmark"):
        one = pf.null_counts(table(spark, folder, name)).select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# -- words and pairs -----------------------------------------------------------


def byte_symbols(spark, folder):
    return wd.word_frequency(documents(spark, folder)).select(
        "word",
        tx.to_hex("word").alias("hex"),
        _ids(sy.symbol_ids(sy.byte_symbols(F.col("word")))).alias("ids"),
    )


def hex_round_trip(spark, folder):
    hexed = wd.word_frequency(documents(spark, folder)).select("word", tx.to_hex("word").alias("hex"))
    return hexed.withColumn("back", tx.lossy_utf8(tx.from_hex("hex")))


def adjacent_symbols(spark, folder):
    def as_hex(position):
        return tx.to_hex(F.encode(F.substring("pair", position, 1), "ISO-8859-1"))

    pairs = F.posexplode(sy.windows(sy.byte_symbols(F.col("word")), 2)).alias("pos", "pair")
    return (
        wd.word_frequency(documents(spark, folder))
        .select("word", pairs)
        .select("word", "pos", as_hex(1).alias("left"), as_hex(2).alias("right"))
    )


def first_merge(spark, folder):
    """Every distinct word after the best pair of all is merged once."""
    frequency = wd.word_frequency(documents(spark, folder))
    tokenizer = learn_merges(frequency, sy.FIRST_MERGE_ID + 1)
    return _with_ids(encode_words(frequency, tokenizer))


# -- training ------------------------------------------------------------------


def train_merges(spark, folder):
    return train_tokenizer(documents(spark, folder), vocab_size=VOCAB_SIZE).merges_table(spark)


def train_more_merges(spark, folder):
    return trained(spark, folder, LARGE_VOCAB_SIZE).merges_table(spark)


def train_from_chunks(spark, folder):
    chunks = [documents(spark, folder), table(spark, folder, "conversations")]
    return train_on_chunks(chunks, vocab_size=VOCAB_SIZE).merges_table(spark)


def vocabulary(spark, folder):
    return (
        trained(spark, folder)
        .vocabulary(spark)
        .select("id", tx.to_hex("token").alias("token"), "kind")
    )


def vocabulary_size(spark, folder):
    return (
        trained(spark, folder)
        .vocabulary(spark)
        .agg(F.count_distinct("token").alias("vocab_size"))
    )


def tokenizer_file(spark, folder):
    """Merges after a round trip through the text format."""
    learned = trained(spark, folder)
    path = scratch_path(spark, "tokenizer")
    tf.export_text(Tokenizer(learned.merges), spark, path)
    loaded = tf.import_text(spark, path)
    return loaded.merges_table(spark).select(
        "rank", "left", "right", F.lit(loaded.vocab_size).alias("vocab_size")
    )


# -- encode and decode ---------------------------------------------------------


def word_token_ids(spark, folder):
    return _with_ids(encode_words(wd.word_frequency(documents(spark, folder)), trained(spark, folder)))


def occurrences(spark, folder):
    docs, tokenizer = documents(spark, folder), trained(spark, folder)
    return _with_ids(occurrence_ids(wd.word_positions(docs, "doc_id"), tokenizer))


def encode_documents(spark, folder):
    ids = trained(spark, folder).encode("text")
    encoded = documents(spark, folder).select("doc_id", ids.alias("token_ids"))
    return _with_ids(encoded.withColumn("n_tokens", F.size("token_ids")))


def encode_large_vocabulary(spark, folder):
    ids = trained(spark, folder, LARGE_VOCAB_SIZE).encode_with_special("text")
    encoded = documents(spark, folder).select("doc_id", ids.alias("token_ids"))
    return _with_ids(encoded.withColumn("n_tokens", F.size("token_ids")))


def encode_prompts(spark, folder):
    ids = trained(spark, folder).encode_prompt("text")
    return table(spark, folder, "benchmark").select("item_id", _ids(ids).alias("token_ids"))


def stored_tokens(spark, folder):
    """The token table from its store: computed and written, then found and read."""
    docs, tokenizer = documents(spark, folder), trained(spark, folder)
    store = scratch_path(spark, "tokens")
    token_table(docs, tokenizer, store, "doc_id")
    return _with_ids(token_table(docs, tokenizer, store, "doc_id"))


def file_tokens(spark, folder):
    """The token store of the documents' files: filled, then found."""
    tokenizer, store = trained(spark, folder), scratch_path(spark, "token-store")
    tokens = lambda: token_store(spark, f"{folder}/documents.parquet", tokenizer, store, "doc_id")
    tokens()
    return _with_ids(tokens())


def decode_documents(spark, folder):
    text = trained(spark, folder).decode("token_ids").alias("decoded")
    return _tokens(spark, folder).select("doc_id", text)


def lossy_decode(spark, folder):
    """Every token decoded on its own with its predecessor, cutting characters apart."""
    tokenizer = trained(spark, folder)
    return (
        bt.next_token_pairs(_tokens(spark, folder))
        .groupBy("input", "target")
        .agg(F.count("*").alias("freq"))
        .withColumn("decoded", tokenizer.decode(F.array("input", "target")))
    )


def token_strings(spark, folder):
    """Tokens in use and their strings, with one id past the vocabulary per document."""
    tokenizer = trained(spark, folder)
    beyond = F.array(F.lit(len(tokenizer.tokens) + 1))
    used = (
        _tokens(spark, folder)
        .select(F.explode(F.concat("token_ids", beyond)).alias("id"))
        .groupBy("id")
        .agg(F.count("*").alias("freq"))
    )
    return used.withColumn("token", tokenizer.id_to_string("id"))


# -- samples, split, batches ---------------------------------------------------


def train_valid_split(spark, folder):
    docs = table(spark, folder, "documents").where("text is not null")
    return ordering.train_valid_split(docs, "doc_id").select("doc_id", "split")


def shuffled_order(spark, folder):
    docs = table(spark, folder, "documents").where("text is not null").select("doc_id")
    return ordering.shuffled_rank(docs, "doc_id", bt.SEED).withColumn("rn", F.col("rn").cast("bigint"))


def sample_at_index(spark, folder):
    return ordering.get_sample(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", 137)


def _training_set(spark, folder):
    store = scratch_path(spark, "training-set")
    return build_training_set(
        documents(spark, folder),
        trained(spark, folder),
        store,
        "doc_id",
        vocab_size=VOCAB_SIZE,
    )


def train_batches(spark, folder):
    rows = _training_set(spark, folder).train_batches("doc_id", 1)
    return _with_ids(rows, "input", "target")


def valid_batches(spark, folder):
    rows = _training_set(spark, folder).valid_batches("doc_id")
    return _with_ids(rows, "input", "target")


def stacked_batches(spark, folder):
    def rows_as_text(name):
        # One pass over the matrix; no id is null and no row empty.
        rows = F.to_json(name)
        inside = F.substr(rows, F.lit(3), F.length(rows) - 4)
        return F.replace(F.replace(inside, F.lit("],["), F.lit("|")), F.lit(","), F.lit(" ")).alias(name)

    stacked = bt.stacked(_training_set(spark, folder).train_windows("doc_id", 1))
    return stacked.select(
        "epoch", "batch_id", "n_rows", rows_as_text("inputs"), rows_as_text("targets")
    )


# -- scoring -------------------------------------------------------------------


def next_counts(size: int):
    def query(spark, folder):
        return _with_ids(sc.next_token_counts(_tokens(spark, folder), size), "context")

    return query


def best_next_token(spark, folder):
    return _with_ids(sc.best_next(sc.next_token_counts(_tokens(spark, folder))), "context")


def completed_prompts(spark, folder):
    completed = complete_prompts(
        table(spark, folder, "benchmark"),
        _tokens(spark, folder),
        trained(spark, folder),
        "item_id",
        max_new_tokens=COMPLETION_STEPS,
    )
    # A greedy cut may fall inside a character: compare the text by its well-formed bytes.
    new_bytes = trained(spark, folder).decode_bytes("new_ids")
    return completed.select(
        "item_id",
        "prompt",
        _ids("new_ids").alias("new_ids"),
        F.concat(tx.to_hex("prompt"), tx.to_hex(new_bytes)).alias("completion_hex"),
    )


def blank_texts_skipped(spark, folder):
    return (
        table(spark, folder, "conversations")
        .where(~tx.is_blank("text"))
        .select("conv_id", "turn", "text")
    )


def _rounded(loss: DataFrame) -> DataFrame:
    return loss.withColumns({c: F.round(c, 6) for c in ("loss_nonpad", "loss_all")})


def masked_loss(spark, folder):
    scored = table(spark, folder, "embeddings")
    return _rounded(sc.masked_loss(scored, logits="embedding", target="label"))


def loss_by_split(spark, folder):
    scored = ordering.train_valid_split(table(spark, folder, "embeddings"), "vec_id")
    return _rounded(sc.masked_loss(scored, "split", logits="embedding", target="label"))


def loss_by_epoch(spark, folder):
    scored = table(spark, folder, "embeddings").withColumn("epoch", (F.col("vec_id") % 3).cast("int"))
    return _rounded(sc.masked_loss(scored, "epoch", logits="embedding", target="label"))


def _toy_scorer(n_tokens: int):
    """A stand-in for a model: scores that a formula gives for the last id, so SQL can follow."""

    def make():
        import numpy as np

        def score(sequences):
            return sequences.map(lambda ids: (31 * np.asarray(ids)[:, None] + 17 * np.arange(n_tokens)) % 101 / 10.0)

        return score

    return make


def _prompt_tokens(spark, folder, tokenizer):
    prompts = table(spark, folder, "benchmark").where(F.col("text").isNotNull())
    return prompts.select("item_id", tokenizer.encode_with_special("text").alias("token_ids"))


def scorer_loss(spark, folder):
    """Scores of a caller's model per place, and the loss over them."""
    tokenizer = trained(spark, folder)
    scored = sc.scored_tokens(_prompt_tokens(spark, folder, tokenizer), _toy_scorer(VOCAB_SIZE), "item_id")
    return _rounded(sc.masked_loss(scored, "item_id"))


def scorer_completion(spark, folder):
    tokenizer = trained(spark, folder)
    prompts = table(spark, folder, "benchmark").where(F.col("text").isNotNull())
    open_ids = prompts.select("item_id", tokenizer.encode_prompt("text").alias("token_ids"))
    new = sc.continue_with(open_ids, _toy_scorer(VOCAB_SIZE), "item_id", max_new_tokens=COMPLETION_STEPS)
    return _with_ids(new, "new_ids")


def decode_with_unknown(spark, folder):
    """Texts whose ids hold padding, unknown ones and ids beyond the vocabulary."""
    tokenizer = trained(spark, folder)
    odd = F.array(*map(F.lit, (sy.PAD, sy.UNK, len(tokenizer.tokens), -1)))
    rows = _tokens(spark, folder).select("doc_id", F.concat("token_ids", odd).alias("token_ids"))
    return rows.select("doc_id", tokenizer.decode("token_ids").alias("decoded"))


def report_file(spark, folder):
    """A report table after a round trip through JSON."""
    path = scratch_path(spark, "report")
    report = pf.length_histogram(documents(spark, folder))
    write_report(report, path, "json")
    return spark.read.schema(report.schema).json(path)


# -- streaming -----------------------------------------------------------------


def _stream(spark, folder):
    """The documents as files that arrive in three batches, each of as many files as there are cores."""
    docs, arriving = table(spark, folder, "documents"), scratch_path(spark, "arriving")
    cores = max(1, spark.sparkContext.defaultParallelism)
    docs.repartition(3 * cores, "doc_id").write.parquet(arriving)
    return jobs.read_stream(spark, arriving, docs.schema, files_per_trigger=cores)


def _run_stream(spark, start: Callable, name: str) -> str:
    out = scratch_path(spark, name)
    start(f"{out}/out", f"{out}/progress").awaitTermination()
    return f"{out}/out"


def stream_word_frequency(spark, folder):
    stream = _stream(spark, folder)
    return jobs.word_counts(spark, _run_stream(spark, lambda o, c: jobs.stream_word_frequency(stream, o, c), "stream-words"))


def stream_profile(spark, folder):
    stream = _stream(spark, folder)
    return jobs.latest(spark, _run_stream(spark, lambda o, c: jobs.stream_profile(stream, o, c), "stream-profile"))


def stream_tokens(spark, folder):
    stream, tokenizer = _stream(spark, folder), trained(spark, folder)
    out = _run_stream(spark, lambda o, c: jobs.stream_tokens(stream, tokenizer, o, c, "doc_id"), "stream-tokens")
    return _with_ids(spark.read.parquet(out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on_documents = lambda f: lambda spark, folder: f(documents(spark, folder))
    on = lambda name, f: lambda spark, folder: f(table(spark, folder, name))
    return {
        "schema_summary": on("documents", describe_schema),
        "profile_documents": on_documents(pf.profile),
        "profile_conversations": on("conversations", pf.profile),
        "profile_pages": on("pages", pf.profile),
        "null_counts": null_counts,
        "text_measures": on_documents(lambda df: pf.text_measures(df, "doc_id")),
        "char_frequency": on_documents(lambda df: pf.char_frequency(df, "text")),
        "top_chars": on_documents(pf.top_chars),
        "char_frequency_first_rows": on_documents(
            lambda df: pf.char_frequency(df, "text", sample_rows=SAMPLE_ROWS, key="doc_id")
        ),
        "length_histogram": on_documents(pf.length_histogram),
        "sample_texts": on("documents", lambda df: pf.sample_texts(df, "doc_id")),
        "previews": on("pages", lambda df: df.select("page_id", tx.preview("html").alias("preview"))),
        "word_positions": on_documents(lambda df: wd.word_positions(df, "doc_id")),
        "word_frequency": on_documents(wd.word_frequency),
        "corpus_totals": on_documents(lambda df: wd.corpus_totals(wd.word_frequency(df))),
        "byte_symbols": byte_symbols,
        "hex_round_trip": hex_round_trip,
        "adjacent_symbols": adjacent_symbols,
        "pair_frequency": on_documents(lambda df: wd.pair_frequency(wd.word_frequency(df))),
        "best_pair": on_documents(lambda df: wd.best_pair(wd.pair_frequency(wd.word_frequency(df)))),
        "first_merge": first_merge,
        "train_merges": train_merges,
        "train_more_merges": train_more_merges,
        "train_from_chunks": train_from_chunks,
        "merge_progress": lambda spark, folder: trained(spark, folder).progress(spark, 8),
        "vocabulary": vocabulary,
        "vocabulary_size": vocabulary_size,
        "tokenizer_file": tokenizer_file,
        "word_token_ids": word_token_ids,
        "occurrence_ids": occurrences,
        "encode_documents": encode_documents,
        "encode_large_vocabulary": encode_large_vocabulary,
        "encode_prompts": encode_prompts,
        "token_rows": lambda spark, folder: _with_ids(_tokens(spark, folder)),
        "token_table": stored_tokens,
        "token_store": file_tokens,
        "decode_documents": decode_documents,
        "lossy_decode": lossy_decode,
        "round_trip": lambda spark, folder: _with_ids(
            round_trip(table(spark, folder, "benchmark"), trained(spark, folder), "item_id")
        ),
        "token_strings": token_strings,
        "shuffled_order": shuffled_order,
        "train_valid_split": train_valid_split,
        "sample_at_index": sample_at_index,
        "sample_index": on("documents", lambda df: ordering.key_rank(df.select("doc_id"), "doc_id")),
        "train_batches": train_batches,
        "valid_batches": valid_batches,
        "stacked_batches": stacked_batches,
        "next_token_pairs": lambda spark, folder: bt.next_token_pairs(_tokens(spark, folder), "doc_id"),
        "next_token_counts": next_counts(1),
        "next_token_counts_2": next_counts(2),
        "best_next_token": best_next_token,
        "complete_prompts": completed_prompts,
        "blank_texts_skipped": blank_texts_skipped,
        "masked_loss": masked_loss,
        "loss_by_split": loss_by_split,
        "loss_by_epoch": loss_by_epoch,
        "scorer_loss": scorer_loss,
        "scorer_completion": scorer_completion,
        "decode_with_unknown": decode_with_unknown,
        "report_file": report_file,
        "stream_word_frequency": stream_word_frequency,
        "stream_profile": stream_profile,
        "stream_tokens": stream_tokens,
    }
