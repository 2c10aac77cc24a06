import brute
import pytest

from glyphmill.operators.tokenizer import Tokenizer
from glyphmill.streaming import jobs

FIRST = [(1, "a b a"), (2, None), (3, "")]
LATER = [(4, "b c"), (5, "x" * 120)]


def add(spark, rows, path):
    spark.createDataFrame(rows, "id int, text string").write.mode("append").parquet(path)


def test_word_counts_and_profile_grow_with_arriving_files(spark, tmp_path):
    source = str(tmp_path / "in")
    seen = []
    for rows in (FIRST, LATER):
        add(spark, rows, source)
        seen += rows
        stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 1)
        run = {"words": jobs.stream_word_frequency, "profile": jobs.stream_profile}
        for name, start in run.items():
            start(stream, str(tmp_path / name), str(tmp_path / f"{name}-progress")).awaitTermination()
        texts = [t for _, t in seen]
        counted = jobs.word_counts(spark, str(tmp_path / "words")).collect()
        assert {r.word: r.freq for r in counted} == brute.word_counts(texts)
        row = jobs.latest(spark, str(tmp_path / "profile")).first()
        lengths = [len(t) for t in texts if t is not None]
        assert (row.n_rows, row.nulls) == (len(texts), 1)
        assert (row.chars_min, row.chars_max) == (min(lengths), max(lengths))
        assert row.chars_mean == pytest.approx(sum(lengths) / len(lengths))
        assert row.chars_from_100 == sum(length >= 100 for length in lengths)


def test_tokens_are_appended_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    tokenizer = Tokenizer(((b"a", b"b"),), 261)
    for rows in (FIRST, LATER):
        add(spark, rows, source)
        stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 1)
        jobs.stream_tokens(stream, tokenizer, out, str(tmp_path / "progress"), "id").awaitTermination()
    got = {r.id: r.token_ids for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == len(got)
    assert got == {
        i: [2, *brute.encode(tokenizer.merges, t), 3] for i, t in FIRST + LATER if t is not None
    }


def test_the_log_of_word_counts_is_folded(spark, tmp_path):
    """Batches write their own words only; folds replace the log, and a batch that runs again changes nothing."""
    source, out = str(tmp_path / "in"), tmp_path / "out"
    seen = []
    for i in range(7):
        rows = [(i, f"w{i} a b{i % 2}"), (100 + i, None)]
        add(spark, rows, source)
        seen += [t for _, t in rows]
        stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 100)
        jobs.stream_word_frequency(stream, str(out), str(tmp_path / "progress"), folded_batches=2).awaitTermination()
        assert {r.word: r.freq for r in jobs.word_counts(spark, str(out)).collect()} == brute.word_counts(seen)
        assert spark.read.parquet(str(out / "log" / f"batch={i}")).count() == 3
    assert (out / "folded-5").exists() and not (out / "folded-1").exists() and not (out / "log" / "batch=1").exists()
    # The commit of the last batch is lost: it runs again, over its own rows.
    for kind in ("commits",):
        for path in (tmp_path / "progress" / kind).glob("*6*"):
            path.unlink()
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 100)
    jobs.stream_word_frequency(stream, str(out), str(tmp_path / "progress"), folded_batches=2).awaitTermination()
    assert {r.word: r.freq for r in jobs.word_counts(spark, str(out)).collect()} == brute.word_counts(seen)
