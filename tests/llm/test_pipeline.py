"""The pipeline on a small table with every kind of odd row, stage by stage."""

import random

import corpus_pipeline
from glyphmill.llm import bpe, quality
from glyphmill.llm.plan import stored


def table():
    rng = random.Random(9)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 150))), "en", f"s{i % 4}", 0))
    rows += [(100 + i, rows[i][1], "en", "s1", 0) for i in range(5)]
    rows += [(200 + i, rows[i][1] + " tail", "en", None, 0) for i in range(5)]
    rows += [(300, rows[9][1] + " me@example.com", None, "s2", 0), rows[7], (400, None, "en", "s1", None), (401, "", "en", "s1", 0)]
    rows += [(402, "too short", "en", "s1", 9), (None, " ".join(f"n{k}" for k in range(80)), "en", "s0", 0)]
    return rows


def test_stages(spark):
    docs = spark.createDataFrame(table(), "doc_id long, text string, lang string, source string, n_chars long")
    frames = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, "unused"), name)
        frames[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.simpleString() == frames["documents"].schema.simpleString()
    kept = {r.doc_id for r in frames["quality_rules"].collect()}
    assert kept >= set(range(60)) | {None} and not kept & {400, 401, 402}
    single = [r.doc_id for r in frames["near_duplicates"].collect()]
    assert len(single) == len(set(single)) and set(single) == set(range(60)) | {None}
    assert {r.doc_id for r in frames["personal_data"].collect()} == set(single)
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    before, after = words(frames["personal_data"].collect()), words(frames["mix_sources"].collect())
    assert abs(before - after) < 0.2 * before
    encoder = bpe.Encoder(bpe.default_vocabulary())
    for r in frames["encode"].collect():
        assert r.token_ids == list(memoryview(encoder.encode(r.text)).cast("I"))


def test_personal_data_is_generalised_where_it_stays(spark):
    text = " ".join(f"u{k}" for k in range(60)) + " me@example.com"
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    row = dict(corpus_pipeline.STAGES)["personal_data"](spark, docs, "unused").first()
    assert row.text == text.replace("me@example.com", "<email>") and row.n_chars == len(row.text)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "unused")
        assert empty.count() == 0


def test_quality_keeps_every_copy_for_the_next_stage(spark):
    docs = spark.createDataFrame(table(), "doc_id long, text string, lang string, source string, n_chars long")
    assert {100, 101, 200} <= {r.doc_id for r in quality.kept_documents(docs).collect()}
