import datetime
import hashlib
import math
from pathlib import Path

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from glyphmill.operators import batches as bt, ordering, scoring as sc
from glyphmill.operators.tokenizer import Tokenizer, token_rows
from glyphmill.plans.corpus import build_training_set, complete_prompts
from glyphmill.session import scratch_path
from glyphmill.sources import token_table as tt

N = 101


@pytest.fixture(scope="module")
def tokens(spark):
    rows = [(i, [2, *range(10, 10 + i % 7), 3]) for i in range(N)]
    return spark.createDataFrame(rows, "doc_id long, token_ids array<int>")


def shuffled(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("partitions", [1, 7])
def test_shuffle_is_exact_and_independent_of_partitioning(tokens, partitions):
    ranked = ordering.shuffled_rank(tokens.repartition(partitions), "doc_id", 42)
    rows = ranked.orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(1, N + 1))
    assert [r.doc_id for r in rows] == shuffled(range(N), 42)


def test_key_rank(spark):
    keys = [5, -3, 2**40, 7, 0, 10**15, 9]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = ordering.key_rank(df, "k").orderBy("rn").collect()
    assert [(r.rn, r.k) for r in rows] == list(enumerate(sorted(keys), 1))
    assert ordering.get_sample(df, "k", 2).first().k == sorted(keys)[2]
    assert ordering.get_sample(df, "k", 7).count() == 0


@pytest.mark.parametrize("ratio", [0.0, 0.29, 0.9, 1.0])
def test_split_has_the_exact_size_and_follows_the_shuffle(tokens, ratio):
    rows = ordering.train_valid_split(tokens, "doc_id", ratio).collect()
    train = {r.doc_id for r in rows if r.split == "train"}
    assert len(rows) == N and train == set(shuffled(range(N), 42)[: math.floor(N * ratio)])


def cut(ids, width):
    """Windows of a text: every token and its successor in exactly one."""
    return [ids[a : a + width + 1] for a in range(0, max(len(ids) - 1, 1), width)]


@pytest.mark.parametrize("width", [2, 5])
def test_batches_hold_every_pair_once(tokens, width):
    rows = bt.batches(tokens, "doc_id", 3, batch_size=4, max_seq_len=width).collect()
    texts = {i: [2, *range(10, 10 + i % 7), 3] for i in range(N)}
    keys = [f"{i}:{w}" for i, ids in texts.items() for w in range(len(cut(ids, width)))]
    order = shuffled(keys, "42:3")
    assert len(rows) == len(keys) and max(r.batch_id for r in rows) == (len(keys) - 1) // 4
    for r in rows:
        assert order[r.batch_id * 4 + r.row_in_batch] == f"{r.doc_id}:{r.window_no}" and r.epoch == 3
        full = (cut(texts[r.doc_id], width)[r.window_no] + [0] * (width + 1))[: width + 1]
        assert (r.input, r.target) == (full[:-1], full[1:])
    assert sum(t != 0 for r in rows for t in r.target) == sum(len(t) - 1 for t in texts.values())
    stacked = bt.stacked(bt.batch_windows(tokens, "doc_id", 3, 4, width), width).collect()
    by_batch = {}
    for r in sorted(rows, key=lambda r: (r.batch_id, r.row_in_batch)):
        by_batch.setdefault(r.batch_id, []).append((r.input, r.target))
    assert {r.batch_id: list(zip(r.inputs, r.targets)) for r in stacked} == by_batch
    first = bt.batches(tokens, "doc_id", 3, max_seq_len=width, truncate=True).collect()
    assert len(first) == N and {r.window_no for r in first} == {0}


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, [2, 5, 3]), (4, [2, 3]), (1, [2, 6, 3])], "k long, token_ids array<int>")
    assert ordering.shuffled_rank(df, "k", 42).count() == 3
    assert [r.k for r in ordering.key_rank(df, "k").orderBy("rn").collect()] == [1, 4, None]
    assert ordering.get_sample(df, "k", 2).first().k is None
    assert sorted(r.split for r in ordering.train_valid_split(df, "k", 0.5).collect()) == ["train", "valid", "valid"]
    assert bt.batches(df, "k", 1, max_seq_len=4).count() == 3


@pytest.fixture
def many_parts(spark):
    """Sorted rows stay in as many parts as they were dealt to."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_parts(tokens, many_parts):
    rows = ordering.key_rank(tokens, "doc_id").collect()
    assert all(r.rn == r.doc_id + 1 for r in rows) and len(rows) == N
    assert ordering._Sorted(tokens, ["doc_id"]).offsets.count() > 2
    for i in (0, 50, N - 1):
        assert ordering.get_sample(tokens, "doc_id", i).first().doc_id == i


def test_keys_of_any_type_and_clashing_names(spark, many_parts):
    texts = ["b", "", "aa", "Z", "\u00e9", None, "ab"]
    rows = [(t, None if t is None else datetime.date(2020, 1, 1 + i), i, i, i, i, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k string, day date, bucket int, offset int, part int, hash int, n int").repartition(3)
    for key in ("k", "day"):
        known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0].encode() if key == "k" else r[1])
        want = [r[2] for r in known] + [5]
        ranked = ordering.key_rank(df, key)
        assert ranked.columns == [*df.columns, "rn"]
        assert [r.bucket for r in sorted(ranked.collect(), key=lambda r: r.rn)] == want
        assert [ordering.get_sample(df, key, i).first().offset for i in range(7)] == want
        assert ordering.get_sample(df, key, 7).count() == ordering.get_sample(df, key, -1).count() == 0
    shuffled = sorted(ordering.shuffled_rank(df, "k", 1).collect(), key=lambda r: r.rn)
    hashes = [hashlib.md5(f"1:{r.k or ''}".encode()).hexdigest() for r in shuffled]
    assert len(hashes) == 7 and hashes == sorted(hashes) and [r.rn for r in shuffled] == list(range(1, 8))
    for ratio in (0.0, 0.2, 0.5, 0.9, 1.0):
        split = ordering.train_valid_split(df.where("k is null or k <> ''"), "k", ratio).collect()
        assert sum(r.split == "train" for r in split) == math.floor(6 * ratio)
    empty = df.where("false")
    assert ordering.key_rank(empty, "k").count() == ordering.train_valid_split(empty, "k").count() == 0


def test_split_takes_few_counts(spark):
    """Many rows: the smallest hashes are the training rows, whatever the number of passes."""
    ids = [r.id for r in ordering.train_valid_split(spark.range(3000), "id", 0.37).where("split = 'train'").collect()]
    by_hash = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(ids) == sorted(by_hash[:1110])


def test_next_token_pairs_leave_out_padding(tokens):
    rows = bt.next_token_pairs(tokens, "doc_id", max_seq_len=3).collect()
    for r in rows:
        ids = [2, *range(10, 10 + r.doc_id % 7), 3]
        assert [r.input, r.target] == ids[r.pos : r.pos + 2] and r.pos < 3
    assert len(rows) == sum(min(3, i % 7 + 1) for i in range(N))


def greedy(samples, prompt, size, steps):
    counts = {}
    for ids in samples:
        for i in range(len(ids) - size):
            seen = counts.setdefault(tuple(ids[i : i + size]), {})
            seen[ids[i + size]] = seen.get(ids[i + size], 0) + 1
    ids, out = list(prompt), []
    for _ in range(steps):
        seen = counts.get(tuple(ids[-size:])) if len(ids) >= size else None
        if not seen:
            break
        out.append(min(seen, key=lambda t: (-seen[t], t)))
        ids.append(out[-1])
    return out


@pytest.mark.parametrize("size, steps", [(1, 13), (2, 6)])
def test_completion_equals_step_by_step(spark, size, steps):
    texts = ["abc abd abc", "cab", "bca bd", "abcd abce"]
    prompts = ["ab", "  ", " zq\u3000", "c", None]
    tokenizer = Tokenizer(((b"a", b"b"),), 261)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    asked = spark.createDataFrame(list(enumerate(prompts)), "id int, text string")
    got = complete_prompts(
        asked,
        token_rows(df, tokenizer, "id"),
        tokenizer,
        "id",
        context_size=size,
        max_new_tokens=steps,
    ).collect()
    assert sorted(r.id for r in got) == [0, 2, 3]
    samples = [[2, *brute.encode(tokenizer.merges, t), 3] for t in texts]
    for r in got:
        prompt = [2, *brute.encode(tokenizer.merges, r.prompt)]
        assert r.new_ids == greedy(samples, prompt, size, steps)
        assert r.completion == r.prompt + brute.decode(tokenizer.merges, r.new_ids)


def test_masked_loss(spark):
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(40, 6)) * 30
    targets = rng.integers(0, 6, 40)
    rows = [("a" if i % 3 else "b", logits[i].tolist(), int(targets[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "split string, logits array<double>, target int")
    top = logits.max(1)
    terms = np.log(np.exp(logits - top[:, None]).sum(1)) + top - logits[range(40), targets]
    keep = targets != 0
    total = sc.masked_loss(df).first()
    assert (total.n_all, total.n_nonpad) == (40, keep.sum())
    assert total.loss_nonpad == pytest.approx(terms[keep].mean(), abs=1e-9)
    assert total.loss_all == pytest.approx(terms[keep].sum() / 40, abs=1e-9)
    assert sc.masked_loss(df, "split").count() == 2
    only_pad = sc.masked_loss(df.where("target = 0")).first()
    assert only_pad.loss_nonpad is None and only_pad.loss_all == 0


def test_a_target_without_a_score_is_an_error(spark):
    df = spark.createDataFrame([([0.1, 0.2], 1), ([0.1, 0.2], 7)], "logits array<double>, target int")
    with pytest.raises(Exception, match="target outside the logits: 7"):
        sc.masked_loss(df).collect()


def test_scores_per_place_and_greedy_completion(tokens):
    def echo_scorer():
        """Prefers the id after the last one; equal scores for two ids."""
        import pandas as pd

        return lambda sequences: pd.Series(
            [[[1.0 if j in (i + 1, i + 2) else 0.0 for j in range(20)] for i in ids] for ids in sequences]
        )

    few = tokens.where("doc_id < 7")
    rows = sc.scored_tokens(few, echo_scorer, "doc_id").collect()
    for r in rows:
        ids = [2, *range(10, 10 + r.doc_id % 7), 3]
        assert r.target == ids[r.pos + 1]
        scores = np.array(echo_scorer()(pd.Series([ids[:-1]]))[0][r.pos], float)
        assert np.isclose(r.lse, np.log(np.exp(scores).sum())) and r.score == scores[r.target]
    assert len(rows) == sum(i + 1 for i in range(7))
    assert sc.masked_loss(sc.scored_tokens(few, echo_scorer, "doc_id")).first().n_all == len(rows)
    open_ids = few.selectExpr("doc_id", "array(5, 6) as token_ids").unionByName(few.selectExpr("doc_id + 100", "array(2)").toDF("doc_id", "token_ids"))
    new = {r.doc_id: r.new_ids for r in sc.continue_with(open_ids, echo_scorer, "doc_id", max_new_tokens=3).collect()}
    assert new[0] == [7, 8, 9] and new[100] == [3, 4, 5]
    stopped = sc.continue_with(open_ids, echo_scorer, "doc_id", max_new_tokens=3, stop_at_end=True)
    assert {r.doc_id: r.new_ids for r in stopped.collect()}[100] == []


def test_scores_in_blocks_of_the_vocabulary(tokens):
    """A model may hand out its scores block by block; no row grows with the vocabulary."""

    def make_scorer(width=7):
        def blocks(ids, width):
            whole = np.random.default_rng(len(ids)).standard_normal((len(ids), 40)) * 30
            yield from (whole[:, i : i + width] for i in range(0, 40, width))

        return lambda sequences: [blocks(ids, width) for ids in sequences]

    few = tokens.where("doc_id < 20")
    got = sc.scored_tokens(few, make_scorer, "doc_id")
    assert got.columns == ["doc_id", "pos", "lse", "score", "target"]
    rows = {(r.doc_id, r.pos): r for r in got.collect()}
    want = {(r.doc_id, r.pos): r for r in sc.scored_tokens(few, lambda: make_scorer(40), "doc_id").collect()}
    assert rows.keys() == want.keys() and len(rows) > 20
    for k, r in rows.items():
        assert np.isclose(r.lse, want[k].lse) and r.score == want[k].score
    lse, own = sc.log_sum_exp([[[-np.inf, 1.0]], [[]], [[2.0]]], np.array([5]))
    assert np.isclose(lse[0], np.log(np.exp(1) + np.exp(2))) and np.isnan(own[0])


def test_scoring_with_a_callers_model(tokens):
    def make_scorer():
        return lambda sequences: pd.Series([[float(len(s)), 1.0] for s in sequences])

    rows = sc.score_with(tokens, make_scorer, "doc_id").collect()
    assert len(rows) == N and all(r.logits == [len(r.token_ids), 1.0] for r in rows)


def test_token_store_encodes_new_files_only(spark, tmp_path):
    path, store = tmp_path / "some docs", tmp_path / "store"
    tokenizer = Tokenizer(((b"a", b"b"),), 261)

    def add(rows, name):
        part = spark.createDataFrame(rows, "id int, text string").coalesce(1)
        part.write.parquet(str(tmp_path / f"one-{name}"))
        path.mkdir(exist_ok=True)
        next((tmp_path / f"one-{name}").glob("*.parquet")).rename(path / f"{name}.parquet")

    def tokens():
        rows = tt.token_store(spark, str(path), tokenizer, str(store), "id").collect()
        assert len({r.id for r in rows}) == len(rows)
        return {r.id: r.token_ids for r in rows}

    def files():
        return {p: p.stat().st_mtime_ns for p in store.rglob("part=*/*.parquet")}

    add([(1, "ab a"), (2, None), (3, "")], "first")
    add([(9, None)], "none")
    want = {1: [2, 260, 36, 101, 3], 3: [2, 3]}
    assert tokens() == want
    first = files()
    assert tokens() == want and files() == first
    add([(4, "b")], "second")
    assert tokens() == want | {4: [2, 102, 3]}
    assert first.items() <= files().items() and len(files()) == len(first) + 1
    # A changed file is another part; a file that has gone is not returned.
    (path / "first.parquet").unlink()
    add([(1, "b a")], "third")
    assert tokens() == {1: [2, 102, 36, 101, 3], 4: [2, 102, 3]}
    # A part the manifest does not list is written again, not added to.
    for manifest in store.rglob("manifest/*.parquet"):
        manifest.unlink()
    assert tokens() == {1: [2, 102, 36, 101, 3], 4: [2, 102, 3]}


def test_token_table_is_stored_once_per_tokenizer_and_source(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "corpus")
    spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id int, text string").write.parquet(path)
    df, store = spark.read.parquet(path), tmp_path / "store"
    first, second = Tokenizer((), 260), Tokenizer(((b"a", b"b"),), 261)
    rows = tt.token_table(df, first, str(store), "id").collect()
    assert {r.id: r.token_ids for r in rows} == {1: [2, 101, 36, 102, 3], 3: [2, 3]}

    def files():
        return {p: p.stat().st_mtime_ns for p in Path(store).rglob("*.parquet")}

    written = files()
    assert tt.token_table(df, first, str(store), "id").count() == 2 and files() == written
    tt.token_table(df, second, str(store), "id")
    assert len(files()) > len(written)
    # A table cut short is not used: the manifest's row count tells.
    damaged = next(p for p in written if p.parent.name == "tokens" and p.stat().st_size)
    for p in written:
        if p.parent == damaged.parent:
            p.write_bytes(b"broken")
    again = tt.token_table(spark.read.parquet(path), first, str(store), "id")
    assert {r.id for r in again.collect()} == {1, 3}
    in_memory = spark.createDataFrame([(1, "x")], "id int, text string")
    assert tt.source_fingerprint(in_memory) == tt.source_fingerprint(in_memory.repartition(3))
    assert tt.source_fingerprint(in_memory) != tt.source_fingerprint(in_memory.union(in_memory))


def test_token_table_follows_what_is_encoded(spark, tmp_path):
    path = str(tmp_path / "corpus")
    spark.createDataFrame([(i, f"text {i}") for i in range(10)], "id int, text string").write.parquet(path)
    df, store, tokenizer = spark.read.parquet(path), str(tmp_path / "store"), Tokenizer(())
    inputs = [df, df.withColumn("text", F.upper("text")), df.where("id < 4"), df.where("id >= 6")]
    for given in inputs:
        got = {r.id: r.token_ids for r in tt.token_table(given, tokenizer, store, "id").collect()}
        assert got == {r.id: [2, *brute.encode((), r.text), 3] for r in given.collect()}


def test_training_set(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id int, text string")
    built = build_training_set(df, Tokenizer(()), str(tmp_path), "id", vocab_size=260)
    assert (built.tokens.count(), built.train.count(), built.valid.count()) == (20, 18, 2)
    assert built.train_batches("id", 1, batch_size=5, max_seq_len=8).count() == 18
    assert built.valid_batches("id").where(F.col("epoch").isNull()).count() == 2
    with pytest.raises(ValueError, match="expected 10000"):
        build_training_set(df, Tokenizer(()), str(tmp_path), "id", vocab_size=10000)


class _Session:
    def __init__(self, **conf):
        self.settings = {key.replace("_", "."): value for key, value in conf.items()}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_scratch_folder_is_the_shared_one():
    given = _Session(spark_checkpoint_dir="/shared/place/", spark_master="yarn")
    assert scratch_path(given, "x").startswith("/shared/place/x-")
    assert scratch_path(given, "x") != scratch_path(given, "x")
    assert "x-" in scratch_path(_Session(spark_master="local[2]"), "x")
    for master in ("yarn", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(_Session(spark_master=master), "x")
