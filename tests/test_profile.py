import pytest
from pyspark.sql import functions as F

from glyphmill.operators import profile as pf
from glyphmill.plans.corpus import profile_corpus
from glyphmill.sources import corpus, report

EDGES = [0, 99, 100, 499, 500, 999, 1000, 4999, 5000, 9999, 10000, 49999, 50000]


@pytest.fixture(scope="module")
def df(spark):
    texts = [None, "", "  ", *["x" * n for n in EDGES if n], "a b  c"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def metrics(df, column="text"):
    return {r.metric: r.value for r in pf.profile(df).where(F.col("column") == column).collect()}


def test_profile(df):
    m = metrics(df)
    lengths = sorted([0, 2, *[n for n in EDGES if n], 6])
    assert m["rows"] == len(lengths) + 1 and m["nulls"] == 1 and m["n"] == len(lengths)
    assert m["null_pct"] == pytest.approx(100 / (len(lengths) + 1))
    assert (m["chars_min"], m["chars_max"]) == (0, 50000)
    assert m["chars_mean"] == pytest.approx(sum(lengths) / len(lengths))
    assert m["chars_median"] == lengths[len(lengths) // 2]
    assert m["words_max"] == 3 and m["words_min"] == 0
    assert m["graphemes_mean"] == m["chars_mean"]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_median_is_the_upper_one(spark, n):
    df = spark.createDataFrame([("y" * i,) for i in range(n)], "text string")
    assert metrics(df)["chars_median"] == list(range(n))[n // 2]


def test_profile_of_an_empty_table(spark):
    m = metrics(spark.createDataFrame([], "text string"))
    assert m["rows"] == 0 and m["null_pct"] is None and m["chars_median"] is None


def test_histogram_is_half_open_and_keeps_empty_buckets(spark, df):
    rows = pf.length_histogram(df).orderBy("lo").collect()
    assert [r.lo for r in rows] == [0, 100, 500, 1000, 5000, 10000, 50000]
    assert [r.n for r in rows] == [4, 2, 2, 2, 2, 2, 1]
    assert sum(r.pct for r in rows) == pytest.approx(100)
    one = pf.length_histogram(spark.createDataFrame([("abc",)], "text string")).collect()
    assert len(one) == 7 and sum(r.n for r in one) == 1


def test_char_frequency_ranks_ties_by_character(spark):
    df = spark.createDataFrame([(1, "bba a"), (2, "zzzz")], "id int, text string")
    rows = pf.char_frequency(df).orderBy("rank").collect()
    assert [(r.char, r.freq) for r in rows] == [("z", 4), ("a", 2), ("b", 2), (" ", 1)]
    first = pf.char_frequency(df, sample_rows=1, key="id").collect()
    assert {r.char for r in first} == {"a", "b", " "}
    top = pf.top_chars(df, k=1).collect()
    assert [(r.char, r.label) for r in top] == [("z", "z")]


def test_samples_skip_nulls_and_follow_the_key(df):
    rows = pf.sample_texts(df, "id").orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3]


def test_columns_are_found_by_type_and_checked_by_name(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, x double")
    assert corpus.text_columns(df) == ["name"]
    with pytest.raises(Exception, match="missing"):
        corpus.texts(df, "missing")
    with pytest.raises(TypeError, match="not string"):
        corpus.texts(df, "x")
    rows = corpus.describe_schema(df).collect()
    assert [(r.ordinal, r.name, r.type, r.n_rows) for r in rows] == [
        (0, "id", "int", 1),
        (1, "name", "string", 1),
        (2, "x", "double", 1),
    ]


def test_report_files_and_progress(spark, df, tmp_path):
    from pyspark.sql import Observation

    tables = profile_corpus(df, "id", str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(tables)
    report.write_report(tables["nulls"], str(tmp_path / "json"), "json")
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    seen = Observation("rows")
    report.with_progress(df, seen, longest=F.max(F.length("text"))).write.format("noop").mode(
        "overwrite"
    ).save()
    assert seen.get == {"rows": df.count(), "longest": 50000}
