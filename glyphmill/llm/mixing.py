"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should appear ``x = target / source size`` times. The whole part
is certain; the fraction is a probability. Pairs of documents of one source pass probability
to each other, measured in words, until one of the two is decided; the words expected of the
pair never change. Small groups do this side by side, and the one document that each group
leaves undecided goes into a group of the next level, so a tree of groups ends with one
document per source. That one is rounded: what is taken misses the target by at most half of
that document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from glyphmill.llm.plan import let, small_side, stored, text_key, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often.
MAX_COPIES = 3.0
#: Documents that decide among themselves in one step, on average.
GROUP = 32
SEED = 17
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: float = MAX_COPIES) -> DataFrame:
    """``(source, n_docs, source_size, target, x)`` from rows ``(source, size, m)``, written.

    Sources in code point order, null last, get the weights in turn. A target stops at
    ``max_copies`` times its source; the rest is shared by weight among the others. In the order of
    cap per weight, a source is capped if its share of what the capped ones before it leave is
    not below its cap, so running sums over the table of sources find the split.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("m").alias("n_docs"), F.sum(F.col("size") * F.col("m")).alias("source_size")
    )
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(in_order)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = totals.select(
        "*", place.alias("rank"), weight.alias("weight"), (F.col("source_size") * max_copies).alias("cap")
    )
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    shares = caps.select(
        "*",
        F.sum("source_size").over(every).alias("all_words"),
        F.sum("weight").over(every).alias("all_weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
    ).withColumn(
        "capped",
        F.col("cap") / F.col("weight")
        <= (F.col("all_words") - F.col("cap_before")) / (F.col("all_weights") - F.col("weight_before")),
    )
    done = shares.select(
        "*",
        F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every).alias("cap_sum"),
        F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0.0)).over(every).alias("weight_sum"),
    )
    open_share = (F.col("all_words") - F.col("cap_sum")) / (F.col("all_weights") - F.col("weight_sum"))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * open_share)
    x = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(1.0)
    return stored(
        done.select("source", "rank", "n_docs", "source_size", target.alias("target"), x.alias("x")), "targets"
    )


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that is fixed by the columns."""
    bits = F.xxhash64(F.lit(SEED), *columns).bitwiseAND(F.lit((1 << 52) - 1))
    return bits.cast("double") / float(1 << 52)


def _decide(items: Column, level: int) -> Column:
    """One pass over a group: an array of its items, each with its last probability.

    ``now`` is the document in hand; each step settles it or the next one.
    """
    item = "struct<h:bigint,size:bigint,p:double,k1:bigint,k2:bigint,copy_no:int>"

    def step(state, new):
        a, b = state["now"], new
        up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])  # words a can take from b
        down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
        rise = _uniform(a["h"], b["h"], F.lit(level)) * (up + down) < down

        def moved(words):
            pa = a["p"] + words / a["size"]
            pb = b["p"] - words / b["size"]

            def clean(p):
                return F.when(p < _EPS, 0.0).when(p > 1 - _EPS, 1.0).otherwise(p)

            return let(
                F.struct(a.withField("p", clean(pa)).alias("a"), b.withField("p", clean(pb)).alias("b")),
                lambda two: F.when(
                    two["a"]["p"].isin(0.0, 1.0),
                    F.struct(two["b"].alias("now"), F.concat(state["done"], F.array(two["a"])).alias("done")),
                ).otherwise(
                    F.struct(two["a"].alias("now"), F.concat(state["done"], F.array(two["b"])).alias("done"))
                ),
            )

        return let(F.when(rise, up).otherwise(-down), moved)

    start = F.struct(F.element_at(items, 1).alias("now"), F.slice(items, 1, 0).cast(f"array<{item}>").alias("done"))
    rest = F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))
    return F.aggregate(rest, start, step, lambda s: F.concat(s["done"], F.array(s["now"])))


def copies(rows: DataFrame, targets: DataFrame, group: int = GROUP) -> DataFrame:
    """``(source, k1, k2, size, copy_no, copies)``: a row per row of the input.

    ``rows`` has ``(source, k1, k2, size, m)``: documents by a 128-bit key, ``m`` equal rows.
    The outcome depends on the documents alone, not on how they are partitioned.
    """
    side = small_side(targets)
    base = F.floor(F.col("x") + _EPS)
    numbered = rows.join(side, rows["source"].eqNullSafe(side["source"])).select(
        rows["source"],
        F.col("rank").alias("rank"),
        "n_docs",
        "size",
        "k1",
        "k2",
        F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("copy_no"),
        base.cast("int").alias("base"),
        F.greatest(F.col("x") - base, F.lit(0.0)).alias("p"),
    )
    h = F.xxhash64(F.lit(SEED), "rank", "k1", "k2", "copy_no")
    first = stored(numbered.withColumn("h", h), "mix-rows")
    settled = ["source", "k1", "k2", "size", "copy_no", "base"]
    certain = F.when((F.col("p") < _EPS) | (F.col("size") == 0), F.lit(0)).cast("int")
    decided = [
        first.where(certain.isNotNull()).select(*settled, certain.alias("up")),
    ]
    waiting = first.where(certain.isNull()).select("rank", "n_docs", "h", "size", "p", "k1", "k2", "copy_no")
    levels, left = [], max((r[0] or 0 for r in targets.agg(F.max("n_docs")).collect()), default=0)
    level = 0
    while True:
        buckets = F.greatest(F.ceil(F.col("n_docs") / float(group ** (level + 1))), F.lit(1))
        bucket = F.pmod(F.xxhash64("h", F.lit(level)), buckets)
        item = F.struct("h", "size", "p", "k1", "k2", "copy_no")
        out = (
            waiting.groupBy("rank", "n_docs", bucket.alias("bucket"))
            .agg(F.array_sort(F.collect_list(item)).alias("items"))
            .select("rank", "n_docs", F.explode(_decide(F.col("items"), level)).alias("i"))
            .select("rank", "n_docs", "i.*")
        )
        out = stored(out, f"mix-level{level}")
        last = left <= group ** (level + 1)
        p = F.col("p")
        if last:
            levels.append(out.withColumn("p", (p >= 0.5).cast("double")))
            break
        levels.append(out.where(p.isin(0.0, 1.0)))
        waiting = out.where(~p.isin(0.0, 1.0))
        level += 1
    ups = levels[0]
    for more in levels[1:]:
        ups = ups.unionByName(more)
    ups = ups.select("rank", "k1", "k2", "copy_no", "size", p.cast("int").alias("up"))
    by_rank = small_side(targets.select("source", "rank", F.floor(F.col("x") + _EPS).cast("int").alias("base")))
    decided.append(ups.join(by_rank, "rank").select(*settled, "up"))
    every = decided[0].unionByName(decided[1])
    return every.withColumn("copies", F.col("base") + F.col("up")).drop("base", "up")


def _sizes(docs: DataFrame, text: str, source: str, *more: Column) -> DataFrame:
    """Documents as ``(source, k1, k2, size, m)`` and the columns of ``more``; equal rows meet."""
    return (
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *more)
        .groupBy("source", "size", "k1", "k2")
        .agg(F.count("*").alias("m"))
    )


def _keys(key: str, text: str) -> list[Column]:
    """A document's key: its id and text, 128 bits; null ids are equal."""
    k1, k2 = text_key(F.col(text))
    return [F.xxhash64(F.lit(1), F.col(key), k1).alias("k1"), F.xxhash64(F.lit(2), F.col(key), k2).alias("k2")]


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(key, source, size, source_size, target, copies, taken)`` per row of ``docs``.

    A null text has no words, a null source is one source after all others. Equal rows each
    get a row. Sources without words are taken once, which adds none. An empty table gives none.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), *_keys(key, text), word_count(F.col(text)).alias("size"))
    seen = stored(
        rows.groupBy("key", "source", "size", "k1", "k2").agg(F.count("*").alias("m")), "mix-documents"
    )
    targets = source_targets(seen.select("source", "size", "m"))
    names = small_side(targets.select("source", "source_size", "target"))
    taken = copies(seen.select("source", "k1", "k2", "size", "m"), targets).alias("t")
    by_key = seen.select("key", "source", "k1", "k2").alias("d")
    on = F.expr("d.k1 = t.k1 and d.k2 = t.k2 and d.source <=> t.source")
    out = by_key.join(taken, on).select("key", "d.source", "size", "copies")
    return out.join(names, out["source"].eqNullSafe(names["source"])).select(
        F.col("key").alias(key),
        out["source"].alias("source"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(source).alias("source"), *_keys(key, text))
    seen = stored(_sizes(docs, text, source, *_keys(key, text)), "mix-documents")
    targets = source_targets(seen.select("source", "size", "m"))
    taken = (
        copies(seen, targets)
        .groupBy("source", "k1", "k2")
        .agg(F.min("copies").alias("least"), F.sum("copies").alias("total"), F.count("*").alias("m"))
        .where("total > 0")
        .alias("t")
    )
    # Equal rows share their copies: the first ``total - m * least`` of them get one more.
    r = rows.alias("r")
    on = F.expr("r.k1 = t.k1 and r.k2 = t.k2 and r.source <=> t.source")
    met = r.join(taken, on)
    nth = Window.partitionBy("r.k1", "r.k2", "r.source").orderBy(F.lit(0))
    times = F.when(F.col("m") == 1, F.col("total")).otherwise(
        F.col("least") + (F.row_number().over(nth) <= F.col("total") - F.col("m") * F.col("least")).cast("int")
    )
    return (
        met.select("row", times.cast("int").alias("times"))
        .where("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("row.*")
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")
