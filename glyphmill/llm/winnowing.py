"""Document fingerprints by winnowing.

Hashes of k tokens in a row are taken over the whole text; every window of w hashes gives its
smallest, the rightmost one on ties, with its position. Texts that share w + k - 1 tokens in a
row share a fingerprint hash.

One rule cuts every text, whatever its length and script: a token is a run of lower-case letters
with the capital before it, a run of capitals, a run of digits, or any other single code point
but white space. So scripts without word spaces or case are cut by code points, and long unspaced
lines where letters, digits and case meet. A run is cut after TOKEN_CHARS code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from glyphmill.llm.plan import SPACE, let, small_side, stored, text_key

GRAM, WINDOW = 4, 5
TOKEN_CHARS = 32
_LOWER, _CAPITAL = r"[\p{Ll}\p{M}]", r"[\p{Lu}\p{Lt}]"
TOKEN = (
    rf"{_CAPITAL}?{_LOWER}{{1,{TOKEN_CHARS}}}|{_CAPITAL}{{1,{TOKEN_CHARS}}}|\p{{N}}{{1,{TOKEN_CHARS}}}|[^{SPACE}]"
)
#: Cells that the ids' range is cut into to see where they lie; the driver gets one count each.
CELLS = 4096
#: The most documents of a bucket, about.
BUCKET_ROWS = 20_000


def selected(tokens: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """``array<struct<h, back>>``: chosen hashes in text order; ``back`` is minus the position."""

    def hashes(t):
        places = F.sequence(F.lit(0), F.greatest(F.size(t) - k, F.lit(0)))
        return F.transform(
            places, lambda i: F.struct(F.xxhash64(F.slice(t, i + 1, k)).alias("h"), (-i).alias("back"))
        )

    def minima(grams):
        starts = F.sequence(F.lit(1), F.greatest(F.size(grams) - w + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_min(F.slice(grams, i, w)))

    def once(chosen):
        return F.filter(
            chosen, lambda x, i: (i == 0) | (F.get(chosen, F.greatest(i - 1, F.lit(0)))["back"] != x["back"])
        )

    return let(tokens, lambda t: let(hashes(t), lambda g: let(minima(g), once)))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text that is not null: chosen hashes with their positions."""
    return selected(tokens(text))


def hash_set(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: x["h"]))


def digest(chosen: Column) -> Column:
    """A fingerprint as one string: SHA-256 of its hashes and positions."""
    return F.sha2(F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["h"], -x["back"])), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; no fingerprint is empty."""
    return let(
        F.size(F.array_intersect(a, b)), lambda both: both / (F.size(a) + F.size(b) - both).cast("double")
    )


def _bucket(docs: DataFrame, key: str) -> Column:
    """A bucket number that never falls as the key grows, with about as many rows in each.

    Counts per cell of the keys' range (at most CELLS numbers) say where keys are dense; a
    dense cell is cut evenly, sparse neighbours share a bucket. Null keys come before all.
    """
    at = F.col(key).cast("double")
    lo, hi, n = docs.agg(F.min(at), F.max(at), F.count("*")).first()
    if lo is None:
        return F.lit(0)
    width = max((hi - lo) / CELLS, 1.0)
    cell = F.floor((at - lo) / width).cast("int")
    counts = dict(docs.where(at.isNotNull()).groupBy(cell.alias("cell")).count().collect())
    wanted = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(1.0, min(BUCKET_ROWS, n / wanted))
    first, cuts, bucket, filled = [], [], 0, 0
    for c in range(max(counts) + 1):
        pieces = max(1, round(counts.get(c, 0) / rows))
        if filled and filled + counts.get(c, 0) > rows:
            bucket, filled = bucket + 1, 0
        first.append(bucket)
        cuts.append(pieces)
        bucket, filled = bucket + pieces - 1, (filled if pieces == 1 else rows) + counts.get(c, 0)
    known = F.array(*map(F.lit, first)), F.array(*map(F.lit, cuts))
    within = (at - lo) / width - cell
    piece = F.least(F.floor(within * F.get(known[1], cell)), F.get(known[1], cell) - 1)
    return F.coalesce((F.get(known[0], cell) + piece).cast("int"), F.lit(-1))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with its successor and an edited text, fingerprinted, as columns
    ``(key, n_chars, edited, chosen, edited_chosen, set, edited_set, next_set)``.

    The successor is the next row by descending key, then text; the last row's is the first. The
    edited text has its last third replaced by the successor's first as many code points. A null
    text is empty, null keys come last, repeated rows succeed each other, one row succeeds itself.

    Texts move once, to buckets of neighbouring keys. The first row of each bucket is also sent
    to the bucket before it, whose last row it succeeds; one short row per bucket says which.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("key"), body.alias("text"), text_key(F.col(text))[0])
    base = base.withColumn("bucket", _bucket(docs.select(F.col(key).alias("key")), "key"))
    # Window of one row per bucket; the order of buckets is descending.
    down = Window.orderBy(F.col("bucket").desc())
    tops = base.groupBy("bucket").agg(F.max(F.struct("key", "k1")).alias("top"))
    heads = tops.select(
        "bucket",
        "top",
        F.coalesce(
            F.lag("bucket").over(down), F.min("bucket").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        ).alias("to"),
    )
    heads = small_side(stored(heads, "bucket-heads"))
    b, h = base.alias("b"), heads.alias("h")
    is_head = F.expr("b.bucket = h.bucket and b.key <=> h.top.key and b.k1 = h.top.k1")
    places = F.when(
        F.col("h.to").isNotNull(),
        F.array(
            F.struct(F.col("b.bucket").alias("bucket"), F.lit(False).alias("guest")),
            F.struct(F.col("h.to").alias("bucket"), F.lit(True).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("b.bucket").alias("bucket"), F.lit(False).alias("guest"))))
    dealt = (
        b.join(h, is_head, "left")
        .select("b.key", "b.text", "b.k1", F.explode(places).alias("place"))
        .select("key", "text", "k1", "place.*")
        .repartition("bucket")
    )
    own = dealt.withColumn("chosen", fingerprint(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("key").desc_nulls_last(), F.col("k1").desc())
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    pairs = own.select(
        "key", "guest", "text", "chosen", F.lead("text").over(order).alias("next"), F.lead("chosen").over(order).alias("next_chosen")
    ).where("not guest")
    edited = pairs.select(
        "key",
        n.cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third)).alias("edited"),
        "chosen",
        "next_chosen",
    ).withColumn("edited_chosen", fingerprint(F.col("edited")))
    return edited.select(
        F.col("key").alias(key),
        "n_chars",
        "edited",
        "chosen",
        "edited_chosen",
        hash_set(F.col("chosen")).alias("set"),
        hash_set(F.col("edited_chosen")).alias("edited_set"),
        hash_set(F.col("next_chosen")).alias("next_set"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return compared(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("chosen")).alias("fingerprint"),
        digest(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("set"), F.col("edited_set")).alias("near_edited"),
        likeness(F.col("set"), F.col("next_set")).alias("near_next"),
    )
