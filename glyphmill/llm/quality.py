"""Quality rules: counts inside each document, and lines that many documents of a host share.

Lines are normalised and hashed; a line is frequent if more distinct documents of its host
have it than a limit allows. A document that keeps too little without them is rejected. The limit
is a number of documents, the same for a host of any size.

``judged`` gives counts and the verdict; ``kept_documents`` gives the texts that pass, without
their frequent lines. Both judge alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glyphmill.llm.plan import BROADCAST_ROWS, SPACE, let, small_side, stored, text_key, words

MIN_WORDS = 50
#: Rejected if more than this percentage of the words lies in repeated windows.
MAX_REPEATED_PERCENT = 50
WINDOW_WORDS = 3
SYMBOLS = "#*$%&|<>"
#: A line is frequent in more distinct documents of its host than this.
MIN_DOCUMENTS = 10
#: A document is depleted if it keeps a smaller share of its words, or fewer than MIN_WORDS.
MIN_KEPT_SHARE = 0.30

def _repeated_words(ws: Column) -> Column:
    """How many words lie in a window of three words that the text has twice or more.

    The windows' hashes are sorted with their places; equal neighbours are repeated windows.
    """
    n = F.size(ws)

    def hashed(_, i):
        return F.struct(
            F.xxhash64(*[F.get(ws, i + k) for k in range(WINDOW_WORDS)]).alias("h"), i.alias("i")
        )

    def places(grams):
        def repeated(g, i):
            before = (i > 0) & (F.get(grams, i - 1)["h"] == g["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(
                F.get(grams, i + 1)["h"] == g["h"], F.lit(False)
            )

        return F.array_sort(F.transform(F.filter(grams, repeated), lambda g: g["i"]))

    def covered(at):
        steps = F.transform(
            at, lambda p, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW_WORDS)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    grams = F.array_sort(F.transform(F.slice(ws, 1, F.greatest(n - 2, F.lit(0))), hashed))
    return F.when(n > WINDOW_WORDS, let(grams, lambda g: let(places(g), covered))).otherwise(0)


def _measures(text: Column) -> Column:
    """All counts of one text as a struct, with the words split once."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    bare = F.regexp_replace(text, f"[{SPACE}]+", "")
    return let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.length(bare).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", "")))
            .cast("bigint")
            .alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("bigint")
            .alias("n_dup_lines"),
            _repeated_words(ws).cast("bigint").alias("n_repeat_words"),
        ),
    )


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), f"[{SPACE}]+", " "))


def _document_lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``(host, k1, k2, line, words)``: a row per document text and distinct normalised line.

    Exact copies within a host are one document: their lines meet in one row each, where all
    have as many words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(F.col(host).alias("host"), *text_key(F.col(text)), F.explode(F.split(body, "\n")).alias("piece"))
        .select("host", "k1", "k2", _normal(F.col("piece")).alias("piece"))
        .where("piece <> ''")
        .select("host", "k1", "k2", F.xxhash64("piece").alias("line"), F.size(F.split("piece", " ")).alias("w"))
        .groupBy("host", "k1", "k2", "line")
        .agg(F.sum("w").alias("w"))
    )


def frequent_lines(
    docs: DataFrame, text: str = "text", host: str = "source", min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``(host, line, n_documents)`` of the lines above the limit, as a written table."""
    counts = _document_lines(docs, text, host).groupBy("host", "line").agg(F.count("*").alias("n_documents"))
    return stored(counts.where(F.col("n_documents") > min_documents), "frequent-lines")


def _marked_lines(docs: DataFrame, frequent: DataFrame, text: str, host: str) -> DataFrame:
    """The rows of ``_document_lines``, with ``lost`` true for frequent lines, else null."""
    lines, lost = _document_lines(docs, text, host), small_side(frequent.withColumn("lost", F.lit(True)))
    same = lines["host"].eqNullSafe(lost["host"]) & (lines["line"] == lost["line"])
    return lines.join(lost, same, "left").select(lines["host"], "k1", "k2", lines["line"], "w", "lost")


def _word_sums() -> list[Column]:
    left = F.when(F.col("lost"), 0).otherwise(F.col("w"))
    return [F.sum("w").alias("w"), F.sum(left).alias("left_w")]


def _too_little() -> Column:
    return (F.col("left_w") < MIN_KEPT_SHARE * F.col("w")) | (F.col("left_w") < MIN_WORDS)


def depleted_documents(docs: DataFrame, frequent: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``(host, k1, k2)`` of the texts that keep too little without the frequent lines, written."""
    sums = _marked_lines(docs, frequent, text, host).groupBy("host", "k1", "k2").agg(*_word_sums())
    lost = sums.where((F.col("left_w") < F.col("w")) & _too_little())
    return stored(lost.select("host", "k1", "k2"), "depleted")


def shortened_documents(docs: DataFrame, frequent: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``(host, k1, k2, depleted, lines)`` of the texts with frequent lines, written.

    ``lines`` are the hashes of those lines; a depleted text has none, as it goes as a whole.
    """
    sums = (
        _marked_lines(docs, frequent, text, host)
        .groupBy("host", "k1", "k2")
        .agg(*_word_sums(), F.collect_set(F.when(F.col("lost"), F.col("line"))).alias("lines"))
        .where(F.size("lines") > 0)
        .withColumn("depleted", _too_little())
    )
    lines = F.when(F.col("depleted"), F.slice("lines", 1, 0)).otherwise(F.col("lines"))
    return stored(sums.select("host", "k1", "k2", "depleted", lines.alias("lines")), "shortened")


def _base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED_PERCENT * F.col(f"{m}.n_words")
    )


def judged(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``(row, quality)``: each row of ``docs`` as a struct, and its counts with the verdict.

    Nulls: a null text is empty and fails the base rule; null hosts are one host. Repeated
    rows each give a row. An empty table gives none. Extra columns stay inside ``row``, so no
    name can clash.
    """
    frequent = frequent_lines(docs, text, host)
    lost = small_side(depleted_documents(docs, frequent, text, host).withColumn("depleted", F.lit(True)))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(host).alias("host"),
        *text_key(F.col(text)),
        _measures(F.coalesce(F.col(text), F.lit(""))).alias("m"),
    )
    on = rows["host"].eqNullSafe(lost["host"]) & (rows["k1"] == lost["k1"]) & (rows["k2"] == lost["k2"])
    failed = _base_failed("m")
    kept = ~failed & F.col("depleted").isNull()
    quality = F.struct("m.*", failed.alias("base_failed"), kept.alias("kept"))
    return rows.join(lost, on, "left").select("row", quality.alias("quality"))


def kept_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, without frequent lines in ``text``; ``n_chars``, if there, follows.

    A line is frequent in more than MIN_DOCUMENTS distinct texts of its host. A text passes if
    the base rule holds for it as it came, and if without its frequent lines it has MIN_WORDS
    words and MIN_KEPT_SHARE of what it had. Other lines and blank ones stay as they are.
    """
    shortened = shortened_documents(docs, frequent_lines(docs, text, host), text, host)
    hashes = shortened.agg(F.sum(F.size("lines") + 1)).first()[0] or 0
    side = F.broadcast(shortened) if hashes <= BROADCAST_ROWS else shortened
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(host).alias("host"),
        *text_key(F.col(text)),
        _measures(F.coalesce(F.col(text), F.lit(""))).alias("m"),
    ).where(~_base_failed("m"))
    on = rows["host"].eqNullSafe(side["host"]) & (rows["k1"] == side["k1"]) & (rows["k2"] == side["k2"])
    stays = F.filter(
        F.split(F.col(f"row.`{text}`"), "\n"), lambda x: ~F.array_contains(F.col("lines"), F.xxhash64(_normal(x)))
    )
    left = (
        rows.join(side, on, "left")
        .where(F.coalesce(~F.col("depleted"), F.lit(True)))
        .select("row", F.when(F.col("lines").isNotNull(), F.array_join(stays, "\n")).alias("now"))
    )
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.coalesce("now", value)
        elif c == "n_chars":
            value = F.when(F.col("now").isNotNull(), F.length("now")).otherwise(value).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return left.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs.select("doc_id", "text", "source")).select("row.doc_id", "quality.*")


SQL = r"""
WITH d AS (
    SELECT doc_id, source AS host, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), grams AS (
    SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), repeated AS (
    SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT w) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS w FROM repeated) GROUP BY doc_id
), lines AS (
    SELECT doc_id, host, text, trim(regexp_replace(lower(unnest(ls)), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM d
), common AS (
    SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT text) > 10
), left_over AS (
    SELECT doc_id, sum(len(string_split(line, ' '))) AS w,
        sum(CASE WHEN c.host IS NULL THEN len(string_split(line, ' ')) ELSE 0 END) AS left_w
    FROM lines LEFT JOIN common c USING (host, line) GROUP BY doc_id
), base AS (
    SELECT doc_id, len(ws) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN covered USING (doc_id)
)
SELECT b.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND NOT coalesce(left_w < w AND (left_w < 0.30 * w OR left_w < 50), FALSE) AS kept
FROM base b LEFT JOIN left_over USING (doc_id)
"""
