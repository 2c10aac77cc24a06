"""Secret scans: patterns that are secrets on their own, and multipart credentials.

Weak parts (user or key names, values after vague labels, long unlabelled strings, endpoints) are
common and mean little alone. Within a scope, an identifier, a secret and an endpoint make each
other plausible: parts are joined by interval, and a weak secret is reported only if an access key,
or an identifier and an endpoint, lie at most SCOPE code points from its nearer end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from glyphmill.llm.plan import BROADCAST_ROWS, SPACE, let, stored, text_key

# The base patterns, in the order of kinds.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6

#: Weak parts of a credential.
IDENTIFIER = (
    "(?:[Uu]ser(?:[Nn]ame|_?[Ii]d)?|[Ll]ogin|[Cc]lient_?[Ii]d|[Aa]ccount|[Aa]ccess_?[Kk]ey(?:_?[Ii]d)?)"
    "[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}"
)
ENDPOINT = "(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@%&=+-]{4,}"
#: A value after a label that may or may not name a secret.
LABELLED = rf"(?<![A-Za-z])(?i:pass(?:phrase)?|pwd|pw|key|credentials?)[\"']?\x20*[:=]\x20*[\"']?[^{SPACE}\"',;]{{6,}}"
#: User and secret in an address; it has all three parts.
USER_INFO = rf"://[^{SPACE}/:@]+:[^{SPACE}/@]+@"
#: A long run; of interest if it has letters and digits, or is all letters or all digits.
OPAQUE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
#: How far apart, in code points, the parts of one credential may lie.
SCOPE = 200

KINDS = ("assign", "access", "hex")
#: A weak secret that overlaps a span of a smaller level is no secret of its own.
LEVELS = {
    **dict.fromkeys(KINDS, 0), "user_info": 1, "identifier": 2, "labelled": 3, "mixed": 4, "endpoint": 5, "plain": 6
}
WEAK = ("user_info", "labelled", "mixed", "plain")
#: Parts into which rows of equal texts are dealt for the last join.
SALTS = 64


def _spans(text: Column, pattern: str, kind: str, keep=None, part=None) -> Column:
    """Spans of all matches of ``pattern``: the text between matches tells where they are.

    ``keep`` says which matches count, ``part`` gives start, end and kind from those of a match.

    The text is split at the matches; match number i starts after the first i + 1 pieces and
    the i matches before it.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def placed(found):
        steps = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        first = F.struct(F.lit(0).alias("at"), F.slice(F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"), F.lit("").alias("m"))), 1, 0).alias("out"))
        return F.aggregate(
            F.slice(steps, 1, F.size(found)),
            first,
            lambda a, x: let(
                a["at"] + F.coalesce(x["g"], F.lit(0)),
                lambda s: F.struct(
                    (s + F.length(x["m"])).alias("at"),
                    F.concat(
                        a["out"], F.array(F.struct(s.alias("s"), (s + F.length(x["m"])).alias("e"), x["m"].alias("m")))
                    ).alias("out"),
                ),
            ),
            lambda a: a["out"],
        )

    spans = let(matches, placed)
    if keep is not None:
        spans = F.filter(spans, lambda x: keep(x["m"]))
    order = KINDS.index(kind) if kind in KINDS else len(KINDS)

    def shaped(x):
        begin, end, name = (x["s"], x["e"], F.lit(kind)) if part is None else part(x["s"], x["e"], x["m"])
        return F.struct(begin.alias("s"), F.lit(order).alias("order"), end.alias("e"), name.alias("kind"))

    found = F.transform(spans, shaped)
    none = F.slice(found, 1, 0)
    return F.when(text.rlike(pattern), found).otherwise(none)


def _parts(text: Column) -> list[Column]:
    def long_enough(m):
        return F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE

    def user(s, e, m):
        return s + 3, s + F.length(F.substring_index(m, ":", 2)), F.lit("identifier")

    def secret(s, e, m):
        return s + F.length(F.substring_index(m, ":", 2)) + 1, e - 1, F.lit("user_info")

    def address(s, e, m):
        return s, e, F.lit("endpoint")

    def mixed(m):
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]")

    def random_looking(s, e, m):
        return s, e, F.when(mixed(m), "mixed").otherwise("plain")

    user_info = [_spans(text, USER_INFO, "user_info", part=part) for part in (secret, user, address)]
    opaque = _spans(text, OPAQUE, "opaque", lambda m: mixed(m) | m.rlike("^(?:[A-Za-z]+|[0-9]+)$"), random_looking)
    return [
        _spans(text, ASSIGN, "assign", long_enough).alias("assign"),
        _spans(text, ACCESS, "access").alias("access"),
        _spans(text, HEX, "hex").alias("hex"),
        F.concat(_spans(text, IDENTIFIER, "identifier"), user_info[1]).alias("identifier"),
        F.concat(_spans(text, ENDPOINT, "endpoint"), user_info[2]).alias("endpoint"),
        F.concat(user_info[0], _spans(text, LABELLED, "labelled"), opaque).alias("weak"),
    ]


def _marks(rows: DataFrame) -> DataFrame:
    """``(k1, k2, s, e, kind)``: the spans of each text that has parts to be linked, once for equal texts."""
    may = (F.size("weak") > 0) & (
        (F.size("access") > 0) | ((F.size("identifier") > 0) & (F.size("endpoint") > 0))
    )
    parts = F.concat("base", "identifier", "endpoint", "weak")
    texts = rows.where(may).select("k1", "k2", parts.alias("parts")).dropDuplicates(["k1", "k2"])
    return texts.select("k1", "k2", F.explode("parts").alias("p")).select("k1", "k2", "p.s", "p.e", "p.kind")


def _free(marks: DataFrame) -> DataFrame:
    """The weak secrets of ``marks`` that overlap no span of a smaller level.

    Among the spans of a text by their start, the furthest end so far and the next start tell.
    """
    level = F.element_at(F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair]), F.col("kind"))
    by_start = Window.partitionBy("k1", "k2").orderBy("s", "level", "e", "kind")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    # The following rows are the rows before in the opposite order.
    after = Window.partitionBy("k1", "k2").orderBy(*[F.col(c).desc() for c in ("s", "level", "e", "kind")])
    after = after.rowsBetween(Window.unboundedPreceding, -1)
    rows, free = marks.withColumn("level", level), F.lit(False)
    for kind in WEAK:
        stronger = F.col("level") < LEVELS[kind]
        rows = rows.withColumn(f"end_{kind}", F.max(F.when(stronger, F.col("e"))).over(before))
        rows = rows.withColumn(f"start_{kind}", F.min(F.when(stronger, F.col("s"))).over(after))
        overlaps = F.coalesce(F.col(f"end_{kind}") > F.col("s"), F.lit(False)) | F.coalesce(
            F.col(f"start_{kind}") < F.col("e"), F.lit(False)
        )
        free = free | ((F.col("kind") == kind) & ~overlaps)
    return rows.where(free).select("k1", "k2", "s", "e")


def _linked(rows: DataFrame, scope: int) -> DataFrame:
    """``(k1, k2, linked)``: the weak secrets of each text that complementary parts vouch for.

    The interval join deals the text into buckets as wide as the scope. A secret widened by the
    scope on both sides is longer than two buckets, so of the partners of a kind that touch a
    bucket the smallest start and the largest end say whether one of them meets the secret.
    """
    marks = _marks(rows)

    def buckets(first, last):
        return F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))).alias("b")

    near = (
        marks.where(F.col("kind").isin("access", "identifier", "endpoint"))
        .select("k1", "k2", "kind", "s", "e", buckets(F.col("s"), F.col("e")))
        .groupBy("k1", "k2", "kind", "b")
        .agg(F.min("s").alias("first"), F.max("e").alias("last"))
    )
    weak = _free(marks).select("k1", "k2", "s", "e", buckets(F.col("s") - scope, F.col("e") + scope))
    met = weak.join(near, ["k1", "k2", "b"]).where(
        (F.col("last") >= F.col("s") - scope) & (F.col("first") <= F.col("e") + scope)
    )
    vouched = (
        met.groupBy("k1", "k2", "s", "e")
        .agg(*[F.max(F.when(F.col("kind") == kind, 1)).alias(kind) for kind in ("access", "identifier", "endpoint")])
        .where("access = 1 or (identifier = 1 and endpoint = 1)")
    )
    span = F.struct("s", F.lit(len(KINDS)).alias("order"), "e", F.lit("linked").alias("kind"))
    return vouched.groupBy("k1", "k2").agg(F.collect_set(span).alias("linked"))


def _with_linked(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` with the linked spans of their texts; copies of a text never meet in one task."""
    spans = linked.agg(F.sum(F.size("linked"))).first()[0] or 0
    if spans <= BROADCAST_ROWS:
        return rows.join(F.broadcast(linked), ["k1", "k2"], "left")
    salted = linked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return dealt.join(salted, ["k1", "k2", "salt"], "left")


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``(key, assign, access, hex, base, spans)`` per row of ``docs``: arrays of spans in code points.

    ``base`` is sorted by start, then kind; ``spans`` also has the linked weak secrets. A null
    or empty text has none. Spans depend on the text alone: equal texts are linked once, repeated
    rows each give a row, an empty table gives none.
    """
    rows = docs.select(F.col(key).alias("key"), *text_key(F.col(text)), *_parts(F.coalesce(F.col(text), F.lit(""))))
    rows = stored(rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex"))), "secret-parts")
    linked = stored(_linked(rows, scope), "linked-secrets")
    none = F.slice("base", 1, 0)
    return _with_linked(rows, linked).select(
        F.col("key").alias(key),
        *KINDS,
        "base",
        F.array_sort(F.concat("base", F.coalesce("linked", none))).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scanned(docs).select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
