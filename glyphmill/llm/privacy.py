"""Personal data: pattern spans, and terms that give a protected entity away.

The values that the patterns find (addresses, numbers) are the protected entities. How
strongly a term beside an entity reveals it is read off the corpus: of the texts that have the
term, what share has the entity near it? ``-log2`` of that share is what stays unknown of the
entity once the term is seen. A term that leaves less than a bit unknown is a span of its own in
every text that has it, with the entity or without, and is generalised when texts are rewritten.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glyphmill.llm.plan import BROADCAST_ROWS, small_batches, small_side, stored, text_key
from glyphmill.llm.tokens import Words, runs, signed, slices

KINDS = ("email", "ip", "card", "phone")
#: What takes the place of a span.
GENERAL = {"email": "<email>", "ip": "<ip>", "card": "<card>", "phone": "<phone>", "term": "<term>"}
#: Words on each side of an entity that count as beside it.
CONTEXT = 5
#: Bits of the entity that must stay unknown, and how many different texts must agree.
MIN_BITS = 1.0
MIN_CONTEXTS = 3
#: Words in a row whose smallest hash, outside an entity's context, stands for a text and its near copies.
EVIDENCE_WORDS = 4

#: Taken off both ends of a word to get its term.
MARKS = ".,;:!?()[]{}\"'|*&$%#<>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match has one @: from there back over the local part, and on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers joined by dots, four by four from the left."""
    for run in _DOTTED.finditer(text):
        parts, at = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start."""
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *s) for s in _ips(text)]
        out += [("card", *s) for s in _cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in _phones(text)]
    return out


def _id(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _places(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, id)`` of the words in code points, without marks around them."""
    words = Words(pa.array([text], pa.string()), lower=True, trim=MARKS)
    # Bytes that begin a character; their running count turns byte places into code points.
    begins = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    return list(zip(begins[words.starts].tolist(), begins[words.ends].tolist(), signed(words.ids()).tolist()))


def _evidence(words: list[int]):
    """A function from a context's words, ``lo`` to ``hi``, to a number that stands for the text around it.

    The smallest hash of words in a row outside the context: texts that differ have different
    ones however alike their contexts are, and near copies mostly the same.
    """
    n = max(len(words) - EVIDENCE_WORDS + 1, 0)
    ids = np.array(words, np.int64).view(np.uint64)
    hashes = signed(runs(ids, EVIDENCE_WORDS, np.zeros(len(ids), np.int64))[0])
    before, after = np.minimum.accumulate(hashes), np.minimum.accumulate(hashes[::-1])[::-1]

    def of(lo: int, hi: int) -> int:
        ends = lo - EVIDENCE_WORDS
        found = [int(before[ends])] if ends >= 0 else []
        found += [int(after[hi])] if hi < n else []
        return min(found) if found else _id(repr(words))

    return of


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(k1, k2, entity, evidence, term)``: the terms beside each entity of a text, once a text."""
    for batch in slices(batches):
        rows = []
        for k1, k2, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            spans = base_spans(text)
            if not spans:
                continue
            words = _places(text)
            starts, ends, ids = [w[0] for w in words], [w[1] for w in words], [w[2] for w in words]
            evidence, terms = {}, {}
            of = _evidence(ids)
            for kind, s, e in spans:
                first, after = bisect_right(ends, s), bisect_left(starts, e)
                lo, hi = max(first - CONTEXT, 0), min(after + CONTEXT, len(ids))
                entity, mine = _id(f"{kind}:{text[s:e].lower()}"), of(lo, hi)
                evidence[entity] = min(mine, evidence.get(entity, mine))
                terms.setdefault(entity, set()).update(ids[lo:first] + ids[after:hi])
            rows += [(k1, k2, entity, evidence[entity], t) for entity, own in terms.items() for t in own]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "entity", "evidence", "term"]
        )


def _terms_of_texts(wanted: np.ndarray | None):
    """A map to ``(k1, k2, term)``: the distinct terms of each text, of ``wanted`` if given (sorted)."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column(2), lower=True, trim=MARKS)
            ids, doc = signed(words.ids()), words.doc
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, ids), len(wanted) - 1)
                hit = wanted[at] == ids
                ids, doc = ids[hit], doc[hit]
            pairs = np.unique(np.stack([doc.astype(np.int64), ids], 1), axis=0) if len(ids) else np.zeros((0, 2), np.int64)
            of = pa.array(pairs[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(pairs[:, 1])], names=["k1", "k2", "term"]
            )

    return terms


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, n)``: how many texts of a batch have each term."""
    for batch in batches:
        seen = []
        for part in slices(iter([batch])):
            words = Words(part.column(0), lower=True, trim=MARKS)
            ids = words.ids()
            order = np.lexsort((ids, words.doc))
            ids, doc = ids[order], words.doc[order]
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
            seen.append(ids[fresh])
        terms, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64),) * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(terms)), pa.array(n.astype(np.int64))], names=["term", "n"]
        )


def revealing_terms(
    docs: DataFrame, text: str = "text", min_bits: float = MIN_BITS, min_contexts: int = MIN_CONTEXTS
) -> DataFrame:
    """``(k1, k2, terms)``: per text, the terms in it that give an entity away; written.

    The share of an entity among the texts of a term is counted over the whole corpus. A term
    must stand beside the entity in ``min_contexts`` different texts; copies and near copies of
    one text are one piece of evidence, texts with one constant signature are many.
    """
    texts = small_batches(docs).select(*text_key(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    beside = stored(
        texts.mapInArrow(_contexts, "k1 bigint, k2 bigint, entity bigint, evidence bigint, term bigint"),
        "beside",
    )
    together = (
        beside.groupBy("entity", "term", "evidence")
        .agg(F.count("*").alias("n_texts"))
        .groupBy("entity", "term")
        .agg(F.sum("n_texts").alias("together"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= min_contexts)
    )
    holders = texts.select("text").mapInArrow(_holders, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    bits = -F.log2(F.least(F.col("together") / F.col("n"), F.lit(1.0)))
    revealing = stored(together.join(holders, "term").where(bits < min_bits).select("term").distinct(), "revealing")
    schema = "k1 bigint, k2 bigint, term bigint"
    if revealing.count() <= BROADCAST_ROWS:
        wanted = np.array(sorted(r.term for r in revealing.toLocalIterator()), np.int64)
        found = texts.mapInArrow(_terms_of_texts(wanted), schema) if len(wanted) else texts.sparkSession.createDataFrame([], schema)
    else:
        found = texts.mapInArrow(_terms_of_texts(None), schema).join(revealing, "term")
    return stored(found.groupBy("k1", "k2").agg(F.collect_set("term").alias("terms")), "terms-of-texts")


def all_spans(text: str, terms: list[int] | None) -> list[tuple[str, int, int]]:
    """Base spans, then the spans of the given terms that touch none of them."""
    base = base_spans(text)
    if not terms:
        return base
    wanted, taken = set(terms), sorted((s, e) for _, s, e in base)
    out, i = list(base), 0
    for s, e, term in _places(text):
        if term in wanted and e > s:
            while i < len(taken) and taken[i][1] <= s:
                i += 1
            if not any(a < e and s < b for a, b in taken[i : i + len(KINDS) + 1]):
                out.append(("term", s, e))
    return out


def _with_terms(docs: DataFrame, text: str) -> DataFrame:
    """``(row, text, terms)`` of each row; texts move only if the table of terms is large."""
    side = small_side(revealing_terms(docs, text))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *text_key(F.col(text)),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.join(side, ["k1", "k2"], "left").select("row", "text", "terms")


_SPANS = T.ArrayType(T.StructType().add("kind", "string").add("s", "integer").add("e", "integer"))


@F.arrow_udf(T.StructType().add("base", _SPANS).add("every", _SPANS))
def _find(texts: pa.Array, terms: pa.Array) -> pa.Array:
    def shaped(spans):
        return [{"kind": k, "s": s, "e": e} for k, s, e in spans]

    span = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
    out = []
    for text, own in zip(texts, terms):
        text = text.as_py()
        base = shaped(base_spans(text))
        own = own.as_py()
        out.append({"base": base, "every": shaped(all_spans(text, own)) if own else base})
    return pa.array(out, pa.struct([("base", span), ("every", span)]))


@F.arrow_udf(T.StringType())
def _rewrite(texts: pa.Array, terms: pa.Array) -> pa.Array:
    return pa.array([generalised(t.as_py(), own.as_py()) for t, own in zip(texts, terms)], pa.string())


def generalised(text: str, terms: list[int] | None) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, by the first."""
    out, done = [], 0
    for kind, s, e in sorted(all_spans(text, terms), key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], GENERAL[kind]]
        done = max(done, e)
    return "".join(out) + text[done:] if out else text


def found(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(row, base, every)``: each row as a struct, its base spans, and these with revealing terms.

    Spans are ``(kind, s, e)`` in code points, by kind, then start. A null or empty text has
    none; repeated rows each give a row, and extra columns stay inside ``row``.
    """
    return _with_terms(docs, text).select("row", _find("text", "terms").alias("f")).select("row", "f.base", "f.every")


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with spans generalised in ``text``; ``n_chars``, if there, follows."""
    rows = _with_terms(docs, text).select("row", "text", _rewrite("text", "terms").alias("now"))
    now = F.when(F.col(f"row.`{text}`").isNotNull(), F.col("now"))
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = now
        elif c == "n_chars":
            value = F.when(F.col("now") != F.col("text"), F.length("now")).otherwise(value).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return rows.select(*columns)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return found(docs).select(
        "row.doc_id",
        *[F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("every")).alias("spans"),
    )
