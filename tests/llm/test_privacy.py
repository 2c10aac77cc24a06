"""Personal data spans against the plain patterns; terms that reveal an entity."""

import re

from glyphmill.llm import privacy
from hypothesis import given, settings, strategies as st

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    ds = [int(c) for c in d][::-1]
    return (sum(ds[::2]) + sum(sum(divmod(2 * x, 10)) for x in ds[1::2])) % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="ab@._%+-19 05()é\n", max_size=60))
def test_base_spans(text):
    assert privacy.base_spans(text) == plain(text)


def test_numbers():
    for text in ["4111 1111-1111 1111", "49529359002530524111", "+1 (407) 555-7710 x 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0004"]:
        assert privacy.base_spans(text) == plain(text)


def test_documents_and_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    given_rows = [(1000 + i, f"note {i} from Zorblat Quux a{i} b{i} zq@example.com c{i} d{i} Zorblat end{i}") for i in range(6)]
    given_rows += [(2000, None), (2001, ""), (2001, ""), (2002, "from nobody in particular")]
    more = docs.unionByName(spark.createDataFrame(given_rows, docs.schema))
    texts = [r.text or "" for r in more.collect()]
    got = privacy.found(more.withColumn("k1", privacy.F.lit("x"))).collect()
    assert len(got) == len(texts)
    for r in got:
        text = r.row.text or ""
        assert [tuple(s) for s in r.base] == plain(text)
        extra = {text[s.s : s.e] for s in r.every if s.kind == "term"}
        assert extra == ({"Zorblat", "Quux"} if 1000 <= r.row.doc_id < 1006 else set()), (r.row.doc_id, extra)
    clean = {r.doc_id: r.text for r in privacy.sanitised(more).collect()}
    assert clean[1003] == "note 3 from <term> <term> a3 b3 <email> c3 d3 <term> end3"
    assert clean[2000] is None and clean[2002] == "from nobody in particular"
    assert privacy.found(docs.limit(0)).count() == 0


def test_terms_of_a_constant_signature_and_of_texts_without_the_entity(spark):
    """One context in ten different texts is ten pieces of evidence; near copies of one text are not."""
    def own(name, n):
        return " ".join(f"{name}x{k}" for k in range(n))

    sign = "Yours truly Zorblat Quux Manager zq@example.com Phone desk nine floor two"
    rows = [(i, f"{own(f't{i}', 40)} {sign}") for i in range(10)]
    rows += [(100 + i, f"{own(f'u{i}', 30)} met Zorblat yesterday") for i in range(4)]
    copied = own("c", 400) + " from Blenk Morv ab@example.com beside the door " + own("d", 400)
    rows += [(200 + i, f"{copied} tail{i}") for i in range(3)]
    got = {
        r.row.doc_id: {r.row.text[s.s : s.e] for s in r.every if s.kind == "term"}
        for r in privacy.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert all({"Zorblat", "Quux"} <= got[i] for i in range(10))
    assert all(got[100 + i] == {"Zorblat"} for i in range(4))
    assert not any(got[200 + i] for i in range(3))
