"""Quality rules and license scans: the SQL on the documents, and edge rows."""

from pathlib import Path

import duckdb
import pytest
from glyphmill.llm import licenses, quality

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module", [quality, licenses])
def test_documents_against_sql(spark, module):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    df = module.query(spark, FOLDER)
    result = db.execute(module.SQL)
    names = [c[0] for c in result.description]
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, result.fetchall()))


def test_quality_edge_rows(spark):
    shared = "Shared line of this host for all.\n"
    menu = "\n".join(" ".join(f"menu{i}.{k}" for k in range(6)) for i in range(12))
    rows = [(i, shared + " ".join(f"own{i}.{k}" for k in range(70)), "h") for i in range(30)]
    rows += [(100 + i, menu + f"\nown words {i}", "h") for i in range(20)]
    rows += [(200, None, "h"), (201, "", None), (202, "a b c d " * 40, None), (202, "a b c d " * 40, None), (203, "#$% & x", "h")]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, source string, k1 int, kept boolean")
    got = {}
    for r in quality.judged(docs).collect():
        got.setdefault(r.row.doc_id, []).append(r.quality)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][0].kept for i in range(30))
    assert not any(got[100 + i][0].kept or got[100 + i][0].base_failed for i in range(20))
    assert got[200][0].n_words == 0 and got[200][0].base_failed and not got[201][0].kept
    assert [q.n_repeat_words for q in got[202]] == [160, 160] and got[202][0].base_failed
    assert (got[203][0].n_symbols, got[203][0].word_chars) == (4, 5)
    assert quality.kept_documents(docs).columns == docs.columns
    assert quality.judged(docs.limit(0)).count() == 0


def test_copies_are_one_document(spark):
    text = "\n".join(" ".join(f"line{i}.{k}" for k in range(6)) for i in range(12))
    docs = spark.createDataFrame([(i, text, "h") for i in range(40)], "doc_id long, text string, source string")
    assert quality.kept_documents(docs).count() == 40


def test_stage_removes_frequent_lines_whatever_the_hosts_size(spark):
    """11 of 400 texts of a host share a line, which is below a tenth; the base rule keeps all."""
    own = lambda i, n: " ".join(f"own{i}.{k}" for k in range(n))
    menu = "\n".join(" ".join(f"menu{i}.{k}" for k in range(6)) for i in range(12))
    rows = {i: own(i, 60) for i in range(360)}
    rows |= {1000 + i: f"{own(i, 30)}x\n\n  Home  | About Us |\tContact\n{own(-i - 1, 30)}y\n" for i in range(11)}
    rows |= {2000 + i: f"{menu}\nonly words {i}" for i in range(11)}  # a small share stays
    rows |= {3000 + i: f"home | about us | contact\n{own(3000 + i, 48)}" for i in range(9)}  # 48 words stay
    rows |= {4000 + i: f"Ten have this one\n{own(4000 + i, 60)}" for i in range(10)}
    docs = spark.createDataFrame(
        [(k, t, "h", len(t)) for k, t in rows.items()] + [(1000, rows[1000], "other", 7), (1000, rows[1000], None, 7)],
        "doc_id long, text string, source string, n_chars long",
    )
    judged = quality.judged(docs).collect()
    assert not any(r.quality.base_failed for r in judged)
    got = {(r.doc_id, r.source): r for r in quality.kept_documents(docs).collect()}
    assert {(r.row.doc_id, r.row.source) for r in judged if r.quality.kept} == set(got)
    assert {k for k, host in got if host == "h"} == {k for k in rows if k < 2000 or k >= 4000}
    for k, text in rows.items():
        if (k, "h") in got:
            want = "\n".join(x for x in text.split("\n") if "About Us" not in x)
            assert (got[k, "h"].text, got[k, "h"].n_chars) == (want, len(want))
    assert got[1000, "other"].text == got[1000, None].text == rows[1000] and got[1000, "other"].n_chars == 7


def test_whole_table_loses_documents_by_its_lines(spark):
    """On the documents, and on planted ones among them, verdicts follow the lines and the stage agrees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    own = lambda i, n: " ".join(f"own{i}.{k}" for k in range(n))
    menu = "\n".join(" ".join(f"menu{i}.{k}" for k in range(6)) for i in range(12))
    host = docs.first().source
    planted = [(10**9 + i, f"{menu}\n{own(i, 20)}", host) for i in range(12)]  # depleted
    planted += [(2 * 10**9 + i, f"{menu}\n{own(100 + i, 60)}", host) for i in range(12)]  # enough is left
    both = docs.union(spark.createDataFrame(planted, docs.schema))
    judged = quality.judged(both).select("row.doc_id", "quality.*").collect()
    by_lines = {r.doc_id for r in judged if not r.base_failed and not r.kept}
    assert {k for k, _, _ in planted[:12]} <= by_lines and not {k for k, _, _ in planted[12:]} & by_lines
    assert sorted(r.doc_id for r in judged if r.kept) == sorted(r.doc_id for r in quality.kept_documents(both).collect())


def test_license_edge_rows(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + licenses.KNOWN[0][1].replace("sublicense", "sub-license").upper()
    rows = [
        (1, mit), (1, mit), (2, None), (3, ""), (4, "text\nreleased under the mit licence!\nmore"),
        (5, "SPDX-License-Identifier: Apache-2.0\nAll rights reserved."), (6, "I was released under the MIT License."), (7, "© 2021 Me"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")
    got = sorted((tuple(r) for r in licenses.scanned(docs).collect()), key=repr)
    assert got == sorted(
        [(1, "MIT", 0, "MIT")] * 2
        + [(2, None, 0, ""), (3, None, 0, ""), (4, None, 1, "MIT"), (5, None, 2, "Apache-2.0,all-rights-reserved")]
        + [(6, None, 0, ""), (7, None, 0, "")],
        key=repr,
    )
    assert licenses.scanned(docs.limit(0)).count() == 0


BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def test_long_licenses_inside_texts(spark):
    mit, cut = licenses.KNOWN[0][1], "We give no warranty. " + licenses.KNOWN[0][1][:400]
    comments = "\n".join("// " + x for x in BSD_2.split("\n"))
    rows = [
        (1, f"# Tool\n\nSome words first.\n\nMIT License\n\nCopyright (c) 2020 Me\n\n{mit}\n\n## More\nwords", None, "MIT"),
        (2, "intro " + mit.replace("\n", " ") + " outro", None, "MIT"),
        (3, f"// Copyright 2021 Me\n{comments}\nint main() {{}}\n{mit}", None, "BSD-2-Clause,MIT"),
        (4, cut, None, ""),
        (5, mit.replace("free of charge", "for a fee"), None, ""),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2]], "doc_id long, text string")
    got = {(r.doc_id, r.whole, r.n_lines, r.licenses) for r in licenses.scanned(docs).collect()}
    assert got == {(i, whole, 0, names) for i, _, whole, names in rows}


@pytest.mark.skipif(not Path("/usr/share/common-licenses/GPL-3").exists(), reason="no licence texts on this machine")
def test_whole_public_licenses(spark):
    def text(name):
        return Path(f"/usr/share/common-licenses/{name}").read_text()

    apache = text("Apache-2.0")
    rows = [("GPL-2.0", text("GPL-2")), ("GPL-3.0", text("GPL-3")), ("LGPL-3.0", text("LGPL-3")), ("MPL-2.0", text("MPL-2.0"))]
    rows += [("CC0-1.0", text("CC0-1.0")), ("Apache-2.0", apache), ("Apache-2.0", apache[: apache.index("   APPENDIX")])]
    rows += [("Apache-2.0", apache[apache.index("TERMS AND CONDITIONS") :]), ("BSD-3-Clause", text("BSD"))]
    rows += [("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2020, Me\nAll rights reserved.\n\n" + BSD_2)]
    docs = [(i, t) for i, (_, t) in enumerate(rows)] + [(100 + i, f"See below.\n\n{t}\n\nThe end.") for i, (_, t) in enumerate(rows)]
    got = {r.doc_id: r for r in licenses.scanned(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, (name, _) in enumerate(rows):
        assert got[i].whole == name and name in got[i].licenses.split(",")
        assert got[100 + i].whole is None and name in got[100 + i].licenses.split(",")
