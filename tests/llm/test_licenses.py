import re
import textwrap

import pytest

from pitlane.llm import licenses as L
from pitlane.llm.license_texts import LICENSES

TEXTS = dict(reversed([(i, t) for i, t in LICENSES if "\n" in t]))


def found(spark, *rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return sorted(map(tuple, L.scan_licenses(df, L.known_licenses(spark)).collect()))


def test_whole_texts_in_other_spellings(spark):
    mit = TEXTS["MIT"].replace("Copyright (c) <year> <copyright holders>", "Copyright © 2020-2024 Some One\nAll rights reserved.")
    british = mit.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ,").replace('"', "''")
    assert found(spark, mit, british, british + " more", TEXTS["ISC"].replace("\n\n", "\n")) == [(0, "MIT", True, 1), (1, "MIT", True, 1), (3, "ISC", True, 1)]


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0", "GFDL-1.3", "Artistic"])
def test_whole_texts_of_common_licences(spark, name):
    with open(f"/usr/share/common-licenses/{name}") as f:
        text = f.read()
    ids = {"GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "GFDL-1.3": "GFDL-1.3-only", "Artistic": "Artistic-1.0-Perl"}
    got = found(spark, text, text.upper(), text.split("END OF TERMS")[0], text[:-300])
    whole = [(k, i) for k, i, w, _ in got if w]
    assert whole == [(k, ids.get(name, name)) for k in ((0, 1, 2))] and not any(k == 3 and w for k, _, w, _ in got)


def wrapped(text, width):
    """Paragraphs filled anew, but those that hold a notice."""
    out = []
    for p in re.split(r"\n[ \t]*\n", text):
        notice = re.search(r"copyright\s*(\(c\)|[\[<])", p, re.IGNORECASE)
        out.append(p if notice else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False))
    return "\n\n".join(out)


def test_wrapping_does_not_matter(spark):
    rows, want = [], []
    for i, t in LICENSES:
        for text in (*(wrapped(t, w) for w in range(60, 101, 5 if "\n" in t else 100)), " ".join(t.split())):
            want.append((len(rows), i))
            rows.append(text)
    got = {(a, b) for a, b, whole, _ in found(spark, *rows) if whole}
    assert [(i, rows[k][:60]) for k, i in want if (k, i) not in got] == []


def test_only_notices_go(spark):
    notices = ["Copyright (c) 2020 A B", "Copyright 2019-2021 The Authors", "© Some One", "(c) 2020 X", "Copyright [yyyy] [name]", "Copyright Some One", "Copyright (C) A\nCopyright (C) B\nAll rights reserved."]
    body = TEXTS["ISC"].split("\n\n", 2)[2]
    rows = [f"{n}\n\n{body}" for n in notices] + [body.replace("the above copyright notice", "the above\ncopyright notice"), body.replace("copyright notice", "copyright\nnotice"), "Copyright (c) 2020 A B " + body]
    assert found(spark, *rows) == [(k, "ISC", True, 1) for k in range(len(rows))]
    assert found(spark, body.replace("copyright notice", "notice")) == []


def test_lines_count_as_units(spark):
    line = "Released under the MIT Licence."
    assert found(spark, f"prose\n{line}\nmore", line, f"x {line}", f"{line}\n  released UNDER the mit license\nLicensed under CC BY-NC 4.0") == [
        (0, "MIT", False, 1), (1, "MIT", True, 1), (3, "CC-BY-NC-4.0", False, 1), (3, "MIT", False, 2),
    ]


def test_edges(spark, edge_docs, no_docs):
    known = L.known_licenses(spark)
    assert L.scan_licenses(edge_docs, known).count() == 0 and L.scan_licenses(no_docs, known).count() == 0
    odd = spark.createDataFrame([("a", "Word"), ("b", "word!"), ("c", ""), (None, None)], "license_id string, text string")
    assert sorted(map(tuple, L.scan_licenses(edge_docs, odd).collect())) == [(4, "a", True, 1), (4, "b", True, 1)]
    twice = edge_docs.unionAll(edge_docs)
    assert {r.n_units for r in L.scan_licenses(twice, odd).collect()} == {2}


def test_a_large_table_is_joined_without_a_broadcast(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_ROWS", 1)
    odd = spark.createDataFrame([("a", "Word"), ("b", "word!"), ("c", "x")], "license_id string, text string")
    assert sorted(map(tuple, L.scan_licenses(edge_docs, odd).collect())) == [(4, "a", True, 1), (4, "b", True, 1)]


@pytest.mark.parametrize("key", ["op1_quality_rules", "op8_license_digests"])
def test_sql_agrees(spark, key):
    import duckdb

    from pitlane.llm.registry import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(ORACLES[key]).to_arrow_table()
    got = QUERIES[key](spark, "/root/testdata/sf0.001")
    cols = sorted(got.columns)
    assert cols == sorted(want.column_names)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(zip(*(want[c].to_pylist() for c in cols)))
