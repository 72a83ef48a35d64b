import random

import pytest

from pitlane.llm import decontaminate as D

from .conftest import prose
from .llm_data import texts


def distance(p, t):
    """Least edit distance of p to a substring of t, by dynamic programming."""
    prev = list(range(len(p) + 1))
    best = prev[-1]
    for c in t:
        cur = [0]
        for i, x in enumerate(p, 1):
            cur.append(min(prev[i - 1] + (x != c), prev[i] + 1, cur[-1] + 1))
        prev, best = cur, min(best, cur[-1])
    return best


def test_myers_equals_dynamic_programming():
    r = random.Random(1)
    for _ in range(800):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 80)))
        t = "".join(r.choice("abc") for _ in range(r.randint(1, 40)))
        got, want = D.myers(p, t, len(p)), distance(p, t)
        assert (got[0] if got else len(p)) == want


def edited(text, n, seed):
    r, s = random.Random(seed), list(text)
    for _ in range(n):
        k = r.randrange(len(s))
        s[k : k + 1] = r.choice([[], ["q"], [s[k], "q"]])
    return "".join(s)


def test_matches_equal_brute_force(spark):
    items = [(k, prose(100 + k, 20)) for k in range(12)] + [(50, "tiny item"), (51, ""), (52, None), (53, "Tiny, ITEM!")]
    r, docs = random.Random(2), []
    for k in range(60):
        i, t = r.choice(items[:12])
        docs.append((k, f"{prose(k, 15)} {edited(t, r.randrange(0, 14), k)}. {prose(k + 500, 15)}"))
    docs += [(100, "before TINY -- item after"), (101, "tinyitem"), (102, "tiny items")]
    got = {(m.doc_id, m.item_id): m.distance for m in D.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for d, t in docs:
        for i, x in items:
            n, k = D.normal(x), D.budget(len(D.normal(x)))
            if n and k and (e := distance(n, D.normal(t))) <= k:
                want[d, i] = e
            elif n and not k and f" {n} " in f" {D.normal(t)} ":
                want[d, i] = 0
    assert got == want and len(want) > 20


def test_items_in_the_documents_are_found(spark):
    rows = texts("sf0.001")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(m.doc_id, m.item_id) for m in D.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    exact = {(i, b.item_id) for b in bench.collect() for i, t in rows if D.normal(b.text) and D.normal(b.text) in D.normal(t)}
    assert exact <= got


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.createDataFrame(texts("sf0.001"), "doc_id long, text string")
    whole, kept = sorted(map(tuple, D.matches(docs, bench).collect())), docs.count()
    kept = sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK_CHARS", 3_000)
    assert sorted(map(tuple, D.matches(docs, bench).collect())) == whole
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == kept
    assert set(kept) == {i for i, _ in texts("sf0.001")} - {m[0] for m in whole}


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, prose(2, 80)), (None, prose(3, 80)), (2, None), (3, ""), (4, "?!")], "item_id long, text string")
    got = sorted(((m.doc_id, m.item_id, m.distance) for m in D.matches(edge_docs, items).collect()), key=repr)
    assert got == sorted([(50, 1, 0), (50, 1, 0), (51, 1, 0), (None, None, 0)], key=repr)
    kept = D.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 4
    none = items.where("false")
    assert D.matches(edge_docs, none).count() == 0 and D.drop_contaminated(edge_docs, none).count() == edge_docs.count()
    assert D.matches(no_docs, items).count() == 0 and D.drop_contaminated(no_docs, items).count() == 0


@pytest.mark.parametrize(("n", "k"), [(40, 2), (41, 5), (7, 6)])
def test_pieces_cover_the_item(n, k):
    item = "".join(chr(97 + i % 26) for i in range(n))
    got = D.pieces(item, k)
    assert len(got) == k + 1 and "".join(p for _, p in got) == item and all(item.startswith(p, o) and p for o, p in got)
