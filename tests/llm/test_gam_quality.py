import math
import re

import numpy as np

from pitlane.llm import gam_quality as G

from .conftest import EDGES, prose
from .llm_data import data, texts

LABELS = "doc_id long, quality int, toxic int"


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(data("sf0.1", t)) for t in ("documents", "labels"))
    got = G.quality_scores(docs, labels)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").where("held_out").toPandas()
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.98
    assert (held["predicted"] == held["quality"]).mean() > 0.97


def test_scores_are_the_sums_of_the_tables():
    r = np.random.default_rng(0)
    x = r.normal(size=(600, len(G.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # only a pair can tell
    m = G.fit(x, y, rounds=40)
    assert (0, 1) in m.pairs and ((m.score(x) > 0.5) == y).mean() > 0.85
    row, total = x[7], m.intercept
    for k, t in enumerate(m.tables):
        total += t[sum(row[k] >= c for c in m.cuts[k])]
    for (i, j), t in zip(m.pairs, m.pair_tables):
        total += t[sum(row[i] >= c for c in m.pair_cuts[i]), sum(row[j] >= c for c in m.pair_cuts[j])]
    assert np.isclose(m.margin(x)[7], total)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = (spark.read.parquet(data("sf0.01", t)) for t in ("documents", "labels"))
    a = sorted(map(tuple, G.quality_scores(docs, labels).collect()))
    turned = labels.withColumn("quality", G.F.when(G.fold("doc_id", 5) == 0, 1 - G.F.col("quality")).otherwise(G.F.col("quality")))
    b = sorted(map(tuple, G.quality_scores(docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source"), turned).collect()))
    assert a == b


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(3, 0, 0), (6, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (2, None, None), (999, 1, 1)], LABELS)
    got = {r.doc_id: r for r in G.quality_scores(edge_docs, labels).collect()}
    assert len(got) == len(EDGES) + 3 and all(0 <= r.score <= 1 for r in got.values())
    assert got[0].score == got[1].score == got[2].score
    assert G.quality_scores(no_docs, labels).count() == 0
    none = G.quality_scores(edge_docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    one_class = G.quality_scores(edge_docs, spark.createDataFrame([(k, 1, 0) for k in range(8)], LABELS)).collect()
    assert len({r.score for r in one_class}) == 1 and one_class[0].score > 0.5
    kept = G.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert G.features(None) == G.features("") == [0.0] * len(G.FEATURES) and len(G.features(prose(1, 5))) == len(G.FEATURES)


def plain_features(text):
    """The features by their names, character by character and word by word."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return [0.0] * len(G.FEATURES)
    n, chars = len(words), sum(len(w) for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    grams = [tuple(words[k : k + 4]) for k in range(n - 3)]
    cased = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0xDF) if c != 0xD7}
    return [
        math.log1p(n), chars / n, len(set(words)) / n, max(words.count(w) for w in set(words)) / n,
        sum(len(w) <= 3 for w in words) / n, sum(len(w) >= 12 for w in words) / n,
        sum(not (c.isalnum() or c == "_" or c.isspace() or c in ".,") for c in text) / chars,
        sum(c in cased for c in text) / chars, sum(c in "0123456789" for c in text) / chars,
        sum(w.upper() == w.lower() for w in words) / n, n / (1 + sum(c in ".!?" for c in text)), n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(grams)) / len(grams) if grams else 0.0,
    ]


def test_whole_query_equals_the_plain_version(spark):
    docs, labels = (spark.read.parquet(data("sf0.001", t)) for t in ("documents", "labels"))
    m = G.fit_quality(docs, labels)
    got = {r.doc_id: r for r in G.op6_quality_gam(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == 200
    for i, t in texts("sf0.001"):
        if len(t or "") > 20_000:
            continue  # the plain count of words is quadratic
        x = [round(v, 9) for v in plain_features(t)]
        z = m.intercept + sum(table[sum(v >= c for c in cuts)] for v, cuts, table in zip(x, m.cuts, m.tables))
        for (a, b), table in zip(m.pairs, m.pair_tables):
            z += table[sum(x[a] >= c for c in m.pair_cuts[a]), sum(x[b] >= c for c in m.pair_cuts[b])]
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-z)), rel_tol=1e-9), i
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_a_tree_takes_the_best_cuts():
    r = np.random.default_rng(3)
    for _ in range(20):
        g, h = r.normal(size=9), r.uniform(1, 3, 9)

        def leaf(lo, hi):
            return g[lo:hi].sum() ** 2 / (h[lo:hi].sum() + 1)

        tree = G._tree(g, h, depth=1)
        gains = [leaf(0, k) + leaf(k, 9) - leaf(0, 9) for k in range(1, 9)]
        k = int(np.argmax(gains)) + 1
        if gains[k - 1] > 1e-9:
            want = [g[:k].sum() / (h[:k].sum() + 1)] * k + [g[k:].sum() / (h[k:].sum() + 1)] * (9 - k)
            assert np.allclose(tree, want)
