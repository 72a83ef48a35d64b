import corpus_pipeline as C

from pitlane.llm import decontaminate as D
from pitlane.llm.common import materialize, table
from pitlane.llm.registry import QUERIES

from .test_jaccard_join import brute as brute_classes
from .test_secrets import brute as brute_secrets

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in C.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)

    def rows(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    before, after = kept["quality"]
    labels = table(spark, SF, "labels")
    bad, good = ({r.doc_id for r in labels.where(f"quality = {q}").collect()} for q in (0, 1))
    ids = {i for i, _ in rows(after)}
    assert len(good - ids) <= 0.01 * len(good) and len(bad & ids) <= 0.05 * len(bad)

    before, after = kept["near_duplicates"]
    assert sorted(i for i, _ in rows(after)) == sorted(i for i, c, _ in brute_classes(rows(before)) if i == c)

    before, after = kept["decontamination"]
    items = [D.normal(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaky = {i for i, t in rows(before) if any(x and x in D.normal(t) for x in items)}
    ids = {i for i, _ in rows(after)}
    assert leaky and not leaky & ids and len(ids) >= len(rows(before)) - len(leaky) - 5

    before, after = kept["secret_scan"]
    old, new = dict(rows(before)), dict(rows(after))
    assert old.keys() == new.keys()
    assert all(brute_secrets(t) == "" for t in new.values()) and all(new[i] == t for i, t in old.items() if brute_secrets(t) == "")
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = kept["packing"]
    assert {r.doc_id for r in after.collect()} == set(new)


def test_an_empty_table_goes_through(spark):
    docs = table(spark, SF, "documents").where("false")
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-empty-{name}")
        assert docs.count() == 0


def test_edges_go_through(spark, edge_docs):
    docs = edge_docs
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-edge-{name}")
    assert docs.count() >= 1


def test_one_query_for_each_operator():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secret_scan", "packing"]
