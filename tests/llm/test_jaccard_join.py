import random
import re
from collections import defaultdict

import numpy as np

from pitlane.llm import jaccard_join as J

from .conftest import EDGES, prose
from .llm_data import texts


def shingles(text):
    """Runs of five words; a shorter text is one."""
    words = re.findall(r"\w+", text.lower()) if text else []
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, class_id, n_links) from all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    root, links, where = list(range(len(rows))), [0] * len(rows), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for h in s:
            for o in where[h]:
                shared[o] += 1
            where[h].append(k)
        for o, m in shared.items():
            if m >= 0.8 * (len(s) + len(sets[o]) - m):
                links[k] += 1
                links[o] += 1
                root[find(k)] = find(o)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def near(text, edits, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(999)}"
    return " ".join(w)


def test_equals_brute_force_on_documents_and_a_large_group(spark):
    base = prose(9, 200)
    rows = texts("sf0.001")
    rows += [(10_000 + k, near(base, k % 9, k)) for k in range(120)]  # a group of near copies around the threshold
    rows += [(20_000 + k, base) for k in range(60)]  # and of exact ones
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in J.jaccard_join(df).collect())
    assert got == brute(rows)
    # Blocks far smaller than the groups give the same result.
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in J.jaccard_join(df, block=16).collect())
    assert got == brute(rows)


def test_edges(edge_docs, no_docs):
    got = J.jaccard_join(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    for k, t in enumerate(EDGES):
        if not J.Shingler()(t).size:
            assert (by[k].class_id, by[k].n_links) == (k, 0)
    assert (by[50].class_id, by[50].n_links, by[50].n_copies) == (50, 2, 3) and by[51].class_id == 50
    assert by[None].class_id is None and by[None].n_links == 0
    assert J.jaccard_join(no_docs).count() == 0


def test_keep_one_keeps_one_of_each_class_and_all_without_words(spark, edge_docs, no_docs):
    kept = J.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == [*range(len(EDGES)), 50] and kept.where("doc_id is null").count() == 1
    assert J.keep_one(no_docs).count() == 0
    rows = [(k, near(prose(5, 100), 1, k)) for k in range(6)] + [(None, prose(5, 100)), (9, "²"), (9, "²"), (10, "́")]
    ids = [r.doc_id for r in J.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(ids) == [0, 9, 10]


def test_pruning_never_drops_similar_signatures():
    need = J.least_matches()
    assert all(0 < n < s for n, s in zip(need[1:], range(J.STEP, J.HASHES + 1, J.STEP)))
    assert need[-1] < 0.8 * J.HASHES  # a pair at the threshold passes with its expected matches


def test_shared_shingles_by_pairs_and_by_product(monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 64)  # several blocks of columns
    r = random.Random(4)
    sets = [np.unique(np.array([r.randrange(400) for _ in range(r.randint(1, 300))], np.uint64)) for _ in range(40)]
    i, j = np.triu_indices(40, 1)
    want = [len({*sets[a].tolist()} & {*sets[b].tolist()}) for a, b in zip(i, j)]
    assert J.shared_shingles(sets, i, j).tolist() == want  # many pairs
    assert J.shared_shingles(sets, i[:50], j[:50]).tolist() == want[:50]  # few


def test_a_pair_survives_in_the_first_band_it_shares_only():
    r = np.random.default_rng(1)
    a = r.integers(0, 256, (60, J.HASHES)).astype(np.uint8)
    b = a.copy()
    b[r.random(b.shape) < 0.15] ^= 1  # near copies
    keys_a, keys_b = J.bands_of(a), J.bands_of(b)
    for k in range(60):
        common = np.flatnonzero(keys_a[k] == keys_b[k])
        found = [band for band in range(J.BANDS) if len(J.surviving_pairs(a[k : k + 1], b[k : k + 1], band, False)[0]) and band in common]
        assert found == common[:1].tolist()


def test_a_large_group_is_written_as_nodes_not_pairs(spark, monkeypatch):
    base, seen = prose(11, 120), []
    rows = [(k, near(base, 2, k)) for k in range(700)]
    keep = J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, label: seen.append((label, keep(df, label))) or seen[-1][1])
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block=64).collect())
    assert got == brute(rows)
    found = dict(seen)["candidates"]
    assert not [t for _, t in found.dtypes if t.startswith("array")]
