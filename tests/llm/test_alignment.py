import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pitlane.llm import alignment as A

from .conftest import EDGES, SCHEMA, keyed
from .llm_data import data, texts

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain_groups(ends_a, ends_b):
    """(A tokens, B tokens) of each group, by the set of common ends."""
    common = sorted(set(ends_a) & set(ends_b))
    at_a, at_b = [[e.index(c) + 1 for c in common] for e in (ends_a, ends_b)]
    steps = lambda x: [b - a for a, b in zip([0, *x], x)]
    return list(zip(steps(at_a), steps(at_b)))


@pytest.mark.parametrize("seed", range(60))
def test_irregular_groups_equal_the_common_ends(seed):
    r = random.Random(seed)
    n, share = r.randint(1, 200), r.choice([0.05, 0.5, 0.95])
    both = [k for k in range(1, n + 1) if r.random() < share]
    ends = [sorted({*both, n, *(k for k in range(1, n) if r.random() < r.choice([0.02, 0.3]))}) for _ in range(2)]
    want = plain_groups(*ends)
    got = A.irregular_groups(*(np.array(e, "int64") for e in ends))
    assert got == [(k, a, b) for k, (a, b) in enumerate(want) if (a, b) != (1, 1)]


def test_long_stretches_are_jumped_exactly():
    ends = np.arange(1, 1_000_001)
    assert A.irregular_groups(ends, ends) == []
    assert A.irregular_groups(np.delete(ends, 700_000), ends) == [(700_000, 1, 2)]


def test_ids_are_those_of_the_tokenizers():
    pair, plain, r = A.load_pair(PATH_A, PATH_B), Tokenizer.from_file(PATH_A), random.Random(7)
    plain.encode_special_tokens = True
    parts = ["a", "b", "the", " ", " ", "  ", "\n", "\t", "é", "日", "\xa0", "\u3000", ".", "'s", "<0x41>", "<s>", "\x00", "\x1c", "\x85", "1", "\r", "   ", "ing", "Z", "▁"]
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        got = pair.encode(t)
        if "▁" in t:
            assert got is None
        else:
            assert got[0].tolist() == plain.encode(" " + t, add_special_tokens=False).ids and got[1].tolist() == pair.pieces.encode(t), repr(t)


class Plain:
    """The contract from the tokenizers themselves, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATH_A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            self.bytes_a = {int(k): base64.b64decode(x) for x, k in map(bytes.split, f)}

    def piece(self, k):
        p = self.b.id_to_piece(k)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return None
        raw = (" " + text).encode()
        sides = []
        for ids, of in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a.get), (self.b.encode(text), self.piece)):
            tokens = [of(k) for k in ids]
            if b"".join(tokens) != raw:
                return None
            at, ends = 0, {}
            for k, x in zip(ids, tokens):
                at += len(x)
                ends[at] = k
            sides.append(ends)
        out, group = [], ([], [])
        for end in sorted({*sides[0], *sides[1]}):
            for side, ids in zip(sides, group):
                if end in side:
                    ids.append(side[end])
            if end in sides[0] and end in sides[1]:
                out.append(group)
                group = ([], [])
        return out

    def rows(self, docs):
        """COLUMNS of (id, text) rows."""
        found = [(i, self.groups(t)) for i, t in docs]
        count = Counter((a[-1], b[-1]) for _, g in found for a, b in g or ())
        most = defaultdict(int)
        for (_, b), n in count.items():
            most[b] = max(most[b], n)
        for i, g in found:
            if g is None:
                yield i, 0, 0, 0, 0, 0, 0, ""
                continue
            links = [(a[-1], b[-1]) for a, b in g]
            line = ";".join("|".join(",".join(map(str, x)) for x in pair) for pair in g)
            yield (
                i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(line.encode()).hexdigest(),
            )


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_query_equals_the_plain_version(spark, plain):
    got = A.op13_token_alignment(spark, "/root/testdata/sf0.001")
    assert got.columns == COLUMNS
    assert keyed(got) == sorted(plain.rows(texts("sf0.001")), key=repr)


ODD = ["<|endoftext|> x", "<s> </s> <unk> <0x41>", "▁ taken for a space", "it's  \r\n we'll\t", "  two before", "after  ", "\n x", "a\x00b", "١٢٣ ²½", " " * 30_000 + "x"]


def test_edges(spark, plain, edge_docs, no_docs, tmp_path):
    more = spark.createDataFrame([(100 + k, t, "en", "s", 0) for k, t in enumerate(ODD)], SCHEMA)
    docs = edge_docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    docs.withColumnsRenamed({}).selectExpr("*", "'x' AS links", "'x' AS pair", "1 AS n_a").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert keyed(A.op13_token_alignment(spark, str(tmp_path))) == sorted(plain.rows(rows), key=repr)
    no_docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert A.op13_token_alignment(spark, f"{tmp_path}/none").collect() == []


def test_special_tokens_are_text_and_other_spellings_have_none(plain):
    pair = A.load_pair(PATH_A, PATH_B)
    assert 50256 not in pair("x <|endoftext|> y").a.tolist()
    assert pair("▁") is None and pair("") is None and pair(None) is None


def test_a_run_of_a_million_spaces():
    x = A.load_pair(PATH_A, PATH_B)("a" + " " * 1_000_000 + "b")
    assert x.a_sizes.sum() == len(x.a) and x.b_sizes.sum() == len(x.b)


def test_arrays_spell_the_text_group_by_group(spark):
    pair = A.load_pair(PATH_A, PATH_B)
    df = spark.createDataFrame([(1, "Grüße, the quick-brown 日本語 fox"), (2, None)], "doc_id long, text string")
    one, none = A.align_tokens(df, PATH_A, PATH_B).orderBy("doc_id").collect()
    assert none.a_ids == none.b_ids == none.a_sizes == none.b_sizes == []
    i = j = 0
    for n, m in zip(one.a_sizes, one.b_sizes):
        left, right = (b"".join(of[k] for k in ids) for of, ids in ((pair.a_bytes, one.a_ids[i : i + n]), (pair.b_bytes, one.b_ids[j : j + m])))
        assert left == right
        i, j = i + n, j + m
    assert i == len(one.a_ids) and j == len(one.b_ids)


def test_linked_pairs_stay_within_the_bound(spark):
    links = A.linked(spark.read.parquet(data("sf0.01", "documents")), PATH_A, PATH_B)
    counts = A.pair_counts(links, 32_000).collect()
    pair = A.load_pair(PATH_A, PATH_B)
    assert len(counts) <= A.pair_bound(PATH_A, PATH_B) < 1_500_000
    for r in counts:
        a, b = pair.a_bytes[r.pair // 32_000], pair.b_bytes[r.pair % 32_000]
        assert a.endswith(b) or b.endswith(a)


def test_edge_texts_in_one_batch_each(monkeypatch, spark):
    monkeypatch.setattr(A, "BATCH_CHARS", 10)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(EDGES)], "doc_id long, text string").coalesce(1)
    assert A.align_tokens(df, PATH_A, PATH_B).count() == len(EDGES)
