import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlane.llm import packing as P

from .conftest import EDGES
from .llm_data import data, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_gives_the_ids_of_tokenizers(tokenizer):
    encoder = P.load_encoder(PATH)
    odd = ["<|endoftext|> x", "it's  \r\n we'll\t", "a" * 3000, "😀 ß 日本語 \x00", " " * 500 + "x", "١٢٣ ²½"]
    for t in [x for _, x in texts("sf0.001")] + odd + [x for x in EDGES if x and len(x) < 70_000]:
        assert encoder.encode_to_numpy(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def pieces_of(ids, most=2048):
    first = len(ids) % most
    cuts = ([(0, first)] if first else []) + [(s, most) for s in range(first, len(ids), most)]
    return [(k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]


def check(packed, rows, tokenizer):
    want = sorted((i, *p) for i, t in rows for p in pieces_of(tokenizer.encode(t or "", add_special_tokens=False).ids + [0]))
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert got == want
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    return len(by), sum(r.length for r in packed)


def test_round_trip_and_density(spark, tokenizer):
    rows = texts("sf0.01")
    packed = P.pack_documents(spark.read.parquet(data("sf0.01", "documents")), PATH).collect()
    n, tokens = check(packed, rows, tokenizer)
    assert n <= -(-tokens // 2048) * 1.01 + 1


def test_edges(edge_docs, no_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in edge_docs.where("doc_id is not null").collect()]
    packed = P.pack_documents(edge_docs, PATH).collect()
    want = sorted((i, *p) for i, t in rows for p in pieces_of(tokenizer.encode(t or "", add_special_tokens=False).ids + [0]))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in packed) == 1
    assert P.pack_documents(no_docs, PATH).count() == 0


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "  <|endoftext|>\n\n<|endoftext|> ", "<|endoftext| >", "é<|endoftext|>" + " word" * 3000]


def test_added_tokens_are_those_of_tokenizers_at_its_defaults(spark):
    plain = Tokenizer.from_file(PATH)
    assert plain.encode(ADDED[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    ids_of = P.load_ids(PATH)
    for t in ADDED + [x for x in EDGES if x and len(x) < 70_000]:
        assert ids_of(t).tolist() == plain.encode(t, add_special_tokens=False).ids
    rows = list(enumerate(ADDED))
    check(P.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), rows, plain)


M = 1_200_000
GAPS = [
    " " * M + "x", "a" + " " * M, "\n" * M + "1", " \r\n\t" * (M // 4) + "!", "é" + "\u3000" * M + "ß" + " " * M + "\n." + "\x85" * M,
    " " * M + "<|endoftext|>" + " " * M + "\nend", " " * 20_000 + "a" + "\n" * 20_000 + " b" + " " * M + " it's " + " " * 9_999 + "c", "\x1c" * M + " x",
]


def test_long_white_space(spark):
    plain = Tokenizer.from_file(PATH)
    ids_of = P.load_ids(PATH)
    for t in GAPS:
        assert ids_of(t).tolist() == plain.encode(t, add_special_tokens=False).ids
    assert len(ids_of(" " * 6_000_000)) > 0
    rows = [(0, GAPS[0]), (1, "one"), (2, GAPS[5])]
    check(P.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), rows, plain)


def test_sequences_hold_the_ids(spark, tokenizer):
    df = spark.createDataFrame([(1, "one two"), (2, "three"), (3, None)], "doc_id long, text string")
    seqs = P.sequences(P.pack_documents(df, PATH, with_ids=True)).collect()
    flat = [x for s in seqs for x in np.frombuffer(bytes(s.ids), "<u4").tolist()]
    assert sorted(flat) == sorted(tokenizer.encode("one two").ids + [0] + tokenizer.encode("three").ids + [0, 0])


def test_the_fullest_bin_closes_first():
    bins = P.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # bin 1 (free 3) closed for bin 2
    assert bins.put(3) == (0, 6)  # not bin 1, though it would have fitted best
    assert bins.put(2) == (2, 8)


def test_cut_puts_the_rest_first():
    assert P.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)] and P.cut(4096) == [(0, 2048), (2048, 2048)] and P.cut(1) == [(0, 1)]


def test_repeated_rows_are_dealt_over_the_parts(spark):
    docs = spark.createDataFrame([(None, "")] * 4000 + [(7, "the same text")] * 1000, "doc_id long, text string")
    pieces = P.materialize(P.token_pieces(docs, PATH, with_ids=False).withColumn(P._ROW, F.monotonically_increasing_id()), "pieces")
    packed = P.best_fit_pack(pieces, 8)
    assert P._ROW not in packed.columns
    by_part = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 40)).count().collect()]
    assert sum(by_part) == 5000 and len(by_part) == 8 and max(by_part) < 900
