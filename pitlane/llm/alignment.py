"""Cross-tokenizer alignment: diagonal run skipping.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B); both cut the same
bytes, so a token is told by its end. Where ends of both meet, a group of A tokens and B tokens
closes. Most groups are one to one, and then the ends of both stand at a constant shift of their
indices: ``irregular_groups`` compares stretches of the end arrays at the current shift, in steps
that double while all ends agree and halve where one differs. What is left there is an irregular
group: the shorter side is followed token by token until both meet, and the shift is updated.

Each group links its last A token and its last B token, which end together, so one of both tokens'
bytes ends in the other's. Hence the number of id pairs that can ever be linked is bounded by the
vocabularies (``pair_bound``: about a million here) and not by the corpus: the corpus-wide counts
of pairs are a table of that size, which may be broadcast.

Defined results: null or empty texts, and texts that the tokens of A or of B do not spell byte for
byte, have no tokens: empty arrays, zeros and an empty digest. Null ids and repeated rows are kept,
other columns are not read; an empty table gives no rows. Whole texts are encoded, at any length;
strings of special tokens are ordinary text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlane.config import new_output_dir
from pitlane.llm.common import bounded_batches, table, texts_of
from pitlane.llm.packing import load_encoder, load_plain_ids

#: Characters of text whose results make one output batch, about: bounds what a task holds.
BATCH_CHARS = 1_000_000
#: Ends compared at first; the step doubles while they agree.
FIRST_STEP = 8
_SPACE = "\u2581"  # the piece vocabulary's sign for a space (fixed value)


class Alignment(NamedTuple):
    """Ids of both sides in order, and for each group how many of them it takes from each side."""

    a: np.ndarray
    b: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray


def irregular_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, A tokens, B tokens) of the groups that are not one to one. The ends (int64) rise
    strictly and the last ones are equal."""
    wide = 8  # bytes of an end: stretches are compared as bytes
    raw_a, raw_b = ends_a.tobytes(), ends_b.tobytes()
    a_list, b_list = ends_a.tolist(), ends_b.tolist()
    out, size = [], len(raw_a)
    i = j = spared = 0  # all before i and j is done; the shift is j - i; groups are i - spared
    while i * wide < size:
        x, y, step = i * wide, j * wide, FIRST_STEP * wide
        while raw_a[x : x + step] == raw_b[y : y + step]:  # a stretch of one-to-one groups
            x, y = x + step, y + step
            if x >= size:  # the last ends are equal, so both sides end here
                return out
            step *= 2
        while step > wide:  # the first difference is in this step: halve to it
            step >>= 1
            if raw_a[x : x + step] == raw_b[y : y + step]:
                x, y = x + step, y + step
        i, j = x // wide, y // wide
        x, y = i, j
        a, b = a_list[x], b_list[y]
        while a != b:
            if a < b:
                x += 1
                a = a_list[x]
            else:
                y += 1
                b = b_list[y]
        out.append((i - spared, x + 1 - i, y + 1 - j))
        spared += x - i
        i, j = x + 1, y + 1
    return out


class Pair:
    """Two tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        encoder = load_encoder(path_a)
        self.encode_a = load_plain_ids(path_a)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes = [self._bytes_a(encoder, k) for k in range(encoder.n_vocab)]
        self.b_bytes = [self._bytes_b(k) for k in range(self.pieces.vocab_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], "int64")
        self.b_len = np.array([len(x) for x in self.b_bytes], "int64")

    @staticmethod
    def _bytes_a(encoder, k: int) -> bytes:
        try:
            return encoder.decode_single_token_bytes(k)
        except KeyError:  # an id of an added token: never given here
            return b""

    def _bytes_b(self, k: int) -> bytes:
        piece = self.pieces.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(k) else piece.replace(_SPACE, " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """A's and B's ids of a space and a text; None if B's do not spell it (A's, over bytes, spell any)."""
        b = self.pieces.encode(text)  # adds the space itself
        text = f" {text}"
        if b"".join(map(self.b_bytes.__getitem__, b)) != text.encode():
            return None
        return self.encode_a(text).astype("<i4"), np.array(b, "<i4")

    def __call__(self, text: str | None) -> Alignment | None:
        """The alignment of both encodings of a space and the text; None if there are no tokens."""
        ids = self.encode(text) if text else None
        if ids is None:
            return None
        a, b = ids
        odd = irregular_groups(self.a_len[a].cumsum(), self.b_len[b].cumsum())
        at, in_a, in_b = np.array(odd, "int64").reshape(-1, 3).T
        groups = len(a) - int((in_a - 1).sum())
        a_sizes, b_sizes = np.ones(groups, "int32"), np.ones(groups, "int32")
        a_sizes[at], b_sizes[at] = in_a, in_b
        return Alignment(a, b, a_sizes, b_sizes)


@lru_cache(2)  # one for each worker process, not for each task
def load_pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def pair_bound(path_a: str, path_b: str) -> int:
    """How many id pairs can be linked at most: those of which one token's bytes end in the other's."""
    pair = load_pair(path_a, path_b)

    def suffixes(longer: list[bytes], of: list[bytes]) -> int:
        ids: dict[bytes, int] = {}
        for x in of:
            ids[x] = ids.get(x, 0) + 1
        return sum(ids.get(x[k:], 0) for x in longer for k in range(len(x)))

    return suffixes(pair.a_bytes, pair.b_bytes) + suffixes(pair.b_bytes, pair.a_bytes)


def aligned(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    fields: list[tuple[str, pa.DataType]],
    view: Callable[[Alignment | None], tuple],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The kept columns of each document with what ``view`` makes of its alignment (``fields``)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(*keep, docs[text].cast("string").alias("__align_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = load_pair(path_a, path_b)

        def made(b: pa.RecordBatch, first: int, rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)]
            kept = [b.column(k).slice(first, len(rows)) for k in range(len(keep))]
            return pa.RecordBatch.from_arrays([*kept, *columns], [*keep, *(name for name, _ in fields)])

        for b in batches:
            first, chars, rows = 0, 0, []
            for t in texts_of(b, "__align_text", rows=64):
                rows.append(view(align(t)))
                chars += len(t or "")
                if chars > BATCH_CHARS:
                    yield made(b, first, rows)
                    first, chars, rows = first + len(rows), 0, []
            if rows:
                yield made(b, first, rows)

    kinds = dict(src.dtypes)
    ddl = [f"`{c}` {kinds[c]}" for c in keep] + [f"`{name}` {_DDL[kind]}" for name, kind in fields]
    return src.mapInArrow(run, ", ".join(ddl))


_INTS = pa.list_(pa.int32())
_DDL = {pa.int64(): "long", pa.string(): "string", _INTS: "array<int>", pa.list_(pa.int64()): "array<long>"}
ARRAYS = [("a_ids", _INTS), ("b_ids", _INTS), ("a_sizes", _INTS), ("b_sizes", _INTS)]


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The alignment itself: both sides' ids, and the groups as how many ids they take of each."""
    return aligned(docs, path_a, path_b, ARRAYS, lambda x: tuple(x) if x else ([], [], [], []), text, keep)


@lru_cache(2)
def _words(size: int) -> np.ndarray:
    """For each separator (',', '|', ';') and id the text of both."""
    return np.array([f"{sep}{k}" for sep in ",|;" for k in range(size)], object)


def groups_text(x: Alignment) -> str:
    """The groups as ``a1,a2|b1;a3|b2,b3``."""
    size = int(max(x.a.max(), x.b.max())) + 1
    size = 1 << size.bit_length()  # few sizes, so few tables
    a_ends, b_ends = x.a_sizes.cumsum(), x.b_sizes.cumsum()
    a_words, b_words = x.a.astype("int64"), x.b.astype("int64")
    a_words[a_ends - x.a_sizes] += 2 * size  # the first A id of a group
    b_words[b_ends - x.b_sizes] += size  # its first B id
    line = np.empty(len(a_words) + len(b_words), "int64")  # group by group, A's ids and then B's
    line[np.arange(len(a_words)) + np.repeat(b_ends - x.b_sizes, x.a_sizes)] = a_words
    line[np.arange(len(b_words)) + np.repeat(a_ends, x.b_sizes)] = b_words
    return "".join(_words(size)[line].tolist())[1:]


def link_codes(x: Alignment, b_vocabulary: int) -> np.ndarray:
    """For each group the pair of ids that end it, as ``a * b_vocabulary + b``."""
    return x.a[x.a_sizes.cumsum() - 1].astype("int64") * b_vocabulary + x.b[x.b_sizes.cumsum() - 1]


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts, digest of the groups and link codes of each document, as a written table."""
    vocabulary = load_pair(path_a, path_b).pieces.vocab_size()
    narrow = load_encoder(path_a).n_vocab * vocabulary < 1 << 31
    codes = _INTS if narrow else pa.list_(pa.int64())
    kind = "int32" if narrow else "int64"

    def view(x: Alignment | None) -> tuple:
        if x is None:
            return 0, 0, 0, "", []
        return len(x.a), len(x.b), len(x.a_sizes), hashlib.sha256(groups_text(x).encode()).hexdigest(), link_codes(x, vocabulary).astype(kind)

    fields = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("links", codes)]
    path = new_output_dir(docs.sparkSession, "links")
    aligned(docs, path_a, path_b, fields, view).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def pair_counts(links: DataFrame, b_vocabulary: int) -> DataFrame:
    """(pair, n, best): every linked id pair, its links in all documents, and whether no pair of
    its B id has more. At most ``pair_bound`` rows."""
    counts = links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_b = Window.partitionBy(F.col("pair") % b_vocabulary)
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def link_scores(links: DataFrame, counts: DataFrame) -> DataFrame:
    """``links`` without its codes but with n_links, n_best and count_sum. The counts, bounded by
    the vocabularies, go to the tasks as sorted arrays."""
    known = counts.toArrow().sort_by("pair")
    sent = links.sparkSession.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))
    kept = [(c, kind) for c, kind in links.dtypes if c != "links"]
    names = [c for c, _ in kept] + ["n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for b in batches:
            at = b.schema.get_field_index("links")
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                codes = part.column(at)
                ends = np.concatenate([[0], np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False))])
                place = np.searchsorted(pair, codes.flatten().to_numpy())
                scores = [ends[1:] - ends[:-1]]
                for value in (best, n):
                    so_far = np.concatenate([[0], np.cumsum(value[place], dtype="int64")])
                    scores.append(so_far[ends[1:]] - so_far[ends[:-1]])
                columns = [part.column(part.schema.get_field_index(c)) for c, _ in kept]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(s, pa.int64()) for s in scores], names)

    ddl = ", ".join(f"`{c}` {kind}" for c, kind in kept)
    return links.mapInArrow(run, f"{ddl}, n_links long, n_best long, count_sum long")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between the byte-level and the piece vocabulary."""
    import public_tokenizers

    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    links = linked(table(spark, sf_dir, "documents"), path_a, path_b)
    counts = pair_counts(links, load_pair(path_a, path_b).pieces.vocab_size())
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return link_scores(links, counts).select(*columns)
