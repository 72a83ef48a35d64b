"""N-gram Jaccard self-join with Bayesian candidate pruning.

Words are lower-cased ``\\w+`` runs, shingles five consecutive words (a shorter text is one
shingle), similar texts have Jaccard similarity of at least 0.8.

1. Exact copies fold into one node, the md5 of the text; every later step runs on nodes.
2. A node's signature is 240 one-byte MinHash values; 40 bands of 6 propose candidates (a pair
   at 0.8 is missed with probability 5e-6, one at 0.85 with 6e-9).
3. Buckets with two nodes or more are split into blocks of at most ``block`` nodes, and each
   pair of blocks is one unit of work, so neither a hot passage nor a huge group of near
   copies lands in one task. A pair is handled in the first band that it shares only.
4. Within a unit the signatures are compared 48 values at a time; a pair whose posterior
   probability of reaching 0.8 falls below ``tolerance`` is dropped, and so is one that turns out to
   share an earlier band. Only the nodes that are left in some pair are written, with their
   signatures: the pairs are found again from these where the texts are, and never written.
5. What is left is verified on the whole texts' shingle sets, in a unit of many near copies by one
   product of its node x shingle incidence. A unit gives each node's number of linked documents and
   the least node that its links join it to, never all pairs.
6. Classes are the connected components of the links, by distributed label propagation over
   written tables; nothing is gathered on the driver but the number of changed rows.

Defined results: a null text or one without a word has no shingle, links to nothing and is a
class of its own; repeated rows are copies of one another; only the id and text columns are
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import materialize, table, texts_of, whole_groups

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
STEP = 48  # whole bands
TOLERANCE = 1e-6
BLOCK = 512
#: Shingles of a unit that are multiplied at once: bounds the matrix.
COLUMNS = 8192
_WORD = re.compile(r"\w+")
_M = np.uint64(0xFF51AFD7ED558CCD)


def _word_hash(w: str) -> int:
    return int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Shingler:
    """Distinct 64-bit shingle hashes of texts; remembers words' hashes within a task."""

    def __init__(self, words: int = WORDS, remembered: int = 1 << 17):
        self.words, self.remembered, self.known = words, remembered, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = _WORD.findall(text.lower()) if text else []
        if not found:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        try:
            codes = [known[w] for w in found]
        except KeyError:
            for w in found:
                if w not in known:
                    known[w] = _word_hash(w)
            codes = [known[w] for w in found]
        h = np.array(codes, np.uint64)
        n = max(1, len(h) - self.words + 1)
        out = np.full(n, np.uint64(len(h) if len(h) < self.words else self.words), np.uint64)
        for k in range(min(self.words, len(h))):
            out = (out ^ h[k : k + n]) * _M
            out ^= out >> np.uint64(29)
        return np.unique(out)


@lru_cache(1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-byte MinHash values of non-empty shingle sets, a row for each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint8)
    for k, a in enumerate(_multipliers()):
        out[:, k] = (np.minimum.reduceat(flat * a, starts) >> np.uint64(24)).astype(np.uint8)
    return out


def bands_of(sig: np.ndarray) -> np.ndarray:
    """The 64-bit bucket keys of signatures: 6 bytes of values and the band's number."""
    b = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), b.shape[:2]).copy()
    for k in range(ROWS):
        key = (key << np.uint64(8)) | b[:, :, k]
    return key.view(np.int64)


@lru_cache(8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For 0, STEP, 2 STEP ... values compared: the fewest matches a pair may have.

    The similarity has a uniform prior; a one-byte value matches with probability
    s + (1 - s) / 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = [0]
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        post = np.exp(log - log.max(axis=1, keepdims=True))
        tail = post[:, s >= threshold].sum(axis=1) / post.sum(axis=1)
        out.append(int(np.argmax(tail >= tolerance)))
    return np.array(out)


def surviving_pairs(a: np.ndarray, b: np.ndarray, band: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of a, j of b) that share no earlier band and keep a posterior above the
    tolerance; i < j if both blocks are the same one."""
    i, j = np.triu_indices(len(a), 1) if same else (x.ravel() for x in np.indices((len(a), len(b))))
    need = least_matches()
    matches = np.zeros(len(i), np.int32)
    for k, lo in enumerate(range(0, HASHES, STEP), 1):
        earlier = min(STEP // ROWS, max(0, band - lo // ROWS))  # bands before this one among the compared
        keep = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 16):  # in slices: bounded memory
            s = slice(at, at + (1 << 16))
            equal = a[i[s], lo : lo + STEP] == b[j[s], lo : lo + STEP]
            matches[s] += equal.sum(axis=1, dtype=np.int32)
            keep[s] = matches[s] >= need[k]
            if earlier:
                keep[s] &= ~equal[:, : earlier * ROWS].reshape(-1, earlier, ROWS).all(axis=2).any(axis=1)
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def _sketch(docs: DataFrame) -> DataFrame:
    """node (md5), n rows of it, signature - of the texts with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            group, rows, size = [], [], 0
            for at, t in enumerate(texts_of(b, "text")):
                s = shingler(t)
                if len(s):
                    group.append(s)
                    rows.append(at)
                    size += len(s)
                if group and (size > 1 << 16 or at + 1 == b.num_rows):
                    sig = pa.array([x.tobytes() for x in signatures(group)], pa.binary())
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), sig], ["node", "sig"])
                    group, rows, size = [], [], 0

    return docs.mapInArrow(run, "node binary, sig binary")


def _band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for all bands of each node."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                sig = np.frombuffer(b"".join(b["sig"]), np.uint8).reshape(len(b), HASHES)
                yield pd.DataFrame({"keys": list(bands_of(sig)), "node": b["node"]})

    rows = nodes.select("node", "sig").mapInPandas(run, "keys array<long>, node binary")
    return rows.select(F.explode("keys").alias("key"), "node")


def _unit_pairs(sig: np.ndarray, blk: np.ndarray, key: int, bi: int, bj: int) -> tuple[np.ndarray, np.ndarray]:
    """Surviving pairs of a unit's nodes, by their places."""
    left = np.flatnonzero(blk == bi)
    right = left if bi == bj else np.flatnonzero(blk == bj)
    i, j = surviving_pairs(sig[left], sig[right], key >> 48, bi == bj)
    return left[i], right[j]


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), HASHES)


def _candidates(units: DataFrame) -> DataFrame:
    """Units of (key, bi, bj) with signatures: the nodes that are in a surviving pair."""
    columns = ["key", "bi", "bj", "blk", "node", "n", "doc_id", "sig"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, bounds in whole_groups(batches, ["key", "bi", "bj"]):
            all_sig = _signatures(frame["sig"])
            key, bi, bj, blk = (frame[c].to_numpy() for c in ("key", "bi", "bj", "blk"))
            take = []
            for lo, hi in zip(bounds, bounds[1:]):
                if hi - lo > 1:
                    i, j = _unit_pairs(all_sig[lo:hi], blk[lo:hi], int(key[lo]), bi[lo], bj[lo])
                    take += (np.union1d(i, j) + lo).tolist()
            if take:
                yield frame.iloc[take][columns].reset_index(drop=True)

    kinds = dict(units.dtypes)
    return units.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def shared_shingles(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair have in common."""
    if len(i) <= 4 * len(sets):
        out = np.empty(len(i), np.int64)
        for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
            both = np.concatenate([sets[x], sets[y]])
            both.sort()
            out[k] = (both[1:] == both[:-1]).sum()
        return out
    # Many pairs of few nodes: the product of the incidence matrix with itself, some columns at a time.
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = seen[column] > 1  # others are in no pair's intersection
    row, column = row[common], column[common]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers below 2^24: exact
    for first in range(0, len(seen), COLUMNS):
        lo, hi = np.searchsorted(column, [first, first + COLUMNS])
        if hi > lo:
            part, at = np.unique(column[lo:hi], return_inverse=True)
            block = np.zeros((len(sets), len(part)), np.float32)
            block[row[lo:hi], at] = 1
            total += block @ block.T
    return total[i, j].astype(np.int64)


def _links(nodes: list[bytes], n: np.ndarray, sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> list[tuple]:
    """(node, linked documents, least node joined to) of a unit's nodes, in their order, with a link."""
    size = np.array([len(s) for s in sets])
    near = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
    i, j = i[near], j[near]
    shared = shared_shingles(sets, i, j)
    linked = shared >= threshold * (size[i] + size[j] - shared)
    i, j = i[linked], j[linked]
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, i, n[j])
    np.add.at(links, j, n[i])
    root = np.arange(len(nodes))
    while True:  # the least place among neighbours, and what that one has already found
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        root = root[root]
        if (root == before).all():
            break
    return [(nodes[k], int(links[k]), nodes[root[k]]) for k in np.flatnonzero(links).tolist()]


def _verified(units: DataFrame, threshold: float) -> DataFrame:
    """Units with signatures and texts: per node its number of linked documents and the least
    node that the unit's links join it to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for frame, bounds in whole_groups(batches, ["key", "bi", "bj"]):
            key, bi, bj, blk, n, node, text = (frame[c].to_numpy() for c in ("key", "bi", "bj", "blk", "n", "node", "text"))
            out: list[tuple] = []
            for lo, hi in zip(bounds, bounds[1:]):
                # A repeated row of the table comes more than once, one after another: one counts.
                at = [k for k in range(lo, hi) if k == lo or node[k] != node[k - 1]]
                i, j = _unit_pairs(_signatures(frame["sig"].iloc[at]), blk[at], int(key[lo]), bi[lo], bj[lo])
                out += _links([bytes(node[k]) for k in at], n[at], [shingler(text[k]) for k in at], i, j, threshold)
            yield pd.DataFrame(out, columns=["node", "links", "to"])

    return units.mapInPandas(run, "node binary, links long, to binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the least node of each connected component, from edges (a, b).

    Large-star and small-star rounds until no edge changes; each round is a written table.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_m = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_m, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        e = materialize(small.where("a <> b").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = now


def _source(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """doc_id, node (md5 of the text; null for a null text) and text."""
    base = docs.select(docs[id_col].alias("doc_id"), docs[text].cast("string").alias("text"))
    return base.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")


def classes(src: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per node with a word: its least doc_id, n rows, links to documents of other nodes, and
    root, the least node of its connected component."""
    if threshold < THRESHOLD:
        raise ValueError(f"the bands are laid out for a threshold of {THRESHOLD} or more")
    sketched = _sketch(src.where("text is not null").select("node", "text"))
    counted = src.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))
    nodes = materialize(sketched.groupBy("node").agg(F.min("sig").alias("sig")).join(counted, "node"), "nodes")

    rows = _band_rows(nodes)
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    members = rows.join(size, "key").withColumn("blocks", blocks)
    members = members.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A node meets each block once; block pairs are named by (lower, higher).
    pairs = members.select("key", "node", "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("key", "node", "blk", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"))
    unit = ["key", "bi", "bj"]
    units = pairs.join(nodes, "node").repartition(*unit).sortWithinPartitions(*unit, "node")
    found = materialize(_candidates(units), "candidates")

    # A merge join at every size: the texts are shuffled once, by their digest.
    wanted = found.hint("merge").join(src.withColumnRenamed("doc_id", "of"), ["node"]).where(F.col("doc_id").eqNullSafe(F.col("of"))).drop("of")
    checked = materialize(_verified(wanted.repartition(*unit).sortWithinPartitions(*unit, "node"), threshold), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = nodes.select("node", "n", "doc_id").join(links, "node", "left").join(roots, "node", "left")
    return named.withColumns({"root": F.coalesce("root", "node"), "links": F.coalesce("links", F.lit(0))})


def jaccard_join(
    docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: ``class_id`` (the least id among the documents joined to it by
    links), ``n_links`` (documents with a similarity of ``threshold`` or more, copies
    included) and ``n_copies`` (documents with the same text, itself included)."""
    src = _source(docs, text, id_col)
    named = classes(src, threshold, block)
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    of_node = named.join(least, "root").select("node", "class_id", "n", "links")
    out = src.select("doc_id", "node").join(of_node, "node", "left")
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("n", F.lit(1)).alias("n_copies"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents less all but one of each class: the row with the least id (null ids last),
    then the least digest, stays. Documents without a word all stay."""
    src = _source(docs, text, id_col)
    named = materialize(classes(src, threshold).select("root", "node", "doc_id"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("node"))
    stays = named.groupBy("root").agg(F.min(order).alias("s")).select(F.col("s.doc_id").alias("__keep_id"), F.col("s.node").alias("node"))
    # How often the row that stays comes, by id and digest alone: no text is moved for it.
    times = src.where("node is not null").groupBy(F.col("doc_id").alias("of"), "node").agg(F.count(F.lit(1)).alias("__times"))
    stays = stays.join(times, "node").where(F.col("__keep_id").eqNullSafe(F.col("of"))).drop("of")
    verdict = named.select("node").join(stays, "node", "left").withColumnRenamed("node", "__keep_node")
    verdict = materialize(verdict, "verdicts")
    digest = F.unhex(F.md5(docs[text].cast("string")))
    judged = docs.withColumn("__keep_own", digest).join(verdict.hint("merge"), F.col("__keep_own") == F.col("__keep_node"), "left")
    stay = judged[id_col].eqNullSafe(F.col("__keep_id")) & F.col("__times").isNotNull()
    out = judged.where(F.col("__keep_node").isNull() | (stay & (F.col("__times") == 1))).select(docs.columns)
    if verdict.where("__times > 1").limit(1).count():
        out = out.unionAll(judged.where(stay & (F.col("__times") > 1)).dropDuplicates(["__keep_own"]).select(docs.columns))
    return out


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join over all documents."""
    return jaccard_join(table(spark, sf_dir, "documents"))
