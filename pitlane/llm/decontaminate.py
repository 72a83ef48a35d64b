"""Benchmark decontamination: pigeonhole edit matching.

Texts and items are normalised (lower case, runs of other characters than letters and digits
become one space). An item of length L may stand in a text with up to k = L * rate edits; it is
split into k + 1 pieces, of which at least one must then stand there unchanged. One automaton
over the distinct pieces of a block of items finds all piece hits in a pass over the text, and
the windows around the hits, merged where they overlap, are verified by Myers' bit-parallel
distance against the whole item.

The items go to the tasks in blocks of at most ``BLOCK_CHARS`` normalised characters; a larger
benchmark takes more passes, never a larger broadcast.

Defined results: null or empty texts match nothing; items without a letter or digit match
nothing; equal items each match; a repeated row gives repeated matches; of several places the
one with the least distance, then the first one, counts; null ids are kept; extra columns
are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import bounded_batches, parts_for, table, texts_of

#: Edits allowed per character of the normalised item.
ERROR_RATE = 0.07
#: Items shorter than this many characters must stand in a text exactly, between word edges.
LEAST_CHARS = 40
BLOCK_CHARS = 2_000_000

_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower-cased letters and digits, other runs as one space."""
    return _OTHER.sub(" ", text.lower()).strip() if text else ""


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits that an item of this length may have."""
    return int(length * rate) if length >= LEAST_CHARS else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of the item in k + 1 parts that differ by one character at most."""
    n, parts = len(item), k + 1
    ends = [n * p // parts for p in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` within ``text`` (free start and end),
    the first of equals; None beyond ``most`` edits."""
    m = len(pattern)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, None
    for at, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & mask), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Matcher:
    """All items of a block, ready to search texts for."""

    def __init__(self, items: list[tuple[object, str]], rate: float = ERROR_RATE):
        import ahocorasick

        self.items = [(i, t, budget(len(t), rate)) for i, t in items if t]
        self.automaton = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, t, k) in enumerate(self.items):
            for off, piece in pieces(t, k) if k else [(0, f" {t} ")]:
                at[piece].append((n, off))
        for piece, where in at.items():
            self.automaton.add_word(piece, (len(piece), where))
        if at:
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[tuple[object, int, int]]:
        """(item id, distance, end in the normalised text) of the items in a text."""
        if not self.items or not (t := normal(text)):
            return []
        windows: dict[int, list[list[int]]] = {}
        found: dict[int, tuple[int, int]] = {}
        padded = f" {t} "
        for end, (length, where) in self.automaton.iter(padded):
            start = end - length + 1 - 1  # in t
            for n, off in where:
                _, item, k = self.items[n]
                if not k:
                    found.setdefault(n, (0, start + 1 + len(item)))
                    continue
                lo, hi = max(0, start - off - k), min(len(t), start - off + len(item) + k)
                spans = windows.setdefault(n, [])
                if spans and lo <= spans[-1][1] and lo >= spans[-1][0]:
                    spans[-1][1] = max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
        for n, spans in windows.items():
            _, item, k = self.items[n]
            for lo, hi in spans:
                got = myers(item, t[lo:hi], k)
                if got and (n not in found or got[0] < found[n][0]):
                    found[n] = (got[0], lo + got[1])
        return [(self.items[n][0], d, e) for n, (d, e) in sorted(found.items())]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The normalised items, in lists of at most about ``BLOCK_CHARS`` characters: a list is
    read when its pass is planned, and is all that a pass broadcasts."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = parts_for(total, BLOCK_CHARS // 2)
    for block in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else items
        yield [(r["item_id"], normal(r["text"])) for r in mine.orderBy("item_id", "text").collect()]


def matches(
    docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns of each document with item_id, distance and end for each item in it."""
    src = docs.select(*keep, docs[text].cast("string").alias("__leak_text"))
    kinds = dict(src.dtypes)
    ddl = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"item_id {dict(benchmark.dtypes)['item_id']}, distance int, end long"])
    context = docs.sparkSession.sparkContext

    def searched(items: list[tuple[object, str]]) -> DataFrame:
        sent = context.broadcast(items)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            match = Matcher(sent.value, rate)
            for b in batches:
                hits = [(at, *hit) for at, t in enumerate(b["__leak_text"]) for hit in match(t)]
                out = b[list(keep)].iloc[[h[0] for h in hits]].reset_index(drop=True)
                for k, c in enumerate(("item_id", "distance", "end"), 1):
                    out[c] = [h[k] for h in hits]
                yield out

        return src.mapInPandas(run, ddl)

    return reduce(DataFrame.unionAll, map(searched, _blocks(benchmark)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text: str = "text") -> DataFrame:
    """The documents in which no item stands: one pass over the rows for each block of items,
    without a join or a shuffle, in batches bounded by bytes."""
    context = docs.sparkSession.sparkContext
    bounded_batches(docs.sparkSession)
    for items in _blocks(benchmark):
        sent = context.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            match = Matcher(sent.value, rate)
            for b in batches:
                yield b.filter(pa.array([not match(t) for t in texts_of(b, text)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, distance, end) for all documents and benchmark items."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
