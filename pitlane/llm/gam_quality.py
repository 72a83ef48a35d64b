"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees on one feature at a time (each tree is a piecewise constant
function of the feature's bins) learns one lookup table per feature; the strongest pairs, found
on the residuals, then get two-feature tables the same way. A document's score is the sum of
its bins' values, looked up for whole batches at once.

The model is fitted on the driver from at most ``max_rows`` labelled rows (an even hash sample
of the training folds) of numbers only; features and scores of all documents are computed on
the executors. Labels, language, source and id are never features.

Defined results: null and empty texts score like a text without words; labels of documents
that are not in the table, and null labels, are ignored; a document with several labels gives
several training rows; with no usable label every score is 0.5; with one class only, the score
is that class's smoothed frequency; repeated rows get equal scores; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import fold, labelled_sample, sigmoid, table, texts_of

#: Most labelled rows that the model is fitted on.
MAX_TRAIN_ROWS = 20_000
BINS = 32
ROUNDS = 120
RATE = 0.15
PAIRS = 6
PAIR_BINS = 8
CUT = 0.3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_SYMBOL = re.compile(r"[^\w\s.,]")
_ENDS = re.compile(r"[.!?]")

FEATURES = (
    "log_words", "mean_word", "distinct_ratio", "top_word_ratio", "short_ratio", "long_ratio", "symbol_ratio",
    "upper_ratio", "digit_ratio", "no_letter_ratio", "mean_sentence", "mean_line", "dup_line_ratio", "repeat_4gram_ratio",
)


def features(text: str | None) -> list[float]:
    """The feature values of one whole text."""
    t = text or ""
    words = _WORD.findall(t)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in t.split("\n") if x.strip()]
    quads = n - 3
    distinct_quads = len(set(zip(words, words[1:], words[2:], words[3:]))) if quads > 0 else 0
    return [
        float(np.log1p(n)),
        chars / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(c for w, c in counts.items() if len(w) <= 3) / n,
        sum(c for w, c in counts.items() if len(w) >= 12) / n,
        len(_SYMBOL.findall(t)) / chars,
        len(_UPPER.findall(t)) / chars,
        len(_DIGIT.findall(t)) / chars,
        sum(c for w, c in counts.items() if w.upper() == w.lower()) / n,
        n / (1 + len(_ENDS.findall(t))),
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        1 - distinct_quads / quads if quads > 0 else 0.0,
    ]


def with_features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and an array of feature values, for whole texts in batches."""
    return _add(docs, keep, text, "x array<double>", lambda x: pa.array(list(x), pa.list_(pa.float64())))


def _add(docs: DataFrame, keep: list[str], text: str, column: str, of) -> DataFrame:
    """The kept columns and one more, made from the rows' feature values.

    The kept columns, texts among them, never leave Arrow's buffers.
    """
    own = text in keep and dict(docs.dtypes)[text] == "string"
    src = docs.select(*keep) if own else docs.select(*keep, docs[text].cast("string").alias("__gam_text"))
    name, kinds = text if own else "__gam_text", dict(src.dtypes)
    added = column.split()[0].strip("`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in texts_of(b, name)]).reshape(b.num_rows, len(FEATURES))
            columns = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, of(np.round(x, 9))], [*keep, added])

    return src.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), column]))


@dataclass
class Gam:
    """Cut points and value tables per feature, tables of pairs, and the intercept."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, t in enumerate(self.tables):
            out += t[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[
                np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                np.searchsorted(self.pair_cuts[j], x[:, j], side="right"),
            ]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def _cuts(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.arange(1, bins) / bins))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0, least: float = 1.0) -> np.ndarray:
    """Values per bin of a shallow regression tree on ordered bins, from gradient sums."""
    out = np.zeros(len(g))

    def grow(lo: int, hi: int, level: int) -> None:
        G, H = g[lo:hi].sum(), h[lo:hi].sum()
        if level and hi - lo > 1:
            gl, hl = np.cumsum(g[lo : hi - 1]), np.cumsum(h[lo : hi - 1])
            gain = gl**2 / (hl + ridge) + (G - gl) ** 2 / (H - hl + ridge) - G**2 / (H + ridge)
            gain[(hl < least) | (H - hl < least)] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > 1e-9:
                grow(lo, lo + k + 1, level - 1)
                grow(lo + k + 1, hi, level - 1)
                return
        out[lo:hi] = G / (H + ridge)

    grow(0, len(g), depth)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Gam:
    """Cyclic boosting on the log loss; deterministic for given rows."""
    m = Gam()
    if not len(y):
        return m
    p = (y.sum() + 0.5) / (len(y) + 1)
    m.intercept = float(np.log(p / (1 - p)))
    d = x.shape[1]
    m.cuts = [_cuts(x[:, k], BINS) for k in range(d)]
    m.pair_cuts = [_cuts(x[:, k], PAIR_BINS) for k in range(d)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    if y.min() == y.max():
        return m
    bins = [np.searchsorted(m.cuts[k], x[:, k], side="right") for k in range(d)]
    margin = np.full(len(y), m.intercept)
    for _ in range(rounds):
        for k in range(d):
            q = sigmoid(margin)
            size = len(m.tables[k])
            step = rate * _tree(np.bincount(bins[k], y - q, size), np.bincount(bins[k], q * (1 - q), size))
            m.tables[k] += step
            margin += step[bins[k]]
    small = [np.searchsorted(m.pair_cuts[k], x[:, k], side="right") for k in range(d)]
    wide = [len(c) + 1 for c in m.pair_cuts]
    q = sigmoid(margin)

    def gain(i: int, j: int) -> float:
        cell = small[i] * wide[j] + small[j]
        g = np.bincount(cell, y - q, wide[i] * wide[j])
        h = np.bincount(cell, q * (1 - q), wide[i] * wide[j])
        return float((g**2 / (h + 1.0)).sum())

    ranked = sorted(((gain(i, j), i, j) for i in range(d) for j in range(i + 1, d)), key=lambda t: (-t[0], t[1:]))
    m.pairs = [(i, j) for _, i, j in ranked[:pairs]]
    m.pair_tables = [np.zeros((wide[i], wide[j])) for i, j in m.pairs]
    for _ in range(rounds // 4):
        for (i, j), t in zip(m.pairs, m.pair_tables):
            q = sigmoid(margin)
            cell = small[i] * wide[j] + small[j]
            g = np.bincount(cell, y - q, t.size).reshape(t.shape)
            h = np.bincount(cell, q * (1 - q), t.size).reshape(t.shape)
            # A two-level tree: the best cut on one feature, within each side a tree on the other.
            best = None
            for axis in (0, 1):
                gs, hs = (g, h) if axis == 0 else (g.T, h.T)
                for c in range(1, gs.shape[0]):
                    halves = [_tree(gs[s].sum(0), hs[s].sum(0), depth=1) for s in (slice(0, c), slice(c, None))]
                    worth = sum(float((gs[s].sum(0) * v).sum()) for s, v in zip((slice(0, c), slice(c, None)), halves))
                    if best is None or worth > best[0]:
                        best = (worth, axis, c, halves)
            if best is None:
                continue
            _, axis, c, (lo, hi) = best
            step = np.zeros(t.shape if axis == 0 else t.T.shape)
            step[:c], step[c:] = rate * lo, rate * hi
            step = step if axis == 0 else step.T
            t += step
            margin += step[small[i], small[j]]
    return m


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Gam:
    """The model, from the folds 1 to 4 of the labels."""
    train = labelled_sample(labels, "quality", 5, 0, max_rows)
    rows = with_features(docs.select("doc_id", "text").join(train, "doc_id"), ["doc_id", "y"])
    rows = rows.toPandas()
    if not len(rows):
        return Gam()
    rows["k"] = [tuple(v) for v in rows["x"]]
    rows = rows.sort_values(["doc_id", "y", "k"])
    return fit(np.array(rows["x"].tolist()), rows["y"].to_numpy(float))


def score_quality(docs: DataFrame, model: Gam, keep: list[str], text: str = "text", score: str = "score") -> DataFrame:
    """The kept columns and the score, by name ``score``."""
    return _add(docs, keep, text, f"`{score}` double", lambda x: pa.array(model.score(x), pa.float64()))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents whose score reaches ``cut``, columns unchanged."""
    scored = score_quality(docs, fit_quality(docs, labels), docs.columns, score="__gam_score")
    return scored.where(F.col("__gam_score") >= cut).select(docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    out = score_quality(docs, fit_quality(docs, labels), ["doc_id"])
    return out.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
