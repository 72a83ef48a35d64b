"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the character n-grams (1 to 4) of its words with their edges marked,
lower-cased, hashed into ``buckets`` rows of an embedding table. Their mean, weighted by
their number in the text, goes through a linear layer and a softmax. Table and layer are
trained by stochastic gradient descent in numpy on a bounded hash sample that is even over the
languages and holds each of them. Since the layer is linear, the trained product (buckets x
languages) stands for both while there are at most ``DIM`` languages; beyond that the table keeps its ``DIM``
columns, so a model and what a task remembers of words have a bound whatever the number of languages.
A temperature fitted on a part of the sample that training did not see calibrates the
probabilities, and ``accepted`` is false below the score that only a small share of that part's
right answers has.

Defined results: a null text or one without a letter is ``und`` with score 0; rows without a
language are not learned from; a language of one row is learned from it; with no training row at all everything is ``und`` with score 0;
with one language that is the answer; ties go to the language first in order; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import fold, materialize, table

#: Bounds of the sample that is trained on, about: rows of a language, rows and characters in all (shared evenly by
#: the languages; each has a row at least), and characters of a text, of which a longer one gives its first.
ROWS_PER_LANG = 600
SAMPLE_ROWS = 24_000
SAMPLE_CHARS = 40_000_000
MAX_SAMPLE_CHARS = 20_000
#: Languages whose shares are broadcast to the rows; more are joined.
BROADCAST_LANGS = 100_000
BUCKETS = 1 << 17
DIM = 16
EPOCHS = 6
RATE = 0.5
#: Greatest share of one subword in a step: short texts would make the weights run away.
MOST_SHARE = 0.05
UND = "und"
#: Share of right answers that calibrated rejection may lose.
REJECT = 0.005

_LETTERS = re.compile(r"[^\W\d_]+")
_P = np.uint64(0x9E3779B97F4A7C15)


def _ngrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the 1- to 4-grams of a code point array whose words are parted by 32.

    A space may only be the first or last character of one: the edge of a word. A 1-gram of the
    final space is left out, so each word has its own n-grams and texts sum up their words.
    """
    c = codes.astype(np.uint64)
    space = codes == 32
    at = np.arange(len(c))
    hashes, starts = [(c * _P + np.uint64(1))[:-1]], [at[:-1]]
    h, inner = c, np.zeros(len(c), bool)
    for n in range(2, 5):
        if len(c) < n:
            break
        h = (h[:-1] * _P) ^ c[n - 1 :]
        if n > 2:
            inner = inner[: len(h)] | space[n - 2 : n - 2 + len(h)]
        else:
            inner = inner[: len(h)]
        hashes.append((h * _P + np.uint64(n))[~inner])
        starts.append(at[: len(h)][~inner])
    return np.concatenate(hashes), np.concatenate(starts)


def _buckets(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the subwords of words, and each subword's word."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    h, start = _ngrams(codes)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(buckets)).astype(np.int64), (np.cumsum(codes == 32) - 1)[start]


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; signs that count as word characters but are none go."""
    found = _LETTERS.findall(text.lower()) if text else []
    if found and not "".join(found).isalpha():
        found = [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]
    return found


def subwords(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket numbers of a text's subwords."""
    words = words_of(text)
    return _buckets(words, buckets)[0] if words else np.empty(0, np.int64)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their weights, which sum to 1."""
    ids, n = np.unique(subwords(text), return_counts=True)
    return ids, n / max(1, n.sum())


@dataclass
class LangModel:
    """Languages, a table of bucket rows, the layer behind it (none if the table is the product with it
    already), temperature and rejection bound."""

    langs: list[str]
    table: np.ndarray
    layer: np.ndarray | None
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def of_mean(self, mean: np.ndarray) -> np.ndarray:
        """Logits out of the mean of a text's bucket rows."""
        return (mean if self.layer is None else mean @ self.layer) + self.bias

    def mean(self, text: str | None) -> np.ndarray | None:
        ids = subwords(text) if text else ()
        if not len(ids) or not self.langs:
            return None
        return self.table[ids].sum(axis=0, dtype=np.float64) / len(ids)

    def logits(self, text: str | None) -> np.ndarray | None:
        mean = self.mean(text)
        return None if mean is None else self.of_mean(mean)


class Predictor:
    """Scores texts by their words; a word's sums over its subwords are kept within a task, for at most
    about ``remembered`` words of ``DIM`` + 1 numbers."""

    def __init__(self, model: LangModel, remembered: int = 400_000):
        self.model, self.remembered = model, remembered
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((0, self.model.table.shape[1] + 1))

    def learn(self, words: list[str]) -> None:
        ids, word = _buckets(words)
        w = self.model.table
        first = len(self.known)
        if first + len(words) > len(self.sums):  # room for as many again: rows are copied seldom
            more = np.zeros((max(1024, 2 * (first + len(words))), w.shape[1] + 1))
            more[:first] = self.sums[:first]
            self.sums = more
        mine = self.sums[first : first + len(words)]
        for k in range(w.shape[1]):
            mine[:, k] = np.bincount(word, w[ids, k], len(words))
        mine[:, -1] = np.bincount(word, minlength=len(words))
        self.known.update(zip(words, range(first, first + len(words))))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        m, out = self.model, []
        for lo in range(0, len(texts), 256):
            found = [words_of(t) for t in texts[lo : lo + 256]]
            if len(self.known) > self.remembered:
                self.forget()
            new = sorted({w for ws in found for w in ws} - self.known.keys())
            if new and m.langs:
                self.learn(new)
            for ws in found:
                if not ws or not m.langs:
                    out.append((UND, 0.0, False))
                    continue
                total = self.sums[[self.known[w] for w in ws]].sum(axis=0)
                p = m.probabilities(m.of_mean(total[:-1] / total[-1]))
                k = int(np.argmax(p))
                out.append((m.langs[k], float(p[k]), bool(p[k] >= m.least)))
        return out


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> LangModel:
    """SGD on embeddings and layer, then the temperature on every tenth row kept apart."""
    names = sorted(set(langs))
    if not names:
        return LangModel([], np.zeros((BUCKETS, 0), np.float32), None, np.zeros(0))
    bags = [bag(t) for t in texts]
    place = {v: k for k, v in enumerate(names)}
    y = np.array([place[v] for v in langs])
    apart = np.arange(len(y)) % 10 == 9
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, len(names))), np.zeros(len(names))
    rows = np.flatnonzero(~apart)
    weight = len(rows) / (len(names) * np.maximum(1, np.bincount(y[rows], minlength=len(names))))
    steps = max(1, epochs * len(rows))
    done = 0
    for _ in range(epochs):
        for r in rng.permutation(rows):
            ids, w = bags[r]
            lr = rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            hidden = w @ emb[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[r]] -= 1
            p *= lr * min(3.0, weight[y[r]])
            back = out @ p
            out -= np.outer(hidden, p)
            bias -= 0.1 * p
            emb[ids] -= np.outer(np.minimum(w, MOST_SHARE), back) * DIM
    if len(names) <= DIM:
        m = LangModel(names, (emb @ out).astype(np.float32), None, bias)
    else:
        m = LangModel(names, emb.astype(np.float32), out, bias)
    means = [(m.mean(texts[r]), y[r]) for r in np.flatnonzero(apart)]
    means = [(a, b) for a, b in means if a is not None]
    if means:
        hidden, truth = np.array([a for a, _ in means]), np.array([b for _, b in means])

        def scores(t: float) -> tuple[np.ndarray, np.ndarray]:
            """Probability of the truth, and of the answer where that is right, else -1; some rows at a time."""
            m.temperature = t
            of_truth, of_answer = np.empty(len(truth)), np.full(len(truth), -1.0)
            for lo in range(0, len(truth), 128):
                p = m.probabilities(m.of_mean(hidden[lo : lo + 128]))
                of_truth[lo : lo + 128] = p[np.arange(len(p)), truth[lo : lo + 128]]
                right = p.argmax(axis=1) == truth[lo : lo + 128]
                of_answer[lo : lo + 128][right] = p.max(axis=1)[right]
            return of_truth, of_answer

        m.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: -float(np.log(scores(t)[0] + 1e-12).mean()))
        answers = scores(m.temperature)[1]
        if (answers >= 0).any():
            m.least = float(np.quantile(answers[answers >= 0], REJECT))
    return m


def training_sample(docs: DataFrame, rows: int = ROWS_PER_LANG, all_rows: int = SAMPLE_ROWS, all_chars: int = SAMPLE_CHARS) -> DataFrame:
    """A sample of the training folds that holds every language: the texts whose id's hash lies below their
    language's share, which keeps to its part of all rows and characters, and the least hash of each."""
    seen = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).where("lang is not null and doc_id is not null and text is not null").where(fold("doc_id", 4) != 2)
    seen = seen.where(F.col("text").rlike(r"\p{L}")).withColumn("spread", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30))
    chars = F.least(F.length("text"), F.lit(MAX_SAMPLE_CHARS))
    each = seen.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("chars"), F.min("spread").alias("least"))
    each = materialize(each, "languages")
    langs = max(1, each.count())
    share = F.least(F.lit(min(rows, all_rows / langs)) / F.col("n"), F.lit(all_chars / langs) / F.col("chars"))
    each = each.select("lang", share.alias("share"), "least")
    joined = seen.join(F.broadcast(each) if langs <= BROADCAST_LANGS else each, "lang")
    return joined.where((F.col("spread") < F.col("share")) | (F.col("spread") <= F.col("least"))).select(
        "doc_id", "lang", F.substring("text", 1, MAX_SAMPLE_CHARS).alias("text")
    )


def fit_langid(docs: DataFrame, rows: int = ROWS_PER_LANG) -> LangModel:
    sample = training_sample(docs, rows).toPandas().sort_values(["doc_id", "lang", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def identify(docs: DataFrame, model: LangModel, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Id, lang_pred, score and accepted of every whole text; the model goes out as a broadcast
    variable (buckets x ``DIM`` floats at most, and ``DIM`` for each language)."""
    src = docs.select(docs[id_col].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = dict(src.dtypes)["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = Predictor(sent.value)
        for b in batches:
            got = predict(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], **{c: [g[k] for g in got] for k, c in enumerate(("lang_pred", "score", "accepted"))}})

    return src.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from the training folds."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit_langid(docs))
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))  # a null id is in no fold
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")
