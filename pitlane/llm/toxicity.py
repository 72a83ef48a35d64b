"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

1. A lexicon of words and stems is learned from the training folds: the prefixes (4 to 8
   letters) that tell toxic texts best by their log-likelihood ratio, none within another.
2. The lexicon is a trie. The states that an input reaches in the intersection of the trie with
   each entry's Levenshtein automaton, (node, edits) pairs, are determinised lazily and
   remembered, so a word costs one table step per letter and most die after three or four.
   Words are lower-cased; letter look-alikes, stretched and dotted spellings are undone first.
3. A hit weighs its entry's smoothed log-odds, for misspelled forms their own. A window
   around it tells quotation (quotes, verbs of saying) from abuse (direct address).
4. A logistic layer over the sums, with a ridge towards prior weights, gives the score.

Everything is fitted on at most ``max_rows`` labelled rows outside the held-out fold. Defined
results: null and empty texts have no hit and get the score of clean texts; with no usable
label the lexicon is empty and all scores are low and equal; repeated rows get equal scores;
labels without a document and null labels are ignored; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import fold, labelled_sample, materialize, sigmoid, table

#: Bounds of the fit: labelled rows, and lexicon entries.
MAX_TRAIN_ROWS = 12_000
MAX_ENTRIES = 500
LEAST_TEXTS = 8
#: An entry's texts are toxic this many times as often as texts are, significantly so.
LIFT = 3.0
LEAST_G = 30.0
SHORTEST, LONGEST = 4, 8
WINDOW = 6

#: Cue words (fixed values): verbs of saying, and direct address.
SAYING = frozenset(
    "said says say called calls quote quoted quotes wrote word words term terms insult insults slur "
    "sagte nannte schrieb wort zitat dit appelé écrit mot citation dijo llamó escribió palabra cita".split()
)
ADDRESS = frozenset("you your yours youre u ur du dich dir dein ihr euch tu te toi ton vous votre tú ti usted eres".split())
_QUOTES = "\"“”«»„‘’'`"
_LEET = str.maketrans("013457@$!", "oieastasi")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?()[]{}<>*~…" + _QUOTES
_STRETCHED = re.compile(r"(.)\1{2,}")
_SPACED = re.compile(r"(?:\w[.\-*_]){2,}\w")


def edits_allowed(length: int) -> int:
    """Edits within which an entry of this length still counts."""
    return 0 if length < 5 else 1 if length < 9 else 2


def plain_word(token: str) -> str:
    """The lower-cased word of a token with look-alike, stretched and dotted spellings undone."""
    w = token.strip(_EDGE).lower()
    if not w or w.isalpha():
        return _STRETCHED.sub(r"\1", w)
    if _SPACED.fullmatch(w):
        w = re.sub(r"[.\-*_]", "", w)
    if any(c.isalpha() for c in w):
        w = w.translate(_LEET)
    return _STRETCHED.sub(r"\1", w)


@dataclass(frozen=True)
class Entry:
    """A lexicon entry; a stem takes any ending."""

    text: str
    stem: bool
    weight: float
    fuzzy: float


class LexiconAutomaton:
    """Trie and Levenshtein automata in one lazily determinised machine.

    A state is the set of (trie node, edits so far), less the pairs that a pair with fewer
    edits at the same node implies. Edits are insertion, deletion and substitution of a letter.
    """

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.reach: list[int] = [0]  # edits that the laxest entry below a node allows
        for n, e in enumerate(entries):
            at = 0
            most = edits_allowed(len(e.text))
            self.reach[0] = max(self.reach[0], most)
            for c in e.text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.reach.append(0)
                at = self.children[at][c]
                self.reach[at] = max(self.reach[at], most)
            self.ends[at] = n
        self.states: list[frozenset[tuple[int, int]]] = []
        self.number: dict[frozenset[tuple[int, int]], int] = {}
        self.step: list[dict[str, int]] = []
        self.hit: list[tuple[int, int] | None] = []  # (edits, entry) of whole words
        self.stem_hit: list[tuple[int, int] | None] = []  # of stems, whatever follows
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        todo = sorted(pairs, key=lambda p: p[1])
        while todo:  # deletions of entry letters reach deeper nodes
            node, e = todo.pop(0)
            if best.get(node, 99) <= e or e > self.reach[node]:
                continue
            best[node] = e
            if e < self.reach[node]:
                todo += [(child, e + 1) for child in self.children[node].values()]
                todo.sort(key=lambda p: p[1])
        key = frozenset(best.items())
        if key in self.number:
            return self.number[key]
        k = self.number[key] = len(self.states)
        self.states.append(key)
        self.step.append({})
        ends = [(e, self.ends[n]) for n, e in key if self.ends[n] >= 0 and e <= edits_allowed(len(self.entries[self.ends[n]].text))]
        self.hit.append(min(ends, default=None))
        self.stem_hit.append(min((x for x in ends if self.entries[x[1]].stem), default=None))
        return k

    def _next(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.states[state]:
            if c in self.children[node]:
                out.add((self.children[node][c], e))
            if e < self.reach[node]:
                out.add((node, e + 1))  # a letter too many
                out |= {(child, e + 1) for child in self.children[node].values()}  # another letter
        k = self.step[state][c] = self._state(out)
        return k

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the best entry for a word, fewest edits first."""
        state, best = self.start, None
        for c in word:
            nxt = self.step[state].get(c)
            state = nxt if nxt is not None else self._next(state, c)
            if not self.states[state]:
                return best
            found = self.stem_hit[state]
            if found and (best is None or found < best):
                best = found
        found = self.hit[state]
        return found if found and (best is None or found < best) else best


def hits(text: str | None, automaton: LexiconAutomaton, known: dict[str, tuple[int, int] | None]) -> tuple[int, list[tuple[int, int, bool, bool, bool]]]:
    """Number of words, and (entry, edits, quoted, said, addressed) of each hit."""
    tokens = _TOKEN.findall(text) if text else []
    out = []
    for at, token in enumerate(tokens):
        if token in known:
            m = known[token]
        else:
            w = plain_word(token)
            m = known[token] = automaton.match(w) if len(w) >= SHORTEST - 1 else None
        if m is None:
            continue
        lo = max(0, at - WINDOW)
        near = {t.strip(_EDGE).lower().replace("'", "") for t in tokens[lo : at + WINDOW + 1]}
        before, after = tokens[lo : at + 1], tokens[at : at + WINDOW + 1]
        quoted = any(t[0] in _QUOTES for t in before) and any(t.rstrip(".,;:!?")[-1:] in _QUOTES and len(t) > 1 for t in after)
        out.append((m[1], m[0], quoted, not SAYING.isdisjoint(near), not ADDRESS.isdisjoint(near)))
    return len(tokens), out


#: Prior weights of the logistic layer: intercept, then the features below.
PRIOR = np.array([-3.5, 2.0, -0.8, -0.5, 0.3, 0.3])


def doc_features(n_words: int, found: list[tuple[int, int, bool, bool, bool]], entries: list[Entry]) -> list[float]:
    """Sums over the hits: abuse, quoted, reported, addressed, and density per 100 words."""
    total = quoted = said = addressed = 0.0
    for entry, edits, q, s, a in found:
        w = entries[entry].fuzzy if edits else entries[entry].weight
        total += w * (0.4 if q else 1.0)
        quoted += w * q
        said += w * s
        addressed += w * a
    return [np.log1p(total), np.log1p(quoted), np.log1p(said), np.log1p(addressed), np.log1p(100 * total / max(1, n_words))]


@dataclass
class ToxModel:
    """Lexicon and the logistic layer."""

    entries: list[Entry]
    coef: np.ndarray

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, float).reshape(len(rows), len(PRIOR) - 1)
        return sigmoid(self.coef[0] + x @ self.coef[1:])


def lexicon_counts(train: DataFrame) -> DataFrame:
    """(form, texts, toxic, whole_toxic): in how many distinct training texts a prefix occurs, in
    how many toxic ones, and in how many of these as a whole word."""
    token = F.transform(F.split(F.lower("text"), r"[^\p{L}0-9@$!]+"), lambda w: F.translate(w, "013457@$!", "oieastasi"))
    words = F.array_distinct(F.filter(token, lambda w: F.length(w) >= SHORTEST))
    each = train.dropDuplicates(["text", "y"]).select("y", words.alias("words"))
    # Strings only, so distinct forms are found by hashing; whole words are marked by "=".
    heads = F.flatten(
        F.transform(
            "words",
            lambda w: F.transform(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(w))), lambda k: F.substring(w, F.lit(1), k)),
        )
    )
    whole = F.transform(F.filter("words", lambda w: F.length(w) <= LONGEST), lambda w: F.concat(F.lit("="), w))
    forms = each.select("y", F.explode(F.concat(F.array_distinct(heads), whole)).alias("f"))
    counts = forms.groupBy("f").agg(F.count(F.lit(1)).alias("texts"), F.sum("y").alias("toxic"))
    marked = F.col("f").startswith("=")
    counts = counts.select(F.when(marked, F.substring("f", 2, LONGEST)).otherwise(F.col("f")).alias("form"), marked.alias("whole"), "texts", "toxic")

    def total(c: str, whole: bool):
        return F.sum(F.when(F.col("whole") == whole, F.col(c)).otherwise(0))

    return counts.groupBy("form").agg(total("texts", False).alias("texts"), total("toxic", False).alias("toxic"), total("toxic", True).alias("whole_toxic"))


def choose_lexicon(counts: pd.DataFrame) -> list[tuple[str, bool]]:
    """(form, stem) of the most telling prefixes, at most ``MAX_ENTRIES``.

    ``counts`` has form, toxic, whole_toxic and g, the log-likelihood ratio. By falling g, of
    equals the longest; a form leaves out its own prefixes and continuations.
    """
    rows = sorted(counts.itertuples(), key=lambda r: (-round(r.g, 6), -len(r.form), r.form))
    chosen: dict[str, bool] = {}
    before: set[str] = set()  # prefixes of chosen forms
    for r in rows:
        heads = {r.form[:k] for k in range(SHORTEST, len(r.form) + 1)}
        if r.form in before or not heads.isdisjoint(chosen):
            continue
        chosen[r.form] = r.whole_toxic < 0.5 * r.toxic
        before |= heads
        if len(chosen) == MAX_ENTRIES:
            break
    return sorted(chosen.items())


def _scan(docs: DataFrame, entries: list[Entry], keep: list[str]) -> DataFrame:
    """Kept columns, number of words and hits of every whole text."""
    src = docs.select(*keep, docs["text"].cast("string").alias("__tox_text"))
    kinds = dict(src.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, known = LexiconAutomaton(entries), {}
        for b in batches:
            if len(known) > 500_000:
                known.clear()
            out = b[keep].copy()
            got = [hits(t, automaton, known) for t in b["__tox_text"]]
            out["n_words"] = [n for n, _ in got]
            out["hits"] = [[{"entry": h[0], "edits": h[1], "quoted": h[2], "said": h[3], "addressed": h[4]} for h in f] for _, f in got]
            yield out

    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return src.mapInPandas(run, f"{ddl}, n_words int, hits array<struct<entry int, edits int, quoted boolean, said boolean, addressed boolean>>")


def _fit_layer(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method with a ridge towards ``PRIOR``."""
    a = np.column_stack([np.ones(len(y)), x])
    w = PRIOR.copy()
    for _ in range(30):
        p = sigmoid(a @ w)
        g = a.T @ (p - y) + ridge * (w - PRIOR)
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> ToxModel:
    """Lexicon, weights and layer from the training folds."""
    sample = labelled_sample(labels, "toxic", 5, 0, max_rows)
    train = docs.select("doc_id", "text").join(sample, "doc_id").where("text is not null").select("doc_id", "y", F.col("text").cast("string").alias("text"))
    train = materialize(train, "toxicity-sample")  # bounded rows, read three times
    totals = train.dropDuplicates(["text", "y"]).agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    total, toxic = int(totals[0]), int(totals[1])
    if not toxic or toxic == total:
        return ToxModel([], PRIOR.copy())
    forms = lexicon_counts(train)
    base, t, c = toxic / total, F.col("toxic"), F.col("texts") - F.col("toxic")
    g = 2 * (t * F.log(t / (F.col("texts") * base)) + F.when(c > 0, c * F.log(c / (F.col("texts") * (1 - base)))).otherwise(0.0))
    telling = forms.where((t >= LEAST_TEXTS) & (t / F.col("texts") >= F.lit(min(0.95, LIFT * base)))).withColumn("g", g).where(F.col("g") >= LEAST_G)
    # Far more than the lexicon's bound, so whole families come with their longer forms.
    counts = telling.orderBy(F.desc("g"), F.desc(F.length("form")), "form").limit(MAX_ENTRIES * 40).toPandas()
    draft = [Entry(f, s, 1.0, 1.0) for f, s in choose_lexicon(counts)]
    scanned = _scan(train, draft, ["doc_id", "y"]).orderBy("doc_id", "y", "n_words").toPandas()
    seen = np.zeros((len(draft), 2, 2))  # entry, misspelled, label: texts
    for r in scanned.itertuples():
        for e, m in {(h["entry"], int(h["edits"] > 0)) for h in r.hits}:
            seen[e, m, r.y] += 1
    entries = []
    for k, e in enumerate(draft):
        def odds(n: np.ndarray, prior: float) -> float:
            p, q = (n[1] + prior * 2) / (toxic + 2), (n[0] + (1 - prior) * base * 2) / (total - toxic + 2)
            return float(np.clip(np.log(p / q), 0.0, 6.0))

        weight = odds(seen[k, 0], 0.5)
        bad = seen[k, 1]
        # Few misspelled forms: near the entry's own weight; many in clean texts: none.
        fuzzy = weight * float(np.clip((bad[1] + 2) / (bad[1] + bad[0] + 2.5) * 1.25 - 0.25, 0.0, 1.0))
        entries.append(Entry(e.text, e.stem, round(weight, 6), round(fuzzy, 6)))
    x = np.array([doc_features(r.n_words, [(h["entry"], h["edits"], h["quoted"], h["said"], h["addressed"]) for h in r.hits], entries) for r in scanned.itertuples()])
    return ToxModel(entries, _fit_layer(x, scanned["y"].to_numpy(float)))


def score_toxicity(docs: DataFrame, model: ToxModel, keep: list[str]) -> DataFrame:
    """Kept columns with score, number of hits and of quoted hits."""
    src = docs.select(*keep, docs["text"].cast("string").alias("__tox_text"))
    kinds = dict(src.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, known = LexiconAutomaton(model.entries), {}
        for b in batches:
            if len(known) > 500_000:
                known.clear()
            out = b[keep].copy()
            got = [hits(t, automaton, known) for t in b["__tox_text"]]
            out["score"] = model.scores([doc_features(n, f, model.entries) for n, f in got])
            out["n_hits"] = [len(f) for _, f in got]
            out["n_quoted"] = [sum(h[2] for h in f) for _, f in got]
            yield out

    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return src.mapInPandas(run, f"{ddl}, score double, n_hits int, n_quoted int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    out = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    held = (fold("doc_id", 5) == 0).alias("held_out")
    return out.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_quoted")
