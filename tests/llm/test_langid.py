import random
import re

import numpy as np

from pitlane.llm import langid as L

from .conftest import EDGES, prose
from .llm_data import data, texts


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(data("sf0.1", "documents"))
    got = L.identify(docs, L.fit_langid(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(L.fold("doc_id", 4) == 2).toPandas()
    assert len(got) > 2000 and (got["lang_pred"] == got["lang"]).mean() > 0.99
    ok = got[got["accepted"]]
    assert (ok["lang_pred"] == ok["lang"]).mean() >= (got["lang_pred"] == got["lang"]).mean()


def test_words_sum_up_to_the_text():
    m = L.fit([prose(k, 30) for k in range(20)] + ["der die das und nicht über"] * 20, ["en"] * 20 + ["de"] * 20, epochs=1)
    for t in (prose(3, 40), "Über, die Straße!", "a", "x1y"):
        z = m.logits(t)
        got = L.Predictor(m)([t])[0]
        p = m.probabilities(z)
        assert got[0] == m.langs[int(p.argmax())] and np.isclose(got[1], p.max())
    small = L.Predictor(m, remembered=3)
    some = [prose(k, 20) for k in range(600)]
    assert small(some) == L.Predictor(m)(some)  # forgetting words changes nothing


def test_language_source_and_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(data("sf0.01", "documents"))
    held = L.fold("doc_id", 4) == 2
    changed = docs.withColumn("lang", L.F.when(held, "zz").otherwise(L.F.col("lang"))).withColumn("source", L.F.lit(None))
    a, b = (sorted(map(tuple, L.identify(docs, L.fit_langid(d)).collect())) for d in (docs, changed))
    assert a == b and "zz" not in {r[1] for r in b}


def test_signs_are_no_letters():
    assert L.words_of("m² ½ Ⅷ x") == ["m", "x"] and L.words_of("² ½") == [] and L.words_of("Ünï") == ["ünï"]


def test_edges(spark, edge_docs, no_docs):
    m = L.fit_langid(spark.read.parquet(data("sf0.001", "documents")))
    got = L.identify(edge_docs, m).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == edge_docs.count()
    for k, t in enumerate(EDGES):
        letters = any(c.isalpha() for c in t or "")
        assert (by[k].lang_pred == "und") == (not letters) and (by[k].score == 0) == (not letters)
    assert L.identify(no_docs, m).count() == 0
    nothing = L.fit_langid(no_docs)
    assert {(r.lang_pred, r.score) for r in L.identify(edge_docs, nothing).collect()} == {("und", 0.0)}
    one = L.fit_langid(edge_docs)  # one language, few rows, clashing columns
    assert {r.lang_pred for r in L.identify(edge_docs, one).collect()} <= {"en", "und"}


def spoken(lang, row, n=12):
    """A text of a made-up language: words of its own syllables."""
    r = random.Random(f"{lang}/{row}")
    own = random.Random(lang)
    syllables = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)]
    return " ".join("".join(r.choice(syllables) for _ in range(2)) for _ in range(n))


def test_a_thousand_languages_are_all_learned_in_bounded_memory(spark):
    rows = [(1 + 4 * (1000 * k + lang), spoken(lang, k), f"l{lang:04}") for lang in range(1000) for k in range(6)]
    docs = spark.createDataFrame([(i, t, v) for i, t, v in rows], "doc_id long, text string, lang string").repartition(4)
    sample = L.training_sample(docs, all_rows=3000).collect()
    assert {r.lang for r in sample} == {f"l{k:04}" for k in range(1000)} and 2500 < len(sample) < 4500
    m = L.fit_langid(docs)
    assert len(m.langs) == 1000 and m.table.nbytes + m.layer.nbytes < 10_000_000
    predict = L.Predictor(m)
    got = predict([spoken(lang, 99, 30) for lang in range(1000)])
    assert np.mean([g[0] == f"l{k:04}" for k, g in enumerate(got)]) > 0.8
    assert predict.sums.shape[1] == L.DIM + 1


def test_table_and_layer_are_their_product(monkeypatch):
    texts = [spoken(k % 3, k) for k in range(60)]
    langs = [f"l{k % 3}" for k in range(60)]
    product = L.fit(texts, langs, epochs=2)
    monkeypatch.setattr(L, "DIM", 2)
    apart = L.fit(texts, langs, epochs=2)
    assert product.layer is None and apart.layer is not None
    for m in (product, apart):
        for (lang, score, _), t in zip(L.Predictor(m)(texts), texts):
            p = m.probabilities(m.logits(t))
            assert lang == m.langs[int(p.argmax())] and np.isclose(score, p.max())


def test_sample_keeps_to_rows_and_characters_and_cuts_long_texts(spark):
    rows = [(4 * k + 1, "mot " * 30_000 if k % 2 else "Wort " * 20, "fr" if k % 2 else "de") for k in range(400)] + [(2001, "solo " * 9000, "it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.training_sample(docs, all_chars=900_000).toPandas()
    by = got.groupby("lang")["text"].agg(["count", lambda t: t.str.len().sum()])
    assert set(by.index) == {"de", "fr", "it"} and by.loc["it", "count"] == 1
    assert got["text"].str.len().max() <= L.MAX_SAMPLE_CHARS and by.loc["fr"].iloc[1] < 900_000


def plain_scores(m, text):
    """(language, score) from the definition: every 1- to 4-gram of every edge-marked word, one by one."""
    words = ["".join(filter(str.isalpha, w)) for w in re.findall(r"[^\W\d_]+", (text or "").lower())]
    total, n = np.zeros(m.table.shape[1]), 0
    for w in (f" {w} " for w in words if w):
        for size in range(1, 5):
            for at in range(len(w) - size + 1):
                gram = w[at : at + size]
                if size == 1 and at == len(w) - 1:
                    continue  # the edge that the next word begins with
                h = ord(gram[0])
                for c in gram[1:]:
                    h = (h * int(L._P) % 2**64) ^ ord(c)
                h = (h * int(L._P) + size) % 2**64
                total += m.table[(h ^ (h >> 31)) % L.BUCKETS]
                n += 1
    if not n:
        return "und", 0.0
    p = m.probabilities(m.of_mean(total / n))
    return m.langs[int(p.argmax())], float(p.max())


def test_whole_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(data("sf0.001", "documents"))
    m = L.fit_langid(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.op9_language_id(spark, "/root/testdata/sf0.001").collect()}
    for i, t in texts("sf0.001")[:60]:
        lang, score = plain_scores(m, t)
        assert got[i][0] == lang and np.isclose(got[i][1], score, atol=1e-4)


def test_held_out_is_a_boolean_for_null_ids_too(spark, edge_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op9_language_id(spark, str(tmp_path)).collect()
    assert {r.held_out for r in got} <= {True, False} and [r.held_out for r in got if r.doc_id is None] == [False]
