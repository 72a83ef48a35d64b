import re
from collections import Counter

from .llm_data import data, texts
from pitlane.llm.quality_rules import Rule, quality_rules

from .conftest import EDGES


def brute(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(win)
    rep = {p for i, w in enumerate(win) if seen[w] > 1 for p in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep),
        len(words) < 20 or 100 * len(rep) > 30 * len(words),
    )


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_brute_force(spark):
    rows = texts("sf0.001")
    extra = ["a b c d e f g h " * 3, "x " * 8, "a b c d e f g h", "l1\nl1\n\nl2 #|\nl1", "a b c d e f g h i a b c d e f g h"]
    rows += [(10_000 + k, t) for k, t in enumerate(extra)]
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_edges(edge_docs, no_docs):
    got = quality_rules(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    for k, t in enumerate(EDGES):
        assert tuple(by[k][c] for c in COLS) == brute(t), k
    assert not by[0].kept and by[0].base_failed
    assert quality_rules(no_docs).count() == 0


def test_rules_are_a_table(spark):
    df = spark.createDataFrame([(1, "one two # three")], "doc_id long, text string")
    r = quality_rules(df, rules=(Rule("n_words", 2, 3), Rule("symbol_ratio", None, 0.5))).first()
    assert list(r.broken) == ["n_words"] and not r.kept


def test_no_python_and_no_shuffle(spark):
    plan = quality_rules(spark.read.parquet(data("sf0.001", "documents")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
