import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and river stone light bread garden winter letter paper summer window mountain yellow quiet harbour engine copper silver".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


#: Texts every operator must take: null, empty, blank, no letter, one word, long run, very long, odd characters.
EDGES = [None, "", " \n\t ", "... !!!", "word", "a" * 60_000, prose(1, 30_000), "é́ ​ \U0001f600 ß\x00\x1f 日本語", "\n\n\n", "1" * 5_000]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge texts with null ids, repeated rows and columns whose names an operator may use itself."""
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(EDGES)]
    rows += [(50, prose(2, 80), None, None, None), (50, prose(2, 80), None, None, None), (None, prose(3, 80), "en", "s", 1), (51, prose(2, 80), "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("y", "x", "md5", "node", "key", "base", "score", "share", "n", "piece", "start", "kind", "item_id", "lines", "m", "sig"):
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def keyed(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
