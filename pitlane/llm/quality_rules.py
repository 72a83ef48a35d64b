"""Quality rules: a threshold table compiled into one Spark projection.

Every measure (length, symbol, stop-word, line and repetition ratios) and every rule is a
built-in expression over the row; there is no user function, no shuffle and no second scan.

Defined results: a null text has no words and fails the base rule like an empty one; ratios
with nothing to divide by are 0; repeated rows each get their own equal result; the result
carries only the id and the measures, so extra input columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import let, table, text_column

#: Words are maximal runs of characters other than these.
SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the tables (fixed values).
STOP_WORDS = (
    "a an and are as at be by for from had has have in is it of on or that the their this to was were which with "
    "au aux avec ce dans de des du elle en est et il la le les ne par pas pour qui se sur un une "
    "auf aus das dem den der die ein eine er es für im ist mit nicht sich sie sind und von zu "
    "al como con del el es la las lo los no o para por que se su un una y"
).split()


#: For stop words: white space becomes a space, trailing punctuation goes.
PLAIN = ("\t\n\x0b\x0c\r.,;:!?", "     ")


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high]; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are per word or per line, see ``measures``.
RULES = (
    Rule("n_words", 20, None),
    Rule("repeat_word_ratio", None, 0.30),
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.35),
    Rule("upper_ratio", None, 0.40),
    Rule("alpha_word_ratio", 0.70, None),
    Rule("ellipsis_line_ratio", None, 0.30),
    Rule("bullet_line_ratio", None, 0.90),
)


def _repeated(words: Column) -> Column:
    """Words that stand in an 8-word window found twice or more in the text.

    Windows are compared by a 64-bit hash of their words, built by doubling (pairs, fours,
    eights), so each word is hashed twice and not eight times. Texts without a repeat end
    after one hash-set pass; in the others (hash, position) pairs are sorted, windows equal to
    a neighbour are repeated, and the covered words are summed over their sorted positions.
    """
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            last = F.size(s) - 1
            at = F.transform(
                s,
                lambda x, j: F.when(
                    ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(s, j + 1)["h"] == x["h"])), x["i"]
                ),
            )
            state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
            return F.aggregate(
                F.sort_array(F.filter(at, lambda p: p.isNotNull())),
                state,
                lambda a, p: F.struct(
                    (p + WINDOW).alias("end"),
                    (a["total"] + F.least(F.lit(WINDOW), p + WINDOW - a["end"])).alias("total"),
                ),
                lambda a: a["total"],
            )

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), of_sorted)
        )

    def doubled(a: Column, gap: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - 1 - gap), lambda i: F.xxhash64(F.get(a, i), F.get(a, i + gap)))

    windows = let(let(doubled(words, 1), lambda a: doubled(a, 2)), lambda a: doubled(a, 4))
    return F.when(n <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, covered))


def measures(text: Column) -> Column:
    """Struct of all counts and ratios of one text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def count(c: Column) -> Column:
        return F.size(c).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(
            count(w).alias("n_words"),
            _repeated(w).alias("n_repeat_words"),
            count(F.array_distinct(w)).alias("n_distinct_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            count(x).alias("n_lines"),
            (count(x) - count(F.array_distinct(x))).alias("n_dup_lines"),
            count(F.filter(x, lambda y: y.rlike(r"(\.\.\.|…)\s*$"))).alias("n_ellipsis_lines"),
            count(F.filter(x, lambda y: y.rlike(r"^\s*[-*•·–]\s"))).alias("n_bullet_lines"),
        )

    def of_text(t: Column) -> Column:
        return F.struct(
            F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]*+\p{L}")).cast("long").alias("n_alpha_words"),
            count(F.filter(F.split(F.translate(F.lower(t), *PLAIN), " "), lambda x: x.isin(STOP_WORDS))).alias("n_stop_words"),
        )

    return F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), let(text, of_text).alias("t"))


COUNTS = {
    "w": ("n_words", "n_repeat_words", "n_distinct_words"),
    "l": ("n_lines", "n_dup_lines", "n_ellipsis_lines", "n_bullet_lines"),
    "t": ("word_chars", "n_symbols", "n_upper", "n_alpha_words", "n_stop_words"),
}


def ratios() -> dict[str, Column]:
    """The rules' measures over the count columns."""

    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "n_words": F.col("n_words"),
        "repeat_word_ratio": over("n_repeat_words", "n_words"),
        "mean_word_chars": over("word_chars", "n_words"),
        "symbol_ratio": over("n_symbols", "n_words"),
        "stop_word_ratio": over("n_stop_words", "n_words"),
        "dup_line_ratio": over("n_dup_lines", "n_lines"),
        "distinct_word_ratio": over("n_distinct_words", "n_words"),
        "upper_ratio": over("n_upper", "word_chars"),
        "alpha_word_ratio": over("n_alpha_words", "n_words"),
        "ellipsis_line_ratio": over("n_ellipsis_lines", "n_lines"),
        "bullet_line_ratio": over("n_bullet_lines", "n_lines"),
    }


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Array of the names of the rules a row breaks."""
    of = ratios()
    broken = []
    for r in rules:
        m = of[r.measure]
        out = F.lit(False)
        if r.low is not None:
            out = out | (m < F.lit(r.low))
        if r.high is not None:
            out = out | (m > F.lit(r.high))
        broken.append(F.when(out, F.lit(r.measure)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: the counts, ``base_failed``, the broken rules and ``kept``."""
    m = docs.select(docs[id_col].alias(id_col), measures(text_column(docs, text)).alias("m"))
    flat = m.select(id_col, *(F.col(f"m.{g}.{c}").alias(c) for g, names in COUNTS.items() for c in names))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = flat.withColumns({"base_failed": failed, "broken": compile_rules(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production rules over all documents."""
    out = quality_rules(table(spark, sf_dir, "documents"))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select(*base, F.array_join("broken", ",").alias("broken"), "kept")
