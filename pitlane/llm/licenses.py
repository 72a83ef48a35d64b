"""License scan: canonical digest lookup.

A text's canonical form is lower case, without copyright notices and the addresses in them,
with equivalent spellings made one and every run of other characters than letters and digits made a space. The md5 of
a whole text's form, and of each of its lines', is hash-joined to the digests of the known
licences; nothing is matched in part.

Known licences are a table (``license_id``, ``text``); it is canonicalised by the same
expressions. It is broadcast while its count is at most ``BROADCAST_ROWS``, else joined by a shuffle.

Defined results: null texts, and texts or lines whose canonical form is empty, match nothing; a
known text with an empty form is ignored; if several licences share a form, all are reported;
repeated rows of one id add up their counts; only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import table
from pitlane.llm.license_texts import LICENSES

BROADCAST_ROWS = 10_000

#: Where a notice ends: at the line's end, or where a licence goes on in the same line.
_ENDS = (
    r"(permission (?:is hereby|is granted|to use)|redistribution and use|everyone (?:is permitted|may copy)|(?:licensed|released|distributed) under"
    r"|this (?:software|program|library|file|work|product) (?:is|may|comes)|(?:gnomovision|<program>) comes with|\n|\z)"
)
#: Words that go on with a sentence after "copyright" or after the list item "(c)"; a notice goes on with a holder.
_SENTENCE = (
    r"(?:(?:notice|holder|owner|law|license|licence|line|interest|permission|statement|disclaimer|right|act|claim|work)s?|ownership|doctrines|treaty"
    r"|protect(?:ed|ion)|infring[a-z]+|patent|like|also|and|are|as|for|if|in|is|of|on|or|resulting|those|to|the[ \t\r\n]+(?:software|library|program))"
)
_ITEM = r"(?:you|under|representations|if|to|a|an|all|any|in|this|that|each|such|when|where|with|without|no|or|and|it|must|may|the licen)"

#: (pattern, replacement) applied in order to lower-cased text. Lines stay apart by \n. Neither a
#: sentence that a wrap makes begin with "copyright" nor the text behind a notice goes with it.
RULES = (
    (r"\ball[ \t\n]+rights[ \t\n]+reserved\b(?: by [^\n.]*)?", " "),
    (r"\b(?:51[ \t\n]+franklin|59[ \t\n]+temple|675[ \t\n]+mass)[^;]{0,80}?\busa\b|<https?://fsf\.org/>", " "),
    (r"\bcopyright[ \t]*(?:\(c\)|©)[ \t\n]*_[_ \t\n]*", " "),
    (r"\bcopyright[ \t,:]*(?:\(c\)|©|[0-9<\[{]|year\b)[^\n]*?" + _ENDS, " $1"),
    (r"(?m)^[^\p{L}\p{N}\n]*(?:©|\(c\)[ \t]*(?:copyright\b|[0-9<\[{]))[^\n]*?" + _ENDS, " $1"),
    (r"\bcopyright([^\p{L}\p{N}]+" + _SENTENCE + r"\b)", "copyrightx$1"),
    (r"\(c\)([^\p{L}\p{N}]+" + _ITEM + ")", "cx$1"),
    (r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\))[^\n]*?" + _ENDS, " $1"),
    (r"[^\p{L}\p{N}\n]+", " "),
    (r"\b(licen|defen|offen)ce", "$1se"),
    (r"(\p{L}{3})is(e|ed|es|ing|ation)\b", "$1iz$2"),
    (r"(\p{L}{2})our(s|ed|able|ite)?\b", "$1or$2"),
    (r"\b(sub|non|re)[ \n]+(licens|infring|distribut)", "$1$2"),
    (r"\b(judg|acknowledg)ement", "$1ment"),
    (r"\bhttps\b", "http"),
    (r"(?m)^ +| +$", ""),
)


def canonical(text: Column) -> Column:
    """The canonical form, its lines parted by line feeds."""
    c = F.lower(text)
    for pattern, new in RULES:
        c = F.regexp_replace(c, pattern, new)
    return c


def known_licenses(spark: SparkSession) -> DataFrame:
    """The built-in table of licence texts and notices."""
    return spark.createDataFrame(LICENSES, "license_id string, text string")


def digests(known: DataFrame) -> DataFrame:
    """(license_id, digest) of the known texts."""
    whole = F.concat_ws(" ", F.filter(F.split(canonical(known["text"]), "\n"), lambda x: x != ""))
    return known.select("license_id", whole.alias("form")).where("form <> ''").select("license_id", F.md5("form").alias("digest")).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, license_id, whole, n_units): which licences stand in a document as its whole
    text or as lines of it, and how many of these units do."""
    form = docs.select(docs[id_col].alias("doc_id"), canonical(docs[text].cast("string")).alias("form"))
    lines = F.filter(F.split("form", "\n"), lambda x: x != "")
    # A text of one line is one unit: the whole.
    units = form.select("doc_id", lines.alias("lines")).select(
        "doc_id",
        F.explode(
            F.when(F.size("lines") == 0, F.array().cast("array<struct<whole:boolean,digest:string>>"))
            .when(F.size("lines") == 1, F.array(F.struct(F.lit(True).alias("whole"), F.md5(F.get("lines", F.lit(0))).alias("digest"))))
            .otherwise(
                F.concat(
                    F.array(F.struct(F.lit(True).alias("whole"), F.md5(F.concat_ws(" ", "lines")).alias("digest"))),
                    F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.md5(x).alias("digest"))),
                )
            )
        ).alias("u"),
    )
    table_ = digests(known)
    if table_.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table_ = F.broadcast(table_)
    hits = units.select("doc_id", "u.whole", "u.digest").join(table_, "digest")
    return hits.groupBy("doc_id", "license_id").agg(F.max("whole").alias("whole"), F.count(F.lit(1)).alias("n_units"))


def op8_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))
