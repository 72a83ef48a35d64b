"""Secret scan with multipart credential linking, in DataFrame operations only.

Patterns give parts: the base kinds (assign, access, hex), which are always reported, and weak
ones - high-entropy tokens, account names, endpoints - which prove nothing alone. A weak part is
reported only if a complementary part starts within ``WINDOW`` characters in the same scope
(paragraph): an interval join of parts with per-bin extremes of the other parts, so many parts
in a place cost no pairs.

A match's offsets come from ``split`` and ``regexp_extract_all`` by the same pattern: the pieces
between the matches and the matches, summed up by a window over the document's few parts. Only
documents with a hint of a part are looked at closely, and no text is shuffled.

Defined results: a null text is an empty one; a document without parts has zero counts, empty
``spans`` and the digest of an empty string; repeated rows get equal results, keyed by id and
text digest, null ids included; offsets are code points, ends exclusive; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlane.llm.common import let, table

WINDOW = 200
MASK = "[REDACTED]"

_NAMES = "(?i:(password|passwd|secret|token|api_?key))"
_VALUE = r"[A-Za-z0-9+/_.=-]"
#: kind -> (pattern, group whose length counts, least length). The first three are the base kinds, in order.
PATTERNS = {
    "assign": (_NAMES + r"""["']?\x20*[:=]\x20*["']?(""" + _VALUE + "+)", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    # A run of 32 or more is found from its start either way; short runs are never matches.
    "hex": ("[0-9a-f]{32,}", 0, 32),
    "key": (
        r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])"
        r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])",
        0,
        40,
    ),
    "account": (
        r"""(?<![A-Za-z0-9])(?i:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
        0,
        3,
    ),
    "endpoint": (
        r"""(?i:\b(?:https?|wss?|ftp|jdbc:[a-z]{2,20}|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://[^\s"'<>]+"""
        r"""|(?<![A-Za-z0-9])(?:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[a-z0-9][a-z0-9.-]{3,})""",
        0,
        3,
    ),
    "break": (r"\n[ \t\r]*\n", 0, 1),
}
BASE = ("assign", "access", "hex")
WEAK = ("key", "account", "endpoint")
#: What a kind is in a credential, and which roles a weak one needs near it.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "key": "secret", "account": "id", "endpoint": "place"}
NEEDS = {"key": ("id", "place"), "account": ("secret",), "endpoint": ("secret",)}
#: A run in which a hexadecimal or high-entropy token may stand; entered at its start only.
LONG_RUN = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32}"

SPAN = "struct<start:long,ord:int,kind:string,end:long>"


def _hinted(text: Column) -> Column:
    """A cheap test that every text with a part passes."""
    return F.coalesce(text.contains(":") | text.contains("=") | text.contains("AKIA") | text.rlike(LONG_RUN), F.lit(False))


def _literal(values: dict[str, object]) -> Column:
    """A lookup of ``kind``."""
    c = F.lit(None)
    for k, v in values.items():
        c = F.when(F.col("kind") == k, v if isinstance(v, Column) else F.lit(v)).otherwise(c)
    return c


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, gap, len, size) of a pattern's matches: characters since the last match,
    in the match, and in the group that counts."""
    pattern, group, _ = PATTERNS[kind]
    p = F.lit(pattern)

    def zipped(gaps: Column) -> Column:
        whole, part = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group))
        return F.transform(
            F.arrays_zip(whole.alias("m"), part.alias("g"), gaps.alias("b")),
            lambda x: F.struct(
                F.lit(kind).alias("kind"), F.length(x["b"]).alias("gap"), F.length(x["m"]).alias("len"), F.length(x["g"]).alias("size")
            ),
        )

    # The piece after the last match has no match to go with.
    pieces = F.split(text, pattern, -1)
    found = let(F.slice(pieces, 1, F.size(pieces) - 1), zipped)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<kind:string,gap:int,len:int,size:int>>"))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


KEY = ["doc_id", "md5"]


def parts(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All parts of documents: doc_id, md5, kind, start, end and scope."""
    src = docs.select(docs[id_col].alias("doc_id"), docs[text].cast("string").alias("text")).where(_hinted(F.col("text")))
    one = src.select("doc_id", _digest(src["text"]).alias("md5"), F.concat(*(_matches(F.col("text"), k) for k in PATTERNS)).alias("m"))
    # An inner explode lets the optimiser put "m is not null" before the hint, and so match every text.
    rows = one.select(*KEY, F.posexplode_outer("m").alias("pos", "m")).where("pos is not null").select(*KEY, "pos", "m.*").distinct()
    before = Window.partitionBy(*KEY, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before).cast("long"))
    rows = rows.withColumn("start", F.col("end") - F.col("len")).where(F.col("size") >= _literal({k: v[2] for k, v in PATTERNS.items()}))
    in_order = Window.partitionBy(*KEY).orderBy("start", "end", "kind")
    scope = F.sum((F.col("kind") == "break").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    base = F.col("kind").isin(*BASE)
    met = (F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) > F.col("start")) | (
        F.min(F.when(base, F.col("start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing)) < F.col("end")
    )
    out = rows.select(*KEY, "kind", "start", "end", scope.alias("scope"), base.alias("base"), F.coalesce(met, F.lit(False)).alias("met"))
    # Weak parts that meet a base span are part of it.
    return out.where((F.col("kind") != "break") & (F.col("base") | ~F.col("met"))).drop("met")


def linked(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """The weak parts that have a complementary part in reach.

    Bins are as wide as the reach: another part in the same bin is in reach, and in the bins
    beside it the nearest one decides, so the least and greatest start per bin suffice.
    """
    bin_of = F.floor(F.col("start") / window)
    other = found.select(*KEY, "scope", _literal(ROLE).alias("role"), bin_of.alias("bin"), "start")
    other = other.groupBy(*KEY, "scope", "role", "bin").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    other = other.select(F.col("doc_id").alias("o_id"), F.col("md5").alias("o_md5"), F.col("scope").alias("o_scope"), "role", "bin", "lo", "hi")
    weak = found.where(~F.col("base"))
    needs = _literal({k: F.array(*map(F.lit, v)) for k, v in NEEDS.items()})
    asked = weak.select(*KEY, "kind", "start", "end", "scope", F.explode(needs).alias("need"), bin_of.alias("at"))
    asked = asked.withColumn("bin", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)))
    near = (
        asked["doc_id"].eqNullSafe(other["o_id"])
        & (asked["md5"] == other["o_md5"])
        & (asked["scope"] == other["o_scope"])
        & (asked["need"] == other["role"])
        & (asked["bin"] == other["bin"])
        & (other["hi"] >= asked["start"] - window)
        & (other["lo"] <= asked["start"] + window)
    )
    return asked.join(other, near, "left_semi").select(*KEY, "kind", "start", "end").distinct()


def reported(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per id and text digest with any: ``base`` and ``spans``, arrays by start, then kind."""
    found = parts(docs, text, id_col)
    every = found.where("base").select(*KEY, "kind", "start", "end", F.lit(True).alias("base"))
    every = every.unionByName(linked(found).withColumn("base", F.lit(False)))
    order = _literal({k: n for n, k in enumerate((*BASE, *WEAK))})
    span = F.struct("start", order.cast("int").alias("ord"), "kind", "end")
    return every.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: base counts, the base spans' digest and all spans."""
    few = docs.select(docs[id_col].alias("doc_id"), docs[text].alias("text"))
    # The join back carries the digest of the text, not the text.
    r = reported(few)
    own = few.select("doc_id", _digest(few["text"]).alias("md5"))
    r = r.select(F.col("doc_id").alias("r_id"), F.col("md5").alias("r_md5"), "base", "spans")
    out = own.join(r, own["doc_id"].eqNullSafe(r["r_id"]) & (own["md5"] == r["r_md5"]), "left")
    none = F.array().cast(f"array<{SPAN}>")
    out = out.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *(count(k) for k in BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _mask_base(text: Column) -> Column:
    """The base kinds replaced by pattern: linear in the text, however many there are. A value
    after a shorter one ("token: secret: ...") is masked too, though the scan drops it."""
    mask = MASK.replace("[", "\\[").replace("]", "\\]")
    out = F.regexp_replace(text, _NAMES + r"""(["']?\x20*[:=]\x20*["']?)""" + _VALUE + "{8,}", "$1$2" + mask)
    return F.regexp_replace(out, "AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", mask)


def redact_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with every reported span masked; other columns unchanged.

    Documents without a weak part are rewritten where they stand; only the few with one are
    joined to the scan's result, whose linked spans are cut out by their offsets.
    """
    t = docs[text].cast("string")
    weak_part = _hinted(t) & F.coalesce(t.rlike("|".join(f"(?:{PATTERNS[k][0]})" for k in WEAK)), F.lit(False))
    plain = docs.where(~weak_part).withColumn(text, F.when(_hinted(t), _mask_base(t)).otherwise(t))
    some = docs.where(weak_part)
    r = reported(some, text, id_col).select(
        F.col("doc_id").alias("__scan_id"),
        F.col("md5").alias("__scan_md5"),
        F.filter("spans", lambda s: ~s["kind"].isin(*BASE)).alias("__scan_weak"),
    )
    out = some.join(r, some[id_col].eqNullSafe(r["__scan_id"]) & (_digest(some[text]) == r["__scan_md5"]), "left")
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    t = out[text]

    def step(a: Column, s: Column) -> Column:
        before = F.substring(t, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(a["out"], before, F.lit(MASK)).alias("out"), s["end"].alias("at"))
        )

    cut = F.aggregate("__scan_weak", state, step, lambda a: F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), F.length(t))))
    out = out.withColumn(text, _mask_base(F.coalesce(cut, t)))
    return plain.select(docs.columns).unionAll(out.select(docs.columns))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return find_secrets(table(spark, sf_dir, "documents"))
