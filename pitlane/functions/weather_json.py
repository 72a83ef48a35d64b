"""C17: a session's weather as a Variant, written once as parsed and read by path, instead of a string of JSON.

JSON arrives as text. Text that is no JSON object is malformed: it is reported (``malformed_json``, a Q4
report) and never raised, and an upsert leaves the session's weather as it was. Variants
have no order and no hash, so keys, de-duplication and joins use the text, which is parsed last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SESSION_KEY = ["year", "track", "session_type"]
#: What a session's weather says, by path and type.
FIELDS = {
    "samples": ("$.samples", "int"),
    "track_min": ("$.track.min", "double"),
    "track_max": ("$.track.max", "double"),
    "wet": ("$.wet", "boolean"),
}


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object; false for NULL and for anything malformed."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def as_variant(text: Column) -> Column:
    """The text as a Variant; NULL unless it is a JSON object."""
    return F.when(is_object(text), F.try_parse_json(text))


def with_variant(sessions: DataFrame, column: str = "weather") -> DataFrame:
    """The table with its JSON column parsed."""
    return sessions.withColumn(column, as_variant(F.col(column)))


def malformed_json(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q4: one row per JSON column: (table_name, column_name, malformed_count), in one pass. NULL is missing, not malformed."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & ~is_object(F.col(c))).alias(c) for c in columns])
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {stacked}) AS (column_name, malformed_count)").select(
        F.lit(table).alias("table_name"), "column_name", F.col("malformed_count").cast("long").alias("malformed_count")
    )


def upsert_weather(base: DataFrame, updates: DataFrame, order: str | None = None) -> DataFrame:
    """``base`` sessions (Variant weather) with the weather of ``updates`` (natural key, ``weather`` text).

    Of several well-formed texts for a session the last by ``order`` counts, then the greatest text; a session
    without one keeps its weather; unknown sessions are not added (U1 adds sessions).
    """
    good = updates.where(is_object(F.col("weather"))).select(*SESSION_KEY, F.col("weather").alias("_text"), (F.col(order) if order else F.lit(0)).alias("_order"))
    last = good.groupBy(*SESSION_KEY).agg(F.max_by("_text", F.struct("_order", "_text")).alias("_text"))
    joined = base.join(last, SESSION_KEY, "left")
    weather = F.coalesce(F.try_parse_json("_text"), F.col("weather")).alias("weather")
    return joined.select(*[weather if c == "weather" else F.col(c) for c in base.columns])


def weather_fields(sessions: DataFrame, fields: dict[str, tuple[str, str]] = FIELDS) -> DataFrame:
    """One typed column per path; NULL where the path is absent or of another type."""
    read = [F.try_variant_get("weather", path, kind).alias(name) for name, (path, kind) in fields.items()]
    return sessions.select(*[c for c in sessions.columns if c != "weather"], *read)
