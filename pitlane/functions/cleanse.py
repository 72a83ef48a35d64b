"""Scalar cleansing functions C1-C17, Column -> Column, all JVM built-ins.

Durations are integer microseconds, so ms conversion is exact integer
arithmetic rather than float seconds (SURVEY §A T1-T3).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compound -> chart colour, exact upper-case match, default grey (fixed values).
COMPOUND_COLOURS = {
    "HARD": "#D9D9D9",
    "MEDIUM": "yellow",
    "SOFT": "red",
    "INTERMEDIATE": "green",
    "WET": "blue",
}
DEFAULT_COLOUR = "grey"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ms(us: str | Column, rounding: str = "round") -> Column:
    """Integer microseconds -> integer milliseconds (NULL stays NULL).

    ``round``: nearest ms, ties to even (Python ``round``), as the full
    ingest does. ``truncate``: toward zero (Python ``int``), as the simple
    ingest does, minus its float error.

    ``us / 1000.0`` is exact at every tie (x.5 is a double) and cannot round
    across one elsewhere, so both are exact for |us| < 2**53 / 1000
    (about 104 days, far beyond any session).
    """
    ms = _c(us).cast("double") / 1000.0
    if rounding == "truncate":
        return ms.cast("long")
    if rounding != "round":
        raise ValueError(f"rounding must be 'round' or 'truncate', not {rounding!r}")
    return F.bround(ms, 0).cast("long")


def seconds_text_to_us(text: str | Column) -> Column:
    """C1 fallback: a numeric string is seconds (``'90.5'`` -> 90,500,000 us); else NULL."""
    return (F.trim(_c(text)).try_cast("decimal(38,6)") * 1000000).cast("long")


def duration_text_to_us(text: str | Column) -> Column:
    """C1 for text: ``[D days ][H:]M:S[.f]`` or plain seconds -> microseconds; anything else is NULL."""
    t = F.trim(_c(text))
    clock = r"^(?:(\d+) days? )?(?:(\d+):)?(\d+):(\d+(?:\.\d+)?)$"

    def part(k: int, us: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(t, clock, k), F.lit("")).try_cast("decimal(28,6)"), F.lit(0)) * us

    total = part(1, 86_400_000_000) + part(2, 3_600_000_000) + part(3, 60_000_000) + part(4, 1_000_000)
    return F.when(t.rlike(clock), total.cast("long")).otherwise(seconds_text_to_us(t))


def nullable_int(x: str | Column) -> Column:
    """Float-with-NaN -> int, truncating; NaN and NULL -> NULL (ANSI casts of NaN raise)."""
    x = _c(x)
    return F.when(x.isNotNull() & ~F.isnan(x), x).cast("int")


def clean(c: str | Column, *fallbacks: str | Column, default: str | None = "") -> Column:
    """``str(a or b or default).strip()``.

    NULL and '' count as missing (Python truthiness); the first present
    value is trimmed afterwards, so '  ' is present and cleans to ''.
    """
    parts = [F.nullif(_c(x), F.lit("")) for x in (c, *fallbacks)]
    if default is not None:
        parts.append(F.lit(default))
    return F.trim(F.coalesce(*parts))


def or_default(x: str | Column, default) -> Column:
    """``x or default`` for numbers (NULL and 0 both give the default)."""
    x = _c(x)
    return F.when(x.isNull() | (x == 0), F.lit(default)).otherwise(x)


def compound_colour(compound: str | Column) -> Column:
    """C14: chart colour of a compound; unknown or NULL -> grey."""
    m = F.create_map(*[F.lit(v) for kv in COMPOUND_COLOURS.items() for v in kv])
    return F.coalesce(F.try_element_at(m, _c(compound)), F.lit(DEFAULT_COLOUR))


def chart_title(track: str | Column) -> Column:
    """``"{track} – Pit Stop Strategy"``."""
    return F.format_string("%s – Pit Stop Strategy", _c(track))


def chart_subtitle(year: str | Column, session_type: str | Column) -> Column:
    """``"{year} {session_type}"``."""
    return F.format_string("%s %s", _c(year), _c(session_type))


def lap_label(n: str | Column) -> Column:
    """``"Lap {n}"``."""
    return F.format_string("Lap %s", _c(n))
