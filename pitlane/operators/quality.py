"""Outlier removal (X1) and standardisation (X2), advertised by the reference
without code; definitions are ours (SURVEY §2.12).

Both compute per-group statistics with aggregates (partial + final, so a
hot session is combined map-side) and join the small per-group result
back, instead of a window over the group; AQE broadcasts it from its real size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_safe_join(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    s = stats.select(*[F.col(k).alias(f"_k_{k}") for k in by], *[c for c in stats.columns if c not in by])
    cond = None
    for k in by:
        c = df[k].eqNullSafe(s[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return df.join(s, cond, "inner").drop(*[f"_k_{k}" for k in by])


def iqr_fences(laps: DataFrame, by: Sequence[str] = ("session_id", "compound"), col: str = "lap_time_ms",
               k: float = 1.5) -> DataFrame:
    """Per group: exact quartiles (linear interpolation) and the Tukey fences.

    ``percentile`` keeps a value -> count map per group, bounded by the
    number of distinct lap times, not by the number of laps.
    """
    q = F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.75)))
    return (
        laps.where(F.col(col).isNotNull())
        .groupBy(*by)
        .agg(q.alias("_q"))
        .select(
            *by,
            (F.col("_q")[0] - k * (F.col("_q")[1] - F.col("_q")[0])).alias("lower_fence"),
            (F.col("_q")[1] + k * (F.col("_q")[1] - F.col("_q")[0])).alias("upper_fence"),
        )
    )


def drop_outliers(laps: DataFrame, by: Sequence[str] = ("session_id", "compound"), col: str = "lap_time_ms",
                  k: float = 1.5) -> DataFrame:
    """Timed laps inside their group's fences (a NULL group key is a group)."""
    by = list(by)
    fenced = _null_safe_join(laps.where(F.col(col).isNotNull()), iqr_fences(laps, by, col, k), by)
    return fenced.where(F.col(col).between(F.col("lower_fence"), F.col("upper_fence"))).drop(
        "lower_fence", "upper_fence"
    )


def standardise(laps: DataFrame, by: Sequence[str] = ("session_id",), col: str = "lap_time_ms") -> DataFrame:
    """Compound upper-cased and trimmed; lap time as a z-score within its session.

    z is NULL for an untimed lap or a group whose sample deviation is NULL or 0.
    """
    by = list(by)
    stats = laps.where(F.col(col).isNotNull()).groupBy(*by).agg(
        F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd")
    )
    out = laps.join(stats, by, "left")  # session keys are never NULL
    return out.select(
        *[c for c in laps.columns if c != "compound"],
        F.upper(F.trim("compound")).alias("compound"),
        ((F.col(col) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))).alias(f"{col}_z"),
    )
