"""Logistic membership of single features: how likely each value is for a true event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (falls, log10, steepness, centre) by feature.
CURVES = {
    "max_distance_km": (True, False, 8.0, 1.0),
    "median_linelet": (True, True, 3.0, -5.0),
    "time_duration": (True, False, 2.0, 6.0),
    "line_fit_residual": (True, True, 3.0, -5.0),
    "group_count": (False, False, 0.07, 25.0),
    "energy_balance": (False, False, 25.0, 0.3),
    "max_line_distance": (True, False, 3000.0, 0.005),
    "max_line_distance_ratio": (True, False, 80.0, 0.4),
    "mean_spline_residual": (True, True, 3.0, -2.0),
}


def membership(feature: str, x: Column) -> Column:
    falls, log, steep, centre = CURVES[feature]
    v = F.when(x > 0, F.log10(x)).otherwise(F.lit(float("-inf"))) if log else x
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), (v - centre) * steep))
    p = 1 / (1 + F.exp(-z))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - p if falls else p))


def cascade(df, steps: list[tuple[str, Column, float]], out: str = "probability"):
    """Multiplies memberships step by step, dropping rows under each step's cutoff on the way."""
    df = df.withColumn(out, F.lit(1.0))
    for feature, x, cutoff in steps:
        df = df.withColumn(out, F.col(out) * membership(feature, x)).where(F.col(out) >= cutoff)
    return df
