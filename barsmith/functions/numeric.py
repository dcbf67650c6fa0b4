"""Scalar helpers shared by every feature set.

Spark 4 runs with ANSI mode on, where ``x / 0`` raises. Every ratio in this
library goes through :func:`safe_div`, which yields NULL instead (the pandas
builders would give NaN or +-inf; NULL is the Spark-native "no value").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return F.try_divide(col(a), col(b))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (Spark aggregates skip NULL but propagate NaN)."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def pct_change(cur: str | Column, prev: str | Column) -> Column:
    """(cur - prev) / prev as a fraction."""
    return safe_div(col(cur) - col(prev), col(prev))


def clamp_positive(c: str | Column) -> Column:
    """``where(d > 0, 0)`` in pandas: keeps positive values, else 0.

    A NULL input (the first bar has no previous close) becomes 0 as well,
    which is what the pandas rule does with its leading NaN.
    """
    c = col(c)
    return F.when(c > 0, c).otherwise(F.lit(0.0))
