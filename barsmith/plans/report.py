"""Final rounding of test-query outputs.

Engines add floating-point values in different orders, so sums, means and
standard deviations can differ in the last bits. Test queries round such
columns (means to 6 places, dispersion-type values to 4) in both Spark and
the SQL oracle; exact operations (differences, ratios of inputs) stay as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])
