"""Two-proportion statistics on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_proportion_z(event_a: Column, total_a: Column, event_b: Column, total_b: Column) -> Column:
    """Pooled z statistic of rate a minus rate b; NULL when it is undefined."""
    a, n_a = event_a.cast("double"), F.nullif(total_a.cast("double"), F.lit(0.0))
    b, n_b = event_b.cast("double"), F.nullif(total_b.cast("double"), F.lit(0.0))
    pooled = (a + b) / (n_a + n_b)
    variance = pooled * (1 - pooled) * (1 / n_a + 1 / n_b)
    return F.when(variance > 0, (a / n_a - b / n_b) / F.sqrt(F.nullif(variance, F.lit(0.0))))


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value: the complementary error function at |z| / sqrt(2).

    Spark SQL has none. Up to 2 it is one minus the error function's series, from there on a
    continued fraction, which keeps the relative precision of small tails. Both have a fixed
    number of terms, beyond what a double can tell. The one-element array binds the argument: as
    plain columns each term would hold, and the optimizer visit, a copy of how z is computed.
    """
    return F.transform(F.array(F.abs(z.cast("double")) / math.sqrt(2)), _complement)[0]


def _complement(x: Column) -> Column:
    series, twice = F.lit(1.0), 2 * x * x
    for n in range(45, 0, -1):
        series = 1 + twice / (2 * n + 1) * series
    fraction, part = F.lit(1.0), F.lit(1.0) / F.nullif(twice, F.lit(0.0))
    for n in range(60, 0, -1):
        fraction = 1 + n * part / fraction
    bell = F.exp(-x * x) / math.sqrt(math.pi)
    return F.when(x < 2, 1 - 2 * x * bell * series).otherwise(bell / (x * fraction))


def cohen_h(rate_a: Column, rate_b: Column) -> Column:
    def arc(rate: Column) -> Column:
        clamped = F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))
        # greatest/least skip NULLs, so an undefined rate must stay NULL explicitly
        return F.when(rate.isNotNull(), F.asin(F.sqrt(clamped)))

    return 2 * arc(rate_a) - 2 * arc(rate_b)


def significant(p_value: Column, level: float = 0.05) -> Column:
    return p_value < level
