"""Time-decay expressions (P1) and day arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DAY_MS

# Pruning and decay defaults of the portrait jobs.
MIN_WEIGHT = 0.01             # weights below this may be pruned; also the
                              # fraction left after one decay period
MIN_KEYWORDS_COUNT = 10       # pruning stops while total - 1 <= this
BASE_COEFFICIENT = 0.9        # fixed-coefficient decay of guest portraits
DEFAULT_FACTOR = 0.9          # factor when the period rule does not apply
WEIGHT_FLOOR = 0.001          # decayed weights never go below this
PERIOD_DAYS = 30


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def whole_days(as_of_ms, ts_ms: Column) -> Column:
    """Whole days from ``ts_ms`` to ``as_of_ms``, truncated toward zero."""
    return ((_lit(as_of_ms) - ts_ms) / F.lit(DAY_MS)).cast("long")


def decay_factor(days: Column, period: int = PERIOD_DAYS, fraction: float = MIN_WEIGHT) -> Column:
    """``fraction ** ((days mod period) / period)`` when period > 0,
    days > 0 and 0 < fraction < 1; otherwise 0.9. The modulo is intended:
    day ``period`` gives factor 1 again."""
    if not (period > 0 and 0 < fraction < 1):
        return F.lit(DEFAULT_FACTOR)
    rate = math.log(fraction) / period
    return F.when(days > 0, F.exp(F.lit(rate) * (days % F.lit(period)))).otherwise(F.lit(DEFAULT_FACTOR))


def floor_and_round(w: Column, floor: float = WEIGHT_FLOOR, scale: int = 4) -> Column:
    """Clamp to the floor (values <= floor become floor), then round half-up."""
    return F.round(F.when(w <= F.lit(floor), F.lit(floor)).otherwise(w), scale)


def coefficient_power(days: Column, coefficient: float = BASE_COEFFICIENT) -> Column:
    """Fixed-coefficient decay over ``max(1, days)`` days."""
    return F.pow(F.lit(coefficient), F.greatest(F.lit(1), days).cast("double"))
