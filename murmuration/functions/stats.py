"""Weights and interval arithmetic of the bucketed signal."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half-width of the interval of a thin bucket.
THIN_SPREAD = 0.6
THIN_FLOOR = 0.15
# Fixed value: the volume z-score is divided by this before tanh.
Z_SCALE = 3.0


def engagement_weight(engagement: Column) -> Column:
    return F.log1p(F.greatest(engagement, F.lit(0)).cast("double"))


def normal_quantile(confidence: float) -> float:
    return NormalDist().inv_cdf(0.5 + confidence / 2)


def interval_margin(n: Column, variance: Column, min_sample: int, confidence: float) -> Column:
    thin = F.lit(THIN_SPREAD) * (F.lit(1.0) - n / F.lit(float(min_sample))) + F.lit(THIN_FLOOR)
    normal = F.lit(normal_quantile(confidence)) * F.sqrt(variance / n)
    return F.when(n < min_sample, thin).otherwise(normal)


def clamp_unit(value: Column) -> Column:
    return F.greatest(F.least(value, F.lit(1.0)), F.lit(-1.0))
