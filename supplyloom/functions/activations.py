"""Scalar functions of scores and losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clamp_min(x: Column, floor: float = 0.0) -> Column:
    """Null stays null (``greatest`` alone would skip it)."""
    return F.when(x < F.lit(floor), F.lit(floor)).otherwise(x)


def bce_with_logits(logit: Column, label: Column) -> Column:
    """Stable binary cross-entropy of a logit against a 0/1 label."""
    return clamp_min(logit) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def margin(positive: Column, negative: Column) -> Column:
    return clamp_min(negative - positive + F.lit(1.0))
