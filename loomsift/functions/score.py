"""Scores of a prediction against a reference, and ratios with guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def length_ratio(prediction: Column, reference: Column) -> Column:
    """Shorter length over longer, at least 1; both empty gives 0."""
    a, b = F.length(F.coalesce(prediction, F.lit(""))), F.length(F.coalesce(reference, F.lit("")))
    return F.least(a, b) / F.greatest(a, b, F.lit(1))


def exact_match(prediction: Column, reference: Column) -> Column:
    same = strip(F.coalesce(prediction, F.lit(""))) == strip(F.coalesce(reference, F.lit("")))
    return F.when(same, 1.0).otherwise(0.0)


def share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))
