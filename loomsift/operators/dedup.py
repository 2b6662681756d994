"""First-wins duplicate removal and feed-local title removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be a total arrival order.

    Planned as a group limit before the shuffle as well as after it, so each task
    sends at most one row per key, however hot a key is. A null key is one key.
    """
    names = [f"_key{i}" for i in range(len(key))]
    keyed = df.select("*", *(k.alias(n) for k, n in zip(key, names, strict=True)))
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return keyed.withColumn("_place", place).where("_place = 1").drop("_place", *names)


def per_group(df: DataFrame, group: Sequence[Column], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group: quotas and per-source limits."""
    names = [f"_group{i}" for i in range(len(group))]
    keyed = df.select("*", *(k.alias(g) for k, g in zip(group, names, strict=True)))
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return keyed.withColumn("_place", place).where(F.col("_place") <= n).drop("_place", *names)


def against_ledger(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows whose key the ledger doesn't hold. A null key is one key, as for
    ``first_wins``."""
    known = ledger.select(F.col(key).alias("_known")).distinct()
    return df.join(known, df[key].eqNullSafe(known["_known"]), "left_anti")
