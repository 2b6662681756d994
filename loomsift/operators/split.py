"""Seeded order, exact splits, quotas, samples and weighted choice.

Order comes from a hash of seed and key, so it is the same on any cluster. An exact
split needs ranks over all rows; these come without a global sort: rows fall into
buckets by the first digits of their hash, bucket sizes are added up (a table of at
most ``BUCKETS`` rows), and rows are ranked within their bucket only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the hash that name a bucket.
DIGITS = 4
BUCKETS = 16**DIGITS

# Sizes of the two splits.
ASSEMBLER_FLOOR = 500
EVAL_SHARE = 0.05
# End of fixed values.


def seeded(seed: int, *key: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]), 256)


def ranked(df: DataFrame, hashed: Column, ties: Sequence[Column] = (), rank: str = "rank", total: str = "total") -> DataFrame:
    """``df`` with each row's 1-based rank by ``hashed`` over all rows, and their
    number."""
    rows = df.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, DIGITS))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One row per bucket, so a window over all of them stays small.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(every).alias(total))
    within = Window.partitionBy("_bucket").orderBy("_hash", *ties)
    return (
        rows.withColumn("_place", F.row_number().over(within))
        .join(F.broadcast(bases), "_bucket")  # at most BUCKETS rows
        .withColumn(rank, F.col("_base") + F.col("_place"))
        .drop("_hash", "_bucket", "_base", "_place")
    )


def factory_split(df: DataFrame, key: str, seed: int = 42, eval_share: float = EVAL_SHARE) -> DataFrame:
    """Adds ``split``: train is the head, max(1, floor(n * (1 - share))) rows."""
    rows = ranked(df, seeded(seed, F.col(key)), [F.col(key)])
    cut = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(1 - eval_share)))
    return rows.withColumn("split", F.when(F.col("rank") <= cut, "train").otherwise("eval"))


def assembler_split(df: DataFrame, key: str, seed: int = 42, eval_share: float = EVAL_SHARE) -> DataFrame:
    """Adds ``split``: eval is the head, max(500, floor(n * share)) rows; with 500
    rows or fewer, train is empty. Not stratified."""
    rows = ranked(df, seeded(seed, F.col(key)), [F.col(key)])
    cut = F.greatest(F.lit(ASSEMBLER_FLOOR), F.floor(F.col("total") * F.lit(eval_share)))
    return rows.withColumn("split", F.when(F.col("rank") <= cut, "eval").otherwise("train"))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for a seed: a distributed top-n."""
    return df.withColumn("_hash", seeded(seed, F.col(key))).orderBy("_hash", key).limit(n).drop("_hash")


def pick(pool: Sequence[str], seed: int, *key: Column) -> Column:
    """One of a pool per row, by a hash of seed and key."""
    number = F.conv(F.substring(seeded(seed, *key), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*map(F.lit, pool)), (F.pmod(number, F.lit(len(pool))) + 1).cast("int"))


def pick_some(pool: Sequence[str], n: int, seed: int, *key: Column) -> Column:
    """n distinct members of a pool per row, in hash order."""
    hashed = F.transform(F.array(*map(F.lit, pool)), lambda x: F.struct(seeded(seed, *key, x).alias("h"), x.alias("x")))
    return F.slice(F.transform(F.array_sort(hashed), lambda s: s.x), 1, n)


def roll(seed: int, *key: Column) -> Column:
    """A number in [0, 1) per row, from the first 8 hex digits of the hash."""
    return F.conv(F.substring(seeded(seed, *key), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def weighted(remaining: Mapping[str, int], where: Column) -> Column:
    """The first name whose cumulative weight exceeds ``where`` (in [0, 1)) of the
    total; names without weight are never chosen."""
    total, running, out = sum(remaining.values()), 0, None
    for name, weight in remaining.items():
        running += weight
        hit = where * total < running
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def picks_before(pick: Column, quota: Column, place: Column, quotas: Sequence[int]) -> Column:
    """How many picks of each name precede a name's ``pick``-th (from 1), where the k-th
    of a name with quota q falls at (k - 1/2) / q and ties go to the earlier name: an
    array, one number for each of ``quotas``. ``place`` is the name's own place (from 0).

    Arithmetic on whole numbers alone: the k-th of another quota p comes before where
    (2k - 1) q < (2 pick - 1) p.
    """
    at, own = (2 * pick - 1).cast("decimal(19,0)"), (2 * quota).cast("decimal(19,0)")
    before = []
    for other, p in enumerate(quotas):
        reach = at * F.lit(p).cast("decimal(18,0)") + quota
        over = reach % own
        with_ties = ((reach - over) / own).cast("long")  # picks that come before or fall together
        tie = (over == 0) & (place <= other)  # not won by the name itself or a later one
        before.append(F.least(F.lit(p).cast("long"), with_ties - F.when(tie, 1).otherwise(0)))
    return F.array(*before)


def apportioned(df: DataFrame, name: str, pick: str, quotas: Mapping[str, int], out: str = "turn") -> DataFrame:
    """Deals turns to the picks of several names by their remaining quota, without drawing,
    sorting or counting one after another: adds ``out``, the turn (from 1) of each row,
    the ``pick``-th of its name, and ``before``, the picks of each name until then (by the
    order of ``quotas``, the row's own not counted).

    After any number of turns a name is within (1 + names * share) / 2 of its part, where
    share is its quota over all, and in practice within one (a test measures it). Picks
    beyond their quota and names without one have no turn.
    """
    known = [(n, q) for n, q in quotas.items() if q > 0]
    if not known:
        return df.withColumn(out, F.lit(None).cast("long")).withColumn("before", F.lit(None).cast("array<long>"))
    look = lambda values: F.element_at(F.create_map(*[x for (n, _), v in zip(known, values, strict=True) for x in (F.lit(n), F.lit(v).cast("long"))]), F.col(name))
    quota, place = look([q for _, q in known]), look(range(len(known)))
    before = picks_before(F.col(pick), quota, place, [q for _, q in known])
    due = quota.isNotNull() & F.col(pick).between(1, quota)
    rows = df.withColumn("before", F.when(due, before))
    return rows.withColumn(out, F.aggregate("before", F.lit(1).cast("long"), lambda total, n: total + n))


def numbered(df: DataFrame, by: str, order: str, out: str = "pick", cuts: int = 256) -> DataFrame:
    """Adds each row's 1-based place in its group by ``order``, also where a group holds
    most rows: rows fall into ranges of ``order``, are ranked within group and range, and
    the sizes before are added up (groups x ranges rows, so groups must be few)."""
    ends = df.agg(F.percentile_approx(order, [i / cuts for i in range(1, cuts)])).first()[0] or []
    reach = sorted(set(ends))
    part = F.lit(0) if not reach else F.size(F.filter(F.array(*map(F.lit, reach)), lambda end: end < F.col(order)))
    rows = df.withColumn("_range", part)
    sizes = rows.groupBy(by, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col(by).alias("_by"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(by, "_range").orderBy(order)
    placed = rows.withColumn("_place", F.row_number().over(within)).join(F.broadcast(bases), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_of")))
    return placed.withColumn(out, (F.col("_base") + F.col("_place")).cast("long")).drop("_range", "_place", "_by", "_of", "_base")


def spans(weights: DataFrame, name: str, weight: str, seed: int = 42, digits: int = DIGITS) -> DataFrame:
    """(name, block, low, high): the whole numbers [low, high) that choose a name, for a
    table of any size. Names lie in the order of their hash; blocks are its first digits,
    so there are at most 16 ** digits, and prefix sums run within a block on top of the
    sums of the blocks before. Names that are null or weigh nothing, or less, have none."""
    rows = weights.where(F.col(name).isNotNull() & (F.col(weight) > 0)).select(F.col(name).alias("name"), F.col(weight).cast("long").alias("_w"))
    rows = rows.withColumn("_hash", seeded(seed, F.col("name"))).withColumn("block", F.substring("_hash", 1, digits))
    sums = rows.groupBy("block").agg(F.sum("_w").alias("_sum"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    bases = sums.select("block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    up_to = F.sum("_w").over(Window.partitionBy("block").orderBy("_hash", "name").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    high = F.col("_base") + up_to
    return rows.join(F.broadcast(bases), "block").select("name", "block", (high - F.col("_w")).alias("low"), high.alias("high"))


def roulette(df: DataFrame, where: Column, spans: DataFrame, out: str = "name") -> DataFrame:
    """Adds the name whose span holds ``where`` (in [0, 1)) of the total; null for a null
    ``where`` or where there are no names. A row finds its block by binary search over
    the blocks' first numbers, and its span among the few of the block by a join."""
    blocks = spans.groupBy("block").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("low").collect()  # at most 16 ** digits rows
    if not blocks:
        return df.withColumn(out, F.lit(None).cast(spans.schema["name"].dataType))
    starts, names, total = np.array([b.low for b in blocks]), [b.block for b in blocks], blocks[-1].high

    @F.pandas_udf("string")
    def block_of(at: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.array(names, dtype=object)
        for batch in at:
            found = np.searchsorted(starts, batch.fillna(0).to_numpy(np.int64), "right") - 1
            yield pd.Series(table[found]).where(batch.notna().to_numpy(), None)

    rows = df.withColumn("_at", F.floor(where * F.lit(float(total)))).withColumn("_in", block_of("_at"))
    held = spans.select(F.col("name").alias("_name"), F.col("block").alias("_block"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    near = (F.col("_in") == F.col("_block")) & (F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_high"))
    return rows.join(held, near, "left").withColumn(out, F.col("_name")).drop("_at", "_in", "_name", "_block", "_low", "_high")


def round_robin(index: Column, k: int | Column) -> Column:
    return F.pmod(index, k if isinstance(k, Column) else F.lit(k))


def work_queue(spark, target: int, done: DataFrame, key: str = "idx", margin: float = 0.2) -> DataFrame:
    """Indices below twice the target that aren't done, in order, up to the target
    and a margin over it."""
    todo = spark.range(2 * target).withColumnRenamed("id", key).join(done.select(key).distinct(), key, "left_anti")
    return todo.orderBy(key).limit(int(target * (1 + margin)))
