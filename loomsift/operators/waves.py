"""Making rows in waves, up to a quota for each category.

Candidates are numbered within their category. A category asks for its next ones in
order, as many as the pass rate so far says it needs, and stops when it has its target,
so what a full category doesn't need is never made. One wave serves all categories with
one job, whose result is written before it is read; between waves the driver holds
three numbers for each category. What is kept are a category's first passing candidates
in order, so it doesn't depend on how waves are sized.

A category is never sent more candidates than would bring it ``margin`` above its target
if all passed, and its numbers end at ``most`` times the target.

Rows, defined: candidates without a category or number are never made; repeated numbers
are made together and all count; a category without a target isn't asked; one whose
candidates end stays short; empty tables and targets of 0 make nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# How far a queue goes beyond the target, and where its numbers end.
MARGIN, MOST = 0.2, 2
# End of fixed values.


@dataclass
class Quota:
    """What a category wants, has been sent, and has kept."""

    target: int
    asked: int = 0  #: numbers below this one have been made
    passed: int = 0
    sent: int = 0  #: candidates made, which may be fewer than numbers
    waves: int = 0

    def next(self, pace: float = 1.0, margin: float = MARGIN, most: int = MOST) -> int:
        """Candidates of the next wave: what is missing over the pass rate, which starts
        at one; ``pace`` scales it."""
        missing = self.target - self.passed
        if missing <= 0:
            return 0
        wanted = math.ceil(missing * (self.asked + 1) / (self.passed + 1) * pace)
        room = math.floor(self.target * (1 + margin)) - self.passed
        return max(0, min(max(1, wanted), max(1, room), most * self.target - self.asked))


def in_waves(
    candidates: DataFrame, make: Callable[[DataFrame], DataFrame], passes: Column, targets: Mapping[str, int], category: str = "category",
    number: str = "idx", pace: float = 1.0, margin: float = MARGIN, most: int = MOST,
) -> tuple[DataFrame, dict[str, Quota]]:
    """The kept rows, each category's first ``target`` that pass, and what became of the
    quotas. ``make`` turns candidates into rows that hold their columns."""
    spark = candidates.sparkSession
    quotas = {name: Quota(target) for name, target in targets.items()}
    kept = None
    while True:
        ahead = {name: quota.next(pace, margin, most) for name, quota in quotas.items()}
        ahead = {name: n for name, n in ahead.items() if n}
        if not ahead:
            break
        bounds = spark.createDataFrame([(name, quotas[name].asked, quotas[name].asked + n) for name, n in ahead.items()], "_name string, _from long, _to long")
        low, high = min(quotas[n].asked for n in ahead), max(quotas[n].asked + m for n, m in ahead.items())
        rows = candidates.where(F.col(number).between(low, high - 1) & F.col(category).isin(*ahead))  # reaches the scan
        rows = rows.join(F.broadcast(bounds), F.col(category) == F.col("_name")).where((F.col(number) >= F.col("_from")) & (F.col(number) < F.col("_to")))
        made = written(make(rows.drop("_name", "_from", "_to")).withColumn("_passed", F.coalesce(passes, F.lit(False))), "wave")
        told = {r[0]: r for r in made.groupBy(category).agg(F.count("*").alias("sent"), F.count_if("_passed").alias("passed")).collect()}  # one row a category
        for name, n in ahead.items():
            quota = quotas[name]
            quota.asked, quota.waves = quota.asked + n, quota.waves + 1
            if name in told:
                quota.sent, quota.passed = quota.sent + told[name].sent, quota.passed + told[name].passed
        good = made.where("_passed").drop("_passed")
        kept = good if kept is None else kept.unionByName(good)
    if kept is None:
        kept = make(candidates.limit(0))
    goal = spark.createDataFrame(list(targets.items()), "_name string, _target long")
    place = F.row_number().over(Window.partitionBy(category).orderBy(number))
    ranked = kept.join(F.broadcast(goal), F.col(category) == F.col("_name")).withColumn("_place", place)
    return ranked.where(F.col("_place") <= F.col("_target")).drop("_name", "_target", "_place"), quotas
