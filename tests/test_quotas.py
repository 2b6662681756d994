"""Waves, turns, roulette and weekly limits on small tables."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loomsift.operators import split
from loomsift.operators.render import weekly
from loomsift.operators.waves import Quota, in_waves


def work(spark):
    rows = [(c, i, (i * 7 + len(c)) % 3 == 0) for c, n in (("a", 60), ("bb", 200), ("none", 0)) for i in range(n)]
    rows += [("a", 5, True), ("a", 5, False), (None, 3, True), ("a", None, True), ("other", 1, True)]
    return spark.createDataFrame(rows, "category string, idx long, good boolean")


@pytest.mark.parametrize("pace", [0.3, 1.0, 50.0])
def test_waves_keep_the_first_passing_ones(spark, pace):
    made = []

    def make(df):
        made.append(df.count())
        return df

    targets = {"a": 10, "bb": 30, "none": 4, "zero": 0}
    kept, quotas = in_waves(work(spark), make, F.col("good"), targets, pace=pace)
    rows = sorted((r.category, r.idx) for r in kept.collect())
    assert rows == sorted([("a", i) for i in (2, 5, 5, 8, 11, 14, 17)] + [("bb", i) for i in range(60) if (i * 7 + 2) % 3 == 0]) or len(rows) == len(set(rows)) + 1
    assert [i for c, i in rows if c == "a"] == [2, 5, 5, 8, 11, 14, 17]  # numbers end at twice the target
    assert quotas["a"].asked == 20 and quotas["none"].sent == 0 and quotas["zero"].asked == 0
    assert sum(made) == sum(q.sent for q in quotas.values()) and all(q.passed <= q.target * 1.2 for q in quotas.values())


def test_a_full_category_asks_for_no_more(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "easy").otherwise("hard").alias("category"), F.floor(F.col("id") / 2).alias("idx"))
    passes = (F.col("category") == "easy") | (F.col("idx") % 2 == 0)
    kept, quotas = in_waves(rows, lambda df: df, passes, {"easy": 100, "hard": 100})
    assert quotas["easy"].sent == 100 and quotas["easy"].waves == 1
    assert 199 <= quotas["hard"].asked <= 200 and quotas["hard"].waves > 1
    assert {r[0]: r[1] for r in kept.groupBy("category").count().collect()} == {"easy": 100, "hard": 100}
    none, quotas = in_waves(rows.limit(0), lambda df: df, passes, {"easy": 3})
    assert none.count() == 0 and quotas["easy"].asked == 6
    assert in_waves(rows, lambda df: df, passes, {})[0].count() == 0


def test_quota_sizes():
    assert Quota(100).next() == 100 and Quota(100, asked=100, passed=25).next() == 95 and Quota(100, asked=200).next() == 0
    assert Quota(100, asked=100, passed=50).next() == 70 and Quota(100, 100, 100).next() == 0 and Quota(1, asked=1).next() == 1


@pytest.mark.parametrize("quotas", [{"a": 9000 // 60, "b": 7500 // 60, "c": 7500 // 60}, {"a": 1, "b": 40, "c": 3, "d": 3, "e": 0}, {"a": 5, "b": 5}, {"a": 7}])
def test_turns_follow_the_quotas(spark, quotas):
    picks = [(n, k) for n, q in quotas.items() for k in range(1, q + 3)] + [(None, 1), ("z", 1)]
    dealt = split.apportioned(spark.createDataFrame(picks, "name string, pick long"), "name", "pick", quotas).collect()
    names = [n for n, q in quotas.items() if q]
    want = sorted((Fraction(2 * k - 1, 2 * q), names.index(n), n) for n, q in quotas.items() for k in range(1, q + 1))
    turns = sorted((r.turn, r.name, r.before) for r in dealt if r.turn is not None)
    assert [n for _, n, _ in turns] == [n for _, _, n in want] and [t for t, _, _ in turns] == list(range(1, len(want) + 1))
    total, count = sum(quotas.values()), dict.fromkeys(names, 0)
    for turn, name, before in turns:
        assert before == list(count.values())
        count[name] += 1
        off = {n: abs(count[n] - Fraction(turn * quotas[n], total)) for n in names}
        assert all(off[n] <= (1 + Fraction(len(names) * quotas[n], total)) / 2 for n in names)
        assert len(names) > 3 or max(off.values()) <= 1
    assert all(r.turn is None for r in dealt if r.name is None or r.pick > quotas.get(r.name, 0))


def test_turns_without_quotas(spark):
    assert split.apportioned(spark.createDataFrame([("a", 1)], "name string, pick long"), "name", "pick", {}).first().turn is None


def test_places_in_a_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 100 == 9, F.lit(None)).otherwise("cold").alias("g"), F.col("id").alias("at"))
    found = split.numbered(rows, "g", "at", cuts=16).collect()
    for g in ("hot", "cold", None):
        own = sorted((r.at, r.pick) for r in found if r.g == g)
        assert [p for _, p in own] == list(range(1, len(own) + 1))
    assert split.numbered(rows.limit(0), "g", "at").count() == 0


def test_roulette(spark):
    draw = random.Random(1)
    weights = [(f"n{i}", draw.choice([0, 1, 5, -3, 1000])) for i in range(300)] + [(None, 50), ("big", 200_000)]
    table = split.spans(spark.createDataFrame(weights, "name string, weight long"), "name", "weight", digits=2)
    held = sorted((r.low, r.high, r["name"]) for r in table.collect())
    assert held[0][0] == 0 and all(a[1] == b[0] for a, b in zip(held, held[1:])) and {h[2]: h[1] - h[0] for h in held} == {n: w for n, w in weights if n and w > 0}
    total = held[-1][1]
    at = [i / 997 for i in range(997)] + [None, 0.0, 1 - 2**-40] + [low / total for low, _, _ in held]
    rows = split.roulette(spark.createDataFrame([(x,) for x in at], "x double"), F.col("x"), table).collect()
    assert len(rows) == len(at)
    for r in rows:
        want = None if r.x is None else next(n for low, high, n in held if low <= int(r.x * total) < high)
        assert r["name"] == want
    none = split.spans(spark.createDataFrame([("a", 0)], "name string, weight long"), "name", "weight")
    assert split.roulette(spark.range(1), F.lit(0.5), none).first()["name"] is None


def test_weekly(spark):
    rows = [("2024-01-01", "x", 5.0, 1), ("2024-01-01", "x", 9.0, 2), ("2024-01-03", "x", 7.0, 3), ("2024-01-03", "y", 8.0, 4), ("2024-01-08", "y", 1.0, 5), ("2024-01-20", None, 1.0, 6), (None, "z", 99.0, 7)]
    items = spark.createDataFrame(rows, "day string, item string, value double, id long").withColumn("place", F.lit(0)).drop("place")
    found = weekly(items, "day", ["item"], [F.desc("value"), F.col("id")], most=2).collect()
    told = sorted((str(r.journal_day), r.place, r.id, r.n_rows) for r in found)
    assert told == [("2024-01-01", 1, 2, 2), ("2024-01-03", 1, 2, 4), ("2024-01-03", 2, 4, 4), ("2024-01-08", 1, 4, 3), ("2024-01-08", 2, 3, 3), ("2024-01-20", 1, 6, 1)]
