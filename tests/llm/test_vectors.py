"""Near-duplicate embeddings and hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsift.llm import embedding_dedup, hard_negatives, jaccard_join
from loomsift.llm.embedding_dedup import Plan

ODD = [None, [], [0.0, 0.0, 0.0], [math.inf, 1.0, 2.0], [math.nan, 1.0, 2.0], [None, 1.0, 2.0], [1e300, 1e300, 0.0], [1e-310, 1e-310, 0.0], [1.0, 1.0], [2.0, 2.0], [-0.0, 1.0, 0.0], [0.0, 3.0, 0.0]]


def clustered(seed, n=240, length=24):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((12, length))
    out = middle[rng.integers(0, 12, n)] + rng.standard_normal((n, length)) * rng.choice([0, 0.05, 0.2, 0.5], n)[:, None]
    return [[float(x) for x in v] for v in out]


def linked(rows, cosine):
    """Links, components by plain search."""
    fit = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v) / max(map(abs, v)) if fit(v) else None for _, v in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    near = [[j for j, w in enumerate(unit) if j != i and u is not None and w is not None and len(u) == len(w) and u @ w >= cosine] for i, u in enumerate(unit)]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen |= set(new)
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(near[i]), least, key == least))
    return sorted(out, key=repr)


def frame(spark, rows):
    df = spark.createDataFrame([(i, v, 7, 1) for i, v in rows], "vec_id long, embedding array<double>, digest int, copies int")
    return df.withColumn("component", F.lit("x"))


@pytest.mark.parametrize("seed", range(2))
def test_links_equal_all_pairs(spark, seed):
    rows = list(enumerate(clustered(seed))) + [(1000 + i, v) for i, v in enumerate(ODD)]
    rows += [(None, rows[5][1]), (None, [9.0] * 24), (None, [9.0] * 24), (3, rows[3][1]), (3, rows[9][1]), (-4, [2 * x for x in rows[7][1]])]
    found = embedding_dedup.link(frame(spark, rows))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked(rows, 0.95)


def test_no_vectors(spark):
    assert embedding_dedup.link(frame(spark, [(1, None)]).limit(0)).count() == 0
    assert [tuple(r) for r in embedding_dedup.link(frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_hot_groups(spark):
    """Copies and near copies in thousands: links are counted, pairs never made."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(i, base.tolist()) for i in range(2000)] + [(2000 + i, (base + rng.standard_normal(16) * 0.01).tolist()) for i in range(2500)]
    rows += [(5000 + i, rng.standard_normal(16).tolist()) for i in range(200)]
    found = {r.vec_id: r for r in embedding_dedup.link(frame(spark, rows)).collect()}
    assert {found[i].n_links for i in range(4500)} == {4499} and {found[i].component_id for i in range(4500)} == {0}
    assert sum(r.kept for r in found.values()) == len({r.component_id for r in found.values()})


def test_full_buckets_are_thinned_in_the_map_pass():
    signature, key, hot = np.array([5] * 100 + [6] * 3, np.uint64), np.arange(103), {}
    kept, keys, edges = jaccard_join.thinned(signature, key, 8, hot)
    assert (kept == 5).sum() == 9 and (kept == 6).sum() == 3 and len(edges) == 91 and set(edges[:, 0]) == {0} and hot == {5: 0}
    assert set(edges[:, 1]) | set(keys[kept == 5]) == set(range(100))
    kept, keys, edges = jaccard_join.thinned(signature, key + 200, 8, hot)  # the task's next batch
    assert (kept == 5).sum() == 0 and len(edges) == 100 and set(edges[:, 0]) == {0} and (kept == 6).sum() == 3
    assert all(len(x) == 0 for x in jaccard_join.thinned(signature[:0], key[:0], 8, hot))


def test_recall_at_the_threshold():
    """Pairs at the threshold itself meet as often as the plan says; near ones always."""
    plan, rng = Plan.of(100_000, 0.95), np.random.default_rng(3)
    for cosine, least in ((0.95, 0.97), (0.98, 0.999)):
        a = rng.standard_normal((1500, 32))
        b = rng.standard_normal((1500, 32))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b -= (a * b).sum(axis=1)[:, None] * a
        b /= np.linalg.norm(b, axis=1)[:, None]
        b = cosine * a + math.sqrt(1 - cosine**2) * b
        every = range(plan.tables)
        met = (embedding_dedup.buckets(a, plan, every) == embedding_dedup.buckets(b, plan, every)).any(axis=1)
        assert met.mean() >= least
    apart = embedding_dedup.buckets(a, plan, every)
    assert (apart[1:] == apart[:-1]).any(axis=1).mean() < 0.01
    assert plan.projections < Plan.of(10**9, 0.95).projections and sum(len(r) for r in Plan.of(10**9, 0.95).rounds()) == Plan.of(10**9, 0.95).tables


def mined(rows, asked, positives=5, k=3, low=50, high=95):
    fit = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    whole = lambda v: [math.floor(min(max(256 * x, -1.7976931348623157e308), 1.7976931348623157e308)) for x in v]
    out = []
    for anchor in {i for i, _, _ in fit if asked(i)}:
        own, label = min((v, y) for i, v, y in fit if i == anchor)
        score = [(-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(whole(own), whole(v), strict=True)))), i, y) for i, v, y in fit if i != anchor and len(v) == len(own)]
        score.sort()
        for place, (s, p, _) in enumerate([x for x in score if x[2] == label][:positives]):
            negatives = [x for x in score if x[2] != label and 100 * -x[0] >= low * -s and 100 * -x[0] <= high * -s][:k]
            out += [(anchor, place + 1, p, rank + 1, i, -s, -n) for rank, (n, i, _) in enumerate(negatives)]
    return sorted(out)


def labelled(spark, rows):
    return spark.createDataFrame([(i, v, y, 0) for i, v, y in rows], "vec_id long, embedding array<double>, label int, slot int").withColumn("score", F.lit("x"))


@pytest.mark.parametrize("tile", [7, 4096])
def test_negatives_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    draw = random.Random(4)
    rows = [(i, v, draw.choice([0, 1, 2, None])) for i, v in enumerate(clustered(9, 150, 8))]
    rows += [(200 + i, v, i % 2) for i, v in enumerate(ODD[:6] + ODD[8:])] + [(None, [1.0] * 8, 1), rows[10], rows[20], (20, [0.5] * 8, 2), (30, [0.0] * 8, 1)]
    rows += [(300 + i, [1.0] * 8, i % 3) for i in range(12)]  # ties
    found = hard_negatives.mine(labelled(spark, rows), F.col("id") % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == mined(rows, lambda i: i % 10 == 0)


def test_negatives_by_groups_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 600)
    rows = [(i, v, i % 4) for i, v in enumerate(clustered(2, 80, 8))]
    found = hard_negatives.mine(labelled(spark, rows), F.col("id") % 8 == 0, positives=2, k=2, low=10, high=99)
    assert sorted(tuple(r) for r in found.collect()) == mined(rows, lambda i: i % 8 == 0, 2, 2, 10, 99)


def test_negatives_of_nothing_and_of_huge_vectors(spark):
    none = labelled(spark, [(0, [1.0], 1)])
    assert hard_negatives.mine(none.limit(0), F.col("id") == 0).count() == 0
    assert hard_negatives.mine(none, F.col("id") == 0).count() == 0
    rows = [(0, [1e200, 1.0], 1), (1, [1e100, 2.0], 1), (2, [1e12, 3.0], 0), (3, [-1e200, 1.0], 0), (4, [1.0, 1.0], 1), (5, [1.7e308, 1.0], 1)]
    found = hard_negatives.mine(labelled(spark, rows), F.col("id") >= 0)
    assert sorted(tuple(r) for r in found.collect()) == mined(rows, lambda i: True)


def test_limits_hold_for_any_score():
    for score in (-7, -1, 0, 1, 19, 20, 21, 2**62):
        least, most = hard_negatives.limits(score, 50, 95)
        for n in range(score // 2 - 3, score // 2 + 3):
            assert (50 * score <= 100 * n) == (n >= least)
        for n in range(95 * score // 100 - 2, 95 * score // 100 + 3):
            assert (100 * n <= 95 * score) == (n <= most)
