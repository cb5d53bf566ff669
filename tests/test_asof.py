"""As-of join and window firings against a direct search."""

import random

import pytest
from pyspark.sql import functions as F

from panewise.operators.asof import asof_join
from panewise.operators.firing import first_firings
from panewise.schema import Params


def direct(left, right, direction, ties):
    sign = 1 if direction == "backward" else -1
    out = []
    for i, k, t in left:
        fit = [(sign * u, v) for q, u, v in right if None not in (k, t, q, u) and q == k and sign * u <= sign * t]
        best = None
        if fit:
            top = max(u for u, _ in fit)
            same = [v for u, v in fit if u == top]
            best = (sign * top, max(same) if ties == "max" else min(same))
        out.append((i, k, t, *(best or (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("ties", ["max", "min"])
def test_against_direct_search(spark, monkeypatch, direction, ties):
    monkeypatch.setattr("panewise.operators.asof.SLOT_BLOCK", 3)
    rng = random.Random(3)
    for span in (60, 100_000):
        left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, rng.randrange(-span, span)]) if i % 9 == 0 else rng.randrange(-span, span)) for i in range(300)]
        right = [(rng.choice(["a", "b", "d", None]), rng.randrange(-span, span), rng.randrange(5)) for _ in range(60)] + [("a", None, 1)]
        lf = spark.createDataFrame(left, "i long, k string, t long")
        rf = spark.createDataFrame(right, "k string, u long, v long")
        got = asof_join(lf, rf, "t", "u", ["k"], direction, ties, slot_ms=17)
        assert got.columns == ["i", "k", "t", "u", "v"]
        assert sorted(map(tuple, got.collect()), key=repr) == direct(left, right, direction, ties)
        alone = asof_join(lf.drop("k"), rf.drop("k"), "t", "u", (), direction, ties, slot_ms=1000)
        want = direct([(i, 0, t) for i, _, t in left], [(0, u, v) for _, u, v in right], direction, ties)
        assert sorted(map(tuple, alone.collect()), key=repr) == sorted([(i, t, *r) for i, _, t, *r in want], key=repr)


def test_empty_sides_and_wrong_arguments(spark):
    left, right = spark.createDataFrame([(1, 5)], "i long, t long"), spark.createDataFrame([(1, 2)], "u long, v long")
    assert asof_join(left.limit(0), right, "t", "u").count() == 0
    assert [tuple(r) for r in asof_join(left, right.limit(0), "t", "u").collect()] == [(1, 5, None, None)]
    with pytest.raises(ValueError):
        asof_join(left, right.withColumnRenamed("v", "t"), "t", "u")
    with pytest.raises(ValueError):
        asof_join(left, right, "t", "u", direction="nearest")


def test_long_spans_of_small_batches(spark):
    """Many batches and window ends over months: an equi-plan, and each end gets its batch."""
    p = Params()
    n = 200_000
    ends = spark.range(n // 2).select((F.col("id") * p.slide_ms * 4).alias("end_ms"))
    marks = spark.range(n).select(
        F.col("id").alias("batch_id"), (F.col("id") * 60_000).alias("batch_max_ms"), F.lit(0).cast("long").alias("batch_min_ms"),
        F.when(F.col("id") > 0, (F.col("id") - 1) * 60_000).alias("max_prev_ms"))
    out = first_firings(ends, marks, p)
    plan = out._jdf.queryExecution().executedPlan()
    # window end 120 s x k, plus the bound of 10 s, is first reached by the batch at minute 2 k + 1
    wrong = out.filter(F.col("fire_batch") != F.col("end_ms") / 60_000 + 1).count()
    assert (out.count(), wrong) == (n // 2, 0)
    assert "CartesianProduct" not in plan.toString() and "NestedLoop" not in plan.toString()


def test_firings_with_stalled_batches(spark):
    rows = [(0, 100_000, None), (1, 40_000, 100_000), (2, 100_000, 100_000), (3, 250_000, 100_000), (4, 10_000_000, 250_000)]
    marks = spark.createDataFrame([(b, m, 0, q) for b, m, q in rows], "batch_id long, batch_max_ms long, batch_min_ms long, max_prev_ms long")
    ends = spark.createDataFrame([(e,) for e in (30_000, 90_000, 90_001, 240_000, 240_001, 9_990_000, 9_990_001)], "end_ms long")
    got = {r.end_ms: r.fire_batch for r in first_firings(ends, marks).collect()}
    assert got == {30_000: 0, 90_000: 0, 90_001: 3, 240_000: 3, 240_001: 4, 9_990_000: 4}
