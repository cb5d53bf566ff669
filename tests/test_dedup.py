"""T2 batch: first arrival wins; TTL measured from the accept; hot keys are exact too."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panewise.operators.dedup import dedup_first, dedup_ttl

SCHEMA = "event_id string, arrival_ms long, payload int"


def _brute(rows, ttl):
    """Rows without a time are kept; the others walk the clock of their key (a null key is a key)."""
    by = {}
    untimed = [r for r in rows if r[1] is None]
    for k, t, n in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        last, kept = by.get(k, (None, []))
        if last is None or t - last >= ttl:
            last, kept = t, kept + [(k, t, n)]
        by[k] = (last, kept)
    return sorted([x for _, kept in by.values() for x in kept] + untimed, key=repr)


def test_ttl_edge_times(spark):
    times = [0, 1800, 3599, 3600, 5000, 7199, 7200, 20000]
    df = spark.createDataFrame([("k", s * 1000, i) for i, s in enumerate(times)], SCHEMA)
    for max_light in (1000, 0):
        kept = sorted(r.arrival_ms // 1000 for r in dedup_ttl(df, ttl_ms=3_600_000, max_light=max_light).collect())
        assert kept == [0, 3600, 7200, 20000]


def test_first_wins_even_if_payload_differs(spark):
    df = spark.createDataFrame([("k", 5, 2), ("k", 3, 9), ("j", 1, 1)], SCHEMA)
    assert sorted(map(tuple, dedup_first(df).collect())) == [("j", 1, 1), ("k", 3, 9)]
    assert sorted(map(tuple, dedup_ttl(df, ttl_ms=None).collect())) == [("j", 1, 1), ("k", 3, 9)]


def test_hot_key_path_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(0, 20_000_000), i) for i in range(5000)]
    rows += [(f"k{i}", rng.randrange(0, 5_000_000), i) for i in range(300)]
    rows += [("tie", 100, 2), ("tie", 100, 1), ("tie", 700_000, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    exp = _brute(rows, 600_000)
    for max_light in (10, 1000):
        got = sorted(map(tuple, dedup_ttl(df, ttl_ms=600_000, max_light=max_light).collect()), key=repr)
        assert got == exp


def test_small_ttl_on_a_hot_key(spark):
    rng = random.Random(4)
    rows = [("hot", rng.randrange(0, 400_000), i) for i in range(3000)] + [("hot", 10**12 + 7, 0), ("hot", -5, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for ttl in (1, 50, 997):
        assert sorted(map(tuple, dedup_ttl(df, ttl_ms=ttl, max_light=0).collect()), key=repr) == _brute(rows, ttl)


def test_key_size_never_changes_the_answer(spark):
    rows = [("k", None, 1), ("k", None, 2), ("k", 100, 3), ("k", 5_000_000, 4), (None, 7, 5), (None, 8, 6), (None, None, 7), ("j", 1, 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    for max_light in (0, 1, 3, 1000):
        got = sorted(map(tuple, dedup_ttl(df, ttl_ms=3_600_000, max_light=max_light).collect()), key=repr)
        assert got == _brute(rows, 3_600_000) and len(got) == 7


def test_extreme_times_in_both_paths(spark):
    top, low = (1 << 63) - 1, -(1 << 63)
    rows = [("a", 100, 1), ("a", top, 2), ("b", low, 1), ("b", low + 3_600_000, 2), ("b", top - 3_600_000, 3), ("b", top, 4), ("c", top - 1, 1), ("c", top, 2), ("d", low, 1), ("d", top, 2), ("d", 0, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for ttl in (1, 3_600_000):
        for max_light in (0, 1000):
            got = sorted(map(tuple, dedup_ttl(df, ttl_ms=ttl, max_light=max_light).collect()), key=repr)
            assert got == _brute(rows, ttl)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-20, 50)), st.integers(0, 3)),
             min_size=1, max_size=30),
    st.integers(1, 20),
)
def test_property_paths_agree_with_nulls(spark, rows, ttl):
    df = spark.createDataFrame(rows, SCHEMA)
    for max_light in (0, 3, 1000):
        got = sorted(map(tuple, dedup_ttl(df, ttl_ms=ttl, max_light=max_light).collect()), key=repr)
        assert got == _brute(rows, ttl)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.integers(0, 3)), min_size=1,
             max_size=40),
    st.integers(1, 20),
)
def test_property_exact_and_idempotent(spark, rows, ttl):
    df = spark.createDataFrame(rows, SCHEMA)
    once = dedup_ttl(df, ttl_ms=ttl, max_light=3)
    got = sorted(map(tuple, once.collect()), key=repr)
    assert got == _brute(rows, ttl)
    assert sorted(map(tuple, dedup_ttl(once, ttl_ms=ttl).collect()), key=repr) == got
