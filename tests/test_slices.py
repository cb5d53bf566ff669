"""Slices, bit words of users, stored partial metrics and sketches against the direct window metrics."""

import random

import pytest
from pyspark.sql import functions as F

from panewise.operators.distinct import number_users
from panewise.operators.late import classify_late
from panewise.operators.sketches import delay_sketches, merge_delay_sketches, merge_user_sketches, user_sketches
from panewise.operators.slices import dimension_metrics, slice_width, sliced_metrics, slices, to_windows, totals, window_metrics_of
from panewise.operators.windows import window_metrics
from panewise.plans.partials import PartialsTable, UserDictionary, late_partials, on_time_partials
from panewise.schema import Params


def orders(spark, n=3000, seed=1, users=400):
    rng = random.Random(seed)
    rows = [(f"e{i}", None if rng.random() < 0.02 else f"u{rng.randrange(users)}", "hot" if rng.random() < 0.5 else f"s{rng.randrange(4)}", rng.randrange(1000) / 4, rng.randrange(-300_000, 600_000), rng.randrange(8)) for i in range(n)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, store_id string, amount double, event_time long, batch_id long")
    return df.withColumn("event_ts", F.timestamp_millis("event_time"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("size,slide", [(60_000, 30_000), (60_000, 60_000), (90_000, 60_000), (70_000, 30_000)])
@pytest.mark.parametrize("numbered", [False, True])
def test_windows_from_slices(spark, size, slide, numbered):
    p, df = Params(size_ms=size, slide_ms=slide), orders(spark)
    want = rows_of(window_metrics(df, p))
    if numbered:
        numbers = number_users(df.select("user_id"))
        named = df.join(numbers, "user_id", "left")
        partials = slices(named, p, numbered=True)
        assert partials.filter(F.col("slice_ms") % slice_width(p) != 0).count() == 0
        got = window_metrics_of(to_windows(partials, p), p)
    else:
        got = sliced_metrics(df, p)
    assert rows_of(got) == want


def test_words_hold_64_users_and_a_row_enters_one_slice(spark):
    df = orders(spark, 6000, users=100_000)
    named = df.join(number_users(df.select("user_id")), "user_id", "left")
    partials = slices(named, Params(), numbered=True, width=86_400_000)
    assert partials.agg(F.sum("order_cnt")).first()[0] == 6000
    hot = partials.filter("store_id = 'hot' AND user_word IS NOT NULL")
    users = df.filter("store_id = 'hot'").groupBy(F.floor(F.col("event_time") / 86_400_000)).agg(F.count_distinct("user_id").alias("n")).agg(F.sum("n")).first()[0]
    assert hot.agg(F.sum(F.bit_count("user_bits"))).first()[0] == users and hot.count() < users / 8


def test_numbers_have_no_gaps_and_stay(spark, scratch):
    numbers = UserDictionary(spark, f"{scratch}/users")
    first = spark.createDataFrame([(f"u{i % 700}",) for i in range(2000)] + [(None,)], "user_id string")
    numbers.extend(first.limit(1), 0)
    numbers.extend(first, 1)
    numbers.extend(first.repartition(7), 2)  # nothing new
    more = spark.createDataFrame([(f"u{i}",) for i in range(650, 900)], "x string")
    numbers.extend(more, 3)
    once = {r.user_id: r.user_no for r in numbers.users().collect()}
    assert sorted(once.values()) == list(range(900)) and once[first.first()[0]] == 0
    numbers.extend(more.repartition(5), 3)  # a retry
    assert {r.user_id: r.user_no for r in numbers.users().collect()} == once
    assert numbers.numbered(spark.createDataFrame([("u5",), (None,), ("new",)], "user_id string")).filter("user_no IS NULL").count() == 2


def test_late_rows_merge_into_stored_metrics(spark, scratch):
    df = orders(spark).drop("event_ts")
    c = classify_late(df).cache()
    late = c.filter("is_late")
    assert late.count() > 50
    numbers = UserDictionary(spark, f"{scratch}/users")
    table = PartialsTable(spark, f"{scratch}/partials")
    numbers.extend(c.select("user_id"), 0)
    on_time = numbers.numbered(c)
    table.write(on_time_partials(on_time), "on_time", 0)
    from panewise.operators.late import metrics_excluding_late

    before = rows_of(metrics_excluding_late(c.withColumn("event_ts", F.timestamp_millis("event_time"))))
    assert rows_of(table.metrics()) == before
    for _ in range(2):  # written twice: the second replaces the first
        table.write(late_partials(on_time), "late", 7)
    want = rows_of(window_metrics(df.withColumn("event_ts", F.timestamp_millis("event_time"))))
    assert rows_of(table.metrics()) == want != before
    assert rows_of(table.metrics(sources=["on_time"])) == before
    day = [r for r in want if r[0].startswith("1970-01-01")]
    assert rows_of(table.metrics("19700101", "19700101")) == day


def test_dimension_sets_in_one_pass(spark):
    df = orders(spark).withColumn("category", F.when(F.col("amount") > 100, F.lit("dear")).when(F.col("amount") > 50, F.lit("fair")))
    got = dimension_metrics(df, [["store_id"], ["category"], ["store_id", "category"], []])
    for level, keys in ((1, ["store_id"]), (2, ["category"]), (0, ["store_id", "category"])):
        part = got.filter(F.col("grouping_id") == level)
        want = window_metrics(df, Params(), keys=keys)
        assert rows_of(part.select(*want.columns)) == rows_of(want)
    assert got.filter("grouping_id = 3").agg(F.sum("order_cnt")).first()[0] == 2 * 3000


def test_totals_of_repeated_grains(spark):
    df = spark.createDataFrame([(1, 0, 0b101, 2, 1.0), (1, 0, 0b110, 3, 2.0), (1, 1, 1, 1, 0.5), (1, None, None, 4, 0.0), (2, None, None, 1, 0.0)], "g int, user_word long, user_bits long, order_cnt long, gmv double")
    assert rows_of(totals(df, ["g"])) == [(1, 10, 3.5, 4), (2, 1, 0.0, 0)]


def test_user_sketches_merge(spark):
    df = orders(spark, 20_000, users=9000)
    stored = user_sketches(df, width_ms=60_000)
    exact = {(r.window_start, r.store_id): r for r in window_metrics(df, Params(size_ms=3_600_000, slide_ms=3_600_000)).collect()}
    got = merge_user_sketches(stored, 3_600_000).collect()
    assert len(got) == len(exact)
    for r in got:
        e = exact[r.window_start, r.store_id]
        assert (r.window_end, r.order_cnt, r.gmv_total) == (e.window_end, e.order_cnt, e.gmv_total)
        assert abs(r.user_cnt - e.user_cnt) <= 0.049 * e.user_cnt + 1


def test_delay_sketches_merge(spark):
    rng = random.Random(2)
    rows = [("a" if i % 3 else "b", i * 1000, i * 1000 + int(rng.expovariate(1 / 8000))) for i in range(30_000)] + [("b", None, 5)]
    df = spark.createDataFrame(rows, "store_id string, event_time long, arrival_ms long")
    got = {r.store_id: r for r in merge_delay_sketches(delay_sketches(df)).collect()}
    for store in "ab":
        delays = sorted(a - t for s, t, a in rows if s == store and t is not None)
        assert (got[store].rows, got[store].max_delay_ms) == (len(delays), delays[-1])
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            value = got[store][name]
            below, upto = sum(d < value for d in delays) / len(delays), sum(d <= value for d in delays) / len(delays)
            assert below <= q + 0.02 and upto >= q - 0.02


def test_empty_tables(spark, scratch):
    df = orders(spark, 5).limit(0)
    assert sliced_metrics(df).count() == 0 and dimension_metrics(df, [["store_id"]]).count() == 0
    assert merge_user_sketches(user_sketches(df), 60_000).count() == 0
    numbers = UserDictionary(spark, f"{scratch}/users")
    assert numbers.users().count() == 0
    numbers.extend(df.select("user_id"), 0)
    assert numbers.users().count() == 0
