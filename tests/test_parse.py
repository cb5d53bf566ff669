"""SURVEY 2.1-A: lenient JSON coercion, one row per documented case."""

from panewise.operators import anomalies, parse_orders, valid_orders
from panewise.sources.encode import encode_orders

CASES = [
    # value, expected (event_id, user_id, store_id, amount, event_time, reason)
    ('{"event_id":"e1","user_id":"u","store_id":"s","amount":7.5,"event_time":1000}', ("e1", "u", "s", 7.5, 1000, None)),
    ('{"event_id":"e2","amount":"7.5"}', ("e2", "unknown", "default", 7.5, 0, None)),
    ('{"event_id":"e3","event_time":"2024-01-01"}', ("e3", "unknown", "default", 0.0, 0, None)),
    ('{"event_id":"e4","event_time":1.9e3}', ("e4", "unknown", "default", 0.0, 1900, None)),
    ('{"event_id":123}', ("123", "unknown", "default", 0.0, 0, None)),
    ('{"event_id":"t"} x', ("t", "unknown", "default", 0.0, 0, None)),  # trailing text accepted
    ('{"event_id":"a","event_id":"b"}', ("b", "unknown", "default", 0.0, 0, None)),  # last key wins
    ('{"event_id":"e5","user_id":"","store_id":""}', ("e5", "", "", 0.0, 0, None)),  # empty text is kept
    ('{"event_id":"e6","amount":-3.25}', ("e6", "unknown", "default", -3.25, 0, None)),  # negatives pass
    ('{"event_id":"e7","user_id":null,"store_id":null}', ("e7", "unknown", "default", 0.0, 0, None)),
    ('{"event_id":"{x"}', ("{x", "unknown", "default", 0.0, 0, None)),  # text id that looks like JSON
    ("[1]", (None, None, None, None, None, "malformed_json")),
    ('"str"', (None, None, None, None, None, "malformed_json")),
    ("null", (None, None, None, None, None, "malformed_json")),
    ("", (None, None, None, None, None, "malformed_json")),
    ("not json", (None, None, None, None, None, "malformed_json")),
    ('{"event_id":""}', (None, None, None, None, None, "event_id_missing")),
    ('{"user_id":"u"}', (None, None, None, None, None, "event_id_missing")),
    ('{"event_id":{"x":1}}', (None, None, None, None, None, "event_id_missing")),
    ('{"event_id":[1]}', (None, None, None, None, None, "event_id_missing")),
]

# Documented divergences from the reference's JSON library:
DIVERGENCES = [
    ('{"event_id":null}', "event_id_missing"),  # reference: the text "null" passes; we keep it an anomaly
    ('{"event_id":"d1","amount":true}', 0.0),  # reference: 1.0
    ('{"event_id":"d2","amount":1e400}', 0.0),  # reference: +Infinity
]


def _parse(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return {r["i"]: r for r in parse_orders(df).collect()}


def test_coercion_table(spark):
    got = _parse(spark, [c[0] for c in CASES])
    for i, (value, exp) in enumerate(CASES):
        r = got[i]
        if exp[5] is None:
            assert (r.event_id, r.user_id, r.store_id, r.amount, r.event_time, r.reason) == exp, value
        else:
            assert r.reason == exp[5], value


def test_null_message_is_malformed(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert parse_orders(df).first().reason == "malformed_json"


def test_documented_divergences(spark):
    got = _parse(spark, [d[0] for d in DIVERGENCES])
    assert got[0].reason == "event_id_missing"
    assert got[1].amount == 0.0 and got[1].reason is None
    assert got[2].amount == 0.0 and got[2].reason is None


def test_valid_and_anomaly_split_is_a_partition(spark):
    values = [c[0] for c in CASES]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    p = parse_orders(df)
    v, a = valid_orders(p), anomalies(p)
    assert v.count() + a.count() == len(values)
    assert set(a.columns) == {"value", "reason"}
    assert "value" not in v.columns and "reason" not in v.columns


def test_encode_roundtrip(spark):
    df = spark.createDataFrame(
        [("e1", "u1", "s1", 12.31, 1704067207179), ("e2", "u2", "s2", 0.0, 0)],
        "event_id string, user_id string, store_id string, amount double, event_time long",
    )
    back = valid_orders(parse_orders(encode_orders(df))).drop("event_ts")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_from_json_evaluated_once(spark):
    df = spark.createDataFrame([('{"event_id":"x"}',)], "value string")
    plan = valid_orders(parse_orders(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_extra_fields_do_not_leak_into_the_shared_schema(spark):
    from panewise.schema import RAW_JSON

    before = len(RAW_JSON.fields)
    df = spark.createDataFrame([('{"event_id":"e","city":"x"}',)], "value string")
    for _ in range(2):
        r = parse_orders(df, extra_fields=("city",)).first()
        assert r.city == "x" and r.reason is None
    assert len(RAW_JSON.fields) == before
    assert "city" not in parse_orders(df).columns


def test_event_times_without_a_timestamp_are_dead_letters(spark):
    """Nanoseconds, the largest long, a very negative and a microsecond time never stop the job."""
    bad = [1704067200000000000, 9223372036854775807, -62200000000000000, 1704067200000000, 253402214400000, -62135510400001]
    good = [1704067200000, 0, -1, 253402214399999, -62135510400000]
    rows = [(f'{{"event_id":"e{i}","event_time":{t}}}',) for i, t in enumerate(bad + good)]
    parsed = parse_orders(spark.createDataFrame(rows, "value string"))
    dead = anomalies(parsed).collect()
    assert len(dead) == len(bad) and {r.reason for r in dead} == {"event_time_out_of_range"}
    assert sorted(r.event_time for r in valid_orders(parsed).collect()) == sorted(good)
    assert valid_orders(parsed).filter("event_ts IS NULL").count() == 0
