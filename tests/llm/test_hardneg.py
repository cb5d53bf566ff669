"""Hard negatives against a direct computation in Python integers."""

import math

import numpy as np
import pytest

from panewise.llm import entries, hardneg
from panewise.llm.embdup import rotation


def direct(rows, anchor=lambda i: i % 100 == 0, scale=256, n_positives=5, n_negatives=10, low=30, high=90):
    good = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = min(good.get(i, (str(label), v)), (str(label), v))
    good = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in good.items()}
    out = []
    for i, (label, v) in good.items():
        if not anchor(i):
            continue
        score = {j: sum(a * b for a, b in zip(v, w, strict=True)) for j, (_, w) in good.items() if len(w) == len(v)}
        order = sorted(score, key=lambda j: (-score[j], j))
        for p in [j for j in order if j != i and good[j][0] == label][:n_positives]:
            negatives = [j for j in order if good[j][0] != label and low * score[p] <= 100 * score[j] <= high * score[p]]
            out += [(i, p, k, j, score[p], score[j]) for k, j in enumerate(negatives[:n_negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 3, 64, 130])
def test_bounds_hold(dim):
    rng = np.random.default_rng(dim)
    v = np.floor(rng.standard_normal((300, dim)) * 256 * rng.choice([0, 0.01, 1, 50], (300, 1))).astype(np.int64)
    v[5] = 7
    turn = rotation(dim)
    bits, numbers = hardneg.encoded(v, turn)
    lower, upper = hardneg.Planes(v[:40], turn).bounds(bits, numbers)
    score = v[:40] @ v.T
    assert (lower <= score).all() and (score <= upper).all()
    if dim == 64:  # and they are narrow
        norms = np.linalg.norm(v, axis=1)
        assert np.median(((upper - lower) / np.maximum(norms[:40, None] * norms, 1))[score != 0]) < 0.3


def vectors(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim))
    v = centres[rng.integers(0, 8, n)] + rng.standard_normal((n, dim)) * rng.choice([0.2, 1.0], (n, 1))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def collected(df):
    return sorted(map(tuple, df.collect()))


def test_against_direct_search(monkeypatch, frame):
    monkeypatch.setattr(hardneg, "PIECE", (3, 50))
    rows = [(i, "abcd"[i % 3 if i % 5 else 3], [float(x) for x in v]) for i, v in enumerate(vectors(1, 700))]
    rows += [(1000 + i, "a", rows[0][2]) for i in range(40)] + [(2000 + i, "b", rows[100][2]) for i in range(40)]  # ties
    rows += [(300, "z", rows[7][2]), (300, "a", rows[9][2]), (0, rows[0][1], rows[0][2])]  # repeated ids and rows
    rows += [(None, "a", rows[1][2]), (3000, None, rows[1][2]), (3100, "a", None), (3200, "a", []), (3300, "a", [None] * 16), (3400, "b", [math.nan] * 16), (3500, "b", [math.inf] * 16)]
    rows += [(3600, "a", [0.0] * 16), (3700, "alone", rows[3][2]), (3800, "short", [1.0, 0.5]), (3801, "short", [1.0, 0.0]), (3802, "other", [0.5, 0.5]), (3803, "other", [-0.5, 0.5])]
    df = frame(rows, "vec_id long, label string, embedding array<double>", extra=("id", "v", "anchor", "salt"))
    import pyspark.sql.functions as F

    out = hardneg.hard_negatives(df, F.col("vec_id") % 100 == 0, row_block=100, anchor_block=3)
    got, want = collected(out), direct(rows)
    assert got == want and len(want) > 200 and any(r[0] == 3800 for r in want)
    few = hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0, n_positives=2, n_negatives=3, low=-20, high=100, scale=1000)
    assert collected(few) == direct(rows, lambda i: i % 50 == 0, 1000, 2, 3, -20, 100)


def test_large_vectors_and_empty_tables(frame):
    import pyspark.sql.functions as F

    rows = [(0, "a", [1e300, 1.0]), (100, "a", [500_000.0, 3.0]), (101, "a", [400_000.0, 3.0]), (102, "b", [300_000.0, 5.0]), (103, "b", [1.0, 0.0])]
    df = frame(rows, "vec_id long, label string, embedding array<double>")
    assert collected(hardneg.hard_negatives(df, F.col("vec_id") % 100 == 0)) == direct(rows[1:])
    assert hardneg.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hardneg.hard_negatives(df, F.lit(False)).count() == 0
    assert hardneg.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_query_shifts_labels(spark, tmp_path):
    rows = [(i, i % 10 if i % 11 else None, [float(x) for x in v]) for i, v in enumerate(vectors(4, 800))]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = collected(entries.op13_hard_negatives(spark, str(tmp_path)))
    assert got == direct([(i, label if label is None or i % 7 else (label + 1) % 10, v) for i, label, v in rows]) and len(got) > 100
