"""Periodic runs against a direct search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from panewise.llm import entries, runs


def direct(words, min_length=6, min_exponent=4):
    """Runs by looking at every period at every place."""
    out = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def left_over(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def strange_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            some = [rng.choice("abcdefg") for _ in range(rng.randrange(1, 14))]
            words += some if rng.random() < 0.4 else (some * rng.randrange(1, 9))[: -rng.randrange(1, 3)]
        yield words


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for prime, generator in runs.PRIMES:
        x = rng.integers(0, prime, (3, 16), dtype=np.uint64)
        assert (runs.restored(runs.transform(x, prime, generator), prime, generator) == x).all()
        y = rng.integers(0, prime, (3, 16), dtype=np.uint64)
        both = runs.transform(x, prime, generator) * runs.transform(y, prime, generator) % np.uint64(prime)
        got = runs.restored(both, prime, generator)
        want = [[sum(int(a[i]) * int(b[(k - i) % 16]) for i in range(16)) % prime for k in range(16)] for a, b in zip(x, y, strict=True)]
        assert got.tolist() == want


def test_occurrences():
    rng = np.random.default_rng(2)
    blocks, windows = rng.integers(0, 2, (50, 4)), rng.integers(0, 2, (50, 19))
    want = [[(w[i : i + 4] == b).all() for i in range(16)] for b, w in zip(blocks, windows, strict=True)]
    assert runs.occurrences(blocks, windows).tolist() == want
    assert runs.occurrences(blocks + 40_000_000, windows + 40_000_000).tolist() == want  # more primes
    with pytest.raises(ValueError):
        runs.occurrences(blocks + (1 << 60), windows)


@pytest.mark.parametrize("longest", [1 << 12, 4])
def test_runs_of_many_texts(monkeypatch, longest):
    monkeypatch.setattr(runs, "LONGEST", longest)
    texts = [[w.encode() for w in words] for words in strange_texts(longest, 400)]
    assert runs.runs_of(texts) == [direct(t) for t in texts]
    assert runs.runs_of(texts, 20, 5) == [direct(t, 20, 5) for t in texts]


def test_long_periods_and_long_runs():
    rng = random.Random(5)
    some = [b"%d" % rng.randrange(10**6) for _ in range(7001)]
    assert runs.runs_of([some * 5, [], some, [b"a"] * 300_000]) == [[(0, 35005, 7001)], [], [], [(0, 300_000, 1)]]
    # periods longer than the longest block, within and next to runs of short periods
    inner = ([b"a"] * 5000 + [b"b"]) * 4
    assert runs.runs_of([inner]) == [sorted([(0, 20004, 5001), *((5001 * i, 5000, 1) for i in range(4))])]
    with pytest.raises(ValueError):
        runs.find_runs(np.arange(4), 4, min_exponent=3)


def test_operator_keeps_rows_and_columns(frame):
    rows = [(1, "a\tb a\x0bb a b  a b"), (1, None), (None, ""), (2, " \n "), (3, "x " * 6), (3, "x " * 5), (4, "A a " * 9), (5, "é é é é é é é é"), (6, ("word " * 40_000).strip())]
    df = frame(rows, "doc_id long, text string", extra=("Runs", "_text"))
    out = runs.periodic_runs(df)
    assert out.columns == ["doc_id", "text", "_text", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, r.text or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", t or "")
        found = [(0, len(words), 1)] if len(words) == 40_000 else direct(words)
        want.append((i or 0, t or "", len(words), found, left_over(words, found)))
    assert got == sorted(want)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = direct(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(left_over(words, found)))


def test_query_against_direct_search(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(w)) for i, w in enumerate(strange_texts(3, 250))]
    rows += [(1000 + i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randrange(90)))) for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, " leading  and trailing ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = entries.op11_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(expected(i, t) for i, t in rows)
    assert sum(r[1] > 0 for r in got) > 80 and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in got)
