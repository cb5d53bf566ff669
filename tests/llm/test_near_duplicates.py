"""Substring dedup, n-gram join, embeddings, decontamination and line dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panewise.llm import decontam, embdup, linedup, ngramjoin, substring
from panewise.llm.common import IdFilter, id_filter
from panewise.llm.components import components


def closure(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == closure({x for e in links for x in e}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_take_one_step(spark, monkeypatch):
    """Links that name the smallest node already need no second step to tell that nothing changes."""
    from panewise.llm import components as module

    steps, written = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: steps.append(name) or written(df, name))
    got = {r.node: r.component for r in components(spark.createDataFrame([(i % 5, i) for i in range(5, 90)], "a long, b long")).collect()}
    assert got == {i: i % 5 for i in range(90)} and len(steps) == 2


def test_id_filter_has_no_false_negatives(spark):
    ids = [random.Random(1).randrange(-(2**62), 2**62) for _ in range(1)] + list(range(-500, 500))
    f = id_filter(spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long"), 16)
    assert isinstance(f, IdFilter) and f.has(np.array(ids)).all()
    assert f.has(np.arange(10_000, 20_000)).mean() < 0.1


# ------------------------------------------------------------ substrings


def test_fm_index_against_brute_force():
    rng = random.Random(1)
    for shard_words in (10**6, 40):
        segments = [[rng.choice("abc") for _ in range(rng.randint(4, 14))] for _ in range(70)]
        docs = [rng.randrange(25) for _ in segments]
        best = {}
        for g, d in zip(segments, docs, strict=True):
            for i in range(len(g) - 3):
                best[tuple(g[i : i + 4])] = min(best.get(tuple(g[i : i + 4]), 99), d)
        got = substring.smallest_documents([np.array([ord(c) for c in g], np.uint64) for g in segments], np.array(docs), 4, shard_words)
        assert [x.tolist() for x in got] == [[best[tuple(g[i : i + 4])] for i in range(len(g) - 3)] for g in segments]


def test_matching_statistics():
    text = np.array([*b"abcabd", 0, *b"zabc", 0], np.int64)
    text = np.unique(text, return_inverse=True)[1]
    index = substring.FmIndex(text, int(text.max()) + 1, 4)
    match, low, high = index.search(text, np.array([2, 5, 10]), 3, 2)
    assert match.tolist() == [3, 0, 3]  # "abc" occurs twice, nothing that ends in d does
    assert (high - low).tolist() == [2, 0, 2]


def test_range_minima():
    rng = np.random.default_rng(3)
    for n, values in ((1, 5), (64, 3), (700, 10**12), (5_000, 400)):
        x = rng.integers(-values, values, n)
        low = rng.integers(0, n, 600)
        high = np.minimum(low + 1 + rng.integers(0, rng.choice([3, 70, n], 600)), n)
        got = substring.RangeMinimum(x).smallest(low, high)
        assert got.tolist() == [x[a:b].min() for a, b in zip(low, high, strict=True)]


def test_statistics_skip_windows_without_loss():
    rng = np.random.default_rng(8)
    for letters, width, least in ((2, 6, 2), (4, 5, 2), (9, 4, 2), (40, 5, 1)):
        segments = [rng.integers(1, letters + 1, rng.integers(width, 60)) for _ in range(30)]
        text = np.concatenate([np.append(x, 0) for x in segments])
        starts = np.cumsum([0] + [len(x) + 1 for x in segments])
        ends = np.concatenate([np.arange(a + width - 1, a + len(x)) for a, x in zip(starts, segments)])
        index = substring.FmIndex(text[: len(text) // 2] if least == 1 else text, letters + 1, width + 1)
        match, low, high = index.search(text, ends, width, least)
        places, lo, hi, searched = index.shared(text, ends, width, least)
        order = np.argsort(places)
        assert places[order].tolist() == np.flatnonzero(match == width).tolist()
        assert lo[order].tolist() == low[match == width].tolist() and hi[order].tolist() == high[match == width].tolist()
        assert letters < 9 or searched < len(ends)  # with few words nearly every window is shared


def repeats(rows, width=13):
    first = defaultdict(lambda: 1 << 63)
    words = [(i if i is not None else (1 << 63) - 1, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for j in range(len(w) - width + 1):
            key = tuple(w[j : j + width])
            first[key] = min(first[key], i)
    out = []
    for (i, _), (k, w) in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < k:
                gone[j : j + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def test_repeats_against_brute_force(frame, prose):
    passage = prose(99, 60)
    rows = [(i, prose(i, 40) + " " + (passage if i % 3 == 0 else prose(50 + i, 12)) + " " + prose(200 + i, 20)) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(6)] + [(200, passage), (201, prose(99, 13)), (202, " ".join(prose(99, 12).split())), (203, "a " * 3000), (204, "a " * 14)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (None, passage), (5, rows[5][1]), (6, prose(777, 30)), (303, "Ünï code " * 20), (304, "Ünï code\x0b" * 20)]
    df = frame(rows, "doc_id long, text string", extra=("words", "tag", "at"))
    got = sorted(map(tuple, substring.remove_repeats(df, shard_words=300).collect()), key=repr)
    assert got == sorted(repeats(rows), key=repr)
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_a_frequent_run(frame, prose, monkeypatch):
    # the run with the smallest hash is the anchor of all windows that hold it, in whatever context
    hot = min((prose(5000 + i, 4) for i in range(3000)), key=lambda t: int(substring.window_hashes(substring.word_hashes(t.encode()), 4)[0]))
    rows = [(i, f"{prose(i, 10)} {hot} {prose(1000 + i // 2, 12)} {hot} {prose(2000 + i % 7, 14)}") for i in range(80)]
    sizes, decide = [], substring._decide

    def spy(segments, width, shard_words):
        sizes.extend(segments.groupBy("anchor").agg(F.sum(F.length("words") / 8 + 1)).collect())
        return decide(segments, width, shard_words)

    monkeypatch.setattr(substring, "_decide", spy)
    got = sorted(map(tuple, substring.remove_repeats(frame(rows, "doc_id long, text string"), shard_words=300).collect()), key=repr)
    assert got == sorted(repeats(rows), key=repr) and sum(r[2] for r in got) > 0
    assert sizes and max(n for _, n in sizes) <= 300


# ------------------------------------------------------------ n-gram join


def jaccard_groups(rows, width=5, percent=75):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()))
    ids = [(n, i, s) for n, (i, s) in enumerate(sets)]
    links = [(i, j) for n, i, s in ids for m, j, t in ids if m < n and s and t and i is not None and j is not None and 100 * len(s & t) >= percent * len(s | t)]
    label = closure({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), label.get(i)) for i, s in sets), key=repr), len(links)


def test_jaccard_against_brute_force(frame, prose):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = prose(g, rng.choice([6, 9, 30, 120, 400])).split()
        for _ in range(rng.choice([1, 2, 5, 9])):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 25) + 1)):
                w[rng.randrange(len(w))] = rng.choice(["new", "other", "words"])
            rows.append((len(rows) * 3, " ".join(w)))
    common = prose(500, 40)
    rows += [(1000 + i, f"{common} {prose(600 + i, 12)}") for i in range(25)]
    rows += [(2000, "one two"), (2001, "ONE  two"), (2002, "one two three"), (2003, None), (2004, ""), (2005, " \n"), (None, rows[0][1]), (2006, "É a b c d"), (2007, "é a b c d"), (0, rows[0][1]), (2008, rows[0][1])]
    want, n = jaccard_groups(rows)
    assert n > 40
    df = frame(rows, "doc_id long, text string", extra=("class", "token", "n"))
    assert sorted(map(tuple, ngramjoin.near_duplicates(df).collect()), key=repr) == want


def test_rounds_of_pivots_change_no_result(frame, prose, monkeypatch):
    """Copies around the threshold, most of them unlike most others: every number of rounds gives the same groups."""
    rng, base = random.Random(12), prose(99, 90).split()
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(2, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = frame(rows, "doc_id long, text string")
    want = sorted(map(tuple, ngramjoin.near_duplicates(df).collect()))
    rounds = []
    pivots = ngramjoin._pivot_pairs
    monkeypatch.setattr(ngramjoin, "_pivot_pairs", lambda *a: rounds.append(a[1]) or pivots(*a))
    monkeypatch.setattr(ngramjoin, "FEW_PAIRS", 0)
    assert sorted(map(tuple, ngramjoin.near_duplicates(df).collect())) == want
    sets = [{tuple(t.lower().split()[k : k + 5]) for k in range(86)} for _, t in rows]
    links = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    label = closure(range(120), links)
    assert {r[0]: r[2] for r in want} == label and rounds and len(set(label.values())) > 3


def test_pivots_hold_the_centre_of_a_group(spark):
    # 300 copies with changes of their own share 20 shingles with the text (class 0) they were made from; 30 lie in no component yet
    rows = [(t, c, 100, c if c > 270 else 0, 5000 if c == 0 else 4000 + c % 700) for t in range(20) for c in range(301)]
    known = spark.createDataFrame(rows, "token long, class long, n int, component long, centre int")
    pairs = {(r.a, r.b) for r in ngramjoin._pivot_pairs(known, 1, 75).collect()}
    assert {(0, c) for c in range(271, 301)} <= pairs
    assert len(pairs) <= ngramjoin.PIVOTS * 301


def test_few_pairs_of_a_large_group_are_verified(frame, prose, monkeypatch):
    words = prose(3, 150).split()

    def copy(i):  # the text with changed words of its own; the more, the fewer other copies it links with
        own = list(words)
        for k in range(i % 5):
            own[(i * 37 + k * 31) % 150] = f"own{i}x{k}"
        return " ".join(own)

    rows = [(1000 - i, copy(i)) for i in range(260)]
    seen, verified = [], ngramjoin.verified
    monkeypatch.setattr(ngramjoin, "verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    df = frame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngramjoin.near_duplicates(df).collect()}
    sets = {i: set(ngramjoin.shingles(t.encode(), 5).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in sets}
    assert sum(seen) <= 10 * len(rows)


def test_texts_of_a_shared_passage_are_not_fetched(frame, prose, monkeypatch):
    """Documents that share 40 of 120 words link with nothing; bits tell, so that hardly a pair is joined with its texts."""
    passage, rows = prose(40, 40), []
    for i in range(60):
        rows.append((i, f"{passage} {prose(800 + i, 80)}"))
    rows.append((60, rows[7][1] + " more"))
    seen, verified = [], ngramjoin.verified
    monkeypatch.setattr(ngramjoin, "verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    got = sorted(map(tuple, ngramjoin.near_duplicates(frame(rows, "doc_id long, text string")).collect()), key=repr)
    want, _ = jaccard_groups(rows)
    assert got == want and 1 <= sum(seen) <= 3


def test_bits_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x, y, both = (rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64) for _ in range(3))
        x, y = np.unique(np.concatenate([x, both])), np.unique(np.concatenate([y[: rng.integers(1, 40)], both]))
        assert ngramjoin.least_difference(ngramjoin.parities(x), ngramjoin.parities(y)) <= len(np.setxor1d(x, y))
    assert ngramjoin.least_difference(ngramjoin.parities(x), ngramjoin.parities(x)) == 0
    far = rng.integers(0, 2**63, (2, 500)).astype(np.uint64)
    assert ngramjoin.least_difference(*(ngramjoin.parities(h) for h in far)) > 1000 - 2 * 429  # 429 of 500 and 500 must be shared


def test_ngramjoin_shared_shingles_are_found_from_packed_ones():
    rng = np.random.default_rng(6)
    parts = [ngramjoin.trimmed(rng.integers(0, 2**64, 5000, dtype=np.uint64)) for _ in range(3)]
    parts[1][:40], parts[2][:70] = parts[0][:40], parts[0][30:100]
    parts[2][100:103] = parts[2][100]  # several documents of one part
    sent = {}
    for part in parts:
        for bucket, raw in zip(*ngramjoin.packed_tokens(part), strict=True):
            sent.setdefault(int(bucket), []).append(raw)
    assert sum(map(len, (b"".join(x) for x in sent.values()))) <= 5 * 15_000
    got = np.concatenate([ngramjoin.repeated_tokens(bucket, raw) for bucket, raw in sent.items()])
    assert sorted(got.tolist()) == sorted({*parts[0][:100].tolist(), int(parts[2][100])})
    counts = np.array([0, 1, 255, 256, 65535, 0], np.uint16)
    assert ngramjoin.unpacked_counts(ngramjoin.packed_counts(counts)).tolist() == counts.tolist()


def test_ngramjoin_deals_rows_once_a_step(spark, frame, prose, monkeypatch):
    """Pivots, components and offers of a shingle need no further exchange of its rows; no shuffle files or tables of a step are left over."""
    plans, written = {}, ngramjoin.written

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(ngramjoin, "written", seen)
    monkeypatch.setattr(ngramjoin, "FEW_PAIRS", 0)
    words = [prose(i, 60).split() for i in range(4)]
    rows = [(10 * k + i, " ".join([*text[: 50 - i], f"w{k}x{i}", *text[50 - i :]])) for k, text in enumerate(words) for i in range(5)]
    before = spark.conf.get(ngramjoin.CLEANUP, "false")
    got = {r.doc_id: r.component_id for r in ngramjoin.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    sets = {i: set(ngramjoin.shingles(t.encode(), 5).tolist()) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert links and got == closure(sets, links)
    assert spark.conf.get(ngramjoin.CLEANUP, "false") == before
    assert "hashpartitioning" not in plans["prefixes"]  # shared shingles are kept one row a class, where they are found
    # rows by class and their labels, these labels' own step, then once by shingle
    assert sum("hashpartitioning(token" in line for line in plans["known"].splitlines()) == 1, plans["known"]


def test_shingles_of_a_column(prose):
    rng = random.Random(6)
    texts = [None, "", " \n", "one", "one two three four", "É a b c d", prose(1, 9_000)] + [prose(i, rng.randrange(1, 300)) + rng.choice(["", " ", "\n"]) for i in range(300)]
    rng.shuffle(texts)
    for column in (pa.array(texts), pa.array(["left out", *texts])[1:], pa.array([], pa.string())):
        got = list(ngramjoin.column_shingles(column, 5))
        assert len(got) == len(column)
        assert all(np.array_equal(g, ngramjoin.shingles(t.encode() if t is not None else None, 5)) for g, t in zip(got, column.to_pylist(), strict=True))


def test_jaccard_of_ids_with_several_texts(frame, prose):
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = []
    for i in range(0, 200, 10):
        texts = [prose(7000 + i + j, 60) for j in range(4)]
        rows += [(i, t) for t in texts] + [(i + 1 + j, near(t)) for j, t in enumerate(texts)] + [(i, None), (i, ""), (None, texts[0])]
    got = sorted(map(tuple, ngramjoin.near_duplicates(frame(rows, "doc_id long, text string")).collect()), key=repr)
    want, links = jaccard_groups(rows)
    assert got == want and links >= 80


def test_jaccard_threshold_is_exact(frame):
    # sets of 7 and 6 shingles: 6 of 7 shared; and 3 of 4 exactly at the threshold
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g"), (3, "p q r s t u v"), (4, "p q r s t u v w")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (4, 1), 2: (3, 1), 3: (3, 3), 4: (4, 3)}


def test_prefixes_meet_often_enough():
    """Every pair that links shares at least l shingles in the prefixes its sizes ask for."""
    rng = np.random.default_rng(3)
    sketch = rng.poisson(3, 1 << ngramjoin.SKETCH_LOG2).astype(np.float32)
    common = rng.integers(0, 2**63, 30).astype(np.uint64) * np.uint64(2)
    sketch[ngramjoin.cells(common)] = 5000
    prefixes, longer = ngramjoin.Prefixes(sketch, 75), 0
    for _ in range(400):
        n = int(rng.integers(1, rng.choice([6, 120])))
        x = np.unique(np.concatenate((rng.integers(0, 2**63, n).astype(np.uint64), common[: rng.integers(0, 30)])))
        y = np.unique(np.concatenate((x[rng.random(len(x)) < 0.95], rng.integers(0, 2**63, int(n * 0.06)).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        (a, la), (b, lb) = prefixes.of(x), prefixes.of(y)
        least, need = -(-75 * (len(x) + len(y)) // 175), min(la, lb)
        longer += need > 1
        need = min(need, least)
        shared = np.intersect1d(a[: len(x) - least + need], b[: len(y) - least + need])
        assert len(shared) >= need
        i, j = max(np.flatnonzero(np.isin(a, shared))), max(np.flatnonzero(np.isin(b, shared)))
        assert len(shared) + min(len(x) - i, len(y) - j) - 1 >= least
    assert longer > 20


def test_word_hashes():
    from panewise.llm import common

    words = ["a", "b", "ab", "ba", "aa", "aaa", "Ünï", "é", "x" * 5000, "A"]
    text = " \t".join(words * 3).encode()
    h = common.word_hashes(text)
    assert len(h) == 30 and len(np.unique(h)) == len(words) and (h[:10] == h[10:20]).all()
    assert len(np.unique(common.word_hashes(text, lower=True))) == len(words) - 1
    long = (" ".join(f"w{i % 977}" for i in range(120_000)) + "\n" + "z" * 600_000 + " end").encode()
    whole = common.word_hashes(long)
    alone = {w: common.word_hashes(w)[0] for w in set(long.split())}
    assert (whole == np.array([alone[w] for w in long.split()])).all()
    assert len(common.word_hashes(b" \n ")) == 0 == len(common.word_hashes(None))


def test_jaccard_empty(frame):
    df = frame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, ngramjoin.near_duplicates(df).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert ngramjoin.near_duplicates(df.limit(0)).count() == 0


# ------------------------------------------------------------ embeddings


def test_code_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 100):
        v, q = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.standard_normal((200, dim)), rng.standard_normal((150, dim))))
        q[:100] = v[:100] + 0.2 * rng.standard_normal((100, dim)) / np.sqrt(dim)
        q /= np.linalg.norm(q, axis=1)[:, None]
        turn = embdup.rotation(dim)
        bits, factor = embdup.codes(v, turn)
        estimates, upper = embdup.estimate(bits, factor, q @ turn, dim)
        assert (upper >= v @ q.T - embdup.SLACK).all()
        if dim == 64:
            assert abs((estimates - v @ q.T).mean()) < 0.01


def test_estimates_are_unbiased_over_rotations():
    rng = np.random.default_rng(2)
    v, q = rng.standard_normal((1, 16)), rng.standard_normal((1, 16))
    v, q = v / np.linalg.norm(v), q / np.linalg.norm(q)
    out = []
    for seed in range(1500):
        turn = embdup.rotation(16, seed)
        out.append(embdup.estimate(*embdup.codes(v, turn), q @ turn, 16)[0][0, 0])
    assert np.mean(out) == pytest.approx(float((v @ q.T)[0, 0]), abs=0.02)


def test_embeddings_against_brute_force(frame):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(40):
        base = rng.standard_normal(24)
        for _ in range(int(rng.integers(1, 8))):
            v = base + rng.choice([0.0, 0.15, 0.4]) * rng.standard_normal(24)
            rows.append((len(rows) * 2, [float(np.float32(x)) for x in v], int(g % 3) if g % 7 else None))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)] + [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] * 24, 1), (2004, [float("inf")] + [1.0] * 23, 1), (2005, [None] + [1.0] * 23, 1), (2006, [1e300, 1e300], 2), (2007, [1e300, 1.01e300], 2), (2008, [1e-300, 1e-300], 2), (2009, [1.0, -1.0], 2), (None, rows[0][1], 0)]
    df = frame(rows, "vec_id long, embedding array<double>, label int", extra=("v", "bits", "copies"))
    got = sorted(map(tuple, embdup.near_duplicates(df, block=20).collect()), key=repr)

    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    def unit(v):
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    good = [r for r in rows if usable(r)]
    links = [(a[0], b[0]) for n, a in enumerate(good) for b in good[:n] if a[2] == b[2] and len(a[1]) == len(b[1]) and unit(a[1]) @ unit(b[1]) >= 0.93]
    label = closure({r[0] for r in rows if r[0] is not None}, links)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    want = sorted([(i, count[i] if i is not None else 0, label.get(i), i is not None and label[i] == i) for i, _, _ in rows], key=repr)
    assert got == want and len(links) > 100
    assert embdup.near_duplicates(df.limit(0)).count() == 0


# ------------------------------------------------------------ decontamination


def test_overlap_is_the_best_stretch():
    item = np.arange(30, dtype=np.uint64)
    doc = np.concatenate((np.arange(100, 110), np.arange(30), np.arange(200, 205))).astype(np.uint64)
    assert decontam.overlap(doc, item, 10) == (30, 0, 30)
    doc[15] = 999
    assert decontam.overlap(doc, item, 10) == (29, 0, 30)
    assert decontam.overlap(doc, item, 100) == (0, 0, 0)


def test_decontamination(frame, prose):
    items = [(i, prose(1000 + i, 15 + 4 * i)) for i in range(10)] + [(50, "Only seven words stand in this."), (51, "too short"), (52, None), (53, ""), (54, prose(1000, 15))]
    docs, want = [], set()
    for i in range(60):
        words = prose(i, 80).split()
        if i % 3 == 0:
            item = items[i % 10][1].split()
            for k in range(6, len(item), 9):  # every ninth word is another one
                item[k] = "substitute"
            words[30:30] = [w.upper() + "," for w in item]
            want.add((i, i % 10))
        docs.append((i, " ".join(words)))
    docs += [(100, None), (101, ""), (102, "x only SEVEN words, stand in this! y"), (103, "only seven words lie in this"), (104, "too short"), (None, items[3][1]), (105, items[4][1]), (105, items[4][1])]
    want |= {(102, 50), (None, 3), (105, 4)}
    want |= {(i, 54) for i, k in want if k == 0}
    df, bench = frame(docs, "doc_id long, text string", extra=("item", "seed", "words")), frame(items, "item_id long, text string", extra=("n",))
    out = decontam.overlaps(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    whole = next(r for r in out if r.doc_id == 105)
    assert (whole.n_match, whole.n_differ, whole.doc_start, whole.item_start, whole.item_words) == (31, 0, 0, 0, 31)
    kept = decontam.decontaminate(df, bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want} and kept.columns == df.columns
    assert decontam.overlaps(df.limit(0), bench).count() == 0
    assert decontam.overlaps(df, bench.limit(0)).count() == 0


def test_decontamination_by_a_very_long_item(frame, prose):
    item = [f"{w}{i % 13}" for i, w in enumerate(prose(7, 20_000).split())]
    part = item[9_000:9_040]
    docs = [(1, " ".join(item)), (2, "and " + " ".join([*part[:20], "other", *part[21:]]) + " or"), (3, prose(8, 500)), (4, "so so " * 5_000)]
    df = frame(docs, "doc_id long, text string")
    bench = frame([(1, " ".join(item)), (2, "so " * 300)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_match, r.n_differ, r.doc_start, r.item_start) for r in decontam.overlaps(df, bench).collect()}
    assert got == {(1, 1): (20_000, 0, 0, 0), (2, 1): (39, 1, 1, 9_000), (4, 2): (300, 0, 0, 0)}


# ------------------------------------------------------------ lines


def test_lines_against_sql(spark, frame, prose):
    rng, rows = random.Random(6), []
    pool = [prose(i, rng.choice([1, 3, 7, 8, 9, 25, 60])) for i in range(40)]
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            w = rng.choice(pool).split()
            change = rng.random()
            if change < 0.25:
                w[rng.randrange(len(w))] = "other"
            elif change < 0.4:
                w.insert(rng.randrange(len(w) + 1), "more")
            elif change < 0.5:
                del w[rng.randrange(len(w))]
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i * 2, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "a a a a a a a a\na a a a a a a\na a a a a a a a a"), (504, ("long " * 5000).strip() + "\n" + ("long " * 4999).strip()), (505, "one two three four five six seven eight\none two four five six seven eight nine")]
    df = frame(rows, "doc_id long, text string", extra=("line", "words", "first", "near"))
    got = sorted(map(tuple, linedup.repeated_lines(df).drop("text_tag").collect()))
    documents = df.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.sql(linedup.ORACLE_SQL).fetchall())
    assert got == want and sum(r[4] for r in want) > 10
    gone = defaultdict(set)
    for i, no, *_ in want:
        gone[i].add(no)
    kept = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for n, x in enumerate(lines, 1) if n not in gone[i]]
        if not gone[i] or any(x.split() for x in left):
            kept[i] = "\n".join(left) if t is not None else None
    out = linedup.dedup_lines(df)
    assert {r.doc_id: r.text for r in out.collect()} == kept and out.columns == df.columns
    assert linedup.repeated_lines(df.limit(0)).count() == 0


def test_lines_of_repeated_rows(frame):
    line = "this line has got a few more than eight words"
    rows = [(1, line), (1, line), (None, line), (2, "x\n" + line), (2, "y")]
    df = frame(rows, "doc_id long, text string")
    got = sorted(map(tuple, linedup.repeated_lines(df).drop("text_tag").collect()), key=repr)
    assert got == [(2, 2, 1, 1, 0), (None, 1, 1, 1, 0)]
    assert sorted(r.text for r in linedup.dedup_lines(df).collect()) == [line, line, "x", "y"]


def test_close_pairs_lose_none():
    rng = np.random.default_rng(12)
    for dim, threshold in ((1, 0.93), (2, 0.5), (24, 0.93), (64, 0.93), (100, 0.8), (300, 0.93), (64, -0.2)):
        v = rng.standard_normal((150, dim))
        w = np.concatenate((v[:100] + rng.choice([0.0, 0.1, 0.35, 0.5], (100, 1)) * rng.standard_normal((100, dim)), rng.standard_normal((50, dim)), np.ones((1, dim)), v[:1] * 1e-200))
        turn = embdup.rotation(dim)
        unit = v / np.linalg.norm(v, axis=1)[:, None]
        bits, factor = embdup.codes(unit, turn)
        i, j = embdup.close_pairs(v, bits, factor, w / np.abs(w).max(axis=1, keepdims=True), turn, threshold)
        cosine = unit @ (w / np.abs(w).max(axis=1, keepdims=True) / np.linalg.norm(w / np.abs(w).max(axis=1, keepdims=True), axis=1)[:, None]).T
        sure = cosine >= threshold + 1e-9
        got = np.zeros(cosine.shape, bool)
        got[i, j] = True
        assert got[sure].all() and not got[cosine < threshold - 1e-9].any() and sure.any()


def test_estimates_leave_few_pairs_to_compute():
    rng = np.random.default_rng(4)
    v = rng.standard_normal((600, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    turn = embdup.rotation(64)
    bits, factor = embdup.codes(v, turn)
    _, upper = embdup.estimate(bits, factor, v @ turn, 64)
    assert ((upper >= 0.93) & ~np.eye(600, dtype=bool)).mean() < 0.01


def test_rounds_look_components_up_once_a_class(spark, frame, prose, monkeypatch):
    """A further round joins one row of each class with its component, not one of each shingle, and finds what no round finds."""
    base = prose(1, 60).split()
    rows = [(i, " ".join([*base[: i % 30], f"own{i}", *base[i % 30 :]])) for i in range(60)]
    docs = frame(rows, "doc_id long, text string")
    result = lambda: {(r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.near_duplicates(docs).collect()}
    monkeypatch.setattr(ngramjoin, "FEW_PAIRS", float("inf"))
    want = result()
    looked, labelled = [], ngramjoin._labelled

    def spy(rows, links):
        looked.append((rows.count(), rows.select("class").distinct().count()))
        return labelled(rows, links)

    monkeypatch.setattr(ngramjoin, "_labelled", spy)
    monkeypatch.setattr(ngramjoin, "FEW_PAIRS", -1)
    assert result() == want
    assert len(looked) > 1 and looked[-1][0] > 0
    assert all(n == classes for n, classes in looked)


def test_open_rows_packed_by_class_stay_the_same(spark):
    rng = random.Random(6)
    flat = {(rng.randrange(50), c, 100 + c, rng.randrange(9), 2 + c % 3, 10 * c) for c in range(20) for _ in range(5)}
    known = spark.createDataFrame([(*r, 0, 0, 1) for r in flat], "token long, class long, n int, place int, need int, centre int, component long, largest long, met long")
    packed = ngramjoin._by_class(known)
    assert packed.count() == 20
    assert {tuple(r) for r in ngramjoin._by_token(packed, "centre").collect()} == flat


@pytest.mark.parametrize(("held", "most", "collects"), [(300, 750, False), (376, 750, True)])
def test_driver_collects_garbage_beyond_half_of_its_heap(held, most, collects):
    from types import SimpleNamespace as Box

    from panewise.llm.common import spare_driver

    calls = []
    lang = Box(Runtime=Box(getRuntime=lambda: Box(totalMemory=lambda: held, maxMemory=lambda: most)), System=Box(gc=lambda: calls.append(1)))
    assert spare_driver(Box(sparkContext=Box(_jvm=Box(java=Box(lang=lang))))) == collects
    assert len(calls) == collects
