import math
from collections import defaultdict

import numpy as np
import pytest

from panewise.llm import entries, langid

SF = "/root/testdata/sf0.01"
LATIN, GREEK = ["banana bandana", "abba anna band"], ["αβγα αβ", "βαγ αβγ"]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, t, "la") for i, t in enumerate(LATIN)] + [(9 + i, t, "el") for i, t in enumerate(GREEK)] + [(20, None, "la"), (21, "x y", None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def brute_force(texts):
    """Interpolated Kneser-Ney over dictionaries, straight from its definition."""
    counts = [defaultdict(int) for _ in range(langid.ORDER + 1)]
    for t in texts:
        s = [chr(c) for c in langid.symbols(t).astype(int)]
        for k in range(1, langid.ORDER + 1):
            x = [" "] * (langid.ORDER - 2) + s
            for i in range(len(x) - k + 1):
                counts[k][tuple(x[i : i + k])] += 1
    used = [None] * (langid.ORDER + 1)
    for k in range(1, langid.ORDER + 1):
        used[k] = dict(counts[k]) if k == langid.ORDER else {g: max(1, sum(h[1:] == g for h in counts[k + 1])) for g in counts[k]}

    def discount(k):
        n1, n2 = (sum(v == n for v in used[k].values()) for n in (1, 2))
        return min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.1), 0.95)

    def p(gram):
        if not gram:
            return 1 / 4096
        k, d = len(gram), discount(len(gram))
        same = {g: v for g, v in used[k].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * p(gram[1:])

    return p


def test_probabilities_match_the_definition(small):
    assert small.langs == ["el", "la"]
    for column, texts in enumerate((GREEK, LATIN)):
        p = brute_force(texts)
        for text in ("band", "αβγ banana", "zz nana", "a"):
            s = [" "] * (langid.ORDER - 1) + [chr(c) for c in langid.symbols(text).astype(int)][1:]
            want = [math.log(p(tuple(s[i : i + langid.ORDER]))) for i in range(len(s) - langid.ORDER + 1)]
            h, n = small.entropies([text])
            assert n[0] == len(want)
            assert h[0, column] == pytest.approx(-sum(want) / len(want), rel=1e-9)


def test_probabilities_sum_to_one(small):
    p = brute_force(LATIN)
    alphabet = sorted({c for t in LATIN for c in t})
    total = sum(p((*" ban", c)) for c in alphabet)
    assert total <= 1 + 1e-9 and total > 0.9


def test_blocks_of_long_texts_change_nothing(small, monkeypatch):
    text = "banana αβγ band " * 300
    whole, n = small.entropies([text, "anna", None])
    monkeypatch.setattr(langid, "BLOCK", 97)
    parts, m = small.entropies([text, "anna", None])
    assert n.tolist() == m.tolist()
    np.testing.assert_allclose(whole, parts)


def test_predictions_and_odd_rows(small, frame):
    rows = [(1, "banana banda"), (2, "αβγ αβ"), (3, None), (4, ""), (5, "123 !?"), (6, "banana band " * 20000), (7, "αβγ"), (7, "αβγ"), (None, "anna"), (8, "жжжж щщщщ ёёёё " * 30)]
    df = frame(rows, "doc_id long, text string", extra=("score", "lang"))
    out = [tuple(r) for r in langid.predict(df, small).collect()]
    lang = {i: (x, s, ok) for i, x, s, _, ok in out}
    assert [lang[i][0] for i in (1, 2, 3, 4, 5, 6, 7, None)] == ["la", "el", "und", "und", "und", "la", "el", "la"]
    assert all(0 <= s <= 1 for _, s, _ in lang.values()) and lang[3][1] == 0
    assert not lang[3][2] and not lang[5][2] and len(out) == len(rows)
    assert langid.predict(df.limit(0), small).count() == 0


def test_nothing_to_learn(frame):
    df = frame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.fit(df) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    out = entries.op3_language_id(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held) > 0
    assert sum(r.accepted for r in out) >= 0.99 * len(out)
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    _, _, _, ok = model.predict(["жжжж щщщщ ёёёё ъъъ ыыы " * 20, "zxqj vwkq xzzq jqxv " * 20])
    assert not ok.any()


def test_documents_out_of_the_sample_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, rows_per_lang=60)
    learnt = {r["text"] for r in langid.training_sample(docs, "text", "lang", "doc_id", 60).select("text").collect()}
    texts = [r["text"] for r in docs.select("text").collect() if r["text"] not in learnt]
    _, sizes = model.entropies(texts)
    ok = model.predict(texts)[3]
    assert len(texts) > 500 and ok[sizes > 0].sum() >= 0.999 * (sizes > 0).sum() and ok[(sizes > 0) & (sizes < 100)].all()
    assert model.predict(["A.", "Re."])[3].all()
    assert not model.predict(["жжжж щщщщ ёёёё ъъъ ыыы " * 20, "zxqj vwkq xzzq jqxv " * 20])[3].any()
    assert list(model.limits) == sorted(model.limits, reverse=True)
