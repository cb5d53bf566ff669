"""Language identification with interpolated Kneser-Ney character models.

One character model per language, orders 1 to ``ORDER``. Spark counts the n-grams
of the training rows; the tables are then fixed arrays of 64-bit n-gram hashes in
ascending order, one array per order for all languages together, with one column
of probabilities per language. Scoring is a binary search per character in the top
order; only characters whose n-gram is unknown go through the lower orders. The
language with the lowest cross-entropy per character wins. A text is rejected when
its best cross-entropy lies above the limit of its length class, calibrated on labelled rows that the
models were not fitted on.

Training uses at most ``rows_per_lang`` rows of each language (those with the
smallest hash of their id) and keeps at most ``max_ngrams`` n-grams of an order.
Null texts and texts without a letter are ``und`` with score 0 and are rejected.
Ties go to the language that sorts first. Repeated rows each get their own row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panewise.llm.common import U64, give_back, kept_schema, map_arrow, mix

ORDER = 5
#: Bounds of the training sample and of the model (see the module docstring).
ROWS_PER_LANG = 600
MAX_NGRAMS = 400_000
#: Characters scored together.
BLOCK = 100_000
SHARPNESS = 6.0
#: Length classes (scored symbols) of the rejection limit; texts below ``SHORT`` symbols get ``SHORT_MARGIN``.
CLASSES, SHORT, SHORT_MARGIN = (12, 40, 100, 400, 1600), 40, 2.0
#: Rows without which a language has too few left-out rows, or a class no limit of its own.
LEFT_OUT = 100
UND = "und"

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def symbols(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters; every run of other characters is one blank, blanks at both ends."""
    if not text:
        return np.empty(0, U64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[cp]
    if not is_letter.any():
        return np.empty(0, U64)
    cp = np.where(is_letter, cp, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    cp = cp[keep]
    cp = cp if cp[-1] == 32 else np.append(cp, 32)
    return np.concatenate(([32], cp[1:] if cp[0] == 32 else cp)).astype(U64)


def gram_hashes(s: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols that end at each position from k - 1 on; the same symbols hash alike in any order k."""
    n = len(s) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    total = np.full(n, k, U64)
    for j in range(k):
        total = (total ^ s[j : j + n]) * U64(0x9E3779B97F4A7C15)
        total ^= total >> U64(29)
    return mix(total)


@dataclass
class KneserNey:
    """Sorted hash arrays of all orders; ``direct[k]`` and ``backoff[k]`` have a column per language."""

    langs: list[str]
    keys: list[np.ndarray]
    direct: list[np.ndarray]
    backoff: list[np.ndarray]
    full: np.ndarray  # log probability of each top-order n-gram, interpolated
    uniform: float
    limits: tuple[float, ...] = (math.inf,) * (len(CLASSES) + 1)

    def places(self, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        h = gram_hashes(s, k)
        keys = self.keys[k - 1]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def _ladder(self, s: np.ndarray) -> np.ndarray:
        """Interpolated probability of the last symbol of each window of ORDER symbols; s has shape (ORDER, n)."""
        n = s.shape[1]
        p = np.full((n, len(self.langs)), self.uniform)
        for k in range(1, ORDER + 1):
            if k > 1:
                at, hit = self._columns(s[ORDER - k : ORDER - 1])
                p *= np.where(hit[:, None], self.backoff[k - 2][at], 1.0)
            at, hit = self._columns(s[ORDER - k :])
            if k == 1:
                p *= self.backoff[ORDER]
            p += np.where(hit[:, None], self.direct[k - 1][at], 0.0)
        return p

    def _columns(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.full(s.shape[1], len(s), U64)
        for row in s:
            total = (total ^ row) * U64(0x9E3779B97F4A7C15)
            total ^= total >> U64(29)
        h, keys = mix(total), self.keys[len(s) - 1]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def log_probs(self, s: np.ndarray) -> np.ndarray:
        """Log probabilities of the symbols from ORDER - 1 on, one column per language."""
        at, hit = self.places(s, ORDER)
        out = self.full[at]
        miss = np.flatnonzero(~hit)
        if len(miss):
            windows = np.stack([s[miss + j] for j in range(ORDER)])
            out[miss] = np.log(self._ladder(windows))
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol and language of each text, and how many symbols were scored."""
        pad = np.full(ORDER - 1, 32, U64)
        out, sizes = np.full((len(texts), len(self.langs)), np.inf), np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        rows: list[int] = []

        def flush() -> None:
            if not rows:
                return
            lp = self.log_probs(np.concatenate([*parts, pad[:0]]))
            at = 0
            for row, part in zip(rows, parts, strict=True):
                n = len(part) - (ORDER - 1)
                total = -lp[at : at + n].sum(axis=0)
                out[row] = total if sizes[row] == 0 else out[row] + total
                sizes[row] += n
                at += len(part)
            parts.clear()
            rows.clear()

        held = 0
        for row, text in enumerate(texts):
            s = symbols(text)
            if not len(s):
                continue
            s = np.concatenate([pad, s[1:]])
            for start in range(0, len(s) - ORDER + 1, BLOCK):  # a very long text is scored in blocks that overlap by the context
                parts.append(s[start : start + BLOCK + ORDER - 1])
                rows.append(row)
                held += len(parts[-1])
                if held >= BLOCK:
                    flush()
                    held = 0
        flush()
        with np.errstate(invalid="ignore"):
            return out / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score from 0 to 1, best cross-entropy and whether the text is accepted."""
        h, sizes = self.entropies(texts)
        some = sizes > 0
        best = np.where(some, h.argmin(axis=1), 0)
        low = h[np.arange(len(texts)), best] if len(texts) else np.empty(0)
        score = np.zeros(len(texts))
        if some.any():
            # the margin counts for more the longer the text
            weight = SHARPNESS * np.sqrt(np.minimum(sizes[some], 400))[:, None]
            score[some] = 1.0 / np.exp(-weight * (h[some] - low[some, None])).sum(axis=1)
        accepted = some & (low <= np.array(self.limits)[np.searchsorted(CLASSES, sizes, side="right")])
        return [self.langs[b] if ok else UND for b, ok in zip(best, some, strict=True)], score, np.where(some, low, np.nan), accepted


def training_sample(df: DataFrame, text_col: str, lang_col: str, id_col: str, rows_per_lang: int) -> DataFrame:
    """At most ``rows_per_lang`` rows of each language, those with the smallest hash of id and text."""
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not counts:
        return rows.select("text", "lang", "h")
    # a first cut by hash value keeps what the exact top-k has to sort near its bound
    span = 2.0**64
    cut = F.lit(2**63 - 1)
    for lang, n in counts.items():
        if n > 4 * rows_per_lang:
            cut = F.when(F.col("lang") == lang, F.lit(int(-(2**63) + span * 2 * rows_per_lang / n))).otherwise(cut)
    w = Window.partitionBy("lang").orderBy("h", "text")
    return rows.filter(F.col("h") <= cut).withColumn("k", F.row_number().over(w)).filter(F.col("k") <= rows_per_lang).select("text", "lang", "h")


def count_ngrams(sample: DataFrame) -> DataFrame:
    """(lang, k, gram, ctx, suf, n): counts of all n-grams with the hashes of their first and last k - 1 symbols."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in sorted(set(batch.column(1).to_pylist())):
                rows = [t for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x == lang]
                parts = [s for s in map(symbols, rows) if len(s)]
                for k in range(1, ORDER + 1):
                    pad = np.full(ORDER - 2, 32, U64)  # the first letter has a full context, of blanks
                    grams, ctx, suf = [], [], []
                    for s in parts:
                        s = np.concatenate([pad, s])
                        g = gram_hashes(s, k)
                        grams.append(g)
                        if k > 1:
                            below = gram_hashes(s, k - 1)
                            ctx.append(below[:-1])
                            suf.append(below[1:])
                    if not grams:
                        continue
                    g, first, n = np.unique(np.concatenate(grams), return_index=True, return_counts=True)
                    c, f = (np.concatenate(x)[first] if k > 1 else np.zeros(len(g), U64) for x in (ctx, suf))
                    yield pa.record_batch({"lang": pa.array([lang] * len(g)), "k": pa.array(np.full(len(g), k, np.int32)), "gram": pa.array(g.view(np.int64)), "ctx": pa.array(c.view(np.int64)), "suf": pa.array(f.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    rows = map_arrow(sample.select("text", "lang"), count, "lang string, k int, gram long, ctx long, suf long, n long")
    return rows.groupBy("lang", "k", "gram").agg(F.first("ctx").alias("ctx"), F.first("suf").alias("suf"), F.sum("n").alias("n"))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows_per_lang: int = ROWS_PER_LANG, max_ngrams: int = MAX_NGRAMS, reject_quantile: float = 0.999, reject_margin: float = 1.35) -> KneserNey | None:
    """Models of all languages of ``df``; None if there is nothing to learn from.

    The limit of rejection of a length class is the ``reject_quantile`` of the best cross-entropies of all
    labelled rows that took no part in the fit, times ``reject_margin`` (``SHORT_MARGIN`` for short texts, which
    vary more), and at least that of longer texts. If a language has too few rows beyond its sample, models of
    four fifths of the sample are fitted for the limits.
    """
    sample = training_sample(df, text_col, lang_col, id_col, rows_per_lang)
    thin = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).groupBy(lang_col).count().filter(F.col("count") < rows_per_lang + LEFT_OUT)
    limits = None
    if not thin.isEmpty():
        part = sample.filter("pmod(h, 5) > 0")
        limits = _limits(_fitted(part, max_ngrams), df, part, text_col, lang_col, reject_quantile, reject_margin)
    model = _fitted(sample, max_ngrams)
    if model is None:
        return None
    limits = limits or _limits(model, df, sample, text_col, lang_col, reject_quantile, reject_margin)
    # a handful of rows, all of them learnt
    model.limits = limits or _limits(model, df, None, text_col, lang_col, reject_quantile, reject_margin) or model.limits
    return model


def _fitted(sample: DataFrame, max_ngrams: int) -> KneserNey | None:
    counts = count_ngrams(sample)
    w = Window.partitionBy("lang", "k").orderBy(F.desc("n"), "gram")
    t = counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= max_ngrams).drop("r").toArrow().to_pandas()  # bounded: max_ngrams per language and order
    return assemble(t) if len(t) else None


def _limits(model: KneserNey | None, df: DataFrame, learnt: DataFrame | None, text_col: str, lang_col: str, quantile: float, margin: float) -> tuple[float, ...] | None:
    """Limit of each length class from the labelled rows of the model's languages whose text is not in ``learnt``; None without such rows."""
    if model is None:
        return None
    known = np.sort(np.array([r[0] for r in learnt.select(F.xxhash64("text")).distinct().collect()] if learnt is not None else [], np.int64))  # bounded: rows_per_lang per language
    shared = df.sparkSession.sparkContext.broadcast((model, known))
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isin(model.langs) & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        model, known = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 400):
                part = batch.slice(start, 400)
                part = part.filter(pa.array(~np.isin(part.column(1).to_numpy(), known), pa.bool_()))
                h, sizes = model.entropies(part.column(0).to_pylist())
                some = sizes > 0
                yield pa.record_batch({"size": pa.array(np.searchsorted(CLASSES, sizes[some], side="right").astype(np.int32)), "low": pa.array(h[some].min(axis=1))})

    scored = map_arrow(rows.select("text", F.xxhash64("text").alias("h")), run, "size int, low double")
    found = {r["size"]: r for r in scored.groupBy("size").agg(F.count("*").alias("n"), F.percentile_approx("low", quantile, 100_000).alias("q")).collect()}  # one row per class
    shared.destroy()
    if not found:
        return None
    places = range(len(CLASSES) + 1)
    limits = [0.0] * len(places)
    for c in places:
        # a class of few rows is at least as wide as the next shorter one that has rows, else the next longer one
        shorter, longer = [k for k in found if k < c], [k for k in found if k > c]
        beside = found[max(shorter)]["q"] if shorter else found[min(longer)]["q"] if longer else 0.0
        limits[c] = max(found[c]["q"], beside if found[c]["n"] < LEFT_OUT else 0.0) if c in found else beside
    widest = 0.0
    for c in reversed(places):
        widest = max(widest, limits[c])
        limits[c] = widest * (SHORT_MARGIN if c <= CLASSES.index(SHORT) else margin)
    return tuple(limits)


def assemble(t: pd.DataFrame) -> KneserNey:
    """Kneser-Ney tables from n-gram counts (columns of ``count_ngrams``)."""
    langs = sorted(t["lang"].unique())
    t = t.assign(**{c: t[c].to_numpy(np.int64).view(np.uint64) for c in ("gram", "ctx", "suf")})
    keys = [np.unique(t.loc[t["k"] == k, "gram"].to_numpy()) for k in range(1, ORDER + 1)]
    width = len(langs)
    direct = [np.zeros((len(x), width)) for x in keys]
    backoff = [np.ones((len(x), width)) for x in keys]
    unseen = np.ones(width)
    for j, lang in enumerate(langs):
        own = {k: t[(t["k"] == k) & (t["lang"] == lang)] for k in range(1, ORDER + 1)}
        for k in range(1, ORDER + 1):
            rows = own[k]
            if k == ORDER:
                c = rows.set_index("gram")["n"]
            else:  # continuation counts: how many different symbols stand before it
                c = own[k + 1].groupby("suf").size().reindex(rows["gram"], fill_value=0)
                c = c.clip(lower=1)  # what starts a text has no symbol before it
            n1, n2 = int((c == 1).sum()), int((c == 2).sum())
            d = min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.1), 0.95)
            value = c.to_numpy(float)
            at = np.searchsorted(keys[k - 1], rows["gram"].to_numpy())
            if k == 1:
                total = value.sum()
                direct[0][at, j] = (value - d) / total
                unseen[j] = d * len(value) / total
            else:
                ctx, inv = np.unique(rows["ctx"].to_numpy(), return_inverse=True)
                total = np.bincount(inv, value)
                direct[k - 1][at, j] = (value - d) / total[inv]
                spot = np.searchsorted(keys[k - 2], ctx)
                ok = (spot < len(keys[k - 2])) & (keys[k - 2][np.minimum(spot, len(keys[k - 2]) - 1)] == ctx)
                backoff[k - 2][spot[ok], j] = (d * np.bincount(inv) / total)[ok]
    model = KneserNey(langs, keys, direct, [*backoff, unseen], np.zeros((len(keys[-1]), width)), 1.0 / 4096)
    # interpolate the top order once, so that a known n-gram costs one search
    top = t[t["k"] == ORDER].drop_duplicates("gram").sort_values("gram")
    below = _interpolated(model, t)
    spot = np.searchsorted(keys[ORDER - 2], top["ctx"].to_numpy())
    ok = (spot < len(keys[ORDER - 2])) & (keys[ORDER - 2][np.minimum(spot, len(keys[ORDER - 2]) - 1)] == top["ctx"].to_numpy())
    bow = np.where(ok[:, None], backoff[ORDER - 2][np.minimum(spot, len(keys[ORDER - 2]) - 1)], 1.0)
    model.full = np.log(direct[ORDER - 1] + bow * below)
    return model


def _interpolated(model: KneserNey, t: pd.DataFrame) -> np.ndarray:
    """Probability under the orders below the top of each top-order n-gram's last symbol, in key order."""
    p = None
    for k in range(1, ORDER + 1):
        rows = t[t["k"] == k].drop_duplicates("gram").sort_values("gram")
        if k == 1:
            p = model.direct[0] + model.backoff[ORDER] * model.uniform
            continue
        suf, ctx = rows["suf"].to_numpy(), rows["ctx"].to_numpy()
        low = model.keys[k - 2]
        at = np.minimum(np.searchsorted(low, suf), len(low) - 1)
        lower = np.where((low[at] == suf)[:, None], p[at], model.backoff[ORDER] * model.uniform)
        if k == ORDER:
            return lower
        at = np.minimum(np.searchsorted(low, ctx), len(low) - 1)
        bow = np.where((low[at] == ctx)[:, None], model.backoff[k - 2][at], 1.0)
        p = model.direct[k - 1] + bow * lower
    return p


def predict(df: DataFrame, model: KneserNey | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score``, ``cross_entropy`` and ``accepted`` for every row of ``df``.

    Without a model (nothing to learn from) every row is ``und`` and rejected.
    """
    n_keep = len(keep)
    shared = df.sparkSession.sparkContext.broadcast(model)
    # a text that is kept travels once
    own = keep.index(text_col) if text_col in keep and dict(df.dtypes)[text_col] == "string" else n_keep
    picked = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(keep)], *([df[text_col].cast("string").alias("text_")] if own == n_keep else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        model = shared.value
        for batch in batches:
            for start in range(0, max(1, batch.num_rows), 400):
                part = batch.slice(start, 400)
                texts = part.column(own).to_pylist()
                if model is None:
                    lang, score, low, ok = [UND] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), np.zeros(len(texts), bool)
                else:
                    lang, score, low, ok = model.predict(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], pa.array(lang, pa.string()), pa.array(score), pa.array(low, from_pandas=True), pa.array(ok)], names=[*[f"c{i}" for i in range(n_keep)], "lang_pred", "score", "cross_entropy", "accepted"])
        give_back()  # the next stages may leave this worker idle

    return map_arrow(picked, run, kept_schema(picked, n_keep, "lang_pred string, score double, cross_entropy double, accepted boolean")).toDF(*keep, "lang_pred", "score", "cross_entropy", "accepted")
