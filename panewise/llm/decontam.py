"""Benchmark decontamination with spaced-seed hashes.

A seed is a fixed mask over consecutive words that ignores some of its positions, so
a hash of the rest survives substitutions at the ignored ones. Seeds of all
benchmark windows and of all document windows are joined; each hit fixes an
alignment (document position minus item position), along which the words are
compared without gaps. The best-scoring stretch (+1 for an equal word, -``PENALTY`` for another)
counts as an overlap if it holds at least ``min_match`` equal words, or the whole item if that is shorter.

Words are lower-cased, lose ASCII punctuation and are split at ASCII white space. Items
with fewer words than the longest mask are searched as a whole, word for word;
items with fewer than ``MIN_ITEM`` words, null or empty ones are not searched.
Null or empty documents have no overlap. A row with a null id is reported with a null id.
Rows with one id and different texts count separately; equal rows are reported once.

A fixed-size filter of the benchmark's seeds keeps other document windows out of the
shuffle; the join behind it is exact. Long items are verified along their whole length.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import U64, column_bytes, id_filter, map_arrow, mix, window_hashes, word_hashes, written

#: Fixed masks; 1 counts, 0 is ignored.
MASKS = ("1101100101", "1110010011", "1011010110", "111111")
SPAN = max(map(len, MASKS))
MIN_ITEM, MIN_MATCH, PENALTY = 5, 13, 2.5
_PUNCTUATION = string.punctuation.encode()


def words_of(text: bytes | None) -> np.ndarray:
    """Hashes of the normalised words of a text."""
    if not text:
        return np.empty(0, U64)
    if text.isascii():
        return word_hashes(text.translate(None, _PUNCTUATION), lower=True)
    return word_hashes(text.decode().lower().encode().translate(None, _PUNCTUATION))


def seeds(h: np.ndarray, widths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of all masks at all positions, and of whole windows of the given widths."""
    hashes, places = [], []
    for no, mask in enumerate(MASKS):
        x = window_hashes(h, len(mask), tuple(i for i, c in enumerate(mask) if c == "1"))
        hashes.append(mix(x + U64(no + 1)))
        places.append(np.arange(len(x)))
    for width in widths:
        x = window_hashes(h, width)
        hashes.append(mix(x ^ U64(width << 8)))
        places.append(np.arange(len(x)))
    return np.concatenate(hashes), np.concatenate(places)


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(equal words, first item word, end) of the best stretch along one alignment."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    if a >= b:
        return 0, 0, 0
    equal = doc[a + shift : b + shift] == item[a:b]
    total = np.concatenate(([0.0], np.cumsum(np.where(equal, 1.0, -PENALTY))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return int(equal[start:end].sum()), a + start, a + end


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words, n): the distinct items long enough to search; words is a binary array of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [words_of(t) for t in column_bytes(batch.column(1))]
            yield pa.record_batch({"item": batch.column(0), "words": pa.array([x.tobytes() for x in h], pa.binary()), "n": pa.array([len(x) for x in h], pa.int32())})

    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "item long, words binary, n int").filter(F.col("n") >= MIN_ITEM).distinct()


def overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH) -> DataFrame:
    """One row per document and item that overlap: (id, item, n_match, n_differ, doc_start, item_start, item_words)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("tag", F.xxhash64("text"))
    items = written(benchmark_items(benchmark, item_col, item_text_col).withColumn("item_tag", F.xxhash64("words")), "items")
    widths = tuple(sorted(r["n"] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect()))  # at most SPAN values

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw, n, tag in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h, at = seeds(np.frombuffer(raw, U64), (n,) if n < SPAN else ())
                if n < SPAN:  # whole items only
                    h, at = h[-1:], at[-1:]
                yield pa.record_batch({"seed": pa.array(h.view(np.int64)), "item": pa.array([item] * len(h), pa.int64()), "item_tag": pa.array([tag] * len(h), pa.int64()), "item_at": pa.array(at.astype(np.int32))})

    grams = map_arrow(items.select("item", "words", "n", "item_tag"), item_seeds, "seed long, item long, item_tag long, item_at int")
    known = spark.sparkContext.broadcast(id_filter(grams.select("seed"), 22))

    def doc_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray, int]] = []
            for row, text in enumerate(column_bytes(batch.column(1))):
                h, at = seeds(words_of(text), widths)
                hit = known.value.has(h.view(np.int64))
                if hit.any():
                    out.append((h[hit], at[hit], row))
            rows = np.repeat([r for _, _, r in out], [len(h) for h, _, _ in out]).astype(np.int64) if out else np.empty(0, np.int64)
            h = np.concatenate([h for h, _, _ in out]) if out else np.empty(0, U64)
            at = np.concatenate([a for _, a, _ in out]) if out else np.empty(0, np.int64)
            yield pa.record_batch({"seed": pa.array(h.view(np.int64)), "id": batch.column(0).take(pa.array(rows)), "tag": batch.column(2).take(pa.array(rows)), "doc_at": pa.array(at.astype(np.int32))})

    hits = map_arrow(docs, doc_seeds, "seed long, id long, tag long, doc_at int").join(grams, "seed")
    # at most as many alignments as document and item have words
    found = hits.groupBy("id", "tag", "item", "item_tag").agg(F.collect_set(F.col("doc_at") - F.col("item_at")).alias("shifts"))
    found = written(found, "hits")
    marked = spark.sparkContext.broadcast(id_filter(found.select("tag")))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked.value.has(batch.column(2).to_numpy()), pa.bool_()))

    texts = map_arrow(docs, candidates, "id long, text string, tag long").dropDuplicates(["tag"]).select("tag", "text")
    rows = found.join(items.select("item", "item_tag", "words"), ["item", "item_tag"]).join(texts, "tag").select("id", "tag", "item", "shifts", "words", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, doc = None, np.empty(0, U64)
        for batch in batches:
            out = []
            ids, tags, item_ids, shift_lists, raws = (batch.column(i).to_pylist() for i in range(5))
            for i, text in enumerate(column_bytes(batch.column(5))):
                if text != last:
                    last, doc = text, words_of(text)
                item = np.frombuffer(raws[i], U64)
                n, less, at, start = max((n, a + n - b, -a - shift, -a) for shift in shift_lists[i] for n, a, b in (overlap(doc, item, shift),))
                if n >= min(min_match, len(item)):
                    out.append((ids[i], tags[i], item_ids[i], n, -less, -at, -start, len(item)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 5]
            yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["id", "tag", "item", "n_match", "n_differ", "doc_start", "item_start", "item_words"])

    good = map_arrow(rows, check, "id long, tag long, item long, n_match int, n_differ int, doc_start int, item_start int, item_words int")
    best = good.groupBy("id", "tag", "item").agg(F.max(F.struct("n_match", -F.col("n_differ"), -F.col("doc_start"), -F.col("item_start"), "item_words")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("tag").alias("text_tag"), F.col("item").alias(item_col), "b.n_match", (-F.col("b.col2")).alias("n_differ"), (-F.col("b.col3")).alias("doc_start"), (-F.col("b.col4")).alias("item_start"), F.col("b.item_words").alias("item_words"))


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns, without those whose text overlaps a benchmark item."""
    bad = overlaps(df, benchmark, id_col, text_col, **options).select(F.col("text_tag").alias("tag_")).distinct()
    return df.join(bad, F.xxhash64(F.col(text_col).cast("string")) == bad["tag_"], "left_anti")
