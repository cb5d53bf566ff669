"""Hard negatives by rotated one-bit codes and certain score intervals.

Scores are integer inner products of the vectors ``floor(scale x)``. For each anchor, its positives are the
``n_positives`` best other rows of the same label; for each anchor and positive, its hard negatives are the ``n_negatives``
best rows of other labels whose score lies between ``low`` and ``high`` per cent of the positive's. Equal scores go by the smaller id.

Every vector v is rotated by one random orthogonal matrix and coded by ``CODES`` sign codes: o_1 holds the signs of
the rotated vector, o_2 those of what ``<v, o_1> o_1`` leaves of it, and so on. A row stores the bits, the alignments
c_j of each code with what it codes, and the norm of the last rest. An anchor q is rotated and rounded to ``BITS`` bits a
component, kept as bit planes, so ``<q', o_j>`` comes from population counts of ``plane AND code``. Then

    |<q, v> - sum_j c_j <q', o_j>|  <=  |q - q'| |v| + |rest| sqrt(|q'|^2 - <q', o_last>^2)

holds for certain (Cauchy-Schwarz; the rest is orthogonal to the last code). An anchor's best lower bounds give a score that the wanted
rows must reach; rows whose interval lies below it, or outside the wanted range, are skipped, and the others are scored
in 64-bit integers, which alone decide.

Rows are dealt into blocks by hash, anchors too, and each pair of blocks is one group: for positives within a label, for negatives over all
labels. A group returns its best per anchor (and positive), which one ranking per anchor merges. Work grows with
anchors times rows, as that of any exact search; tasks stay bounded whatever label is large. Sizes of labels go
back to the rows by (label, salt), so a large label spreads.

Rows with null id, label or vector, or with a null or non-finite component take no part, nor do vectors whose integer form
is of norm 2^27 or more (their scores might leave 64 bits), nor empty ones. Vectors are compared with those of equal length only. Of
rows that repeat an id, the least by label, then vector, counts. Labels may be of any type; they are compared as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panewise.llm.common import map_arrow, ship, written
from panewise.llm.embdup import rotation

SCALE, CODES, BITS, SALTS = 256, 6, 6, 64
#: Rows and anchors of a block, about; anchors and rows compared in one array.
ROW_BLOCK, ANCHOR_BLOCK, PIECE = 16_384, 1024, (128, 4096)
#: Norm of the largest integer vectors: 100 times a score still fits 64 bits.
LARGEST = float(1 << 27)
#: Part of the norms' product that allows for rounding of the bounds in double precision.
SLACK = 1e-9


def encoded(v: np.ndarray, turn: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray]:
    """Codes of integer vectors: bits (vector, code, word) and numbers (alignments, norm of the rest, norm)."""
    rest = v @ turn
    n, dim = v.shape
    bits = np.zeros((n, codes, -(-dim // 64) * 8), np.uint8)
    numbers = np.empty((n, codes + 2))
    for j in range(codes):
        sign = rest >= 0
        packed = np.packbits(sign, axis=1, bitorder="little")
        bits[:, j, : packed.shape[1]] = packed
        numbers[:, j] = np.abs(rest).sum(axis=1) / np.sqrt(dim)
        rest = rest - np.where(sign, 1, -1) * (numbers[:, j, None] / np.sqrt(dim))
    numbers[:, -2] = np.linalg.norm(rest, axis=1)
    numbers[:, -1] = np.linalg.norm(v.astype(float), axis=1)
    return bits.view("<u8").reshape(n, codes, -1), numbers


class Planes:
    """Anchors, rotated and rounded, as bit planes."""

    def __init__(self, v: np.ndarray, turn: np.ndarray, bits: int = BITS):
        turned = v @ turn
        n, dim = turned.shape
        self.dim = dim
        self.low = turned.min(axis=1)
        self.step = (turned.max(axis=1) - self.low) / ((1 << bits) - 1)
        level = np.rint((turned - self.low[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.total, self.norm, self.error = rounded.sum(axis=1), np.linalg.norm(rounded, axis=1), np.linalg.norm(turned - rounded, axis=1)
        raw = np.zeros((n, bits, -(-dim // 64) * 8), np.uint8)
        for p in range(bits):
            packed = np.packbits((level >> p) & 1, axis=1, bitorder="little")
            raw[:, p, : packed.shape[1]] = packed
        self.planes = raw.view("<u8").reshape(n, bits, -1)

    def bounds(self, bits: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Certain lower and upper bounds of all scores, (anchor, row)."""
        codes = bits.shape[1]
        estimate = np.zeros((len(self.low), len(bits)))
        for j in range(codes):
            weighed = np.zeros(estimate.shape, np.int64)
            for p in range(self.planes.shape[1]):
                for w in range(bits.shape[2]):
                    weighed += np.left_shift(np.bitwise_count(self.planes[:, p, w, None] & bits[None, :, j, w]).astype(np.int64), p)
            ones = np.bitwise_count(bits[:, j]).sum(axis=1, dtype=np.int64)
            with_code = (2 * (self.low[:, None] * ones + self.step[:, None] * weighed) - self.total[:, None]) / np.sqrt(self.dim)
            estimate += with_code * numbers[:, j]
        norm = np.sqrt(np.maximum(self.norm[:, None] ** 2 - with_code**2, 0))
        within = self.error[:, None] * numbers[:, -1] + numbers[:, -2] * norm + SLACK * (self.norm + self.error)[:, None] * numbers[:, -1]
        return estimate - within, estimate + within


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, -inf if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Best:
    """The best scores per slot met so far; equal scores go by the smaller id."""

    def __init__(self, slots: int, k: int):
        self.slots, self.k = slots, k
        self.slot, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        slot, ids, score = (np.concatenate(x) for x in ((self.slot, slot), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order, slot = order[rank < self.k], slot[rank < self.k]
        self.slot, self.id, self.score = slot, ids[order], score[order]

    def floor(self) -> np.ndarray:
        """Score of the last of each full slot, -inf of the others."""
        out = np.full(self.slots, -np.inf)
        last = np.searchsorted(self.slot, np.arange(self.slots), "right") - 1
        full = np.bincount(self.slot, minlength=self.slots) == self.k
        out[full] = self.score[last[full]]
        return out


def _scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for s in range(0, len(i), 50_000):
        piece = slice(s, s + 50_000)
        out[piece] = np.einsum("nd,nd->n", a[i[piece]], b[j[piece]])
    return out


def best_rows(anchors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, bits: np.ndarray, numbers: np.ndarray, turn: np.ndarray, allowed, low: np.ndarray, high: np.ndarray, k: int) -> Best:
    """For every anchor and range (``low``, ``high``: anchor, range), the ``k`` best rows with scores in the range.

    ``allowed(anchors, rows)`` says for two slices which pairs count. Slots are ``anchor * ranges + range``.
    """
    ranges = low.shape[1]
    best = Best(len(anchors) * ranges, k)
    for a in range(0, len(anchors), PIECE[0]):
        own = slice(a, min(a + PIECE[0], len(anchors)))
        planes = Planes(anchors[own], turn)
        for r in range(0, len(rows), PIECE[1]):
            some = slice(r, min(r + PIECE[1], len(rows)))
            lower, upper = planes.bounds(bits[some], numbers[some])
            counts = allowed(own, some)
            known = best.floor().reshape(-1, ranges)[own]
            wanted = np.zeros(lower.shape, bool)
            for m in range(ranges):
                least, most = low[own, m, None], high[own, m, None]
                sure = np.where(counts & (lower >= least) & (upper <= most), lower, -np.inf)
                reach = np.maximum(np.maximum(_kth(sure, k), known[:, m])[:, None], least)
                wanted |= counts & (upper >= reach) & (lower <= most)
            i, j = np.nonzero(wanted)
            score = _scores(anchors, rows, i + a, j + r)
            for m in range(ranges):
                good = (score >= low[i + a, m]) & (score <= high[i + a, m])
                best.add((i[good] + a) * ranges + m, row_ids[j[good] + r], score[good])
    return best


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<i4") for x in column.to_pylist()]).astype(np.int64)


def _coded_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column, scale: float) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), anchors.alias("anchor"))
    sound = F.expr("size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v", F.coalesce("anchor", F.lit(False)).alias("anchor"))).alias("r")).select("id", "r.*")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(2)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())
            dims = np.diff(ends, prepend=0)
            whole = np.floor(scale * flat)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = whole[(ends[at] - dim)[:, None] + np.arange(dim)]
                with np.errstate(over="ignore"):
                    small = np.sqrt((x * x).sum(axis=1)) < LARGEST
                at, x = at[small], x[small].astype(np.int64)
                if dim not in turns:
                    turns[dim] = rotation(dim)
                bits, numbers = encoded(x, turns[dim])
                kept = batch.take(pa.array(at))
                yield pa.record_batch({
                    "id": kept.column(0), "label": kept.column(1), "dim": pa.array(np.full(len(at), dim, np.int32)), "anchor": kept.column(3),
                    "v": pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()), "bits": pa.array([r.tobytes() for r in bits], pa.binary()), "numbers": pa.array([r.tobytes() for r in numbers], pa.binary()),
                })

    coded = map_arrow(rows, encode, "id long, label string, dim int, anchor boolean, v binary, bits binary, numbers binary")
    return written(coded.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(SALTS)).cast("int")), "vectors")


def _dealt(rows: DataFrame, anchors: DataFrame, keys: list[str], row_block: int, anchor_block: int) -> DataFrame:
    """Pairs of blocks of rows and anchors with equal ``keys``: both sides under (keys, low, high), ``side`` tells them apart."""
    salted = rows.groupBy(*keys, "salt").agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"))
    total = salted.groupBy(*keys).agg(F.ceil(F.sum("n") / row_block).cast("int").alias("row_blocks"), F.ceil(F.sum("a") / anchor_block).cast("int").alias("anchor_blocks"))
    sizes = salted.select(*keys, "salt").join(total.filter("anchor_blocks > 0"), keys)  # at most SALTS rows of a key
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = list(dict.fromkeys([*keys, "row_at", "anchor_at", "side", "id", "label", "v", "bits", "numbers"]))
    left = rows.join(sizes, [*keys, "salt"]).withColumn("row_at", place("row_blocks", 1)).withColumn("anchor_at", every("anchor_blocks")).withColumn("side", F.lit(0))
    right = anchors.join(sizes, [*keys, "salt"]).withColumn("anchor_at", place("anchor_blocks", 2)).withColumn("row_at", every("row_blocks")).withColumn("side", F.lit(1))
    none = F.lit(None).cast("array<struct<score:bigint,id:bigint>>")
    left = left.withColumn("positives", none).select(*columns, "positives")
    return left.unionByName(right.select(*columns, "positives")).groupBy(*keys, "row_at", "anchor_at")


def hard_negatives(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = SCALE,
    n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchors`` says which rows of ``df`` are anchors."""
    ship(df.sparkSession)
    rows = _coded_rows(df, id_col, vector_col, label_col, anchors, scale)
    starts = rows.filter("anchor")

    def both(table: pa.Table):
        side = table.column("side").to_numpy()
        r, a = (table.take(pa.array(np.flatnonzero(side == s))) for s in (0, 1))
        if not len(r) or not len(a):
            return None
        rows_of, anchors_of = _vectors(r.column("v")), _vectors(a.column("v"))
        n = len(r)
        bits = np.stack([np.frombuffer(x, "<u8") for x in r.column("bits").to_pylist()]).reshape(n, CODES, -1)
        numbers = np.stack([np.frombuffer(x, float) for x in r.column("numbers").to_pylist()])
        return r, a, rows_of, anchors_of, bits, numbers, rotation(rows_of.shape[1])

    def find_positives(table: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)] * 3
        if (sides := both(table)) is not None:
            r, a, rows_of, anchors_of, bits, numbers, turn = sides
            ids, own = r.column("id").to_numpy(), a.column("id").to_numpy()
            any_score = np.full((len(own), 1), np.inf)
            best = best_rows(anchors_of, rows_of, ids, bits, numbers, turn, lambda p, q: own[p, None] != ids[None, q], -any_score, any_score, n_positives)
            out = [own[best.slot], best.id, best.score]
        return pa.table(dict(zip(("anchor_id", "id", "score"), out, strict=True)))

    def find_negatives(table: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)] * 5
        if (sides := both(table)) is not None:
            r, a, rows_of, anchors_of, bits, numbers, turn = sides
            number = {}
            labels, own_labels = (np.array([number.setdefault(x, len(number)) for x in t.column("label").to_pylist()]) for t in (r, a))
            listed = a.column("positives").to_pylist()
            # an anchor with fewer positives has empty ranges in place of the others
            scores = np.full((len(listed), n_positives), np.iinfo(np.int64).min, np.int64)
            ids = np.zeros((len(listed), n_positives), np.int64)
            for i, positives in enumerate(listed):
                for m, p in enumerate(positives):
                    scores[i, m], ids[i, m] = p["score"], p["id"]
            real = scores != np.iinfo(np.int64).min
            known = np.where(real, scores, 0)
            least, most = np.where(real, -(-low * known // 100), 1), np.where(real, high * known // 100, 0)
            best = best_rows(anchors_of, rows_of, r.column("id").to_numpy(), bits, numbers, turn, lambda p, q: own_labels[p, None] != labels[None, q], least, most, n_negatives)
            at, m = np.divmod(best.slot, n_positives)
            out = [a.column("id").to_numpy()[at], ids[at, m], scores[at, m], best.id, best.score]
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"), out, strict=True)))

    none = F.lit(None).cast("array<struct<score:bigint,id:bigint>>")
    dealt = _dealt(rows, starts.withColumn("positives", none), ["label", "dim"], row_block, anchor_block)
    found = dealt.applyInArrow(find_positives, "anchor_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    positives = found.withColumn("rank", rank).filter(F.col("rank") <= n_positives)
    positives = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("score", F.col("id"))).alias("positives"))
    dealt = _dealt(rows, starts.join(positives, "id"), ["dim"], row_block, anchor_block)
    negatives = dealt.applyInArrow(find_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    best = negatives.withColumn("rank", rank).filter(F.col("rank") <= n_negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
