"""Near-duplicate embeddings by randomised-rotation binary codes.

Vectors are compared only with vectors of the same label and length. Equal vectors
form a class; one of each goes on, with the size of its class.

Every unit vector is rotated by one random orthogonal matrix and kept as its sign
code o (entries +-1/sqrt(D)) with the correction factor f = <v, o>. The vector it is compared with, q, is rotated too
and rounded at random to ``BITS`` bits a component, kept as bit planes, so that s = <q, o> comes from population
counts of ``plane AND code``, and s / f estimates <q, v> without bias over the rotations and roundings. The angles of q, v and o
obey the triangle inequality, and rounding moves s by at most |q - q'|; so a cosine of t or more needs an estimate of at least

    (cos(acos f + acos t) - |q - q'|) / f

for certain. Pairs with a lower estimate are skipped without loss; for a pair the limit is a number of bits, so that it is decided in integers. Only
the others, unless their interval misses the threshold, are computed exactly, in double precision.

A label's classes are dealt into blocks by hash, and each pair of blocks is one small
group: codes of one side against the planes of the other. A
group returns link counts per vector and a spanning forest, never its pairs. Blocks make a label of any size a
matter of many bounded tasks; the work on a label is quadratic in its distinct
vectors, as any exact comparison of all pairs is.

Null labels, null or empty or zero vectors, and vectors with a null or non-finite component link with
nothing. Rows that repeat an id: the id's links count for each of its vectors' rows separately,
as they are told apart by their content. A null id keeps its row, with a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import map_arrow, ship, written
from panewise.llm.components import components

THRESHOLD = 0.93
#: Distinct vectors of a block, about.
BLOCK = 1500
#: Bits of a component of the rounded side; codes compared in one array.
BITS, PIECE = 4, 64
#: Allows for rounding in single precision.
SLACK = 1e-4


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated unit vectors, packed, and the correction factors."""
    x = unit @ turn
    return np.packbits(x >= 0, axis=1), np.abs(x).sum(axis=1) / np.sqrt(unit.shape[1])


def _words(packed: np.ndarray) -> np.ndarray:
    """Rows of packed bits as 64-bit words, filled up with zeros."""
    out = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    out[..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


class Planes:
    """Rotated unit vectors, rounded at random to ``low + step * level`` and kept as the bit planes of their levels."""

    def __init__(self, query: np.ndarray):
        self.dim = query.shape[1]
        self.low = query.min(axis=1)
        span = query.max(axis=1) - self.low
        self.step = np.where(span > 1e-9, span / ((1 << BITS) - 1), 1.0)
        level = ((query - self.low[:, None]) / self.step[:, None] + np.random.default_rng(3).random(query.shape)).astype(np.int64)
        level = np.minimum(level, (1 << BITS) - 1)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.total, self.error = rounded.sum(axis=1), np.linalg.norm(query - rounded, axis=1)
        self.planes = [np.ascontiguousarray(_words(np.packbits((level >> p) & 1, axis=1)).T) for p in range(BITS)]

    def weighed(self, words: np.ndarray) -> np.ndarray:
        """For all (code, query) the sum of the query's levels at the ones of the code."""
        shape = len(words), len(self.low)
        out = np.zeros(shape, np.uint16 if self.dim << BITS < 1 << 16 else np.uint32)
        both, count = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
        for plane in reversed(self.planes):
            out <<= 1
            for w in range(words.shape[1]):
                np.bitwise_and(words[:, w, None], plane[w], out=both)
                out += np.bitwise_count(both, out=count)
        return out

    def products(self, weighed: np.ndarray, ones: np.ndarray, which=slice(None)) -> np.ndarray:
        """<q', o> from the weighed ones; ``which`` are the queries."""
        return (2 * (self.low[which] * ones + self.step[which] * weighed) - self.total[which]) / np.sqrt(self.dim)

    def limits(self, least: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """For all (code, query) the weighed ones that <q, o> >= least needs."""
        root = np.sqrt(self.dim)
        code = np.stack((least, np.ones(len(least)), ones), axis=1)
        query = np.stack((root / 2 / self.step, (self.total - root * self.error) / 2 / self.step, -self.low / self.step))
        return code.astype(np.float32) @ query.astype(np.float32)


def _upper(s: np.ndarray, error: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Certain upper bounds of <q, v> from s = <q', o>."""
    own = np.arccos(np.minimum(factor, 1))
    return np.cos(np.maximum(0, np.maximum(np.arccos(np.clip(s + error, -1, 1)) - own, own - np.arccos(np.clip(s - error, -1, 1)))))


def estimate(bits: np.ndarray, factor: np.ndarray, query: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of <query, v> and certain upper bounds; queries are rotated unit vectors."""
    planes, words = Planes(query), _words(bits)
    s = planes.products(planes.weighed(words), np.bitwise_count(words).sum(axis=1, dtype=np.int64)[:, None])
    return s / factor[:, None], _upper(s, planes.error, factor[:, None])


def close_pairs(left: np.ndarray, bits: np.ndarray, factor: np.ndarray, right: np.ndarray, turn: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with an exact cosine of at least ``threshold``; ``left`` are vectors, ``bits`` and ``factor`` their codes."""
    left, right = left.astype(float), right.astype(float)
    norm_l, norm_r = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    planes, words = Planes((right / norm_r[:, None]) @ turn), _words(bits)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    wanted = np.clip(threshold - SLACK, -1, 1)
    least = np.cos(np.minimum(np.arccos(np.minimum(factor, 1)) + np.arccos(wanted), np.pi)) - SLACK
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(left), PIECE):
        own = slice(start, start + PIECE)
        weighed = planes.weighed(words[own])
        i, j = np.divmod(np.flatnonzero(weighed >= planes.limits(least[own], ones[own])), len(right))
        for a in range(0, len(i), 100_000):
            p, q = i[a : a + 100_000], j[a : a + 100_000]
            s = planes.products(weighed[p, q], ones[own][p], q)
            open_ = _upper(s, planes.error[q], factor[own][p]) >= wanted
            p, q = p[open_] + start, q[open_]
            cosine = np.einsum("ij,ij->i", left[p], right[q]) / (norm_l[p] * norm_r[q])
            good = cosine >= threshold
            found.append((p[good], q[good]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) of the components of n nodes under the edges."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``."""
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0) & F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))") & F.expr("exists(v, x -> x <> 0)"), F.lit(False))
    rows = rows.withColumn("class", F.when(usable, F.xxhash64("label", "v"))).withColumn("more", F.when(usable, F.md5(F.concat_ws(",", F.col("label"), F.col("v").cast("string")))))
    rows = rows.select("id", "label", "v", "class", "more")
    classes = rows.filter("class IS NOT NULL").groupBy("class", "more").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = classes.withColumn("node", F.xxhash64("class", "more")).withColumn("dim", F.size("v"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            v = [np.array(x) for x in batch.column(4).to_pylist()]
            bits, factor = [], []
            for x in v:
                turn = turns.setdefault(len(x), None)
                if turn is None:
                    turn = turns[len(x)] = rotation(len(x))
                scaled = x / np.abs(x).max()
                c, f = codes((scaled / np.linalg.norm(scaled))[None], turn)
                bits.append(c[0].tobytes())
                factor.append(float(f[0]))
            yield pa.record_batch({"node": batch.column(0), "label": batch.column(1), "dim": batch.column(2), "copies": batch.column(3), "v": pa.array([x.tobytes() for x in v], pa.binary()), "bits": pa.array(bits, pa.binary()), "factor": pa.array(factor)})

    coded = map_arrow(classes.select("node", "label", "dim", "copies", "v"), encode, "node long, label string, dim int, copies long, v binary, bits binary, factor double")
    coded = written(coded, "codes")
    sizes = coded.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = coded.join(sizes, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("node", F.lit(11)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", "dim", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("first"), "node", "copies", "v", "bits", "factor")

    def compare(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        first = table.column("first").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        v = np.stack([np.frombuffer(x, float) for x in table.column("v").to_pylist()])
        # scale by the largest component, so that norms neither overflow nor vanish
        v = v / np.abs(v).max(axis=1, keepdims=True)
        a = np.flatnonzero(first)
        b = a if same else np.flatnonzero(~first)
        out_a, out_b, out_n = [], [], []
        if len(a) and len(b):
            bits = np.stack([np.frombuffer(x, np.uint8) for x in table.column("bits").take(pa.array(a)).to_pylist()])
            factor = table.column("factor").to_numpy()[a]
            i, j = close_pairs(v[a], bits, factor, v[b], rotation(dim), threshold)
            p, q = a[i], b[j]
            keep = p != q
            p, q = p[keep], q[keep]
            if same:  # either order decides alike: a pair counts once
                p, q = np.minimum(p, q), np.maximum(p, q)
                pairs = np.unique(p * len(node) + q)
                p, q = pairs // len(node), pairs % len(node)
            links = np.zeros(len(node), np.int64)
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            some = np.flatnonzero(links)
            child, root = forest(p, q, len(node))
            out_a = np.concatenate((node[some], node[child]))
            out_b = np.concatenate((node[some], node[root]))
            out_n = np.concatenate((links[some], np.zeros(len(child), np.int64)))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()), "n": pa.array(out_n, pa.int64())})

    found = written(dealt.groupBy("label", "dim", "low", "high").applyInArrow(compare, "a long, b long, n long"), "links")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    linked = components(found.filter("a <> b").select("a", "b")).withColumnRenamed("component", "root")
    member = classes.select("class", "more", "node", "rep", "copies").join(links, "node", "left").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    member = member.join(smallest, "root").select("class", "more", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "class", "more").join(member, ["class", "more"], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
