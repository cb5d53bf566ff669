"""Near-duplicate documents by an n-gram Jaccard self-join with adaptive multi-match prefixes.

Documents with the same shingle set form a class; only one document of a class goes on.

Order. Shingles are 64-bit hashes in the global order (commonness, hash). Commonness
comes from a fixed-size count sketch over all documents, so passages that many
documents share stand at the end of every prefix. A wrong estimate costs time, never a link.

Prefixes. A pair of n and m shingles with a Jaccard of at least t overlaps in at least
a = ceil(t / (1 + t) * (n + m)) of them, so the first n - a + l shingles of one and the first m - a + l of the
other share at least l, for every l. Each document takes the l from 1 to ``MAX_MATCH`` of the least
estimated cost: rows of the join, one for each document that a shingle of the prefix meets, and candidates left to
verify. Rare shingles meet at random, so l of them leave an l-th of the candidates; common ones come in
passages that are shared as a whole, so l thins them out only once it exceeds their number. A pair uses the smaller l of its two documents; every joined row must lie in that pair's
prefixes, l rows must meet, and what is left behind the last one must still suffice for the overlap.

Shingles that several prefixes hold are found first, from five bytes of each beyond its bucket; only these are kept, one row a class.
They are then dealt by shingle once for each step, which finds pivots, components and offers within a shingle by windows.

Groups of copies. Within the documents of one shared shingle each is first verified against
one pivot; components of these links stand for whole groups of near copies. Rounds with other pivots follow,
for the shingles whose documents still lie in several components: each shingle offers a few of its documents, the one
with the most widely shared prefix among them, and each document is verified against the few it shares most with. They end when few pairs are left or a round takes few
away, whatever the number of rounds. Then all
pairs whose documents lie in different components are joined (a pair inside
one component cannot change it), so no group of similar documents is expanded into all pairs.

Verification first compares bit strings: each document has as many bins as shingles, up to a power of two, and a bit for each
that holds an odd number of them. Every bin whose bits differ holds a shingle of one document alone, so pairs with
too many of those are no links. For the rest it compares the whole shingle sets. Results: ids that are null, and texts without
words, link with nothing; rows that repeat an id and a text get the same result.
Two different sets of the same 64-bit digest and size would be taken for one class (chance 2**-64 a pair).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panewise.llm.common import U64, as_signed, column_bytes, column_word_hashes, distinct, drop_written, give_back, id_filter, map_arrow, mix, window_hashes, word_hashes, written
from panewise.llm.components import components

WIDTH, PERCENT, MAX_MATCH = 5, 75, 8
#: Cells of the count sketch. Fixed, so that what is broadcast is; a larger corpus may take more.
SKETCH_LOG2 = 23
SLICES = 64
#: Cost of verifying a candidate, in rows of a prefix: so much for the pair, and so much for each shingle.
VERIFY_PAIR, VERIFY_SHINGLE = 60.0, 0.3
#: Pivots of a shingle and of a document in a round. Rounds go on while the pairs left are more than so many per row and fall below that part.
PIVOTS, FEW_PAIRS, PROGRESS = 4, 2, 0.5
#: Groups in which the shingles of all prefixes are counted, each by one task.
BUCKETS_LOG2 = 10
BUCKETS = 1 << BUCKETS_LOG2
#: Other documents that a shingle the sketch takes for rare is expected to meet.
RARE = 0.2


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Distinct hashes of all ``width``-word shingles, ascending; a shorter text is one shingle, no word none."""
    return _sets(word_hashes(text, lower=True), width)  # A-Z only; ASCII white space only


def _sets(h: np.ndarray, width: int) -> np.ndarray:
    if not len(h):
        return h
    width = min(width, len(h))
    return distinct(mix(window_hashes(h, width) + U64(width)))


def column_shingles(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """``shingles`` of every text of a string column."""
    for h, bounds in column_word_hashes(column, lower=True):
        every = mix(window_hashes(h, width) + U64(width))
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield distinct(every[start : end - width + 1]) if end - start >= width else _sets(h[start:end], width)


def set_digest(h: np.ndarray) -> int:
    """64-bit digest of a set, whatever the order of its members."""
    with np.errstate(over="ignore"):
        return int((mix(mix(h ^ U64(0xA0761D6478BD642F)).sum(keepdims=True) + U64(len(h)))).view(np.int64)[0])


def parities(h: np.ndarray) -> bytes:
    """A bit for each of a power of two of bins, at least as many as there are members: whether it holds an odd number of them."""
    size = max(64, 1 << (len(h) - 1).bit_length())
    return np.packbits(np.bincount((h & U64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """Members that are in one set only: at least the bins whose parities differ. The longer ``parities`` are folded."""
    a, b = (np.frombuffer(p, np.uint64) for p in (x, y))
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def cells(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - SKETCH_LOG2)).astype(np.int64)


def _survey(docs: DataFrame, width: int) -> DataFrame:
    """One pass: a row (id, n, class, bits) per document, then each task's part of the sketch as rows (slice, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        counts, held, size = np.zeros(1 << SKETCH_LOG2, np.uint16), [], 0

        def count() -> None:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            counts[at] = np.minimum(counts[at] + n, 65535)  # a task's part saturates; sums do not
            held.clear()

        for batch in batches:
            n, cls, bits = [], [], []
            for h in column_shingles(batch.column(1), width):
                n.append(len(h))
                cls.append(set_digest(h) if len(h) else None)
                bits.append(parities(h) if len(h) else None)
                if len(h):
                    held.append(cells(h))
                    size += len(h)
                    if size > 250_000:
                        count()
                        size = 0
            none = pa.nulls(len(n))
            yield pa.record_batch({"id": batch.column(0), "n": pa.array(n, pa.int64()), "class": pa.array(cls, pa.int64()), "bits": pa.array(bits, pa.binary()), "slice": none.cast(pa.int32()), "counts": none.cast(pa.binary())})
        if held:
            count()
        rows = [(i, packed_counts(part)) for i, part in enumerate(counts.reshape(SLICES, -1)) if part.any()]
        none = pa.nulls(len(rows), pa.int64())
        yield pa.record_batch({"id": none, "n": none, "class": none, "bits": pa.nulls(len(rows), pa.binary()), "slice": pa.array([r[0] for r in rows], pa.int32()), "counts": pa.array([r[1] for r in rows], pa.binary())})

    return map_arrow(docs, run, "id long, n long, class long, bits binary, slice int, counts binary")


def _sketch(survey: DataFrame) -> np.ndarray:
    """Sum of all tasks' sketches; the driver receives its fixed 2**SKETCH_LOG2 cells."""
    width = (1 << SKETCH_LOG2) // SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = total.setdefault(i, np.zeros(width, np.float32))
                own += unpacked_counts(raw.as_buffer())
        yield pa.record_batch({"slice": pa.array(list(total), pa.int32()), "counts": pa.array([_packed(x) for x in total.values()], pa.binary())})

    parts = survey.filter("slice IS NOT NULL").select("slice", "counts")
    rows = map_arrow(parts.repartition(SLICES // 4, "slice"), add, "slice int, counts binary").collect()
    out = np.zeros((SLICES, width), np.float32)
    for r in rows:
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.float16)
    return out.ravel()


def packed_counts(counts: np.ndarray) -> bytes:
    """A task's counts, their low bytes before their high ones, which are nearly all zero."""
    return zlib.compress(counts.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def unpacked_counts(raw: bytes) -> np.ndarray:
    low, high = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(2, -1).astype(np.uint16)
    return low | high << 8


def _packed(counts: np.ndarray) -> bytes:
    """Counts for the driver: half precision is plenty for an order."""
    return zlib.compress(np.minimum(counts, 60_000).astype(np.float16).tobytes(), 1)


class Prefixes:
    """The order, the prefix and the number of matches of each document."""

    def __init__(self, sketch: np.ndarray, percent: int):
        load = float(sketch.mean(dtype=np.float64))
        noise = load + 3 * math.sqrt(load) + 3  # what other shingles of its cell may add to a rare one
        self.level = np.empty(len(sketch), np.uint8)  # 0: rare
        for i in range(0, len(sketch), 1 << 17):  # a slice at a time: the driver holds no copies of the sketch
            part = sketch[i : i + (1 << 17)]
            self.level[i : i + len(part)] = np.minimum(np.ceil(np.log2(1.0 + np.where(part > noise, part - load, 0.0))), 30)
        self.percent = percent

    def centre(self, token: np.ndarray) -> int:
        """How much of a prefix others share: 1000 times the mean level of its shingles."""
        return int(1000 * self.level[cells(token)].mean()) if len(token) else 0

    def of(self, h: np.ndarray) -> tuple[np.ndarray, int]:
        """The longest prefix any pair may ask for, in order, and the document's l."""
        n = len(h)
        least = -(-self.percent * n // 100)
        level = self.level[cells(h)]
        most = min(MAX_MATCH, least)
        size = n - least + most
        hot = level.any()
        order = np.lexsort((h, level))[:size] if hot else np.arange(size)  # h ascends already
        need = 1
        if hot:
            base = n - least
            seen = np.exp2(level[order].astype(float))
        else:
            base, seen = n - least, np.ones(size)
        rare = seen == 1
        rows = np.cumsum(np.where(rare, RARE, seen))  # documents that the prefix meets, one row of the join each
        n_rare = np.cumsum(rare)
        last, best = base + np.arange(1, most + 1) - 1, math.inf
        for m, at in enumerate(last.tolist(), 1):
            common = seen[at] if at + 1 - n_rare[at] >= m else 0.0  # a passage is shared as a whole: m of its shingles filter nothing
            cost = m + rows[at] + (VERIFY_PAIR + VERIFY_SHINGLE * n) * (RARE * n_rare[at] / m + common)
            if cost < best:
                need, best = m, cost
        return h[order[: n - least + need]], need


def overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """Shingles a pair of n and m must share."""
    return F.ceil((n + m) * percent / F.lit(100 + percent)).cast("int")


def _in_prefixes(x: str, y: str, percent: int) -> Column:
    """Whether a shared shingle lies in the prefixes of its pair: places count from 0."""
    least = overlap_needed(F.col(f"{x}n"), F.col(f"{y}n"), percent)
    need = F.least(f"{x}need", f"{y}need")
    return (F.col(f"{x}place") < F.col(f"{x}n") - least + need) & (F.col(f"{y}place") < F.col(f"{y}n") - least + need)


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, met) of joined rows (x_..., y_...): pairs that share l shingles and have enough left behind the last of them."""
    rows = rows.filter(F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent).filter(_in_prefixes("x_", "y_", percent))
    first = F.col("x_class") < F.col("y_class")
    side = {c: (F.when(first, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")), F.when(first, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}"))) for c in ("class", "n", "place")}
    met = rows.groupBy(side["class"][0].alias("a"), side["class"][1].alias("b")).agg(
        F.count("*").alias("met"), F.first(F.least("x_need", "y_need")).alias("need"),
        F.first(side["n"][0]).alias("n"), F.first(side["n"][1]).alias("m"), F.max(side["place"][0]).alias("i"), F.max(side["place"][1]).alias("j"),
    )
    least = overlap_needed(F.col("n"), F.col("m"), percent)
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1
    return met.filter((F.col("met") >= F.least("need", least)) & (F.col("met") + left >= least)).select("a", "b", "met")


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, prefixes: Prefixes, reps) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(shingles, prefix, need) of every document with words that ``reps`` lets through."""
    give_back()
    for batch in batches:
        ids = batch.column(0)
        ok = np.zeros(len(ids), bool)
        known = np.flatnonzero(np.asarray(ids.is_valid()))
        ok[known] = reps.has(ids.drop_null().to_numpy())
        for h in column_shingles(batch.column(1).filter(pa.array(ok)), width):
            if len(h):
                yield (h, *prefixes.of(h))


def trimmed(token: np.ndarray) -> np.ndarray:
    """The upper bits of shingles, for which five bytes in each of ``BUCKETS`` are enough."""
    return token >> U64(64 - BUCKETS_LOG2 - 40)


def packed_tokens(token: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Trimmed shingles as (buckets, five bytes for each shingle of a bucket); what comes more than once is kept twice."""
    token, k = np.unique(token, return_counts=True)
    token = np.repeat(token, np.minimum(k, 2))
    raw = token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    bucket, start = np.unique(token >> U64(40), return_index=True)
    ends = [*start[1:].tolist(), len(token)]
    return bucket.astype(np.int32), [raw[5 * i : 5 * j] for i, j in zip(start.tolist(), ends, strict=True)]


def repeated_tokens(bucket: int, packed: list[bytes]) -> np.ndarray:
    """The trimmed shingles of a bucket that come more than once, ascending."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 5)
    token = np.zeros((len(raw), 8), np.uint8)
    token[:, :5] = raw
    token = np.sort(token.view("<u8").ravel()) + (U64(bucket) << U64(40))
    return distinct(token[1:][token[1:] == token[:-1]])


def _shared_tokens(docs: DataFrame, width: int, shared, representatives) -> DataFrame:
    """(token): trimmed shingles that the prefixes of several documents hold, and by chance a few more."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, token, _ in _prefixes(batches, width, shared.value, representatives.value):
            held.append(trimmed(token))
            size += len(token)
            if size > 250_000:
                yield _packed_rows(held)
                held, size = [], 0
        if held:
            yield _packed_rows(held)

    def _packed_rows(held) -> pa.RecordBatch:
        bucket, packed = packed_tokens(np.concatenate(held))
        return pa.record_batch({"bucket": pa.array(bucket), "packed": pa.array(packed, pa.binary())})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1)), strict=True):
                if bucket != last and held:
                    yield pa.record_batch({"token": as_signed(repeated_tokens(last, held))})
                    held = []
                last = bucket
                held.append(raw)
        if held:
            yield pa.record_batch({"token": as_signed(repeated_tokens(last, held))})

    sent = map_arrow(docs, send, "bucket int, packed binary")
    return map_arrow(sent.repartition("bucket").sortWithinPartitions("bucket"), meet, "token long")


def _class_prefixes(docs: DataFrame, width: int, shared, representatives, tokens) -> DataFrame:
    """A row (class, n, need, centre, token, place) of each document that ``representatives`` lets through: the shingles of its prefix that ``tokens`` holds, and their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, wanted = shared.value, tokens.value
        held, rows = 0, []
        for h, token, need in _prefixes(batches, width, prefixes, representatives.value):
            place = np.flatnonzero(wanted.has(trimmed(token).view(np.int64))).astype(np.int32)
            if not len(place):
                continue
            rows.append((set_digest(h), len(h), need, prefixes.centre(token), token[place], place))
            held += len(place)
            if held > 200_000:
                yield _rows(rows)
                held, rows = 0, []
        if rows:
            yield _rows(rows)

    def _rows(rows) -> pa.RecordBatch:
        cls, n, need, centre, token, place = zip(*rows, strict=True)
        ends = pa.array(np.cumsum([0, *map(len, place)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, x) for x in (as_signed(np.concatenate(token)), pa.array(np.concatenate(place)))]
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), *(pa.array(x, pa.int32()) for x in (n, need, centre)), *lists], names=["class", "n", "need", "centre", "token", "place"])

    return map_arrow(docs, run, "class long, n int, need int, centre int, token array<long>, place array<int>")


def _by_token(rows: DataFrame, *more: str) -> DataFrame:
    """One row for each shingle of ``rows`` of classes, without repeats, dealt by shingle: what looks at one shingle alone moves nothing again."""
    flat = rows.select("class", "n", "need", *more, F.inline(F.arrays_zip("token", "place")))
    return flat.select("token", *FIELDS, *more).repartition("token").distinct()


def _by_class(known: DataFrame) -> DataFrame:
    """The rows of ``_open_rows`` as one row a class again, in the form of ``_class_prefixes``: what is looked up for a class is looked up once.

    As many parts as any shuffle has, however few bytes: each row becomes one for each shingle afterwards.
    """
    own = [F.first(c).alias(c) for c in ("n", "need", "centre")]
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = known.select("class", "n", "need", "centre", "token", "place").repartition(parts, "class").groupBy("class").agg(*own, F.collect_list(F.struct("token", "place")).alias("held"))  # one document's prefix
    return packed.select("class", "n", "need", "centre", F.col("held.token").alias("token"), F.col("held.place").alias("place"))


def _texts(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(class, text) of the documents that the one column of ``ids`` names, once a class."""
    held = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            ok = np.asarray(batch.column(0).is_valid())
            ok[ok] = held.value.has(batch.column(0).drop_null().to_numpy())
            text = batch.column(1).filter(pa.array(ok))
            yield pa.record_batch({"class": pa.array([set_digest(h) if len(h) else None for h in column_shingles(text, width)], pa.int64()), "text": text})

    # by class, since an id may have several texts
    return map_arrow(docs, texts, "class long, text string").dropDuplicates(["class"])


def _close_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes, with their documents, that may still reach the threshold: their ``bits`` differ in no more places than it allows.

    A necessary condition, so no link is lost; it spares the texts of pairs that share a passage only.
    """
    # both sides name the same columns anew, so that Spark deals the classes once
    rows = pairs.select("a", "b").join(classes.select(F.col("class").alias("b"), F.col("rep").alias("id_b"), F.col("n").alias("m"), F.col("bits").alias("y")), "b")
    rows = rows.join(classes.select(F.col("class").alias("a"), F.col("rep").alias("id_a"), F.col("n").alias("l"), F.col("bits").alias("x")), "a")
    rows = rows.select("a", "b", "id_a", "id_b", (F.col("l") + F.col("m") - 2 * overlap_needed(F.col("l"), F.col("m"), percent)).alias("most"), "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [least_difference(x, y) <= most for most, x, y in zip(batch.column(4).to_pylist(), column_bytes(batch.column(5)), column_bytes(batch.column(6)), strict=True)]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(good, pa.bool_()))

    return map_arrow(rows, compare, "a long, b long, id_a long, id_b long")


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold. Texts are fetched only for those that their bits leave open."""
    close = written(_close_pairs(pairs, classes, percent), "pairs")
    texts = _texts(docs, close.select(F.explode(F.array("id_a", "id_b"))), width)
    return written(verified(close, texts, width, percent), "links")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole shingle sets reach the threshold; ``texts`` has a text of each class."""
    rows = pairs.select("a", "b").join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b")
    rows = rows.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, h = None, np.empty(0, U64)
        for batch in batches:
            good = []
            for ta, tb in zip(column_bytes(batch.column(2)), column_bytes(batch.column(3)), strict=True):
                if ta != last:
                    last, h = ta, shingles(ta, width)
                g = shingles(tb, width)
                common = int((g[np.minimum(np.searchsorted(g, h), len(g) - 1)] == h).sum()) if len(g) and len(h) else 0
                good.append(common > 0 and 100 * common >= percent * (len(g) + len(h) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return map_arrow(rows, compare, "a long, b long")


FIELDS = ("class", "n", "place", "need")


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of one class each, with its component."""
    labels = components(links).withColumnRenamed("node", "class")
    return rows.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))


def _open_rows(rows: DataFrame) -> DataFrame:
    """Rows, dealt by shingle, of the shingles whose documents lie in several components, with the shingle's ``largest`` and how many it ``met``."""
    every = Window.partitionBy("token")
    rows = rows.withColumn("k", F.count("*").over(Window.partitionBy("token", "component")))
    rows = rows.select("*", F.max(F.struct("k", "component")).over(every)["component"].alias("largest"), F.count("*").over(every).alias("met"), F.max("k").over(every).alias("most"))
    return written(rows.filter("most < met").drop("k", "most"), "known")


def _pivot_pairs(known: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components to verify: for each document the ``PIVOTS`` with which it shares most.

    Each shingle offers ``PIVOTS`` of its documents, others every turn: one whose prefix is most widely shared, since the
    copies of a text differ least from one with few changes of its own, and others by chance. Their pairs need not pass the prefix filters: every
    document brings at most ``PIVOTS`` of them, and what is not found here is left to the exact join.
    """
    one, every = F.struct("class", "n", "component"), Window.partitionBy("token")
    offered = [F.min_by(one, F.xxhash64("class", F.lit(PIVOTS * turn + i))).over(every) for i in range(PIVOTS - 1)]
    central = F.when(F.pmod(F.xxhash64("class"), F.lit(turn)) == 0, F.col("centre")).otherwise(-1)  # the first turn all, then ever fewer
    offered.append(F.max_by(one, F.struct(central, F.xxhash64("class", F.lit(turn)))).over(every))
    fits = lambda p: (F.col("component") != p["component"]) & (F.least("n", p["n"]) * 100 >= F.greatest("n", p["n"]) * percent)
    met = known.select("token", "class", "n", "component", "centre").repartition("token")  # before the offers are formed, which are wider
    met = met.select("class", "n", "component", F.array_distinct(F.array(*offered)).alias("p"))
    met = met.select("class", F.explode(F.filter("p", fits)["class"]).alias("pivot")).groupBy("class", "pivot").agg(F.count("*").alias("met"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("met"), F.xxhash64("pivot", F.lit(turn))))
    best = met.withColumn("rank", rank).filter(F.col("rank") <= PIVOTS)
    return best.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row: component_id is the smallest id reachable by links.

    ``id`` keeps the name ``id_col``. Rows whose id is null have a null component. If rows with
    the same id hold different texts, all their links count for that id.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # shuffle files of a step go with it, not when the driver happens to collect garbage
    try:
        return _near_duplicates(df, id_col, text_col, width, percent)
    finally:
        spark.conf.set(CLEANUP, before)


def _near_duplicates(df: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    survey = written(_survey(docs, width), "survey")
    prints = survey.filter("slice IS NULL").select("id", "n", "class", "bits")
    classes = written(prints.filter("class IS NOT NULL AND id IS NOT NULL").groupBy("class").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")
    # a document is searched under the class it represents; one id with several texts takes part with each
    send = spark.sparkContext.broadcast
    shared = send(Prefixes(_sketch(survey), percent))
    # the more representatives, the longer their filter, up to 16 MiB: a copy that slips through makes its shingles look shared
    reps = send(id_filter(classes.select("rep"), min(27, max(23, (8 * classes.count()).bit_length()))))
    tokens = send(id_filter(_shared_tokens(docs, width, shared, reps), 25))
    prefixes = written(_class_prefixes(docs, width, shared, reps, tokens), "prefixes")

    # 1. every document against the pivot it shares most shingles with
    star = _by_token(prefixes).withColumn("p", F.min(F.struct(*FIELDS)).over(Window.partitionBy("token"))).filter("class <> p.class")
    star = star.select(*[F.col(c).alias(f"x_{c}") for c in FIELDS], *[F.col(f"p.{c}").alias(f"y_{c}") for c in FIELDS])
    star = _candidates(star, percent)  # b is never the pivot of its row: a pivot is the smallest class
    star = star.groupBy("b").agg(F.max_by("a", F.struct("met", "a")).alias("a"))
    links = _links(star, docs, classes, width, percent)
    known = _open_rows(_by_token(_labelled(prefixes, links), "centre", "component"))
    drop_written(prefixes)

    # 2. other pivots, until few pairs are left or few documents find a link
    turn, before = 0, math.inf
    while True:
        size = known.agg(F.count("*").alias("rows"), F.sum(F.when(F.col("component") != F.col("largest"), F.col("met")).otherwise(0)).alias("pairs")).first()
        if not size["rows"] or size["pairs"] <= FEW_PAIRS * size["rows"] or size["pairs"] > PROGRESS * before:
            break
        turn, before = turn + 1, size["pairs"]
        links = links.union(_links(_pivot_pairs(known, turn, percent), docs, classes, width, percent))
        last, known = known, _open_rows(_by_token(_labelled(_by_class(known), links), "centre", "component"))
        drop_written(last)

    # 3. all pairs that could still join two components
    x = known.filter("component <> largest").select("token", *[F.col(c).alias(f"x_{c}") for c in (*FIELDS, "component")])
    y = known.select("token", "largest", *[F.col(c).alias(f"y_{c}") for c in (*FIELDS, "component")])
    pairs = x.join(y, "token").filter("x_component <> y_component AND (y_component = largest OR x_class < y_class)")
    pairs = _candidates(pairs, percent).select("a", "b")
    links = links.union(_links(pairs, docs, classes, width, percent))
    same = prints.filter("class IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b").select("a", "b")
    linked = components(links.union(same))
    member = classes.join(linked.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = member.join(smallest, "component").select("class", "component_id")
    return prints.join(final, "class", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
