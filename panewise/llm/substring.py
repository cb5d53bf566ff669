"""Removal of repeated word sequences with compressed FM-indexes.

A document loses every word covered by a window of ``WINDOW`` words that also starts
in a document with a smaller id. Windows are judged on the input.

1. Documents with equal texts form a class; a copy (not the smallest id) loses all its
   words at once if it has a window, and takes no further part.
2. Every window has an anchor: the ``ANCHOR`` consecutive words in it with the
   smallest hash (the leftmost of equal ones). Equal windows have equal anchors, so consecutive windows
   with one anchor travel together, as a segment of words, to the shard of that anchor. Anchors
   that occur in one document only are dropped before any text is moved.
3. In a shard, equal segments become one with their smallest document. The distinct
   segments are concatenated, and an FM-index is built over them: the BWT from suffixes sorted by
   their first words, symbol counts, and rank over a wavelet matrix of bit vectors. The suffixes themselves are
   not kept: what the search needs of them, their documents, stays as numbers of few bytes with range minima.
   The words of all segments then stream backwards through the index: backward search gives
   a window's matching statistic (how many words from its end back still occur elsewhere).
   Where it reaches the window, the smallest document of the suffix interval decides; where it falls short, that
   many words and the one before occur nowhere else, and neither does any later window that holds them, so those are skipped.
   A shard takes whole anchors up to ``SHARD_WORDS``.
4. An anchor whose segments have more words than that (common words in many contexts) goes to no shard: the
   whole windows of its distinct segments are the keys, and Spark aggregates their smallest documents.

Words are compared by 64-bit hashes, relabelled to dense symbols in a shard, windows of step 4 by 128 bits of them.
A null id counts as larger than all others. Null texts have no words. Rows with one id do not take
from each other: each loses only what documents with smaller ids have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import U64, column_bytes, distinct, id_filter, map_arrow, mix, window_hashes, word_hashes, written

WINDOW, ANCHOR = 13, 4
#: Low bits of an anchor's hash that hold its place while the smallest is sought.
PLACE = U64((1 << 20) - 1)
#: Words of one FM-index.
SHARD_WORDS = 400_000


# ------------------------------------------------------------------ index


class BitRank:
    """A bit vector with rank: packed 64-bit words and the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1])).astype(np.int32)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        at = i >> 6
        return self.before[at] + np.bitwise_count(self.words[at] & ((U64(1) << (i & 63).astype(U64)) - U64(1))).astype(np.int64)


class WaveletMatrix:
    """Rank of any symbol of a sequence, one bit vector per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((symbols >> shift) & 1).astype(np.uint8)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((shift, BitRank(bits), zeros))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))
        # after the last level equal symbols stand together, in the order of their reversed bits
        codes, reversed_ = np.arange(n_symbols), np.zeros(n_symbols, np.int64)
        for k, (shift, _, _) in enumerate(self.levels):
            reversed_ |= ((codes >> shift) & 1) << k
        order = np.argsort(reversed_, kind="stable")
        counts = np.bincount(symbols, minlength=n_symbols)
        self.first = np.empty(n_symbols, np.int64)
        self.first[order] = np.concatenate(([0], np.cumsum(counts[order])[:-1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank1(i)
            i = np.where((symbol >> shift) & 1, zeros + ones, i - ones)
        return i - self.first[symbol]


class RangeMinimum:
    """Smallest value of ranges: values as numbers of as few bytes as they need, and a sparse table over the minima of blocks of 64."""

    def __init__(self, values: np.ndarray):
        self.names, rank = np.unique(values, return_inverse=True)
        self.rank = rank.astype(np.min_scalar_type(len(self.names)))
        padded = np.full(-(-len(rank) // 64) * 64, len(self.names), self.rank.dtype)
        padded[: len(rank)] = self.rank
        self.table = [padded.reshape(-1, 64).min(axis=1)]
        while 2 << len(self.table) - 1 <= len(self.table[0]):
            half = 1 << len(self.table) - 1
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest value of each range [low, high), none of them empty."""
        out = self.rank[low]
        first, last = -(-low // 64), high // 64
        size = np.maximum(last - first, 0)  # whole blocks inside
        for k, table in enumerate(self.table):
            some = np.flatnonzero(size >> k == 1)
            out[some] = np.minimum(out[some], np.minimum(table[first[some]], table[last[some] - (1 << k)]))
        whole = size > 0
        self._scan(out, np.arange(len(low)), low, np.where(whole, first * 64, high))
        some = np.flatnonzero(whole)
        self._scan(out, some, last[some] * 64, high[some])
        return self.names[out]

    def _scan(self, out: np.ndarray, which: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
        """Takes in the values of ranges of fewer than 128, one place of all of them at a time."""
        while True:
            go = at < to
            if not go.any():
                return
            which, at, to = which[go], at[go], to[go]
            out[which] = np.minimum(out[which], self.rank[at])
            at = at + 1


class FmIndex:
    """FM-index over concatenated segments, each followed by the separator 0; suffixes are sorted by their first ``depth`` symbols.

    Patterns must be shorter than ``depth`` and hold no separator. ``owners`` gives a value for each
    place of the text; ``smallest`` then finds the smallest one of a suffix interval. The suffixes are not kept.
    """

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int, owners: np.ndarray | None = None):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while step < depth:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * (n + n_symbols + 2) + after
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            fresh = np.empty(n, np.int64)
            fresh[order] = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1])))
            rank, step = fresh, step * 2
        self.owners = None if owners is None else RangeMinimum(owners[order])
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        self.bwt = WaveletMatrix(text[order - 1], n_symbols)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for many patterns: the interval of symbol + pattern."""
        both = self.bwt.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        first = self.counts[symbol]
        return first + both[: len(symbol)], first + both[len(symbol) :]

    def search(self, words: np.ndarray, ends: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search from every position of ``ends`` (last word of a window) over ``width`` words.

        Stops a pattern whose interval has fewer than ``least`` suffixes. Returns its matching
        statistic, capped at ``width``, and the interval of the windows that reach it.
        """
        match = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        s = words[ends]
        lo, hi = self.counts[s], self.counts[s + 1]
        for step in range(width):
            if step:
                lo, hi = self.extend(words[ends[live] - step], lo, hi)
            go = hi - lo >= least
            live, lo, hi = live[go], lo[go], hi[go]
            match[live] = step + 1
            if not len(live):
                break
        if len(live):
            low[live], high[live] = lo, hi
        return match, low, high

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest owner of each suffix interval."""
        return self.owners.smallest(low, high)

    def shared(self, words: np.ndarray, ends: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(place in ``ends``, low, high) of the windows that occur ``least`` times or more, and how many were searched; ``ends`` rise.

        In each round one window of ``width`` in a row is searched. If its statistic m falls short, the m + 1 words before its end are
        too rare, and so is every window that holds them: those that end up to ``width - 1 - m`` words later are left out.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        todo, searched = np.arange(len(ends)), 0
        while len(todo):
            e = ends[todo]
            begin = np.maximum.accumulate(np.where(np.concatenate(([True], e[1:] != e[:-1] + 1)), np.arange(len(e)), 0))
            probe = (np.arange(len(e)) - begin) % width == 0
            at = e[probe]
            searched += len(at)
            match, low, high = self.search(words, at, width, least)
            hit = match == width
            found.append((todo[probe][hit], low[hit], high[hit]))
            edge = np.zeros(len(words) + width + 1, np.int64)
            edge[at[~hit]] += 1
            np.subtract.at(edge, at[~hit] + width - match[~hit], 1)
            todo = todo[~probe & (np.cumsum(edge)[e] == 0)]
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none, 0
        return *(np.concatenate(x) for x in zip(*found, strict=True)), searched


def smallest_documents(segments: list[np.ndarray], docs: np.ndarray, width: int, shard_words: int = SHARD_WORDS) -> list[np.ndarray]:
    """For every window of every segment the smallest document that has it; ``docs`` is the smallest document of each segment."""
    sizes = np.array([len(s) + 1 for s in segments])
    flat = np.zeros(int(sizes.sum()), U64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    mask = np.ones(len(flat), bool)
    mask[starts + sizes - 1] = False
    flat[mask] = np.concatenate(segments)
    _, dense = np.unique(flat[mask], return_inverse=True)
    words = np.zeros(len(flat), np.int64)
    words[mask] = dense + 1
    owner = np.repeat(np.arange(len(segments)), sizes)
    windows = [np.arange(a + width - 1, a + z - 1) for a, z in zip(starts, sizes, strict=True)]
    ends = np.concatenate(windows)
    best = docs[owner[ends]].copy()
    # parts of whole segments, each with its own index; normally there is one
    part = (np.cumsum(sizes) - sizes) // max(shard_words, int(sizes.max()))
    single = part[-1] == 0
    for p in range(int(part[-1]) + 1):
        inside = part[owner] == p
        index = FmIndex(words[inside], int(words.max()) + 1, width + 1, docs[owner[inside]])
        # in its own index every window occurs at least once
        found, low, high, _ = index.shared(words, ends, width, 2 if single else 1)
        pairs, first, back = np.unique(low, return_index=True, return_inverse=True)
        best[found] = np.minimum(best[found], index.smallest(pairs, high[first])[back])
    cuts = np.cumsum([len(w) for w in windows])[:-1]
    return np.split(best, cuts)


# ------------------------------------------------------------------ segments


def anchors(h: np.ndarray, width: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of every run of consecutive windows with one anchor."""
    grams = window_hashes(h, anchor)
    n = len(h) - width + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return np.empty(0, U64), none, none
    # the low bits of a hash give way to the place, so that one minimum finds both; the leftmost of equals wins
    tagged = (grams & ~PLACE) | (np.arange(len(grams), dtype=U64) & PLACE)
    span, reach, low = width - anchor + 1, 1, tagged
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[:n], low[span - reach : span - reach + n])
    first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    last = np.append(first[1:], n) - 1
    return low[first] & ~PLACE, first, last


NO_ID = np.iinfo(np.int64).max


def _survey(docs: DataFrame) -> DataFrame:
    """(id, tag, digest of the words, n_words) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, n = [], []
            for text in column_bytes(batch.column(1)):
                words = (text or b"").split()
                n.append(len(words))
                digest.append(hashlib.sha256(b" ".join(words)).digest()[:16])
            yield pa.record_batch({"id": batch.column(0), "tag": batch.column(2), "digest": pa.array(digest, pa.binary()), "n_words": pa.array(n, pa.int64())})

    return map_arrow(docs, run, "id long, tag long, digest binary, n_words long")


def _segments(docs: DataFrame, first_of_class, width: int, wanted=None) -> DataFrame:
    """Without ``wanted`` rows (anchor, doc); with it (anchor, doc, tag, first, seg, words) of the anchors it lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            ok = first_of_class.value.has(ids.to_numpy())
            out: list[tuple] = []
            held = 0
            for keep, one, tag, text in zip(ok, ids.to_pylist(), batch.column(2).to_pylist(), column_bytes(batch.column(1)), strict=True):
                if not keep or not text:
                    continue
                h = word_hashes(text)
                anchor, first, last = anchors(h, width)
                if wanted is None:
                    if len(anchor):
                        out.append((distinct(anchor), one))
                        held += len(anchor)
                else:
                    hit = np.flatnonzero(wanted.value.has(anchor.view(np.int64)))
                    for k in hit:
                        piece = h[first[k] : last[k] + width]
                        raw = piece.tobytes()
                        seg = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
                        out.append((int(anchor[k].view(np.int64)), one, tag, int(first[k]), seg, raw))
                        held += len(piece)
                if held > 300_000:
                    yield pack(out)
                    out, held = [], 0
            yield pack(out)

    if wanted is None:

        def pack(out) -> pa.RecordBatch:
            a = np.concatenate([x[0] for x in out]).view(np.int64) if out else np.empty(0, np.int64)
            d = np.concatenate([np.full(len(x[0]), x[1], np.int64) for x in out]) if out else np.empty(0, np.int64)
            return pa.record_batch({"anchor": pa.array(a), "doc": pa.array(d)})

        return map_arrow(docs, run, "anchor long, doc long")

    names = (("anchor", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int32()), ("seg", pa.int64()), ("words", pa.binary()))

    def pack(out) -> pa.RecordBatch:
        return pa.record_batch({name: pa.array([x[i] for x in out], kind) for i, (name, kind) in enumerate(names)})

    return map_arrow(docs, run, "anchor long, doc long, tag long, first int, seg long, words binary")


def _heavy(occur: DataFrame, shard_words: int) -> DataFrame:
    """Anchors with more than ``shard_words`` words in all their segments, copies counted: at most one for as many words."""
    return occur.groupBy("anchor").agg(F.sum(F.length("words") / 8 + 1).alias("n")).filter(F.col("n") > shard_words).select("anchor")


def _distinct(occur: DataFrame) -> DataFrame:
    return occur.groupBy("seg").agg(F.first("anchor").alias("anchor"), F.first("words").alias("words"), F.min("doc").alias("doc"))


def _decide_windows(segments: DataFrame, width: int) -> DataFrame:
    """As ``_decide``, with whole windows as keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                words = [np.frombuffer(raw, U64) for raw in part.column(1).to_pylist()]
                sizes = np.array([len(w) - width + 1 for w in words])
                a, b = (np.concatenate([window_hashes(f(w), width) for w in words]).view(np.int64) for f in (np.asarray, mix))
                place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                seg, doc = (np.repeat(part.column(i).to_numpy(), sizes) for i in (0, 2))
                yield pa.record_batch({"seg": pa.array(seg), "place": pa.array(place.astype(np.int32)), "a": pa.array(a), "b": pa.array(b), "doc": pa.array(doc)})

    windows = written(map_arrow(segments.select("seg", "words", "doc"), run, "seg long, place int, a long, b long, doc long"), "heavy-windows")
    best = windows.groupBy("a", "b").agg(F.min("doc").alias("best"))
    rows = windows.join(best, ["a", "b"]).groupBy("seg").agg(F.sort_array(F.collect_list(F.struct("place", "best"))).alias("rows"))  # one segment's windows
    return rows.select("seg", F.col("rows.best").alias("smallest"))


def _decide(segments: DataFrame, width: int, shard_words: int) -> DataFrame:
    """(seg, smallest): the smallest document of each window of the distinct segments of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, np.ndarray, int]] = []
        held, anchor = 0, None

        def flush() -> pa.RecordBatch:
            best = smallest_documents([g[1] for g in group], np.array([g[2] for g in group], np.int64), width, shard_words)
            return pa.record_batch({"seg": pa.array([g[0] for g in group], pa.int64()), "smallest": pa.array([b for b in best], pa.list_(pa.int64()))})

        for batch in batches:
            for a, seg, raw, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and held >= shard_words and a != anchor:
                    yield flush()
                    group, held = [], 0
                anchor = a
                group.append((seg, np.frombuffer(raw, U64), doc))
                held += len(raw) // 8 + 1
        if group:
            yield flush()

    rows = segments.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "seg", "words", "doc")
    return map_arrow(rows, run, "seg long, smallest array<bigint>")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, shard_words: int = SHARD_WORDS, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, [kept]) for every row; ``kept`` is the remaining words joined by one space."""
    spark = df.sparkSession
    send = spark.sparkContext.broadcast
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("tag", F.xxhash64("text"))  # tells rows with one id apart
    survey = written(_survey(docs), "survey")
    classes = survey.groupBy("digest").agg(F.min("id").alias("rep"))
    is_rep = send(id_filter(classes.select("rep")))

    shared = _segments(docs, is_rep, width).groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low <> high").select("anchor")
    wanted = send(id_filter(shared, 25))
    occur = written(_segments(docs, is_rep, width, wanted), "segments")
    heavy = written(_heavy(occur, shard_words), "heavy")
    if heavy.isEmpty():
        decided = _decide(_distinct(occur), width, shard_words)
    else:
        decided = _decide(_distinct(occur.join(heavy, "anchor", "left_anti")), width, shard_words)
        decided = decided.union(_decide_windows(_distinct(occur.join(heavy, "anchor", "left_semi")), width))
    hits = occur.select("seg", "doc", "tag", "first").join(decided, "seg")
    hits = hits.withColumn("hit", F.expr("filter(sequence(0, size(smallest) - 1), i -> smallest[i] < doc)")).filter("size(hit) > 0")
    hits = hits.select("doc", "tag", F.expr("transform(hit, i -> first + i)").alias("at"))
    marked = written(hits.groupBy("doc", "tag").agg(F.flatten(F.collect_list("at")).alias("at")), "windows")  # one document's windows

    # copies lose everything if they have a window; the rest of their rows comes from the survey
    copies = survey.join(classes, "digest").filter(f"id > rep AND n_words >= {width}").select("id", "tag").distinct()
    touched = send(id_filter(marked.select("doc").union(copies.select("id"))))

    def cut(text: bytes | None, at) -> tuple[int, int, bytes]:
        words = (text or b"").split()
        n = len(words)
        if at is None or not n:
            return n, 0, b" ".join(words)
        edge = np.zeros(n + 1, np.int64)
        at = np.asarray(at, np.int64)
        at = at[at <= n - width]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + width, -1)
        keep = np.cumsum(edge[:-1]) == 0
        return n, int(n - keep.sum()), b" ".join([w for w, k in zip(words, keep, strict=True) if k])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, max(1, batch.num_rows), 500):
                part = batch.slice(start, 500)
                if part.num_columns == 3:
                    part = part.filter(pa.array(~touched.value.has(part.column(0).to_numpy()), pa.bool_()))
                    extra = [None] * part.num_rows
                    whole = [False] * part.num_rows
                else:
                    extra, whole = part.column(3).to_pylist(), part.column(4).to_pylist()
                rows = []
                for text, at, gone in zip(column_bytes(part.column(1)), extra, whole, strict=True):
                    n, removed, kept = cut(text, at)
                    rows.append((n, n, b"") if gone and n >= width else (n, removed, kept))
                out = {"id": part.column(0), "n_words": pa.array([r[0] for r in rows], pa.int64()), "n_removed": pa.array([r[1] for r in rows], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())}
                if with_text:
                    out["kept"] = pa.array([r[2].decode() for r in rows], pa.string())
                yield pa.record_batch(out)

    fields = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(touched.value.has(batch.column(0).to_numpy()), pa.bool_()))

    plain = map_arrow(docs, finish, fields)
    far = map_arrow(docs, only, "id long, text string, tag long")
    note = marked.select(F.col("doc").alias("id"), "tag", "at").join(copies.withColumn("gone", F.lit(True)), ["id", "tag"], "full")
    hard = map_arrow(far.join(note, ["id", "tag"], "left").select("id", "text", "tag", "at", F.coalesce("gone", F.lit(False)).alias("gone")), finish, fields)
    out = plain.unionByName(hard)
    return out.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id"))).withColumnRenamed("id", id_col)
