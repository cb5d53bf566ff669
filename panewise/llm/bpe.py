"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are merged with a queue that has one bucket per merge rank. A bucket
holds positions of a doubly linked list of parts; a three-level bitmap of
non-empty buckets gives the lowest rank by find-first-set in constant time. An
entry whose pair has changed since it was queued is stale and skipped. The cost
is linear in the pushes, so one very long pre-token is no worse than many short
ones; short ones share a queue. Chunks are remembered per worker, in a bounded memory that lets go of those not met lately.

Null text counts as empty. Repeated and tied rows each get their own result row;
other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panewise.llm.common import give_back, kept_in_worker, kept_schema, map_arrow, parts

#: Chunks a worker remembers: those met lately, and as many met before them.
CHUNK_MEMORY = 150_000
#: A chunk of more characters is not remembered.
LONG_CHUNK = 2_000
#: Bytes of pre-tokens merged together (one longer pre-token goes alone); slots of the memory of pair ranks.
MERGE_BYTES, PAIR_LOG2 = 1 << 19, 18
#: Documents encoded together, and bytes at most (one longer text goes alone).
ROWS, CHARS = 2_000, 4_000_000
KINDS = {pa.binary(): "binary", pa.int64(): "long", pa.string(): "string"}
_TWO_BLANKS = re.compile(r"\s\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file; read on the driver and sent with the task (the size of a vocabulary)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of list positions by merge rank under a three-level bitmap of non-empty buckets."""

    def __init__(self, n_ranks: int):
        self.buckets: list[list | None] = [None] * n_ranks
        self.leaf = [0] * ((n_ranks >> 6) + 1)
        self.mid = [0] * ((n_ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, entry) -> None:
        bucket = self.buckets[rank]
        if bucket is None:
            self.buckets[rank] = [entry]
            leaf, mid = rank >> 6, rank >> 12
            self.leaf[leaf] |= 1 << (rank & 63)
            self.mid[mid] |= 1 << (leaf & 63)
            self.top |= 1 << mid
        else:
            bucket.append(entry)

    def first(self) -> int:
        """Lowest rank with entries, -1 if there is none."""
        top = self.top
        if not top:
            return -1
        mid = (top & -top).bit_length() - 1
        word = self.mid[mid]
        leaf = (mid << 6) + (word & -word).bit_length() - 1
        word = self.leaf[leaf]
        return (leaf << 6) + (word & -word).bit_length() - 1

    def take(self, rank: int) -> list:
        """Remove the whole bucket of a rank."""
        bucket = self.buckets[rank]
        self.buckets[rank] = None
        leaf, mid = rank >> 6, rank >> 12
        self.leaf[leaf] &= ~(1 << (rank & 63))
        if not self.leaf[leaf]:
            self.mid[mid] &= ~(1 << (leaf & 63))
            if not self.mid[mid]:
                self.top &= ~(1 << mid)
        return bucket


class ByteBpe:
    """Encoder and decoder over one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        size = max(ranks.values(), default=-1) + 1
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.vocab: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.vocab[rank] = token
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)])
        if (self.byte_ids < 0).any():
            raise ValueError("the rank table lacks single bytes")
        self.queue = RankQueue(size)
        self.pair_keys = np.full(1 << PAIR_LOG2, -1, np.int64)  # a direct-mapped memory of pair ranks
        self.pair_values = np.full(1 << PAIR_LOG2, -1, np.int64)
        self.chunks: dict[str, bytes] = {}  # met lately
        self.older: dict[str, bytes] = {}

    def pair_rank(self, a: int, b: int) -> int:
        return self.ranks.get(self.vocab[a] + self.vocab[b], -1)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, -1 if the vocabulary lacks it."""
        key = a << 32 | b
        slot = (key * 0x9E3779B97F4A7C1) >> 20 & (1 << PAIR_LOG2) - 1
        out = self.pair_values[slot]
        miss = np.flatnonzero(self.pair_keys[slot] != key)
        if len(miss):
            unknown, back = np.unique(key[miss], return_inverse=True)
            value = np.array([self.pair_rank(k >> 32, k & 0xFFFFFFFF) for k in unknown.tolist()])
            out[miss] = value[back]
            spot = (unknown * 0x9E3779B97F4A7C1) >> 20 & (1 << PAIR_LOG2) - 1
            for k in range(len(unknown)):  # one by one, so that a slot's key and value belong together
                self.pair_keys[spot[k]], self.pair_values[spot[k]] = unknown[k], value[k]
        return out

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the lowest rank first, the leftmost of equal ranks first."""
        n, queue, rank_of = len(piece), self.queue, self.pair_rank
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := rank_of(ids[i], ids[i + 1])) >= 0:
                queue.push(r, i)
        while (rank := queue.first()) >= 0:
            entries = sorted(queue.take(rank))
            for k, i in enumerate(entries):
                j = after[i]
                if ids[i] < 0 or j >= n or rank_of(ids[i], ids[j]) != rank:
                    continue  # stale: the pair has changed since it was queued
                ids[i], ids[j] = rank, -1
                after[i] = nxt = after[j]
                lower = False
                if nxt < n:
                    before[nxt] = i
                    if (r := rank_of(rank, ids[nxt])) >= 0:
                        queue.push(r, i)
                        lower |= r < rank
                if (prev := before[i]) >= 0 and (r := rank_of(ids[prev], rank)) >= 0:
                    queue.push(r, prev)
                    lower |= r < rank
                if lower:  # a lower rank appeared: it goes first, the rest waits in its bucket
                    for rest in entries[k + 1 :]:
                        queue.push(rank, rest)
                    break
        return [x for x in ids if x >= 0]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of many pre-tokens with one queue over all their positions.

        Pre-tokens do not touch each other, so all entries of the lowest rank merge at once. Only where a
        merge makes a pair of a lower rank does the order inside a pre-token matter; those (rare) pre-tokens
        are merged again on their own.
        """
        if not pieces:
            return []
        sizes = np.array([len(p) for p in pieces])
        n = int(sizes.sum())
        starts = np.cumsum(sizes) - sizes
        ids = np.append(self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[starts + sizes - 1] = n
        before[starts] = -1
        owner = np.repeat(np.arange(len(pieces)), sizes)
        again = np.zeros(len(pieces), bool)
        current = np.full(n + 1, -1)  # rank of the pair that starts at each position
        inner = np.flatnonzero(after[:n] < n)
        current[inner] = self.pair_ranks(ids[inner], ids[inner + 1])
        queue = self.queue
        self._push(inner, current[inner])
        while (rank := queue.first()) >= 0:
            i = np.concatenate(queue.take(rank))
            i = i[current[i] == rank]  # others are stale: the pair has changed since it was queued
            if not len(i):
                continue
            if len(i) > 1:
                i = np.unique(i)
                linked = i[1:] == after[i[:-1]]
                if linked.any():  # of overlapping pairs in a row, every other one from the left
                    place = np.arange(len(i))
                    head = np.concatenate(([True], ~linked))
                    i = i[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
            j = after[i]
            k = after[j]
            inside = k < n
            soon = inside & (current[k] == rank)
            if soon.any():  # between two merges there is a pair of the first one's token and an old one
                r = self.pair_ranks(np.full(int(soon.sum()), rank), ids[k[soon]])
                again[owner[i[soon]][(r >= 0) & (r < rank)]] = True
            ids[i], ids[j] = rank, -1
            current[i] = current[j] = -1
            after[i] = k
            before[k[inside]] = i[inside]
            left = before[i]
            fresh = np.concatenate((i[inside], left[left >= 0]))
            if len(fresh):
                fresh = np.unique(fresh) if len(fresh) > 1 else fresh
                r = self.pair_ranks(ids[fresh], ids[after[fresh]])
                current[fresh] = r
                low = (r >= 0) & (r < rank)
                if low.any():
                    again[owner[fresh[low]]] = True
                self._push(fresh, r)
        alive = ids[:n] >= 0
        counts = np.add.reduceat(alive.astype(np.int64), starts)
        raw = ids[:n][alive].astype("<u4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for p in np.flatnonzero(again).tolist():
            out[p] = np.array(self.merge_one(pieces[p]), "<u4").tobytes()
        return out

    def _push(self, places: np.ndarray, ranks: np.ndarray) -> None:
        ok = ranks >= 0
        places, ranks = places[ok], ranks[ok]
        if not len(places):
            return
        if len(places) == 1:
            self.queue.push(int(ranks[0]), places)
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
        push = self.queue.push
        for rank, a, b in zip(ranks[[0, *cuts]].tolist(), [0, *cuts], [*cuts, len(places)], strict=True):
            push(rank, places[a:b])

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of distinct chunks of text; all their unknown pre-tokens are merged together."""
        split = [[p.encode() for p in self.find(c)] for c in chunks]
        ranks = self.ranks
        unknown = list({p for parts in split for p in parts if p not in ranks})
        known: dict[bytes, bytes] = {}
        start = 0
        while start < len(unknown):
            end, size = start, 0
            while end < len(unknown) and size < MERGE_BYTES:
                size += len(unknown[end])
                end += 1
            known.update(zip(unknown[start:end], self.merge(unknown[start:end]), strict=True))
            start = end
        for parts in split:
            for p in parts:
                if p not in known:
                    known[p] = ranks[p].to_bytes(4, "little")
        self.chunks.update(zip(chunks, [b"".join(map(known.__getitem__, parts)) for parts in split], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        No pre-token of the pattern crosses a blank that follows a non-blank, except that a
        space opens the next one. So a text without two blanks in a row may be cut before every
        space and its chunks remembered; any other text is matched as a whole.
        """
        split = []
        for text in texts:
            if _TWO_BLANKS.search(text):
                split.append(self.find(text))
            else:
                first, *rest = text.split(" ")
                split.append([first, *[" " + c for c in rest]] if first else [" " + c for c in rest])
        chunks, older = self.chunks, self.older
        unknown = set().union(*split).difference(chunks)
        known = unknown.intersection(older)
        chunks.update([(c, older[c]) for c in known])
        self.learn(list(unknown - known))
        out = [b"".join(map(chunks.__getitem__, parts)) for parts in split]
        for c in unknown:
            if len(c) > LONG_CHUNK:
                del chunks[c]
        if len(chunks) > CHUNK_MEMORY:
            self.chunks, self.older = {}, chunks
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[str, ByteBpe] = kept_in_worker()


def _coder(ranks_by_key: tuple[str, dict[bytes, int], str]) -> ByteBpe:
    key, ranks, pattern = ranks_by_key
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ByteBpe(ranks, pattern)
    return _CODERS[key]


def _spec(df: DataFrame, ranks_path: str, pattern: str):
    ranks = load_ranks(ranks_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((key, ranks, pattern))


def _parts(batch: pa.RecordBatch, text_column: int) -> Iterator[pa.RecordBatch]:
    return parts(batch, text_column, ROWS, CHARS)


def _mapped(df, ranks_path, pattern, text_col, keep, fields, one):
    """One pass over ``df``: the ``keep`` columns beside the fields that ``one(coder, ids)`` returns."""
    shared = _spec(df, ranks_path, pattern)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        give_back(_CODERS)
        for batch in batches:
            for part in _parts(batch, n_keep):
                texts = [t or "" for t in part.column(n_keep).to_pylist()]
                rows = [one(coder, ids) for ids in coder.encode(texts)]
                columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], *columns], names=[*[f"c{i}" for i in range(n_keep)], *[name for name, _ in fields]])

    picked = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(keep)], df[text_col].cast("string").alias("text_"))
    return map_arrow(picked, run, kept_schema(picked, n_keep, ", ".join(f"{name} {KINDS[kind]}" for name, kind in fields))).toDF(*keep, *[name for name, _ in fields])


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (binary, little-endian uint32) and ``n_tokens`` of every whole text."""

    def one(coder, ids):
        return ids, len(ids) // 4

    return _mapped(df, ranks_path, pattern, text_col, keep, [("ids", pa.binary()), ("n_tokens", pa.int64())], one)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded`` (binary): the bytes of the ids of every row. Null ids decode to nothing."""
    shared = _spec(df, ranks_path, pattern)
    n_keep = len(keep)
    picked = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(keep)], df[ids_col].alias("ids_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            raw = [coder.decode(x or b"") for x in batch.column(n_keep).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array(raw, pa.binary())], names=[*[f"c{i}" for i in range(n_keep)], "decoded"])

    return map_arrow(picked, run, kept_schema(picked, n_keep, "decoded binary")).toDF(*keep, "decoded")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode every whole text, decode the ids again, in one pass: ``n_tokens``, the SHA-256 of the
    ids as little-endian uint32 and of the decoded bytes. The ids themselves are not shuffled."""

    def one(coder, ids):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    return _mapped(df, ranks_path, pattern, text_col, keep, [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())], one)
