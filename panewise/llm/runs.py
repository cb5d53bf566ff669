"""Periodic runs of words, by block convolution at dyadic scales.

A run is a maximal stretch of consecutive words with smallest period q, of at
least ``min_exponent`` q words and at least ``min_length``. Words
are maximal runs of bytes other than the six ASCII white-space characters, compared as they are.

Scale B = 1, 2, 4, ... finds the periods from B to 2B - 1. Every 2B words a block starts, of B words
(``LONGEST`` at most). A run of such a period has four of them or more, so it holds a
whole block and the same block one period later. All places in the window behind a block where it
occurs again come from one convolution: the sum of squared differences of word numbers is
``sum a^2 + sum w^2 - 2 (a * w)``, with the last term from number-theoretic transforms modulo
primes whose product exceeds any such sum, so a zero is an exact match and nothing is rounded. The distances are
seeds; each is extended both ways as far as words that far apart are equal. Equal stretches found again at a multiple of
the period are known by their ends.

Two shortcuts change no result. A block is transformed only if each of its words comes
again within 2B words, and not if a known run of a period no longer than the block covers it and the window behind it (two
periods of one stretch that long have a common divisor as period). Texts are taken together, about
``CHUNK`` words at a time, parted by numbers that occur once; a longer text is a chunk of its own. Blocks are transformed in batches of
bounded size, so a chunk needs memory in proportion to its words.

Rows without text, and empty texts, have no words and no runs, and their ``collapsed`` text is empty. Rows are judged one by
one, so ids may be null or repeated. All columns of the input other than the new ones are kept; one of a new one's name is replaced.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import column_bytes, free_name, kept_schema, map_arrow

MIN_LENGTH, MIN_EXPONENT = 6, 4
CHUNK = 1 << 17
#: Words of the longest block; larger scales look for the first so many words of their blocks.
LONGEST = 1 << 12
#: Numbers in one batch of transforms.
BATCH = 1 << 18
#: Primes k 2^m + 1 below 2^31 with a generator; a product of two numbers below them fits 64 bits.
PRIMES = ((998_244_353, 3), (469_762_049, 3), (754_974_721, 11), (167_772_161, 3))
U64 = np.uint64


@functools.cache
def _turns(prime: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``2 half``."""
    root = pow(generator, (prime - 1) // (2 * half), prime)
    if inverse:
        root = pow(root, -1, prime)
    out = np.ones(half, U64)
    size = 1
    while size < half:
        out[size : 2 * size] = out[:size] * U64(pow(root, size, prime)) % U64(prime)
        size *= 2
    return out


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), in bit-reversed order."""
    m, n = rows.shape
    p, out = U64(prime), rows
    half = n // 2
    while half:
        pairs = out.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        after = np.empty_like(pairs)
        after[:, :, 0] = (u + v) % p
        after[:, :, 1] = (u + (p - v)) % p * _turns(prime, generator, half, False) % p
        out, half = after, half // 2
    return out.reshape(m, n)


def restored(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of ``transform``."""
    m, n = rows.shape
    p, out = U64(prime), rows
    half = 1
    while half < n:
        pairs = out.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _turns(prime, generator, half, True) % p
        after = np.empty_like(pairs)
        after[:, :, 0] = (u + v) % p
        after[:, :, 1] = (u + (p - v)) % p
        out, half = after, half * 2
    return out.reshape(m, n) * U64(pow(n, -1, prime)) % p


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, at which offsets of its window the block occurs: zeros of the squared differences."""
    m, length = blocks.shape
    width = windows.shape[1]
    places = width - length + 1
    size = 1 << max(1, (width - 1).bit_length())
    largest = int(max(blocks.max(), windows.max()))
    bound, primes = length * largest * largest, []
    for prime in PRIMES:
        primes.append(prime)
        if (product := int(np.prod([p for p, _ in primes], dtype=object))) > 2 * bound:
            break
    if product <= 2 * bound:
        raise ValueError("word numbers are too large for the primes")
    a, w = blocks.astype(U64), windows.astype(U64)
    zero = np.ones((m, places), bool)
    for prime, generator in primes:
        p = U64(prime)
        own, all_words = np.zeros((m, size), U64), np.zeros((m, size), U64)
        own[:, :length], all_words[:, :width] = a[:, ::-1] % p, w % p
        product = transform(own, prime, generator) * transform(all_words, prime, generator) % p
        cross = restored(product, prime, generator)[:, length - 1 : length - 1 + places]
        squares = np.zeros((m, width + 1), U64)
        np.cumsum(all_words[:, :width] ** 2 % p, axis=1, out=squares[:, 1:])  # below 2^31 times the width
        behind = (squares[:, length : length + places] - squares[:, :places]) % p
        before = ((own[:, :length] ** 2 % p).sum(axis=1) % p)[:, None]
        zero &= (before + behind) % p == cross * U64(2) % p
    return zero


def _reach(x: np.ndarray, at: int, distance: int, limit: int, step: int) -> int:
    """First place from ``at`` on, going by ``step``, where x[i] and x[i + distance] differ (or the limit)."""
    span = 64
    while (at < limit) if step > 0 else (at > limit):
        end = min(at + span, limit) if step > 0 else max(at - span, limit)
        piece = slice(at, end) if step > 0 else slice(end + 1, at + 1)
        other = slice(piece.start + distance, piece.stop + distance)
        differ = np.flatnonzero(x[piece] != x[other])
        if len(differ):
            return at + int(differ[0]) if step > 0 else end + 1 + int(differ[-1])
        at, span = end, span * 2
    return at


def _next_same(x: np.ndarray) -> np.ndarray:
    """Distance from each place to the next with the same number; the length of x if there is none."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), len(x), np.int64)
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def find_runs(x: np.ndarray, longest_text: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of the numbers ``x`` (0 and up), ascending; no run is longer than ``longest_text``."""
    if min_exponent < 4:
        raise ValueError("a run of fewer than four periods may hold no whole block")
    n = len(x)
    found: dict[tuple[int, int], int] = {}
    again = _next_same(x)
    scale = 1
    while scale * min_exponent <= longest_text:
        length = min(scale, LONGEST)
        known = _Covered(found, length)
        starts = np.arange(0, n - length, 2 * scale)
        reach = np.zeros(len(starts) * 2 * scale, np.int64)
        reach[: min(n, len(reach))] = again[: len(reach)]
        starts = starts[reach.reshape(-1, 2 * scale)[:, :length].max(axis=1, initial=0) < 2 * scale]
        starts = starts[~known(starts, 2 * scale + length)]
        seen: dict[int, int] = {}  # distance -> end of the last stretch of words that come again so far away
        for own, far in _seeds(x, starts, scale, length):
            new = ~known(own, far + length)
            for start, distance in zip(own[new].tolist(), far[new].tolist(), strict=True):
                if start < seen.get(distance, 0):
                    continue
                right = _reach(x, start + length, distance, n - distance, 1)
                seen[distance] = right
                left = _reach(x, start - 1, distance, -1, -1) + 1
                if right + distance - left >= max(min_length, min_exponent * distance):
                    found.setdefault((left, right + distance), distance)
        scale *= 2
    return sorted((s, e, q) for (s, e), q in found.items())


class _Covered:
    """Which stretches lie in one of the runs whose period is at most ``length``."""

    def __init__(self, found: dict[tuple[int, int], int], length: int):
        runs = sorted(ends for ends, q in found.items() if q <= length)
        self.starts = np.array([s for s, _ in runs], np.int64)
        self.ends = np.maximum.accumulate(np.array([e for _, e in runs], np.int64)) if runs else self.starts

    def __call__(self, starts: np.ndarray, span) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(len(starts), bool)
        at = np.searchsorted(self.starts, starts, "right") - 1
        return (at >= 0) & (self.ends[np.maximum(at, 0)] >= starts + span)


def _seeds(x: np.ndarray, starts: np.ndarray, scale: int, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and distances at which the block at a start comes again, distances from scale to 2 scale - 1."""
    if not len(starts):
        return
    places = min(scale, 3 * LONGEST)
    padded = np.concatenate((x, np.full(2 * scale + length + places, x.max() + 1)))
    rows = max(1, BATCH // (2 * (places + length)))
    for first in range(scale, 2 * scale, places):
        count = min(places, 2 * scale - first)
        for i in range(0, len(starts), rows):
            own = starts[i : i + rows]
            blocks = padded[own[:, None] + np.arange(length)]
            windows = padded[own[:, None] + first + np.arange(count + length - 1)]
            at, offset = np.nonzero(occurrences(blocks, windows))
            start, distance = own[at], first + offset
            # the first block of a run is followed by more than a period of equal words: most seeds end here
            for k in range(1, 9):
                place = start + distance * k // 8
                good = (place + distance < len(x)) & (padded[place] == padded[np.minimum(place + distance, len(padded) - 1)])
                start, distance = start[good], distance[good]
            yield start, distance


def _chunks(column: pa.Array) -> Iterator[list[list[bytes]]]:
    held, words = [], 0
    for text in column_bytes(column):
        own = text.split() if text else []  # bytes: the six ASCII characters, nothing else
        if held and words + len(own) > CHUNK:
            yield held
            held, words = [], 0
        held.append(own)
        words += len(own)
    if held:
        yield held


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per text, given as its words, the (start, length, period) of its runs by start, then period."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    number = list(map(numbers.__getitem__, chain.from_iterable(texts)))
    sizes = np.array([len(words) for words in texts])
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    x = np.empty(int(first[-1]), np.int64)
    parting = first[1:] - 1
    inside = np.ones(len(x), bool)
    inside[parting] = False
    x[inside] = number
    x[parting] = len(numbers) + np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if sizes.max(initial=0) >= max(min_length, min_exponent):
        for s, e, q in find_runs(x, int(sizes.max()), min_length, min_exponent):
            t = int(np.searchsorted(first, s, "right")) - 1
            out[t].append((s - int(first[t]), e - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    turn = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turn[start + period] += 1
        turn[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()]


NEW = "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(df: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``df`` with ``n_words``, its ``runs`` by start, then period, and the ``collapsed`` text: the words outside
    the repetitions, joined by one space."""
    if min_exponent < 4:
        raise ValueError("a run of fewer than four periods may hold no whole block")
    new = ["n_words", "runs", "collapsed"]
    kept = [c for c in df.columns if c.lower() not in new]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in _chunks(batch.column(len(kept))):
                runs = runs_of(texts, min_length, min_exponent)
                short = [b" ".join(collapsed(w, r)) for w, r in zip(texts, runs, strict=True)]
                own = batch.slice(done, len(texts))
                done += len(texts)
                listed = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], kind)
                columns = [*own.columns[: len(kept)], pa.array([len(w) for w in texts], pa.int64()), listed, pa.array(short, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    rows = df.select(*kept, F.col(text_col).cast("string").alias(free_name(df, "text")))
    return map_arrow(rows, find, kept_schema(rows, len(kept), NEW))
