"""Token-id files with Elias-Fano document boundaries.

File format: rows of a Parquet table in a shared folder, one row per block of
consecutive documents in ascending id order. A block holds the concatenated ids
(little-endian, 16 bits each if the vocabulary fits, else 32) and the end offset of
every document as an Elias-Fano sequence: the low bits of each offset packed,
the high bits in unary in a bit vector, and the position of every 64th one-bit
as select samples. So a boundary costs about 2 + log2(mean length) bits, and
``EliasFano.select(i)`` finds one without decoding the others. Spark's Parquet
writer commits whole tasks, so lost executors and repeated attempts leave no
half blocks.

Null text counts as empty (the document is its end id alone). Rows with equal
ids stay separate documents, in no fixed order among themselves; null ids come first.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panewise.llm.common import map_arrow, parts

#: Most ids of a block; one document longer than that makes a block of its own.
BLOCK_IDS = 1 << 20
#: Words a worker remembers; cleared when full.
WORD_MEMORY = 900_000
#: Documents encoded together, and bytes at most (one longer text goes alone); words the library gets as one text.
ROWS, TEXT_BYTES, JOINED = 1_200, 4_000_000, 500
SAMPLE = 64
_PUNCTUATION = string.punctuation.encode()


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``universe``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("Elias-Fano needs a non-decreasing sequence of non-negative integers")
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The i-th value, from the select sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) & (0xFF << (at & 7))
        while (count := word.bit_count()) <= left:
            left -= count
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        return (one - i) << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        value = 0
        for b in range(self.low_bits):
            bit = i * self.low_bits + b
            value |= (int(self.low[bit >> 3]) >> (bit & 7) & 1) << b
        return value

    def values(self) -> np.ndarray:
        """The whole sequence."""
        if self.n == 0:
            return np.empty(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.zeros(self.n, np.int64)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (ones - np.arange(self.n)) << self.low_bits | low


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(definition: str, ordinary_specials: bool) -> WordEncoder:
    """The worker's encoder for a tokenizer file; it lives on from task to task, and so does its memory."""
    key = (definition, ordinary_specials)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(definition, ordinary_specials)
    return _ENCODERS[key]


class WordEncoder:
    """Ids of a text by a tokenizers file, remembering the ids of each white-space separated word.

    The tokenizer must never join across white space. That is so when it drops white space while it
    splits; ``by_word`` says whether the file does, else whole texts are encoded.
    """

    def __init__(self, definition: str, ordinary_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_word = self._ids(["a b", "  a\tb\r\n\x0b\x0c"]) == [b"".join(self._ids(["a", "b"]))] * 2
        # tokens that the library cuts out of a text before it splits it; words with one go to the library as they are
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_word = self.by_word and not any(t.split() != [t] for t in added)
        self.added = tuple(t.lower().encode() for t in added)
        # a vocabulary without capitals folds them itself; folding them first makes fewer words
        self.folds = self.by_word and self._ids([string.ascii_uppercase, "It'S", "A1b"]) == self._ids([string.ascii_lowercase, "it's", "a1b"])
        # one that always parts letters from punctuation: a word's tail is a word of its own
        tails = [*string.punctuation, "...", "!?", "***", "')", '."']
        self.parts_tails = self.by_word and self._ids([f"ab{t}" for t in tails]) == [a + b for a, b in zip(self._ids(["ab"] * len(tails)), self._ids(tails), strict=True)]
        self.between = self._separator()
        self.memory: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.dtype.itemsize == 2 else "I"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _separator(self) -> tuple[bytes, int] | None:
        """A token that the library cuts out of a text before anything else, to part the words of one call; none if it would not."""
        if not self.by_word or self.tokenizer.encode_special_tokens:
            return None
        words = ["a", "b1", "it's", "...", "<|", "é", "|>", "<", "c"]
        alone = self._ids(words)
        for no, t in self.tokenizer.get_added_tokens_decoder().items():
            if t.special and not (t.single_word or t.lstrip or t.rstrip or t.normalized):
                token = np.array([no], self.dtype).tobytes()
                if self._ids([t.content.join(words)]) == [token.join(alone)]:
                    return t.content.encode(), no
        return None

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words without added tokens: many words a call, since the library takes longer to begin one than to encode a word."""
        if self.between is None:
            return self._ids([w.decode() for w in words])
        text, no = self.between
        groups, out = [words[i : i + JOINED] for i in range(0, len(words), JOINED)], []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([text.join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            cuts = np.flatnonzero(ids == no)
            if len(cuts) != len(group) - 1:
                out += self._ids([w.decode() for w in group])
                continue
            raw, ends = ids.tobytes(), cuts * self.dtype.itemsize
            starts = [0, *(ends + self.dtype.itemsize).tolist()]
            out += [raw[a:b] for a, b in zip(starts, [*ends.tolist(), len(raw)], strict=True)]
        return out

    def _has_added(self, lowered: bytes) -> bool:
        return any(t in lowered for t in self.added)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._ids([t.decode() for t in texts])
        lowered = [t.lower() for t in texts]  # bytes: ASCII letters only
        added = [self._has_added(low) for low in lowered]  # folding could make an added token of other letters
        split = [(low if self.folds and not has else t).split() for t, low, has in zip(texts, lowered, added, strict=True)]
        memory, some_added = self.memory, any(added)
        words = set().union(*split)
        missing = list(words.difference(memory))
        if len(memory) + len(missing) > WORD_MEMORY:
            memory.clear()
            missing = list(words)
        tailed = []
        if self.parts_tails:
            for w in missing:
                stem = w.rstrip(_PUNCTUATION)
                if stem and len(stem) < len(w) and stem[-1:].isalpha() and not (some_added and self._has_added(w.lower())):  # an ASCII letter
                    tailed.append((w, stem, w[len(stem) :]))
            whole = {w for w, _, _ in tailed}
            new = {p for _, *parts in tailed for p in parts if p not in memory}
            missing = list(new.union(w for w in missing if w not in whole))
        for start in range(0, len(missing), 20_000):
            part = missing[start : start + 20_000]
            memory.update(zip(part, self._ids([w.decode() for w in part]) if some_added else self._word_ids(part), strict=True))
        for w, stem, tail in tailed:
            memory[w] = memory[stem] + memory[tail]
        near = {w: memory[w] for w in words}  # a few of the memory's words, found again and again
        return [b"".join(map(near.__getitem__, one)) for one in split]


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", ordinary_specials: bool = False, block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text, append ``end_id`` to each document, and write blocks in ascending id order to ``path``.

    A special token written in a text gets its own id, as in the library; with ``ordinary_specials`` it is text like any other.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    shared = df.sparkSession.sparkContext.broadcast(definition)  # a vocabulary file; it does not grow with the data

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value, ordinary_specials)
        end = np.array([end_id], coder.dtype).tobytes()
        part, no = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        runs: list[bytes] = []
        held = before = 0

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(r) // coder.dtype.itemsize for r in runs])
            ef = EliasFano.build(ends)
            return pa.record_batch({"part": pa.array([part], pa.int32()), "block": pa.array([no], pa.int64()), "n_docs": pa.array([len(runs)], pa.int64()), "n_ids": pa.array([int(ends[-1])], pa.int64()), "in_part": pa.array([before], pa.int64()), "width": pa.array([coder.dtype.itemsize], pa.int32()), "doc_ids": pa.array([ids], pa.list_(pa.int64())), "low_bits": pa.array([ef.low_bits], pa.int32()), "low": pa.array([ef.low.tobytes()], pa.binary()), "high": pa.array([ef.high.tobytes()], pa.binary()), "samples": pa.array([ef.samples.tobytes()], pa.binary()), "ids": pa.array([b"".join(runs)], pa.binary())})

        for batch in batches:
            for rows in parts(batch, 1, ROWS, TEXT_BYTES):
                texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in rows.column(1)]
                for one, run in zip(rows.column(0).to_pylist(), coder.encode(texts), strict=True):
                    size = len(run) // coder.dtype.itemsize + 1
                    if runs and held + size > block_ids:
                        yield block()
                        no, held, before = no + 1, 0, before + held
                        ids, runs = [], []
                    ids.append(one)
                    runs.append(run + end)
                    held += size
        if runs:
            yield block()

    rows = df.select(F.col(id_col).cast("long").alias("id_"), F.col(text_col).cast("string").alias("text_"))
    rows = rows.repartitionByRange(F.col("id_").asc_nulls_first()).sortWithinPartitions(F.col("id_").asc_nulls_first())
    map_arrow(rows, blocks, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)


BLOCK_SCHEMA = "part int, block long, n_docs long, n_ids long, in_part long, width int, doc_ids array<bigint>, low_bits int, low binary, high binary, samples binary, ids binary"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of ``path`` with ``first``, the number of ids before each block."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per written partition, so this side stays a few MB even with 100,000 of them
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    before = F.coalesce(F.sum("n_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.select("part", before.alias("part_first"))
    return blocks.join(F.broadcast(parts), "part").withColumn("first", F.col("in_part") + F.col("part_first"))


def documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document cut from its block by the boundaries; ids as little-endian uint32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, counts, runs in _cut(batches):
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts), "n_tokens": pa.array(counts), "ids": pa.array([r.tobytes() for r in runs], pa.binary())})

    return map_arrow(_picked(blocks), cut, "doc_id long, start long, n_tokens long, ids binary")


def digests(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): as ``documents``, with the unsigned CRC-32 of the uint32 ids in place of them."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, counts, runs in _cut(batches):
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts), "n_tokens": pa.array(counts), "ids_crc32": pa.array([zlib.crc32(r) for r in runs], pa.int64())})

    return map_arrow(_picked(blocks), crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _picked(blocks: DataFrame) -> DataFrame:
    return blocks.select("first", "n_docs", "width", "doc_ids", "low_bits", "low", "high", "samples", "ids")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            first, n_docs, width, doc_ids, low_bits, low, high, samples, ids = (c[i].as_py() for c in batch.columns)
            ends = EliasFano(n_docs, low_bits, low, high, samples).values()
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            run = np.frombuffer(ids, f"<u{width}").astype("<u4")
            yield doc_ids, starts + first, ends - starts, [run[a:b] for a, b in zip(starts, ends, strict=True)]

