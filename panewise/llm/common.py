"""Helpers shared by the operators of this package.

Word hashing works on UTF-8 bytes: a word is a maximal run of bytes other than
the six ASCII white-space characters, so no decoding is needed; all words of a text
are hashed by a few array operations. Fixed-size
filters (``IdFilter``) only save shuffle volume: a false positive sends a row
down the exact path, so results never depend on their size.
"""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panewise.session import ensure_checkpoint_dir

U64 = np.uint64
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application, so that tasks can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(here):  # else it was loaded from an archive that Spark has already
        folder = tempfile.mkdtemp(prefix="panewise-ship-")  # on the driver only, for code; executors fetch it from the driver
        shutil.copytree(here, f"{folder}/src/panewise", ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(f"{folder}/panewise-{uuid.uuid4().hex[:8]}", "zip", f"{folder}/src"))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in every task."""
    ship(df.sparkSession)
    return df.mapInArrow(func, schema)


def kept_schema(df: DataFrame, n: int, ddl: str) -> T.StructType:
    """The first ``n`` columns of ``df`` and the fields of ``ddl``."""
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in df.schema.fields[:n]), *T.StructType.fromDDL(ddl).fields])


#: What operators keep in a worker from task to task.
_KEPT: list[dict] = []


def kept_in_worker() -> dict:
    """A dictionary that lives from task to task, until the worker turns to another operator."""
    _KEPT.append({})
    return _KEPT[-1]


def give_back(own: dict | None = None) -> None:
    """Return memory that this worker has freed to the system; workers live on from stage to stage. Of what operators keep, only ``own`` stays."""
    for kept in _KEPT:
        if kept is not own:
            kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def parts(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``rows`` rows and ``size`` bytes in that string column; one longer text goes alone."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        limit = size + (int(sizes[start - 1]) if start else 0)
        end = min(max(int(np.searchsorted(sizes, limit, "right")), start + 1), start + rows)
        yield batch.slice(start, end - start)
        start = end


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors and the driver share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spare_driver(spark: SparkSession) -> bool:
    """Collect the garbage of the driver's JVM once it holds half of its largest heap, which then shrinks; whether it did so."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # Spark Connect: the server sees to its own heap
        return False
    runtime = jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() <= runtime.maxMemory():
        return False
    jvm.java.lang.System.gc()
    return True


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    spare_driver(spark)  # plans and results of the steps so far
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the folder of a table made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x9E3779B97F4A7C15)
    h = h ^ (h >> U64(29))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\x0b\x0c")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at once; a longer text is cut at blanks.
TEXT_BLOCK = 1 << 18
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, at least n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, TEXT_BLOCK)
        _POWERS[:] = [np.concatenate(([U64(1)], np.cumprod(np.full(size - 1, x, U64)))) for x in (_STEP, pow(_STEP, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word of a text; ``lower`` folds A-Z.

    A polynomial over the bytes of a word, read off running sums over the whole text, so no
    word is ever cut out.
    """
    if not text:
        return np.empty(0, U64)
    raw = np.frombuffer(text, np.uint8)
    if len(raw) > TEXT_BLOCK:
        out, start = [], 0
        while start < len(raw):
            end = min(start + TEXT_BLOCK, len(raw))
            if end < len(raw) and not _BLANK[raw[end]]:
                back = np.flatnonzero(_BLANK[raw[start:end]])
                if len(back):
                    end = start + int(back[-1]) + 1
                else:  # one word fills the block: up to its end
                    ahead = np.flatnonzero(_BLANK[raw[end:]])
                    end = end + int(ahead[0]) if len(ahead) else len(raw)
            out.append(_block_hashes(raw[start:end], lower))
            start = end
        return np.concatenate(out)
    return _block_hashes(raw, lower)


def column_word_hashes(column: pa.Array, lower: bool = False, size: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, bounds) of some texts at a time: text i has the words ``bounds[i]`` to ``bounds[i + 1]``.

    Texts are joined by a blank up to ``size`` bytes, so that short ones share the array operations; a longer text goes alone.
    """
    held, n = [], 0
    for text in column_bytes(column):
        text = text or b""
        if held and n + len(text) > size:
            yield _joined_hashes(held, lower)
            held, n = [], 0
        held.append(text)
        n += len(text) + 1
    if held:
        yield _joined_hashes(held, lower)


def _joined_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    if len(texts) == 1:
        h = word_hashes(texts[0], lower)
        return h, np.array([0, len(h)])
    h, starts = _block_words(np.frombuffer(b" ".join(texts), np.uint8), lower)
    return h, np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))


def _block_hashes(raw: np.ndarray, lower: bool) -> np.ndarray:
    return _block_words(raw, lower)[0]


def _block_words(raw: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = ~_BLANK[raw]
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = turns[0::2], turns[1::2]
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum((_LOWER[raw] if lower else raw) * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xC2B2AE3D27D4EB4F)), starts


def distinct(h: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order."""
    if len(h) < 2:
        return h
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def window_hashes(h: np.ndarray, width: int, positions: tuple[int, ...] | None = None) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; ``positions`` restricts the words that count."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    factors = mix(np.arange(1, width + 1, dtype=U64) * U64(0x632BE59BD9B4E019)) | U64(1)
    total = np.zeros(n, U64)
    for j in range(width) if positions is None else positions:
        total += h[j : j + n] * factors[j]
    return mix(total)


def column_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, row by row."""
    return (v.as_buffer().to_pybytes() if v.is_valid else None for v in column)


def as_signed(h: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(h).view(np.int64))


class IdFilter:
    """Fixed-size membership filter over longs (two hash positions). No false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def _places(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(np.ascontiguousarray(ids).view(U64) + U64(0x51ED2701))
        return h % U64(size), (h >> U64(32)) * U64(0x2545F4914F6CDD1D) % U64(size)

    def __contains__(self, one: int) -> bool:
        return bool(self.has(np.array([one], np.int64))[0])

    def has(self, ids: np.ndarray) -> np.ndarray:
        a, b = self._places(ids, len(self.bits) * 8)
        return ((self.bits[a >> U64(3)] >> (a & U64(7)).astype(np.uint8)) & (self.bits[b >> U64(3)] >> (b & U64(7)).astype(np.uint8)) & 1).astype(bool)


def id_filter(ids: DataFrame, log2_bits: int = 23) -> IdFilter:
    """Filter over the one long column of ``ids``.

    Each task fills its own bit array and sends the non-zero 8 KiB slices; slices are
    OR-ed where they meet. The driver receives ``2**log2_bits`` bits, whatever the input.
    """
    size, slice_bytes = 1 << log2_bits, 8192
    name = ids.columns[0]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size >> 3, np.uint8)
        for batch in batches:
            v = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            for p in IdFilter._places(v, size):
                np.bitwise_or.at(bits, p >> U64(3), np.left_shift(1, (p & U64(7)).astype(np.uint8)).astype(np.uint8))
        yield from _slices(bits.reshape(-1, min(slice_bytes, len(bits))))

    def _slices(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        full = np.flatnonzero(table.any(axis=1))
        yield pa.record_batch({"at": pa.array(full.astype(np.int32)), "bits": pa.array([table[i].tobytes() for i in full], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(raw, np.uint8)
                table[at] = table[at] | part if at in table else part
        yield pa.record_batch({"at": pa.array(list(table), pa.int32()), "bits": pa.array([x.tobytes() for x in table.values()], pa.binary())})

    parts = map_arrow(ids.select(F.col(name).cast("long")), fill, "at int, bits binary")
    rows = parts.repartition(16, "at").mapInArrow(merge, "at int, bits binary").collect()
    bits = np.zeros(size >> 3, np.uint8)
    for r in rows:
        bits[r["at"] * min(slice_bytes, len(bits)) :][: len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return IdFilter(bits)
