"""Shared plumbing of the training-data operators: tables, shared scratch storage, Arrow blocks."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: a space and the characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Splits on runs of ASCII white space.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, which the cluster names in spark.checkpoint.dir.

    Where none is named: the one set by setCheckpointDir; on one machine, as in tests, a temporary one of this process, removed at its
    end; on a cluster an error, as no folder of one machine would do.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="loomgraph-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return "file://" + _OWN["dir"]


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB rather than the default 64, so that workers hold little whatever a row's length; a setting of the caller's own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, "8m")


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one where df has that column already."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def bundled(df: DataFrame, columns: list[str]) -> Column:
    """Columns as one struct, so that working columns beside it can't clash with them; null-free where there are none."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.struct(F.lit(0).alias("_0"))


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run here drops its shuffle files as each job ends, rather than when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, for mapInArrow, so that a worker hands its memory back when a task ends: it idles beside the next stage's."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            _POWERS.__init__()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def row_key(*names: str) -> Column:
    """64 bits that tell rows apart by doc_id and text, so that a doc_id that comes with several texts keeps them apart."""
    return F.xxhash64(*[F.col(x) for x in names])


def _offsets(text: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    held = text.buffers()[1]
    if held is None or not len(text):
        return np.zeros(len(text) + 1, np.int64)
    return np.frombuffer(held, width)[text.offset : text.offset + len(text) + 1].astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20, most_rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of at most most_bytes of text, or one row where that alone is longer."""
    if batch.num_rows == 0:
        return
    text = batch.column(batch.schema.get_field_index(column))
    offsets = _offsets(text)
    ends, at, rows, base = offsets[1:], 0, batch.num_rows, int(offsets[0])
    while at < rows:
        to = int(np.searchsorted(ends, base + most_bytes, side="right"))
        to = min(max(to, at + 1), at + most_rows, rows)
        yield batch.slice(at, to - at)
        base, at = int(ends[to - 1]), to
    pa.default_memory_pool().release_unused()  # idle workers hold on to what they have


def text_bytes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and where each row starts and ends in them; null is empty."""
    text = batch.column(batch.schema.get_field_index(column))
    if text.null_count:
        text = text.fill_null("")
    offsets = _offsets(text)
    data = text.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


# -- words and hashes of blocks of text ---------------------------------------------------------

_SPACE_TABLE = np.ones(256, bool)
_SPACE_TABLE[[0x20, *range(0x09, 0x0E)]] = False
_ITEM_TABLE = np.zeros(256, bool)
_ITEM_TABLE[0x30:0x3A] = _ITEM_TABLE[0x61:0x7B] = _ITEM_TABLE[0x80:] = True
#: Bytes of words that white space parts, and of words of digits, lower-case letters and all beyond ASCII.
SPACED, LETTERED = _SPACE_TABLE, _ITEM_TABLE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and the position of each row's first word (rows + 1 of them)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = np.empty(n + 1, bool)
    word[:n] = inside[data]
    word[n] = False
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < n]
    first[edge] = word[edge]
    starts = np.flatnonzero(first)
    last = word[:n].copy()
    last &= ~word[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of the base of Rolling and of its inverse, as far as a task has needed them; they don't travel."""

    BASE = 0x9E3779B97F4A7C15 & ~7 | 5

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return Powers, ()

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(max(n, 1 << 19), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_POWERS = Powers()


class Rolling:
    """Polynomial hashes of any stretch of a sequence, from running sums modulo 2**64.

    The symbols are first spread to random 64-bit values, so that the powers of two in the modulus do no harm.
    """

    def __init__(self, seed: int):
        self.seed = seed
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = np.uint64(rng.integers(1 << 62))

    def __reduce__(self):
        return Rolling, (self.seed,)

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        """Running sums of symbols: uint8 bytes, or uint64 values already spread."""
        _POWERS.reach(len(symbols) + 1)
        values = self.bytes[symbols] if symbols.dtype == np.uint8 else symbols ^ self.salt
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(values * _POWERS.up[: len(symbols)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of symbols[start:end] for each pair."""
        return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_ODD))

    def grams(self, symbols: np.ndarray, n: int) -> np.ndarray:
        """Hash of each n symbols in a row."""
        if len(symbols) < n:
            return np.zeros(0, np.uint64)
        sums = self.sums(symbols)
        return mix((sums[n:] - sums[:-n]) * _POWERS.down[: len(symbols) - n + 1] + np.uint64(n * _ODD % (1 << 64)))


_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n bytes in a row, n at least 8: sums of products of the words that cover them."""
    count = len(data) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    spots = [*range(0, n - 8, 8), n - 8]
    out = None
    for k, at in enumerate(spots):
        word = np.ndarray((count,), "<u8", data, at, (1,))
        factor = _MULTIPLIERS[k % 3] + np.uint64(2 * (k // 3))
        out = word * factor if out is None else np.add(out, word * factor, out=out)
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIERS[3]
    out ^= out >> np.uint64(32)
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, end to end."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    at = np.cumsum(lengths)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


def strings_of(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Arrow binaries that lie end to end in data."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
