"""Language-model scoring with a log-frequency Bloom filter of quantised n-gram counts.

Workers cut the rows into chunks of FLUSH tokens and ask for the distinct words and word pairs of a chunk: hashes, and how often the
chunk's training documents hold them, go to 2^SLICES buckets by hash, whatever the partitions. A bucket adds the counts up and makes its
slice of the filter, as large as its pairs need (BITS_EACH bits a level, at least its share of 2^FILTER_BITS bits): a count c is stored as
the levels 1 ... 1 + floor(2 log2 c), each a membership of its own, and a reader probes level after level until one is missing.
The bucket answers each chunk with exact word counts and the levels its slice tells for the pairs, so a slice never leaves its task, no
n-gram is left out whatever the corpus, and nothing is broadcast. Answers then meet the chunk's rows again by one shuffle.

score: sum over tokens of log10 p(w | before), p = (min(pair, context) + MU * p1(w)) / (context + MU), pair from
the filter, context and word counts exact. base_score: exact add-half unigrams.

Defined results: a null or empty text is the end token alone; a document of null doc_id trains and is not held out;
a repeated row trains again and gets the same scores; without training documents N and V are 0 and every token is
unknown; an empty table gives no rows; other columns are not read. Pair counts are kept by 32 bits and a bucket, so pairs
that collide share a count; word counts by 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACED, Rolling, bound_batches, lean, materialise, mix, ranges, slices, table, text_bytes, word_spans

#: Least size of the whole filter; slices grow beyond their share of it with what they hold.
FILTER_BITS = 28
#: The filter has 2^SLICES slices.
SLICES = 10
PROBES = 4
#: Bits of the filter for each stored level.
BITS_EACH = 12
#: Not read any more, as every word's exact count is joined; tests set it.
FREQUENT = 1 << 19
MU = 256.0
#: Tokens of a chunk.
FLUSH = 1 << 20
PIECE_BYTES = 1 << 19
_BYTES = Rolling(41)
END, START = np.uint64(0x5EED0000E0D), np.uint64(0x5EED0005A27)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, each row's words and then an end, and where rows start."""
    data, offsets = text_bytes(part, text)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, SPACED)
    words = _BYTES.stretch(_BYTES.sums(data), starts, ends)
    edges = rows + np.arange(len(rows))
    out = np.full(edges[-1], END, np.uint64)
    out[ranges(edges[:-1], np.diff(rows))] = words
    return out, edges


def pairs(held: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it, or the start of the text."""
    before = np.empty(len(held), np.uint64)
    before[1:] = held[:-1]
    before[edges[:-1]] = START
    return mix(before * _PAIR + held)


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(2 * np.log2(np.maximum(counts, 1)) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, np.ceil(2.0 ** ((level - 1) / 2) - 1e-9), 0.0)


def _spots(keys: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        salt = np.uint64((level * 0x9E3779B97F4A7C15 + k * 0xD1B54A32D192ED03) % (1 << 64))
        yield (mix(keys + salt) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Filter:
    """Slices of a bitmap; the upper bits of a key name its slice."""

    bitmap: np.ndarray
    high: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Stored levels by probing level 1, 2, ... until one is missing."""
        size = int(math.log2(len(self.bitmap) * 8)) - self.high
        base = (keys >> np.uint64(64 - self.high)).astype(np.int64) << size if self.high else np.zeros(len(keys), np.int64)
        level = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        at = 1
        while len(open_):
            there = np.ones(len(open_), bool)
            for spot in _spots(keys[open_], at, size):
                place = base[open_] + spot
                there &= (self.bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            open_ = open_[there]
            level[open_] = at
            at += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return level_count(self.levels(keys))


def _key(hashes: np.ndarray, high: int) -> np.ndarray:
    """The bits of a hash that counting keeps: its bucket and 32 more."""
    return hashes & ~np.uint64((1 << (32 - high)) - 1)


def room(counts: np.ndarray, least: int) -> int:
    """Bits, as a power of two and at least 2^least, of a slice that holds n-grams of these counts."""
    needed = int(levels(counts).sum()) * BITS_EACH
    return max(least, math.ceil(math.log2(max(needed, 8))))


def fill(keys: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """A slice of the filter with all of the n-grams."""
    top = levels(counts)
    flags = np.zeros(1 << bits, bool)
    for level in range(1, int(top.max(initial=0)) + 1):
        for spot in _spots(keys[top >= level], level, bits):
            flags[spot] = True
    return np.packbits(flags, bitorder="little")


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their summed counts, and which of them each row is."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    new = np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]))
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts, which


def squeezed(values: np.ndarray, ordered: bool = False) -> bytes:
    """Whole numbers as compressed bytes: differences where they are in order, the bytes of one rank next to each other."""
    if not len(values):
        return b""
    held = np.diff(values, prepend=values.dtype.type(0)) if ordered else values
    planes = np.ascontiguousarray(held.view(np.uint8).reshape(len(held), -1).T)
    return pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def opened_up(blob: bytes, n: int, kind: type, ordered: bool = False) -> np.ndarray:
    """The n numbers again."""
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob, n * size, asbytes=True), np.uint8)
    held = np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()
    return np.cumsum(held, dtype=kind) if ordered else held


_ASKED = "chunk long, bucket int, n_words int, n_pairs int, words binary, word_counts binary, pairs binary, pair_counts binary, rows binary"
_ANSWER = "chunk long, bucket int, n_words int, n_pairs int, counts binary, levels binary, tokens long, distinct long"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _ask(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[pa.RecordBatch]:
    """The rows of each chunk, and what it asks of each bucket."""
    bounds = np.arange(1 << SLICES, dtype=np.uint64) << np.uint64(64 - SLICES)

    def asked(chunk: int, words: list[np.ndarray], both: list[np.ndarray], trains: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        trains, found = np.concatenate(trains), []
        for held in (words, both):
            held = np.concatenate(held)
            keys = _counted(held)[0]
            trained, times = _counted(held[trains])
            counts = np.zeros(len(keys), np.uint32)
            counts[np.searchsorted(keys, trained)] = times
            found.append((keys, counts, np.append(np.searchsorted(keys, bounds), len(keys)).tolist()))
        (words, times, at), (both, together, place) = found
        low = (both >> np.uint64(32 - SLICES)).astype(np.uint32)
        rows = [
            (
                chunk, b, at[b + 1] - at[b], place[b + 1] - place[b], squeezed(words[at[b] : at[b + 1]] - bounds[b], True), squeezed(times[at[b] : at[b + 1]]),
                squeezed(low[place[b] : place[b + 1]], True), squeezed(together[place[b] : place[b + 1]]), None,
            )
            for b in range(1 << SLICES)
            if at[b + 1] > at[b] or place[b + 1] > place[b]
        ]
        for k in range(0, len(rows), 256):
            yield _batch(_ASKED, rows[k : k + 256])

    chunk, n = TaskContext.get().partitionId() << 32, 0
    words, both, trains = [], [], []
    for batch in batches:
        for part in slices(batch, "_text", PIECE_BYTES):
            held, edges = tokens(part, "_text")
            words.append(held)
            both.append(_key(pairs(held, edges), SLICES))
            trains.append(np.repeat(~part.column("_held").to_numpy(zero_copy_only=False), np.diff(edges)))
            n += len(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(part)
            yield _batch(_ASKED, [(chunk, None, None, None, None, None, None, None, sink.getvalue().to_pybytes())])
            if n >= flush:
                yield from asked(chunk, words, both, trains)
                words, both, trains, n = [], [], [], 0
                chunk += 1
    if n:
        yield from asked(chunk, words, both, trains)


def _answer(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Each bucket's tokens and distinct words, and its answers to the chunks; rows come bucket by bucket."""

    def answered(bucket: int, chunks: list[int], held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        words, times, low, together = (np.concatenate(x) for x in zip(*held, strict=True))
        both = np.uint64(bucket) << np.uint64(64 - SLICES) | low.astype(np.uint64) << np.uint64(32 - SLICES)
        _, counts, which = _added(words, times)
        keys, sums, place = _added(both, together)
        there = sums > 0
        told = Filter(fill(keys[there], sums[there], room(sums[there], least)), 0).levels(keys).astype(np.uint8)[place]
        exact = counts[which]
        yield _batch(_ANSWER, [(None, bucket, None, None, None, None, int(counts.sum()), int((counts > 0).sum()))])
        at = np.cumsum([0, *(len(x[0]) for x in held)]).tolist()
        to = np.cumsum([0, *(len(x[2]) for x in held)]).tolist()
        rows = [(c, bucket, at[k + 1] - at[k], to[k + 1] - to[k], squeezed(exact[at[k] : at[k + 1]]), squeezed(told[to[k] : to[k + 1]]), None, None) for k, c in enumerate(chunks)]
        for k in range(0, len(rows), 256):
            yield _batch(_ANSWER, rows[k : k + 256])

    now, chunks, held = None, [], []
    for batch in batches:
        for chunk, bucket, n_words, n_pairs, *blobs in zip(*batch.columns, strict=True):
            if bucket.as_py() != now:
                if chunks:
                    yield from answered(now, chunks, held)
                now, chunks, held = bucket.as_py(), [], []
            chunks.append(chunk.as_py())
            n_words, n_pairs = n_words.as_py(), n_pairs.as_py()
            words, times, low, together = (x.as_py() for x in blobs)
            first = np.uint64(now) << np.uint64(64 - SLICES)
            held.append([opened_up(words, n_words, np.uint64, True) + first, opened_up(times, n_words, np.uint32), opened_up(low, n_pairs, np.uint32, True), opened_up(together, n_pairs, np.uint32)])
    if chunks:
        yield from answered(now, chunks, held)


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    bound_batches(docs.sparkSession)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("_held"), F.col(text).alias("_text"))
    flush, least = FLUSH, FILTER_BITS - SLICES
    made = materialise(rows.mapInArrow(lean(lambda batches: _ask(batches, flush)), _ASKED), "lm-asked")
    asked = made.filter("rows is null").drop("rows").repartition("bucket").sortWithinPartitions("bucket")
    answers = materialise(asked.mapInArrow(lean(lambda batches: _answer(batches, least)), _ANSWER), "lm-answers")
    sums = answers.filter("chunk is null").agg(F.sum("tokens"), F.sum("distinct")).first()
    total, distinct = int(sums[0] or 0), int(sums[1] or 0)
    weight = total + 0.5 * (distinct + 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def scored(parts: list[pa.RecordBatch], counts: list[np.ndarray], told: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        split = [tokens(part, "_text") for part in parts]
        words, which = np.unique(np.concatenate([held for held, _ in split]), return_inverse=True)
        of = np.unique(np.concatenate([_key(pairs(*x), SLICES) for x in split]), return_inverse=True)[1]
        exact, stored = np.concatenate(counts), level_count(np.concatenate(told).astype(np.int64))
        texts = float(exact[np.searchsorted(words, END)])  # as many texts start as end
        logs, n = np.log10((exact + 0.5) / weight), 0
        for part, (held, edges) in zip(parts, split, strict=True):
            own, n = slice(n, n + len(held)), n + len(held)
            at = exact[which[own]].astype(np.float64)
            before = np.empty(len(held))
            before[1:] = at[:-1]
            before[edges[:-1]] = texts
            together = np.minimum(stored[of[own]], before)
            model = np.log10((together + MU * (at + 0.5) / weight) / (before + MU))
            add = lambda x: pa.array(np.add.reduceat(x, edges[:-1]))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_held"), pa.array(np.diff(edges)), add((at > 0).astype(np.int64)), pa.array(np.full(part.num_rows, total)), add(logs[which[own]]), add(model)],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, counts, told = None, [], [], []
        for batch in batches:
            for chunk, _, n_words, n_pairs, count, level, blob in zip(*batch.columns, strict=True):
                if chunk.as_py() != now:
                    if parts:
                        yield from scored(parts, counts, told)
                    now, parts, counts, told = chunk.as_py(), [], [], []
                if blob.is_valid:
                    parts += list(pa.ipc.open_stream(blob.as_buffer()))
                else:  # in the order of buckets, which is that of keys
                    counts.append(opened_up(count.as_py(), n_words.as_py(), np.int64))
                    told.append(opened_up(level.as_py(), n_pairs.as_py(), np.uint8))
        if parts:
            yield from scored(parts, counts, told)

    none = F.lit(None).cast("binary")
    sizes = ["n_words", "n_pairs"]
    texts = made.filter("rows is not null").select("chunk", "bucket", *sizes, none.alias("counts"), none.alias("levels"), "rows")
    both = texts.unionByName(answers.filter("chunk is not null").select("chunk", "bucket", *sizes, "counts", "levels", none.alias("rows")))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(lean(run), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def brute_force(docs: list[tuple]) -> list[tuple]:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, for tests."""
    import re
    import zlib
    from collections import Counter

    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]) for d, t in docs]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    counts = Counter(w for (_, words), h in zip(split, held, strict=True) if not h for w in words)
    n, v = counts.total(), len(counts)
    return [
        (d, h, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for (d, w), h in zip(split, held, strict=True)
    ]
