"""Plumbing of the operators that remove repeated stretches of text: classes of runs, and texts joined with what goes.

A run (anchors.Runs) with the content between the start of its first window and the end of its last is an
occurrence; equal content under one anchor is a class. Most anchors have a single class, which needs nothing but
its counts; only anchors with several send their content on. Texts are scanned once for each step rather than
written between steps, and travel compressed once, to meet the runs that go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import Runs, membership_filter, opened, passes, repeated_filter, share
from .common import bound_batches, bundled, lean, materialise, slices

PIECE_BYTES = 1 << 18


@dataclass
class Found:
    """Runs of a block, the hash of each run's content, and what content(chosen runs) gives."""

    runs: Runs
    whole: np.ndarray
    content: Callable[[np.ndarray], pa.Array]
    #: First symbol of each row.
    rows: np.ndarray


def doc_key(docs: DataFrame, text: str) -> Column:
    """64 bits for each doc_id: itself where it is a whole number. A null one gets a hash of the text instead."""
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    return F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(9), F.col(text))).otherwise(F.col("doc_id").cast("long") if whole else F.xxhash64("doc_id"))


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """_doc, _tag, _text. The tag, 64 more bits, tells texts of one doc_id apart, and with _doc those of none."""
    return docs.select(doc_key(docs, text).alias("_doc"), F.xxhash64(text).alias("_tag"), F.col(text).alias("_text")).filter("_text is not null")


def later_copies(docs: DataFrame, tag: str) -> DataFrame:
    """_doc, _tag of keyed texts that a smaller _doc has, too. Texts are told apart by 128 bits; only hashes travel."""
    rows = docs.select("_doc", "_tag", F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit(5), "_text").alias("_h2"))
    groups = rows.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_a"), F.max("_doc").alias("_b")).filter("_a < _b")
    return materialise(rows.join(groups, ["_h1", "_h2"]).filter("_doc > _a").select("_doc", "_tag").distinct(), tag)


#: Bits of the filter of texts that are no copies, as a power of two.
OTHERS_BITS = 26


def without(docs: DataFrame, copies: DataFrame) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """A function that drops copies from batches of keyed texts, by a filter of fixed size of the others.

    Where the filter is full, copies pass and are worked on like other texts.
    """
    mixed = F.xxhash64("_doc", "_tag")
    others = docs.select("_doc", "_tag").join(copies, ["_doc", "_tag"], "left_anti").select(mixed.alias("_id"))
    kept = share(docs, membership_filter(others, "_id", OTHERS_BITS))
    held: list[np.ndarray] = []

    def wanted(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(opened(kept))
        return batch.filter(pa.array(passes(held[0], batch.column("_id").to_numpy().view(np.uint64))))

    return wanted


class Classes:
    """Occurrences, classes and the content of open anchors of the texts in keyed(docs)."""

    def __init__(self, docs: DataFrame, find: Callable[[pa.RecordBatch], Found], content: T.DataType, tag: str, wanted: Callable[[pa.RecordBatch], pa.RecordBatch] = lambda b: b):
        """wanted: drops rows from a batch that need no work. It sees _doc, _tag, _text and _id, a hash of the first two."""
        bound_batches(docs.sparkSession)
        docs = docs.withColumn("_id", F.xxhash64("_doc", "_tag"))
        self.docs, self.find, self.kind, self.wanted = docs, find, content, wanted

        def seeds(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for part in slices(wanted(batch), "_text", PIECE_BYTES):
                yield find(part).runs.anchor

        self.repeated = share(docs, repeated_filter(docs, seeds))
        classes = self.occurrences().groupBy("_anchor", "_class").agg(
            F.count(F.lit(1)).alias("_members"), F.min("_doc").alias("_least"), F.max("_doc").alias("_most")
        )
        #: _anchor, _class, _members, _least, _most
        self.classes = materialise(classes, tag)
        #: _anchor, _n of the anchors with more than one class
        self.open = materialise(self.classes.groupBy("_anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), tag + "-open")

    def occurrences(self) -> DataFrame:
        """_anchor, _class, _doc, _tag, _at: the run's first window and its number of windows, in 64 bits."""
        find, repeated, wanted = self.find, self.repeated, self.wanted

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bitmap = opened(repeated)
            for batch in batches:
                for part in slices(wanted(batch), "_text", PIECE_BYTES):
                    found = find(part)
                    runs = found.runs
                    some = np.flatnonzero(passes(bitmap, runs.anchor))
                    row = runs.row[some]
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(runs.anchor[some].view(np.int64)), pa.array(found.whole[some].view(np.int64)), part.column("_doc").take(at),
                            part.column("_tag").take(at), pa.array((runs.first[some] - found.rows[row]) << 6 | runs.count[some]),
                        ],
                        names=["_anchor", "_class", "_doc", "_tag", "_at"],
                    )

        return self.docs.mapInArrow(lean(run), "_anchor long, _class long, _doc long, _tag long, _at long")

    def resolved(self, told: DataFrame) -> DataFrame:
        """Occurrences joined with told by _class. Classes of a thousandth of all occurrences or more, at most a thousand of
        them, are dealt over SALTS pieces."""
        total = self.classes.agg(F.sum("_members")).first()[0] or 0
        hot = self.classes.filter(F.col("_members") * 1000 >= max(total, LEAST_HOT * 1000)).select("_class", F.lit(True).alias("_hot"))
        hot = F.broadcast(hot)  # at most a thousand rows
        rows = self.occurrences().drop("_anchor").join(hot, "_class", "left")
        rows = rows.withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("_doc"), F.lit(SALTS))).otherwise(0).cast("int")).drop("_hot")
        dealt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        told = told.join(hot, "_class", "left").withColumn("_salt", F.explode(dealt)).drop("_hot")
        return rows.join(told, ["_class", "_salt"]).drop("_salt")

    def open_content(self) -> DataFrame:
        """_anchor, _class, _count, _members, _least, _content of the open anchors: a row for each class of a task's texts."""
        find, wanted, repeated = self.find, self.wanted, self.repeated
        turned = self.open.select(F.shiftleft("_anchor", 32).bitwiseOR(F.shiftrightunsigned("_anchor", 32)).alias("_turned"))
        several = share(self.docs, membership_filter(turned, "_turned", OPEN_BITS))
        names = ["_anchor", "_class", "_count", "_members", "_least", "_content"]

        def merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            _, lead, which = np.unique(whole.column("_class").to_numpy(), return_index=True, return_inverse=True)
            members = np.zeros(len(lead), np.int64)
            np.add.at(members, which, whole.column("_members").to_numpy())
            least = np.full(len(lead), np.iinfo(np.int64).max)
            np.minimum.at(least, which, whole.column("_least").to_numpy())
            out = whole.take(pa.array(lead)).combine_chunks()
            columns = [pa.array(members) if n == "_members" else pa.array(least) if n == "_least" else out.column(n).combine_chunks() for n in names]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size, first, second = [], 0, opened(repeated), opened(several)
            for batch in batches:
                for part in slices(wanted(batch), "_text", PIECE_BYTES):
                    found = find(part)
                    runs = found.runs
                    some = np.flatnonzero(passes(first, runs.anchor))
                    half = runs.anchor[some]  # the other half of the hash, so that little passes both filters by chance
                    some = some[passes(second, half << np.uint64(32) | half >> np.uint64(32))]
                    if not len(some):
                        continue
                    _, lead, which = np.unique(found.whole[some], return_index=True, return_inverse=True)
                    least = np.full(len(lead), np.iinfo(np.int64).max)
                    np.minimum.at(least, which, part.column("_doc").to_numpy()[runs.row[some]])
                    lead = some[lead]
                    columns = [
                        pa.array(runs.anchor[lead].view(np.int64)), pa.array(found.whole[lead].view(np.int64)), pa.array(runs.count[lead], pa.int32()),
                        pa.array(np.bincount(which)), pa.array(least), found.content(lead),
                    ]
                    held.append(pa.RecordBatch.from_arrays(columns, names=names))
                    size += held[-1].nbytes
                    if size > MERGE_BYTES:
                        yield merged(held)
                        held, size = [], 0
            if held:
                yield merged(held)

        kinds = [T.LongType(), T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), self.kind]
        return self.docs.mapInArrow(lean(run), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


#: Pieces that a hot class is dealt over, and the fewest occurrences of a hot class.
SALTS, LEAST_HOT = 64, 2000
#: Bytes of content that a task merges by class before it sends them.
MERGE_BYTES = 8 << 20
#: Bits of the filter of open anchors, as a power of two.
OPEN_BITS = 27


def gathered(hit: DataFrame) -> DataFrame:
    """_doc, _tag, _runs from rows _doc, _tag, _at, _mask: a list for each text that loses anything."""
    return hit.groupBy("_doc", "_tag").agg(F.collect_list(F.struct("_at", "_mask")).alias("_runs"))


def covered(runs: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    """Which symbols lie under a marked window. runs: for each row its (at, mask); an at under 0 marks the whole row."""
    flat = runs.flatten()
    per_row = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at, mask = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    whole = np.repeat(np.arange(len(per_row)), per_row)[at < 0]
    mask = np.where(at < 0, 0, mask)
    first, count = (at >> 6) + np.repeat(rows[:-1], per_row), at & 63
    step = np.zeros(int(rows[-1]) + 1, np.int32)
    for k in range(int(count.max(initial=0))):
        marked = first[(k < count) & ((mask >> np.int64(k)) & 1 == 1)] + k
        np.add.at(step, marked, 1)
        np.add.at(step, marked + length, -1)
    np.add.at(step, rows[whole], 1)
    np.add.at(step, rows[whole + 1], -1)
    return np.cumsum(step[:-1], dtype=np.int32, out=step[:-1]) > 0


Cut = Callable[[np.ndarray, np.ndarray, pa.Array], list[pa.Array]]


def cut_texts(docs: DataFrame, runs: DataFrame, text: str, cut: Cut, added: list[T.StructField]) -> DataFrame:
    """docs with added columns: what cut makes of (bytes, row offsets, lists of runs) for blocks of rows.

    An input column that has the name of an added one is replaced. The text is the one large column; it is
    compressed for the shuffle.
    """
    new = [f.name for f in added]
    others = [c for c in docs.columns if c != text and c not in new]
    rest = T.StructField("_rest", docs.select(bundled(docs, others).alias("_rest")).schema["_rest"].dataType)
    keys = [T.StructField("_doc", T.LongType()), T.StructField("_tag", T.LongType())]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            for part in slices(batch, "_text", PIECE_BYTES):
                raw = part.column("_text").cast(pa.binary()).to_pylist()
                sizes = pa.array([None if x is None else len(x) for x in raw], pa.int64())
                blobs = pa.array([None if x is None else codec.compress(x).to_pybytes() for x in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("_rest"), blobs, part.column("_doc"), part.column("_tag"), sizes], names=["_rest", "_text", "_doc", "_tag", "_size"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            sizes = batch.column("_size").fill_null(0).to_numpy(zero_copy_only=False)
            blobs, nulls = batch.column("_text"), batch.column("_size").is_null()
            at = 0
            while at < batch.num_rows:
                to = at + max(int(np.searchsorted(np.cumsum(sizes[at:]), PIECE_BYTES, side="right")), 1)
                part = batch.slice(at, to - at)
                data = b"".join(codec.decompress(b.as_buffer(), int(n)).to_pybytes() for b, n in zip(blobs[at:to], sizes[at:to], strict=True) if n)
                offsets = np.concatenate(([0], np.cumsum(sizes[at:to])))
                texts = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]).cast(pa.string())
                texts = pa.compute.if_else(nulls[at:to], pa.scalar(None, pa.string()), texts)
                made = cut(np.frombuffer(data, np.uint8), offsets, part.column("_runs"))
                yield pa.RecordBatch.from_arrays([part.column("_rest"), texts, *made], names=["_rest", "_text", *new])
                at = to

    rows = docs.select(bundled(docs, others).alias("_rest"), F.col(text).alias("_text"), doc_key(docs, text).alias("_doc"), F.xxhash64(text).alias("_tag"))
    wire = rows.mapInArrow(lean(pack), T.StructType([rest, T.StructField("_text", T.BinaryType()), *keys, T.StructField("_size", T.LongType())]))
    joined = wire.join(runs, ["_doc", "_tag"], "left").select("_rest", "_text", "_size", "_runs")
    out = joined.mapInArrow(lean(unpack), T.StructType([rest, T.StructField("_text", T.StringType()), *added]))
    back = [F.col("_text").alias(c) if c == text else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns if c not in new]
    return out.select(*back, *new)
