"""Suffix-array dedup over bytes by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if it lies under a string of `length` bytes that also starts in a document of smaller doc_id. Anchors
deal the strings out: equal strings have one anchor, so runs of strings meet by anchor. A run's bytes, from the
first string to the end of the last, form a class with the least doc_id that has it, so copies are one class
however many there are (a whole text that a smaller doc_id has, too, goes without further work); a class that is alone with its anchor has nothing to be compared with. Each task lays the classes of its anchors end to end in blocks, sorts their suffixes by
bounded prefix, takes the Burrows-Wheeler transform, and grows intervals breadth first: the interval of cw is the
one of w stepped back over c, so the borders between intervals, which are the common prefixes, appear by increasing
value; at `length` it stops. An interval's least doc_id then says which of its strings go.

A block holds whole anchors; an anchor whose classes alone exceed BLOCK_BYTES makes a block of its own up to
HEAVY_CLASSES classes, and an anchor with more is taken string by string in an aggregation by content, which spreads
over tasks and gives the same result.

Defined results: a null text is empty; doc_id is a whole number; documents of a null one neither lose bytes nor make others lose any;
rows that repeat a doc_id are one document, so they never cost each other a byte; an empty table gives no rows; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import Runs
from .common import Rolling, byte_grams, lean, materialise, ranges, shuffles_dropped, strings_of, table, text_bytes
from .repeats import Classes, Found, covered, cut_texts, gathered, keyed, later_copies, without

LENGTH = 50
GRAM = 24
_GRAMS = Rolling(21)
#: Bytes of a block of classes that is sorted at once.
BLOCK_BYTES = 1 << 19
#: Classes of one anchor that a block takes; beyond it the anchor is dealt out string by string.
HEAVY_CLASSES = 20_000


def bounded_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least `depth` bytes, by doubling from eight."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    key = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    known = 8
    while True:
        order = np.argsort(key)
        placed = key[order]
        new = np.empty(n, np.uint64)
        new[0] = 0
        np.not_equal(placed[1:], placed[:-1], out=new[1:], casting="unsafe")
        if known >= depth:
            return order
        rank = np.empty(n + known, np.uint64)
        rank[order] = np.cumsum(new) + np.uint64(1)
        rank[n:] = 0
        key = rank[:n] << np.uint64(32) | rank[known:]
        known *= 2


def intervals(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and for each the number of its interval of equal prefixes of `length` bytes."""
    order = bounded_order(data, length)
    n = len(order)
    rank = np.empty(n + 1, np.int32)
    rank[order] = np.arange(n, dtype=np.int32)
    rank[n] = 0
    following = rank[order + 1]  # where a step back from here came from: the inverse of the transform's last-to-first map
    head = data[order]
    border = np.empty(n, bool)
    border[0] = True
    np.not_equal(head[1:], head[:-1], out=border[1:])
    open_ = np.flatnonzero(~border).astype(np.int32)  # places where no border has appeared yet
    for level in range(1, length):  # common prefixes of 1, 2, ... length - 1 bytes
        if level % 4 == 1:
            open_ = open_[~border[open_]]
            one, two = following[open_ - 1], following[open_]
            left, right = np.minimum(one, two), np.maximum(one, two)  # suffixes alike beyond the sorted prefix stand in any order
            wide = np.flatnonzero(right - left > 1)
        parted = border[right]
        if len(wide):  # other characters stand between: any border on the way parts them
            gaps = (right[wide] - left[wide]).astype(np.int64)
            if int(gaps.sum()) < n:
                between = border[ranges(left[wide].astype(np.int64) + 1, gaps)]
                parted[wide] = np.logical_or.reduceat(between, np.cumsum(gaps) - gaps)
            else:
                number = np.cumsum(border, dtype=np.int32)
                parted[wide] = number[left[wide]] != number[right[wide]]
        border[open_[parted]] = True
    return order, np.cumsum(border, dtype=np.int32) - 1


def masks(spans: list[bytes], counts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each class, a bit for each of its strings that starts in a document smaller than the class's own first."""
    sizes = np.fromiter(map(len, spans), np.int64, len(spans)) + 1
    data = np.frombuffer(b"\0".join([*spans, b""]), np.uint8)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.full(len(data), -1, np.int64)
    owner[ranges(starts, counts)] = np.repeat(np.arange(len(spans)), counts)
    order, number = intervals(data, length)
    mine = owner[order]
    some = mine >= 0
    place, own, inside = order[some], mine[some], number[some]
    first = np.full(int(number[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, inside, docs[own])
    late = first[inside] < docs[own]
    out = np.zeros(len(spans), np.int64)
    np.bitwise_or.at(out, own[late], np.int64(1) << (place[late] - starts[own[late]]))
    return out


_MASKS = "_class long, _least long, _mask long"


def _settle(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= 2 * BLOCK_BYTES:
                whole = pa.Table.from_batches(held).combine_chunks()
                anchors = whole.column("_anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))
                if cut:
                    yield from settle(whole.slice(0, cut))
                    whole = whole.slice(cut)
                held, size = whole.to_batches(), whole.nbytes if cut else size
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    def settle(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = whole.column("_class").to_numpy()
        _, lead, which = np.unique(keys, return_index=True, return_inverse=True)
        least = np.full(len(lead), np.iinfo(np.int64).max)
        np.minimum.at(least, which, whole.column("_least").to_numpy())
        spans, counts = whole.column("_content").take(pa.array(lead)).to_pylist(), whole.column("_count").to_numpy()[lead].astype(np.int64)
        mask = masks(spans, counts, least, length)
        some = mask != 0
        yield pa.RecordBatch.from_arrays([pa.array(keys[lead][some]), pa.array(least[some]), pa.array(mask[some])], names=["_class", "_least", "_mask"])

    return run


def _find(length: int):
    def find(part: pa.RecordBatch) -> Found:
        data, rows = text_bytes(part, "_text")
        gram = max(min(GRAM, length), length - 62)
        runs = Runs(rows, length, gram, byte_grams(data, gram))
        size = runs.count + length - 1
        whole = _GRAMS.stretch(_GRAMS.sums(data), runs.first, runs.first + size)
        return Found(runs, whole, lambda some: strings_of(data[ranges(runs.first[some], size[some])], np.cumsum(size[some])), rows)

    return find


def repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """_doc, _tag, _runs: runs of strings, with a bit for each that goes, of the texts that lose any."""
    if length < 8:
        raise ValueError("strings of fewer than 8 bytes have no anchors")
    with shuffles_dropped(docs.sparkSession):
        return gathered(_hits(keyed(docs.filter("doc_id is not null"), text), length))


def _hits(texts: DataFrame, length: int) -> DataFrame:
    """_doc, _tag, _at, _mask of the runs that lose strings, written: each step's shuffles go before the next one's, and all before the texts travel."""
    copies = later_copies(texts.filter(F.octet_length("_text") >= length), "suffix-copies")
    found = Classes(texts, _find(length), T.BinaryType(), "suffix-classes", without(texts, copies))
    open_ = found.open_content().drop("_members")
    heavy = found.open.filter(F.col("_n") > HEAVY_CLASSES).select("_anchor")
    light = open_ if heavy.isEmpty() else open_.join(heavy, "_anchor", "left_anti")
    settled = light.repartition("_anchor").sortWithinPartitions("_anchor").mapInArrow(lean(_settle(length)), _MASKS)
    if light is not open_:
        settled = settled.unionByName(_string_by_string(open_.join(heavy, "_anchor", "left_semi"), length))
    later = found.classes.filter("_most > _least").select("_class", "_least", F.lit(0).cast("long").alias("_mask"))
    told = later.unionByName(settled).groupBy("_class").agg(F.min("_least").alias("_least"), F.bit_or("_mask").alias("_mask"))
    hit = found.resolved(materialise(told, "suffix-told"))
    hit = hit.withColumn("_mask", F.when(F.col("_doc") > F.col("_least"), F.lit(-1).cast("long")).otherwise(F.col("_mask"))).filter("_mask <> 0")
    whole = copies.select("_doc", "_tag", F.lit(-1).cast("long").alias("_at"), F.lit(-1).cast("long").alias("_mask"))
    return materialise(hit.select("_doc", "_tag", "_at", "_mask").unionByName(whole), "suffix-hits")


def _string_by_string(classes: DataFrame, length: int) -> DataFrame:
    """The same verdicts for anchors with very many classes: one row for each string, its least doc_id by aggregation."""
    classes = classes.groupBy("_class", "_count", "_content").agg(F.min("_least").alias("_least"))
    each = classes.select("_class", "_least", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("_at"), "_content")
    each = each.select("_class", "_least", "_at", F.substring("_content", F.col("_at") + 1, F.lit(length)).alias("_string"))
    first = each.groupBy("_string").agg(F.min("_least").alias("_first_doc"))
    late = each.join(first, "_string").filter(F.col("_first_doc") < F.col("_least"))
    return late.groupBy("_class").agg(F.min("_least").alias("_least"), F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))


def _counted(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many flags are set before each row's first byte and before the end; running sums would take 16 bytes a flag."""
    each = [np.count_nonzero(flags[a:b]) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(each, dtype=np.int64)))


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """docs with _n_bytes, _n_removed, _n_spans and _kept (binary: a cut may fall inside a character)."""

    def cut(data: np.ndarray, rows: np.ndarray, runs: pa.Array) -> list[pa.Array]:
        gone = covered(runs, rows, length)
        before = _counted(gone, rows)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edge = rows[:-1][np.diff(rows) > 0]
        begins[edge] = gone[edge]
        spans = np.diff(_counted(begins, rows))
        return [pa.array(np.diff(rows)), pa.array(np.diff(before)), pa.array(spans), strings_of(data[~gone], (rows - before)[1:])]

    added = [T.StructField(n, T.LongType()) for n in ("_n_bytes", "_n_removed", "_n_spans")]
    return cut_texts(docs, repeats(docs, length, text), text, cut, [*added, T.StructField("_kept", T.BinaryType())])


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256")
    )


def brute_force(docs: list[tuple], length: int = LENGTH) -> list[tuple]:
    """The digest rows, with the kept bytes, from a dictionary of all strings, for tests."""
    first: dict[bytes, int] = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        if d is not None:
            for k in range(len(b) - length + 1):
                first[s] = min(first.get(s := b[k : k + length], d), d)
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if d is not None and first[b[k : k + length]] < d:
                gone[k : k + length] = True
        edges = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
        out.append((d, len(b), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out
