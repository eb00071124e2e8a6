"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Documents with equal sets are one class from the start, however many there are. Two sets of sizes a <= b link only
if they share at least ceil(t * b) shingles and differ in at most (a + b)(1 - t)/(1 + t) of them.

Light pairs (b up to the boundary): each set lists its subsets of the fixed size that a partner of size b must
share; linked sets have a subset in common. Heavy pairs (b beyond it): inverted lists of shingles are scanned. In an
order that all sets share, with shingles of one set first and those of many sets last, linked sets have a shingle in
common among the first a - ceil(t * a) + 1 of each, so only those are looked up, and a set that has so many shingles
of its own needs no list at all. The boundary is where, summed over the sizes found, listing subsets costs less than
scanning lists.

Which shingles and subsets occur more than once, and which often, two filters of fixed size tell; they err only in
letting too much through. A parity sketch stands for each member of a list: the bits in
which two sketches differ can only be fewer than the shingles in which the sets differ, so what a sketch drops is
proven not to link. First one member of each list meets every other, which joins groups of near copies without
bringing a list together. Lists whose members are then still in several components are scanned, each in one task, a
long one as pairs of its blocks; of what a scan keeps only trees between components leave the task, never the pairs
of a list. All pairs are checked against the whole sets; where one from a scan fails, its lists are scanned again for
other trees, and in the end for all pairs between components that are still apart and that the sketch allows, so no
link is lost.

Defined results: lower-cases A-Z; a set of fewer words than a shingle is the whole sequence; a text that is null
or has no word is an empty set and links with nothing; rows that repeat a doc_id and text are one class, each row
gets its result; a null doc_id takes part but is never a component's name unless it is alone there; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import FILTER_BITS, opened, passes, repeated_filters, share
from .common import LOWER, SPACED, Rolling, bound_batches, bundled, lean, materialise, mix, ranges, slices, table, text_bytes, word_spans
from .components import connected

SHINGLE = 3
#: 100 * intersection >= 90 * union.
THRESHOLD = Fraction(9, 10)
#: What looking up one shingle costs, against 1 for listing a subset: rows of an inverted list, and the sketches that meet there.
SCAN_COST = 8
#: A shingle that this many tasks and flushes of tasks have seen, at two each at most, comes last in the common order; size of the filter that tells.
COMMON, COMMON_BITS = 64, 24
#: Members of a list that one task scans; a longer list is dealt out as pairs of blocks of about so many.
LONG = 4096
_BYTES, _WORDS = Rolling(31), Rolling(32)
_LOW48 = np.uint64((1 << 48) - 1)
PIECE_BYTES = 1 << 19


class Plan:
    """Boundary, prefixes and subset sizes for a threshold."""

    def __init__(self, sizes: dict[int, int], threshold: Fraction = THRESHOLD):
        self.t = threshold
        scanning = {n: rows * SCAN_COST * self.prefix(n) for n, rows in sizes.items()}
        cost = least = sum(scanning.values())
        self.light, listing = 0, 0
        for n in sorted(sizes):  # the boundary of least cost; beyond the point where listing alone costs more there is none
            listing += sizes[n] * self.subsets(n)
            if listing > least:
                break
            cost += sizes[n] * self.subsets(n) - scanning[n]
            if cost < least:
                self.light, least = n, cost
        #: The least size that can link with a heavy one.
        self.listed = math.ceil(self.t * (self.light + 1))

    def prefix(self, n: int) -> int:
        """Shingles, in the common order, one of which any set that links with one of size n has among its own first ones."""
        return n - self.shared(n) + 1

    def sketch_bytes(self, n: int) -> int:
        """A power of two, with eight bits at least for each shingle in which linked sets of size n may differ, and 64 up to 1 KB.

        With 64 bits two differing shingles seldom fall on one, so hardly a pair passes that differs in more than a few too many.
        """
        most = self.apart(n, n)
        return max(32, 1 << most.bit_length(), min(1 << (8 * most).bit_length(), 1024))

    def shared(self, larger: int) -> int:
        return math.ceil(self.t * larger)

    def reach(self, n: int) -> int:
        """The largest size that can link with size n."""
        return math.floor(n / self.t)

    def apart(self, a: int, b: int) -> int:
        """The most shingles in which linked sets of these sizes differ."""
        return math.floor((a + b) * (1 - self.t) / (1 + self.t))

    def subsets(self, n: int) -> int:
        return sum(math.comb(n, self.shared(m)) for m in range(n, self.reach(n) + 1))


class Sets:
    """Distinct shingle hashes (48 bits) of a block of rows, end to end, sorted within a row."""

    def __init__(self, batch: pa.RecordBatch, text: str, n: int = SHINGLE):
        data, offsets = text_bytes(batch, text)
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets, SPACED)
        words = _BYTES.stretch(_BYTES.sums(data), starts, ends)
        counts = np.diff(rows)
        sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        first = ranges(rows[:-1], sizes)
        row = np.repeat(np.arange(len(counts)), sizes)
        grams = _WORDS.stretch(_WORDS.sums(words), first, np.minimum(first + n, rows[row + 1]))
        held = row.astype(np.uint64) << np.uint64(48) | grams >> np.uint64(16)
        held.sort()
        new = np.ones(len(held), bool)
        new[1:] = held[1:] != held[:-1]
        held = held[new]
        self.hashes = held & _LOW48
        self.row = (held >> np.uint64(48)).astype(np.int64)
        self.sizes = np.bincount(self.row, minlength=len(counts))
        self.edges = np.concatenate(([0], np.cumsum(self.sizes)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.hashes + np.uint64(77)))))
        both = total[self.edges[1:]] - total[self.edges[:-1]]
        self.ids = mix(both + self.sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def of(self, k: int) -> np.ndarray:
        return self.hashes[self.edges[k] : self.edges[k + 1]]


def spread(sets: Sets, rows: np.ndarray) -> np.ndarray:
    """The shingles of rows, end to end, as filters and the common order take them."""
    return mix(sets.hashes[ranges(sets.edges[rows], sets.sizes[rows])] + np.uint64(1000))


def heavy_keys(sets: Sets, plan: Plan, repeated: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, shingles) that are looked up: of the first ones in the common order, those that other sets may have."""
    prefix = np.array([plan.prefix(n) for n in range(int(sets.sizes.max(initial=0)) + 1)])
    rows = np.flatnonzero((sets.sizes > 0) & (sets.sizes >= plan.listed))
    shingles = spread(sets, rows)
    often = passes(repeated, shingles).astype(np.uint64)
    owner = np.repeat(np.arange(len(rows)), sets.sizes[rows])
    some = np.bincount(owner, weights=1 - often.astype(float), minlength=len(rows)) < prefix[sets.sizes[rows]]
    rows, held = rows[some], some[owner]  # most sets have enough shingles of their own
    shingles, often = shingles[held], often[held]
    often[often > 0] += passes(common, shingles[often > 0]).astype(np.uint64)
    owner = np.repeat(np.arange(len(rows)), sets.sizes[rows])
    order = np.lexsort((often << np.uint64(62) | shingles >> np.uint64(2), owner))
    first = np.cumsum(sets.sizes[rows]) - sets.sizes[rows]
    chosen = order[ranges(first, prefix[sets.sizes[rows]])]
    chosen = chosen[often[chosen] > 0]
    return rows[owner[chosen]], mix(shingles[chosen] ^ np.uint64(0x11))


def light_keys(sets: Sets, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(rows, keys) of the subsets that small sets list."""
    rows, keys = [], []
    for k in np.flatnonzero((sets.sizes > 0) & (sets.sizes <= plan.light)).tolist():
        spread = mix(sets.of(k) + np.uint64(999))
        n = len(spread)
        for m in range(n, min(plan.reach(n), plan.light) + 1):
            left = n - plan.shared(m)  # listing what is left out is shorter
            gone = list(combinations(range(n), left)) if left else [()]
            found = np.full(len(gone), spread.sum(dtype=np.uint64)) - (spread[np.array(gone)].sum(axis=1, dtype=np.uint64) if left else np.uint64(0))
            keys.append(mix(found ^ np.uint64(m << 40 | 0xABC)))
            rows.append(np.full(len(gone), k))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(keys)


def sketches(sets: Sets, rows: np.ndarray, plan: Plan) -> Iterator[bytes]:
    """Parity sketches: a bit flips for each shingle that falls on it. Folding one by halves gives that of half the width."""
    for row in rows.tolist():
        width = plan.sketch_bytes(int(sets.sizes[row]))
        spot = (mix(sets.of(row) + np.uint64(7)) & np.uint64(width * 8 - 1)).astype(np.int64)
        yield np.packbits(np.bincount(spot, minlength=width * 8) & 1, bitorder="little").tobytes()


def folded(drawn: list[bytes], width: int) -> np.ndarray:
    """Sketches of at least that width, folded to it: a row of words each."""
    out = np.zeros((len(drawn), width // 8), np.uint64)
    for size in {len(x) for x in drawn}:
        at = [k for k, x in enumerate(drawn) if len(x) == size]
        held = np.frombuffer(b"".join(drawn[k] for k in at), np.uint64).reshape(len(at), size // width, width // 8)
        out[at] = np.bitwise_xor.reduce(held, axis=1)
    return out


def _distinct(sets: Sets) -> np.ndarray:
    """The first row of each set of the block."""
    return np.unique(sets.ids, return_index=True)[1]


_MEMBERS = "_key long, _set long, _size int, _sketch binary"


def inverted_lists(docs: DataFrame, plan: Plan, text: str, n: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Members of the lists of several sets (_key, _set, _size), and their sketches (_set, _sketch)."""

    def seen(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in slices(batch, text, PIECE_BYTES):
            sets = Sets(part, text, n)
            yield light_keys(sets, plan)[1]
            own = _distinct(sets)
            yield spread(sets, own[sets.sizes[own] >= plan.listed])

    repeated, common = (share(docs, x) for x in repeated_filters(docs, seen, (2, COMMON), (FILTER_BITS, COMMON_BITS)))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, often = opened(repeated), opened(common)
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES):
                sets = Sets(part, text, n)
                lone = np.zeros(len(sets.ids), bool)
                lone[_distinct(sets)] = True
                rows, keys = light_keys(sets, plan)
                some = passes(several, keys)
                heavy, shingles = heavy_keys(sets, plan, several, often)
                rows, keys = np.concatenate((rows[some], heavy)), np.concatenate((keys[some], shingles))
                rows, keys = rows[lone[rows]], keys[lone[rows]]
                if not len(rows):
                    continue
                own, lead = np.unique(rows, return_index=True)
                held: list[bytes | None] = [None] * len(rows)
                for k, x in zip(lead.tolist(), sketches(sets, own, plan), strict=True):  # one of a set's rows carries its sketch
                    held[k] = x
                columns = [pa.array(keys.view(np.int64)), pa.array(sets.ids[rows].view(np.int64)), pa.array(sets.sizes[rows], pa.int32()), pa.array(held, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["_key", "_set", "_size", "_sketch"])

    rows = materialise(docs.mapInArrow(lean(members), _MEMBERS), "jaccard-members")
    several = rows.groupBy("_key").agg(F.min("_set").alias("_a"), F.max("_set").alias("_b")).filter("_a < _b").select("_key")
    lists = materialise(rows.drop("_sketch").join(several, "_key", "left_semi").distinct(), "jaccard-lists")
    drawn = rows.filter("_sketch is not null").join(lists.select("_set").distinct(), "_set", "left_semi")
    return lists, materialise(drawn.groupBy("_set").agg(F.first("_sketch").alias("_sketch")), "jaccard-sketches")


def _stars(lists: DataFrame, drawn: DataFrame, threshold: Fraction) -> DataFrame:
    """_a, _b: one member of each list with every other one, where the sketches allow it. No list meets in one task for this."""
    one = lists.groupBy("_key").agg(F.max(F.struct(F.xxhash64("_set").alias("h"), "_set", "_size")).alias("_one"))
    pairs = lists.join(one, "_key").filter(F.col("_set") != F.col("_one._set"))
    pairs = pairs.select(F.col("_set").alias("_a"), F.col("_one._set").alias("_b"), F.col("_size").alias("_n"), F.col("_one._size").alias("_m")).distinct()
    up, down = threshold.numerator, threshold.denominator
    pairs = pairs.filter((F.least("_n", "_m") * down >= F.greatest("_n", "_m") * up))
    pairs = pairs.join(drawn.withColumnsRenamed({"_set": "_a", "_sketch": "_x"}), "_a").join(drawn.withColumnsRenamed({"_set": "_b", "_sketch": "_y"}), "_b")
    allowed = _allowed(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("_n", "_m"))
            differ = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist(), strict=True)):
                x, y = folded([x, y], min(len(x), len(y)))
                differ[k] = np.bitwise_count(x ^ y).sum()
            fits = pa.array(allowed(differ, n, m))
            ends = [batch.column(c).to_numpy() for c in ("_a", "_b")]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], names=["_a", "_b"]).filter(fits)

    return pairs.mapInArrow(lean(run), _PAIRS).distinct()


def _allowed(threshold: Fraction):
    """Whether sets of sizes n and m that differ in at least so many shingles may still link."""
    up, down = threshold.numerator, threshold.denominator
    return lambda differ, n, m: (differ * (down + up) <= (n + m) * (down - up)) & (np.minimum(n, m) * down >= np.maximum(n, m) * up)


def _dealt(lists: DataFrame, drawn: DataFrame, long: int) -> DataFrame:
    """Units to scan, each in one partition, with the sketches: whole lists, and each two blocks of a list of over `long` members.

    A list of m members is cut into k = m / long blocks by a hash of the set, so that each member is in k units. _side tells the blocks of a unit apart.
    """
    blocks = lists.groupBy("_key").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > long).select("_key", F.ceil(F.col("_m") / long).cast("int").alias("_k"))
    blocks = materialise(blocks, "jaccard-long")
    if blocks.isEmpty():
        rows = lists.withColumns({"_unit": F.lit(0), "_side": F.lit(0)})
    else:
        rows = lists.join(blocks, "_key", "left").withColumn("_side", F.when(F.col("_k").isNull(), 0).otherwise(F.pmod(F.xxhash64("_set"), F.col("_k")).cast("int")))
        pairs = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda j: F.least(j, F.col("_side")) * F.col("_k") + F.greatest(j, F.col("_side")))
        rows = rows.withColumn("_unit", F.explode(F.when(F.col("_k").isNull(), F.array(F.lit(0))).otherwise(pairs))).drop("_k")
    return rows.join(drawn, "_set").repartition("_key", "_unit").sortWithinPartitions("_key", "_unit", "_size", "_set")


def _scan(threshold: Fraction, forest: int):
    """Pairs of members of different components that the sketches allow, in each unit: all, or only what joins the components to trees.

    Which of several links joins two trees depends on forest, from 1 on; 0 stands for all pairs.
    """
    allowed = _allowed(threshold)
    salt = np.uint64(forest << 32)

    def pairs(sets: np.ndarray, sizes: np.ndarray, drawn: list[bytes], groups: np.ndarray, sides: np.ndarray) -> Iterator[tuple[int, int]]:
        root, n = np.unique(groups, return_inverse=True)[1], len(sets)
        left = int(root.max())
        across = sides.min() != sides.max()  # members of one block meet in a unit of their own
        reach = np.searchsorted(sizes, sizes * threshold.denominator // threshold.numerator, side="right")  # members come by size
        width, base = 0, 0
        for a in range(n - 1):
            if not left:  # one tree already
                break
            rest = np.arange(a + 1, reach[a])
            rest = rest[root[rest] != root[a]]
            if across:
                rest = rest[sides[rest] != sides[a]]
            if not len(rest):
                continue
            if len(drawn[a]) != width:  # of this width are a run of members; those beyond them are folded to it
                width, base = len(drawn[a]), a
                last = max(k for k in range(a, n) if len(drawn[k]) == width)
                held = folded(drawn[a : reach[last]], width)
            differ = np.bitwise_count(held[rest - base] ^ held[a - base]).sum(axis=1, dtype=np.int64)
            hits = rest[allowed(differ, sizes[a], sizes[rest])]
            if forest:
                hits = hits[np.argsort(mix(sets[hits].view(np.uint64) + salt))]
            for b in hits.tolist():
                if forest:
                    if root[a] == root[b]:
                        continue
                    root[root == root[b]] = root[a]
                    left -= 1
                yield int(sets[a]), int(sets[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole = whole if rest is None else pa.concat_tables([rest, whole]).combine_chunks()
            edges = units(whole)
            cut = edges[-2] if len(edges) > 1 else 0
            yield from lists(whole.slice(0, cut))
            rest = whole.slice(cut)
        if rest is not None:
            yield from lists(rest)

    def units(whole: pa.Table) -> list[int]:
        """Where units start, and the end."""
        keys, unit = (whole.column(c).to_numpy() for c in ("_key", "_unit"))
        return [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (unit[1:] != unit[:-1])) + 1).tolist(), len(keys)]

    def lists(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        if not whole.num_rows:
            return
        sides = whole.column("_side").to_numpy()
        sets, sizes = whole.column("_set").to_numpy(), whole.column("_size").to_numpy().astype(np.int64)
        groups = whole.column("_group").to_numpy()
        drawn = whole.column("_sketch").to_pylist()
        edges = units(whole)
        out: set[tuple[int, int]] = set()

        def told() -> pa.RecordBatch:
            ends = np.array(list(out), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["_a", "_b"])

        for at, to in zip(edges[:-1], edges[1:], strict=True):
            if to - at < 2:
                continue
            for a, b in pairs(sets[at:to], sizes[at:to], drawn[at:to], groups[at:to], sides[at:to]):
                out.add((min(a, b), max(a, b)))
                if len(out) >= HELD_PAIRS:
                    yield told()
                    out.clear()
        if out:
            yield told()

    return run


#: Pairs that a task holds before it sends them on.
HELD_PAIRS = 1 << 16
_PAIRS = "_a long, _b long"


def _check(pairs: DataFrame, docs: DataFrame, text: str, threshold: Fraction, n: int = SHINGLE) -> DataFrame:
    """_a, _b, _linked: each pair judged on the whole sets, which travel only for sets that are in a pair."""
    spark = docs.sparkSession
    ends = pairs.select(F.explode(F.array("_a", "_b")).alias("_set")).distinct()
    bits = np.zeros(1 << 21, np.uint8)  # 16 M flags: a first sieve of fixed size
    flags = ends.groupBy(F.expr("shiftrightunsigned(_set, 46)").alias("_cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(_set, 40) & 63 as int))")).alias("_word")
    )
    for cell, word in flags.collect():  # 2^18 cells at most, whatever the input
        bits[cell * 8 : cell * 8 + 8] = np.frombuffer((word & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little"), np.uint8)
    sieve = spark.sparkContext.broadcast(bits)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES):
                sets = Sets(part, text, n)
                own = _distinct(sets)
                own = own[passes(sieve.value, sets.ids[own]) & (sets.sizes[own] > 0)]
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sets.ids[own].view(np.int64)), pa.array([sets.of(k).tobytes() for k in own.tolist()], pa.binary())], names=["_set", "_shingles"]
                    )

    held = docs.mapInArrow(lean(wanted), "_set long, _shingles binary").join(ends, "_set", "left_semi")
    held = materialise(held.groupBy("_set").agg(F.max("_shingles").alias("_shingles")), "jaccard-sets")
    both = pairs.join(held.withColumnsRenamed({"_set": "_a", "_shingles": "_x"}), "_a").join(held.withColumnsRenamed({"_set": "_b", "_shingles": "_y"}), "_b")
    up, down = threshold.numerator, threshold.denominator

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("_x"), batch.column("_y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                joined = np.concatenate((x, y))
                joined.sort()
                same = int(np.count_nonzero(joined[1:] == joined[:-1]))
                linked.append(down * same >= up * (len(joined) - same))
            yield pa.RecordBatch.from_arrays([batch.column("_a"), batch.column("_b"), pa.array(linked, pa.bool_())], names=["_a", "_b", "_linked"])

    return materialise(both.mapInArrow(lean(judge), _PAIRS + ", _linked boolean"), "jaccard-checked")


def classes_of(docs: DataFrame, text: str = "text", n: int = SHINGLE) -> DataFrame:
    """doc_id, _row (a hash of the text), _set, _size of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES):
                sets = Sets(part, text, n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_row"), pa.array(sets.ids.view(np.int64)), pa.array(sets.sizes.astype(np.int64))], names=["doc_id", "_row", "_set", "_size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text, F.xxhash64(text).alias("_row")).mapInArrow(lean(run), f"doc_id {kind}, _row long, _set long, _size long")


def components(docs: DataFrame, text: str = "text", threshold: Fraction = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, over shingles of n words."""
    out = _labelled(docs, text, threshold, n)
    return out.select("doc_id", F.col("_size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _labelled(docs: DataFrame, text: str, threshold: Fraction, n: int) -> DataFrame:
    """doc_id, _row, _set, _size, component_id of every row; null for an empty set or a component without a doc_id."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col(text).alias("_text"))
    rows = materialise(classes_of(docs, "_text", n), "jaccard-classes")
    named = rows.filter("_size > 0").groupBy("_set", "_size").agg(F.min("doc_id").alias("_name"))
    sizes = {int(size): int(c) for size, c in named.groupBy("_size").agg(F.count(F.lit(1))).collect()}
    plan = Plan(sizes, threshold)
    lists, drawn = inverted_lists(docs, plan, "_text", n)
    checked = _check(materialise(_stars(lists, drawn, threshold), "jaccard-stars"), docs, "_text", threshold, n)
    links, failed = (checked.filter(x).select("_a", "_b") for x in ("_linked", "not _linked"))
    groups = connected(links).withColumnsRenamed({"id": "_set", "component": "_group"})
    for forest in (1, 2, 0):
        open_ = lists.join(groups, "_set", "left").withColumn("_group", F.coalesce("_group", "_set"))
        several = open_.groupBy("_key").agg(F.min("_group").alias("_x"), F.max("_group").alias("_y")).filter("_x < _y").select("_key")
        if forest != 1:  # only lists of a pair that failed can hold links that the trees don't tell
            ends = lists.join(failed.select(F.explode(F.array("_a", "_b")).alias("_set")).distinct(), "_set", "left_semi").select("_key").distinct()
            several = several.join(ends, "_key", "left_semi")
        open_ = materialise(open_.join(several, "_key", "left_semi"), "jaccard-open")
        if open_.isEmpty():
            break
        more = _dealt(open_, drawn, LONG).mapInArrow(lean(_scan(threshold, forest)), _PAIRS).distinct()
        if not forest:
            more = more.join(failed, ["_a", "_b"], "left_anti")
        checked = _check(materialise(more, "jaccard-pairs"), docs, "_text", threshold, n)
        found = checked.filter("_linked").select("_a", "_b")
        if not found.isEmpty():
            links = links.unionByName(found)
            groups = connected(links).withColumnsRenamed({"id": "_set", "component": "_group"})
        wrong = checked.filter("not _linked").select("_a", "_b")
        if wrong.isEmpty():
            break
        failed = wrong if forest == 1 else failed.unionByName(wrong).distinct()
    named = named.select("_set", "_name").join(groups, "_set", "left").withColumn("_group", F.coalesce("_group", "_set"))
    label = named.groupBy("_group").agg(F.min("_name").alias("component_id"))
    of_set = named.select("_set", "_group").join(label, "_group").select("_set", "component_id")
    return rows.join(of_set, "_set", "left")


def keep_one_of_each(docs: DataFrame, text: str = "text", threshold: Fraction = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id, or any where theirs is null.

    Rows are judged by doc_id and text: where a doc_id comes with several texts, each stays or goes by itself, and of equal rows all stay or all go.
    """
    found = _labelled(docs, text, threshold, n).filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    found = found.select(F.col("doc_id").alias("_gone_doc"), F.col("_row").alias("_gone_row")).distinct()
    rows = docs.select(bundled(docs, docs.columns).alias("_in"), F.col("doc_id").alias("_doc"), F.xxhash64(text).alias("_row"))
    kept = rows.join(found, (F.col("_row") == F.col("_gone_row")) & F.col("_doc").eqNullSafe(F.col("_gone_doc")), "left_anti")
    return kept.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def brute_force(docs: list[tuple], n: int = SHINGLE, threshold: Fraction = THRESHOLD) -> list[tuple]:
    """The digest rows by comparing all pairs, for tests."""
    import re

    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, min(len(words), 1)))})
    label = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if label[a] != label[b] and sets[a] and (both := len(sets[a] & sets[b])) * threshold.denominator >= threshold.numerator * (len(sets[a]) + len(sets[b]) - both):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    first: dict[int, int | None] = {}
    for (doc, _), x in zip(docs, label, strict=True):
        first[x] = min((d for d in (first.get(x), doc) if d is not None), default=None)
    return [(doc, len(s), first[x] if s else doc) for (doc, _), s, x in zip(docs, sets, label, strict=True)]
