"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words of digits, letters and anything beyond ASCII. A pattern is a window
of n consecutive words of a benchmark item; an item of fewer words, but not none, is one pattern. Patterns of one
length m are searched together: a shift table over blocks of up to three words says how far the search may skip,
a block that ends a pattern has shift 0, its hash selects a bucket of patterns, and the words themselves are
compared. The text is cut into lanes that skip along side by side, so that each step is one array operation.

What is broadcast has a stated bound: the benchmark is taken in groups of at most group_chars characters, each in a
pass of its own over the documents; nothing grows with the documents and nothing is shuffled.

Defined results: a null text has no words and no hit; a null item text or id is no item; items that repeat an id
count once; equal windows of several items count for each of them; empty tables give no rows or no hits; every
input column passes through and one struct column is added under a name that the caller may set.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LETTERED, LOWER, Rolling, bound_batches, fresh, lean, materialise, ranges, slices, table, text_bytes, word_spans

WORDS = 10
BLOCK = 3
TABLE_BITS = 20
LANE = 256
#: Characters of benchmark text that one group of patterns may come from: some 60 bytes a word, so 200 MB of tables at most, or one item where that alone is longer.
GROUP_CHARS = 16 << 20

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))),
    ]
)
_ADDED_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]
)

_BYTES, _GRAMS = Rolling(101), Rolling(202)


class Words:
    """The words of a block of texts: bytes, spans, first word of each row, and a hash of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends, self.rows = word_spans(self.data, offsets, LETTERED)
        self.hashes = _BYTES.stretch(_BYTES.sums(self.data), self.starts, self.ends)

    def window(self, at: int, n: int) -> tuple[bytes, ...]:
        return tuple(self.data[self.starts[k] : self.ends[k]].tobytes() for k in range(at, at + n))


def _words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    found = Words(data, np.array([0, len(data)]))
    return list(found.window(0, len(found.starts)))


class Patterns:
    """Shift table, suffix buckets and the windows themselves, as places in the words of the items, for patterns of m words."""

    def __init__(self, m: int, held: Words, first: np.ndarray, items: np.ndarray):
        """held: the items' words; first: where each distinct window starts in them; items: (window, item) pairs in order of the window."""
        self.m, self.block, self.held, self.first = m, min(BLOCK, m), held, first
        self.edges, self.items = np.searchsorted(items[:, 0], np.arange(len(first) + 1)), items[:, 1]
        hashes = held.hashes[first[:, None] + np.arange(m)]
        self.shift = np.full(1 << TABLE_BITS, m - self.block + 1, np.uint8 if m < 250 else np.int64)
        for end in range(self.block, m + 1):
            last = blocks(hashes[:, end - self.block : end])
            np.minimum.at(self.shift, slot(last), m - end)
        order = np.argsort(last, kind="stable")
        self.suffix, self.which = last[order], order

    def items_of(self, pattern: int) -> np.ndarray:
        return self.items[self.edges[pattern] : self.edges[pattern + 1]]

    def search(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of each occurrence inside one row."""
        m, n = self.m, len(words.hashes)
        if n < m:
            return
        ending = blocks(np.lib.stride_tricks.sliding_window_view(words.hashes, self.block))  # at k: the block that ends at word k + block - 1
        slots = slot(ending)
        skip, back = self.shift, self.block - 1
        at = np.arange(m - 1, n, LANE)
        stop = np.minimum(at + LANE, n)
        zero = []
        while len(at):
            step = skip[slots[at - back]]
            zero.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.sort(np.concatenate(zero))
        first = ends - (m - 1)
        whole = np.searchsorted(words.rows, first, side="right") == np.searchsorted(words.rows, ends, side="right")
        ends, first = ends[whole], first[whole]
        low = np.searchsorted(self.suffix, ending[ends - back], side="left")
        high = np.searchsorted(self.suffix, ending[ends - back], side="right")
        for k in range(int((high - low).max(initial=0))):  # k-th pattern of each bucket
            some = low + k < high
            start, pattern = first[some], self.which[low[some] + k]
            for j in range(m):
                same = words.hashes[start + j] == self.held.hashes[self.first[pattern] + j]
                start, pattern = start[same], pattern[same]
            for s, p in zip(start.tolist(), pattern.tolist(), strict=True):
                if words.window(s, m) == self.held.window(int(self.first[p]), m):
                    yield s, p


def blocks(hashes: np.ndarray) -> np.ndarray:
    """Hash of each row of a few word hashes."""
    out = np.zeros(len(hashes), np.uint64)
    for k in range(hashes.shape[1]):
        out = (out ^ hashes[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def slot(block: np.ndarray) -> np.ndarray:
    return (block >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def compile_patterns(items: list[tuple[str, str]], n: int = WORDS) -> tuple[list[str], list[Patterns]]:
    """The distinct item ids in order, and the patterns of each length."""
    names = sorted({item for item, _ in items})
    number = {item: k for k, item in enumerate(names)}
    raw = [text.encode() for _, text in items]
    held = Words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64))))
    owner, counts = np.array([number[item] for item, _ in items], np.int64), np.diff(held.rows)
    sums, out = _GRAMS.sums(held.hashes), []
    for m in sorted(set(np.minimum(counts, n).tolist()) - {0}):
        rows = np.flatnonzero(np.minimum(counts, n) == m)
        windows = counts[rows] - m + 1
        start, item = ranges(held.rows[rows], windows), np.repeat(owner[rows], windows)
        _, lead, which = np.unique(_GRAMS.stretch(sums, start, start + m), return_index=True, return_inverse=True)
        odd = np.zeros(len(start), bool)  # windows that share a hash but not the words stand for themselves
        for j in range(m):
            odd |= held.hashes[start + j] != held.hashes[start[lead][which] + j]
        which[odd] = len(lead) + np.arange(int(odd.sum()))
        out.append(Patterns(m, held, np.concatenate((start[lead], start[odd])), np.unique(np.stack((which, item), 1), axis=0)))
    return names, out


def item_groups(items: DataFrame, group_chars: int = GROUP_CHARS) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in groups of bounded size, read one partition at a time."""
    group, chars = [], 0
    rows = items.select(F.col("item_id").cast("string"), "text").filter("item_id is not null and text is not null")
    for item, text in rows.toLocalIterator():
        if group and chars + len(text) > group_chars:
            yield group
            group, chars = [], 0
        group.append((item, text))
        chars += len(text)
    if group:
        yield group


def find(docs: DataFrame, items: DataFrame, n: int = WORDS, text: str = "text", into: str = "_contamination") -> DataFrame:
    """docs with a struct added (or put in place of one of that name): n_words, n_hit, the items whose windows occur, and the runs of hit words.

    A benchmark of several groups takes a pass for each, whose findings the next one adds to; between passes the rows are written to the
    shared folder and the group's broadcast is destroyed, so that no worker ever holds more than one group.
    """
    docs = docs.drop(into)
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    shared = None
    for group in itertools.chain(item_groups(items), [None]):
        if group is None and shared is not None:
            break
        if shared is not None:
            docs = materialise(docs, "contamination")
            shared.destroy()
        shared = context.broadcast(cloudpickle.dumps(compile_patterns(group or [], n)))
        docs = _search(docs, shared, text, into)
    return docs


def _search(docs: DataFrame, shared: Broadcast, text: str, into: str) -> DataFrame:
    """One pass with one group, on top of what earlier ones have found."""
    found = into in docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, compiled = cloudpickle.loads(shared.value)
        for whole in batches:
            for batch in slices(whole, text):
                words = Words(*text_bytes(batch, text))
                cover = np.zeros(len(words.starts) + 1, np.int32)
                items: dict[int, set[str]] = {}
                if found:
                    for row, before in enumerate(batch.column(into).to_pylist()):
                        for run in before["spans"]:
                            cover[words.rows[row] + run["from"]] += 1
                            cover[words.rows[row] + run["to"]] -= 1
                        items[row] = set(before["items"])
                for patterns in compiled:
                    for start, p in patterns.search(words):
                        cover[start] += 1
                        cover[start + patterns.m] -= 1
                        row = int(np.searchsorted(words.rows, start, side="right")) - 1
                        items.setdefault(row, set()).update(names[k] for k in patterns.items_of(p))
                hit = np.cumsum(cover[:-1]) > 0
                before = np.concatenate(([0], np.cumsum(hit)))[words.rows]
                counts, hits = np.diff(words.rows), np.diff(before)
                rows = [
                    {"n_words": c, "n_hit": h, "items": sorted(items.get(r, ())), "spans": _runs(hit[words.rows[r] : words.rows[r + 1]]) if h else []}
                    for r, (c, h) in enumerate(zip(counts.tolist(), hits.tolist(), strict=True))
                ]
                kept = [c for c in batch.schema.names if c != into]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(rows, _ADDED_ARROW)], names=[*kept, into])

    rest = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(lean(scan), T.StructType([*rest, T.StructField(into, ADDED)]))


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"from": a, "to": b} for a, b in edges.reshape(-1, 2).tolist()]


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WORDS, text: str = "text") -> DataFrame:
    """docs without the rows that hold a window of an item."""
    into = fresh(docs, "_contamination")
    return find(docs, items, n, text, into).filter(F.col(f"{into}.n_hit") == 0).drop(into)


def query(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("_contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple], items: list[tuple], n: int = WORDS) -> list[tuple]:
    """The digest rows by comparing every window, for tests."""
    split = lambda t: [w.decode() for w in _words(t)] if t else []
    wanted: dict[tuple, set[str]] = {}
    for item, text in items:
        words = split(text)
        m = min(n, len(words))
        for k in range(len(words) - m + 1 if m and item is not None else 0):
            wanted.setdefault(tuple(words[k : k + m]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for m in {len(w) for w in wanted}:
            for k in range(len(words) - m + 1):
                if (w := tuple(words[k : k + m])) in wanted:
                    hit.update(range(k, k + m))
                    found |= wanted[w]
        told = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), told, bool(hit)))
    return out


_SPLIT_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"
SQL = rf"""
WITH i AS (
  SELECT item_id, {_SPLIT_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL
), p AS (
  SELECT DISTINCT item_id, m, list_slice(w, k, k + m - 1) AS g
  FROM (SELECT item_id, w, least({WORDS}, len(w)) AS m, unnest(generate_series(1, len(w) - least({WORDS}, len(w)) + 1)) AS k FROM i WHERE len(w) > 0)
), d AS (
  SELECT doc_id, row_number() OVER () AS rid, {_SPLIT_SQL} AS w FROM documents
), win AS (
  SELECT rid, m, k, list_slice(w, k, k + m - 1) AS g
  FROM (SELECT rid, w, m, unnest(generate_series(1, len(w) - m + 1)) AS k FROM d, (SELECT DISTINCT m FROM p))
), hit AS (
  SELECT rid, item_id, k, win.m FROM win JOIN p USING (m, g)
), c AS (
  SELECT rid, count(DISTINCT x) AS n FROM (SELECT rid, unnest(generate_series(k, k + m - 1)) AS x FROM hit) GROUP BY rid
), t AS (
  SELECT rid, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""
