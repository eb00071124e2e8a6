"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a model file: a normaliser (white space marks, the dummy prefix), an arc for each piece, an arc for
each character without a piece that puts out its bytes, and a grammar over neighbouring pieces. For a byte-pair
model the grammar lets b follow a if merging would leave a and b apart; every other neighbour has infinite weight.
Composing with an input gives a lattice of arcs whose tropical shortest path, each arc weighing 1, is the encoding: with the
grammar exactly one path stays finite, the one that merging finds. Pieces whose scores tie in the
model, the runs of white space marks, merge after all others and from the left; they are put in last.

Texts are cut where no piece can cross (between characters that stand side by side in no piece), each distinct stretch is composed once per task, and all stretches of a
block are searched side by side, one position after another. The model file is read on the driver and its arrays
are broadcast; their size depends on the vocabulary alone. Nothing is shuffled.

Defined results: a null text has null ids and decodes to null, an empty text has none; a white space mark in the text itself
decodes to a space, which is the one case where the round trip is not exact; an id that is null or outside the vocabulary
decodes to a replacement character; repeated rows encode alike; other columns pass through;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, bound_batches, lean, ranges, slices, table, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_MARK = MARK.encode()
_BYTES, _CHECK = Rolling(51), Rolling(52)
PIECE_BYTES = 1 << 19
#: Stretches of text whose encoding a task remembers.
REMEMBERED = 1 << 19


# -- the model file -----------------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    bpe: bool
    prefix: bool

    @staticmethod
    def parse(data: bytes) -> ModelFile:
        pieces, bpe, prefix = [], False, True
        for field, value in _fields(data):
            if field == 1:
                told = dict(_fields(value))
                pieces.append((told.get(1, b"").decode(), float(np.frombuffer(told.get(2, bytes(4)), "<f4")[0]), told.get(3, 1)))
            elif field == 2:
                bpe = dict(_fields(value)).get(3, 1) == 2
            elif field == 3:
                told = dict(_fields(value))
                prefix = bool(told.get(3, 1))
                if told.get(2) or told.get(4, 1):
                    raise NotImplementedError("only the identity normaliser that keeps white space is compiled")
        if not bpe:
            raise NotImplementedError("only byte-pair models are compiled")
        return ModelFile(pieces, bpe, prefix)


NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def merge(symbols: list[str], score: dict[str, float], below: float | None = None) -> list[str]:
    """Byte-pair merging: the best score first, the leftmost of equals."""
    left, right = [k - 1 for k in range(len(symbols))], [k + 1 for k in range(len(symbols))]
    symbols = list(symbols)
    heap: list[tuple[float, int, int, str]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < len(symbols) and (text := symbols[a] + symbols[b]) in score and (below is None or score[text] > below):
            heapq.heappush(heap, (-score[text], a, b, text))

    for k in range(len(symbols) - 1):
        offer(k, k + 1)
    while heap:
        _, a, b, text = heapq.heappop(heap)
        if symbols[a] and symbols[b] and right[a] == b and symbols[a] + symbols[b] == text:
            symbols[a], symbols[b] = text, ""
            right[a] = right[b]
            if right[b] < len(symbols):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
    return [s for s in symbols if s]


class Table:
    """Open addressing from 64-bit keys to numbers, probed for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(int(len(keys)).bit_length() + 2, 4)
        size = 1 << self.bits
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        spot = self._spot(keys)
        self.steps = 0
        while len(left):
            self.steps += 1
            free = self.values[spot] < 0
            placed, first = np.unique(spot[free], return_index=True)
            taken = left[free][first]
            self.keys[placed], self.values[placed] = keys[taken], values[taken]
            stay = ~np.isin(left, taken)
            left, spot = left[stay], (spot[stay] + 1) & (size - 1)

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        spot = self._spot(keys)
        for _ in range(self.steps):
            held = self.values[spot]
            same = (self.keys[spot] == keys[open_]) & (held >= 0)
            out[open_[same]] = held[same]
            more = ~same & (held >= 0)
            if not more.any():
                break
            open_, spot = open_[more], (spot[more] + 1) & (len(self.keys) - 1)
        return out


class Transducer:
    """Arcs and grammar of a model. Tokens are numbered by merge order: 0 is a character without a piece, then single characters, then merges."""

    def __init__(self, model: bytes):
        file = ModelFile.parse(model)
        self.prefix = file.prefix
        usable = {text: (n, score) for n, (text, score, kind) in enumerate(file.pieces) if kind in (NORMAL, USER) and text}
        ties: dict[float, list[str]] = {}
        for text, (_, score) in usable.items():
            if len(text) > 1:
                ties.setdefault(score, []).append(text)
        late = {text for found in ties.values() if len(found) > 1 for text in found}
        if any(text.strip(MARK) for text in late) or any(MARK in text[1:] for text in usable if text not in late):
            raise NotImplementedError("tied scores, or marks inside pieces, other than runs of white space marks")
        self.late = {text: score for text, (_, score) in usable.items() if text in late}
        self.number = {text: n for text, (n, _) in usable.items()}
        single = sorted(text for text in usable if len(text) == 1)
        merged = sorted((text for text in usable if len(text) > 1 and text not in late), key=lambda x: -usable[x][1])
        score = {text: usable[text][1] for text in merged}
        order = {text: k + 1 for k, text in enumerate([*single, *merged])}
        split = {text: (text, text) for text in single}
        dead = set()
        for text in merged:
            parts = merge(list(text), score, below=score[text])
            if len(parts) == 2 and all(p in order for p in parts):
                split[text] = (parts[0], parts[1])
            else:
                split[text] = (text, text)
                dead.add(text)
        count = len(order) + 1
        self.left, self.right, self.out = (np.zeros(count, np.int64) for _ in range(3))
        for text, k in order.items():
            self.left[k], self.right[k], self.out[k] = order[split[text][0]], order[split[text][1]], usable[text][0]
        pairs = {(order[t[:k]], order[t[k:]]): order[t] for t in merged for k in range(1, len(t)) if t[:k] in order and t[k:] in order}
        self.pairs = Table(np.array([a << 32 | b for a, b in pairs], np.uint64), np.array(list(pairs.values()), np.int32))
        raw = [self._inner(t) for t in [*single, *merged] if t not in dead]
        kept = [order[t] for t in [*single, *merged] if t not in dead]
        self.longest = max(map(len, raw))
        self.arcs = Table(self._hash(raw), np.array(kept, np.int32))
        #: Whether some piece has a character that ends in the first byte before one that begins with the second: elsewhere no piece crosses.
        self.crossed = np.zeros((256, 256), bool)
        for text in (*merged, *self.late):
            for a, b in zip(text[:-1], text[1:], strict=True):
                self.crossed[self._inner(a)[-1], self._inner(b)[0]] = True
        self.byte = np.zeros(256, np.int32)
        for n, (text, _, kind) in enumerate(file.pieces):
            if kind == BYTE:
                self.byte[int(text[3:5], 16)] = n
        self.mark = self.number[MARK]
        self.pool = [b"" if k in (UNKNOWN, CONTROL, UNUSED) else bytes([int(t[3:5], 16)]) if k == BYTE else self._inner(t) for t, _, k in file.pieces]

    @staticmethod
    def _inner(text: str) -> bytes:
        return text.replace(MARK, " ").encode()

    @staticmethod
    def _hash(raw: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(x) for x in raw])
        return _BYTES.stretch(_BYTES.sums(data), np.concatenate(([0], ends[:-1])), ends)

    def apart_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves a and b apart when they stand side by side.

        Takes back the merges that made a and b, the latest first, and looks whether at some stage the parts at the
        seam would have merged before the ones taken back.
        """
        out = np.ones(len(a), bool)
        open_, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(open_):
            joined = self.pairs(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)).astype(np.int64)
            bad = (joined >= 0) & (joined < limit)
            out[open_[bad]] = False
            left, right = self.right[a], self.left[b]
            whole_a, whole_b = left == a, right == b
            step_a = ((a > b) & ~whole_a) | (whole_b & ~whole_a)
            step_b = ~step_a & ~whole_b
            limit = np.where(step_a, a, np.where(step_b, b + 1, limit))
            a, b = np.where(step_a, left, a), np.where(step_b, right, b)
            go = ~bad & (step_a | step_b)
            open_, a, b, limit = open_[go], a[go], b[go], limit[go]
        return out

    def lattice(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of the composition with each stretch: stretch, from, to (in data), token."""
        lengths = ends - starts
        spot = ranges(starts, lengths)
        word = np.repeat(np.arange(len(starts)), lengths)
        stop = ends[word]
        sums = _BYTES.sums(data)
        found = []
        for n in range(1, self.longest + 1):
            fits = spot + n <= stop
            spot, word, stop = spot[fits], word[fits], stop[fits]
            if not len(spot):
                break
            token = self.arcs(_BYTES.stretch(sums, spot, spot + n))
            some = token >= 0
            found.append((word[some], spot[some], spot[some] + n, token[some].astype(np.int64)))
        # characters without a piece of their own
        at = ranges(starts, lengths)
        at = at[(data[at] & 0xC0) != 0x80]
        lead = data[at]
        size = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        own = self.arcs(_BYTES.stretch(sums, at, at + size)) < 0
        at, size = at[own], size[own]
        found.append((np.searchsorted(starts, at, side="right") - 1, at, at + size, np.zeros(len(at), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def shortest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the stretches (end to end in data, in order), and how many each has."""
        word, left, right, token = self.lattice(data, starts, ends)
        order = np.argsort(left, kind="stable")
        word, left, right, token = word[order], left[order], right[order], token[order]
        depth = left - starts[word]
        cost = np.where(depth == 0, 1, np.iinfo(np.int32).max).astype(np.int32)
        back = np.full(len(left), -1, np.int64)
        open_ = np.flatnonzero(depth == 0)
        begin = np.searchsorted(left, np.arange(len(data) + 1))
        while len(open_):  # arcs reached in the last step lead on to the arcs that start where they end
            open_ = open_[right[open_] < ends[word[open_]]]
            low = begin[right[open_]]
            counts = begin[right[open_] + 1] - low
            after = ranges(low, counts)
            before = np.repeat(open_, counts)
            fits = self.apart_pairs(token[before], token[after])
            before, after = before[fits], after[fits]
            better = cost[before] + 1 < cost[after]
            before, after = before[better], after[better]
            cost[after], back[after] = cost[before] + 1, before
            open_ = np.unique(after)
        # walk back from the arc that ends each stretch
        final = np.flatnonzero((right == ends[word]) & (cost < np.iinfo(np.int32).max))
        best = final[np.lexsort((cost[final], word[final]))]
        best = best[np.concatenate((np.ones(min(len(best), 1), bool), word[best][1:] != word[best][:-1]))]
        if len(best) != len(starts):
            raise ValueError("a stretch without a path")
        chain = []
        at = best
        while len(at):
            chain.append(at)
            at = back[at]
            at = at[at >= 0]
        arcs = np.concatenate(chain) if chain else np.zeros(0, np.int64)
        arcs = np.sort(arcs)  # arcs lie in order of their start, so this is the order of the text
        return self._ids(data, word[arcs], left[arcs], right[arcs], token[arcs], len(starts))

    def _ids(self, data, word, left, right, token, words) -> tuple[np.ndarray, np.ndarray]:
        plain = token > 0
        sizes = np.where(plain, 1, right - left)
        out = np.repeat(self.out[token], sizes)
        spread = ranges(left[~plain], (right - left)[~plain])
        out[np.repeat(~plain, sizes)] = self.byte[data[spread]]
        counts = np.bincount(word, weights=sizes, minlength=words).astype(np.int64)
        return self._late(out, counts)

    def _late(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of white space marks, which only stand at the front of a stretch, merged last."""
        if not self.late:
            return ids, counts
        edges = np.concatenate(([0], np.cumsum(counts)))
        two = np.flatnonzero(counts > 1)
        two = two[(ids[edges[two]] == self.mark) & (ids[edges[two] + 1] == self.mark)]
        if not len(two):
            return ids, counts
        pieces, counts, at = [], counts.copy(), 0
        for k in two.tolist():
            a, b = int(edges[k]), int(edges[k + 1])
            n = int(np.argmax(np.append(ids[a:b] != self.mark, True)))
            runs = [self.number[x] for x in merge([MARK] * n, self.late)]
            pieces += [ids[at:a], np.array(runs, ids.dtype)]
            counts[k] += len(runs) - n
            at = a + n
        return np.concatenate([*pieces, ids[at:]]), counts


class Encoder:
    """Encodes blocks of texts, and remembers the stretches that it has seen."""

    def __init__(self, transducer: Transducer):
        self.fst = transducer
        self.forget()

    def forget(self) -> None:
        self.known = self.check = np.zeros(0, np.uint64)
        self.first, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        data, offsets = self._normal(data, offsets)
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        begin = np.zeros(n, bool)
        begin[0] = True
        begin[1:] = ~self.fst.crossed[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80)
        begin[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], n)
        keys, second = (h.stretch(h.sums(data), starts, ends) for h in (_BYTES, _CHECK))
        distinct, lead, which = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            self._learn(data, distinct[new], second[lead[new]], starts[lead[new]], ends[lead[new]])
            at = np.searchsorted(self.known, distinct)
        at = at[which]
        if np.array_equal(self.check[at], second):
            sizes = self.size[at]
            ids = self.pool[ranges(self.first[at], sizes)]
        else:  # two stretches of one hash: nothing remembered counts
            ids, sizes = self.fst.shortest(data, starts, ends)
        total = np.concatenate(([0], np.cumsum(sizes)))
        counts = np.diff(total[np.searchsorted(starts, offsets)])
        if len(self.known) > REMEMBERED:
            self.forget()
        return ids, counts

    def _normal(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """White space marks as spaces, and one in front of each text that isn't empty."""
        if len(data) > 2:
            marks = np.flatnonzero((data[:-2] == _MARK[0]) & (data[1:-1] == _MARK[1]) & (data[2:] == _MARK[2]))
            if len(marks):
                data, keep = data.copy(), np.ones(len(data), bool)
                data[marks] = 0x20
                keep[marks + 1] = keep[marks + 2] = False
                offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
                data = data[keep]
        if not self.fst.prefix:
            return data, offsets
        some = np.diff(offsets) > 0
        shift = np.concatenate(([0], np.cumsum(some)))
        out = np.full(len(data) + shift[-1], 0x20, np.uint8)
        out[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
        return out, offsets + shift

    def _learn(self, data: np.ndarray, keys: np.ndarray, second: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        own = data[ranges(starts, ends - starts)]
        till = np.cumsum(ends - starts)
        ids, counts = self.fst.shortest(own, np.concatenate(([0], till[:-1])), till)
        first = np.concatenate(([0], np.cumsum(counts)[:-1])) + len(self.pool)
        self.pool = np.concatenate((self.pool, ids.astype(np.int32)))
        known = np.concatenate((self.known, keys))
        order = np.argsort(known, kind="stable")
        self.known, self.check = known[order], np.concatenate((self.check, second))[order]
        self.first, self.size = np.concatenate((self.first, first))[order], np.concatenate((self.size, counts))[order]


class Decoder:
    """The text of lists of ids. An id outside the vocabulary, or null, is one replacement character."""

    def __init__(self, fst: Transducer):
        pool = [*fst.pool, "\ufffd".encode()]
        self.sizes, self.prefix = np.array([len(x) for x in pool]), fst.prefix
        self.first, self.data = np.concatenate(([0], np.cumsum(self.sizes)[:-1])), np.frombuffer(b"".join(pool), np.uint8)

    def __call__(self, held: pa.ListArray) -> pa.Array:
        last = len(self.sizes) - 1
        flat = held.flatten().cast(pa.int64()).fill_null(-1).to_numpy()
        flat = np.where((flat >= 0) & (flat < last), flat, last)
        counts = held.value_lengths().fill_null(0).to_numpy()
        raw = self.data[ranges(self.first[flat], self.sizes[flat])]
        till = np.concatenate(([0], np.cumsum(self.sizes[flat])))[np.concatenate(([0], np.cumsum(counts)))]
        texts = [
            None if null else raw[a + (self.prefix and b > a and raw[a] == 0x20) : b].tobytes().decode(errors="replace")
            for a, b, null in zip(till[:-1].tolist(), till[1:].tolist(), held.is_null().to_pylist(), strict=True)
        ]
        return pa.array(texts, pa.string())


def _broadcast(df: DataFrame, path: str):
    from pyspark import cloudpickle

    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Transducer(f.read())))


_IDS = T.ArrayType(T.IntegerType())


def encode(docs: DataFrame, path: str = MODEL, text: str = "text", into: str = "_ids", decoded: str | None = None) -> DataFrame:
    """docs with the piece ids of text added (or put in place of a column of that name). path: the model file, on the driver.

    decoded names a column for the text that the ids decode to, made in the same pass.
    """
    added = [T.StructField(into, _IDS), *([T.StructField(decoded, T.StringType())] if decoded else [])]
    docs = docs.drop(*[f.name for f in added])
    bound_batches(docs.sparkSession)
    model = _broadcast(docs, path)
    names = [*docs.columns, *[f.name for f in added]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import cloudpickle

        fst = cloudpickle.loads(model.value)
        encoder, decoder = Encoder(fst), Decoder(fst)
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES):
                ids, counts = encoder(*text_bytes(part, text))
                edges = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                null = part.column(text).is_null() if part.column(text).null_count else None
                lists = pa.ListArray.from_arrays(edges, pa.array(ids, pa.int32()), mask=null)
                yield pa.RecordBatch.from_arrays([*part.columns, lists, *([decoder(lists)] if decoded else [])], names=names)

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *added]))


def decode(rows: DataFrame, path: str = MODEL, ids: str = "_ids", into: str = "_decoded") -> DataFrame:
    """rows with the text of the ids added (or put in place of a column of that name); bytes that are no UTF-8 become replacement characters."""
    rows = rows.drop(into)
    model = _broadcast(rows, path)
    names = [*rows.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import cloudpickle

        decoder = Decoder(cloudpickle.loads(model.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, decoder(part.column(ids))], names=names)

    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())]))


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the comma-joined ids) and whether decoding gives the text back."""
    ids = F.coalesce(F.col("_ids"), F.array().cast("array<int>"))
    return rows.select(
        "doc_id", F.size(ids).cast("long").alias("n_pieces"), F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.col("text").eqNullSafe(F.col("_decoded")).alias("round_trip"),
    )


def query(spark, sf_dir: str, path: str = MODEL) -> DataFrame:
    return digest(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="_decoded"))
