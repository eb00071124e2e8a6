"""Substring dedup by seed and extend, over words.

Seeds are winnowed anchors: any two equal windows of `length` words have the same anchor at the same place. Runs
whose anchor occurs once are dropped by a filter of fixed size. The others are joined on their anchors: runs with
the same words on both sides, out to the ends of their windows, form a class; the classes of an anchor extend
against each other window by window, each with the number of its members, so a passage that a third of all
documents share is one row a class and never a list of pairs. Windows that occur twice or more, laid over the
text, make up the maximal repeats of at least `length` words, and every word under them goes.

An anchor with one class needs no windows: all or none of its members repeat. Windows are told apart by 64 bits within an anchor of 64 bits.

Defined results: a null text has no words and keeps none; a repeated row is a copy like any other, and as rows of
one doc_id and text are told apart by nothing, each gets the same result; a null doc_id is a document, told apart by 128 bits of its text; other
columns pass through untouched; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import Runs
from .common import SPACED, Rolling, ranges, table, text_bytes, word_spans
from .repeats import Classes, Found, covered, cut_texts, gathered, keyed

LENGTH = 35
GRAM = 10
_BYTES, _WORDS = Rolling(11), Rolling(12)


def _find(length: int):
    def find(part: pa.RecordBatch) -> Found:
        data, offsets = text_bytes(part, "_text")
        starts, ends, rows = word_spans(data, offsets, SPACED)
        words = _BYTES.stretch(_BYTES.sums(data), starts, ends)
        gram = max(min(GRAM, length), length - 62)
        runs = Runs(rows, length, gram, _WORDS.grams(words, gram))
        whole = _WORDS.stretch(_WORDS.sums(words), runs.first, runs.first + runs.count + length - 1)

        def windows(some: np.ndarray) -> pa.Array:
            edges = np.concatenate(([0], np.cumsum(runs.count[some])))
            found = _WORDS.grams(words, length)[ranges(runs.first[some], runs.count[some])]
            return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(found.view(np.int64)))

        return Found(runs, whole, windows, rows)

    return find


def repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """_doc, _tag, _runs: runs of windows, with a bit for each that repeats, of the texts that have any."""
    if length < 1:
        raise ValueError("a passage has a word at least")
    found = Classes(keyed(docs, text), _find(length), T.ArrayType(T.LongType()), "repeat-classes")
    content = found.open_content().groupBy("_anchor", "_class", "_content").agg(F.sum("_members").alias("_members"))
    open_ = content.select("_anchor", "_class", "_members", F.posexplode("_content").alias("_at", "_window"))
    counted = open_.groupBy("_anchor", "_window").agg(F.sum("_members").alias("_n")).filter("_n > 1").select("_anchor", "_window")
    partly = open_.filter("_members = 1").join(counted, ["_anchor", "_window"], "left_semi")
    partly = partly.groupBy("_class").agg(F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))
    masks = found.classes.filter("_members > 1").select("_class", F.lit(-1).cast("long").alias("_mask")).unionByName(partly)
    return gathered(found.resolved(masks))


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """docs with _n_words, _n_removed and _kept: the words that stay, joined by one space."""

    def cut(data: np.ndarray, offsets: np.ndarray, runs: pa.Array) -> list[pa.Array]:
        starts, ends, rows = word_spans(data, offsets, SPACED)
        gone = covered(runs, rows, length)
        before = np.concatenate(([0], np.cumsum(gone)))[rows]
        lengths = (ends - starts)[~gone] + 1
        joined = np.append(data, np.uint8(0))[ranges(starts[~gone], lengths)]
        till = np.concatenate(([0], np.cumsum(lengths)))
        joined[till[1:] - 1] = 0x20
        edge = till[rows - before]
        raw = joined.tobytes()
        kept = [raw[a : max(a, b - 1)].decode() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        return [pa.array(np.diff(rows)), pa.array(np.diff(before)), pa.array(kept, pa.string())]

    added = [T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType()), T.StructField("_kept", T.StringType())]
    return cut_texts(docs, repeats(docs, length, text), text, cut, added)


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT rid, k, md5(array_to_string(list_slice(w, k, k + {LENGTH - 1}), ' ')) AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - {LENGTH - 1})) AS k FROM d)
), hit AS (
  SELECT rid, k FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT rid, unnest(generate_series(k, k + {LENGTH - 1})) AS k FROM hit
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY k) AS t FROM (SELECT rid, unnest(w) AS x, unnest(generate_series(1, len(w))) AS k FROM d) ANTI JOIN gone USING (rid, k) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT rid, count(*) AS n FROM gone GROUP BY rid) USING (rid) LEFT JOIN kept USING (rid)
"""
