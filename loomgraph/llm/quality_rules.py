"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a predicate over a document's measures. On a bounded sample (Cascade.sample_rows rows, a documented
parameter) the rules' cost and rejections are estimated; they then run in order of rejections, among what earlier
rules leave, per cost, and the first that rejects ends the cascade for that row. The order never changes which rows are kept.

Defined results: a null text has no words, so every measure is 0 and the row is rejected as too short; an empty
table gives no rows; every input column stays as it is, and a measure whose name an input column has already
takes its place only in the digest; repeated rows are judged one by one.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, bundled, materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """reject: from the names of the text and words columns to a predicate. Never null."""

    name: str
    reject: Callable[[Column, Column], Column]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACES, ""))


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def n_dup_lines(text: Column) -> Column:
    return _bind(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_stutters(words: Column) -> Column:
    """Words equal to the one before."""
    most = F.greatest(F.size(words) - 1, F.lit(0))
    return F.size(F.filter(F.zip_with(F.slice(words, 1, most), F.slice(words, 2, most), lambda a, b: a == b), lambda x: x))


def n_repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text.

    Windows are told apart by a 64-bit hash. Only a text with an equal pair sorts its windows; the covered words
    are then the union of [p, p + 8) over the sorted starts p.
    """
    n = F.size(words)
    hashes = F.when(
        n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    )

    def starts(s: Column) -> Column:
        last = F.size(s)
        same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
        twins = F.filter(
            F.sequence(F.lit(0), last - 1), lambda i: ((i > 0) & same(i, i - 1)) | ((i < last - 1) & same(i, i + 1))
        )
        return F.sort_array(F.transform(twins, lambda i: F.get(s, i)["i"]))

    covered = lambda p: F.aggregate(
        p,
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("at"), (a["n"] + F.least(F.lit(WINDOW), x - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    repeated = lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        _bind(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: covered(starts(s))),
    )
    return F.coalesce(_bind(hashes, repeated), F.lit(0))


#: The rules, from cheap to dear as declared; the cascade finds its own order.
BASE = (
    Rule("too_short", lambda text, words: F.size(words) < 20),
    Rule("repetitive", lambda text, words: 100 * n_repeat_words(words) > 30 * F.size(words)),
)
RULES = (
    Rule("symbols", lambda text, words: 10 * n_symbols(text) > F.size(words)),
    Rule("duplicate_lines", lambda text, words: 2 * n_dup_lines(text) > F.size(_lines(text))),
    Rule("stutter", lambda text, words: 100 * n_stutters(words) > 30 * F.size(words)),
    Rule("word_length", lambda text, words: (word_chars(text) < 2 * F.size(words)) | (word_chars(text) > 15 * F.size(words))),
)


@dataclass(frozen=True)
class Cascade:
    rules: tuple[Rule, ...] = BASE + RULES
    #: Bound of the sample that the order is estimated on; rows beyond it never change a verdict.
    sample_rows: int = 200
    #: Times that the sample is gone over to time a rule, so that the work outweighs the start of a job.
    laps: int = 8
    seed: int = 11

    def sample(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """About sample_rows texts, the same ones each time that the same files are read."""
        texts = docs.select(F.col(text).cast("string").alias("t"))
        share = min(1.0, 1.5 * self.sample_rows / max(docs.count(), 1))
        return materialise(texts.sample(fraction=share, seed=self.seed).limit(self.sample_rows), "rules-sample")

    def measure(self, docs: DataFrame, text: str = "text") -> tuple[list[float], list[tuple[frozenset[int], int]]]:
        """Seconds that each rule takes for the sample, without what a job takes that does nothing; which rules reject how many of its rows."""
        local = self.sample(docs, text).withColumn("w", words_of(F.col("t")))
        bits = [r.reject(F.col("t"), F.col("w")).alias(f"r{k}") for k, r in enumerate(self.rules)]
        found = local.select(*bits).groupBy(*[f"r{k}" for k in range(len(bits))]).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each combination of rules
        patterns = [(frozenset(k for k in range(len(bits)) if row[k]), row["n"]) for row in found]
        often = local.withColumn("lap", F.explode(F.sequence(F.lit(1), F.lit(self.laps))))

        def seconds(predicate: Column) -> float:
            took = []
            for _ in range(2):  # the first compiles
                began = time.perf_counter()
                often.agg(F.sum(predicate.cast("int"))).collect()
                took.append(time.perf_counter() - began)
            return min(took) / self.laps

        start = seconds(F.size("w") + F.col("lap") < 0)
        return [max(seconds(r.reject(F.col("t"), F.col("w"))) - start, 1e-6) for r in self.rules], patterns

    def ordered(self, docs: DataFrame, text: str = "text") -> list[Rule]:
        """Each time the rule that rejects most, per second, of what the rules before it leave; ties and rules that reject nothing go by cost, then name."""
        if len(self.rules) < 2:
            return list(self.rules)
        cost, patterns = self.measure(docs, text)
        left, out = set(range(len(self.rules))), []
        while left:
            gain = {k: sum(n for p, n in patterns if k in p) / cost[k] for k in left}
            best = min(left, key=lambda k: (-gain[k], cost[k], self.rules[k].name))
            out.append(self.rules[best])
            left.remove(best)
            patterns = [(p, n) for p, n in patterns if best not in p]
        return out


def judge(docs: DataFrame, cascade: Cascade | None = None, text: str = "text") -> DataFrame:
    """docs with _rejected_by: the first rule, in the cascade's order, that rejects the row, or null.

    An input column of that name is replaced. The words are bound inside the expression, so a filter on the verdict
    that Spark pushes down still splits a text once.
    """
    rules = (cascade := cascade or Cascade()).ordered(docs, text)

    def verdict(words: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(rule.reject(F.col(text), words), F.lit(rule.name)).otherwise(out)
        return out

    return docs.withColumn("_rejected_by", _bind(words_of(F.col(text)), verdict))


def keep_good(docs: DataFrame, cascade: Cascade | None = None, text: str = "text") -> DataFrame:
    rows = docs.select(bundled(docs, docs.columns).alias("_in"), F.col(text).alias("_text"))
    kept = judge(rows, cascade, "_text").filter(F.col("_rejected_by").isNull())
    return kept.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """The measures of every row, and the cascade's verdict over the rules beyond the base ones."""
    rows = judge(docs.select("doc_id", F.col("text").cast("string").alias("text")), Cascade(rules=RULES))
    rows = rows.withColumn("_words", words_of(F.col("text"))).select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        word_chars(F.col("text")).cast("long").alias("word_chars"),
        n_symbols(F.col("text")).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.col("_rejected_by").isNull().alias("_passed"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("_passed")).drop("_passed")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT rid, i, list_slice(w, i, i + 7) AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d)
), cov AS (
  SELECT rid, count(DISTINCT k) AS n FROM (
    SELECT rid, unnest(generate_series(i, i + 7)) AS k
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1) GROUP BY rid
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(generate_series(1, len(w) - 1), lambda i: w[i] = w[i + 1])) AS n_stutters
  FROM d LEFT JOIN cov USING (rid)
), b AS (
  SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stutters,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 100 * n_stutters > 30 * n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b
"""
