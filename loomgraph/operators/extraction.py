"""From chunks to entities and relationships: prompts, the extractor's seam, and strict reading of what it answers.

A model is a function from prompts to answers that a caller plugs in; its raw answers are a table of their own, so
a plan never asks twice. ReplayExtractor reads such a table; RuleExtractor finds indicators of compromise by pattern
and needs no model. Reading answers is column expressions, but for JSON repair, which is an Arrow function.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BEFORE, share, strip
from .quality import CHINESE, ENGLISH, INDICATORS

# Entity and relationship types, and which types a relationship may join.
ENTITY_TYPES = ["ThreatOrganization", "Target", "Report", "AttackEvent", "Tactic", "Technique", "Procedure", "Tool", "Asset"]
RELATIONSHIP_TYPES = ["BELONG", "LAUNCH", "ATTACK", "HAS", "USE"]
SCHEMA = [
    ("Report", "AttackEvent", "BELONG"), ("ThreatOrganization", "AttackEvent", "LAUNCH"), ("Technique", "Procedure", "LAUNCH"),
    ("AttackEvent", "Target", "ATTACK"), ("AttackEvent", "Tactic", "ATTACK"), ("AttackEvent", "Procedure", "ATTACK"),
    ("Tactic", "Technique", "HAS"), ("Procedure", "Tool", "USE"), ("Asset", "Procedure", "USE"),
]
MENU_WORDS = ["首页", "登录", "注册", "home", "about", "contact"]
DEFAULT_CONFIDENCE = 0.7


def schema_of(types: dict[str, dict[str, list[str]]]) -> list[tuple[str, str, str]]:
    """Every source type with every target type, for relationship types told as {name: {source, target}}."""
    return [(s, t, name) for name, told in types.items() for s in told["source"] for t in told["target"]]


# -- prompts ------------------------------------------------------------------------------------


def prompt_features(text: Column, content_type: Column | None = None) -> dict[str, Column]:
    zh, en = share(text, r"[\x{4e00}-\x{9fff}]"), share(text, "[a-zA-Z]")
    n = F.length(text)
    return {
        "table_guidance": (content_type == "table") if content_type is not None else F.lit(False),
        "lang_guidance": F.when(zh > 0.6, "zh").when(en > 0.6, "en").otherwise("mixed"),
        "length_guidance": F.when(n > 3000, "long").when(n < 500, "short").otherwise("none"),
        "technique_guidance": text.rlike(r"(?s)###\s+[^#\n]+?\s*\n.*?\*\*[^–]+?–\s*T\.?\d+"),
        "few_shot": F.when(zh > 0.5, "chinese").otherwise("english"),
    }


def build_prompt(text: Column, guidance: dict[str, str], entity_types: list[str] | None = None, relationships: dict[str, str] | None = None, examples: dict[str, str] | None = None) -> Column:
    """The prompt for each chunk. guidance and examples: texts by feature value."""
    told = prompt_features(text)
    vocabulary = "\n".join(f"- {x}" for x in entity_types or ENTITY_TYPES)
    relations = "\n".join(f"- {k}: {v}" if v else f"- {k}" for k, v in (relationships or dict.fromkeys(RELATIONSHIP_TYPES, "")).items())
    pick = lambda c, texts: F.coalesce(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])[c], F.lit("")) if texts else F.lit("")
    parts = [F.lit(vocabulary), F.lit(relations), pick(told["lang_guidance"], guidance), pick(told["length_guidance"], guidance), pick(told["few_shot"], examples or {}), text]
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "\n\n")


# -- the seam -----------------------------------------------------------------------------------


class ChunkExtractor(Protocol):
    def answers(self, chunks: DataFrame) -> DataFrame:
        """doc_id, chunk_id, response, status, error, attempts for each chunk."""


class CallError(Exception):
    """What went wrong with a call. kind: rate_limit, timeout, server, connection, bad_request or other."""

    def __init__(self, kind: str, message: str = ""):
        super().__init__(message or kind)
        self.kind = kind


def retries(error: Exception, done: int) -> bool:
    """Whether a call that failed after `done` retries is worth another: limits, time-outs, servers and connections always are, a bad
    request twice unless its content was refused, anything else if it speaks of a time-out."""
    kind = getattr(error, "kind", None) or ("timeout" if isinstance(error, TimeoutError) else "connection" if isinstance(error, ConnectionError) else "other")
    if kind == "bad_request":
        return done < 2 and "data_inspection_failed" not in str(error)
    return kind in ("rate_limit", "timeout", "server", "connection") or "timeout" in str(error).lower()


def delay(done: int, most: float = 60.0) -> float:
    """Seconds to wait before retry number done, from 0: 1, 2, 4 ... up to most."""
    return float(min(2**done, most))


class CallExtractor:
    """Asks a function once a chunk, again after an error that may pass (retries), up to `tries` times in all, waiting between; a chunk
    that fails is a row that says so. wait: what waits the seconds that delay gives, time.sleep unless tests pass another."""

    def __init__(self, ask: Callable[[str], str], tries: int = 3, wait: Callable[[float], None] = time.sleep):
        self.ask, self.tries, self.wait = ask, tries, wait

    def answers(self, chunks: DataFrame) -> DataFrame:
        ask, tries, wait = self.ask, self.tries, self.wait

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for doc, chunk, prompt in batch.itertuples(index=False):
                    response, error, used = None, None, 0
                    if prompt is None or not prompt.strip():
                        out.append((doc, chunk, None, "skipped", None, 0))
                        continue
                    while response is None and used < tries:
                        used += 1
                        try:
                            response, error = ask(prompt), None
                            break
                        except Exception as e:  # kept as the row's error
                            error = f"{type(e).__name__}: {e}"
                            if not retries(e, used - 1):
                                break
                            if used < tries:
                                wait(delay(used - 1))
                    out.append((doc, chunk, response, "success" if error is None else "failed", error, used))
                yield pd.DataFrame(out, columns=["doc_id", "chunk_id", "response", "status", "error", "attempts"])

        return chunks.select("doc_id", "chunk_id", "prompt").mapInPandas(run, "doc_id long, chunk_id long, response string, status string, error string, attempts int")


class ReplayExtractor:
    """Answers from a table of earlier ones (doc_id, chunk_id, response)."""

    def __init__(self, recorded: DataFrame):
        self.recorded = recorded

    def answers(self, chunks: DataFrame) -> DataFrame:
        held = self.recorded.select("doc_id", "chunk_id", "response")
        out = chunks.select("doc_id", "chunk_id").join(held, ["doc_id", "chunk_id"], "left")
        missing = F.col("response").isNull()
        return out.select(
            "doc_id", "chunk_id", "response", F.when(missing, "failed").otherwise("success").alias("status"), F.when(missing, "not recorded").alias("error"), F.lit(0).alias("attempts")
        )


IOC = {"ipv4": INDICATORS["ipv4"], "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "sha1": INDICATORS["sha1"], "md5": INDICATORS["md5"], "cve": INDICATORS["cve"]}


def iocs(chunks: DataFrame, key: list[str], text: str, kinds: dict[str, str] | None = None) -> DataFrame:
    """key, kind, value, n: indicators in each chunk and how often."""
    def of_kind(kind: str, pattern: str) -> Column:
        values = F.regexp_extract_all(F.col(text), F.lit(BEFORE + "(" + pattern + r")(?![\p{L}\p{N}_])"), F.lit(1))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    found = F.flatten(F.array(*[of_kind(k, p) for k, p in (kinds or IOC).items()]))
    rows = chunks.select(*key, F.explode(found).alias("e")).select(*key, "e.kind", "e.value")
    return rows.groupBy(*key, "kind", "value").agg(F.count(F.lit(1)).alias("n"))


class RuleExtractor:
    """Indicators as assets, each two that meet in a chunk (in order of kind and value) as a relationship."""

    def entities(self, chunks: DataFrame, key: list[str], text: str) -> DataFrame:
        found = iocs(chunks, key, text)
        return found.select(*key, F.concat_ws("--", "kind", F.lower("value")).alias("id"), F.col("kind").alias("type"), F.col("value").alias("name"), "n")

    def relationships(self, entities: DataFrame, key: list[str]) -> DataFrame:
        """Next to each entity the one that follows it in the chunk: a chain, so a chunk of n gives n - 1."""
        from pyspark.sql import Window

        w = Window.partitionBy(*key).orderBy("type", "name")
        out = entities.select(*key, F.col("id").alias("source"), F.lead("id").over(w).alias("target"), F.lit("USE").alias("type"))
        return out.filter("target is not null")


def failure_class(content: Column, response: Column) -> Column:
    low = F.lower(content)
    known = F.lit(0)
    for k in (*CHINESE, *ENGLISH):
        known = known + F.contains(low, F.lit(k.lower())).cast("int")
    menu = F.lit(0)
    for k in MENU_WORDS:
        menu = menu + F.contains(low, F.lit(k)).cast("int")
    formed = F.contains(response, F.lit('"entities"')) & F.contains(response, F.lit('"relationships"'))
    return (
        F.when(F.length(strip(content)) < 100, "too_short")
        .when(known < 2, "no_keywords")
        .when(menu >= 2, "navigation")
        .when(F.coalesce(F.length(strip(response)), F.lit(0)) < 10, "no_response")
        .when(~formed, "bad_format")
        .otherwise("not_parsed")
    )


def call_stats(answers: DataFrame) -> DataFrame:
    """One row of counters over a table of answers (status, attempts, input_tokens, output_tokens, duration)."""
    ok = F.count_if(F.col("status") == "success")
    return answers.agg(
        F.count(F.lit(1)).alias("total"), ok.alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.round(100.0 * F.try_divide(ok, F.count(F.lit(1))), 6).alias("success_rate"), F.round(F.avg(F.greatest(F.col("attempts") - 1, F.lit(0))), 6).alias("avg_retries"),
        F.round(F.avg("duration"), 6).alias("avg_duration"), F.sum(F.col("input_tokens") + F.col("output_tokens")).cast("long").alias("tokens"),
    )


# -- reading answers ----------------------------------------------------------------------------


def is_json_object(text: Column) -> Column:
    """Whether the whole text is one JSON object."""
    return F.coalesce(strip(text).rlike(r"(?s)^\{.*\}$") & F.try_parse_json(text).isNotNull(), F.lit(False))


def repair(text: str) -> str | None:
    """The first JSON object in an answer, with what models get wrong put right; null where that fails.

    Reads character by character and knows when it is inside a string, so values are never rewritten.
    """
    text = re.sub("[​-‏﻿]", "", re.sub(r"```(?:json)?", "", text))
    if (at := text.find("{")) < 0:
        return None
    out, stack, inside, escaped = [], [], False, False
    at -= 1
    while (at := at + 1) < len(text):
        c = text[at]
        if inside:
            if escaped:
                if c not in '"\\/bfnrtu':
                    out.append("\\")
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                inside = False
            elif c in "\n\r\t":
                c = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}[c]
            out.append(c)
            continue
        if c in "“”":
            c = '"'
        if c == '"':
            if out and out[-1] in '"}]' and stack:
                out.append(",")
            inside = True
        elif c in "{[":
            if out and out[-1] in '"}]' and stack:
                out.append(",")
            stack.append("}" if c == "{" else "]")
        elif c in "}]":
            if not stack or stack[-1] != c:
                continue  # one too many
            while out and (out[-1] == "," or out[-1].isspace()):
                out.pop()
            stack.pop()
        elif c not in ":,":
            if literal := re.compile(r"true|false|null|-?\d+(\.\d+)?([eE][+-]?\d+)?").match(text, at):
                out.append(literal[0])
                at += len(literal[0]) - 1
            continue  # white space, or a word that belongs to no value
        out.append(c)
        if not stack:
            break
    out += ['"'] if inside else []
    fixed = "".join(out + stack[::-1])
    try:
        return json.dumps(json.loads(fixed), ensure_ascii=False)
    except ValueError:
        return None


def repaired(text: Column) -> Column:
    """Answers as JSON, unchanged where they parse already."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else repair(t))

    return F.when(is_json_object(text), text).otherwise(run(text))


def parsed(text: Column, key: str | None = None, mend: Callable[[str], str | None] | None = None) -> Column:
    """An answer as a JSON object that has `key`, or {}: as it is, else as a second call mends it, else by the rules of repair.

    mend: the second call, which gets the broken answer; without one only the rules are tried. Null is {}.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str:
            for way in ([mend] if mend else []) + [lambda x: x, repair]:
                try:
                    out = way(t) if t is not None else None
                    held = json.loads(out) if out else None
                except Exception:  # the next way is tried
                    continue
                if isinstance(held, dict) and (key is None or key in held):
                    return out
            return "{}"

        return texts.map(one)

    whole = is_json_object(text)
    if key is not None:
        whole = whole & F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
    return F.when(whole, text).otherwise(run(text))


_FLAT = "id:string,name:string,labels:string,description:string,properties:struct<id:string,name:string,description:string>"


def entities_of(answers: DataFrame, response: str = "response") -> DataFrame:
    """ord, id, type, name, description of the entities that have labels, an id and a name, flat or under properties."""
    parsed = F.from_json(F.col(response), f"entities array<struct<{_FLAT}>>")
    rows = answers.select(*[c for c in answers.columns if c != response], F.posexplode(parsed["entities"]).alias("ord", "e"))
    rows = rows.select(
        *[c for c in rows.columns if c != "e"], F.coalesce("e.id", "e.properties.id").alias("id"), F.col("e.labels").alias("type"),
        F.coalesce("e.name", "e.properties.name").alias("name"), F.coalesce("e.description", "e.properties.description", F.lit("")).alias("description"),
    )
    return rows.filter("id is not null and type is not null and name is not null")


def confidence(raw: Column) -> Column:
    """A number from 0 to 1, to two places (half to even); else the default. raw: its JSON text."""
    value = F.when(raw.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), raw.try_cast("double"))
    return F.when((value >= 0) & (value <= 1), F.bround(value, 2)).otherwise(DEFAULT_CONFIDENCE)


def relationships_of(answers: DataFrame, response: str = "response") -> DataFrame:
    """ord, source, target, type, confidence, evidence of the relationships that have both ends and a type."""
    items = F.from_json(F.get_json_object(F.col(response), "$.relationships"), "array<string>")
    rows = answers.select(*[c for c in answers.columns if c != response], F.posexplode(items).alias("ord", "r"))
    get = lambda k: F.get_json_object("r", f"$.{k}")
    quoted = F.col("r").rlike(r'"confidence"\s*:\s*"')
    rows = rows.select(
        *[c for c in rows.columns if c != "r"], get("source").alias("source"), get("target").alias("target"), get("type").alias("type"),
        F.when(quoted, DEFAULT_CONFIDENCE).otherwise(F.coalesce(confidence(get("confidence")), F.lit(DEFAULT_CONFIDENCE))).alias("confidence"), F.coalesce(get("evidence"), F.lit("")).alias("evidence"),
    )
    return rows.filter("source is not null and target is not null and type is not null")


def merge_groups(text: Column) -> Column:
    """Lists of two or more whole numbers from 0; anything else in the answer is left out."""
    bare = F.regexp_replace(text, r"```(json)?", "")
    groups = F.from_json(bare, "array<array<string>>")
    whole = F.filter(groups, lambda g: (F.size(g) >= 2) & F.forall(g, lambda x: x.rlike(r"^\s*[0-9]+\s*$")))
    return F.transform(whole, lambda g: F.transform(g, lambda x: strip(x).cast("int")))


def qa_pairs_of(response: Column) -> Column:
    """question, answer, type, confidence of pairs whose question has 5 and answer 10 characters or more."""
    pairs = F.from_json(response, "qa_pairs array<struct<question:string,answer:string,type:string,confidence:double>>")["qa_pairs"]
    good = F.filter(pairs, lambda p: (F.length(strip(p["question"])) >= 5) & (F.length(strip(p["answer"])) >= 10))
    return F.transform(
        good,
        lambda p: F.struct(
            strip(p["question"]).alias("question"), strip(p["answer"]).alias("answer"),
            F.coalesce(p["type"], F.lit("factual")).alias("type"), F.coalesce(p["confidence"], F.lit(0.8)).alias("confidence"),
        ),
    )
