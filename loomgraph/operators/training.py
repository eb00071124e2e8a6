"""Question-answer pairs, training samples, augmentation and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .extraction import is_json_object

# Replacements, prefixes and suffixes for augmentation, texts that hold nothing to extract.
SYNONYMS = {
    "攻击": ["入侵", "侵犯", "打击", "进犯", "袭击"],
    "组织": ["团伙", "集团", "机构", "团体", "势力"],
    "漏洞": ["缺陷", "弱点", "破绽", "瑕疵", "隐患"],
    "恶意": ["有害", "不良", "危险", "破坏性"],
    "软件": ["程序", "应用", "系统", "工具"],
    "网络": ["互联网", "因特网", "在线", "联网"],
    "attack": ["infiltration", "assault", "strike", "breach"],
    "organization": ["group", "team", "entity", "faction"],
    "vulnerability": ["weakness", "flaw", "gap", "loophole"],
    "malicious": ["harmful", "dangerous", "hostile", "destructive"],
    "software": ["program", "application", "tool", "system"],
    "network": ["internet", "web", "online", "cyber"],
}
PREFIXES = [
    "根据报告，", "资料显示，", "据分析，", "研究表明，",
    "Based on the report, ", "According to the analysis, ", "As shown in the data, ", "Research indicates that ",
]
SUFFIXES = [
    "这是重要的安全信息。", "需要引起关注。", "具有重要参考价值。",
    "This is important security information.", "This requires attention.", "It has important reference value.",
]
NOTHING = '{"entities":[],"relationships":[]}'
EMPTY_INPUTS = [
    "今天天气很好，阳光明媚。", "The weather is nice today.", "用户登录系统，查看了个人资料页面。",
    "用户在系统中浏览了产品信息。", "The user browsed product information in the system.", "他正在阅读一篇关于科技发展的文章。",
]
SYSTEM = "Extract entities and relationships from the text. Answer with one JSON object."


def turn_pairs(turns: DataFrame) -> DataFrame:
    """conv_id, turn, question, answer: each user turn with the assistant turn right after it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    out = turns.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("text").over(w).alias("answer"), F.lead("role").over(w).alias("_next"))
    return out.filter("role = 'user' and _next = 'assistant'").drop("role", "_next")


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs long enough, stripped, with the id chunk_{i}_qa_{j} by place after the check."""
    out = pairs.withColumn("question", strip(F.col("question"))).withColumn("answer", strip(F.col("answer")))
    out = out.filter((F.length("question") >= 5) & (F.length("answer") >= 10))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return out.withColumn("id", F.concat(F.lit("chunk_"), F.col("conv_id").cast("string"), F.lit("_qa_"), place.cast("string")))


def qa_status(content: Column, response: Column) -> Column:
    return F.when(F.length(strip(content)) < 50, "skipped").when(response.isNull(), "failed").otherwise("success")


def qa_prompt(content: Column, pairs: int = 3, language: str = "en") -> Column:
    ask = {"zh": "请用中文回答。", "en": "Answer in English."}.get(language, "Answer in the language of the text.")
    return F.format_string(f"Write {pairs} question-answer pairs about the text as JSON with qa_pairs. {ask}\n\n%s", content)


def qa_summary(results: DataFrame) -> DataFrame:
    """One row over results (status, qa_pairs: array of struct<type, confidence>); failed counts what was skipped, too."""
    per = results.select("status", F.when(F.col("status") == "success", F.col("qa_pairs")).alias("p"))
    pairs = per.select(F.explode("p").alias("p")).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("p.confidence"), 3).alias("avg_confidence"))
    ok = F.count_if(F.col("status") == "success")
    whole = per.agg(F.count(F.lit(1)).alias("total"), ok.alias("success"), (F.count(F.lit(1)) - ok).alias("failed"), F.round(100.0 * F.try_divide(ok, F.count(F.lit(1))), 2).alias("success_rate"))
    out = whole.join(pairs)
    return out.withColumn("avg_per_chunk", F.round(F.coalesce(F.try_divide("pairs", "success"), F.lit(0.0)), 2))


def chat_text(system: Column | str, user: Column, assistant: Column) -> Column:
    part = lambda role, c: [F.lit(f"<|im_start|>{role}\n"), c if isinstance(c, Column) else F.lit(c), F.lit("<|im_end|>")]
    return F.concat(*part("system", system), F.lit("\n"), *part("user", user), F.lit("\n"), *part("assistant", assistant))


def samples(chunks: DataFrame, entities: DataFrame, edges: DataFrame, key: str = "chunk_id") -> DataFrame:
    """key, n_entities, n_relationships, input, output: what was extracted from each chunk with content, as JSON."""
    listed = lambda df, fields: df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("_l"))
    ents = listed(entities.withColumn("labels", F.col("type")), ["labels", "id", "name"]).withColumnRenamed("_l", "entities")
    rels = listed(edges, ["type", "source", "target"]).withColumnRenamed("_l", "relationships")
    out = chunks.filter(strip(F.col("content")) != "").join(ents, key).join(rels, key, "left")
    none = F.from_json(F.lit("[]"), "array<struct<type:string,source:string,target:string>>")
    out = out.withColumn("relationships", F.coalesce("relationships", none))
    answer = F.to_json(F.struct("entities", "relationships"))
    return out.select(key, F.size("entities").cast("long").alias("n_entities"), F.size("relationships").cast("long").alias("n_relationships"), F.col("content").alias("input"), answer.alias("output"))


def first_replaced(text: Column, old: Column, new: Column) -> Column:
    at = F.instr(text, old)
    return F.when(at == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(old), F.length(text))))


def _draw(seed: int, salt: str, key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), key), F.lit(n)).cast("int")


def augment(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """kind, input, output: the samples and variants of about 30 % by synonyms, 15 % by order of sentences, 15 % by prefix and suffix,
    each drawn by a seeded hash of its key, and the texts that hold nothing."""
    k = F.col(key)
    old = F.array(*[F.lit(w) for w in SYNONYMS])
    new = F.array(*[F.array(*[F.lit(x) for x in v]) for v in SYNONYMS.values()])
    text = F.col("input")
    for n in range(3):
        word = _draw(seed, f"word{n}", k, len(SYNONYMS))
        options = F.get(new, word)
        swapped = first_replaced(text, F.get(old, word), F.get(options, F.pmod(F.xxhash64(F.lit(seed + n), k), F.size(options).cast("long")).cast("int")))
        text = F.when(_draw(seed, "times", k, 3) >= n, swapped).otherwise(text)
    chosen = lambda salt, share: _draw(seed, salt, k, 1000) < int(1000 * share)
    out = [rows.select(F.lit("original").alias("kind"), "input", "output"), rows.filter(chosen("synonym", 0.3)).select(F.lit("synonym").alias("kind"), text.alias("input"), "output")]
    parts = F.filter(F.transform(F.split("input", "[.。!?！？;；]"), strip), lambda s: s != "")
    mixed = F.transform(F.array_sort(F.transform(parts, lambda s: F.struct(F.xxhash64(F.lit(seed), s).alias("h"), s.alias("s")))), lambda x: x["s"])
    shuffled = F.concat(F.array_join(mixed, ""), F.when(F.col("input").rlike("[.。!?！？;；]$"), "。").otherwise(""))
    out.append(rows.filter(chosen("order", 0.15) & (F.size(parts) > 2)).select(F.lit("order").alias("kind"), shuffled.alias("input"), "output"))
    for kind, options in (("prefix", PREFIXES), ("suffix", SUFFIXES)):
        listed = F.array(*[F.lit(x) for x in options])
        for n in range(2):
            added = F.get(listed, _draw(seed, f"{kind}{n}", k, len(options)))
            both = F.concat(added, F.col("input")) if kind == "prefix" else F.concat(F.col("input"), added)
            out.append(rows.filter(chosen("affix", 0.15)).select(F.lit(kind).alias("kind"), both.alias("input"), "output"))
    spark = rows.sparkSession
    out.append(spark.createDataFrame([("empty", x, NOTHING) for x in EMPTY_INPUTS], "kind string, input string, output string"))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def evaluation(answers: DataFrame, response: str = "response", baseline: float = 0.65) -> DataFrame:
    """One row of counters over answers: how many parse, have and fill entities and relationships, and averages over all rows."""
    ok = is_json_object(F.col(response))
    text = F.when(ok, F.col(response))
    size = lambda name: F.size(F.from_json(F.get_json_object(text, f"$.{name}"), "array<string>"))
    rows = answers.select(ok.alias("ok"), F.coalesce(size("entities"), F.lit(-1)).alias("e"), F.coalesce(size("relationships"), F.lit(-1)).alias("r"))
    total, n = F.count(F.lit(1)), F.count_if(F.col("ok"))
    rate = F.coalesce(F.try_divide(n, total), F.lit(0.0))
    count = lambda c: F.sum(F.greatest(F.col(c), F.lit(0))).cast("long")
    return rows.agg(
        total.alias("total"), n.alias("parsed"), F.round(rate, 6).alias("rate"), F.round(rate - baseline, 6).alias("over_baseline"),
        F.count_if(F.col("e") >= 0).alias("has_entities"), F.count_if(F.col("e") > 0).alias("with_entities"),
        F.count_if(F.col("r") >= 0).alias("has_relationships"), F.count_if(F.col("r") > 0).alias("with_relationships"),
        F.round(F.try_divide(count("e"), total), 6).alias("avg_entities"), F.round(F.try_divide(count("r"), total), 6).alias("avg_relationships"),
    )


def type_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(column), F.lit("Unknown")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


def report(counts: DataFrame, title: str) -> str:
    """A listing of counts (type, n), largest first; the counts are a row for each type."""
    rows = counts.orderBy(F.col("n").desc(), "type").collect()
    return "\n".join([title, *(f"{r.type}: {r.n}" for r in rows)])
