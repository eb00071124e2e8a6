"""Rule-based quality of text chunks: detectors, score, verdict, selection and analysis of what was selected.

All are column expressions over one text column, so a plan scores chunks in a single pass without a shuffle; only
top-k selection shuffles, by the group that it ranks in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import AFTER, BEFORE, LINK, count, filled_lines, lines, share, shortened, strip, words

# Security keywords. Those that stand twice count twice.
CHINESE = """
APT 攻击 威胁 恶意 漏洞 病毒 木马 后门 钓鱼 间谍 渗透 入侵 组织 活动 技术 战术 工具 流程 样本 分析 检测 防御 响应 情报
黑客 网络 安全 数据 泄露 勒索 软件 恶意代码 僵尸网络 命令控制 横向移动 权限提升 持久化 数据收集 数据窃取 破坏 影响 目标 受害者
载荷 投递 执行 通信 隐蔽 伪装 绕过 规避 监控 日志
""".split()
ENGLISH = """
attack threat malicious malware vulnerability exploit backdoor trojan virus phishing spear espionage
infiltration penetration intrusion breach compromise payload C2 command control RAT botnet dropper
loader downloader implant backdoor rootkit keylogger stealer ransomware wiper cryptor packer obfuscator
reconnaissance initial access execution persistence privilege escalation defense evasion credential
discovery lateral movement collection exfiltration impact command control communication
actor group campaign operation mission target victim infrastructure domain IP hash indicator
IOC TTPs tactics techniques procedures tools sample binary executable script shellcode injection
hooking hijacking spoofing masquerading living fileless memory registry process service task
scheduled startup autostart persistence steganography network protocol traffic packet connection session
tunnel proxy gateway firewall IDS IPS SIEM endpoint host server client browser email
analysis forensic investigation detection hunting monitoring logging signature rule alert event
intelligence attribution clustering correlation
""".split()
# Lines of a menu, signs of product lists, marketing, table keywords, technical indicators.
MENU_LINE = r"^([+*-]\s*" + LINK + r"|" + LINK + r"\s*$)"
PRODUCT_SIGNS = [r"Products?\s*$", r"Services?\s*$", r"Solutions?\s*$", r"Learn more", r"Explore solutions", r"Free Tools"]
MARKETING = [
    r"Contact.*sales", r"Talk to sales", r"Get.*assistance", r"Join.*Club", r"Subscribe",
    r"fill.*form", r"representative.*contact", r"24/7.*response", r"Learn more", r"Explore.*solutions",
]
TABLE_KEYWORDS = ["APT", "组织", "攻击", "技术", "工具", "样本", "家族", "group", "actor", "family", "campaign", "hash", "domain", "IP"]
INDICATORS = {
    "md5": r"[a-fA-F0-9]{32}",
    "sha1": r"[a-fA-F0-9]{40}",
    "sha256": r"[a-fA-F0-9]{64}",
    "ipv4": r"(?:\d{1,3}\.){3}\d{1,3}",
    "domain": r"[a-zA-Z0-9][a-zA-Z0-9-]*\.[a-zA-Z]{2,}",
    "cve": r"CVE-\d{4}-\d{4,}",
    "technique": r"T\d{4}(?:\.\d{3})?",
    "hex": r"0x[a-fA-F0-9]+",
}


def _flags(*conditions: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions])


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, also inside conditions, where Spark shares no subexpressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_navigation(text: Column) -> Column:
    def told(filled: Column, links: Column) -> Column:
        menu = F.size(F.filter(filled, lambda x: x.rlike(MENU_LINE)))
        signs = F.aggregate(filled, F.lit(0), lambda n, x: n + _flags(*[x.rlike("(?i)" + p) for p in PRODUCT_SIGNS]))
        return (F.size(filled) > 0) & ((links > 0.6 * F.size(filled)) | (menu > 8) | ((links > 5) & (signs >= 2)))

    return _bind(F.struct(filled_lines(text).alias("f"), count(text, LINK).alias("l")), lambda x: told(x["f"], x["l"]))


def is_marketing(text: Column) -> Column:
    return _flags(*[text.rlike("(?i)" + p) for p in MARKETING]) >= 2


def is_garbled(text: Column) -> Column:
    n = F.length(text)
    sparse = (n > 100) & (20 * count(text, " ") < n) & (50 * count(text, r'[.,;:!?()\[\]{}"]') < n)
    return text.rlike("[a-zA-Z0-9+/=]{50,}") | sparse


def is_title_only(text: Column) -> Column:
    bare = strip(text)
    shaped = bare.rlike(r"(?m)^#+\s+") | bare.rlike(r"(?m)^.*\n[-=]+$") | bare.rlike(r"(?m)^\s*[A-Z][^.!?]*$")
    return (F.size(filled_lines(text)) <= 2) & (shaped | ((F.length(bare) < 100) & ~F.contains(bare, F.lit("."))))


def language_points(text: Column) -> Column:
    poor = (share(text, r"[\x{4e00}-\x{9fff}]") < 0.1) & (share(text, "[a-zA-Z]") < 0.3)
    return F.when(F.length(text) == 0, -30).when(poor, -25).when(share(text, r"[0-9|\-+.\s]") > 0.6, -15).otherwise(0)


def keyword_count(text: Column, english: list[str] | None = None, chinese: list[str] | None = None) -> Column:
    """English ones as whole words, Chinese ones anywhere. A list that is given counts its repeats, too."""
    english, chinese = ENGLISH if english is None else english, CHINESE if chinese is None else chinese
    single = sorted({k.lower() for k in english})
    again = [k.lower() for n, k in enumerate(english) if k.lower() in [x.lower() for x in english[:n]]]
    listed = [x for x in (single, again) if x]

    def told(low: Column) -> Column:
        out = F.lit(0)
        if chinese:
            flags = _flags(*[F.contains(low, F.lit(k.lower())) for k in chinese])
            apart = all(any("\u4e00" <= c <= "\u9fff" for c in k) for k in chinese)
            out = F.when(low.rlike(r"[\x{4e00}-\x{9fff}]"), flags).otherwise(0) if apart else flags
        if listed:
            found = F.array_distinct(F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
            out = out + _bind(found, lambda f: reduce(lambda a, b: a + b, [F.size(F.array_intersect(f, F.array(*[F.lit(k) for k in x]))) for x in listed]))
        return out

    return _bind(F.lower(text), told)


def keyword_points(text: Column, english: list[str] | None = None, chinese: list[str] | None = None) -> Column:
    return _bind(keyword_count(text, english, chinese), lambda n: F.when(n < 2, -15).when(n < 4, -5).otherwise(5))


def substance(text: Column) -> Column:
    """Letters, digits and white space once links are their text and list marks are gone."""
    return count(F.regexp_replace(F.regexp_replace(text, LINK, "$1"), r"[+*-]\s*", ""), r"[\p{L}\p{N}\s]")


def substance_points(text: Column) -> Column:
    return _bind(substance(text), lambda n: F.when(n < 100, -20).when(n < 200, -10).otherwise(5))


def table_points(text: Column) -> Column:
    low = F.lower(text)
    rows = F.filter(lines(text), lambda x: F.startswith(strip(x), F.lit("|")))
    cells = F.aggregate(rows, F.lit(0), lambda n, x: n + F.size(F.split(x, r"\|")))
    poor = _flags(*[F.contains(low, F.lit(k.lower())) for k in TABLE_KEYWORDS]) < 2
    shape = F.when(F.size(rows) < 3, -10).when(cells < 3 * F.size(rows), -5).otherwise(0)
    return F.when(poor, -15).otherwise(0) + shape


def technical_bonus(text: Column) -> Column:
    return F.least(F.lit(10), 2 * _flags(*[text.rlike(BEFORE + p + AFTER) for p in INDICATORS.values()]))


def _parts(text: Column, english: list[str] | None = None, chinese: list[str] | None = None) -> Column:
    """early: the score of texts that stop early, or null; total: the sum of points of the others, unbounded."""
    early = F.when(F.length(strip(text)) < 50, 60).when(is_garbled(text), 20)
    total = 100 - F.when(is_title_only(text), 40).otherwise(0) + language_points(text) + keyword_points(text, english, chinese)
    total = total + substance_points(text) + technical_bonus(text)
    return _bind(early, lambda e: F.struct(e.alias("early"), F.when(e.isNull() & text.isNotNull(), total).alias("total")))


def _settled(parts: Column, more: Column | None = None) -> Column:
    total = parts["total"] if more is None else parts["total"] + more
    return F.coalesce(parts["early"], F.when(parts["total"].isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), total))))


def _tables(text: Column, content_type: Column | None) -> Column | None:
    return None if content_type is None else F.when(content_type == "table", table_points(text)).otherwise(0)


def score(text: Column, content_type: Column | None = None, english: list[str] | None = None, chinese: list[str] | None = None) -> Column:
    """0 to 100, null for null. Short texts and garbled ones stop early."""
    return _bind(_parts(text, english, chinese), lambda p: _settled(p, _tables(text, content_type)))


def judged(text: Column, content_type: Column | None = None, least: int = 60) -> Column:
    """score and reject_type as a struct, with the score's parts worked out once for both."""
    return _bind(
        _parts(text),
        lambda p: F.struct(
            _settled(p, _tables(text, content_type)).alias("score"),
            F.when(is_navigation(text), "navigation").when(is_marketing(text), "marketing").when(_settled(p) < least, "low_quality").alias("reject_type"),
        ),
    )


def issues(text: Column) -> Column:
    """Names of what lowered or raised the score, in the order of the rules."""
    short, garbled = F.length(strip(text)) < 50, is_garbled(text)
    named = F.array_compact(
        F.array(
            F.when(is_title_only(text), "title_only"),
            F.when(language_points(text) == -25, "little_text").when(language_points(text) == -15, "digits_and_symbols").when(language_points(text) == -30, "empty"),
            F.when(keyword_points(text) == -15, "few_keywords").when(keyword_points(text) == -5, "some_keywords").otherwise("keywords"),
            F.when(substance_points(text) == -20, "no_substance").when(substance_points(text) == -10, "little_substance").otherwise("substance"),
            F.when(technical_bonus(text) > 0, "technical_indicators"),
        )
    )
    return F.when(short, F.array(F.lit("too_short"))).when(garbled, F.array(F.lit("garbled"))).otherwise(named)


def reject_type(text: Column, least: int = 60, enabled: bool = True) -> Column:
    """Why filtering drops a chunk: navigation, marketing or low_quality; null if it stays."""
    if not enabled:
        return F.lit(None).cast("string")
    return F.when(is_navigation(text), "navigation").when(is_marketing(text), "marketing").when(score(text) < least, "low_quality")


def filter_chunks(chunks: DataFrame, text: str = "content", least: int = 60, enabled: bool = True) -> DataFrame:
    """chunks with reject_type, and the content that a report on rejected chunks shows."""
    out = chunks.withColumn("reject_type", reject_type(F.col(text), least, enabled))
    shown = F.when(F.col("reject_type").isin("navigation", "marketing"), shortened(F.col(text), 200)).otherwise(F.col(text))
    return out.withColumn("report_content", F.when(F.col("reject_type").isNotNull(), shown))


# -- selection and analysis ---------------------------------------------------------------------


def select_chunks(chunks: DataFrame, strategy: str, most: int | None, order: str, text: str = "content", per: list[str] | None = None, seed: int = 0) -> DataFrame:
    """chunks with rk, at most `most` for each group of `per`: first, quality, random (by a seeded hash), else quality."""
    if strategy not in ("first", "random"):
        out = chunks.withColumn("_score", score(F.col(text)))
        by = [F.col("_score").desc(), F.col(order)]
    else:
        out = chunks
        by = [F.col(order)] if strategy == "first" else [F.md5(F.concat(F.lit(f"{seed}:"), F.col(order).cast("string"))), F.col(order)]
    chunks = out
    ranked = chunks.withColumn("rk", F.row_number().over(Window.partitionBy(*(per or [F.lit(0)])).orderBy(*by)).cast("long"))
    ranked = ranked.drop("_score")
    if not per:  # a global top-k: a heap for each partition, then one small merge
        if most:
            top = chunks.orderBy(*by).limit(most)
            return top.withColumn("rk", F.row_number().over(Window.orderBy(*by)).cast("long")).drop("_score")
        return ranked
    return ranked.filter(F.col("rk") <= most) if most else ranked


def length_bucket(text: Column) -> Column:
    n = F.length(text)
    return F.when(n <= 500, "0-500").when(n <= 1000, "500-1000").when(n <= 2000, "1000-2000").otherwise("2000+")


def content_class(text: Column) -> Column:
    low = F.lower(text)
    code = reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in ("def ", "class ", "import ", "{", "}", ";")])
    return F.when(code, "code_like").when(F.size(words(text)) > 50, "text_heavy").otherwise("mixed")


def selection_info(chunks: DataFrame, strategy: str, most: int | None, least: int, order: str, text: str = "content") -> DataFrame:
    """One row: how many chunks there were, passed and were selected, and their scores."""
    scored = chunks.select(F.col(order), judged(F.col(text), least=least).alias("q")).select(order, F.col("q.score").alias("s"), F.col("q.reject_type").alias("r"))
    passed = scored.filter("r is null")
    by = [F.col("s").desc(), F.col(order)] if strategy not in ("first", "random") else [F.col(order)]
    chosen = passed.orderBy(*by).limit(most) if most else passed
    whole = scored.agg(F.count(F.lit(1)).alias("original"), F.count_if(F.col("r").isNull()).alias("filtered"))
    top = chosen.agg(
        F.count(F.lit(1)).alias("selected"), F.round(F.avg("s"), 1).alias("avg_score"), F.min("s").cast("long").alias("min_score"), F.max("s").cast("long").alias("max_score")
    )
    out = whole.crossJoin(top)  # one row each
    ratio = F.round(F.coalesce(F.try_divide(F.col("selected"), F.col("original")), F.lit(0.0)), 6)
    return out.select(F.lit(strategy).alias("strategy"), "*", ratio.alias("selection_ratio"))
