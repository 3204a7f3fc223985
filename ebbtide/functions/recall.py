"""Recall of time words: lexicon terms and patterns, matched natively.

A lexicon is data: ``{"term_buckets": {bucket: [terms]}, "regex_patterns": {group: [patterns]}}``.
Patterns are compiled into literal Java expressions when the plan is built.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.text import without_headers

# The default lexicon.
DEFAULT_LEXICON: dict[str, dict[str, list[str]]] = {
    "term_buckets": {
        "absolute_time_terms": "今天 明天 后天 今晚 今早 明早 上午 中午 下午 晚上 凌晨 当天 次日 本周 下周 本月 月底 月初 月中 年后 节后 周一 周二 周三 周四 周五 周六 周日 周天 星期一 星期二 星期三 星期四 星期五 星期六 星期日 星期天".split(),
        "recruitment_action_terms": "开工 到岗 入场 集合 上岗 报到 用人 要人 缺人 补人 急招 急用 马上上岗 立即上岗 立即到岗 明天上班 开始干 开始做 截止 截止前 招到 招满 停招 结束".split(),
        "duration_terms": "一天 两天 三天 四天 五天 几天 一周 两周 半个月 一个月 短期 长期 临时 连做 连续 干两天 做两天 做几天 干几天".split(),
        "deadline_terms": "之前 以内 最晚 截至 截止 截止前 当天 当晚 月底前 本周内 这两天 尽快 尽早 招到为止".split(),
        "holiday_terms": "五一 国庆 春节 元旦 中秋 清明 端午 双十一 618".split(),
        "complaint_terms": "已招满 不招 电话打不通 联系不上 停机 没人接 空号".split(),
    },
    "regex_patterns": {
        "date_patterns": [r"\d{1,2}月\d{1,2}[号日]", r"\d{4}[-/年]\d{1,2}[-/月]\d{1,2}[日号]?", r"\d{1,2}[号日]"],
        "time_patterns": [r"\d{1,2}[:：]\d{2}", r"\d{1,2}点半?", r"\d{1,2}点\d{1,2}分?"],
        "weekday_patterns": [r"星期[一二三四五六日天]", r"周[一二三四五六日天]"],
        "range_patterns": [r"\d{1,2}月\d{1,2}[号日]到\d{1,2}月\d{1,2}[号日]", r"\d{1,2}[号日]到\d{1,2}[号日]", r"周[一二三四五六日天]到周[一二三四五六日天]"],
        "duration_patterns": [r"[一二两三四五六七八九十\d]+天", r"[一二两三四五六七八九十\d]+周", r"[一二两三四五六七八九十\d]+个月"],
    },
}
ABSOLUTE_GROUPS = ("date", "time", "weekday", "range")


def load_lexicon(path: str | None) -> dict:
    """The lexicon of a JSON file; sections that are missing are empty."""
    if path is None:
        return DEFAULT_LEXICON
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    return {"term_buckets": raw.get("term_buckets") or {}, "regex_patterns": raw.get("regex_patterns") or {}}


def bucket_name(section: str) -> str:
    """The bucket that a section of the lexicon counts for."""
    stem = re.sub(r"_(terms|patterns)$", "", section)
    return "absolute_time" if stem in ABSOLUTE_GROUPS else stem


def compiled(lexicon: Mapping) -> dict[str, list[str]]:
    """Java patterns by bucket, in the lexicon's order; terms longest first."""
    out: dict[str, list[str]] = {}
    for section, terms in lexicon.get("term_buckets", {}).items():
        if terms:
            longest = sorted(terms, key=len, reverse=True)
            out.setdefault(bucket_name(section), []).append("|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", t) for t in longest))
    for section, patterns in lexicon.get("regex_patterns", {}).items():
        for p in patterns:
            out.setdefault(bucket_name(section), []).append(f"(?U){p}")
    return out


def literal_terms(lexicon: Mapping) -> dict[str, list[str]]:
    """The plain terms of each bucket."""
    out: dict[str, list[str]] = {}
    for section, terms in lexicon.get("term_buckets", {}).items():
        out.setdefault(bucket_name(section), []).extend(terms)
    return out


def terms_found(text: Column, patterns: Sequence[str], literals: Sequence[str] = ()) -> Column:
    """Sorted distinct matches of any of the patterns.

    With ``literals``, the terms that the first pattern is made of, that pattern is tried only
    where one of them occurs: finding bytes is many times cheaper than trying all terms at every place."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in patterns]
    if literals:
        occurs = functools.reduce(lambda a, b: a | b, [text.contains(t) for t in literals])
        found[0] = F.when(occurs, found[0]).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def recall(sources: Mapping[str, Column], lexicon: Mapping = DEFAULT_LEXICON, complaint_bucket: str = "complaint") -> Column:
    """A struct: matches (source, bucket, terms), the numbers of temporal and complaint matches,
    and whether there is any temporal one."""
    buckets, literals = compiled(lexicon), literal_terms(lexicon)
    texts = F.array(*[F.struct(F.lit(name).alias("source"), without_headers(F.coalesce(text, F.lit(""))).alias("body")) for name, text in sources.items()])

    def of_source(s: Column) -> Column:  # its body is made once for all buckets
        rows = [F.struct(s["source"].alias("source"), F.lit(bucket).alias("bucket"), terms_found(s["body"], patterns, literals.get(bucket, ())).alias("terms")) for bucket, patterns in buckets.items()]
        return F.filter(F.array(*rows), lambda m: F.size(m["terms"]) > 0)

    matches = F.flatten(F.transform(texts, of_source))

    def counted(ms: Column) -> Column:
        complaints = F.size(F.filter(ms, lambda m: m["bucket"] == complaint_bucket))
        temporal = F.size(ms) - complaints
        return F.struct(ms.alias("matches"), temporal.cast("long").alias("temporal_count"), complaints.cast("long").alias("complaint_count"), (temporal > 0).alias("has_recall"))

    return F.element_at(F.transform(F.array(matches), counted), 1)


def recall_class(record: Column) -> Column:
    return F.when(record["temporal_count"] > 0, "temporal").when(record["complaint_count"] > 0, "complaint_only").otherwise("empty")
