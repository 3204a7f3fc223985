"""Risk rules: keyword tests, the fill status table and what is derived from it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.text import earliest_plain

# The keywords of the rules.
FILLED = "已招满 招满了 人已找到 人找到了 已经找到 不招了 不招 停招 招到了 已招到 已经招到 名额已满 满了 不需要了".split()
SUSPECTED = "干完活 干完了 这波结束 这批结束 阶段结束 先这样 暂时不用 暂时先不用 今天先不用".split()
ACTIVE = "还差 差一个 差几个人 来一个 来两个 来几个人 用几个 还用 继续用 后面的还有 明天还用 现在还差 正在招 用人 缺人".split()
UNREACHABLE = "电话打不通 联系不上 没人接 空号 停机 打不通 无法接通 关机 不接电话".split()
KEYWORDS: Mapping[str, Sequence[str]] = {"filled": FILLED, "suspected": SUSPECTED, "active": ACTIVE, "unreachable": UNREACHABLE}
SUMMARIES = {
    "filled_unreachable": "已招满且联系不上",
    "filled": "已招满",
    "suspected_active": "存在阶段性结束或招满信号，但仍有继续招人迹象",
    "suspected": "阶段性结束，疑似招满",
    "unreachable": "联系不上",
}


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return text.rlike("|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", w) for w in words))


def filled_complaint(count: Column, text: Column, words: Sequence[str] = FILLED) -> Column:
    """There are complaints, and their text says that the post is filled."""
    return (F.coalesce(count, F.lit(0)) > 0) & contains_any(F.coalesce(text, F.lit("")), words)


def closed_complaint(text: Column, words: Sequence[str] = (*FILLED, *UNREACHABLE)) -> Column:
    """The wider test: the text says that the post is filled, or that nobody can be reached."""
    return contains_any(F.coalesce(text, F.lit("")), words)


def fill_status(filled: Column, suspected: Column, active: Column) -> Column:
    return F.when(filled & ~active, "confirmed_filled").when((filled & active) | (suspected & ~active), "suspected_filled").otherwise("not_filled")


def risk(corpus: Column, keywords: Mapping[str, Sequence[str]] = KEYWORDS) -> Column:
    """is_filled, fill_status, is_unreachable, complaint_summary, estimated_filled_at for a text.

    A text without anything has the default record."""
    corpus = F.coalesce(corpus, F.lit(""))
    has = {k: contains_any(corpus, v) for k, v in keywords.items()}
    status = fill_status(has["filled"], has["suspected"], has["active"])
    summary = (
        F.when((status == "confirmed_filled") & has["unreachable"], SUMMARIES["filled_unreachable"])
        .when(status == "confirmed_filled", SUMMARIES["filled"])
        .when((status == "suspected_filled") & has["active"], SUMMARIES["suspected_active"])
        .when(status == "suspected_filled", SUMMARIES["suspected"])
        .when(has["unreachable"], SUMMARIES["unreachable"])
        .otherwise(F.replace(F.substring(corpus, 1, 50), F.lit("\n"), F.lit(" ")))
    )
    first = earliest_plain(corpus)
    at = F.when(status != "not_filled", F.concat(F.replace(first, F.lit(" "), F.lit("T")), F.lit("+08:00")))
    return F.struct(
        (status == "confirmed_filled").alias("is_filled"),
        status.alias("fill_status"),
        has["unreachable"].alias("is_unreachable"),
        summary.alias("complaint_summary"),
        at.alias("estimated_filled_at"),
    )
