"""The candidates build: one wide row per post from members, posts, calls, chats and complaints.

Each branch is ranked, cut and rolled up before it meets the posts, so what is joined at the
end has one row per post.  The lists that the source leaves unordered get a total order here:
calls and complaints from newest to oldest, then by their ids; messages by time, then sender
and text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TEXT_MESSAGE = "TIMTextElem"
MESSAGES = "array<struct<MsgType:string,MsgContent:struct<Text:string>>>"


@dataclass(frozen=True)
class Settings:
    bizdate: str  # yyyyMMdd
    days: int = 7
    top: int = 10
    min_messages: int = 5
    min_posts: int = 1


def after(ts: Column, bizdate: str, days: int) -> Column:
    """Strictly later than the day ``days`` before bizdate; no upper bound."""
    return F.to_date(ts) > F.date_sub(F.to_date(F.lit(bizdate), "yyyyMMdd"), days)


def between_partitions(pt: Column, bizdate: str, days: int) -> Column:
    """The partitions from ``days`` before bizdate to bizdate, both included, as a comparison of
    the raw column, so that partitions are pruned."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(bizdate), "yyyyMMdd"), days), "yyyyMMdd")
    return pt.between(first, F.lit(bizdate))


def publishers(members: DataFrame, posts: DataFrame, min_posts: int = 1) -> DataFrame:
    """(user_id, post_count) of members with enough posts."""
    counted = posts.groupBy("user_id").agg(F.count("id").alias("post_count")).where(F.col("post_count") >= min_posts)
    return counted.join(members.select(F.col("id").alias("user_id")).distinct(), "user_id", "left_semi")


def ranked(rows: DataFrame, by: str, newest: str, *ties: str, rank: str = "rn") -> DataFrame:
    """Number the rows of a group from newest to oldest; ties by further columns."""
    order = Window.partitionBy(by).orderBy(F.col(newest).desc(), *[F.col(t) for t in ties])
    return rows.withColumn(rank, F.row_number().over(order))


def rolled_up(rows: DataFrame, by: str, order: str, text: Column, out: str, sep: str = "\n") -> DataFrame:
    """One text a group: pieces joined in order."""
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(pieces, lambda p: p["t"]), sep).alias(out))


def headed(name: str, rank: str, time: Column, body: Column) -> Column:
    return F.concat(F.lit(f"【{name}"), F.col(rank).cast("string"), F.lit(" "), time, F.lit("】\n"), F.coalesce(body, F.lit("")))


def calls_of(calls: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(info_id, sub_ids, asr_merged) of the newest calls, and (info_id, call_record_count) of all.

    calls: (info_id, sub_id, asr_result, call_time, call_id), filtered."""
    numbered = ranked(calls, "info_id", "call_time", "call_id")
    newest = numbered.where(F.col("rn") <= s.top)
    text = headed("通话", "rn", F.col("call_time").cast("string"), F.col("asr_result"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("rn").alias("o"), text.alias("t"))))
    merged = newest.groupBy("info_id").agg(
        F.array_join(F.array_sort(F.collect_set("sub_id")), ",").alias("sub_ids"),
        F.array_join(F.transform(pieces, lambda p: p["t"]), "\n").alias("asr_merged"),
    )
    return merged, calls.groupBy("info_id").agg(F.count(F.lit(1)).alias("call_record_count"))


def conversations_of(messages: DataFrame, s: Settings) -> DataFrame:
    """(info_id, conversation_id, started, n_texts, rn): conversations with enough different
    messages, those with most first."""
    text = F.get_json_object("msg_body", "$[0].MsgType") == TEXT_MESSAGE
    stats = (
        messages.where(text)
        .groupBy("info_id", "conversation_id")
        .agg(F.min("msg_time").alias("started"), F.count_distinct("msg_body").alias("n_texts"))
        .where(F.col("n_texts") >= s.min_messages)
    )
    return ranked(stats, "info_id", "n_texts", "started", "conversation_id")


def chats_of(messages: DataFrame, all_messages: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(info_id, im_merged) of the top conversations, and (info_id, im_message_count) of all.

    The texts of a conversation are all its messages, those of other posts and of
    administrators too, as in the source.  A message body is a JSON array; every element of
    it is read."""
    conversations = conversations_of(messages, s)
    top = conversations.where(F.col("rn") <= s.top).select("info_id", "conversation_id", "started", "rn")
    said = all_messages.select("conversation_id", "from_user", "msg_time", F.posexplode(F.from_json("msg_body", MESSAGES)).alias("at", "item"))
    said = said.where((F.col("item.MsgType") == TEXT_MESSAGE) & (F.col("item.MsgContent.Text") != ""))
    lines = top.join(said, "conversation_id")
    line = F.concat_ws(": ", F.col("from_user"), F.col("item.MsgContent.Text"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("msg_time").alias("o"), F.col("from_user").alias("f"), F.col("at").alias("i"), line.alias("t"))))
    texts = lines.groupBy("info_id", "rn", "started").agg(F.array_join(F.transform(pieces, lambda p: p["t"]), "\n").alias("body"))
    merged = rolled_up(texts, "info_id", "rn", headed("会话", "rn", F.from_unixtime("started"), F.col("body")), "im_merged")
    return merged, conversations.groupBy("info_id").agg(F.count(F.lit(1)).alias("im_message_count"))


def complaints_of(records: DataFrame, details: DataFrame) -> DataFrame:
    """(info_id, complaint_content, complaint_count, first_complaint_time)."""
    with_text = records.join(details.where(F.col("complaint_content").isNotNull()), records["id"] == details["complaint_id"])
    with_text = with_text.select(F.col("target_info_id").alias("info_id"), "complaint_content", F.col("created_at").alias("complaint_time"), "complaint_id")
    numbered = ranked(with_text, "info_id", "complaint_time", "complaint_id", "complaint_content")
    text = headed("投诉", "rn", F.col("complaint_time").cast("string"), F.col("complaint_content"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("rn").alias("o"), text.alias("t"))))
    return numbered.groupBy("info_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["t"]), "\n").alias("complaint_content"),
        F.count(F.lit(1)).alias("complaint_count"),
        F.min("complaint_time").cast("string").alias("first_complaint_time"),
    )


def assembled(posts: DataFrame, calls: DataFrame, call_counts: DataFrame, chats: DataFrame, chat_counts: DataFrame, complaints: DataFrame) -> DataFrame:
    """The wide rows: every post, with what there is of the others."""
    joined = posts
    for other in (calls, call_counts, chats, chat_counts, complaints):
        joined = joined.join(other, "info_id", "left")
    text = lambda c: F.coalesce(c, F.lit(""))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        "user_id", "info_id", "job_detail", "occupation_id",
        text("sub_ids").alias("sub_id"), text("asr_merged").alias("asr_result"), text("im_merged").alias("im_text"), text("complaint_content").alias("complaint_content"),
        number("im_message_count"), number("call_record_count"), number("complaint_count"), "first_complaint_time", "publish_time",
    )


def build(tables: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """The wide rows of a day from the seven source tables.

    Keys of tables: members, posts, call_log, call_media, chats, complaints, complaint_details;
    each already one snapshot, but for chats, whose partitions ``pt`` are chosen here."""
    posts = tables["posts"].where((F.col("is_check") == 2) & after(F.from_unixtime("add_time"), s.bizdate, s.days))
    users = publishers(tables["members"], posts, s.min_posts)
    own = tables["posts"].join(users.select("user_id"), "user_id", "left_semi")
    base = ranked(own.where((F.col("is_check") == 2) & after(F.from_unixtime("add_time"), s.bizdate, s.days)), "id", "add_time", "detail").where("rn = 1")
    base = base.select("user_id", F.col("id").alias("info_id"), F.col("detail").alias("job_detail"), F.col("occupations_v2").alias("occupation_id"), F.from_unixtime("add_time").alias("publish_time"))
    ids = own.select(F.col("id").alias("info_id")).distinct()
    log = tables["call_log"].where("call_duration > 0").join(ids, "info_id", "left_semi").select("info_id", "sub_id", F.col("id").alias("call_id"))
    media = tables["call_media"].where((F.col("is_asr") == 1) & after(F.col("created_at"), s.bizdate, s.days))
    calls = log.join(media.select(F.col("call_log_id").alias("call_id"), "asr_result", F.col("created_at").alias("call_time")), "call_id")
    recent = tables["chats"].where(between_partitions(F.col("pt"), s.bizdate, s.days))
    chats, chat_counts = chats_of(recent.where("is_admin = 0").join(ids, "info_id", "left_semi"), recent, s)
    merged, call_counts = calls_of(calls, s)
    complaints = complaints_of(tables["complaints"], tables["complaint_details"].select("complaint_id", "complaint_content"))
    return assembled(base, merged, call_counts, chats, chat_counts, complaints)
