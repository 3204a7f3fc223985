"""Candidates: customers are members, orders posts, line items calls, events complaints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import candidates as c

STAMP = "yyyy-MM-dd HH:mm:ss"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _posts(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").where("o_orderstatus = 'O'")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderpriority", "o_totalprice")


def _calls(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").where("l_quantity > 10")
    call = F.concat_ws("-", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)"))
    return li.select(F.col("l_orderkey").alias("info_id"), F.col("l_returnflag").alias("sub_id"), F.col("l_linestatus").alias("asr_result"), F.col("l_shipdate").alias("t"), call.alias("call_id"))


def _users(spark: SparkSession, d: str) -> DataFrame:
    return c.publishers(read(spark, d, "customer").select(F.col("c_custkey").alias("id")), _posts(spark, d), 2)


def _user_calls(spark: SparkSession, d: str) -> DataFrame:
    posts = _posts(spark, d).join(_users(spark, d).select("user_id"), "user_id", "left_semi")
    calls = _calls(spark, d).join(posts.select(F.col("id").alias("info_id")), "info_id", "left_semi")
    return calls.withColumn("call_time", F.date_format("t", STAMP)).drop("t")


def wide_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Posts with their calls, the chats of conversations of their number, and the complaints of
    events of that user number."""
    s = c.Settings("19980101", top=3, min_messages=3)
    posts = _posts(spark, d).join(_users(spark, d).select("user_id"), "user_id", "left_semi")
    base = posts.select("user_id", F.col("id").alias("info_id"), F.col("o_orderpriority").alias("job_detail"), F.lit("").alias("occupation_id"), F.date_format("o_orderdate", STAMP).alias("publish_time"))
    calls, call_counts = c.calls_of(_user_calls(spark, d), s)
    messages = _messages(spark, d)
    chats, chat_counts = c.chats_of(messages, messages, s)
    return c.assembled(base, calls, call_counts, chats, chat_counts, c.complaints_of(*_complaints(spark, d)))


_U = "users AS (SELECT o_custkey AS user_id, count(*) AS post_count FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(*) >= 2)"
_C = f"""{_U}, calls AS (SELECT l_orderkey AS info_id, l_returnflag AS sub_id, l_linestatus AS asr_result, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS call_time,
 lpad(l_linenumber::VARCHAR, 3, '0') || '-' || l_partkey || '-' || l_suppkey || '-' || l_extendedprice::DECIMAL(18,2) AS call_id
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN users ON user_id = o_custkey WHERE l_quantity > 10 AND o_orderstatus = 'O'),
 numbered AS (SELECT *, row_number() OVER (PARTITION BY info_id ORDER BY call_time DESC, call_id) AS rn FROM calls)"""

def active_publishers(spark: SparkSession, d: str) -> DataFrame:
    recent = _posts(spark, d).where(c.after(F.col("o_orderdate"), "19980101", 180))
    return c.publishers(read(spark, d, "customer").select(F.col("c_custkey").alias("id")), recent, 2)


def calls_topk(spark: SparkSession, d: str) -> DataFrame:
    return c.ranked(_user_calls(spark, d), "info_id", "call_time", "call_id").where("rn <= 3").select("info_id", "call_id", "call_time", F.col("rn").cast("long").alias("rn"))


def calls_count(spark: SparkSession, d: str) -> DataFrame:
    return c.calls_of(_user_calls(spark, d), c.Settings("19980101"))[1]


def _messages(spark: SparkSession, d: str) -> DataFrame:
    m = read(spark, d, "conversations")
    item = F.struct(F.when(F.col("role") == "system", "Other").otherwise(c.TEXT_MESSAGE).alias("MsgType"), F.struct(F.col("text").alias("Text")).alias("MsgContent"))
    return m.select(
        F.floor(F.col("conv_id") / 4).cast("long").alias("info_id"), F.col("conv_id").alias("conversation_id"), F.col("role").alias("from_user"),
        F.col("turn").alias("msg_time"), F.to_json(F.array(item)).alias("msg_body"),
    )


def conv_rank_by_distinct(spark: SparkSession, d: str) -> DataFrame:
    ranked = c.conversations_of(_messages(spark, d), c.Settings("19980101", min_messages=3))
    return ranked.select("info_id", "conversation_id", "started", "n_texts", F.col("rn").cast("long").alias("rn"))


_M = """m AS (SELECT conv_id // 4 AS info_id, conv_id AS conversation_id, role, turn, text FROM conversations),
 stats AS (SELECT info_id, conversation_id, min(turn) AS started, count(DISTINCT text) AS n_texts FROM m WHERE role <> 'system' GROUP BY ALL HAVING count(DISTINCT text) >= 3),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY info_id ORDER BY n_texts DESC, started, conversation_id) AS rn FROM stats)"""


def conv_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Messages of the top two conversations of a post, as one text; headers carry the start."""
    m = _messages(spark, d)
    merged, counts = c.chats_of(m, m, c.Settings("19980101", top=2, min_messages=3))
    return merged.join(counts, "info_id").select("info_id", F.md5("im_merged").alias("im_md5"), F.char_length("im_merged").cast("long").alias("n_chars"), "im_message_count")


CONV_ROLLUP_SQL = f"""WITH {_M}, lines AS (SELECT r.info_id, r.rn, r.started, m.role || ': ' || m.text AS line, m.turn, m.role FROM ranked r JOIN m USING (conversation_id)
 WHERE r.rn <= 2 AND m.role <> 'system' AND m.text <> ''),
 bodies AS (SELECT info_id, rn, started, string_agg(line, chr(10) ORDER BY turn, role, line) AS body FROM lines GROUP BY ALL),
 merged AS (SELECT info_id, string_agg('【会话' || rn || ' ' || strftime(make_timestamp(started * 1000000), '%Y-%m-%d %H:%M:%S') || '】' || chr(10) || body, chr(10) ORDER BY rn) AS t FROM bodies GROUP BY info_id)
SELECT info_id, md5(t) AS im_md5, length(t)::BIGINT AS n_chars, (SELECT count(*) FROM ranked r WHERE r.info_id = merged.info_id)::BIGINT AS im_message_count FROM merged"""


def _complaints(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = read(spark, d, "events").where("event_type = 'error'")
    records = e.select(F.col("event_id").alias("id"), F.col("user_id").alias("target_info_id"), F.date_format("ts", STAMP).alias("created_at"))
    return records, e.select(F.col("event_id").alias("complaint_id"), F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("complaint_content"))


def complaint_rollup(spark: SparkSession, d: str) -> DataFrame:
    return c.complaints_of(*_complaints(spark, d))


COMPLAINTS_SQL = """WITH r AS (SELECT user_id AS info_id, event_id, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events WHERE event_type = 'error' AND event_id % 5 <> 0),
 n AS (SELECT *, row_number() OVER (PARTITION BY info_id ORDER BY t DESC, event_id, props) AS rn FROM r)
SELECT info_id, string_agg('【投诉' || rn || ' ' || t || '】' || chr(10) || props, chr(10) ORDER BY rn) AS complaint_content, count(*)::BIGINT AS complaint_count, min(t) AS first_complaint_time
FROM n GROUP BY info_id"""


WIDE_SQL = f"""WITH {_C}, asr AS (SELECT info_id, array_to_string(list_sort(list_distinct(list(sub_id))), ',') AS sub_id,
 string_agg('【通话' || rn || ' ' || call_time || '】' || chr(10) || asr_result, chr(10) ORDER BY rn) AS asr_result FROM numbered WHERE rn <= 3 GROUP BY info_id),
 cc AS (SELECT info_id, count(*) AS n FROM calls GROUP BY info_id),
 {_M}, lines AS (SELECT r.info_id, r.rn, r.started, m.role || ': ' || m.text AS line, m.turn, m.role FROM ranked r JOIN m USING (conversation_id)
 WHERE r.rn <= 3 AND m.role <> 'system' AND m.text <> ''),
 bodies AS (SELECT info_id, rn, started, string_agg(line, chr(10) ORDER BY turn, role, line) AS body FROM lines GROUP BY ALL),
 im AS (SELECT info_id, string_agg('【会话' || rn || ' ' || strftime(make_timestamp(started * 1000000), '%Y-%m-%d %H:%M:%S') || '】' || chr(10) || body, chr(10) ORDER BY rn) AS t FROM bodies GROUP BY info_id),
 imc AS (SELECT info_id, count(*) AS n FROM ranked GROUP BY info_id),
 complaints AS ({COMPLAINTS_SQL})
SELECT o_custkey AS user_id, o_orderkey AS info_id, o_orderpriority AS job_detail, '' AS occupation_id, coalesce(asr.sub_id, '') AS sub_id, coalesce(asr.asr_result, '') AS asr_result,
 coalesce(im.t, '') AS im_text, coalesce(p.complaint_content, '') AS complaint_content, coalesce(imc.n, 0)::BIGINT AS im_message_count, coalesce(cc.n, 0)::BIGINT AS call_record_count,
 coalesce(p.complaint_count, 0)::BIGINT AS complaint_count, p.first_complaint_time, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS publish_time
FROM orders JOIN users ON user_id = o_custkey LEFT JOIN asr ON asr.info_id = o_orderkey LEFT JOIN cc ON cc.info_id = o_orderkey
 LEFT JOIN im ON im.info_id = o_orderkey LEFT JOIN imc ON imc.info_id = o_orderkey LEFT JOIN complaints p ON p.info_id = o_orderkey WHERE o_orderstatus = 'O'"""


def latest_post_dedupe(spark: SparkSession, d: str) -> DataFrame:
    posts = read(spark, d, "orders")
    return c.ranked(posts, "o_custkey", "o_orderdate", "o_orderkey").where("rn = 1").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", STAMP).alias("day"))


def json_field(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"))


def json_array_explode(spark: SparkSession, d: str) -> DataFrame:
    m = read(spark, d, "conversations")
    item = F.struct(F.lit(c.TEXT_MESSAGE).alias("MsgType"), F.struct(F.col("text").alias("Text")).alias("MsgContent"))
    bodies = m.groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("item")))), lambda x: x["item"])).alias("body"))
    return bodies.select("conv_id", F.posexplode(F.from_json("body", c.MESSAGES)).alias("at", "item")).select("conv_id", F.col("at").cast("long").alias("at"), F.md5(F.col("item.MsgContent.Text")).alias("text_md5"))


def window_recent_strict(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    last = e.agg(F.date_format(F.max("ts"), "yyyyMMdd")).first()[0]
    return e.where(c.after(F.col("ts"), last, 7)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def window_recent_inclusive(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("pt", F.date_format("ts", "yyyyMMdd"))
    last = e.agg(F.max("pt")).first()[0]
    return e.where(c.between_partitions(F.col("pt"), last, 7)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    wide_candidates, active_publishers, calls_topk, calls_count, conv_rank_by_distinct, conv_rollup, complaint_rollup, latest_post_dedupe,
    json_field, json_array_explode, window_recent_strict, window_recent_inclusive,
)}
ORACLE_SQL = {
    "wide_candidates": WIDE_SQL,
    "active_publishers": "SELECT o_custkey AS user_id, count(*)::BIGINT AS post_count FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' AND o_orderdate::DATE > DATE '1998-01-01' - 180 GROUP BY 1 HAVING count(*) >= 2",
    "calls_topk": f"WITH {_C} SELECT info_id, call_id, call_time, rn::BIGINT AS rn FROM numbered WHERE rn <= 3",
    "calls_count": f"WITH {_C} SELECT info_id, count(*)::BIGINT AS call_record_count FROM calls GROUP BY 1",
    "conv_rank_by_distinct": f"WITH {_M} SELECT info_id::BIGINT AS info_id, conversation_id, started, n_texts::BIGINT AS n_texts, rn::BIGINT AS rn FROM ranked",
    "conv_rollup": CONV_ROLLUP_SQL,
    "complaint_rollup": COMPLAINTS_SQL,
    "latest_post_dedupe": "SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "json_array_explode": "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT - 1 AS at, md5(text) AS text_md5 FROM conversations",
    "window_recent_strict": "SELECT event_type, count(*)::BIGINT AS n FROM events WHERE ts::DATE > (SELECT max(ts)::DATE FROM events) - 7 GROUP BY 1",
    "window_recent_inclusive": "SELECT event_type, count(*)::BIGINT AS n FROM events WHERE ts::DATE BETWEEN (SELECT max(ts)::DATE FROM events) - 7 AND (SELECT max(ts)::DATE FROM events) GROUP BY 1",
}
