"""Text cleaning, recall, risk and decisions over the driver's documents and conversations.

The tables hold no Chinese text, so word lists are parameters here: the same operators run
with lists in the tables' languages.  What DuckDB's expressions cannot say (back references,
call transcripts) has golden tests instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import modeljson as mj
from ebbtide.functions import risk, text, times
from ebbtide.functions import recall as rc
from ebbtide.operators import docs as documents
from ebbtide.operators import loader
from ebbtide.plans import decide
from ebbtide.queries.build import STAMP, read

LEXICON = {
    "term_buckets": {"absolute_time_terms": ["the", "der", "des"], "duration_terms": ["into", "in"], "complaint_terms": ["trash", "token"]},
    "regex_patterns": {"date_patterns": ["[0-9]{1,3}-[0-9]{4}"], "duration_patterns": ["[0-9]+ [a-z]+"]},
}
WORDS = {"filled": ("trash", "idiot", "que"), "suspected": ("und", "token"), "active": ("the", "stupid"), "unreachable": ("les", "clown")}


def line_dedupe_adjacent(spark: SparkSession, d: str) -> DataFrame:
    lines = text.without_adjacent(F.split("text", "\n"))
    return read(spark, d, "documents").select("doc_id", F.md5(F.array_join(lines, "\n")).alias("text_md5"), F.size(lines).cast("long").alias("n_lines"))


def line_filters(spark: SparkSession, d: str) -> DataFrame:
    lines = F.filter(text.lines_of(F.col("text")), lambda x: ~text.only_punctuation(x) & ~text.short_number(x))
    return read(spark, d, "documents").select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.md5(F.array_join(lines, "\n")).alias("text_md5"))


def greeting_distinct(spark: SparkSession, d: str) -> DataFrame:
    lines = text.clean_chat_lines(F.col("text"), ("Of the.", "The.", "And of."))
    return read(spark, d, "conversations").select("conv_id", "turn", F.md5(F.array_join(lines, "\n")).alias("text_md5"))


def header_strip(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    body = F.concat(F.lit("【通话1 "), F.date_format("ts", STAMP), F.lit("】\n"), "props", F.lit("\n【other】\n"), "event_type")
    return e.select("event_id", text.without_headers(body).alias("body"))


def turn_truncate(spark: SparkSession, d: str) -> DataFrame:
    """Two conversations' lines by sender number; of more than 4 turns the second to the fourth."""
    m = read(spark, d, "conversations")
    line = F.concat(F.ascii("role").cast("string"), F.lit(": "), F.md5("text"))
    chats = m.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    return chats.select("conv_id", F.array_join(text.turns_kept(F.col("lines"), 4), ",").alias("kept"))


def earliest_times(spark: SparkSession, d: str) -> DataFrame:
    """The first header time in string order and in padded order, from unpadded hours."""
    e = read(spark, d, "events")
    one = F.concat(F.lit("【投诉"), F.col("event_id").cast("string"), F.lit(" "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" "), F.hour("ts").cast("string"), F.lit(":"), F.minute("ts").cast("string"), F.lit(":5】"))
    texts = e.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list(one)), "\n").alias("t"))
    return texts.select("user_id", text.earliest_plain(F.col("t")).alias("plain"), text.earliest_padded(F.col("t")).alias("padded"))


def lexicon_recall(spark: SparkSession, d: str) -> DataFrame:
    record = rc.recall({"job_detail": F.col("text"), "im_text": F.col("source")}, LEXICON)
    found = read(spark, d, "documents").select("doc_id", F.explode(record["matches"]).alias("m"))
    return found.select("doc_id", F.col("m.source").alias("source"), F.col("m.bucket").alias("bucket"), F.array_join("m.terms", "|").alias("terms"))


def recall_counts(spark: SparkSession, d: str) -> DataFrame:
    record = rc.recall({"job_detail": F.col("text"), "im_text": F.col("source")}, LEXICON)
    counted = read(spark, d, "documents").select("doc_id", record.alias("r"))
    return counted.select("doc_id", "r.temporal_count", "r.complaint_count", "r.has_recall", rc.recall_class(F.col("r")).alias("recall_class"))


def risk_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").withColumn("r", risk.risk(F.col("text"), WORDS))
    return docs.select("doc_id", "r.is_filled", "r.fill_status", "r.is_unreachable", F.md5("r.complaint_summary").alias("summary_md5"))


def filled_filter(spark: SparkSession, d: str) -> DataFrame:
    """The limit first, in id order, then the filter."""
    docs = read(spark, d, "documents").orderBy("doc_id").limit(500)
    return docs.where(risk.filled_complaint(F.col("n_chars") % 3, F.col("text"), WORDS["filled"])).select("doc_id")


def preview(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "conversations").select("conv_id", "turn", text.preview(F.col("text"), 40).alias("preview"))


def repeat_fold(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.md5(text.folded_repeats(F.col("text"))).alias("text_md5"))


def denoise_full(spark: SparkSession, d: str) -> DataFrame:
    cleaned = text.denoised(F.col("text"), ("the", "und", "de"))
    return read(spark, d, "documents").select("doc_id", F.md5(cleaned).alias("text_md5"), F.char_length(cleaned).cast("long").alias("n_chars"))


def model_json_validate(spark: SparkSession, d: str) -> DataFrame:
    """Replies made from events: whole, with a strange field, out of range, of a wrong type, and broken."""
    e = read(spark, d, "events")
    k = F.col("event_id") % 6
    reply = (
        F.when(k == 0, F.lit('{"normalizable": true, "confidence": 0.5}'))
        .when(k == 1, F.lit('{"normalizable": true, "odd": 1}'))
        .when(k == 2, F.lit('{"confidence": 1.5}'))
        .when(k == 3, F.lit('{"duration_hours": "x"}'))
        .when(k == 4, F.concat(F.lit("{broken"), "props"))
        .otherwise(F.lit('```json\n{"anchor_type": "unknown", "duration_hours": null}\n```'))
    )
    return e.select("event_id", F.coalesce(mj.reply_error(reply, mj.NORMALISATION), F.lit("ok")).alias("outcome"))


def expiry_hint(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    at = lambda hours: F.date_format(F.col("ts") + F.make_dt_interval(hours=hours), "yyyy-MM-dd'T'HH:mm:ss")
    filled = F.concat(at(F.lit(0)), F.lit("+08:00"))
    expiry = F.when(F.col("event_id") % 4 == 0, F.lit("soon")).otherwise(F.concat(at((F.col("event_id") % 5 - 2).cast("int")), F.lit("+08:00")))
    return e.select("event_id", decide.with_hint(F.col("event_type"), filled, expiry).alias("reason"))


def decide_route(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    error = F.when(F.col("event_type") == "error", "parse_error")
    low = F.when(F.col("event_type") != "view", F.col("value") < 50)
    return e.select("event_id", decide.route(error, low).alias("route"))


def iso_times(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).when(k == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:'5'")).otherwise(F.lit("none"))
    return e.select("event_id", F.date_format(times.iso_time(raw), STAMP).alias("t"))


def _raw_rows(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 7 != 0, F.concat(F.lit("U"), k)).alias("user_id"), F.concat(F.lit("J"), k).alias("id"), F.col("c_name").alias("detail"), F.col("c_mktsegment").alias("occupations_v2"),
        F.when(k % 3 == 0, F.lit("x")).alias("im_msg"), F.when(k % 4 == 0, F.concat(F.lit("【投诉1 2026-04-20 9:5:1】\n【投诉2 2026-04-20 10:00:00】"))).alias("complaint_content"),
        F.when(k % 11 == 0, F.lit("many")).otherwise((k % 13 - 1).cast("string")).alias("complaint_count"),
    )


def normalise_rows(spark: SparkSession, d: str) -> DataFrame:
    return loader.normalised(_raw_rows(spark, d)).select("info_id", "im_text", "complaint_content", "asr_result", "sub_id", "first_complaint_time")


def validate_split(spark: SparkSession, d: str) -> DataFrame:
    good, bad = loader.validated(loader.normalised(_raw_rows(spark, d)))
    good = good.select("info_id", "complaint_count", F.lit("").alias("errors"))
    return good.unionByName(bad.select(F.get_json_object("raw_json", "$.info_id").alias("info_id"), F.lit(None).cast("long").alias("complaint_count"), F.array_join("errors", "|").alias("errors")))


def decided_rows(spark: SparkSession, d: str) -> DataFrame:
    """The whole path with a fixed client: documents as posts, conversations' roles as noise."""
    docs = read(spark, d, "documents")
    wide = docs.select(
        F.col("doc_id").alias("info_id"), F.col("text").alias("job_detail"), F.lit("").alias("asr_result"), F.lit("").alias("im_text"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("trash")).otherwise(F.lit("")).alias("complaint_content"), F.lit("2026-04-20 10:00:00").alias("publish_time"),
    )
    replies = {
        "signal_detection": '{"has_temporal_signal": true, "temporal_status": "has_signal", "signal_type": "duration_only", "evidence_summary": ["x"], "confidence": 0.4}',
        "time_normalization": '{"normalizable": true, "anchor_type": "publish_time", "confidence": 0.9}',
        "final_decision": '{"validity_type": "fuzzy_time", "estimated_expiry": "2026-04-21T10:00:00+08:00", "reason": "said", "low_confidence": false}',
    }
    lexicon = {"term_buckets": {"absolute_time_terms": ["trash", "que "], "complaint_terms": ["idiot"]}, "regex_patterns": {}}
    return decide.decided(wide, lambda: decide.FakeClient(replies), lexicon=lexicon, keywords=WORDS)


def output_records(spark: SparkSession, d: str) -> DataFrame:
    """What is published of decisions made from events: formal ones, errors, and low confidence."""
    e = read(spark, d, "events")
    error = F.when(F.col("event_type") == "error", "parse_error")
    low = F.col("value") < 50
    decisions = e.select(
        F.col("event_id").alias("info_id"), F.when(error.isNull(), F.lit("fuzzy_time")).alias("validity_type"), F.when(F.col("event_id") % 3 == 0, F.lit("2026-04-21")).alias("estimated_expiry"),
        F.col("event_type").alias("reason"), decide.route(error, low).alias("route"), error.alias("error_type"),
    )
    made = decide.output_records(decisions, {"graph_version": "g1", "feature_schema_version": "f1"}, F.concat(F.lit("run-"), F.col("info_id")))
    at = lambda path: F.get_json_object("record", path)
    return made.select(
        "publish_key", "run_id", "entity_key", "route", at("$.validity_type").alias("validity_type"), at("$.estimated_expiry").alias("expiry"), at("$.error_type").alias("error_type"),
        at("$.decision_record.reason").alias("review_reason"), at("$.audit.graph_version").alias("graph"), at("$.audit.route").alias("audit_route"), at("$.audit.error_type").alias("audit_error"),
    )


def markdown_rules(spark: SparkSession, d: str) -> DataFrame:
    made = documents.normalised_markdown(read(spark, d, "documents").select("doc_id", "text"), "text")
    return made.select("doc_id", F.md5("text").alias("text_md5"))


QUERIES = {f.__name__: f for f in (
    line_dedupe_adjacent, line_filters, greeting_distinct, header_strip, turn_truncate, earliest_times, lexicon_recall, recall_counts, risk_rules, filled_filter, preview,
    repeat_fold, denoise_full, model_json_validate, expiry_hint, decide_route, iso_times, normalise_rows, validate_split, decided_rows, output_records, markdown_rules,
)}

_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_LINES = f"list_filter(list_transform(string_split_regex(text, '{_BREAK}'), lambda x: regexp_replace(x, '^[\\s\\x{{a0}}\\x{{3000}}]+|[\\s\\x{{a0}}\\x{{3000}}]+$', '', 'g')), lambda x: x <> '')"
_ANY = lambda words: " OR ".join(f"contains(text, '{w}')" for w in words)
_RISK = f"r AS (SELECT doc_id, text, ({_ANY(WORDS['filled'])}) AS f, ({_ANY(WORDS['suspected'])}) AS s, ({_ANY(WORDS['active'])}) AS a, ({_ANY(WORDS['unreachable'])}) AS u FROM documents), q AS (SELECT *, CASE WHEN f AND NOT a THEN 'confirmed_filled' WHEN (f AND a) OR (s AND NOT a) THEN 'suspected_filled' ELSE 'not_filled' END AS fill_status FROM r)"
_TERMS = lambda col, *ps: "list_sort(list_distinct(" + " || ".join(f"regexp_extract_all({col}, '{p}')" for p in ps) + "))"
_RECALL = "m AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{name}' AS source, '{bucket}' AS bucket, {_TERMS(col, *ps)} AS terms FROM documents"
    for name, col in (("job_detail", "text"), ("im_text", "source"))
    for bucket, ps in (("absolute_time", ("the|der|des", "[0-9]{1,3}-[0-9]{4}")), ("duration", ("into|in", "[0-9]+ [a-z]+")), ("complaint", ("trash|token",)))
) + ")"

ORACLE_SQL = {
    "line_dedupe_adjacent": "WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), k AS (SELECT doc_id, list_filter(ls, lambda x, i: i = 1 OR x <> ls[i - 1]) AS ls FROM l) SELECT doc_id, md5(array_to_string(ls, chr(10))) AS text_md5, len(ls)::BIGINT AS n_lines FROM k",
    "line_filters": f"WITH l AS (SELECT doc_id, list_filter({_LINES}, lambda x: NOT regexp_full_match(x, '[\\s\\x{{a0}}\\x{{3000}}{text.PUNCTUATION.replace(chr(39), chr(39) * 2)}]+') AND NOT regexp_full_match(x, '[\\p{{Nd}}{text.CN_DIGITS}]{{1,10}}')) AS ls FROM documents) SELECT doc_id, len(ls)::BIGINT AS n_lines, md5(array_to_string(ls, chr(10))) AS text_md5 FROM l",
    "greeting_distinct": f"WITH l AS (SELECT conv_id, turn, list_filter({_LINES}, lambda x: x NOT IN ('Of the.', 'The.', 'And of.')) AS ls FROM conversations) SELECT conv_id, turn, md5(array_to_string(list_transform(list_filter(list_zip(ls, range(1, len(ls) + 1)), lambda p: list_position(ls, p[1]) = p[2]), lambda p: p[1]), chr(10))) AS text_md5 FROM l",
    "header_strip": "SELECT event_id, props || chr(10) || '【other】' || chr(10) || event_type AS body FROM events",
    "turn_truncate": "WITH m AS (SELECT conv_id, turn, ascii(role) AS who, md5(text) AS what, row_number() OVER (PARTITION BY conv_id ORDER BY turn, ascii(role) || ': ' || md5(text)) AS i FROM conversations), g AS (SELECT *, lag(who) OVER (PARTITION BY conv_id ORDER BY i) IS DISTINCT FROM who AS fresh FROM m), "
    "t AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY i) - 1 AS k FROM g), d AS (SELECT *, min(i) OVER (PARTITION BY conv_id, who, what) AS first_i, max(k) OVER (PARTITION BY conv_id) AS last_k FROM t) "
    "SELECT conv_id, coalesce(string_agg(what, ',' ORDER BY i) FILTER (WHERE last_k < 4 OR k BETWEEN 1 AND 3), '') AS kept FROM d GROUP BY conv_id",
    "earliest_times": "WITH x AS (SELECT user_id, strftime(ts, '%Y-%m-%d') || ' ' || hour(ts) || ':' || minute(ts) || ':5' AS raw, date_trunc('minute', ts) AS t FROM events) SELECT user_id, min(raw) AS plain, arg_min(raw, (t, raw)) AS padded FROM x GROUP BY 1",
    "lexicon_recall": f"WITH {_RECALL} SELECT doc_id, source, bucket, array_to_string(terms, '|') AS terms FROM m WHERE len(terms) > 0",
    "recall_counts": f"WITH {_RECALL}, c AS (SELECT doc_id, count_if(len(terms) > 0 AND bucket <> 'complaint')::BIGINT AS temporal_count, count_if(len(terms) > 0 AND bucket = 'complaint')::BIGINT AS complaint_count FROM m GROUP BY 1) SELECT *, temporal_count > 0 AS has_recall, CASE WHEN temporal_count > 0 THEN 'temporal' WHEN complaint_count > 0 THEN 'complaint_only' ELSE 'empty' END AS recall_class FROM c",
    "risk_rules": f"WITH {_RISK} SELECT doc_id, fill_status = 'confirmed_filled' AS is_filled, fill_status, u AS is_unreachable, md5(CASE WHEN fill_status = 'confirmed_filled' AND u THEN '已招满且联系不上' WHEN fill_status = 'confirmed_filled' THEN '已招满' WHEN fill_status = 'suspected_filled' AND a THEN '存在阶段性结束或招满信号，但仍有继续招人迹象' WHEN fill_status = 'suspected_filled' THEN '阶段性结束，疑似招满' WHEN u THEN '联系不上' ELSE replace(substr(text, 1, 50), chr(10), ' ') END) AS summary_md5 FROM q",
    "filled_filter": f"SELECT doc_id FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 500) WHERE n_chars % 3 > 0 AND ({_ANY(WORDS['filled'])})",
    "preview": "WITH p AS (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations) SELECT conv_id, turn, CASE WHEN t = '' THEN '-' WHEN length(t) > 40 THEN substr(t, 1, 40) || '…' ELSE t END AS preview FROM p",
    "model_json_validate": "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 5 THEN 'ok' WHEN 4 THEN 'parse_error' ELSE 'schema_validation_error' END AS outcome FROM events",
    "expiry_hint": "SELECT event_id, CASE WHEN event_id % 4 <> 0 AND event_id % 5 > 2 THEN event_type || '；注意：投诉已招满时间(' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+08:00)早于预测截止时间，存在矛盾' ELSE event_type END AS reason FROM events",
    "decide_route": "SELECT event_id, CASE WHEN event_type IN ('error', 'view') OR value < 50 THEN 'fallback' ELSE 'formal' END AS route FROM events",
    "iso_times": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS t FROM events",
    "normalise_rows": "SELECT 'J' || c_custkey AS info_id, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END AS im_text, CASE WHEN c_custkey % 4 = 0 THEN '【投诉1 2026-04-20 9:5:1】' || chr(10) || '【投诉2 2026-04-20 10:00:00】' ELSE '' END AS complaint_content, '' AS asr_result, NULL::VARCHAR AS sub_id, CASE WHEN c_custkey % 4 = 0 THEN '2026-04-20 9:5:1' END AS first_complaint_time FROM customer",
    "validate_split": "WITH e AS (SELECT c_custkey AS k, array_to_string(list_filter([CASE WHEN c_custkey % 7 = 0 THEN 'user_id: missing' END, CASE WHEN c_custkey % 11 = 0 THEN 'complaint_count: not a whole number' WHEN c_custkey % 13 = 0 THEN 'complaint_count: negative' END], lambda x: x IS NOT NULL), '|') AS errors FROM customer) SELECT 'J' || k AS info_id, CASE WHEN errors = '' THEN k % 13 - 1 END::BIGINT AS complaint_count, errors FROM e",
    "decided_rows": "SELECT doc_id AS info_id, (contains(text, 'trash') OR contains(text, 'que ')) AS has_recall, CASE WHEN NOT has_recall OR doc_id % 2 = 1 THEN 'not_filled' ELSE 'confirmed_filled' END AS fill_status, "
    "CASE WHEN has_recall THEN 'fuzzy_time' ELSE 'no_validity' END AS validity_type, CASE WHEN has_recall THEN '2026-04-21T10:00:00+08:00' END AS estimated_expiry, CASE WHEN has_recall THEN 'said' ELSE '片段召回为空，无时效信号和风险信号，跳过 LLM 推理' END AS reason, 'formal' AS route, NULL::VARCHAR AS error_type FROM documents",
    "output_records": "WITH e AS (SELECT event_id, event_type, event_type = 'error' OR value < 50 AS review, event_type = 'error' AS wrong FROM events) SELECT event_id || '::f1::g1' || CASE WHEN review THEN '::fallback' ELSE '' END AS publish_key, 'run-' || event_id AS run_id, event_id::VARCHAR AS entity_key, CASE WHEN review THEN 'fallback' ELSE 'formal' END AS route, "
    "CASE WHEN NOT review THEN 'fuzzy_time' END AS validity_type, CASE WHEN NOT review AND event_id % 3 = 0 THEN '2026-04-21' END AS expiry, CASE WHEN wrong THEN 'parse_error' END AS error_type, CASE WHEN review AND NOT wrong THEN event_type END AS review_reason, 'g1' AS graph, CASE WHEN review THEN 'fallback' ELSE 'formal' END AS audit_route, CASE WHEN wrong THEN 'parse_error' END AS audit_error FROM e",
}
