"""Stored replies, run records, the result store and what the screens show, over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import risk, times
from ebbtide.operators import naming, serving, stores
from ebbtide.plans import prompts, records
from ebbtide.queries.build import STAMP, read
from ebbtide.queries.screens import DELAYS, _delays, _runs
from ebbtide.queries.texts import WORDS
from ebbtide.sources import files, templates
from ebbtide.sources.replies import ReplyStore

LEXICON = {"term_buckets": {"absolute_time_terms": ["que ", "today"], "duration_terms": ["trash"], "complaint_terms": ["the "]}, "regex_patterns": {}}
RISK_WORDS = {"filled": ("trash",), "suspected": ("ends",), "active": ("wanted",), "unreachable": ("no answer",)}
TEMPLATES = [(task, "v1", f"You judge {task}.", "Say it as JSON:\n{{payload}}\nNow.") for task in records.STEPS]


class RuleClient:
    """Answers by the number of the job in the prompt's payload: some replies are broken, some calls fail."""

    def complete(self, task: str, payload: str) -> str:
        start = payload.index("Say it as JSON:\n") + len("Say it as JSON:\n")
        job = int(json.loads(payload[start : payload.rindex("\nNow.")])["job_id"])
        if task == "signal_detection":
            if job % 11 == 3:
                return "no JSON"
            given = {"has_temporal_signal": job % 4 != 1, "temporal_status": "has_signal", "signal_type": "duration_only", "evidence_summary": ["x"], "confidence": 0.5}
            return json.dumps(given | ({"odd": 1} if job % 13 == 5 else {}))
        if task == "time_normalization":
            if job % 7 == 2:
                raise ValueError("refused")
            return "```json\n" + json.dumps({"normalizable": True, "anchor_type": "publish_time", "duration_hours": job % 50, "confidence": 0.1 * (job % 10)}) + "\n```"
        return json.dumps({"validity_type": "fuzzy_time", "estimated_expiry": "2026-04-21T10:00:00+08:00", "reason": "said", "low_confidence": job % 3 == 0})


def _wide(spark: SparkSession, d: str) -> DataFrame:
    """Documents as posts; a post's chat is the conversation of its number, each message as a digest
    and every third with a word of time; its call tells the status of the order of its number."""
    docs = read(spark, d, "documents")
    said = F.concat(F.lit("7: "), F.md5("text"), F.when(F.col("conv_id") % 3 == 0, " today").otherwise(""))
    chats = read(spark, d, "conversations").select("conv_id", said.alias("said")).groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list("said")), "\n").alias("im_text"))
    calls = read(spark, d, "orders").select("o_orderkey", F.concat(F.lit('[{"begin": 1, "text": "order '), "o_orderstatus", F.lit('"}]')).alias("asr_result"))
    rows = docs.join(chats, docs["doc_id"] == chats["conv_id"], "left").join(calls, docs["doc_id"] == calls["o_orderkey"], "left")
    complaint = F.when(F.col("doc_id") % 2 == 0, F.lit("【投诉1 2026-04-20 10:25:30】\ntrash")).otherwise(F.lit(""))
    return rows.select(F.col("doc_id").alias("info_id"), F.col("text").alias("job_detail"), "asr_result", "im_text", complaint.alias("complaint_content"), F.lit("2026-04-20 10:00:00").alias("publish_time"))


def _templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, prompts.TEMPLATE)


def _records(spark: SparkSession, d: str, path: str) -> DataFrame:
    settings = records.Settings(lexicon=LEXICON, keywords=RISK_WORDS)
    return records.run_records(_wide(spark, d), RuleClient, _templates(spark), ReplyStore(path), settings)


def run_records(spark: SparkSession, d: str) -> DataFrame:
    """The whole path of every post, its replies stored."""
    made = _records(spark, d, files.shared_folder(spark))
    return made.select(
        "info_id", F.col("snippet_recall.has_recall").alias("has_recall"), F.col("temporal_signal.temporal_status").alias("temporal_status"), F.round("temporal_signal.confidence", 6).alias("confidence"),
        F.col("temporal_signal.duration_hours").alias("duration_hours"), F.col("temporal_signal.anchor_type").alias("anchor_type"), F.col("risk_record.is_filled").alias("is_filled"),
        F.col("decision_record.validity_type").alias("validity_type"), F.contains("decision_record.reason", F.lit("注意")).alias("has_hint"), "route", "error_type",
        F.array_join(F.transform("steps", lambda s: s["step_name"]), ",").alias("steps"), F.get_json_object(F.get("steps", F.lit(0))["payload_json"], "$.evidence_text.asr_text").alias("asr_text"),
        F.array_join(F.from_json(F.get("steps", F.lit(0))["payload_json"], "struct<rule_matches: array<struct<matched_bucket: string>>>")["rule_matches"]["matched_bucket"], ",").alias("buckets"),
    )


def stored_replies(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one store: documents of some sources first, then all of them; a reply tells which run asked."""
    store = ReplyStore(files.shared_folder(spark))
    requests = read(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("cache_key"), F.md5("text").alias("request"))
    asked = [store.fill(rows, "t", lambda _, run=run: lambda text: f"{run}:{text}") for run, rows in enumerate((requests.where("source < 'src5'"), requests, requests), 1)]
    return requests.join(store.read(spark, "t"), "cache_key").select("doc_id", F.col("reply"), F.lit(asked[2]).cast("long").alias("asked_last"))


def run_store_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Two writes of steps by (run_id, step_name), keys repeated in both, into partitions by day."""
    e = read(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("step_name"), "event_id", F.date_format("ts", "yyyyMMdd").cast("int").alias("pt"))
    path = f"{files.shared_folder(spark)}/steps"
    for rows, day in ((e.where("event_id % 3 <> 0"), "2026-01-01"), (e.where("event_id % 2 = 0"), "2026-02-01")):
        stores.upsert(path, rows, ["run_id", "step_name"], F.lit(day), ["event_id"])
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return spark.read.parquet(path).select("run_id", "step_name", F.col("pt").cast("long").alias("pt"), "event_id", day("created_at"), day("updated_at"))


def run_documents(spark: SparkSession, d: str) -> DataFrame:
    """Runs and steps of the whole path, stored twice, their JSON documents decoded again."""
    path = files.shared_folder(spark)
    made = _records(spark, d, path)
    store = stores.RunStore(f"{path}/store")
    for day in ("2026-01-01", "2026-01-02"):
        store.save(made, F.concat(F.lit("run-"), "info_id"), (F.col("info_id") % 3 + 20260401).cast("int"), F.lit(day), {"graph_version": "g1"})
    shapes = {"temporal_signal_json": (records.TEMPORAL, False), "decision_record_json": ("struct<validity_type: string, reason: string>", False), "wide_row_json": ("struct<publish_time: string>", True), "timing_ms_json": ("map<string, double>", False)}
    runs = stores.decoded(store.runs(spark), shapes)
    steps = store.steps(spark).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_steps"))
    return runs.join(steps, "run_id", "left").select(
        "run_id", "entity_key", "route", "has_temporal_signal", "has_decision_record", "has_timing_ms", F.col("temporal_signal.signal_type").alias("signal_type"), F.col("wide_row.publish_time").alias("publish_time"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"), F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"), F.coalesce("n_steps", F.lit(0)).alias("n_steps"),
    )


def lenient_documents(spark: SparkSession, d: str) -> DataFrame:
    """Events' properties, some of them broken, empty, of another kind, or with a field of a wrong type."""
    e = read(spark, d, "events")
    k = F.col("event_id") % 6
    text = F.when(k == 0, F.concat("props", F.lit("}x"))).when(k == 1, F.lit("")).when(k == 2, F.lit("[1]")).when(k == 3, F.lit('{"k": "many"}')).when(k == 4, F.lit(None)).otherwise(F.col("props"))
    made = stores.decoded(e.select("event_id", text.alias("props_json"), text.alias("result_json")), {"props_json": ("struct<k: bigint>", False), "result_json": ("struct<k: bigint>", True), "old_json": ("array<string>", False)})
    return made.select("event_id", "has_props", "has_result", "has_old", F.col("props").isNull().alias("no_props"), F.col("result").isNull().alias("no_result"), F.col("props.k").alias("k"))


def _outputs(spark: SparkSession, d: str, rows: str, flip: int) -> DataFrame:
    e = read(spark, d, "events").where(rows)
    review = F.col("event_id") % flip == 0
    key = F.concat_ws("::", "user_id", "event_type", F.lit("g1"), F.when(review, F.lit("fallback")))
    out = e.select(key.alias("publish_key"), F.concat_ws("::", "user_id", "event_type", F.lit("g1")).alias("line"), F.col("user_id").cast("string").alias("entity_key"), F.when(review, "fallback").otherwise("formal").alias("route"), F.col("event_id").cast("string").alias("record"), F.col("event_id").alias("updated_at"))
    last = out.groupBy("publish_key", "entity_key", "route").agg(F.max("updated_at").alias("updated_at"))  # a store has a key once
    return last.withColumn("record", F.col("updated_at").cast("string"))


def route_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Published records, both routes of some lines among them, and a rerun that flips routes: what is left, and the tombstones."""
    live, gone = stores.reconciled(_outputs(spark, d, "event_id % 5 <> 0", 3), _outputs(spark, d, "event_id % 5 = 0", 2), F.lit("2026-02-01"))
    live = live.select(F.lit("live").alias("state"), "publish_key", "entity_key", "route", "record", F.lit(None).cast("string").alias("reason"))
    return live.unionByName(gone.select(F.lit("gone").alias("state"), "publish_key", "entity_key", "route", F.lit(None).cast("string").alias("record"), "reason"))


def combined_outputs(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select(F.col("user_id").alias("info_id"), F.col("event_type").alias("reason"), F.col("event_id").alias("updated_at"))
    return stores.combined_outputs(rows.where("reason <> 'error'"), rows.where("reason = 'error' AND updated_at % 2 = 0"))


def annotation_append(spark: SparkSession, d: str) -> DataFrame:
    """Views as stored notes, errors and clicks as new ones, orders' customers as the known runs."""
    e = read(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("id"), F.date_format("ts", STAMP).alias("created_at"), F.col("event_type").alias("annotated_label"))
    runs = read(spark, d, "orders").select(F.col("o_custkey").alias("run_id"), F.concat(F.lit("e"), "o_custkey").alias("entity_key"))
    return stores.annotated(e.where("annotated_label = 'view' AND id % 40 = 0"), e.where("annotated_label IN ('error', 'click')"), runs).select("id", "run_id", "entity_key", "status", "annotation_count")


def batch_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a batch, taken while its rows are written."""
    rows, seen = stores.with_counters(_runs(spark, d), "batch")
    rows.write.parquet(f"{files.shared_folder(spark)}/rows")
    return spark.createDataFrame([seen.get], "processed_count long, formal_count long, fallback_count long")


def schedule_summary(spark: SparkSession, d: str) -> DataFrame:
    days = _runs(spark, d).groupBy("pt").agg(F.count(F.lit(1)).alias("processed_count"), F.count_if(F.col("route") == "formal").alias("formal_count"), F.count_if(F.col("route") == "fallback").alias("fallback_count"))
    return stores.days_summary(days.withColumn("error_message", F.when(F.col("processed_count") % 3 == 0, "stopped")))


def nested_rename(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(
        "event_id", F.struct(F.col("user_id").alias("user_id"), F.array(F.struct(F.col("event_type").alias("event_type"))).alias("all_types"), F.create_map(F.lit("a_key"), F.struct(F.col("value").alias("one_value"))).alias("by_key")).alias("run_record")
    )
    back = naming.renamed(naming.renamed(e), naming.snake)
    return naming.renamed(e).select(F.col("eventId").alias("event_id"), F.to_json("runRecord").alias("record"), F.lit(back.schema == e.schema).alias("same"))


def prompt_messages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as payloads of three template versions, one of them unknown."""
    known = spark.createDataFrame([("t", "v1", "  Be brief. ", "Judge:\n{{payload}}\n{{payload}}"), ("t", "v2", "[SYSTEM]\nBe long.", "{{payload}}"), ("u", "v1", "x", "y")], prompts.TEMPLATE)
    version = F.concat(F.lit("v"), (F.col("doc_id") % 3 + 1).cast("string"))
    made = prompts.with_prompt(read(spark, d, "documents"), known, "t", version, F.md5("text"))
    parts = prompts.messages(F.coalesce("prompt", F.lit("alone")))
    return made.select("doc_id", F.array_join(F.transform(parts, lambda m: F.concat_ws("=", m["role"], m["content"])), "|").alias("messages"), F.get_json_object(prompts.request(F.lit("m1"), F.col("prompt")), "$.messages[0].role").alias("first_role"))


def reply_contents(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    k = F.col("event_id") % 5
    choices = lambda content: F.concat(F.lit('{"choices": [{"message": {"role": "assistant", "content": "'), content, F.lit('"}}, {"message": {"content": "second"}}]}'))
    said = F.when(k == 0, F.lit('{"choices": []}')).when(k == 1, choices(F.lit(""))).when(k == 2, F.lit("{}")).when(k == 3, F.lit('{"choices": [{}]}')).otherwise(choices(F.col("event_type")))
    return e.select("event_id", prompts.reply_content(said).alias("content"), prompts.reply_fault(said).alias("fault"))


def sql_template(spark: SparkSession, d: str) -> DataFrame:
    """A template's window over the orders: from its first day to the last, the next day being left out."""
    read(spark, d, "orders").createOrReplaceTempView("ebbtide_orders")
    text = "SELECT o_orderkey, '${bizdate}' AS pt FROM ebbtide_orders WHERE o_orderdate >= '${publish_start}' AND o_orderdate < '${publish_end}' ORDER BY o_orderkey"
    return spark.sql(templates.rendered(text, "19960110", "19960101", "19960228"))


def page_and_total(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d).where("route = 'fallback'")
    return serving.page_with_total(runs.select("run_id", "updated_at"), 3, 20, F.col("updated_at").desc(), F.col("run_id").desc())


def most_common(spark: SparkSession, d: str) -> DataFrame:
    return serving.most_common(read(spark, d, "part"), F.col("p_brand"), F.col("p_partkey")).select("value", "n", "first")


def shown_distribution(spark: SparkSession, d: str) -> DataFrame:
    return serving.shown_distribution(read(spark, d, "documents"), F.when(F.col("lang") != "de", F.col("lang"))).select("label", "n", F.round("share", 9).alias("share"), F.round("bar", 9).alias("bar"))


def recent_events(spark: SparkSession, d: str) -> DataFrame:
    return serving.recent(read(spark, d, "events"), "event_id", 20, event_type="error", props="").select("event_id", "user_id", "event_type")


def complaint_times(spark: SparkSession, d: str) -> DataFrame:
    """Headers of several shapes, made from events: seconds, none, parts of one digit, and one that is no time."""
    e = read(spark, d, "events")
    text = F.concat(
        F.lit("【投诉1 "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("】x【投诉2  "), F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("】【通话1 2026-01-01 10:00:00】【投诉3 2026-13-01 10:00】"),
        F.lit("【投诉44 "), F.date_format("ts", "yyyy-M-d H:m:s"), F.lit("】【投诉 "), F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("】"),
    )
    return e.select("event_id", F.array_join(F.transform(times.complaint_times(text), lambda t: F.date_format(t, STAMP)), "|").alias("times"))


def closed_complaints(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where(risk.closed_complaint(F.col("text"), (*WORDS["filled"], *WORDS["unreachable"]))).select("doc_id")


def value_stats(spark: SparkSession, d: str) -> DataFrame:
    return times.value_stats(_delays(spark, d).withColumn("even", F.col("l_orderkey") % 4), ["even"], "h").select("even", "low", "high", "n", F.round("mean", 6).alias("mean"), "median")


def shown_values(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    k = F.col("event_id") % 4
    status = F.when(k == 0, "confirmed_filled").when(k == 1, "suspected_filled").when(k == 2, "not_filled")
    at = F.when(k == 0, F.date_format("ts", STAMP)).when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 2, F.lit("soon"))
    day = F.date_format("ts", "yyyyMMdd")
    pt = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("_"), day)).otherwise(F.lit("_legacy"))
    return e.select("event_id", naming.as_percent(F.when(k != 3, F.col("value") / 100)).alias("score"), naming.fill_label(status).alias("fill"), naming.time_label(at).alias("at"), naming.day_label(pt).alias("day"))


def allow_list(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "r_name", F.lit(", ,"), F.lower("r_name"), F.lit(",B ,"), "r_name")
    return read(spark, d, "region").select("r_regionkey", F.array_join(naming.allow_list(raw), "|").alias("items"), F.array_join(naming.allow_list(raw, lower=True), "|").alias("lower_items"))


def column_survey(spark: SparkSession, d: str) -> DataFrame:
    """A table whose older partitions lack a column: what each lacks, and the rows with the default filled in."""
    path = f"{files.shared_folder(spark)}/runs"
    runs = read(spark, d, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("note"), F.date_format("ts", "yyyyMMdd").alias("pt"))
    files.write_partition(runs.where("pt < '20240115'").drop("note"), path)
    files.write_partition(runs.where("pt >= '20240115'"), path)
    survey = files.column_survey(spark, path, ["run_id", "note"]).select("pt", F.array_join("lacks", ",").alias("lacks"))
    whole = files.with_defaults(files.scan(spark, path, schema=spark.read.schema("run_id long, note string, pt string").parquet(path).schema), {"note": "none"})
    return whole.groupBy("pt").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("note") == "none").alias("n_default")).join(survey, "pt").select("pt", "n", "n_default", "lacks")


QUERIES = {f.__name__: f for f in (
    run_records, stored_replies, run_store_upsert, run_documents, lenient_documents, route_reconciliation, combined_outputs, annotation_append, batch_counters, schedule_summary, nested_rename,
    prompt_messages, reply_contents, sql_template, page_and_total, most_common, shown_distribution, recent_events, complaint_times, closed_complaints, value_stats, shown_values, allow_list, column_survey,
)}

_R = """runs AS (SELECT 'run-' || event_id AS run_id, user_id AS entity_key, CASE WHEN event_type = 'error' THEN 'fallback' WHEN event_type <> 'view' THEN 'formal' END AS route,
 strftime(ts, '%Y-%m-%d') AS updated_at, strftime(ts, '%Y%m%d') AS pt FROM events)"""
_ANY = lambda words: " OR ".join(f"contains(text, '{w}')" for w in words)
_PATH = """c AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 3 = 0),
b AS (SELECT doc_id AS j, CASE WHEN o_orderkey IS NOT NULL THEN 'order ' || o_orderstatus ELSE '' END AS asr, contains(text, 'que ') OR contains(text, 'today') AS ta, contains(text, 'trash') AS td, conv_id IS NOT NULL AS ca
  FROM documents LEFT JOIN c ON conv_id = doc_id LEFT JOIN orders ON o_orderkey = doc_id),
r AS (SELECT j, asr, list_filter([CASE WHEN ta THEN 'absolute_time' END, CASE WHEN td THEN 'duration' END, CASE WHEN ca THEN 'absolute_time' END], lambda x: x IS NOT NULL) AS found FROM b),
s AS (SELECT *, CASE WHEN len(found) = 0 THEN 'silent' WHEN j % 11 = 3 THEN 'parse_error' WHEN j % 13 = 5 THEN 'schema_validation_error' WHEN j % 4 = 1 THEN 'skip' WHEN j % 7 = 2 THEN 'unknown_time_normalization_error' ELSE 'whole' END AS fate FROM r),
x AS (SELECT *, fate IN ('skip', 'whole') AS fine, fate = 'silent' OR (fate IN ('skip', 'whole') AND j % 3 <> 0) AS formal FROM s)"""
ORACLE_SQL: dict[str, str] = {
    "run_records": f"""WITH {_PATH} SELECT j AS info_id, fate <> 'silent' AS has_recall, CASE WHEN fate = 'silent' THEN 'no_signal' WHEN fine THEN 'has_signal' END AS temporal_status,
 CASE WHEN fate = 'silent' THEN 1.0 WHEN fate = 'skip' THEN 0.5 WHEN fate = 'whole' THEN greatest(0.5, round(0.1 * (j % 10), 6)) END::DOUBLE AS confidence, CASE WHEN fate = 'whole' THEN j % 50 END::BIGINT AS duration_hours,
 CASE WHEN fate IN ('silent', 'skip') THEN 'unknown' WHEN fate = 'whole' THEN 'publish_time' END AS anchor_type, CASE WHEN fate = 'silent' THEN false WHEN fate NOT IN ('parse_error', 'schema_validation_error') THEN j % 2 = 0 END AS is_filled,
 CASE WHEN fate = 'silent' THEN 'no_validity' WHEN fine THEN 'fuzzy_time' END AS validity_type, CASE WHEN fate = 'silent' THEN false WHEN fine THEN j % 2 = 0 END AS has_hint,
 CASE WHEN formal THEN 'formal' ELSE 'fallback' END AS route, CASE WHEN NOT fine AND fate <> 'silent' THEN fate END AS error_type,
 CASE fate WHEN 'silent' THEN '' WHEN 'skip' THEN 'signal_detection,final_decision' WHEN 'whole' THEN 'signal_detection,time_normalization,final_decision' WHEN 'unknown_time_normalization_error' THEN 'signal_detection,time_normalization' ELSE 'signal_detection' END AS steps,
 CASE WHEN fate <> 'silent' THEN asr END AS asr_text, CASE WHEN fate <> 'silent' THEN array_to_string(found, ',') END AS buckets FROM x""",
    "run_documents": f"""WITH {_PATH} SELECT 'run-' || j AS run_id, j::VARCHAR AS entity_key, CASE WHEN formal THEN 'formal' ELSE 'fallback' END AS route, fine OR fate = 'silent' AS has_temporal_signal, fine OR fate = 'silent' AS has_decision_record, false AS has_timing_ms,
 CASE WHEN fate = 'silent' THEN 'no_signal' WHEN fine THEN 'duration_only' END AS signal_type, '2026-04-20 10:00:00' AS publish_time, '2026-01-01' AS created_at, '2026-01-02' AS updated_at,
 CASE fate WHEN 'silent' THEN 0 WHEN 'skip' THEN 2 WHEN 'whole' THEN 3 WHEN 'unknown_time_normalization_error' THEN 2 ELSE 1 END::BIGINT AS n_steps FROM x""",
    "stored_replies": "WITH f AS (SELECT text, min(source) AS s FROM documents GROUP BY text) SELECT doc_id, CASE WHEN s < 'src5' THEN '1:' ELSE '2:' END || md5(text) AS reply, 0::BIGINT AS asked_last FROM documents JOIN f USING (text)",
    "run_store_upsert": "WITH e AS (SELECT user_id AS run_id, event_type AS step_name, strftime(ts, '%Y%m%d')::BIGINT AS pt, max(event_id) FILTER (WHERE event_id % 3 <> 0) AS a, max(event_id) FILTER (WHERE event_id % 2 = 0) AS b FROM events GROUP BY 1, 2, 3) "
    "SELECT run_id, step_name, pt, coalesce(b, a) AS event_id, CASE WHEN a IS NULL THEN '2026-02-01' ELSE '2026-01-01' END AS created_at, CASE WHEN b IS NULL THEN '2026-01-01' ELSE '2026-02-01' END AS updated_at FROM e WHERE a IS NOT NULL OR b IS NOT NULL",
    "lenient_documents": "SELECT event_id, event_id % 6 IN (3, 5) AS has_props, event_id % 6 IN (3, 5) AS has_result, false AS has_old, event_id % 6 NOT IN (3, 5) AS no_props, false AS no_result, CASE WHEN event_id % 6 = 5 THEN json_extract(props, '$.k')::BIGINT END AS k FROM events",
    "route_reconciliation": "WITH o AS (SELECT event_id % 5 = 0 AS fresh, user_id || '::' || event_type || '::g1' AS line, user_id::VARCHAR AS entity_key, CASE WHEN event_id % (CASE WHEN event_id % 5 = 0 THEN 2 ELSE 3 END) = 0 THEN 'fallback' ELSE 'formal' END AS route, max(event_id) AS id FROM events GROUP BY 1, 2, 3, 4), "
    "k AS (SELECT *, line || CASE WHEN route = 'fallback' THEN '::fallback' ELSE '' END AS publish_key, row_number() OVER (PARTITION BY line ORDER BY fresh DESC, route = 'fallback' DESC, id DESC) AS place FROM o), "
    "t AS (SELECT line, publish_key AS top, fresh AS by_run FROM k WHERE place = 1) SELECT 'live' AS state, publish_key, entity_key, route, id::VARCHAR AS record, NULL AS reason FROM k WHERE place = 1 "
    "UNION ALL SELECT 'gone', publish_key, entity_key, route, NULL, CASE WHEN by_run THEN 'superseded' ELSE 'stale_route' END FROM k JOIN t USING (line) WHERE place > 1 AND publish_key <> top AND NOT fresh",
    "combined_outputs": "SELECT info_id, reason, id AS updated_at, route FROM (SELECT user_id AS info_id, event_type AS reason, event_id AS id, CASE WHEN event_type = 'error' THEN 'fallback' ELSE 'formal' END AS route, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'error' DESC, event_id DESC) AS k FROM events WHERE event_type <> 'error' OR event_id % 2 = 0) WHERE k = 1",
    "annotation_append": "WITH s AS (SELECT user_id AS u, count(*) AS c FROM events WHERE event_type = 'view' AND event_id % 40 = 0 GROUP BY 1), r AS (SELECT DISTINCT o_custkey AS u FROM orders), "
    "n AS (SELECT event_id AS id, user_id AS run_id, coalesce(c, 0) AS c, r.u IS NOT NULL AS known, row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S'), event_id) AS k FROM events LEFT JOIN s ON s.u = user_id LEFT JOIN r ON r.u = user_id WHERE event_type IN ('error', 'click')) "
    "SELECT id, run_id, CASE WHEN known THEN 'e' || run_id END AS entity_key, CASE WHEN NOT known THEN 'unknown_run' WHEN c + k > 3 THEN 'max_reached' ELSE 'annotated' END AS status, CASE WHEN known THEN greatest(c, least(c + k, 3)) END::BIGINT AS annotation_count FROM n",
    "batch_counters": f"WITH {_R} SELECT count(*)::BIGINT AS processed_count, count_if(route = 'formal')::BIGINT AS formal_count, count_if(route IS DISTINCT FROM 'formal')::BIGINT AS fallback_count FROM runs",
    "schedule_summary": f"WITH {_R}, d AS (SELECT pt, count(*) AS p, count_if(route = 'formal') AS f, count_if(route = 'fallback') AS b FROM runs GROUP BY 1) SELECT count(*)::BIGINT AS total_days, count_if(p % 3 <> 0)::BIGINT AS success_days, count_if(p % 3 = 0)::BIGINT AS failed_days, "
    "coalesce(sum(p) FILTER (WHERE p % 3 <> 0), 0)::BIGINT AS processed_count, coalesce(sum(f) FILTER (WHERE p % 3 <> 0), 0)::BIGINT AS formal_count, coalesce(sum(b) FILTER (WHERE p % 3 <> 0), 0)::BIGINT AS fallback_count FROM d",
    "nested_rename": """SELECT event_id, '{"userId":' || user_id || ',"allTypes":[{"eventType":"' || event_type || '"}],"byKey":{"a_key":{"oneValue":' || value || '}}}' AS record, true AS same FROM events""",
    "prompt_messages": "WITH d AS (SELECT doc_id, doc_id % 3 AS k, md5(text) AS p FROM documents) SELECT doc_id, CASE k WHEN 0 THEN 'system=Be brief.|user=Judge:' || chr(10) || p || chr(10) || p WHEN 1 THEN 'system=Be long.|user=' || p ELSE 'user=alone' END AS messages, CASE WHEN k < 2 THEN 'system' END AS first_role FROM d",
    "reply_contents": "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN event_type END AS content, CASE event_id % 5 WHEN 0 THEN 'llm_response_no_choices' WHEN 2 THEN 'llm_response_no_choices' WHEN 1 THEN 'llm_response_empty_content' WHEN 3 THEN 'llm_response_empty_content' END AS fault FROM events",
    "sql_template": "SELECT o_orderkey, '19960110' AS pt FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1996-02-29'",
    "page_and_total": f"WITH {_R} SELECT run_id, updated_at, (SELECT count(*) FROM runs WHERE route = 'fallback')::BIGINT AS total FROM runs WHERE route = 'fallback' ORDER BY updated_at DESC, run_id DESC LIMIT 20 OFFSET 3",
    "most_common": 'SELECT p_brand AS value, count(*)::BIGINT AS n, min(p_partkey) AS first FROM part GROUP BY 1',
    "shown_distribution": "SELECT label, n::BIGINT AS n, round(n / sum(n) OVER (), 9) AS share, round(n / max(n) OVER (), 9) AS bar FROM (SELECT coalesce(CASE WHEN lang <> 'de' THEN lang END, 'unknown') AS label, count(*) AS n FROM documents GROUP BY 1)",
    "recent_events": "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 20",
    "complaint_times": "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || '|' || strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') || '|' || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS times FROM events",
    "closed_complaints": f"SELECT doc_id FROM documents WHERE {_ANY((*WORDS['filled'], *WORDS['unreachable']))}",
    "value_stats": f"WITH {DELAYS} SELECT l_orderkey % 4 AS even, min(h) AS low, max(h) AS high, count(*)::BIGINT AS n, round(avg(h), 6) AS mean, list_sort(list(h))[(count(*) // 2 + 1)::BIGINT] AS median FROM h GROUP BY 1",
    "shown_values": "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '-' ELSE round(value / 100 * 100)::BIGINT || '%' END AS score, CASE event_id % 4 WHEN 0 THEN '明确招满' WHEN 1 THEN '疑似招满' ELSE '未招满' END AS fill, "
    "CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts + INTERVAL 8 HOUR, '%Y/%-m/%-d %H:%M:%S') WHEN 2 THEN 'soon' ELSE '-' END AS at, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d ~ %Y-%m-%d') ELSE '_legacy' END AS day FROM events",
    "allow_list": "SELECT r_regionkey, r_name || '|' || CASE WHEN lower(r_name) <> r_name THEN lower(r_name) || '|' ELSE '' END || 'B' AS items, lower(r_name) || '|b' AS lower_items FROM region",
    "column_survey": "SELECT strftime(ts, '%Y%m%d') AS pt, count(*)::BIGINT AS n, CASE WHEN strftime(ts, '%Y%m%d') < '20240115' THEN count(*) ELSE 0 END::BIGINT AS n_default, CASE WHEN strftime(ts, '%Y%m%d') < '20240115' THEN 'note' ELSE '' END AS lacks FROM events GROUP BY 1",
}
