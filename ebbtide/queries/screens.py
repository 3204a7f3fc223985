"""Stores, serving and timing over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import times
from ebbtide.operators import keyed, serving, timing
from ebbtide.queries.build import STAMP, read
from ebbtide.sources import files


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Events as runs: errors went to review, views are unknown."""
    e = read(spark, d, "events")
    route = F.when(F.col("event_type") == "error", "fallback").when(F.col("event_type") != "view", "formal")
    return e.select(
        F.concat(F.lit("run-"), "event_id").alias("run_id"), F.col("user_id").alias("entity_key"), route.alias("route"), F.date_format("ts", "yyyy-MM-dd").alias("updated_at"),
        F.date_format("ts", "yyyyMMdd").alias("pt"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("validity_type"), "event_id",
    )


R = """runs AS (SELECT 'run-' || event_id AS run_id, user_id AS entity_key, CASE WHEN event_type = 'error' THEN 'fallback' WHEN event_type <> 'view' THEN 'formal' END AS route,
 strftime(ts, '%Y-%m-%d') AS updated_at, strftime(ts, '%Y%m%d') AS pt, CASE WHEN event_type <> 'view' THEN event_type END AS validity_type, event_id FROM events)"""


def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return files.by_ids(read(spark, d, "orders"), [" 1", "7", "", "33", "7", "none"], "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


def online_not_found(spark: SparkSession, d: str) -> DataFrame:
    ids = spark.createDataFrame([([" 1", "x9", "", "7", "x9", "-5", "abc"],)], "ids array<string>")
    missing = serving.not_found(serving.in_request_order(ids), read(spark, d, "orders"), "o_orderkey")
    return missing.select(F.col("place").cast("long").alias("place"), "id")


def search_ilike_top50(spark: SparkSession, d: str) -> DataFrame:
    return serving.search(read(spark, d, "customer"), "c_name", "ER#0000001", F.col("c_acctbal").desc(), F.col("c_custkey")).select("c_custkey", "c_name")


def runs_page(spark: SparkSession, d: str) -> DataFrame:
    return serving.runs_page(_runs(spark, d), None, None, 5, 20).select("run_id", "entity_key", "updated_at")


def run_detail(spark: SparkSession, d: str) -> DataFrame:
    """Orders as runs of their customer, line items as steps, events of that user number as annotations."""
    runs = read(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("entity_key"), F.col("o_orderstatus").alias("route"))
    li = read(spark, d, "lineitem")
    no = F.lit(None).cast("string")
    steps = li.select(
        F.col("l_orderkey").alias("run_id"), F.concat_ws("-", "l_linenumber", "l_partkey").alias("step_name"), F.lit("p1").alias("prompt_version"), F.lit("m1").alias("model_version"),
        F.col("l_linestatus").alias("payload_json"), F.col("l_returnflag").alias("result_json"), no.alias("error_type"), F.col("l_shipdate").alias("created_at"),
    )
    e = read(spark, d, "events")
    notes = e.select(F.col("user_id").alias("entity_key"), F.col("event_type").alias("annotated_label"), F.col("props").alias("reviewer_notes"), no.alias("reviewer_name"), F.col("ts").alias("created_at"), F.col("event_id").alias("id"))
    found = serving.run_details(runs, steps, notes)
    step = lambda s: F.concat_ws("|", s["step_name"], s["payload_json"], s["result_json"])
    return found.select(
        "run_id", "entity_key", "route", F.array_join(F.transform("steps", step), ";").alias("steps"), F.array_join(F.transform("annotations", lambda n: F.concat_ws(":", n["id"], n["annotated_label"])), ";").alias("annotations")
    )


def latest_run_ties(spark: SparkSession, d: str) -> DataFrame:
    return keyed.latest_with_ties(_runs(spark, d), "entity_key", "updated_at").select("entity_key", "run_id", "updated_at")


def annotated_docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "lang")


def unannotated_docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "lang")


def incremental_skip(spark: SparkSession, d: str) -> DataFrame:
    todo = keyed.not_yet_done(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id")
    return todo.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def route_stats(spark: SparkSession, d: str) -> DataFrame:
    return serving.route_stats(_runs(spark, d))


def validity_distribution(spark: SparkSession, d: str) -> DataFrame:
    return serving.distribution(_runs(spark, d), F.col("validity_type"))


def range_stats(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    first = runs.agg(F.min("pt")).first()[0]
    days = serving.days_between(spark, first, spark.sql("SELECT date_format(date_add(to_date(:a, 'yyyyMMdd'), 9), 'yyyyMMdd')", args={"a": first}).first()[0])
    return days.join(serving.route_stats(runs, "pt"), "pt", "left").select("pt", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("formal", "fallback", "total")])


def daily_summary(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    told = runs.where(F.substring("pt", 7, 2) == "01").groupBy("pt").agg(F.count(F.lit(1)).alias("processed_count"), F.lit(1).cast("long").alias("formal_count"), F.lit(2).cast("long").alias("fallback_count"))
    return serving.daily_summary(runs, told)


def distribution_share(spark: SparkSession, d: str) -> DataFrame:
    return serving.distribution(read(spark, d, "lineitem"), F.col("l_returnflag"))


def _partitions(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.date_format("ts", "yyyyMMdd").alias("day"), "event_id")
    pt = F.when(F.col("event_id") % 7 == 0, "_legacy").when(F.col("event_id") % 5 == 0, F.concat("day", F.lit("_"), "day")).when(F.col("event_id") % 3 == 0, "20251399").otherwise(F.col("day"))
    return e.select(pt.alias("pt"))


def list_partitions(spark: SparkSession, d: str) -> DataFrame:
    return serving.partitions(_partitions(spark, d))


def latest_partition(spark: SparkSession, d: str) -> DataFrame:
    return serving.latest_partition(_partitions(spark, d))


def last_event_per_user(spark: SparkSession, d: str) -> DataFrame:
    return serving.last_and_count(read(spark, d, "events"), "user_id", "event_id", "event_type", "props")


def annotation_cap(spark: SparkSession, d: str) -> DataFrame:
    return keyed.capped(read(spark, d, "events").select("user_id", "event_id"), "user_id", 3, "event_id")


def keyed_merge(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lit("old").alias("version"), F.date_format("o_orderdate", STAMP).alias("created_at"))
    old = o.where("o_orderkey % 3 <> 0")
    new = o.where("o_orderkey % 2 = 0").withColumns({"version": F.lit("new"), "created_at": F.lit("2026-01-01 00:00:00")})
    return keyed.merged(old, new, "o_orderkey", "created_at")


def keyed_last(spark: SparkSession, d: str) -> DataFrame:
    return keyed.last_of_key(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_extendedprice").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"))


def keyed_delete(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "orders").select(keyed.publish_key(F.col("o_orderkey").cast("string"), F.lit("s1"), F.lit("g1"), F.col("o_orderstatus") == "F").alias("publish_key"))
    return keyed.without_prefix(keys, "publish_key", "1")


def cache_key(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", keyed.cache_key(F.col("doc_id").cast("string"), F.md5("text"), F.lit("g1"), F.lit("p1"), F.lit("m1")).alias("cache_key"))


def upper_median_stats(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    stats = e.groupBy("event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"))
    return stats.join(times.upper_median_by_rank(e, ["event_type"], "value"), "event_type")


def _delays(spark: SparkSession, d: str) -> DataFrame:
    o, li = read(spark, d, "orders"), read(spark, d, "lineitem")
    hours = times.hours_between(F.col("o_orderdate"), F.col("l_shipdate")) / 20 - 1
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(hours.alias("h"), "l_orderkey")


DELAYS = "h AS (SELECT (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 / 20 - 1 AS h, l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


def hour_bucket_hist(spark: SparkSession, d: str) -> DataFrame:
    return timing.bucket_table(_delays(spark, d), F.col("h")).select("place", "bucket", "n", F.round("pct", 6).alias("pct"))


def bucket_table_with_total(spark: SparkSession, d: str) -> DataFrame:
    return timing.bucket_table(_delays(spark, d), F.col("h"), total=True).select("place", "bucket", "n")


def fixed_bins(spark: SparkSession, d: str) -> DataFrame:
    return timing.fixed_bins(_delays(spark, d), F.col("h"), -5.0, 150.0, 2.5)


def complaint_count_distribution(spark: SparkSession, d: str) -> DataFrame:
    return timing.count_distribution(read(spark, d, "events").where("event_type = 'error'"), "user_id")


def _first_delta(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    signup = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("published"))
    errors = e.where("event_type = 'error'").groupBy("user_id").agg(F.min("ts").alias("first"), F.count(F.lit(1)).alias("n_errors"), F.max(F.col("value") > 50).alias("is_filled"))
    both = signup.join(errors, "user_id")
    whole = lambda c: F.date_trunc("second", c)
    return both.select("user_id", F.round(times.hours_between(whole("published"), whole("first")), 6).alias("hours"), "n_errors", "is_filled")


FIRST = """s AS (SELECT user_id, min(ts) AS p FROM events WHERE event_type = 'signup' GROUP BY 1),
 e AS (SELECT user_id, min(ts) AS f, count(*) AS n_errors, max((value > 50)::INT) = 1 AS is_filled FROM events WHERE event_type = 'error' GROUP BY 1),
 delta AS (SELECT user_id, round((epoch(date_trunc('second', f)) - epoch(date_trunc('second', p))) / 3600.0, 6) AS hours, n_errors, is_filled FROM s JOIN e USING (user_id))"""


def first_delta(spark: SparkSession, d: str) -> DataFrame:
    return _first_delta(spark, d).select("user_id", "hours")


def all_delta(spark: SparkSession, d: str) -> DataFrame:
    """From the first sign-up to every error, by error; a user without either has no row."""
    e = read(spark, d, "events")
    signup = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("published"))
    whole = lambda c: F.date_trunc("second", c)
    both = e.where("event_type = 'error'").select("event_id", "user_id", "ts").join(signup, "user_id")
    return both.select("event_id", "user_id", F.round(times.hours_between(whole("published"), whole("ts")), 6).alias("hours"))


def filled_split(spark: SparkSession, d: str) -> DataFrame:
    return _first_delta(spark, d).groupBy("is_filled").agg(F.count(F.lit(1)).alias("n"), F.min("hours").alias("low"), F.max("hours").alias("high"))


def rate_by_count(spark: SparkSession, d: str) -> DataFrame:
    return timing.rate_by_count(_first_delta(spark, d), "n_errors", "is_filled").select("n_errors", "n", F.round("rate", 6).alias("rate"))


def share_below(spark: SparkSession, d: str) -> DataFrame:
    return _delays(spark, d).agg(F.round(F.avg((F.col("h") < 6).cast("int")), 9).alias("share"))


def _flags(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    docs = read(spark, d, "documents").join(read(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")), "doc_id", "left")
    temporal, normal = F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("doc_id") % 3 == 0
    return docs, {"temporal": temporal, "normalizable": normal, "expiry": F.col("n_chars") > 1000, "complaint": F.coalesce(F.col("toxic") == 1, F.lit(False))}


FLAGS = "f AS (SELECT doc_id, coalesce(quality = 1, false) AS t, doc_id % 3 = 0 AS n, n_chars > 1000 AS e, coalesce(toxic = 1, false) AS c, doc_id % 4 = 0 AS filled FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id))"


def label_source(spark: SparkSession, d: str) -> DataFrame:
    docs, f = _flags(spark, d)
    return docs.groupBy(timing.label_source(f["temporal"], f["normalizable"], f["expiry"], f["complaint"]).alias("label_source")).agg(F.count(F.lit(1)).alias("n"))


def matrix_overlap(spark: SparkSession, d: str) -> DataFrame:
    docs, f = _flags(spark, d)
    sets = timing.label_sets(f["temporal"], f["normalizable"], f["expiry"], f["complaint"], F.col("doc_id") % 4 == 0)
    return docs.agg(*[F.count_if(s).alias(f"n_{k.lower()}") for k, s in sets.items()])


def matrix_exclusive(spark: SparkSession, d: str) -> DataFrame:
    docs, f = _flags(spark, d)
    return docs.groupBy(timing.label_class(f["temporal"], f["normalizable"], f["expiry"], f["complaint"], F.col("doc_id") % 4 == 0).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def batch_run_ids(spark: SparkSession, d: str) -> DataFrame:
    """Run ids by entity and versions, so that a rerun of a partition meets its own rows."""
    o = read(spark, d, "orders")
    return o.select("o_orderkey", F.concat(F.lit("run-"), F.substring(F.sha2(F.concat_ws("::", "o_orderkey", F.lit("g1"), F.lit("s1")), 256), 1, 16)).alias("run_id"))


QUERIES = {f.__name__: f for f in (
    point_lookup, online_not_found, search_ilike_top50, runs_page, run_detail, latest_run_ties, annotated_docs, unannotated_docs, incremental_skip, route_stats, validity_distribution,
    range_stats, daily_summary, distribution_share, list_partitions, latest_partition, last_event_per_user, annotation_cap, keyed_merge, keyed_last, keyed_delete, cache_key,
    upper_median_stats, hour_bucket_hist, bucket_table_with_total, fixed_bins, complaint_count_distribution, first_delta, all_delta, filled_split, rate_by_count, share_below,
    label_source, matrix_overlap, matrix_exclusive, batch_run_ids,
)}

_BUCKET = "CASE " + " ".join(f"WHEN h < {end} THEN '{label}'" for end, label in times.HOUR_BUCKETS) + f" ELSE '{times.LAST_BUCKET}' END"
_PLACE = "CASE bucket " + " ".join(f"WHEN '{label}' THEN {i}" for i, label in enumerate([x for _, x in times.HOUR_BUCKETS] + [times.LAST_BUCKET], 1)) + " END"
_DIST = "SELECT label, n::BIGINT AS n, n / sum(n) OVER () AS share, n / max(n) OVER () AS bar FROM (SELECT {0} AS label, count(*) AS n FROM {1} GROUP BY 1)"
_PARTS = """p AS (SELECT CASE WHEN event_id % 7 = 0 THEN '_legacy' WHEN event_id % 5 = 0 THEN strftime(ts, '%Y%m%d') || '_' || strftime(ts, '%Y%m%d') WHEN event_id % 3 = 0 THEN '20251399' ELSE strftime(ts, '%Y%m%d') END AS pt FROM events)"""

ORACLE_SQL = {
    "point_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN (1, 7, 33)",
    "online_not_found": "SELECT (i - 1)::BIGINT AS place, id FROM (SELECT unnest(['1', 'x9', '7', '-5', 'abc']) AS id, unnest([1, 2, 3, 4, 5]) AS i) WHERE id NOT IN (SELECT o_orderkey::VARCHAR FROM orders)",
    "search_ilike_top50": "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%ER#0000001%' ORDER BY c_acctbal DESC, c_custkey LIMIT 50",
    "runs_page": f"WITH {R} SELECT run_id, entity_key, updated_at FROM (SELECT *, rank() OVER (PARTITION BY entity_key ORDER BY updated_at DESC) AS k FROM runs) WHERE k = 1 ORDER BY updated_at DESC, run_id DESC LIMIT 20 OFFSET 5",
    "run_detail": "WITH s AS (SELECT l_orderkey, string_agg(l_linenumber || '-' || l_partkey || '|' || l_linestatus || '|' || l_returnflag, ';' ORDER BY l_shipdate, l_linenumber || '-' || l_partkey) AS steps FROM lineitem GROUP BY 1), "
    "n AS (SELECT user_id, string_agg(event_id || ':' || event_type, ';' ORDER BY ts, event_id) AS notes FROM events GROUP BY 1) "
    "SELECT o_orderkey AS run_id, o_custkey AS entity_key, o_orderstatus AS route, coalesce(s.steps, '') AS steps, coalesce(n.notes, '') AS annotations FROM orders LEFT JOIN s ON l_orderkey = o_orderkey LEFT JOIN n ON user_id = o_custkey",
    "latest_run_ties": f"WITH {R} SELECT entity_key, run_id, updated_at FROM runs r WHERE updated_at = (SELECT max(updated_at) FROM runs q WHERE q.entity_key = r.entity_key)",
    "annotated_docs": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "unannotated_docs": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "incremental_skip": "SELECT source, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars FROM documents ANTI JOIN labels USING (doc_id) GROUP BY 1",
    "route_stats": f"WITH {R} SELECT count_if(route = 'formal')::BIGINT AS formal, count_if(route = 'fallback')::BIGINT AS fallback, count(*)::BIGINT AS total FROM runs",
    "validity_distribution": f"WITH {R} " + _DIST.format("coalesce(validity_type, 'unknown')", "runs"),
    "range_stats": f"WITH {R}, d AS (SELECT strftime(x, '%Y%m%d') AS pt FROM (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events)::TIMESTAMP, (SELECT min(ts)::DATE + 9 FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS x)) "
    "SELECT d.pt, count_if(route = 'formal')::BIGINT AS formal, count_if(route = 'fallback')::BIGINT AS fallback, count(run_id)::BIGINT AS total FROM d LEFT JOIN runs ON runs.pt = d.pt GROUP BY 1",
    "daily_summary": f"WITH {R} SELECT pt, CASE WHEN substr(pt, 7, 2) = '01' THEN 1 ELSE count_if(route = 'formal') END::BIGINT AS formal, CASE WHEN substr(pt, 7, 2) = '01' THEN 2 ELSE count_if(route = 'fallback') END::BIGINT AS fallback, "
    "CASE WHEN substr(pt, 7, 2) = '01' THEN count(*) ELSE count_if(route IS NOT NULL) END::BIGINT AS total FROM runs GROUP BY pt",
    "distribution_share": _DIST.format("l_returnflag", "lineitem"),
    "list_partitions": f"WITH {_PARTS} SELECT pt, n, row_number() OVER (ORDER BY CASE WHEN pt = '_legacy' THEN 2 WHEN length(pt) = 8 THEN 0 ELSE 1 END, pt DESC)::BIGINT AS place FROM (SELECT pt, count(*)::BIGINT AS n FROM p WHERE pt <> '20251399' GROUP BY 1)",
    "latest_partition": f"WITH {_PARTS} SELECT max(pt) AS pt FROM p WHERE length(pt) = 8 AND try_strptime(pt, '%Y%m%d') IS NOT NULL",
    "last_event_per_user": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(props, event_id) AS props, count(*)::BIGINT AS event_count FROM events GROUP BY 1",
    "annotation_cap": "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k <= 3",
    "keyed_merge": "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS version, CASE WHEN o_orderkey % 6 = 0 THEN '2026-01-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_at FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0",
    "keyed_last": "SELECT l_orderkey, max(l_linenumber)::BIGINT AS l_linenumber FROM lineitem GROUP BY 1",
    "keyed_delete": "SELECT k AS publish_key FROM (SELECT o_orderkey || '::s1::g1' || CASE WHEN o_orderstatus = 'F' THEN '::fallback' ELSE '' END AS k FROM orders) WHERE NOT starts_with(k, '1')",
    "cache_key": "SELECT doc_id, sha256(doc_id || '::' || md5(text) || '::g1::p1::m1') AS cache_key FROM documents",
    "upper_median_stats": "SELECT event_type, min(value) AS low, max(value) AS high, count(value)::BIGINT AS n, list_sort(list(value))[(count(value) // 2 + 1)::BIGINT] AS median FROM events GROUP BY 1",
    "hour_bucket_hist": f"WITH {DELAYS}, b AS (SELECT {_BUCKET} AS bucket, count(*) AS n FROM h GROUP BY 1) SELECT ({_PLACE})::BIGINT AS place, bucket, n::BIGINT AS n, round(n * 100.0 / sum(n) OVER (), 6) AS pct FROM b",
    "bucket_table_with_total": f"WITH {DELAYS}, b AS (SELECT {_BUCKET} AS bucket, count(*) AS n FROM h GROUP BY 1) SELECT ({_PLACE})::BIGINT AS place, bucket, n::BIGINT AS n FROM b UNION ALL SELECT 99, 'total', sum(n)::BIGINT FROM b",
    "fixed_bins": f"WITH {DELAYS} SELECT floor((h + 5) / 2.5)::BIGINT AS bin, count(*)::BIGINT AS n FROM h WHERE h BETWEEN -5 AND 150 GROUP BY 1",
    "complaint_count_distribution": "SELECT n_per_key, count(*)::BIGINT AS n_keys FROM (SELECT count(*)::BIGINT AS n_per_key FROM events WHERE event_type = 'error' GROUP BY user_id) GROUP BY 1",
    "first_delta": f"WITH {FIRST} SELECT user_id, hours FROM delta",
    "all_delta": f"WITH {FIRST} SELECT event_id, user_id, round((epoch(date_trunc('second', ts)) - epoch(date_trunc('second', p))) / 3600.0, 6) AS hours FROM events JOIN s USING (user_id) WHERE event_type = 'error'",
    "filled_split": f"WITH {FIRST} SELECT is_filled, count(*)::BIGINT AS n, min(hours) AS low, max(hours) AS high FROM delta GROUP BY 1",
    "rate_by_count": f"WITH {FIRST} SELECT n_errors, count(*)::BIGINT AS n, round(avg(is_filled::INT) * 100, 6) AS rate FROM delta GROUP BY 1",
    "share_below": f"WITH {DELAYS} SELECT round(avg((h < 6)::INT), 9) AS share FROM h",
    "label_source": f"WITH {FLAGS} SELECT CASE WHEN t AND n AND NOT c THEN '文本时效信号' WHEN t AND NOT n AND NOT c THEN '模糊时效信号' WHEN e AND c THEN '仅投诉' WHEN NOT e THEN '无法打标' ELSE '其他' END AS label_source, count(*)::BIGINT AS n FROM f GROUP BY 1",
    "matrix_overlap": f"WITH {FLAGS}, g AS (SELECT t AND n AND NOT c AS a, t AND NOT n AND NOT c AS b, e AND c AS cc, NOT t AND NOT filled AND NOT e AS d, NOT t AND filled AS ee FROM f) SELECT count_if(a)::BIGINT AS n_a, count_if(b)::BIGINT AS n_b, count_if(cc)::BIGINT AS n_c, count_if(d)::BIGINT AS n_d, count_if(ee)::BIGINT AS n_e, count_if(NOT (a OR b OR cc OR d OR ee))::BIGINT AS n_f FROM g",
    "matrix_exclusive": f"WITH {FLAGS} SELECT CASE WHEN t AND n AND NOT c THEN 'A' WHEN t AND NOT n AND NOT c THEN 'B' WHEN e AND c THEN 'C' WHEN NOT t AND filled THEN 'E' WHEN NOT t AND NOT filled AND NOT e THEN 'D' ELSE 'F' END AS class, count(*)::BIGINT AS n FROM f GROUP BY 1",
    "batch_run_ids": "SELECT o_orderkey, 'run-' || substr(sha256(o_orderkey || '::g1::s1'), 1, 16) AS run_id FROM orders",
}
