"""Stored replies, records, the result store, names and templates."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import modeljson as mj
from ebbtide.functions import times
from ebbtide.operators import naming, serving, stores
from ebbtide.plans import prompts, records
from ebbtide.sources import files, templates
from ebbtide.sources.replies import ReplyStore

LEXICON = {"term_buckets": {"absolute_time_terms": ["today"], "complaint_terms": ["nobody"]}, "regex_patterns": {}}
DETECTED = {"has_temporal_signal": True, "temporal_status": "has_signal", "signal_type": "duration_only", "evidence_summary": ["x"], "confidence": 0.4}
REPLIES = {
    "signal_detection": json.dumps(DETECTED), "time_normalization": '{"normalizable": true, "anchor_type": "call_time", "duration_hours": 5, "interpretation": "i", "confidence": 0.9}',
    "final_decision": '{"validity_type": "exact_date", "estimated_expiry": "2026-04-21", "reason": "said", "low_confidence": false}',
}


def wide(spark, rows):
    fields = "info_id string, job_detail string, asr_result string, im_text string, complaint_content string, publish_time string"
    return spark.createDataFrame([(i, text, "", "", "", "2026-04-20 10:00:00") for i, text in rows], fields)


def known(spark):
    return spark.createDataFrame([(t, v, f"sys {v}", "{{payload}}") for t in records.STEPS for v in ("v1", "v2")], prompts.TEMPLATE)


def client(path, replies=REPLIES, chat=False):
    """A client that writes a file a call."""

    class Counting:
        def complete(self, task, payload):
            with open(f"{path}/calls", "a") as f:
                f.write(task + "\n")
            reply = replies[task]
            if isinstance(reply, Exception):
                raise reply
            return json.dumps({"choices": [{"message": {"content": reply}}]}) if chat else reply

    return Counting


def calls(path):
    try:
        with open(f"{path}/calls") as f:
            return f.read().split()
    except FileNotFoundError:
        return []


def test_a_second_run_asks_nothing(spark, tmp_path):
    rows = wide(spark, [("a", "today"), ("b", "today too"), ("c", "nobody"), ("d", "silent"), ("b", "today too")])
    settings = records.Settings(lexicon=LEXICON, chat=True, calls_a_minute=6000)
    store = ReplyStore(f"{tmp_path}/store")
    run = lambda s=settings: {r.info_id: r for r in records.run_records(rows, client(tmp_path, chat=True), known(spark), store, s).collect()}
    got = run()
    assert sorted(calls(tmp_path)) == sorted(2 * list(records.STEPS))  # repeated rows are asked once
    assert got["a"].route == "formal" and got["a"].temporal_signal.confidence == 0.9 and got["a"].temporal_signal.duration_hours == 5 and got["a"].decision_record.validity_type == "exact_date"
    assert [s.step_name for s in got["a"].steps] == list(records.STEPS) and json.loads(got["a"].steps[0].payload_json)["rule_matches"] == [{"source": "job_detail", "matched_bucket": "absolute_time", "matched_terms": ["today"]}]
    second = json.loads(got["a"].steps[1].payload_json)
    assert second["job_id"] == "a" and second["signal_detection"] == {"temporal_status": "has_signal", "signal_type": "duration_only", "evidence_summary": ["x"]}
    assert json.loads(got["a"].steps[2].payload_json)["temporal_signal_record"]["anchor_type"] == "call_time"
    for silent in ("c", "d"):
        assert got[silent].temporal_signal.confidence == 1.0 and got[silent].risk_record.fill_status == "not_filled" and got[silent].decision_record.validity_type == "no_validity" and got[silent].steps == []
    assert run() == got and len(calls(tmp_path)) == 6
    run(settings.with_prompt_version("final_decision", "v2"))
    assert calls(tmp_path)[6:] == ["final_decision"] * 2  # another version is another key


def test_an_unknown_prompt_version_is_an_error_of_its_rows(spark, tmp_path):
    settings = records.Settings(lexicon=LEXICON).with_prompt_version("signal_detection", "v9")
    one = records.run_records(wide(spark, [("a", "today")]), client(tmp_path), known(spark), ReplyStore(f"{tmp_path}/store"), settings).first()
    assert (one.error_type, one.risk_record) == ("unknown_signal_detection_error", None) and calls(tmp_path) == []


def test_failures_are_tried_again_by_the_next_run(spark, tmp_path):
    rows, store, settings = wide(spark, [("a", "today")]), ReplyStore(f"{tmp_path}/store"), records.Settings(lexicon=LEXICON)
    failing = REPLIES | {"time_normalization": ValueError("no")}
    one = records.run_records(rows, client(tmp_path, failing), known(spark), store, settings).first()
    assert (one.route, one.error_type, one.temporal_signal, one.decision_record) == ("fallback", "unknown_time_normalization_error", None, None)
    assert one.risk_record is not None and [s.error_type for s in one.steps] == [None, "unknown_time_normalization_error"]
    again = records.run_records(rows, client(tmp_path), known(spark), store, settings).first()
    assert again.route == "formal" and calls(tmp_path) == ["signal_detection", "time_normalization", "time_normalization", "final_decision"]


def test_without_signal_normalisation_is_skipped(spark, tmp_path):
    replies = REPLIES | {"signal_detection": json.dumps(DETECTED | {"has_temporal_signal": False, "cannot_determine_reason": "vague"})}
    one = records.run_records(wide(spark, [("a", "today")]), client(tmp_path, replies), known(spark), ReplyStore(f"{tmp_path}/store"), records.Settings(lexicon=LEXICON)).first()
    signal = one.temporal_signal
    assert (signal.normalizable, signal.anchor_type, signal.duration_hours, signal.confidence, signal.cannot_determine_reason) == (False, "unknown", None, 0.4, "vague")
    assert one.time_normalization is None and calls(tmp_path) == ["signal_detection", "final_decision"]


def test_waves_and_tasks_ask_each_key_once(spark, tmp_path):
    store = ReplyStore(f"{tmp_path}/store", per_task=3, wave=10)
    requests = spark.range(57).select(F.col("id").cast("string").alias("cache_key"), F.concat(F.lit("q"), "id").alias("request"))
    requests = requests.union(requests).union(spark.createDataFrame([(None, "x"), ("n", None)], "cache_key string, request string"))
    ask = lambda _: lambda text: None if text == "q7" else text + "!"
    assert store.fill(requests, "t", ask) == 57 and store.fill(requests, "t", ask) == 1 and store.fill(requests, "other", ask) == 57
    said = {r.cache_key: r.reply for r in store.read(spark, "t").collect()}
    assert said == {str(i): f"q{i}!" for i in range(57) if i != 7}


def test_a_wave_reads_its_own_requests(spark, tmp_path):
    store = ReplyStore(f"{tmp_path}/store", per_task=3, wave=10)
    requests = spark.range(57).select(F.col("id").cast("string").alias("cache_key"), F.concat(F.lit("q"), "id").alias("request"))
    assert store.fill(requests, "t", lambda _: lambda text: text) == 57
    (kept,) = (tmp_path / "store/requests").iterdir()
    assert len([d for d in kept.iterdir() if d.is_dir()]) == 6  # a folder a wave
    assert store.read(spark, "t").count() == 57


def test_templates_from_files(spark, tmp_path):
    (tmp_path / "final_decision_v1.yaml").write_text("system: |\n  Be brief.\nuser: |\n  Say {{payload}}\n")
    (tmp_path / "signal_detection_v2.yaml").write_text("user: x\n")
    (tmp_path / "notes.txt").write_text("no template")
    assert {tuple(r) for r in prompts.load_templates(spark, str(tmp_path)).collect()} == {("final_decision", "v1", "Be brief.\n", "Say {{payload}}\n"), ("signal_detection", "v2", "", "x")}


def test_only_whole_json_counts(spark):
    texts = ['{"a": 1}', '{"a": 1}}', '{"a": 1} x', '{"a": 1}, 2', "1],[2", '1,"w":2', "[1, 2]", "", None, " {} "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.where(mj.strict_json(F.col("t")).isNotNull()).select("i").orderBy("i").collect()] == [0, 6, 9]
    assert df.where(F.col("i") == 1).select(mj.reply_error(F.col("t"), mj.DECISION)).first()[0] == "parse_error"


def test_upserts_touch_their_partitions_only(spark, tmp_path):
    path, fields = f"{tmp_path}/t", "run_id string, step_name string, v int, pt int"
    stores.upsert(path, spark.createDataFrame([("r", "s", 1, 1), ("r", "s", 2, 1), ("r", None, 3, 1), ("q", "s", 4, 2)], fields), ["run_id", "step_name"], F.lit("2026-01-01"), ["v"])
    untouched = {p.name for p in (tmp_path / "t" / "pt=2").iterdir()}
    stores.upsert(path, spark.createDataFrame([("r", "s", 9, 1), ("r", "s", 8, 1), ("n", "s", 5, 1)], fields), ["run_id", "step_name"], F.lit("2026-01-02"), ["v"])
    assert {p.name for p in (tmp_path / "t" / "pt=2").iterdir()} == untouched
    got = {(r.run_id, r.step_name): (r.v, r.created_at.day, r.updated_at.day) for r in spark.read.parquet(path).collect()}
    assert got == {("r", "s"): (9, 1, 2), ("r", None): (3, 1, 1), ("n", "s"): (5, 2, 2), ("q", "s"): (4, 1, 1)}


def brute_upsert(old, new):
    """(key, k2) -> (value, created, updated) of rows (key, k2, value, created), by the rules of ``upserted``."""
    out = {}
    for side, rows in enumerate((old, new)):
        for a, b, v, made in rows:
            out.setdefault((a, b), ([], []))[side].append((v, made))
    return {k: ((max(n)[0], min(m for _, m in o) if o else "now", "now") if n else (max(o)[0], min(m for _, m in o if m) if max(o)[1] is None else max(o)[1], None)) for k, (o, n) in out.items()}


@pytest.mark.parametrize("bitmaps, bits", [(512, 1 << 15), (1, 8)])
def test_upserts_whatever_the_bitmaps_tell(spark, monkeypatch, bitmaps, bits):
    monkeypatch.setattr(stores, "BITMAPS", bitmaps)
    monkeypatch.setattr(stores, "BITS", bits)
    key = lambda i: (None if i % 50 == 0 else f"k{i}", "s" if i % 3 else None)
    old = [(*key(i), f"o{i}", f"d{i % 4}") for i in range(100)] + [(*key(i), f"p{i}", "d9") for i in range(0, 100, 9)]
    new = [(*key(i), f"n{i}", None) for i in range(60, 160)] + [(*key(i), f"m{i}", None) for i in range(60, 160, 7)]
    make = lambda rows: spark.createDataFrame(rows, "a string, b string, v string, created_at string")
    merged = stores.upserted(make(old), make(new).drop("created_at"), ["a", "b"], F.lit("now"), order=["v"]).collect()
    expected = brute_upsert(old, new)
    assert len(merged) == len(expected) and {(r.a, r.b): (r.v, r.created_at, r.updated_at) for r in merged} == expected


def test_rows_of_a_repeated_write_stay_where_they_are(spark, tmp_path, monkeypatch):
    rows = spark.range(2000).select(F.concat(F.lit("r"), "id").alias("run_id"), F.repeat(F.col("id").cast("string"), F.lit(500)).alias("doc"), (F.col("id") % 2).cast("int").alias("pt"))
    moved, fates = [], stores._fates

    def seen(*args):
        found = fates(*args)
        moved.append(found.where("NOT _alone AND NOT _pair").count())
        return found

    monkeypatch.setattr(stores, "_fates", seen)
    for day in ("2026-01-01", "2026-01-02"):
        stores.upsert(f"{tmp_path}/t", rows, ["run_id"], F.lit(day))
    assert moved == [0, 0]
    got = spark.read.parquet(f"{tmp_path}/t").agg(F.count("doc"), F.min("created_at").cast("string"), F.max("created_at").cast("string"), F.min("updated_at").cast("string")).first()
    assert tuple(got) == (2000, "2026-01-01 00:00:00", "2026-01-01 00:00:00", "2026-01-02 00:00:00")


def test_texts_are_kept_once(spark, tmp_path):
    """Tables of a run hold a row's text once, requests besides."""
    text = "today " + "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(3000))
    store = ReplyStore(f"{tmp_path}/store")
    made = records.run_records(wide(spark, [("a", text)]), client(tmp_path), known(spark), store, records.Settings(lexicon=LEXICON))
    one = made.first()
    assert one.raw_wide_row.job_detail == one.wide_row.job_detail == text and one.route == "formal"
    for kept in (tmp_path / "store/requests").iterdir():
        row = spark.read.parquet(str(kept)).first()
        assert str(row.asDict(True)).count(text) == (0 if kept.name.startswith("final_decision") else 1), kept.name


def test_a_flipped_route_leaves_one_record(spark):
    fields = "publish_key string, entity_key string, route string, record string, updated_at int"
    published = spark.createDataFrame([("a::s::g", "a", "formal", "1", 1), ("b::s::g", "b", "formal", "2", 1), ("b::s::g::fallback", "b", "fallback", "3", 2), ("c::s::g", "c", "formal", "4", 1)], fields)
    live, gone = stores.reconciled(published, spark.createDataFrame([("a::s::g::fallback", "a", "fallback", "5", 9), ("c::s::g", "c", "formal", "6", 9)], fields), F.lit("now"))
    assert sorted((r.publish_key, r.record) for r in live.collect()) == [("a::s::g::fallback", "5"), ("b::s::g::fallback", "3"), ("c::s::g", "6")]
    assert sorted((r.publish_key, r.reason) for r in gone.collect()) == [("a::s::g", "superseded"), ("b::s::g", "stale_route")]
    again, none = stores.reconciled(live, live.limit(0), F.lit("now"))
    assert again.count() == 3 and none.count() == 0


def test_notes_are_capped_against_what_is_stored(spark, tmp_path):
    runs = spark.createDataFrame([("r", "e"), ("q", "f")], "run_id string, entity_key string")
    note = lambda rows: spark.createDataFrame(rows, "run_id string, id int, created_at string, annotated_label string")
    first = stores.append_notes(str(tmp_path), note([("r", 1, "t1", "x"), ("r", 2, "t1", "y"), ("z", 3, "t1", "x")]), runs)
    assert [(r.id, r.status, r.annotation_count) for r in first.collect()] == [(3, "unknown_run", None)]
    second = stores.append_notes(str(tmp_path), note([("r", 5, "t3", "x"), ("r", 4, "t2", "y"), ("q", 6, "t1", "x"), ("r", 7, "t4", "x")]), runs)
    assert sorted((r.id, r.status, r.annotation_count) for r in second.collect()) == [(5, "max_reached", 3), (7, "max_reached", 3)]
    assert sorted((r.id, r.entity_key) for r in spark.read.parquet(f"{tmp_path}/notes").collect()) == [(1, "e"), (2, "e"), (4, "e"), (6, "f")]


def test_counters_and_days(spark):
    rows, seen = stores.with_counters(spark.createDataFrame([("formal",), ("fallback",), (None,)], "route string"), "c")
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"processed_count": 3, "formal_count": 1, "fallback_count": 2}
    days = spark.createDataFrame([(3, 1, 2, None), (5, 5, 0, "stopped")], "processed_count long, formal_count long, fallback_count long, error_message string")
    assert tuple(stores.days_summary(days).first()) == (2, 1, 1, 3, 1, 2)
    assert tuple(stores.days_summary(days.limit(0)).first()) == (0, 0, 0, 0, 0, 0)


def test_names(spark):
    df = spark.sql("SELECT 1 AS a_b, array(named_struct('c_d', map('k_k', named_struct('e_f', 2)))) AS g_h")
    made = naming.renamed(df)
    assert json.loads(made.select(F.to_json(F.struct("*"))).first()[0]) == {"aB": 1, "gH": [{"cD": {"k_k": {"eF": 2}}}]}
    assert naming.renamed(made, naming.snake).schema == df.schema
    with pytest.raises(ValueError, match="aB"):
        naming.renamed(spark.sql("SELECT named_struct('a_b', 1, 'aB', 2) AS s"))


def test_sql_templates():
    assert templates.problems(" ") == ["the template is empty"] and templates.problems("${x} ${x}") == ["missing ${bizdate}", "unknown ${x}"]
    assert templates.rendered("${bizdate} ${publish_start} ${publish_end}", "20240228", limit=5) == "20240228 2024-02-28 2024-02-29\nLIMIT 5"
    assert templates.default_partition(datetime.date(2026, 1, 1)) == "20251231"
    for wrong in ("2024-02-28", "20240230", "1' OR 1"):
        with pytest.raises(ValueError):
            templates.rendered("${bizdate}", wrong)


def test_pages_and_medians(spark):
    page = serving.page_with_total(spark.range(30), 25, 10, F.col("id"))
    assert [tuple(r) for r in page.collect()] == [(i, 30) for i in range(25, 30)] and serving.page_with_total(spark.range(3), 5, 10, F.col("id")).count() == 0
    with pytest.raises(ValueError):
        serving.page_with_total(spark.range(3), 0, 101, F.col("id"))
    rows = [("a", float(v % 997)) for v in range(5000)] + [("b", 1.0), ("b", 2.0), ("b", 3.0), ("b", 4.0), ("c", None), (None, 7.0)] + [("d", 5.0)] * 300
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in times.upper_median_by_rank(df, ["k"], "v").collect()}
    assert got == {"a": sorted(float(v % 997) for v in range(5000))[2500], "b": 3.0, None: 7.0, "d": 5.0}
    stats = {r.k: tuple(r)[1:] for r in times.value_stats(df, ["k"], "v").collect()}
    assert stats["b"] == (1.0, 4.0, 4, 2.5, 3.0) and stats["c"] == (None, None, 0, None, None)


def test_ranges_of_days(spark):
    assert [r.pt for r in serving.days_between(spark, "20240228", "20240301").collect()] == ["20240228", "20240229", "20240301"]
    assert serving.days_between(spark, "20240101", "20240130").count() == 30
    for start, end, why in (("20240102", "20240101", "ends before"), ("20240101", "20240131", "more than 30"), ("2024011", "20240101", "no day"), ("20240230", "20240301", "day")):
        with pytest.raises(ValueError, match=why):
            serving.days_between(spark, start, end)


def test_survey_and_defaults(spark, tmp_path):
    files.write_partition(spark.createDataFrame([(1, "1")], "a int, pt string"), str(tmp_path / "t"))
    files.write_partition(spark.createDataFrame([(2, "x", "2")], "a int, b string, pt string"), str(tmp_path / "t"))
    assert [(r.pt, r.lacks) for r in files.column_survey(spark, str(tmp_path / "t"), ["a", "b", "c"]).collect()] == [("1", ["b", "c"]), ("2", ["c"])]
    assert sorted(tuple(r) for r in files.with_defaults(spark.read.schema("a int, b string").parquet(str(tmp_path / "t")), {"b": "d", "c": 0}).drop("pt").collect()) == [(1, "d", 0), (2, "x", 0)]


def test_a_reply_is_parsed_once(spark):
    made = spark.createDataFrame([('{"normalizable": true}',), ('{"x": 1} 2',), ('{"confidence": 2}',), (None,)], "t string").select(mj.reply_error(F.col("t"), mj.NORMALISATION).alias("e"))
    assert [r.e for r in made.collect()] == [None, "parse_error", "schema_validation_error", "parse_error"]
    plan = made._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 2  # within brackets and within braces
