"""The candidates build on source-like tables, files, documents, and queries against DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ebbtide import catalog
from ebbtide.operators import candidates, docs, keyed
from ebbtide.plans import decide
from ebbtide.sources import files
from ebbtide.streaming import stateless

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v != v:
        return None
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    made = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(made.columns)
    key = lambda r: repr(r)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in made.collect()), key=key)
    assert got == sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in want.fetchall()), key=key)


def test_every_engine_query_is_registered():
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())


def test_build(spark):
    at = 1776643200  # 2026-04-20 00:00:00 UTC
    make = spark.createDataFrame
    text = '[{{"MsgType":"TIMTextElem","MsgContent":{{"Text":"{}"}}}},{{"MsgType":"TIMTextElem","MsgContent":{{"Text":"and"}}}}]'
    chats = [("P1", "K1", f"u{i % 2}", text.format(i), at + i, 0, "20260420") for i in range(6)] + [("P1", "K2", "u1", text.format("x"), at, 0, "20260420"), ("P1", "K1", "adm", text.format("admin"), at + 9, 1, "20260420")]
    tables = {
        "members": make([("U1",), ("U2",)], "id string"),
        "posts": make([("P1", "U1", "old", "O", 2, at - 3600), ("P1", "U1", "new", "O", 2, at), ("P2", "U2", "late", "O", 2, at - 86400 * 30), ("P3", "U3", "no member", "O", 2, at)], "id string, user_id string, detail string, occupations_v2 string, is_check int, add_time long"),
        "call_log": make([("C1", "P1", "S2", 5), ("C2", "P1", "S1", 5), ("C3", "P1", "S3", 0)], "id string, info_id string, sub_id string, call_duration int"),
        "call_media": make([("C1", "first", 1, "2026-04-19 10:00:00"), ("C2", None, 1, "2026-04-20 10:00:00"), ("C3", "none", 1, "2026-04-20 10:00:00")], "call_log_id string, asr_result string, is_asr int, created_at string"),
        "chats": make(chats, "info_id string, conversation_id string, from_user string, msg_body string, msg_time long, is_admin int, pt string"),
        "complaints": make([("R1", "P1", "2026-04-20 09:00:00"), ("R2", "P1", "2026-04-19 09:00:00")], "id string, target_info_id string, created_at string"),
        "complaint_details": make([("R1", "full"), ("R2", None)], "complaint_id string, complaint_content string"),
    }
    rows = candidates.build(tables, candidates.Settings("20260420")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.user_id, r.info_id, r.job_detail, r.sub_id, r.call_record_count, r.im_message_count, r.complaint_count) == ("U1", "P1", "new", "S1,S2", 2, 1, 1)
    assert r.asr_result == "【通话1 2026-04-20 10:00:00】\n\n【通话2 2026-04-19 10:00:00】\nfirst"
    assert r.im_text.split("\n")[:3] == ["【会话1 2026-04-20 00:00:00】", "u0: 0", "u0: and"] and r.im_text.endswith("adm: admin\nadm: and")
    assert r.complaint_content == "【投诉1 2026-04-20 09:00:00】\nfull" and r.first_complaint_time == "2026-04-20 09:00:00"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "20260101"), ("b", 2, "20260102")], "k string, v long, pt string")
    files.write_partition(df, f"{tmp_path}/t")
    files.write_partition(df.where("k = 'b'").withColumn("v", F.lit(9).cast("long")), f"{tmp_path}/t")
    assert {(r.k, r.v) for r in files.scan(spark, f"{tmp_path}/t").collect()} == {("a", 1), ("b", 9)}
    assert files.scan(spark, f"{tmp_path}/t", "20260101", ["k"]).collect()[0].k == "a"
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines/a.jsonl").write_text('{"k":"x","v":1}\n\n{"k":"y","v":2}\n{"k":"x","v":3}\n')
    assert {(r.k, r.v) for r in files.read_keyed_lines(spark, f"{tmp_path}/lines", spark.createDataFrame([], "k string, v long").schema, "k").collect()} == {("x", 3), ("y", 2)}
    assert files.expired_partitions(df, "20260502").count() == 1
    assert files.limited(df.orderBy("k"), 1, F.col("v") > 1).count() == 0


def test_entity_cascade(spark):
    runs = spark.createDataFrame([("r1", "e1"), ("r2", "e2")], "run_id string, entity_key string")
    steps = spark.createDataFrame([("r1", "s"), ("r2", "s")], "run_id string, step string")
    left = keyed.without_entity({"runs": runs, "steps": steps}, "e1")
    assert left["runs"].first().run_id == left["steps"].first().run_id == "r2"


def test_markdown_grids():
    def made(*rows):
        grid = docs.Grid()
        for row in rows:
            grid.add(docs.cells_of(row))
        return list(grid.lines())

    assert made("|人群|动作|说明|", "|---|---|---|", "|A|B|C|") == ["|人群|动作|说明|", "|---|---|---|", "|A|B|C|"]
    assert made("|动作|说明||", "|专区搭建|说明内容||", "|风险与应对|||") == ["|动作|说明|", "|---|---|", "|专区搭建|说明内容|", "|风险与应对|"]
    assert made("|•<br>甲|•<br>甲|•<br>甲|", "|---|---|---|", "|•<br>乙|||") == ["|甲|", "|---|", "|乙|"]
    assert made("|a long cell of a head|b|", "|x|y|") == ["|a long cell of a head|b|", "|x|y|"] and made("||||") == []
    assert docs.cells_of("no row") is docs.cells_of("|") is None and docs.cells_of(" |a|b ") == ["a", "b"]


def test_markdown_lines():
    assert list(docs.items_within("- 阶段二:说明 ▪ 若已招满 ◦ 阶段三:处理 • x")) == ["- 阶段二:说明", "  - 若已招满", "- 阶段三:处理", "  - x"]
    assert list(docs.items_within("| a ▪ b |")) == ["| a ▪ b |"]
    assert docs.flowed("当前平台职位投诉中,电话打不通\n两类占比高达72%,核心原因\n时效性过时。\n\n## 下节") == "当前平台职位投诉中,电话打不通两类占比高达72%,核心原因时效性过时。\n\n## 下节"
    assert docs.flowed("short\nlines") == "short\nlines" and docs.flowed("") == ""
    assert docs.without_pictures("a\n" + docs.PICTURE_START + "words<br>\n" + docs.PICTURE_END + "\nb") == "a\nb"
    assert docs.without_pictures("a\n" + docs.PICTURE_START + "never ends") == "a\n" + docs.PICTURE_START + "never ends"
    assert docs.field_values("需求负责人 罗 需求提出方 李 预计上线时间 4月") is None and docs.with_fields(["需求负责人", "罗"]) == ["需求负责人", "罗"]


def test_markdown_rules_of_the_extraction(spark):
    cases = {
        "⻥泡 / ⻛险 / 首⻚": "鱼泡 / 风险 / 首页",
        "**----- Start of picture text -----**<br>\n2.1 过期提醒<br>\n**----- End of picture text -----**<br>\n": "## 2.1 过期提醒",
        "x\n**==> picture [1 x 3] intentionally omitted <==**\n[罗 ](javascript:void(0)) &amp; y\x01": "x\n罗  & y",
        "**----- Start of picture text -----**<br>\n需求负责人 罗 需求提出方 李 预计上线时间 4月<br>\n关联项目流程链接 某<br>\n**----- End of picture text -----**<br>\n": "- 需求负责人: 罗\n- 需求提出方: 李\n- 预计上线时间: 4月\n- 关联项目流程链接: 某",
        "需求负责人\n罗\n\n需求提出方\n李\n\n预计上线时间\n4月\n\n关联项目流程链接\n某\n\n## 一": "- 需求负责人: 罗\n- 需求提出方: 李\n- 预计上线时间: 4月\n- 关联项目流程链接: 某\n\n## 一",
        "## • 有效期\n## a. 来源:": "- 有效期\n- a. 来源:",
        "## 1. 零工\n\n2. 标签": "1. 零工\n\n2. 标签",
        "说明结束; 2.2 流量分发优化 \n后续正文": "说明结束;\n\n## 2.2 流量分发优化 \n后续正文",
        "投诉中,'已招满' 的 \"电话\"": "投诉中,“已招满”的 “电话”",
        "- 阶段二:说明 ▪ 若已招满 ◦ 阶段三:处理": "- 阶段二:说明\n  - 若已招满\n- 阶段三:处理",
        "- “ ”\n- 具体内容\n- 正常": "- 正常",
        "|风险与应对|\n|风险||应对方案|\n|不足||扩大|": "|风险|应对方案|\n|---|---|\n|不足|扩大|",
        "|•<br>甲|•<br>甲|\n|---|---|\n|•<br>乙|| ": "|甲|\n|---|\n|乙|",
        "one line of Latin text\nand its end: \nnext": "one line of Latin textand its end:next",
        "|触达|条件|\n|---|---|\n|Push|立刻|\n\n||||||\n|---|---|---|\n||短信|立刻|": "|触达|条件|\n|---|---|\n|Push|立刻|\n\n|短信|立刻|",
        "预计 4月30日\ufffd19:00": "预计 4月30日19:00",
        "标题\x01\n\n<!-- image -->\n\n正文": "标题\n正文",
        "## 一 、目标(必填)": "## 一、目标(必填)",
        "- ▪ 记录(如 明天下午开工 )": "- 记录(如明天下午开工)",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "text string")
    got = docs.normalised_markdown(df.withColumn("key", F.col("text")), "text").collect()
    assert {r.key: r.text for r in got} == {k: v + "\n" for k, v in cases.items()} | {None: None}


def test_all_delta_holds_every_complaint(spark, tmp_path):
    rows = [(1, 1, "signup", "2024-01-01 00:00:00"), (2, 1, "signup", "2024-01-02 00:00:00"), (3, 1, "error", "2024-01-01 03:00:00"), (4, 1, "error", "2024-01-01 01:30:00"), (5, 2, "error", "2024-01-01 01:00:00"), (6, 1, "click", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts string")
    df.withColumn("ts", df.ts.cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    made = catalog.QUERIES["all_delta"](spark, str(tmp_path))
    assert sorted(map(tuple, made.collect())) == [(3, 1, 3.0), (4, 1, 1.5)] and "all_delta" in catalog.ORACLE_SQL


def test_model_is_called_once_a_row_and_stage(spark, tmp_path):
    rows = [(k, k, "", "", "", None) for k in ("明天 a", "明天 quiet", "明天 broken", "none")]
    wide = spark.createDataFrame(rows, "info_id string, job_detail string, asr_result string, im_text string, complaint_content string, publish_time string")
    folder = str(tmp_path)

    class Counting:
        """Counts its calls in files, as they come from other processes."""

        def complete(self, task, payload):
            import json

            with open(f"{folder}/{task}-{json.loads(payload).get('job_detail', '')}", "a") as out:
                out.write("x")
            if task == "signal_detection":
                return "no json" if "broken" in payload else json.dumps({"has_temporal_signal": "quiet" not in payload, "confidence": 0.5})
            return '{"normalizable": true}' if task == "time_normalization" else '{"validity_type": "fuzzy_time", "reason": "said"}'

    made = decide.decided(wide, Counting)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 3
    got = {r.info_id: r for r in made.collect()}
    calls = {p.name: p.read_text() for p in tmp_path.iterdir()}
    assert set(calls) == {"signal_detection-明天 a", "signal_detection-明天 quiet", "signal_detection-明天 broken", "time_normalization-明天 a", "final_decision-"}
    assert all(v == "x" for k, v in calls.items() if k != "final_decision-") and calls["final_decision-"] == "xx"
    assert got["明天 broken"].error_type == "parse_error" and got["明天 broken"].route == "fallback" and got["明天 a"].reason == "said"
    assert got["none"].reason == decide.SILENT and got["none"].route == "formal"


def test_retries():
    class Busy(Exception):
        status = 429

    waits = []
    for errors, want in (([Busy(), TimeoutError()], "ok"), ([Busy()] * 3, None), ([ValueError()], None)):
        left = list(errors)

        class Client:
            def complete(self, task, payload):
                if left:  # noqa: B023
                    raise left.pop(0)  # noqa: B023
                return "ok"

        assert decide.replied(Client(), "t", "{}", sleep=waits.append) == want
    assert waits == [1.0, 2.0, 1.0, 2.0]


def test_ids_reach_the_scan_and_merges_keep_one_row_a_key(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/n")
    found = files.by_ids(spark.read.parquet(f"{tmp_path}/n"), ["3", " 4 ", "x", "04"], "id")
    assert sorted(r.id for r in found.collect()) == [3, 4] and "In(id" in found._jdf.queryExecution().executedPlan().toString()
    old = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 1, 12)], "k string, t long, created long")
    new = spark.createDataFrame([("a", 3, 20), ("a", 4, 21)], "k string, t long, created long")
    assert sorted(map(tuple, keyed.merged(old, new, "k", "created", "t").collect())) == [("a", 4, 11), ("b", 1, 12)]


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("A", "明天开工", "", "", "")], "info_id string, job_detail string, asr_result string, im_text string, complaint_content string")
    rows.write.parquet(f"{tmp_path}/in")
    query = stateless.merge_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), lambda df, _: df.select("info_id", "snippet_recall.has_recall").write.mode("append").parquet(f"{tmp_path}/out"), f"{tmp_path}/ck")
    query.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").first().has_recall


def test_markdown_sends_python_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        assert docs.normalised_markdown(spark.createDataFrame([("a",)] * 600, "t string"), "t").where("t = 'a\n'").count() == 600
        assert int(spark.conf.get(name)) <= docs.BATCH
    finally:
        spark.conf.set(name, before)
