"""Golden cases of the cleaning, recall and risk rules."""

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import modeljson as mj
from ebbtide.functions import recall, risk, text, times
from ebbtide.plans import decide


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""), ("", ""), ("喂喂喂，明天来", "明天来"), ("好好好的", "好的"), ("，，，开工。。", "开工"), ("！！！", ""), ("12345", ""), ("13800138000", "13800138000"),
        ("一样\n一样\n不同", "一样\n不同"), ("a\r\nb c", "a\nb\nc"), ("呃呃那个 来", "来"), ("【投诉1 2026-04-20 11:00:00】", "【投诉1 2026-04-20 1:00】"),
        ("　空格　", "空格"), ("(", ""), ("招满了", "招满"),
    ],
)
def test_denoise(spark, raw, want):
    assert one(spark, raw, text.denoised) == want


def test_calls(spark):
    raw = '[{"speaker":0,"begin":900,"text":"后说"},{"begin":1,"text":"先说"},"x",{"text":" "}]'
    assert one(spark, raw, text.flat_calls) == "先说\n后说"
    many = '【通话1 2026-04-14 08:07:53】\n[{"text":"甲"}]\n【通话2 2026-04-15 10:20:30】\n{"text":"乙"},\n{"text":"丙"}\n【通话3 2026-04-15 10:20:30】\nnot json,\n{"text":"丁"}\n【通话4 x】'
    assert one(spark, many, text.flat_calls).split("\n")[1::2][:1] == ["甲"]
    assert one(spark, many, text.flat_calls).split("\n") == ["【通话1 2026-04-14 08:07:53】", "甲", "【通话2 2026-04-15 10:20:30】", "乙", "丙", "【通话3 2026-04-15 10:20:30】", "not json", "丁"]
    for nothing in (None, "", "null", "[]", "None"):
        assert one(spark, nothing, text.flat_calls) == ""
    assert one(spark, "plain words", text.flat_calls) == "plain words"


def test_chats(spark):
    assert one(spark, "1: 你好\n1: 招人吗今天\n2: 招人\n1: 招人吗今天", text.flat_chat) == "招人今天\n招人"
    said = [f"row {chr(0x5B60 + i)} end" for i in range(31)]
    long = "\n".join(f"{i % 2}: {s}" for i, s in enumerate(said))
    assert one(spark, long, text.flat_chat).split("\n") == said[1:30]
    assert one(spark, "\n".join(long.split("\n")[:30]), text.flat_chat).count("\n") == 29


def test_times(spark):
    body = "【投诉1 2026-04-18 9:00:00】\n【投诉2 2026-04-18 10:00:00】"
    assert one(spark, body, text.earliest_plain) == "2026-04-18 10:00:00"
    assert one(spark, body, text.earliest_padded) == "2026-04-18 9:00:00"
    assert one(spark, "2026-04-18T14:30:0+08:00", times.iso_time) is None
    assert one(spark, "2026-04-18", times.iso_time) is not None
    hours = spark.createDataFrame([(h,) for h in (-1.0, 0.0, 2.5, 3.0, 23.9, 24.0, 168.0, None)], "h double")
    assert [r.b for r in hours.select(times.hour_bucket(F.col("h")).alias("b")).collect()] == ["< 0h (异常)", "0-1h", "2-3h", "3-6h", "12-24h", "1-2天", "> 7天", None]
    four = spark.createDataFrame([(1, v) for v in (1, 2, 3, 4)], "k int, v int")
    assert times.upper_median_by_rank(four, ["k"], "v").first()["median"] == 3 == four.agg(F.expr("1")).count() + 2


def test_recall(spark):
    record = recall.recall({"job_detail": F.lit("【通话1 明天】\n明天上午8点开工，干两天"), "im_text": F.lit("已招满"), "asr_text": F.lit("１２点")})
    r = spark.range(1).select(record.alias("r")).first().r
    got = {(m.source, m.bucket): m.terms for m in r.matches}
    assert got["job_detail", "absolute_time"] == ["8点", "上午", "明天"] and got["job_detail", "duration"] == ["两天", "干两天"]
    assert got["im_text", "complaint"] == ["已招满"] and got["asr_text", "absolute_time"] == ["１２点"]
    assert r.has_recall and r.complaint_count == 1


@pytest.mark.parametrize(
    ("corpus", "status", "summary", "at"),
    [
        ("【投诉1 2026-04-18 14:30:02】\n已招满 空号", "confirmed_filled", "已招满且联系不上", "2026-04-18T14:30:02+08:00"), ("已招满 还差", "suspected_filled", risk.SUMMARIES["suspected_active"], None),
        ("先这样", "suspected_filled", "阶段性结束，疑似招满", None), ("先这样 还差", "not_filled", "先这样 还差", None), ("关机", "not_filled", "联系不上", None), ("", "not_filled", "", None),
    ],
)
def test_risk(spark, corpus, status, summary, at):
    r = one(spark, corpus, risk.risk)
    assert (r.fill_status, r.complaint_summary, r.estimated_filled_at) == (status, summary, at)


@pytest.mark.parametrize(
    ("reply", "error"),
    [
        ('{"validity_type": "no_validity", "reason": "x"}', None), ('```json\n{"validity_type": "exact_date"}\n```', None), ("not json", "parse_error"), ("", "parse_error"), (None, "parse_error"),
        ('{"validity_type": "other"}', "schema_validation_error"), ('{"extra": 1}', "schema_validation_error"), ("[1]", "schema_validation_error"), ('{"reason": null}', "schema_validation_error"),
        ('{"estimated_expiry": null}', None), ('{"low_confidence": "x"}', "schema_validation_error"),
    ],
)
def test_replies(spark, reply, error):
    assert one(spark, reply, lambda x: mj.reply_error(x, mj.DECISION)) == error


def test_decisions(spark):
    wide = spark.createDataFrame(
        [("A", "明天开工", "", "", "【投诉1 2026-04-18 14:32:15】\n已招满", "2026-04-14 07:30:00"), ("B", "长期有效吗", "", "", "", None), ("C", "nothing", "", "", "", None)],
        "info_id string, job_detail string, asr_result string, im_text string, complaint_content string, publish_time string",
    )
    good = {
        "signal_detection": '{"has_temporal_signal": true, "temporal_status": "has_signal", "confidence": 0.4}',
        "time_normalization": '{"normalizable": true, "confidence": 0.9}',
        "final_decision": '{"validity_type": "fuzzy_time", "estimated_expiry": "2026-04-21T10:00:00+08:00", "reason": "said"}',
    }
    rows = {r.info_id: r for r in decide.decided(wide, lambda: decide.FakeClient(good)).collect()}
    assert rows["C"].route == "formal" and rows["C"].validity_type == "no_validity" and not rows["C"].has_recall
    assert rows["A"].route == "formal" and "存在矛盾" in rows["A"].reason and rows["B"].reason == "said"
    for task, reply, error in (("signal_detection", "oops", "parse_error"), ("time_normalization", '{"x": 1}', "schema_validation_error"), ("final_decision", ValueError("down"), "unknown_final_decision_error")):
        rows = {r.info_id: r for r in decide.decided(wide, lambda: decide.FakeClient(good | {task: reply})).collect()}  # noqa: B023
        assert (rows["A"].route, rows["A"].error_type) == ("fallback", error) and rows["C"].route == "formal"


def test_limiter():
    now, slept = [0.0], []
    limiter = decide.Limiter(2, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        limiter.wait()
    assert slept == [60.0]
