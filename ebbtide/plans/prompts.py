"""Prompts of the model stages: templates by version, payloads, messages, and the reply's content."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The marks of a prompt's parts, the place of the payload, and the temperature of a request.
TASK_MARK, SYSTEM_MARK, USER_MARK, PAYLOAD, TEMPERATURE = "[TASK: ", "[SYSTEM]\n", "[USER]\n", "{{payload}}", 0.1
TEMPLATE = "task string, version string, system string, user string"


def load_templates(spark: SparkSession, folder: str) -> DataFrame:
    """(task, version, system, user) of the files <task>_<version>.yaml of a folder, read by Spark.

    A file lacking a part has it empty; one that is no mapping is an error."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for frame in frames:
            known = [yaml.safe_load(text) for text in frame["value"]]
            yield frame[["task", "version"]].assign(**{part: [str(k.get(part) or "") for k in known] for part in ("system", "user")})

    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)_([^_]+)\.yaml$", 1)
    version = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)_([^_]+)\.yaml$", 2)
    files = spark.read.option("pathGlobFilter", "*.yaml").text(folder, wholetext=True)
    return files.select(name.alias("task"), version.alias("version"), "value").where("task <> ''").mapInPandas(parsed, TEMPLATE)


def detection_payload(key: Column, recall: Column, complaint_bucket: str = "complaint") -> Column:
    """The texts and the rule matches other than of complaints, as JSON."""
    matches = F.transform(
        F.filter(recall["matches"], lambda m: m["bucket"] != complaint_bucket), lambda m: F.struct(m["source"].alias("source"), m["bucket"].alias("matched_bucket"), m["terms"].alias("matched_terms"))
    )
    return _json(key.cast("string").alias("job_id"), "publish_time", evidence().alias("evidence_text"), matches.alias("rule_matches"))


def normalisation_payload(key: Column, detection: Column) -> Column:
    """What was detected, in short, and the texts, as JSON."""
    found = F.struct(*[detection[c].alias(c) for c in ("temporal_status", "signal_type", "evidence_summary")])
    return _json(key.cast("string").alias("job_id"), "publish_time", found.alias("signal_detection"), evidence().alias("evidence_text"))


def decision_payload(key: Column, temporal: Column, risk: Column) -> Column:
    """The merged signal and the risk record, as JSON."""
    return _json(key.cast("string").alias("job_id"), "publish_time", temporal.alias("temporal_signal_record"), risk.alias("risk_record"))


def evidence() -> Column:
    return F.struct("job_detail", "im_text", F.col("asr_result").alias("asr_text"))


def _json(*parts: Column | str) -> Column:
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def with_prompt(df: DataFrame, templates: DataFrame, task: str, version: Column, payload: Column, out: str = "prompt") -> DataFrame:
    """Add a row's prompt: its version's template with the payload in place; null if there is no such
    version, or no payload.  Templates are a few rows and are broadcast once counted."""
    own = templates.where(F.col("task") == task).groupBy(F.col("version").alias("_version")).agg(F.min(F.struct("system", "user")).alias("_template"))
    if own.count() <= 1000:
        own = F.broadcast(own)
    user = F.replace(F.col("_template.user"), F.lit(PAYLOAD), payload)
    text = F.concat(F.lit(f"{TASK_MARK}{task}]\n{SYSTEM_MARK}"), F.col("_template.system"), F.lit(f"\n{USER_MARK}"), user)
    return df.withColumn("_asked_version", version).join(own, F.col("_asked_version") == F.col("_version"), "left").withColumn(out, text).drop("_asked_version", "_version", "_template")


def messages(prompt: Column) -> Column:
    """The prompt as messages: what stands before the user's mark, without its marks, is the system's."""
    place = F.instr(prompt, F.lit(USER_MARK))
    head = F.replace(F.substr(prompt, F.lit(1), place - 1), F.lit(TASK_MARK.strip()), F.lit(""))
    close = F.instr(head, F.lit("]\n"))
    system = F.replace(F.when(close > 0, F.substr(head, close + 2)).otherwise(head), F.lit(SYSTEM_MARK), F.lit(""))
    user = F.substr(prompt, place + len(USER_MARK))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    strip = lambda text: F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(place > 0, F.array(message("system", strip(system)), message("user", strip(user)))).otherwise(F.array(message("user", prompt)))


def request(model: Column, prompt: Column) -> Column:
    """The body of a chat request, as JSON; null without a prompt."""
    return F.when(prompt.isNotNull(), F.to_json(F.struct(model.alias("model"), messages(prompt).alias("messages"), F.lit(TEMPERATURE).alias("temperature"))))


def reply_content(response: Column) -> Column:
    """The first choice's content; null if there is none (see ``reply_fault``)."""
    return F.nullif(F.get_json_object(response, "$.choices[0].message.content"), F.lit(""))


def reply_fault(response: Column) -> Column:
    """Why a response has no content."""
    return F.when(F.get_json_object(response, "$.choices[0]").isNull(), F.lit("llm_response_no_choices")).when(reply_content(response).isNull(), F.lit("llm_response_empty_content"))
