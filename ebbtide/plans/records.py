"""Wide rows to full run records: every stage's record beside the decision, model replies stored.

The rows are cleaned, recalled and judged once, and kept as a table, each text once and each row with
a number; only rows with recall go on to the model.  A stage makes prompts as columns, keeps them by
row number, reads the replies that the store has, asks the others (each cache key once), and hands on
replies by row number, so a second run over the same rows, versions and model asks nothing.  Texts
cross a shuffle where a prompt needs them beside a reply, and once more beside the last reply; that
table is kept, and payloads are made of it whenever they are read.  All records are native expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import modeljson as mj
from ebbtide.functions.recall import DEFAULT_LEXICON
from ebbtide.functions.risk import KEYWORDS
from ebbtide.functions.times import mixed_offsets
from ebbtide.operators.keyed import cache_key
from ebbtide.plans import prompts
from ebbtide.plans.decide import SILENT, Client, Limiter, cleaned, replied, route, with_hint, with_recall, with_risk
from ebbtide.sources.replies import ReplyStore

_kind = {"boolean": "boolean", "string": "string", "double": "double", "long": "bigint", "strings": "array<string>"}
_fields = lambda shape: ", ".join(f"{n}: {_kind[f.kind]}" for n, f in shape.items())
TEMPORAL = f"struct<{_fields(mj.DETECTION)}, {_fields({n: f for n, f in mj.NORMALISATION.items() if n != 'confidence'})}>"
STEPS = ("signal_detection", "time_normalization", "final_decision")
#: The columns that cleaning changes, and the row's number.
CLEANED, ROW = ("asr_result", "im_text", "complaint_content"), "_row"


@dataclass(frozen=True)
class Settings:
    """Versions by stage, and how the model is asked.  ``chat``: the client takes a chat request's
    body and gives its response; else it takes the prompt and gives the reply."""

    graph_version: str = "v1"
    feature_schema_version: str = "v1"
    prompt_versions: dict[str, str] = field(default_factory=lambda: dict.fromkeys((*STEPS, "risk"), "v1"))
    model_versions: dict[str, str] = field(default_factory=lambda: dict.fromkeys((*STEPS, "risk"), "qwen3-max"))
    chat: bool = False
    calls_a_minute: int | None = None
    in_flight: int = 8
    lexicon: dict = field(default_factory=lambda: DEFAULT_LEXICON)
    keywords: dict = field(default_factory=lambda: KEYWORDS)

    def with_prompt_version(self, task: str, version: str) -> Settings:
        return replace(self, prompt_versions=self.prompt_versions | {task: version})


def temporal_record(detection: Column, normalised: Column) -> Column:
    """The signal that later stages see: the detection with what was normalised and the higher
    confidence; without normalisation its fields have their defaults."""
    empty = {"normalizable": F.lit(False), "anchor_type": F.lit("unknown"), "interpretation": F.lit("")}
    parts = [F.greatest(detection[n], normalised[n]).alias(n) if n == "confidence" else detection[n].alias(n) for n in mj.DETECTION]
    parts += [(F.coalesce(normalised[n], empty[n]) if n in empty else normalised[n]).alias(n) for n in mj.NORMALISATION if n != "confidence"]
    return F.when(detection.isNotNull(), F.struct(*parts).cast(TEMPORAL))


def silent_temporal() -> Column:
    """The record of a row without recall: surely no signal."""
    given = {"has_temporal_signal": False, "temporal_status": "no_signal", "signal_type": "no_signal", "confidence": 1.0, "normalizable": False, "anchor_type": "unknown", "interpretation": ""}
    parts = [F.array().cast("array<string>") if n == "evidence_summary" else F.lit(given.get(n)) for n in T._parse_datatype_string(TEMPORAL).names]
    return F.struct(*[p.alias(n) for p, n in zip(parts, T._parse_datatype_string(TEMPORAL).names, strict=True)]).cast(TEMPORAL)


def silent_risk(kind: str) -> Column:
    """The default risk record, for rows whose complaints nobody looked at."""
    given = F.struct(F.lit(False).alias("is_filled"), F.lit("not_filled").alias("fill_status"), F.lit(False).alias("is_unreachable"), F.lit("").alias("complaint_summary"), F.lit(None).cast("string").alias("estimated_filled_at"))
    return given.cast(kind)


def _numbered(wide: DataFrame, store: ReplyStore, settings: Settings) -> DataFrame:
    """The rows cleaned, recalled and judged, by number: of the raw row only what cleaning changed is stored beside them."""
    made = with_risk(with_recall(cleaned(wide), settings.lexicon), settings.keywords)
    raw = F.struct(*[F.col("raw_wide_row")[c].alias(c) for c in CLEANED]).alias("_raw")
    return store.kept(made.select(*wide.columns, raw, "snippet_recall", "risk_record", F.monotonically_increasing_id().alias(ROW)), "rows")


def _asked(rows: DataFrame, task: str, payload: Column, client: Callable[[], Client], templates: DataFrame, store: ReplyStore, settings: Settings, key: str) -> DataFrame:
    """(row number, ``<task>``: the reply, ``<task>_fault``, ``<task>_asked``) of the rows, all of which want it."""
    prompt_version, model = settings.prompt_versions[task], F.lit(settings.model_versions[task])
    asking = prompts.with_prompt(rows.withColumn("_payload", payload), templates, task, F.lit(prompt_version), F.col("_payload"), "_prompt")
    asking = asking.withColumn("_request", prompts.request(model, F.col("_prompt")) if settings.chat else F.col("_prompt"))
    entity = F.col(key).cast("string")
    # null parts would vanish from the joined key; a request is there wherever a key is made
    made = cache_key(F.coalesce(entity, F.lit("")), F.sha2("_request", 256), F.lit(settings.graph_version), F.lit(prompt_version), model)
    asking = store.kept(asking.select(ROW, F.when(F.col("_request").isNotNull(), made).alias("cache_key"), F.col("_request").alias("request")), f"{task}-rows")
    calls, in_flight = settings.calls_a_minute, settings.in_flight

    def ask(tasks: int) -> Callable[[str], str | None]:
        own, limiter = client(), Limiter(calls // tasks) if calls else None
        return lambda text: replied(own, task, text, limiter)

    store.fill(asking.select("cache_key", "request"), task, ask, in_flight)
    said = store.read(rows.sparkSession, task).select(F.col("cache_key").alias("_key"), F.col("reply").alias("_reply"))
    joined = asking.select(ROW, "cache_key").join(said, F.col("cache_key") == F.col("_key"), "left")
    reply = prompts.reply_content(F.col("_reply")) if settings.chat else F.col("_reply")
    return joined.select(ROW, reply.alias(task), F.when(reply.isNull(), F.lit("failed")).alias(f"{task}_fault"), F.lit(True).alias(f"{task}_asked"))


def run_records(wide: DataFrame, client: Callable[[], Client], templates: DataFrame, store: ReplyStore, settings: Settings | None = None, key: str = "info_id") -> DataFrame:
    """One row a wide row: ``key``, raw_wide_row, wide_row, snippet_recall, signal_detection,
    time_normalization, temporal_signal, risk_record, decision_record, route, error_type, steps.

    A row whose texts recall nothing has a surely silent signal, the default risk record and a
    decision without validity; one whose detection finds no signal skips normalisation, its signal
    made from the detection alone.  After an error the later records are null and the row goes to review.
    ``steps``: (step_name, prompt_version, model_version, payload_json, result_json, error_type) of what was asked."""
    settings = settings or Settings()
    rows = _numbered(wide, store, settings)
    has = F.coalesce(F.col("snippet_recall.has_recall"), F.lit(False))
    ask = lambda df, task, payload: _asked(df, task, payload, client, templates, store, settings, key)
    error = lambda task, shape, unknown: F.when(F.col(f"{task}_fault").isNotNull(), F.lit(unknown)).otherwise(mj.reply_error(F.col(task), shape))
    fine = F.col("error_type").isNull()
    talk = rows.where(has)
    payloads = {
        "signal_detection": prompts.detection_payload(F.col(key), F.col("snippet_recall")), "time_normalization": prompts.normalisation_payload(F.col(key), F.col("detection")),
        "final_decision": prompts.decision_payload(F.col(key), F.col("temporal_signal"), F.col("risk_record")),
    }

    said = ask(talk, "signal_detection", payloads["signal_detection"])

    def detected(replies: DataFrame) -> DataFrame:
        told = replies.withColumn("error_type", error("signal_detection", mj.DETECTION, "unknown_signal_detection_error"))
        return told.withColumn("detection", F.when(fine, mj.reply_struct(F.col("signal_detection"), mj.DETECTION)))

    signal = detected(said).where(fine & F.col("detection.has_temporal_signal")).select(ROW, "detection")
    more = ask(talk.join(signal, ROW), "time_normalization", payloads["time_normalization"])
    said = said.join(more, ROW, "left")

    def normal(replies: DataFrame) -> DataFrame:
        told, asked = detected(replies), F.coalesce("time_normalization_asked", F.lit(False))
        told = told.withColumn("error_type", F.coalesce("error_type", F.when(asked, error("time_normalization", mj.NORMALISATION, "unknown_time_normalization_error"))))
        told = told.withColumn("normalised", F.when(asked & fine, mj.reply_struct(F.col("time_normalization"), mj.NORMALISATION)))
        return told.withColumn("temporal_signal", F.when(fine, temporal_record(F.col("detection"), F.col("normalised"))))

    more = ask(talk.join(normal(said).where(fine).select(ROW, "temporal_signal"), ROW), "final_decision", payloads["final_decision"])
    talk = normal(talk.join(said.join(more, ROW, "left"), ROW))
    asked = F.col("final_decision_asked")
    talk = talk.withColumn("error_type", F.coalesce("error_type", F.when(asked, error("final_decision", mj.DECISION, "unknown_final_decision_error"))))
    reply = mj.reply_struct(F.col("final_decision"), mj.DECISION)
    filled = F.col("risk_record.estimated_filled_at")
    talk = talk.withColumn("error_type", F.coalesce("error_type", F.when(mixed_offsets(filled, reply["estimated_expiry"]), F.lit("unknown_final_decision_error"))))
    decision = F.struct(reply["validity_type"].alias("validity_type"), reply["estimated_expiry"].alias("estimated_expiry"), with_hint(reply["reason"], filled, reply["estimated_expiry"]).alias("reason"), reply["low_confidence"].alias("low_confidence"))
    talk = store.kept(talk.withColumn("decision_record", F.when(fine, decision)), "records")
    talk = talk.withColumns({f"{task}_payload": payload for task, payload in payloads.items()})
    shape = _shape(wide.columns, key)
    heard = talk.select(
        *shape, F.col("detection").alias("signal_detection"), F.col("normalised").alias("time_normalization"), "temporal_signal", F.when(F.col("detection").isNotNull(), F.col("risk_record")).alias("risk_record"),
        "decision_record", route(F.col("error_type"), F.col("decision_record.low_confidence")).alias("route"), "error_type", _steps(settings).alias("steps"),
    )
    types = heard.schema
    nothing = lambda name: F.lit(None).cast(types[name].dataType).alias(name)
    decided = F.struct(F.lit("no_validity").alias("validity_type"), F.lit(None).cast("string").alias("estimated_expiry"), F.lit(SILENT).alias("reason"), F.lit(False).alias("low_confidence"))
    silent = rows.where(~has).select(
        *shape, nothing("signal_detection"), nothing("time_normalization"), silent_temporal().alias("temporal_signal"), silent_risk(types["risk_record"].dataType.simpleString()).alias("risk_record"),
        decided.cast(types["decision_record"].dataType).alias("decision_record"), F.lit("formal").alias("route"), nothing("error_type"), F.array().cast(types["steps"].dataType).alias("steps"),
    )
    return heard.unionByName(silent)


def _shape(names: list[str], key: str) -> list[Column]:
    raw = F.struct(*[(F.col("_raw")[c] if c in CLEANED else F.col(c)).alias(c) for c in names])
    return [F.col(key), raw.alias("raw_wide_row"), F.struct(*[F.col(c) for c in names]).alias("wide_row"), F.col("snippet_recall")]


def _steps(settings: Settings) -> Column:
    """What was asked, in order: an error is told by the step that made it."""
    mine = F.when(F.col("final_decision_asked"), 3).when(F.col("time_normalization_asked"), 2).otherwise(1)
    made = []
    for i, task in enumerate(STEPS):
        parts = (F.lit(task).alias("step_name"), F.lit(settings.prompt_versions[task]).alias("prompt_version"), F.lit(settings.model_versions[task]).alias("model_version"),
                 F.col(f"{task}_payload").alias("payload_json"), F.col(task).alias("result_json"), F.when(mine == i + 1, F.col("error_type")).alias("error_type"))
        made.append(F.when(F.col(f"{task}_asked"), F.struct(*parts)))
    return F.filter(F.array(*made), lambda s: s.isNotNull())
