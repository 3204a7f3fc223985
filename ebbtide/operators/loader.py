"""From raw rows to wide rows: names, defaults, derived times, and a split into valid and rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.text import earliest_padded

RENAMES = {"id": "info_id", "detail": "job_detail", "occupations_v2": "occupation_id", "im_msg": "im_text"}
EMPTY_TEXTS = ("asr_result", "im_text", "complaint_content")
REQUIRED = ("user_id", "info_id")
TEXTS = ("job_detail", "occupation_id", *EMPTY_TEXTS)
COUNTS = ("im_message_count", "call_record_count", "complaint_count")
NULLABLE = ("sub_id", "first_complaint_time", "publish_time")
WIDE = (*REQUIRED, "job_detail", "occupation_id", "sub_id", *EMPTY_TEXTS, *COUNTS, "first_complaint_time", "publish_time")


def normalised(df: DataFrame) -> DataFrame:
    """Known names, texts without nulls, and the first complaint's time out of the text."""
    df = df.withColumnsRenamed({a: b for a, b in RENAMES.items() if a in df.columns and b not in df.columns})
    for c in EMPTY_TEXTS:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit(""))
    if "sub_id" not in df.columns:
        df = df.withColumn("sub_id", F.lit(None).cast("string"))
    given = F.nullif(F.col("first_complaint_time"), F.lit("")) if "first_complaint_time" in df.columns else F.lit(None).cast("string")
    return df.withColumn("first_complaint_time", F.coalesce(given, earliest_padded(F.regexp_replace("complaint_content", "【(?:通话|会话)", "【-"))))


def errors_of(df: DataFrame) -> Column:
    """An array of what is wrong with a row; empty if nothing."""
    unknown = sorted(set(df.columns) - set(WIDE))
    found = [F.lit(f"{c}: unknown column") for c in unknown]
    for c in REQUIRED:
        found.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) if c in df.columns else F.lit(f"{c}: missing"))
    for c in TEXTS:
        if c in df.columns:
            found.append(F.when(F.col(c).isNull(), F.lit(f"{c}: null")))
    for c in COUNTS:
        if c in df.columns:
            n = F.col(c).cast("string").try_cast("bigint")
            found.append(F.when(n.isNull(), F.lit(f"{c}: not a whole number")).when(n < 0, F.lit(f"{c}: negative")))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def validated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows as wide rows, and the rejected ones with their errors and raw JSON."""
    checked = df.withColumn("_errors", errors_of(df))
    good = checked.where(F.size("_errors") == 0)
    columns = []
    for c in WIDE:
        if c in COUNTS:
            columns.append((F.col(c).cast("string").try_cast("bigint") if c in df.columns else F.lit(0).cast("long")).alias(c))
        else:
            columns.append((F.col(c) if c in df.columns else F.lit(None if c in NULLABLE else "")).cast("string").alias(c))
    bad = checked.where(F.size("_errors") > 0)
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return good.select(*columns), bad.select(raw.alias("raw_json"), F.col("_errors").alias("errors"))
