"""What the review screens ask: counts by route, pages of latest runs, search, daily summaries."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ebbtide.operators.keyed import latest_with_ties
from ebbtide.sources.templates import day

MAX_RANGE_DAYS = 30


def route_stats(runs: DataFrame, *by: str) -> DataFrame:
    """formal, fallback and total counts; the total has all routes."""
    return runs.groupBy(*by).agg(F.count_if(F.col("route") == "formal").alias("formal"), F.count_if(F.col("route") == "fallback").alias("fallback"), F.count(F.lit(1)).alias("total"))


def distribution(df: DataFrame, column: Column, name: str = "label") -> DataFrame:
    """Counts by label (null is unknown), the share of all, and the share of the largest."""
    counts = df.groupBy(F.coalesce(column, F.lit("unknown")).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))  # one row a label
    return counts.select(name, "n", (F.col("n") / F.sum("n").over(every)).alias("share"), (F.col("n") / F.max("n").over(every)).alias("bar"))


def shown_distribution(df: DataFrame, column: Column, name: str = "label") -> DataFrame:
    """What a chart shows: the labels that occur, from the most frequent on, ties by label."""
    return distribution(df, column, name).where("n > 0").orderBy(F.col("n").desc(), name)


def runs_page(runs: DataFrame, annotations: DataFrame | None, annotated: bool | None, offset: int, limit: int) -> DataFrame:
    """Latest runs per entity (ties kept), newest first; optionally only those with or without annotation."""
    latest = latest_with_ties(runs, "entity_key", "updated_at")
    if annotated is not None and annotations is not None:
        latest = latest.join(annotations.select("entity_key").distinct(), "entity_key", "left_semi" if annotated else "left_anti")
    return latest.orderBy(F.col("updated_at").desc(), F.col("run_id").desc()).offset(offset).limit(limit)


MAX_PAGE = 100


def page_with_total(df: DataFrame, offset: int, limit: int, *order: Column) -> DataFrame:
    """A page of rows with ``total``, the number of all rows of df, in one pass: rows are counted on
    their way to the top-k.  A page has at most ``MAX_PAGE`` rows; one beyond the end has none."""
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"a page has 1 to {MAX_PAGE} rows and starts at 0 or later")
    seen = Observation()
    page = df.observe(seen, F.count(F.lit(1)).alias("total")).orderBy(*order).offset(offset).limit(limit).collect()
    total = seen.get["total"] if page else df.count()  # a plan that surely gives nothing is not run, and not counted
    return df.sparkSession.createDataFrame(page, df.schema).withColumn("total", F.lit(total).cast("long"))


def most_common(df: DataFrame, value: Column, seen: Column, limit: int | None = None) -> DataFrame:
    """(value, n, first): counts from the largest on, ties by what was seen first."""
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("first")).orderBy(F.col("n").desc(), "first")
    return counts if limit is None else counts.limit(limit)


def recent(df: DataFrame, ident: str, limit: int = 20, **equal: str | None) -> DataFrame:
    """The rows of largest id; a filter that is empty lets all pass."""
    for column, wanted in equal.items():
        df = df.where(F.col(column) == wanted) if wanted else df
    return df.orderBy(F.col(ident).desc()).limit(limit)


def search(df: DataFrame, column: str, query: str, *order: Column, limit: int = 50) -> DataFrame:
    """Rows whose column contains the query, whatever the case of A to Z; % and _ stand for any
    characters, as in the source; an empty query finds none."""
    if not query:
        return df.limit(0)
    folded = lambda c: F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    pattern = "".join(c.lower() if c.isascii() else c for c in query).replace("\\", "\\\\")
    return df.where(folded(F.col(column)).like(f"%{pattern}%")).orderBy(*order).limit(limit)


STEP = ("step_name", "prompt_version", "model_version", "payload_json", "result_json", "error_type", "created_at")
NOTE = ("annotated_label", "reviewer_notes", "reviewer_name", "created_at", "id")


def run_details(runs: DataFrame, steps: DataFrame, annotations: DataFrame) -> DataFrame:
    """The runs with ``steps``, in order of their time, and ``annotations`` of the run's entity, in
    order of time and id: arrays of structs, empty where there are none.

    Filter runs by run_id before for one of them; the filter prunes the steps' scan too."""
    array = lambda by, fields, first: F.array_sort(F.collect_list(F.struct(*first, *[f for f in fields if f not in first]))).alias(by)
    of_run = steps.groupBy("run_id").agg(array("steps", STEP, ("created_at", "step_name")))
    of_entity = annotations.groupBy("entity_key").agg(array("annotations", NOTE, ("created_at", "id")))
    joined = runs.join(of_run, "run_id", "left").join(of_entity, "entity_key", "left")
    none = lambda name, df: F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)).alias(name)
    return joined.select(*runs.columns, none("steps", of_run), none("annotations", of_entity))


def days_between(spark, start: str, end: str, most: int = MAX_RANGE_DAYS) -> DataFrame:  # noqa: ANN001
    """(pt) of the days from start to end, yyyyMMdd; a range of more than ``most`` days is an error."""
    first, last = day(start), day(end)
    if first > last:
        raise ValueError("the range ends before it starts")
    if (last - first).days >= most:
        raise ValueError(f"the range has more than {most} days")
    return spark.sql(
        "SELECT date_format(d, 'yyyyMMdd') AS pt FROM (SELECT explode(sequence(to_date(:a, 'yyyyMMdd'), to_date(:b, 'yyyyMMdd'), interval 1 day)) AS d)",
        args={"a": start, "b": end},
    )


def daily_summary(runs: DataFrame, summaries: DataFrame | None = None) -> DataFrame:
    """Counts by pt, those of a written summary first, newest day first."""
    counted = runs.groupBy("pt").agg(F.count_if(F.col("route") == "formal").alias("formal"), F.count_if(F.col("route") == "fallback").alias("fallback"))
    counted = counted.withColumn("total", F.col("formal") + F.col("fallback"))
    if summaries is not None:
        told = summaries.select("pt", F.col("formal_count").alias("f"), F.col("fallback_count").alias("b"), F.col("processed_count").alias("t"))
        counted = counted.join(told, "pt", "full").select("pt", F.coalesce("f", "formal").alias("formal"), F.coalesce("b", "fallback").alias("fallback"), F.coalesce("t", "total").alias("total"))
    return counted.orderBy(F.col("pt").desc())


def valid_day(pt: Column) -> Column:
    return pt.rlike(r"^\d{8}$") & F.try_to_timestamp(pt, F.lit("yyyyMMdd")).isNotNull()


def valid_partition(pt: Column) -> Column:
    """A day, a pair of days, or one of the two special names."""
    pair = pt.rlike(r"^\d{8}_\d{8}$") & valid_day(F.substring(pt, 1, 8)) & valid_day(F.substring(pt, 10, 8))
    return pt.isin("_legacy", "_root") | valid_day(pt) | F.coalesce(pair, F.lit(False))


def partitions(df: DataFrame) -> DataFrame:
    """(pt, n, place): days from newest, then ranges by their end, then the legacy partition."""
    counts = df.where(valid_partition(F.col("pt"))).groupBy("pt").agg(F.count(F.lit(1)).alias("n"))
    group = F.when(valid_day(F.col("pt")), 0).when(F.col("pt") == "_legacy", 2).otherwise(1)
    end = F.when(group == 1, F.substring("pt", 10, 8)).otherwise(F.col("pt"))
    order = Window.partitionBy(F.lit(1)).orderBy(group, end.desc(), F.col("pt").desc())
    return counts.withColumn("place", F.row_number().over(order).cast("long"))


def latest_partition(df: DataFrame) -> DataFrame:
    return df.where(valid_day(F.col("pt"))).agg(F.max("pt").alias("pt"))


def last_and_count(events: DataFrame, user: str, ident: str, *columns: str) -> DataFrame:
    """Per user the columns of the event of largest id, and the number of events, in one pass."""
    kept = F.max_by(F.struct(*columns), ident).alias("_last")
    return events.groupBy(user).agg(F.max(ident).alias(ident), kept, F.count(F.lit(1)).alias("event_count")).select(user, ident, *[F.col(f"_last.{c}").alias(c) for c in columns], "event_count")


def in_request_order(ids: DataFrame) -> DataFrame:
    """(place, id): requested ids (an array column ``ids``), trimmed, without blanks, each once."""
    clean = F.array_distinct(F.filter(F.transform("ids", lambda x: F.trim(x)), lambda x: x != ""))
    return ids.select(F.posexplode(clean).alias("place", "id"))


def not_found(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return requested.join(known.select(F.col(key).cast("string").alias("id")), "id", "left_anti").select("place", "id")
