"""Keyed tables without a table format: merges, deletions, caps, and the last row of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_of_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key: the last in the given order."""
    window = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def latest_with_ties(df: DataFrame, key: str, time: str) -> DataFrame:
    """All rows of a key's latest time."""
    window = Window.partitionBy(key).orderBy(F.col(time).desc())
    return df.withColumn("_place", F.rank().over(window)).where("_place = 1").drop("_place")


def merged(old: DataFrame, new: DataFrame, key: str, created: str | None = None, *order: str) -> DataFrame:
    """Old rows whose key is not new, and the new rows; a column ``created`` keeps its old value.

    With ``order``, the last row of a key counts on both sides."""
    if order:
        old, new = last_of_key(old, key, *order), last_of_key(new, key, *order)
    if created is not None:
        first = old.groupBy(F.col(key).alias("_key")).agg(F.min(created).alias("_created"))
        new = new.join(first, F.col(key) == F.col("_key"), "left").withColumn(created, F.coalesce("_created", created)).drop("_key", "_created")
    return old.join(new.select(key), key, "left_anti").unionByName(new.select(*old.columns))


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def without_prefix(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.where(~F.col(key).startswith(prefix))


def without_entity(tables: dict[str, DataFrame], entity_key: str) -> dict[str, DataFrame]:
    """Every table without an entity's rows; steps go by the runs of the entity."""
    runs = tables["runs"].where(F.col("entity_key") == entity_key).select("run_id")
    return {name: without_keys(df, runs, "run_id") if "entity_key" not in df.columns else df.where(F.col("entity_key") != entity_key) for name, df in tables.items()}


def capped(df: DataFrame, key: str, most: int, *order: str) -> DataFrame:
    """The first ``most`` rows of each key: an append with a cap keeps the earliest."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= most).drop("_place")


def publish_key(entity: Column, schema_version: Column, graph_version: Column, fallback: Column) -> Column:
    return F.concat_ws("::", entity, schema_version, graph_version, F.when(fallback, F.lit("fallback")))


def cache_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("::", *parts), 256)


def not_yet_done(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Candidates whose key has not been processed."""
    return without_keys(candidates, done, key)
