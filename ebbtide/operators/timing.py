"""Distributions of times between publishing and complaints, and of where labels come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.risk import contains_any
from ebbtide.functions.times import hour_bucket, hour_bucket_place

# Words by which a reason rests on complaints.
COMPLAINT_WORDS = ("投诉", "招满", "联系不上", "已招满")


def bucket_table(df: DataFrame, hours: Column, total: bool = False) -> DataFrame:
    """(place, bucket, n, pct) of hours, in the order of the buckets; optionally a total row at the end."""
    counts = df.select(hours.alias("h")).where("h is not null").groupBy(hour_bucket(F.col("h")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))
    out = counts.select(hour_bucket_place(F.col("bucket")).cast("long").alias("place"), "bucket", "n", (F.col("n") * 100.0 / F.sum("n").over(every)).alias("pct"))
    if total:
        last = counts.agg(F.sum("n").alias("n")).select(F.lit(99).cast("long").alias("place"), F.lit("total").alias("bucket"), "n", F.lit(100.0).alias("pct"))
        out = out.unionByName(last)
    return out


def fixed_bins(df: DataFrame, value: Column, low: float, high: float, width: float) -> DataFrame:
    """(bin, n): counts by bins of one width, of the values from low to high."""
    clipped = df.select(value.alias("v")).where(F.col("v").between(low, high))
    return clipped.groupBy(F.floor((F.col("v") - low) / width).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def count_distribution(df: DataFrame, key: str) -> DataFrame:
    """(n_per_key, n_keys): how many keys have how many rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_per_key")).groupBy("n_per_key").agg(F.count(F.lit(1)).alias("n_keys"))


def rate_by_count(df: DataFrame, count: str, flag: str) -> DataFrame:
    return df.groupBy(count).agg(F.count(F.lit(1)).alias("n"), (F.avg(F.col(flag).cast("int")) * 100).alias("rate"))


def uses_complaint(reason: Column, words: tuple[str, ...] = COMPLAINT_WORDS) -> Column:
    return contains_any(F.coalesce(reason, F.lit("")), words)


def label_source(temporal: Column, normalizable: Column, expiry: Column, complaint: Column) -> Column:
    return (
        F.when(temporal & normalizable & ~complaint, "文本时效信号")
        .when(temporal & ~normalizable & ~complaint, "模糊时效信号")
        .when(expiry & complaint, "仅投诉")
        .when(~expiry, "无法打标")
        .otherwise("其他")
    )


def label_sets(temporal: Column, normalizable: Column, expiry: Column, complaint: Column, filled: Column) -> dict[str, Column]:
    """The sets A to E, which overlap; F is what lies in none."""
    sets = {
        "A": temporal & normalizable & ~complaint,
        "B": temporal & ~normalizable & ~complaint,
        "C": expiry & complaint,
        "D": ~temporal & ~filled & ~expiry,
        "E": ~temporal & filled,
    }
    none = F.lit(True)
    for s in sets.values():
        none = none & ~s
    return sets | {"F": none}


def label_class(temporal: Column, normalizable: Column, expiry: Column, complaint: Column, filled: Column) -> Column:
    """The same as a cascade in which the first that holds counts: A, B, C, E, D, F."""
    sets = label_sets(temporal, normalizable, expiry, complaint, filled)
    out = F.when(sets["A"], "A")
    for name in ("B", "C", "E", "D"):
        out = out.when(sets[name], name)
    return out.otherwise("F")
