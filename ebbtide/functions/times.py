"""Times as text, hours between them, and buckets of hours."""

from __future__ import annotations

import functools

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Ranges that a group's values are cut into for its median.
RANGES = 64

ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
# Upper ends of the hour buckets, half open, and their labels.
HOUR_BUCKETS = (
    (0, "< 0h (异常)"), (1, "0-1h"), (2, "1-2h"), (3, "2-3h"), (6, "3-6h"), (12, "6-12h"), (24, "12-24h"), (48, "1-2天"), (72, "2-3天"), (168, "3-7天"),
)
LAST_BUCKET = "> 7天"


def iso_time(text: Column) -> Column:
    """A strict ISO time; null for what is none (such as seconds of one digit)."""
    text = F.trim(text)
    return F.when(text.rlike(ISO), F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")))


def contradicts(filled_at: Column, expiry: Column) -> Column:
    """Whether a post was filled before the predicted end; null if either is no time, and an
    error mark is due elsewhere if just one has an offset (see ``mixed_offsets``)."""
    return iso_time(filled_at) < iso_time(expiry)


def mixed_offsets(a: Column, b: Column) -> Column:
    offset = lambda x: F.trim(x).rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & F.trim(x).rlike("[T ]")
    return iso_time(a).isNotNull() & iso_time(b).isNotNull() & (offset(a) != offset(b))


def wall_clock(text: Column) -> Column:
    """The time as written, its offset dropped without conversion."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, r"(?:Z|[+-]\d{2}:?\d{2})$", ""), "T", " "))


#: Fixed value: the header of a complaint, its time written loosely.
LOOSE_HEADER = r"【投诉[0-9]+\s+([0-9-]+\s+[0-9:]+)】"


def loose_time(text: Column) -> Column:
    """An ISO time with its offset dropped, or a time with parts of one digit, with or without
    seconds; null for what is none of them."""
    strict = F.when(F.trim(text).rlike(ISO), wall_clock(F.trim(text)))
    loose = [F.try_to_timestamp(F.regexp_replace(F.trim(text), r"\s+", " "), F.lit(f)) for f in ("yyyy-M-d H:m:s", "yyyy-M-d H:m")]
    return F.coalesce(strict, *loose)


def complaint_times(text: Column) -> Column:
    """All complaints' times of a text, in its order; headers that hold no time are left out."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LOOSE_HEADER), F.lit(1))
    return F.filter(F.transform(found, loose_time), lambda t: t.isNotNull())


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_timestamp(b.cast("timestamp")) - F.unix_timestamp(a.cast("timestamp"))) / F.lit(3600.0)


def hour_bucket(hours: Column) -> Column:
    out = F.when(hours < HOUR_BUCKETS[0][0], HOUR_BUCKETS[0][1])
    for end, label in HOUR_BUCKETS[1:]:
        out = out.when(hours < end, label)
    return out.when(hours.isNotNull(), LAST_BUCKET)


def hour_bucket_place(label: Column) -> Column:
    labels = [x for _, x in HOUR_BUCKETS] + [LAST_BUCKET]
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label)


def upper_median(value: str) -> Column:
    """The element at half of the sorted values, rounded up: 3 for 1, 2, 3, 4.

    A group is gathered to be sorted; for groups beyond memory use ``upper_median_by_rank``."""
    return F.expr(f"element_at(array_sort(collect_list({value})), int(count({value}) div 2) + 1)")


def upper_median_by_rank(df, by: list[str], value: str, out: str = "median"):  # noqa: ANN001, ANN201
    """The same for groups of any size, in three narrow passes and no group in one task.

    A group's values are cut into at most ``RANGES`` ranges by approximate quantiles, which the
    aggregation makes as it goes; counts by range tell in which range the median lies, and only
    that range's distinct values are put in order.  Exact, as the ranges only divide the work."""
    rows = df.where(F.col(value).isNotNull()).select(*by, value)
    cuts = rows.groupBy(*by).agg(F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], RANGES * 20).alias("_cuts"), F.count(F.lit(1)).alias("_every"))
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    ranged = rows.alias("r").join(cuts.alias("c"), functools.reduce(lambda a, b: a & b, same)).select("r.*", "_every", F.size(F.filter("_cuts", lambda x: x < F.col(value))).alias("_range"))
    counts = ranged.groupBy(*by, "_every", "_range", value).agg(F.count(F.lit(1)).alias("_n"))
    of_range = counts.groupBy(*by, "_every", "_range").agg(F.sum("_n").alias("_of_range"))
    before = F.coalesce(F.sum("_of_range").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # RANGES rows a group
    place = F.floor(F.col("_every") / 2) + 1
    middle = of_range.withColumn("_before", before).where((F.col("_before") < place) & (F.col("_before") + F.col("_of_range") >= place))
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (*by, "_range")]
    within = counts.alias("n").join(middle.alias("m"), functools.reduce(lambda a, b: a & b, same)).select("n.*", "_before")
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*by).orderBy(value))
    return within.withColumn("_upto", upto).where(F.col("_upto") >= place).groupBy(*by).agg(F.min(value).alias(out))


def value_stats(df, by: list[str], value: str):  # noqa: ANN001, ANN201
    """(low, high, n, mean, median) of a column by group; the median is the upper one."""
    stats = df.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"), F.avg(value).alias("mean"))
    medians = upper_median_by_rank(df, by, value).withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return stats.join(medians, functools.reduce(lambda a, b: a & b, same), "left").drop(*[f"_{c}" for c in by])
