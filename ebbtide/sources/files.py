"""Readers and writers of the engine's files and tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RETENTION_DAYS = 120


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="ebbtide-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or, where that is
    unset, below the warehouse; a temporary one only if all of Spark is in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _own_folder() if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/ebbtide-{uuid.uuid4().hex}"


def scan(spark: SparkSession, path: str, pt: str | None = None, columns: list[str] | None = None, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """A Parquet table, one partition of it, some of its columns: pruned in the scan.

    Files of different columns need their schema, or ``merge``, which opens the footers of all."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", str(merge).lower())
    df = reader.parquet(path)
    if pt is not None:
        df = df.where(F.col("pt") == pt)
    return df.select(*columns) if columns else df


def limited(df: DataFrame, rows: int | None, condition=None) -> DataFrame:  # noqa: ANN001
    """The first rows, and of those the ones that meet the condition: the limit comes first."""
    df = df.limit(rows) if rows is not None else df
    return df if condition is None else df.where(condition)


def by_ids(df: DataFrame, ids: list[str], key: str = "info_id") -> DataFrame:
    wanted = list(dict.fromkeys(i.strip() for i in ids if i and i.strip()))
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):  # of the column's own type, so that the scan gets the filter
        most = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31}.get(type(kind), 63)
        numbers = [int(i) for i in wanted if i.removeprefix("-").isascii() and i.removeprefix("-").isdigit() and str(int(i)) == i]
        return df.where(F.col(key).isin([n for n in numbers if -(1 << most) <= n < 1 << most])) if numbers else df.limit(0)
    return df.where((F.col(key) if isinstance(kind, T.StringType) else F.col(key).cast("string")).isin(wanted)) if wanted else df.limit(0)


def rendered_sql(spark: SparkSession, text: str, **values: str) -> DataFrame:
    """A SQL text with named parameters (:bizdate, :publish_start, :publish_end)."""
    return spark.sql(text, args=values)


def read_rows(spark: SparkSession, path: str, schema: T.StructType, pt: str | None = None) -> DataFrame:
    """A JSON array (*.json) or lines of JSON; with pt only that partition's rows, a missing one as empty text."""
    df = spark.read.schema(schema).option("multiLine", path.endswith(".json")).json(path)
    if pt is not None:
        df = df.where(F.coalesce(F.col("pt"), F.lit("")) == pt)
    return df.drop("pt")


def read_keyed_lines(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Keyed lines of JSON, the last line of a key."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line")).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", schema).alias("r"), "_file", "_line").select("r.*", "_file", "_line")
    order = Window.partitionBy(key).orderBy(F.col("_file").desc(), F.col("_line").desc())
    return rows.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_file", "_line", "_place")


def write_partition(df: DataFrame, path: str, by: str = "pt") -> None:
    """Overwrite just the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(by).parquet(path)


def write_keyed_lines(df: DataFrame, path: str, key: str) -> None:
    """Lines of JSON in order of their key, fields in order of their names."""
    df.select(*sorted(df.columns)).orderBy(key).write.mode("overwrite").json(path)


def expired_partitions(df: DataFrame, today: str, days: int = RETENTION_DAYS) -> DataFrame:
    """(pt) of the partitions older than the retention."""
    return df.select("pt").distinct().where(F.to_date("pt", "yyyyMMdd") < F.date_sub(F.to_date(F.lit(today), "yyyyMMdd"), days))


def column_survey(spark: SparkSession, path: str, wanted: list[str], by: str = "pt") -> DataFrame:
    """(pt, columns, lacks) of a table's partitions: which columns their files have, and which of the
    wanted ones they lack.  One footer a partition is opened; partitions are at most the retention's days."""
    days = [r[0] for r in spark.read.schema(f"{by} string").parquet(path).select(by).distinct().collect()]
    found = [(day, spark.read.parquet(f"{path}/{by}={day}").columns) for day in sorted(days)]
    return spark.createDataFrame([(day, columns, [c for c in wanted if c not in columns]) for day, columns in found], f"{by} string, columns array<string>, lacks array<string>")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are missing or null have their default, of the column's own type if it is there."""
    make = lambda c, v: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) if c in df.columns else F.lit(v)
    return df.withColumns({c: make(c, v) for c, v in defaults.items()})
