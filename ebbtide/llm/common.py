"""What the operators share: reading tables, texts without nulls, tables in the shared folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="ebbtide-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir.  Where that is unset, below the warehouse, or, if
    all of Spark is in this process, as in tests, below a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _own_folder() if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/ebbtide-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back: cuts lineage, and
    outlives the loss of any executor."""
    spark = df.sparkSession
    path = shared_folder(spark)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The table, its session set to send Python at most so many rows at once: whole texts can
    be long, and a worker holds a batch of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= rows:
        df.sparkSession.conf.set(name, str(rows))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """The name, or a longer one if the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def if_small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """The table, marked for broadcast only if counting finds it small; else Spark shuffles it.

    For tables with narrow rows that have been written before, so that counting is cheap."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
