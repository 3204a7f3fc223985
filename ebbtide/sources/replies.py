"""A store of model replies by cache key: read first, ask only what is missing, keep what was said.

``<path>/replies/task=...`` holds (cache_key, reply, said_at), appended by waves; ``<path>/requests``
holds what was still to ask, one table a run and task, so that a run that is repeated or a task
that is retried never computes the rows above again.  A wave's replies are committed before the
next wave is asked: a run that fails loses one wave at most, and a lost task repeats at most
``per_task`` calls.  Where two runs asked the same key, the reply said first counts.
Calls that fail are not stored, so the next run tries them again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORED = "cache_key string, reply string, said_at timestamp, task string"


@dataclass(frozen=True)
class ReplyStore:
    path: str
    per_task: int = 200
    wave: int = 20_000

    def read(self, spark: SparkSession, task: str | None = None) -> DataFrame:
        """(cache_key, task, reply): one row a key; empty where nothing has been stored."""
        try:
            stored = spark.read.schema(STORED).parquet(f"{self.path}/replies")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = spark.createDataFrame([], STORED)
        stored = stored if task is None else stored.where(F.col("task") == task)
        return stored.groupBy("cache_key", "task").agg(F.min_by("reply", F.struct("said_at", "reply")).alias("reply"))

    def append(self, replies: DataFrame, task: str) -> None:
        """Keep the (cache_key, reply) rows that have a reply."""
        said = replies.where("reply IS NOT NULL").select("cache_key", "reply", F.current_timestamp().alias("said_at"), F.lit(task).alias("task"))
        said.write.mode("append").partitionBy("task").parquet(f"{self.path}/replies")

    def kept(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """A table of this run's own, written once and read from then on."""
        path = f"{self.path}/requests/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def missing(self, requests: DataFrame, task: str, waves: int = 1) -> DataFrame:
        """The (cache_key, request, wave) rows that have no reply yet, each key once, in one shuffle by wave and key."""
        asked = requests.where("cache_key IS NOT NULL AND request IS NOT NULL").select("cache_key", "request", F.lit(False).alias("known"))
        known = self.read(requests.sparkSession, task).select("cache_key", F.lit(None).cast("string").alias("request"), F.lit(True).alias("known"))
        both = asked.unionByName(known).withColumn("wave", F.pmod(F.xxhash64("cache_key"), F.lit(waves)).cast("int"))
        both = both.repartition("wave") if waves > 1 else both
        return both.groupBy("wave", "cache_key").agg(F.min("request").alias("request"), F.bool_or("known").alias("known")).where("NOT known").select("cache_key", "request", "wave")

    def fill(self, requests: DataFrame, task: str, ask: Callable[[int], Callable[[str], str | None]], in_flight: int = 8) -> int:
        """Ask what is missing and store the replies; the number of requests asked.

        ``ask(tasks)`` is called in each task, with the number of tasks that run at once, and gives
        the function that asks the model; it must not raise (null is a failed call).  ``in_flight`` calls of a task run at once.
        A wave's requests have a folder of their own, so it reads no others'."""
        spark = requests.sparkSession
        keys = requests.where("cache_key IS NOT NULL AND request IS NOT NULL").select("cache_key").distinct()
        n = keys.join(self.read(spark, task), "cache_key", "left_anti").count()
        waves = math.ceil(n / self.wave)
        left = self.kept(self.missing(requests, task, waves), task, "wave") if waves else None
        for wave in range(waves):
            part = left.where(F.col("wave") == wave).drop("wave")
            tasks = max(1, math.ceil(n / waves / self.per_task))
            at_once = min(tasks, spark.sparkContext.defaultParallelism)

            def run(frames: Iterator[pd.DataFrame], at_once: int = at_once) -> Iterator[pd.DataFrame]:
                one = ask(at_once)
                with ThreadPoolExecutor(in_flight) as pool:
                    for frame in frames:
                        yield pd.DataFrame({"cache_key": frame["cache_key"], "reply": pd.Series(list(pool.map(one, frame["request"])), dtype=object)})

            self.append(part.repartition(tasks, "cache_key").mapInPandas(run, "cache_key string, reply string"), task)
        return n
