"""The result store as partitioned tables: runs, steps, published records and annotations.

A table is Parquet by ``pt``.  A write merges the partitions that the new rows have and overwrites
those only; other partitions are neither read nor written.  Keys alone are counted first; a row whose
fate is then clear is written where it was read, and of old rows that are replaced only the key moves.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.modeljson import strict_json
from ebbtide.operators.keyed import publish_key
from ebbtide.sources.files import write_partition

MOST_NOTES = 3
#: Bits of one bitmap, and the most bitmaps of each of three kinds (6 MB in all).
BITS, BITMAPS = 1 << 15, 512


def _fates(rows: DataFrame, keys: Sequence[str], created: str) -> DataFrame:
    """Add what is sure of a row's key: ``_alone``, it has this row only; ``_pair``, it has one old row and
    one new, whose ``created`` is ``_low``; ``_covered``, it has a new row.  Where nothing is sure all three are false.

    Keys are marked by their hashes, in bitmaps of a fixed size that are broadcast, one for each kind
    of key; every key marks its own kind, so a place with one kind tells that of all keys there."""
    place = F.xxhash64(*keys)
    which, bit = F.pmod(F.shiftright(place, 15), F.lit(BITMAPS)), F.pmod(place, F.lit(BITS))
    new, old = F.count_if("_new").alias("_n"), F.count_if(~F.col("_new")).alias("_o")
    seen = rows.groupBy(*keys).agg(new, old, F.min(F.when(~F.col("_new"), F.col(created))).alias("_first"))
    one, two = F.col("_n") + F.col("_o") == 1, (F.col("_n") == 1) & (F.col("_o") == 1)
    kinds = {"_one": one, "_two": two, "_many": ~(one | two)}
    first = F.when(two, F.col("_first"))
    like = F.coalesce(F.min(first) == F.max(first), F.lit(False)) & (F.count(first) == F.count_if(two))
    maps = seen.groupBy(which.alias("_which")).agg(*[F.bitmap_construct_agg(F.when(c, bit)).alias(f"{k}_marks") for k, c in kinds.items()], F.min(first).alias("_low"), like.alias("_like"))
    byte = lambda c: F.conv(F.hex(F.substr(c, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = rows.join(F.broadcast(maps), which == F.col("_which"), "left")
    marked = joined.select(*rows.columns, "_low", "_like", *[F.coalesce(F.getbit(byte(f"{k}_marks"), bit % 8) == 1, F.lit(True)).alias(k) for k in kinds])
    covered = F.col("_two") & ~F.col("_one") & ~F.col("_many")
    sure = {"_alone": ~F.col("_two") & ~F.col("_many"), "_pair": covered & F.coalesce("_like", F.lit(False)), "_covered": covered}
    return marked.select(*rows.columns, "_low", *[c.alias(k) for k, c in sure.items()])


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str], now: Column, created: str = "created_at", updated: str = "updated_at", order: Sequence[str] = ()) -> DataFrame:
    """One row a key: the new one if there is one, else the old.

    Keys may repeat on both sides: the last by ``order`` counts (then any, the same in every
    run).  A new row's ``created`` is the earliest that is stored of its key, ``now`` if there is
    none; its ``updated`` is ``now``.  Columns that one side lacks are null there; null keys equal each other.
    Both sides are read several times.  Keys are counted, and rows whose key is sure to have no other row, or one
    old and one new, stay where they are (see ``_fates``); the others meet in one shuffle."""
    if created not in new.columns:
        new = new.withColumn(created, F.lit(None).cast(old.schema[created].dataType if created in old.columns else "timestamp"))
    stamped = new.withColumn(updated, now)
    both = old.withColumn("_new", F.lit(False)).unionByName(stamped.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    names = [c for c in both.columns if c != "_new"]
    rest = [c for c in names if c not in keys]
    kind = both.schema[created].dataType
    both = _fates(both, keys, created)
    begun = F.when(F.col("_new"), F.coalesce(F.when(F.col("_pair"), F.col("_low")), created, now.cast(kind))).otherwise(F.col(created))
    alone = both.where(F.col("_alone") | (F.col("_pair") & F.col("_new"))).select(*[(begun if c == created else F.col(c)).alias(c) for c in names])
    last = F.struct("_new", *order, F.xxhash64(*[F.col(c) for c in names if not isinstance(both.schema[c].dataType, T.MapType)]))
    row = F.when(F.col("_new") | ~F.col("_covered"), F.struct("_new", *rest))
    moved = both.where(~F.col("_alone") & ~F.col("_pair")).select(*keys, row.alias("_row"), last.alias("_last"), F.when(~F.col("_new"), F.col(created)).alias("_created"))
    merged = moved.groupBy(*keys).agg(F.max_by("_row", "_last").alias("_row"), F.min("_created").alias("_created"))
    first = F.when(F.col("_row._new"), F.coalesce("_created", F.col(f"_row.{created}"), now.cast(kind))).otherwise(F.col(f"_row.{created}"))
    return alone.unionByName(merged.select(*[F.col(c) if c in keys else (first if c == created else F.col(f"_row.{c}")).alias(c) for c in names]))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of the store; columns that older files lack are null; empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def upsert(path: str, new: DataFrame, keys: Sequence[str], now: Column, order: Sequence[str] = (), by: str = "pt") -> None:
    """Merge into the partitions that ``new`` has, and overwrite just those."""
    spark = new.sparkSession
    fields = [f for f in new.schema.fields if f.name not in ("created_at", "updated_at")]
    schema = T.StructType([*fields, T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])
    days = [r[0] for r in new.select(by).distinct().collect()]  # days of a run
    old = read_table(spark, path, schema).where(F.col(by).isin(days))
    merged = upserted(old, new.drop("created_at", "updated_at"), [by, *keys], now.cast("timestamp"), order=order)
    write_partition(merged.select(*[f.name for f in schema.fields if f.name != by], by), path, by)


#: The JSON documents of a run, and the column that each comes from.
DOCUMENTS = {
    "wide_row_json": "wide_row", "raw_wide_row_json": "raw_wide_row", "snippet_recall_json": "snippet_recall", "signal_detection_json": "signal_detection", "time_normalization_json": "time_normalization",
    "temporal_signal_json": "temporal_signal", "risk_record_json": "risk_record", "decision_record_json": "decision_record", "timing_ms_json": "timing_ms",
}


@dataclass(frozen=True)
class RunStore:
    """Runs by run_id and steps by (run_id, step_name), below one folder."""

    path: str

    def save(self, records: DataFrame, run_id: Column, pt: Column, now: Column, versions: Mapping[str, str] | None = None, key: str = "info_id") -> None:
        """Upsert the runs of ``records`` (see ``plans.records.run_records``) and their steps."""
        told = records.withColumns({"_run_id": run_id, "_pt": pt})
        as_json = [(F.to_json(c, {"ignoreNullFields": "false"}) if c in records.columns else F.lit(None).cast("string")).alias(name) for name, c in DOCUMENTS.items()]
        named = [F.lit(v).alias(k) for k, v in (versions or {}).items()]
        runs = told.select(F.col("_run_id").alias("run_id"), F.col(key).cast("string").alias("entity_key"), "route", "error_type", *named, *as_json, F.col("_pt").alias("pt"))
        upsert(f"{self.path}/runs", runs, ["run_id"], now)
        steps = told.select(F.col("_run_id").alias("run_id"), F.col("_pt").alias("pt"), F.inline("steps"))
        upsert(f"{self.path}/steps", steps, ["run_id", "step_name"], now)

    def runs(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/runs")

    def steps(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/steps")


def decoded(df: DataFrame, shapes: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Decode JSON columns leniently, each by its own shape: (type, whether the default is the empty document).

    ``x_json`` becomes ``x`` and ``has_x``.  Null, empty and broken JSON, and JSON of another kind than the
    shape (an array for a struct), give the default: null, or a struct whose fields are all null.  Columns
    that the table lacks give the default too.  A field of a wrong type is null by itself."""
    out, dropped = {}, []
    for column, (kind, empty) in shapes.items():
        name = column.removesuffix("_json")
        default = F.from_json(F.lit("{}"), kind) if empty else F.lit(None).cast(kind)
        if column in df.columns:
            fits = F.schema_of_variant(strict_json(F.col(column))).startswith("OBJECT" if kind.lower().startswith(("struct", "map")) else "ARRAY")
            value = F.when(F.coalesce(fits, F.lit(False)), F.from_json(F.col(column), kind, {"mode": "PERMISSIVE"}))
            out[name], out[f"has_{name}"] = F.coalesce(value, default), value.isNotNull()
            dropped.append(column)
        else:
            out[name], out[f"has_{name}"] = default, F.lit(False)
    return df.withColumns(out).drop(*dropped)


# -- published records -------------------------------------------------------------------------


def line_of(key: Column) -> Column:
    """What a publish key names, whatever the route: entity, schema version and graph version."""
    return F.regexp_replace(key, "::fallback$", "")


def combined_outputs(formal: DataFrame, fallback: DataFrame, key: str = "info_id") -> DataFrame:
    """One row a key of both outputs: one for review overrides a formal one, later rows earlier ones.

    Both have ``updated_at``; the route is told by ``route``."""
    both = formal.withColumn("route", F.lit("formal")).unionByName(fallback.withColumn("route", F.lit("fallback")), allowMissingColumns=True)
    rest = [c for c in both.columns if c != key]
    last = F.struct((F.col("route") == "fallback").alias("review"), "updated_at", F.xxhash64(*rest))
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), last).alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def reconciled(published: DataFrame, rerun: DataFrame, run_at: Column) -> tuple[DataFrame, DataFrame]:
    """The published records after a rerun, and tombstones of those that it removed.

    A line (entity and versions) has one record: the rerun's if it is there, whose flipped route so
    removes the record of the other; else what was published, where one for review overrides a formal
    one that an earlier engine left behind.  Both tables: publish_key, entity_key, route, record, updated_at.
    A tombstone has publish_key, entity_key, route, removed_at, reason (superseded, stale_route)."""
    rows = published.withColumn("_new", F.lit(False)).unionByName(rerun.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    names = [c for c in rows.columns if c != "_new"]
    rows = rows.withColumn("_line", line_of(F.col("publish_key")))
    order = [F.col("_new").desc(), (F.col("route") == "fallback").desc(), F.col("updated_at").desc_nulls_last(), F.xxhash64(*names)]
    line = Window.partitionBy("_line").orderBy(*order)  # two routes and a rerun: a few rows
    placed = rows.withColumns({"_place": F.row_number().over(line), "_key": F.first("publish_key").over(line), "_by": F.first("_new").over(line)})
    live = placed.where("_place = 1").select(*names)
    gone = placed.where("_place > 1 AND publish_key <> _key AND NOT _new")
    reason = F.when(F.col("_by"), F.lit("superseded")).otherwise(F.lit("stale_route"))
    stones = gone.groupBy("publish_key", "entity_key", "route").agg(F.min(reason).alias("reason")).withColumn("removed_at", run_at)
    return live, stones.select("publish_key", "entity_key", "route", "removed_at", "reason")


def published_rows(records: DataFrame, versions: Mapping[str, str], updated_at: Column, key: str = "info_id") -> DataFrame:
    """What ``reconciled`` takes, out of run records."""
    entity = F.col(key).cast("string")
    made = publish_key(entity, F.lit(versions.get("feature_schema_version", "")), F.lit(versions.get("graph_version", "")), F.col("route") == "fallback")
    return records.select(made.alias("publish_key"), entity.alias("entity_key"), "route", F.to_json("decision_record", {"ignoreNullFields": "false"}).alias("record"), updated_at.alias("updated_at"))


# -- annotations -------------------------------------------------------------------------------


def annotated(stored: DataFrame, new: DataFrame, runs: DataFrame, most: int = MOST_NOTES) -> DataFrame:
    """Every new note with ``status`` and the run's ``annotation_count`` after it.

    Notes come in order of (created_at, id).  ``unknown_run``: no such run (count null);
    ``max_reached``: the run has ``most`` notes already; ``annotated``: to be appended, with the run's
    entity_key.  Only counts of stored notes are read, and only of runs that have new ones."""
    wanted = new.select("run_id").distinct()
    known = runs.join(wanted, "run_id", "left_semi").groupBy("run_id").agg(F.min("entity_key").alias("_entity"))
    counts = stored.join(wanted, "run_id", "left_semi").groupBy("run_id").agg(F.count(F.lit(1)).alias("_stored"))
    rows = new.drop("entity_key").join(known, "run_id", "left").join(counts, "run_id", "left")
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("created_at", "id"))
    before = F.coalesce("_stored", F.lit(0))
    known_run = F.col("_entity").isNotNull()
    status = F.when(~known_run, "unknown_run").when(before + place > most, "max_reached").otherwise("annotated")
    count = F.when(known_run, F.greatest(before, F.least(before + place, F.lit(most)))).cast("long")
    return rows.select(*[c for c in new.columns if c != "entity_key"], F.col("_entity").alias("entity_key"), status.alias("status"), count.alias("annotation_count"))


def append_notes(path: str, new: DataFrame, runs: DataFrame, most: int = MOST_NOTES) -> DataFrame:
    """Append what fits to the notes at ``path``; the rejected notes, with their status, as a table."""
    spark = new.sparkSession
    fields = [*[f for f in new.schema.fields if f.name != "entity_key"], T.StructField("entity_key", T.StringType())]
    judged = annotated(read_table(spark, f"{path}/notes", T.StructType(fields)), new, runs, most)
    batch = f"{path}/judged/{uuid.uuid4().hex}"
    judged.write.parquet(batch)  # judged once: appending changes what is stored
    judged = spark.read.schema(judged.schema).parquet(batch)
    judged.where("status = 'annotated'").select(*[f.name for f in fields]).write.mode("append").parquet(f"{path}/notes")
    return judged.where("status <> 'annotated'")


# -- counters ----------------------------------------------------------------------------------


def with_counters(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and their counters once an action has gone over them: processed, formal, fallback."""
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("processed_count"), F.count_if(F.col("route") == "formal").alias("formal_count"), F.count_if(F.col("route").isNull() | (F.col("route") != "formal")).alias("fallback_count"))
    return counted, seen


def days_summary(days: DataFrame) -> DataFrame:
    """(total_days, success_days, failed_days, processed_count, formal_count, fallback_count) of the
    days of a schedule; a day failed if it has an error."""
    failed = F.col("error_message").isNotNull()
    sums = [F.coalesce(F.sum(F.when(~failed, F.col(c))), F.lit(0)).alias(c) for c in ("processed_count", "formal_count", "fallback_count")]
    return days.agg(F.count(F.lit(1)).alias("total_days"), F.count_if(~failed).alias("success_days"), F.count_if(failed).alias("failed_days"), *sums)
