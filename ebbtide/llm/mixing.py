"""Mixing sources to target weights by capped water-filling.

``targets`` clamps each source at ``max_epochs`` times its size and hands what is cut off to
the other sources in proportion to their weights, until none is above its cap.  Sources in
order of cap by weight are clamped up to one place, so running sums find the level at once.
``plan`` then turns a source's target into whole repetitions of every document plus a seeded
sample of documents for the fractional one.  Everything is DataFrame operations.

The fractional sample is the set of documents whose hash lies below a cut.  The cut is found
digit by digit (base 16) from sums by (source, digit), so no task ever orders a whole source:
only the last leaf, of some dozens to some hundreds of distinct documents, is gathered.  It is filled from its
largest documents down, then rounded, which keeps a source's taken words within half the
leaf's smallest untaken document of its target.  Rows that are equal in every column are one
document with a count, so any number of them is a row of the plan and no hot spot; sources
are lined up by ranges, so there may be as many as hosts.

Edge cases: null or empty texts have size 0 and are taken as whole repetitions only; a null
source is a source of its own and ranks last; repeated rows are separate documents, of which
as many as the sample takes get the extra copy; an empty table gives an empty mix; other
columns, whatever their names, pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import WORD, if_small, table, text_of, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 20240607
DIGITS = 12
LEAF = 48


def size_of(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def with_running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """Add running sums, own row included, in a total order.

    Rows are dealt out by ranges of the order; each range starts from the sums of those before
    it, so no task sees more than its range."""
    ranges = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    each = ranges.groupBy("_range").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = each.select("_range", *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in sums])
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row a range, of which there are as many as shuffle partitions
    joined = ranges.join(F.broadcast(starts), "_range")
    return joined.withColumns({name: F.sum(c).over(own) + F.col(f"_{name}") for name, c in sums.items()}).drop("_range", *[f"_{name}" for name in sums])


def source_sizes(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, n_docs, weight): one row a source, weights dealt in code-point order.
    docs: (source, size, m), m the number of equal rows."""
    sums = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = with_running(sums, [F.col("source").asc_nulls_last()], place=F.lit(1))
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    return ranked.withColumn("weight", dealt).drop("place")


def targets(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of sources (source, source_size, weight above 0).

    Only the level, one number, reaches the driver: a source gets weight times level words, or
    its cap if that is less."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ratio = cap / F.col("weight")
    order = [ratio.asc(), F.col("source").asc_nulls_last()]
    lined = with_running(sources, order, caps=cap, weights=F.col("weight"), place=F.lit(1))
    all_ = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, weight = share * (all_["size"] or 0), all_["weight"] or 0.0
    # the level if just the sources before this one are clamped
    level = (F.lit(total) - (F.col("caps") - cap)) / (F.lit(weight) - (F.col("weights") - F.col("weight")))
    found = lined.where(level <= ratio).agg(F.min_by(level, "place").alias("level")).first()["level"]
    return sources.withColumn("target", cap if found is None else F.least(cap, F.col("weight") * F.lit(found)))


def _equal_rows(docs: DataFrame, key: str) -> tuple[Column, Column]:
    """(key, tie): rows of equal key and tie are equal in every column that can be hashed."""
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name not in (key, "text") and "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return F.col(key), F.xxhash64(text_of(), *[F.coalesce(F.xxhash64(c), F.lit(0)) for c in others])


def planned(docs: DataFrame, key: str = "doc_id", seed: int = SEED, **how: object) -> DataFrame:
    """(key, tie, source, size, source_size, target, m, whole, extra): a row for each distinct
    row of docs; each of its m copies is taken ``whole`` times, ``extra`` of them once more."""
    own, tie = _equal_rows(docs, key)
    slim = docs.select(own.alias("key"), tie.alias("tie"), F.col("source").alias("source"), size_of().alias("size"))
    slim = slim.groupBy("key", "tie", "source", "size").agg(F.count(F.lit(1)).alias("m")).withColumn("h", F.xxhash64(F.lit(seed), "key", "tie"))
    slim = written(slim.withColumn("words", F.col("size") * F.col("m")))
    sizes = written(source_sizes(slim, how.get("weights", WEIGHTS)))
    sources = targets(sizes, how.get("share", SHARE), how.get("max_epochs", MAX_EPOCHS))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = written(
        sources.withColumn("whole", F.floor(epochs).cast("long"))
        .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
        .withColumn("depth", F.greatest(F.lit(0), F.floor(F.log(16.0, F.greatest(F.col("n_docs"), F.lit(1)) / F.lit(float(LEAF))))).cast("int"))
        .withColumn("depth", F.least(F.col("depth"), F.lit(DIGITS)))
    )
    depth = sources.agg(F.max("depth")).first()[0] or 0
    digit = lambda level: F.shiftrightunsigned(F.col("h"), 60 - 4 * level).bitwiseAND(F.lit(15))
    # prefix: the digits of the cut so far; rest: words still to give below it.
    cuts = sources.select("source", "depth", "rest", F.lit(0).cast("long").alias("prefix"))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    for level in range(depth):
        inside = (
            slim.alias("d")
            .join(if_small(cuts.where(F.col("depth") > level)).alias("c"), same("d", "c"))
            .where((F.shiftrightunsigned(F.col("h"), 64 - 4 * level) == F.col("prefix")) if level else F.lit(True))
        )
        sums = inside.groupBy("d.source", digit(level).alias("digit")).agg(F.sum("words").alias("n"))
        sums = sums.join(cuts.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        up_to = F.sum("n").over(Window.partitionBy("source").orderBy("digit"))
        low = sums.withColumn("below", up_to - F.col("n")).where(F.col("below") <= F.col("rest"))
        chosen = low.groupBy("source").agg(F.max_by(F.struct("digit", "below"), "digit").alias("cut"))
        chosen = chosen.select(F.col("source").alias("s"), F.col("cut.digit").alias("digit"), F.col("cut.below").alias("below"))
        joined = cuts.join(chosen, F.col("source").eqNullSafe(F.col("s")), "left")
        moved = (F.col("depth") > level) & F.col("digit").isNotNull()
        cuts = written(
            joined.select(
                "source",
                "depth",
                F.when(moved, F.col("rest") - F.col("below")).otherwise(F.col("rest")).alias("rest"),
                F.when(moved, F.col("prefix") * 16 + F.col("digit")).otherwise(F.col("prefix")).alias("prefix"),
            )
        )
    cut = sources.join(cuts.select(F.col("source").alias("s"), F.col("rest").alias("leaf_rest"), "prefix"), F.col("source").eqNullSafe(F.col("s")))
    cut = written(cut.drop("s", "rest", "n_docs", "weight"))
    placed = slim.alias("d").join(if_small(cut).alias("c"), same("d", "c")).drop(F.col("c.source"))
    high = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(h, 64 - 4 * depth)"))
    placed = placed.withColumn("high", high)
    leaf = F.col("high") == F.col("prefix")
    of_source = ("source", "source_size", "target", "whole")
    held = placed.where(leaf).groupBy(*of_source, "leaf_rest").agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "h", "key", "tie", "size", "m"))).alias("held"))
    in_leaf = held.select(*of_source, F.explode(_filled(F.col("held"), F.col("leaf_rest"), slim.schema["key"].dataType.simpleString())).alias("x")).select(*of_source, "x.*")
    outside = placed.where(~leaf).withColumn("extra", F.when((F.col("high") < F.col("prefix")) & (F.col("size") > 0), F.col("m")).otherwise(F.lit(0)))
    columns = ["key", "tie", "source", "size", "source_size", "target", "m", "whole", "extra"]
    return in_leaf.select(*columns).unionByName(outside.select(*columns))


def _filled(held: Column, rest: Column, key_type: str) -> Column:
    """The documents of a leaf, largest first, with how many of each fill the rest best."""
    kind = f"array<struct<key:{key_type},tie:long,size:long,m:long,extra:long>>"

    def step(acc: Column, x: Column) -> Column:
        extra = F.when(x["size"] > 0, F.least(x["m"], F.floor(acc["rest"] / x["size"]))).otherwise(F.lit(0).cast("long"))
        one = F.struct(x["key"].alias("key"), x["tie"].alias("tie"), x["size"].alias("size"), x["m"].alias("m"), extra.alias("extra"))
        return F.struct((acc["rest"] - extra * x["size"]).alias("rest"), F.concat(acc["out"], F.array(one)).cast(kind).alias("out"))

    def rounded(acc: Column) -> Column:
        at = F.array_max(F.transform(acc["out"], lambda x, i: F.when((x["extra"] < x["m"]) & (x["size"] > 0), i)))
        return F.transform(acc["out"], lambda x, i: x.withField("extra", x["extra"] + F.when((i == at) & (2 * acc["rest"] >= x["size"]), 1).otherwise(0)))

    return F.aggregate(held, F.struct(rest.cast("double").alias("rest"), F.array().cast(kind).alias("out")), step, rounded)


def plan(docs: DataFrame, key: str = "doc_id", seed: int = SEED, **how: object) -> DataFrame:
    """(key, tie, source, size, source_size, target, copies) for every row of docs.

    ``tie`` tells rows of equal key apart (a hash of their other columns)."""
    each = planned(docs, key, seed, **how).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    copies = F.col("whole") + (F.col("_row") <= F.col("extra")).cast("long")
    return each.select("key", "tie", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", seed: int = SEED, **how: object) -> DataFrame:
    """The mixed corpus: each row of docs as many times as the plan takes it, columns unchanged."""
    total = F.col("whole") * F.col("m") + F.col("extra")
    chosen = planned(docs, key, seed, **how).select(F.col("key").alias("_key"), F.col("tie").alias("_tie"), F.col("m").alias("_m"), total.alias("_copies"))
    chosen = chosen.where("_copies > 0")
    own, tie = _equal_rows(docs, key)
    of = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("_own"), tie.alias("_own_tie"), of.alias("_of"))
    joined = rows.join(chosen, F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_own_tie") == F.col("_tie")))
    # of equal rows one stands for all
    several = joined.where("_m > 1").dropDuplicates(["_own", "_own_tie"])
    every = joined.where("_m = 1").unionByName(several)
    return every.select("_of", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_of.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {"op6_mixing": op6_mixing}
ORACLE_SQL: dict[str, str] = {}
