"""Filter interaction audit: what each filter removes, in every order of the filters.

Documents come as a stream of files, in available-now micro-batches.  Four filters look at a text
alone: A under 200 words, B under half of its words distinct, C over 3 % of its characters A to
Z, D any of # $ % & * |.  The fifth, E, fails a text that equals the text of any smaller id in
the whole table, which no micro-batch can know by itself: the state of a text (its SHA-256 is the
key) is the smallest id so far and what that row counts as.  A row with a smaller id retracts
the earlier one from the counters, minus its mask without E, plus its mask with E, and takes
its place; all other rows of the text count with E at once.  So the counters are right for the files
read so far after each micro-batch, whatever the order of the files.

The state is a log in the shared folder: a micro-batch adds the texts whose smallest id it brought
or lowered, under its number, and reads those of smaller numbers; so a batch that runs again
reads the same state and writes the same folders again.  (A Python state function a text,
``applyInPandasWithState``, gave the same rows at ten times the CPU seconds.)

Rows of a text are combined before they are dealt by text: after the join with the labels they
lie by id, each task combines those of a text, and a text that a third of all documents share
is a row a task and part.  Counters are one row a (part, mask, good, toxic).

From the counters every order follows, as a step's numbers are sums over the masks of 5 bits.

- Null texts are empty; a null part is the empty string.
- Rows with the same text and id have no smaller id among them: none of them fails E for the others.
- A null id is neither smaller nor larger than another: such rows never fail E, nor make others fail.
- A document counts as good (toxic) if any of its labels is quality = 1 (toxic = 1).
- Empty tables give no parts and so no rows.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import GAP, shared_folder, table, text_of, written

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
SPACE = " \t\n\x0b\x0c\r"
#: Micro-batches that the files are dealt to; more of them need less memory at once.
BATCHES = 4


def failures(text: Column) -> Column:
    """The bits of A to D that a text fails."""
    words = F.filter(F.split(F.btrim(text, F.lit(SPACE)), GAP), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.char_length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def masked(docs: DataFrame, labels: DataFrame, doc: str, text: str, part: str) -> DataFrame:
    """(key, known, doc, part, mask, good, toxic): what a document counts as, but for E."""
    rows = docs.select(
        F.unhex(F.sha2(text_of(text), 256)).alias("key"), F.col(doc).isNotNull().alias("known"), F.coalesce(F.col(doc), F.lit("0").cast(docs.schema[doc].dataType)).alias("doc"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failures(text_of(text)).alias("mask"),
    )
    joined = rows.join(labels, (F.col("doc") == F.col("_doc")) & F.col("known"), "left")
    return joined.select("key", "known", "doc", "part", "mask", F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"))


KIND = ("part", "mask", "good", "toxic")


def combined(rows: DataFrame) -> DataFrame:
    """(key, known, part, mask, good, toxic, first, at_first, n): a text's smallest id, the rows
    that have it, and all rows."""
    of_id = rows.groupBy("doc", "key", "known", *KIND).agg(F.count(F.lit(1)).alias("c"))
    return of_id.groupBy("key", "known", *KIND).agg(F.min("doc").alias("first"), F.min_by("c", "doc").alias("at_first"), F.sum("c").alias("n"))


def fates(new: DataFrame, state: DataFrame | None) -> DataFrame:
    """What a micro-batch changes: (key, part, mask, good, toxic, first, at_first, holds, plain, copies).

    ``new`` are rows of ``combined``, ``state`` the rows that held their text's smallest id when they
    came.  A row that holds it now goes to the state; plain and copies are the changes of the
    counters without and with E."""
    rows = new.withColumn("old", F.lit(False))
    if state is not None:
        rows = rows.unionByName(state.select("key", *KIND, "first", "at_first", F.lit(True).alias("known"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("old")))
    text = Window.partitionBy("key")  # a row or few a text: copies have been combined
    rows = rows.withColumns({"_least": F.min(F.when(F.col("known"), F.col("first"))).over(text), "_before": F.min(F.when(F.col("old"), F.col("first"))).over(text)})
    smallest = F.col("known") & (F.col("first") == F.col("_least"))
    holds = ~F.col("old") & smallest
    retracted = F.col("old") & (F.col("first") == F.col("_before")) & (F.col("_least") < F.col("_before"))
    at, n = F.col("at_first"), F.col("n")
    plain = F.when(retracted, -at).when(F.col("old"), 0).when(~F.col("known"), n).when(smallest, at).otherwise(0)
    copies = F.when(retracted, at).when(F.col("old") | ~F.col("known"), 0).when(smallest, n - at).otherwise(n)
    found = rows.select("key", *KIND, "first", "at_first", holds.alias("holds"), plain.cast("long").alias("plain"), copies.cast("long").alias("copies"))
    return found.where("holds OR plain <> 0 OR copies <> 0")


def counted(stream: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n) of all files of a stream of documents.

    ``labels`` has the id's column, quality and toxic."""
    spark = stream.sparkSession
    of_doc = written(labels.groupBy(F.col(doc).alias("_doc")).agg(F.bool_or(F.col("quality") == 1).alias("_good"), F.bool_or(F.col("toxic") == 1).alias("_toxic")))
    folder = shared_folder(spark)
    log = f"key binary, part string, mask int, good boolean, toxic boolean, first {stream.schema[doc].dataType.simpleString()}, at_first long, holds boolean, plain long, copies long, batch int"
    changes = "part string, mask int, good boolean, toxic boolean, n long"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = session.read.schema(log).parquet(f"{folder}/log").where((F.col("batch") < number) & F.col("holds")) if number else None
        fates(combined(masked(batch, of_doc, doc, text, part)), before).write.mode("overwrite").parquet(f"{folder}/log/batch={number}")
        told = session.read.schema(log).parquet(f"{folder}/log").where(F.col("batch") == number).groupBy(*KIND).agg(F.sum("plain").alias("plain"), F.sum("copies").alias("copies"))
        each = F.inline(F.array(F.struct(F.col("mask"), F.col("plain").alias("n")), F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), F.col("copies").alias("n"))))
        told.select("part", "good", "toxic", each).where("n <> 0").coalesce(1).write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    query = stream.writeStream.option("checkpointLocation", f"{folder}/progress").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.lastProgress is None:  # no file, no batch
        return spark.createDataFrame([], changes)
    return spark.read.schema(changes).parquet(f"{folder}/changes").groupBy(*KIND).agg(F.sum("n").alias("n")).where("n <> 0")


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, the bit of the step's filter, the bits of the filters before it) of every order."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    return [("".join(p), i + 1, bit[f], sum(bit[g] for g in p[:i])) for p in permutations(FILTERS) for i, f in enumerate(p)]


def interactions(counts: DataFrame) -> DataFrame:
    """A row a part, order and step, out of the rows of ``counted``.

    A filter's Shapley sum is over all orders: a row that fails k filters is removed by each of
    them in one k-th of the orders."""
    every = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("own"), F.lit(p).alias("before")) for o, s, b, p in orders()])
    rows = counts.select("part", "mask", "good", "toxic", "n", F.explode(every).alias("at")).select("*", "at.*")
    mask, own, before, n = F.col("mask"), F.col("own"), F.col("before"), F.col("n")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    share = F.lit(math.factorial(len(FILTERS))) / F.bit_count("mask")
    total = lambda condition, what=n: F.sum(F.when(condition, what).otherwise(0)).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"), total(mask == own).alias("unique_fails"),
        total(fails & ~gone & F.col("good")).alias("good_lost"), total(fails & ~gone & F.col("toxic")).alias("toxic_lost"), total(fails, n * share.cast("long")).alias("shapley"),
    )


def files_of(spark: SparkSession, path: str, batches: int = BATCHES) -> DataFrame:
    """The files of a table, a folder or one file, as a stream of about so many micro-batches."""
    docs = spark.read.parquet(path)
    files = max(1, math.ceil(len(docs.inputFiles()) / batches))
    either = f"{path[:-1]}[{path[-1]}]"  # a stream takes one file only by a pattern
    return spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files).parquet(either)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(counted(files_of(spark, f"{sf_dir}/documents.parquet"), table(spark, sf_dir, "labels")))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
OP11_SQL = rf"""
WITH good AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, {_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS smallest FROM texts),
masks AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > smallest THEN 16 ELSE 0 END AS mask FROM words),
counts AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM masks LEFT JOIN good USING (doc_id) GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(c, b)),
perms AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM f a, f b, f c, f d, f e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before FROM perms, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
each AS (SELECT part, filter_order, step, own,
  sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM each
"""

QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE_SQL = {"op11_filter_audit": OP11_SQL}
