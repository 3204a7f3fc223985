"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a text's 5-word
shingles (lower-cased A-Z; fewer words: the whole sequence as one shingle).  Sketches merge:
the k smallest of a union are the k smallest of the two sketches together.  From two
sketches come estimates of resemblance, containment and the number of distinct shingles;
below k shingles all three are exact.  Everything is DataFrame expressions.

Edge cases: null or blank texts have the empty sketch, two empty sketches resemble each
other fully (1.0), an empty and a non-empty one not at all; equal texts have equal sketches;
``with_next`` orders rows of equal ids by text (of an id of very many rows by a hash of the
text first) and rows without id last, the only row follows itself, and an empty table stays
empty; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import GAP, fresh, table, text_of, written

K = 128
WORDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH_SPAN = 2.0**64
#: Rows per bucket when rows are lined up by id, and parts that the ids are cut in first.
BUCKET, QUANTILES = 256, 128


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """The distinct shingle hashes of a text, in no order."""
    split = F.filter(F.split(F.translate(text, UPPER, LOWER), GAP), lambda w: w != "")
    hashes = F.transform(split, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (words - 1))
        return (
            F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(F.size(h) < words, F.array(F.xxhash64(h)))
            .otherwise(F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, words))))
        )

    # transform over a one-element array binds the word hashes once
    return F.array_distinct(F.element_at(F.transform(F.array(hashes), shingles), 1))


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    return F.slice(F.sort_array(shingle_hashes(text, words)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the merged sketch that lies in both."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th hash as a share of all."""
    share = (F.element_at(a, k).cast("double") + F.lit(HASH_SPAN / 2) + 1.0) / HASH_SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b too."""
    union = distinct_shingles(merged(a, b, k), k)
    both = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def merge_sketches(df: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch a group from the sketches of its parts.

    Hashes are made distinct before they meet, and a group keeps k of them, so a group's
    array is bounded whatever the number of its parts."""
    hashes = df.select(*by, F.explode(column).alias("_h")).distinct()
    window = Window.partitionBy(*by).orderBy("_h")
    smallest = hashes.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)
    some = smallest.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(column))
    none = df.select(*by).distinct().join(some, by, "left")
    return none.withColumn(column, F.coalesce(column, F.array().cast("array<bigint>")))


def encoded(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "next_text") -> DataFrame:
    """Add the text of the row that follows by key; after the last comes the first.

    Rows meet in buckets of neighbouring ids, so texts are shuffled once and no task orders
    the table.  Only the last row of a bucket looks further: for the first row of the next
    bucket in use, found from a table with one row a bucket.  Buckets follow the quantiles of
    the ids, so ids may be dense, sparse or hashed; ids that many rows have, and rows without
    an id, are dealt out by their texts."""
    b, r, more, after, head = (fresh(docs, n) for n in ("_b", "_row", "_more", "_next", "_head"))
    bucket = bucket_of(docs, key, text)
    chain = _next_bucket(docs.select(bucket.alias("b")).distinct())
    order = Window.partitionBy(b).orderBy(F.col(key).asc_nulls_last(), F.col(text))
    lined = docs.withColumn(b, bucket).withColumn(r, F.row_number().over(order)).withColumn(out, F.lead(text).over(order))
    lined = lined.withColumn(more, F.lead(F.lit(True), 1, False).over(order))
    heads = lined.where(F.col(r) == 1).select(F.col(b).alias(after), F.col(text).alias(head))
    inner = lined.where(more)
    last = lined.where(~F.col(more)).drop(out).join(chain.select(F.col("b").alias(b), F.col("after").alias(after)), b).join(heads, after).withColumnRenamed(head, out)
    columns = [c for c in docs.columns if c != out]
    return inner.select(*columns, out).unionByName(last.select(*columns, out))


def bucket_of(docs: DataFrame, key: str, text: str) -> Column:
    """(part, width, share): the bucket of a row, in the order of the ids; some BUCKET rows each.

    The ids are cut at QUANTILES quantiles, and each part in even widths.  A cut that comes
    more than once is an id of many rows; such rows, and those without an id, are dealt out by a
    hash of their texts.  What reaches the driver are the cuts and two counts."""
    ids = F.col(key).cast("long")
    cuts = F.percentile_approx(ids, [i / QUANTILES for i in range(QUANTILES + 1)], 100 * QUANTILES)
    row = docs.agg(cuts.alias("cuts"), F.count(ids).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    each = max(1, row["n"] // (QUANTILES * BUCKET))  # buckets a part
    found = sorted(set(row["cuts"] or []))
    often = {c: (row["cuts"] or []).count(c) for c in found}
    zero = F.lit(0).cast("long")
    share = lambda n: F.pmod(F.xxhash64(text), F.lit(max(1, n)))
    bucket = F.struct(F.lit(len(found)).alias("part"), zero.alias("width"), share((row["rows"] - row["n"]) // BUCKET).alias("share"))
    if found:
        bounds = F.array(*[F.lit(c).cast("long") for c in found])
        wide = F.array(*[F.lit(max(1, -(-(b - a) // each))).cast("long") for a, b in zip(found, [*found[1:], found[-1] + 1], strict=True)])
        part = F.greatest(F.size(F.filter(bounds, lambda c: c <= ids)) - 1, F.lit(0))
        of_part = lambda p: F.struct(p.alias("part"), F.floor((ids - F.element_at(bounds, p + 1)) / F.element_at(wide, p + 1)).cast("long").alias("width"), zero.alias("share"))
        for c, n in often.items():
            if n > 1:
                bucket = F.when(ids == c, F.struct(F.lit(found.index(c)).alias("part"), (zero - 1).alias("width"), share(n * each).alias("share"))).otherwise(bucket)
        plain = ids.isNotNull() & ~ids.isin([c for c, n in often.items() if n > 1])
        # transform over a one-element array binds the part once
        bucket = F.when(plain, F.element_at(F.transform(F.array(part), of_part), 1)).otherwise(bucket)
    return bucket


def _next_bucket(buckets: DataFrame) -> DataFrame:
    """(b, after) for each bucket in use; the last one's next is the first.  Buckets are lined up
    by ranges; only the first of each range meets those of the others."""
    ranges = written(buckets.repartitionByRange("b").withColumn("range", F.spark_partition_id()))
    near = ranges.withColumn("after", F.lead("b").over(Window.partitionBy("range").orderBy("b")))
    firsts = ranges.groupBy("range").agg(F.min("b").alias("first"))
    every = Window.orderBy("range")  # one row a range, of which there are as many as shuffle partitions
    around = firsts.withColumn("first_after", F.coalesce(F.lead("first").over(every), F.first("first").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    return near.join(F.broadcast(around), "range").select("b", F.coalesce("after", "first_after").alias("after"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as much of the next text's start."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def op4_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    both = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    made = both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"),
        sketch(F.col("edited")).alias("ed"),
        sketch(F.col("next_text")).alias("nx"),
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        encoded(F.col("own")).alias("fingerprint"),
        encoded(F.col("ed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("ed")).alias("near_edited"),
        resemblance(F.col("own"), F.col("nx")).alias("near_next"),
        distinct_shingles(F.col("own")).alias("est_shingles"),
        containment(F.col("own"), F.col("ed")).alias("contained_in_edited"),
    )


QUERIES = {"op4_bottom_k_sketch": op4_bottom_k_sketch}
ORACLE_SQL: dict[str, str] = {}
