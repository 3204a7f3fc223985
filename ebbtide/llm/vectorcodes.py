"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

A component x becomes floor(256 x); a vector is cut into equal consecutive parts, and each part
position has a codebook of at most 256 entries, begun as the parts of the vectors of smallest id
and moved by rounds of assigning and averaging, all in whole numbers, so that every run and
every partitioning give the same books.

Orchard's search keeps, for every entry, the other entries in order of their distance to it.  From a
current entry it walks that list: a closer entry found becomes the current one and its list is
walked from the start; entries met before are marked and not measured again; it stops where the
list's next entry is farther from the current entry than twice the distance to the point, as no
later one can be closer (nor as close).  All points of a batch walk in step.

Tasks hold a batch of vectors and the books (parts x entries x width whole numbers, their number
fixed); a round sends one row a (part, entry) and task, and the driver gets one row a (part, entry).

- Rows are left out if their vector is null, empty, holds null or non-finite components, has a length
  that the number of parts does not divide, or another length than the usable vector of smallest id.
- Ties go to the lower index; equal ids come in order of their components; null ids come last.
- Fewer vectors than entries make a book of that many; without any there are no books.
- Components are at most ``MOST`` in size, so that distances are exact; larger ones are an error.
- Further columns, of whatever names, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import fresh, if_small, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MOST = 2.0**20
#: Vectors that walk in step.
IN_STEP = 4096


@dataclass(frozen=True)
class Book:
    """The entries of a part position, and for each the others' indexes and squared distances, nearest first."""

    entries: np.ndarray
    near: np.ndarray
    gaps: np.ndarray

    @staticmethod
    def of(entries: np.ndarray) -> Book:
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        own = np.arange(len(entries))
        gaps[own, own] = -1  # an entry comes first in its own list, and is then cut
        near = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        return Book(entries, near, np.take_along_axis(gaps, near, axis=1))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of every point, and its squared distance."""
        n, most = len(points), self.near.shape[1]
        current, step = np.zeros(n, np.int64), np.zeros(n, np.int64)
        best = ((points - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, len(self.entries)), bool)
        seen[:, 0] = True
        walking = np.arange(n) if most else np.arange(0)
        while len(walking):
            at, place = current[walking], step[walking]
            on = self.gaps[at, place] <= 4 * best[walking]
            walking, at, place = walking[on], at[on], place[on]
            step[walking] += 1
            other = self.near[at, place]
            new = ~seen[walking, other]
            who, other = walking[new], other[new]
            seen[who, other] = True
            far = ((points[who] - self.entries[other]) ** 2).sum(axis=1)
            better = (far < best[who]) | ((far == best[who]) & (other < current[who]))
            who, other = who[better], other[better]
            current[who], best[who], step[who] = other, far[better], 0
            walking = walking[step[walking] < most]
        return current, best


def _usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite, F.lit(False))


def _scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.when(F.abs(x.cast("double")) <= MOST, F.floor(x.cast("double") * SCALE)).otherwise(F.raise_error(F.lit(f"a component is larger than {MOST:.0f}"))))


def whole_numbers(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", parts: int = PARTS) -> tuple[DataFrame, str, int]:
    """The usable rows with their scaled vector, the name of its column, and its length (0: no rows)."""
    name = fresh(df, "_whole")
    usable = df.where(_usable(F.col(vector), parts))
    first = usable.select(ident, F.size(vector).alias("n")).orderBy(F.col(ident).asc_nulls_last(), "n").head()
    size = first.n if first else 0
    return usable.where(F.size(vector) == size).withColumn(name, _scaled(F.col(vector))), name, size


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, IN_STEP):
            yield batch.slice(start, IN_STEP)


def trained(rows: DataFrame, whole: str, size: int, ident: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Book]:
    """A codebook a part position, out of the rows of ``whole_numbers``."""
    if not size:
        return []
    width = size // parts
    start = rows.select(ident, whole).orderBy(F.col(ident).asc_nulls_last(), whole).limit(entries).collect()
    books = [Book.of(np.array([r[1][p * width : (p + 1) * width] for r in start], np.int64)) for p in range(parts)]
    for _ in range(rounds):
        sums = _sums(rows.select(whole), books, width)
        moved = [book.entries.copy() for book in books]
        for r in sums.collect():  # one row an entry at most
            moved[r.part][r.entry] = [r[f"sum{i}"] // r.n for i in range(width)]
        books = [Book.of(m) for m in moved]
    return books


def _sums(vectors: DataFrame, books: list[Book], width: int) -> DataFrame:
    """(part, entry, n, sum0 ...) over the points that each entry is nearest to."""
    columns = [f"sum{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(books), len(books[0].entries)), np.int64)
        total = np.zeros((*n.shape, width), np.int64)
        for batch in _slices(batches):
            points = _matrix(batch.column(0), len(books) * width)
            for p, book in enumerate(books):
                part = points[:, p * width : (p + 1) * width]
                code, _ = book.nearest(part)
                np.add.at(n[p], code, 1)
                np.add.at(total[p], code, part)
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part.astype(np.int32), entry.astype(np.int32), n[part, entry], *total[part, entry].T)], ["part", "entry", "n", *columns])

    partial = vectors.mapInArrow(run, ", ".join(["part int", "entry int", "n long", *[f"{c} long" for c in columns]]))
    return partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *columns)])


def encoded(rows: DataFrame, whole: str, books: list[Book], code: str = "code", error: str = "error") -> DataFrame:
    """The rows, their scaled vector replaced by the code (two hex digits a part) and the squared error."""
    kept = [c for c in rows.columns if c != whole]
    schema = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add(code, "string").add(error, "long")
    width = books[0].entries.shape[1] if books else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            points = _matrix(batch.column(batch.num_columns - 1), len(books) * width)
            codes, errors = np.zeros((len(points), len(books)), np.uint8), np.zeros(len(points), np.int64)
            for p, book in enumerate(books):
                codes[:, p], far = book.nearest(points[:, p * width : (p + 1) * width])
                errors += far
            digits = codes.tobytes().hex()
            size = 2 * len(books)
            texts = pa.array([digits[i * size : (i + 1) * size] for i in range(len(points))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts, pa.array(errors)], [*kept, code, error])

    return rows.select(*[F.col(f"`{c}`") for c in kept], F.col(whole)).mapInArrow(run, schema)


def books_sha256(books: list[Book]) -> str:
    numbers = ",".join(str(x) for book in books for entry in book.entries for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compressed(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[Book]]:
    """The usable rows with ``code`` and ``error``, and the codebooks."""
    rows, whole, size = whole_numbers(df, ident, vector, parts)
    books = trained(rows, whole, size, ident, parts, entries, rounds)
    return encoded(rows, whole, books, fresh(df, "code"), fresh(df, "error")), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compressed(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    codes = written(codes.drop("embedding"))
    of_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(if_small(of_label), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    """The books after another round."""
    return f"""
near{i} AS (SELECT p.vec_id, p.part, p.x, arg_min(b.entry, list_reduce(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b) * 1000 + b.entry) AS entry
  FROM parts p JOIN book{i} b ON p.part = b.part GROUP BY p.vec_id, p.part, p.x),
mean{i} AS (SELECT part, entry, list(m ORDER BY place) AS x FROM (
  SELECT part, entry, place, CAST(floor(sum(v) / count(*)) AS BIGINT) AS m FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM near{i}) GROUP BY part, entry, place) GROUP BY part, entry),
book{i + 1} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m ON b.part = m.part AND b.entry = m.entry),"""


OP12_SQL = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x FROM kept, (SELECT unnest(range(16)) AS part)),
book0 AS (SELECT p.part, f.entry, p.x FROM parts p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64) f ON p.vec_id = f.vec_id),
{_round_sql(0)}{_round_sql(1)}
far AS (SELECT p.vec_id, p.label, p.part, b.entry, list_reduce(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b) AS d
  FROM parts p JOIN book2 b ON p.part = b.part),
last AS (SELECT vec_id, label, part, min(d) AS d, arg_min(entry, d * 1000 + entry) AS entry FROM far GROUP BY vec_id, label, part),
codes AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, digest
"""

QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLE_SQL = {"op12_vector_codes": OP12_SQL}
