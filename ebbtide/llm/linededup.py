"""Line dedup: lines found in many documents stay in one of them.

A line's key is the line without white space at its ends, A to Z in lower case.  Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines
except in the document of largest id that holds them.

The texts give one narrow row a long line: 128 bits of hash, document, position.  These rows are
dealt by range of (hash, document descending, position) and sorted so within a partition, so a
task streams a line's documents from the largest id on: rows after the first document are
dropped once ``min_docs`` documents have been seen, and only rows of fewer documents are held.  As
ranges are of the whole order and not of the hash alone, a line that a third of all documents
share is cut into many ranges.  What a task cannot decide, as its first line may have begun in
the range before and its last may go on in the next, it gives as pending rows; with them go one
or two rows a partition that count the documents of its outer lines, and joining these decides
the rest.  The result is one compressed bitmap a document, not its text.

- Null texts are empty: one empty line.  Short keys are never dropped and never shuffled.
- Rows of one id count as one document; each has the bitmap of its own text.
- A null id is one more document, smaller than all others.
- Ties: all lines of the largest document stay, however often it repeats a line.
- Empty tables give empty tables; further columns, of whatever names, stay as they are.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.common import fresh, if_small, table, text_of, with_small_batches, written

MIN_CHARS, MIN_DOCS = 40, 5
#: White space that is cut from the ends of a line.
SPACE = " \t\n\x0b\x0c\r"
DROPPED, PENDING, EDGE = 0, 1, 2


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _lower(line: Column) -> Column:
    """A to Z in lower case; where all is ASCII, ``lower`` does the same and is faster."""
    slow = F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(slow)


def long_lines(df: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, of, position) of every line whose key is long enough; ``of`` tells texts of one id apart."""
    texts = df.select(F.col(doc).alias("doc"), text_of(text).alias("text"))
    lines = texts.select("doc", F.xxhash64("text").alias("of"), F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    lines = lines.where(F.char_length("line") >= min_chars).select("doc", "of", "position", F.btrim("line", F.lit(SPACE)).alias("line"))
    key = _lower(F.col("line"))
    hashed = lines.where(F.char_length("line") >= min_chars).select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc", "of", "position")
    return hashed


class _Runs:
    """The stream of a partition's rows, batch by batch; holds rows of the open line only, and
    those only until ``least`` documents have been seen."""

    def __init__(self, part: int, least: int, schema: pa.Schema) -> None:
        self.part, self.least, self.schema = part, least, schema
        self.key: tuple[int, int] | None = None
        self.docs, self.first, self.last, self.opened, self.held = 0, None, None, True, []

    def _rows(self, kind: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        own = {"kind": pa.array(np.full(n, kind, np.int8)), "part": pa.nulls(n, pa.int32()), "last": pa.nulls(n, self.schema.field("last").type), "n_docs": pa.nulls(n, pa.int64())}
        return pa.RecordBatch.from_arrays([own[f.name] if f.name in own else batch.column(f.name).cast(f.type) for f in self.schema], schema=self.schema)

    def edge(self) -> pa.RecordBatch:
        """How many documents the open line has here, and the first and last of them."""
        own = {"kind": EDGE, "part": self.part, "h1": self.key[0], "h2": self.key[1], "doc": self.first, "last": self.last, "n_docs": self.docs}
        return pa.RecordBatch.from_arrays([pa.array([own.get(f.name)], f.type) for f in self.schema], schema=self.schema)

    def batch(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        docs = batch.column("doc")
        codes = docs.dictionary_encode(null_encoding="encode").indices.to_numpy()
        goes_on = self.key == (h1[0], h2[0])
        new_key, new_doc = np.ones(n, bool), np.ones(n, bool)
        new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc[1:] = new_key[1:] | (codes[1:] != codes[:-1])
        new_doc[0] = not goes_on or docs[0].as_py() != self.last
        starts = np.flatnonzero(new_key)
        line = np.cumsum(new_key) - 1
        seen = np.cumsum(new_doc)
        before = seen[starts] - new_doc[starts]
        if goes_on:
            before[0] -= self.docs
        place = seen - before[line]  # of a row's document among those of its line, from 1
        ends = np.append(starts[1:], n) - 1
        total = place[ends]
        undecided = np.zeros(len(starts), bool)
        undecided[0] = self.opened if goes_on else self.key is None
        if self.key is not None and not goes_on:
            yield from self.closed()
        if goes_on and self.held and total[0] >= self.least:
            for rows in self.held:
                yield self._rows(DROPPED, rows)
            self.held = []
        late = (place > 1) & ~undecided[line]
        gone = late & (total >= self.least)[line]
        for kind, chosen in ((DROPPED, gone), (PENDING, undecided[line])):
            if chosen.any():
                yield self._rows(kind, batch.filter(pa.array(chosen)))
        if len(starts) > 1:  # the first line ends here
            if undecided[0]:
                at = int(ends[0])
                self.key, self.docs, self.last = (int(h1[0]), int(h2[0])), int(total[0]), docs[at].as_py()
                self.first = self.first if goes_on else docs[0].as_py()
                yield self.edge()
            self.held = []
        start = int(starts[-1])
        if len(starts) > 1 or not goes_on:
            self.first, self.held = docs[start].as_py(), []
        self.opened = bool(undecided[-1])
        self.key, self.docs, self.last = (int(h1[-1]), int(h2[-1])), int(total[-1]), docs[n - 1].as_py()
        waits = late & (line == len(starts) - 1) & (total[-1] < self.least)
        if waits.any():
            self.held.append(batch.filter(pa.array(waits)))

    def closed(self) -> Iterator[pa.RecordBatch]:
        """The open line ends within the partition; only one that opened the partition has news."""
        if self.opened:
            yield self.edge()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.key is not None:
            yield self.edge()
            for rows in self.held:
                yield self._rows(PENDING, rows)


def _spark_schema(doc: T.DataType) -> T.StructType:
    whole = T.LongType()
    fields = {"kind": T.ByteType(), "part": T.IntegerType(), "h1": whole, "h2": whole, "doc": doc, "last": doc, "of": whole, "position": T.IntegerType(), "n_docs": whole}
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, of, position) of the lines to drop, out of the rows of ``long_lines``."""
    kind = lines.schema["doc"].dataType
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last(), F.col("of"), F.col("position")]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = None
        for batch in batches:
            if batch.num_rows:
                of = {"kind": pa.int8(), "part": pa.int32(), "last": batch.schema.field("doc").type, "n_docs": pa.int64()}
                names = ("kind", "part", "h1", "h2", "doc", "last", "of", "position", "n_docs")
                runs = runs or _Runs(TaskContext.get().partitionId(), min_docs, pa.schema([(x, of[x] if x in of else batch.schema.field(x).type) for x in names]))
                yield from runs.batch(batch)
        if runs is not None:
            yield from runs.end()

    found = written(dealt.mapInArrow(run, _spark_schema(kind)))
    in_order = Window.partitionBy("h1", "h2").orderBy("part")  # at most one row a partition
    edges = found.where(F.col("kind") == EDGE).withColumn("_again", F.lag("last").over(in_order).eqNullSafe(F.col("doc")) & (F.row_number().over(in_order) > 1))
    outer = edges.groupBy("h1", "h2").agg((F.sum("n_docs") - F.count_if("_again")).alias("_docs"), F.min_by(F.struct("doc"), "part").alias("_largest"))
    outer = if_small(outer.where(F.col("_docs") >= min_docs))  # two rows a partition at most
    pending = found.where(F.col("kind") == PENDING).select("h1", "h2", "doc", "of", "position").join(outer, ["h1", "h2"])
    late = pending.where(~F.col("doc").eqNullSafe(F.col("_largest.doc")))
    return found.where(F.col("kind") == DROPPED).select("doc", "of", "position").unionByName(late.select("doc", "of", "position"))


def packed(dropped: np.ndarray) -> bytes:
    """Bit i is 1 if line i stays; lines beyond the last bit stay."""
    bits = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    bits[dropped] = False
    return zlib.compress(np.packbits(bits).tobytes())


def unpacked(bitmap: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)


def keep_bitmaps(df: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, of, n_dropped, bitmap) of the documents that lose lines; all others keep every line."""

    @F.pandas_udf("binary")
    def bitmap(positions: pd.Series) -> pd.Series:
        return positions.map(lambda p: packed(np.asarray(p)))

    gone = dropped_lines(long_lines(df, doc, text, min_chars), min_docs)
    of_doc = gone.groupBy("doc", "of").agg(F.collect_set("position").alias("_gone"))  # within the lines of one text
    return of_doc.select("doc", "of", F.size("_gone").cast("long").alias("n_dropped"), bitmap("_gone").alias("bitmap"))


def kept_text(text: str, bitmap: bytes) -> str:
    lines, stays = text.split("\n"), unpacked(bitmap)
    return "\n".join(line for i, line in enumerate(lines) if i >= len(stays) or stays[i])


def deduplicated(
    df: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, n_lines: str = "n_lines", n_dropped: str = "n_dropped", kept: str = "kept"
) -> DataFrame:
    """The table with the number of lines, of dropped ones, and the text that is left."""

    @F.pandas_udf("string")
    def applied(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else kept_text(t, b) for t, b in zip(texts, bitmaps, strict=True)], dtype=object)

    with_small_batches(df)
    names = {x: fresh(df, f"_{x}") for x in ("doc", "of", "bitmap", "n_dropped")}
    maps = keep_bitmaps(df, doc, text, min_chars, min_docs).withColumnsRenamed(names)
    joined = df.join(maps, F.col(doc).eqNullSafe(F.col(names["doc"])) & (F.xxhash64(text_of(text)) == F.col(names["of"])), "left")
    bitmap = F.col(names["bitmap"])
    left = F.coalesce(applied(F.when(bitmap.isNotNull(), text_of(text)), bitmap), text_of(text))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.size(lines_of(text_of(text))).cast("long").alias(n_lines), F.coalesce(F.col(names["n_dropped"]), F.lit(0)).alias(n_dropped), left.alias(kept))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = f"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM texts),
keyed AS (SELECT doc_id, place, line,
  translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM each),
often AS (SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT keyed.*, often.key IS NOT NULL AND keyed.doc_id <> often.largest AS gone FROM keyed LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op13_line_dedup": op13_line_dedup}
ORACLE_SQL = {"op13_line_dedup": OP13_SQL}
