"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens, which are exploded with their positions.  Before anything
is shuffled, the texts of some megabytes form a block, and the distinct words of a block that
belong to one part of all words (by hash) go into one compressed row: (block, part, words).
So the most frequent word is sent once a block, not once an occurrence.  A shuffle by part
brings all blocks' uses of a word together; each distinct word is encoded once and its ids
join all of them.  The ids go back by block, where they meet the block's sequence of word
numbers, and every text is reassembled by position.  Decoding joins ids with the token-byte
table of the vocabulary, which is broadcast: it has as many rows as the vocabulary, whatever
the corpus.

Positions cross one shuffle only, straight to their block: texts are split twice, once for
the words and once for the positions, as that costs less than writing or moving positions
again.  So the rows of ``df`` must come in the same order both times, as they do from a
table or files, but not after a shuffle (``written`` makes a table).  Each block checks the
number and a digest of its words, and a block that differs is an error, never a wrong result.

Blocks hold whole texts, one at least; a text longer than a block is a block of its own, so a
task holds one block or one text.  Vocabulary and pattern are parameters.

Edge cases: null is the empty text, with no ids; repeated rows and rows of equal or null key
are encoded each; an empty table stays empty; all other columns pass through unchanged
(``ids`` and ``n_tokens`` replace columns of those names), ``block`` and ``part`` among them.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import table, with_small_batches

BLOCK_CHARS = 2_000_000
#: Parts of all words for each shuffle partition; a task keeps the words of one part at a time.
PARTS_A_PARTITION = 4
#: Rows of a block: its other columns and positions (part META), or the words of a part, later their ids.
SHUFFLE_SCHEMA = "block long, part int, data binary"
_SHUFFLE = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])
LEVEL = 3  # of compression
META = -1
SLICE = 256  # texts made Python strings at a time


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, the first of equals, until none is in the ranks."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 256:
        return _encode_long(word, ranks)
    get = ranks.get
    none = 1 << 60
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap over a linked list, for words of thousands of bytes."""
    from heapq import heapify, heappop, heappush

    n = len(word)
    end = list(range(1, n + 1))  # where the part that begins here ends; 0: merged into another
    before = list(range(-1, n - 1))
    rank = lambda a, b, c: ranks.get(word[a:c]) if b < n else None
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(i, i + 1, i + 2)) is not None]
    heapify(heap)
    while heap:
        _, a, b, c = heappop(heap)
        if end[a] != b or b >= n or end[b] != c:
            continue
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
            if (r := rank(a, c, end[c])) is not None:
                heappush(heap, (r, a, c, end[c]))
        p = before[a]
        if p >= 0 and (r := rank(p, a, c)) is not None:
            heappush(heap, (r, p, a, c))
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a : end[a]]])
        a = end[a]
    return out


def _pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2 ** 35 as little-endian groups of seven bits; bytes, and bytes per number."""
    length = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        length += values >= (1 << bits)
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = length > k
        if not has.any():
            break
        out[ends[has] - length[has] + k] = ((values[has] >> (7 * k)) & 127) | ((length[has] > k + 1) << 7)
    return out, length


def _unpack(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of _pack, and the index of each number's last byte."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = np.zeros(len(last), np.int64)
    for k in range(5):
        has = first + k <= last
        if not has.any():
            break
        out[has] |= (data[first[has] + k].astype(np.int64) & 127) << (7 * k)
    return out, last


class _Block:
    """Texts split so far: the distinct pre-tokens with numbers in order of first use, the
    numbers by position, and the count of pre-tokens of each text."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.numbers: list[np.ndarray] = []
        self.counts: list[int] = []
        self.rest: list[pa.RecordBatch] = []
        self.chars = 0

    def add(self, text: str, find) -> None:  # noqa: ANN001
        words = self.words
        found = find(text)
        self.counts.append(len(found))
        self.numbers.append(np.array([words.setdefault(w, len(words)) for w in found], np.int32))
        self.chars += len(text)

    def keys(self) -> list[bytes]:
        return [w.encode("utf-8", "surrogatepass") for w in self.words]


def _blocks(batches: Iterator[pa.RecordBatch], kept: list[str], pattern: str, block_chars: int) -> Iterator[tuple[int, _Block]]:
    """The blocks of a partition, each with its number; where they end depends on the texts
    alone.  The last column of the batches is the partition's own number (a task's would count
    the partitions of a union)."""
    find = regex.compile(pattern).findall
    number, block = None, _Block()
    for batch in batches:
        if number is None and batch.num_rows:
            number = batch.column(batch.num_columns - 1)[0].as_py() << 32
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            at = 0
            for j, text in enumerate(part.column(batch.num_columns - 2).to_pylist()):
                block.add(text or "", find)
                if block.chars >= block_chars:
                    block.rest.append(part.slice(at, j + 1 - at).select(kept))
                    yield number, block
                    number, block, at = number + 1, _Block(), j + 1
            if at < part.num_rows:
                block.rest.append(part.slice(at).select(kept))
    if block.counts:
        yield number, block


def _parts(keys: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(k) % parts for k in keys), np.int32, len(keys))


def _joined(numbers: np.ndarray, data: bytes) -> bytes:
    """Numbers and bytes in one compressed value."""
    packed = _pack(numbers)[0].tobytes()
    return zstandard.compress(len(packed).to_bytes(4, "little") + packed + data, LEVEL)


def _split(value: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(value)
    end = 4 + int.from_bytes(raw[:4], "little")
    return _unpack(np.frombuffer(raw[4:end], np.uint8))[0], raw[end:]


def _word_rows(number: int, block: _Block, parts: int) -> pa.RecordBatch:
    """A row for each part of a block: its words, in order of first use."""
    keys = block.keys()
    part = _parts(keys, parts)
    order = np.argsort(part, kind="stable")
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))[order]
    cuts = [*np.flatnonzero(np.diff(part[order], prepend=-1)).tolist(), len(keys)]
    made = [_joined(sizes[a:b], b"".join([keys[i] for i in order[a:b].tolist()])) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array([number] * len(made), pa.int64()), pa.array(part[order][cuts[:-1]], pa.int32()), pa.array(made, pa.binary())], schema=_SHUFFLE)


def _position_row(number: int, block: _Block, parts: int) -> pa.RecordBatch:
    """One row for a block: its other columns, counts, the part of each word, and the numbers of words by position."""
    keys = block.keys()
    sink = pa.BufferOutputStream()
    rest = pa.Table.from_batches(block.rest)
    with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(rest.combine_chunks())
    digest = zlib.crc32(b"\0".join(keys)).to_bytes(4, "little")
    numbers = np.concatenate(block.numbers).astype(np.int64)
    pieces = [sink.getvalue().to_pybytes(), _joined(np.array(block.counts, np.int64), digest), _joined(_parts(keys, parts).astype(np.int64), b""), _joined(numbers, b"")]
    data = b"".join(len(x).to_bytes(8, "little") + x for x in pieces)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([META], pa.int32()), pa.array([data], pa.binary())], schema=_SHUFFLE)


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        yield data[at + 8 : at + 8 + n]
        at += 8 + n


def _reassemble(rows: list[pa.RecordBatch], ids_name: str, count_name: str, width: str) -> pa.RecordBatch:
    """The texts of one block, with their ids; the row of positions comes first."""
    lengths, flat, found, which = [], [], [], None
    for batch in rows:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data"), strict=True):
            if part == META:
                rest, counts, parts, numbers = _pieces(data.as_py())
                with pa.ipc.open_stream(rest) as stream:
                    table_ = pa.Table.from_batches(list(stream), schema=stream.schema).combine_chunks()
                counts, digest = _split(counts)
                parts, which = _split(parts)[0], _split(numbers)[0]
                continue
            n, ids = _split(data.as_py())
            found += [part] * len(n)
            lengths.append(n)
            flat.append(np.frombuffer(ids[:-4], width))
            if which is None or ids[-4:] != digest:
                raise ValueError("the rows came in another order the second time: give encode a table")
    if which is None:
        raise ValueError("words without their positions: give encode a table")
    lengths = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
    flat = np.concatenate(flat) if flat else np.zeros(0, width)
    order = np.argsort(parts, kind="stable")  # the words' numbers as their parts have come
    if found != parts[order].tolist():
        raise ValueError("some words of a block have not come back")
    ends = np.empty(len(lengths), np.int64)
    ends[order] = np.cumsum(lengths)
    n = np.empty(len(lengths), np.int64)
    n[order] = lengths
    each = n[which]
    upto = np.cumsum(each)
    tokens = flat[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(ends[which] - upto, each)].astype("<u4")
    edges = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])]
    made = [tokens[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
    columns = [c.combine_chunks() for c in table_.columns] if table_.num_columns else []
    return pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary()), pa.array(np.diff(edges), pa.int64())], names=[*table_.schema.names, ids_name, count_name])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows sorted by block, as lists of batches of one block each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[0].column("block")[0].as_py() != blocks[a]:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, column: str = "text", ids: str = "ids", count: str = "n_tokens", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Replace a text column by its ids (little-endian unsigned 32-bit integers) and their number."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    kept = [c for c in df.columns if c not in (column, ids, count)]
    slim = with_small_batches(df).select(*kept, column)
    schema = slim.select(*kept).schema.add(ids, "binary").add(count, "long")

    parts = PARTS_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, [], pattern, block_chars):
            digest = zlib.crc32(b"\0".join(block.keys())).to_bytes(4, "little")
            rows = _word_rows(number, block, parts)
            yield rows.set_column(2, "data", pa.array([digest + x.as_py() for x in rows.column("data")], pa.binary()))

    def positions_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, kept, pattern, block_chars):
            yield _position_row(number, block, parts)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, part, known = shared.value, None, {}
        step = int(width[-1])
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                rows = batch.slice(i, SLICE)
                out = []
                for p, value in zip(rows.column("part").to_pylist(), rows.column("data"), strict=True):
                    if p != part:  # sorted by part: each word is encoded when it first comes
                        part, known = p, {}
                    raw = value.as_py()
                    sizes, blob = _split(raw[4:])
                    made, at = [], 0
                    for size in sizes.tolist():
                        word = blob[at : at + size]
                        at += size
                        own = known.get(word)
                        if own is None:
                            own = known[word] = np.array(encode_word(word, table_), width).tobytes()
                        made.append(own)
                    out.append(_joined(np.fromiter((len(x) // step for x in made), np.int64, len(made)), b"".join(made) + raw[:4]))
                yield pa.RecordBatch.from_arrays([rows.column("block"), rows.column("part"), pa.array(out, pa.binary())], schema=_SHUFFLE)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            yield _reassemble(rows, ids, count, width)

    own = "_partition" + "_" * max(map(len, df.columns))
    slim = slim.withColumn(own, F.spark_partition_id())
    words = slim.select(column, own).mapInArrow(words_of, SHUFFLE_SCHEMA).repartition("part").sortWithinPartitions("part")
    both = words.mapInArrow(encode_words, SHUFFLE_SCHEMA).unionByName(slim.mapInArrow(positions_of, SHUFFLE_SCHEMA))
    return both.repartition("block").sortWithinPartitions("block", "part").mapInArrow(reassemble, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that ids stand for; null ids give null."""
    size = max(ranks.values(), default=-1) + 1
    tokens: list[bytes | None] = [None] * size
    for token, i in ranks.items():
        tokens[i] = token
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    kept = [c for c in df.columns if c != decoded]
    schema = df.select(*kept).schema.add(decoded, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.__getitem__
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                made = [None if v is None else b"".join(map(get, np.frombuffer(v, "<u4").tolist())) for v in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(made, pa.binary())], names=[*kept, decoded])

    return df.select(*kept).mapInArrow(run, schema)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> dict[bytes, int]:
    return load_ranks(public_tokenizers.path(name))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
