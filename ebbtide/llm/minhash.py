"""MinHash near-duplicates by an inverted join on signature coordinates.

Documents with one set of 5-word shingles are one class, and a class has one signature of
``PERMUTATIONS`` minima.  Each class is posted under each pair of coordinate and value.
Postings that no other class shares are dropped, and so are classes with fewer than
``MATCHES`` postings left: they cannot reach the match threshold.  What remains is joined
twice.

A count of the shingles of those classes tells how many of a class's shingles any other has,
in all and in each of ``CELLS`` cells by hash.  The intersection of two classes is, cell by
cell, no larger than the smaller of those counts, which bounds the likeness of every pair
from above; classes and pairs whose bound is below the threshold go.

First come star rounds: in each list of more than one component, every class meets only the
list's hub (at first the class whose values most classes share, then one chosen by hash);
collisions are counted by pair, and each class's best partner is confirmed.  This joins large
groups of near copies with a row per class and coordinate, whatever their size.  Then come up
to ``NEAR_ROUNDS`` rounds in which each class that is still apart confirms the partner of
another component that it shares most coordinates with, so groups about the threshold grow
together with a pair per class and round.  Last, the prefix join over what is still apart: two classes of different components that share at least
``MATCHES`` coordinates share one in the first ``size - MATCHES + 1`` of their postings,
rarest first (prefix filter).  Lists of more than ``LIST`` classes are dealt out as pairs of
blocks, so no task holds a whole list.  Within a list, pairs beyond the bound or below the
match threshold are skipped, and each other pair leaves the first list that both are in and
is confirmed.
So every pair of classes that reaches the match threshold is either confirmed itself or lies
within one component already.

Confirming compares the full sets of shingles of both texts: 100 * intersection >= 75 *
union.  Two sets of likeness 0.75 agree in fewer than 28 of 64 coordinates with a probability
below 1e-7, so in practice no link is lost; tests compare with brute force.

After each star round the classes take the label of the smallest component they are linked
with.  In the end, components of the few links that are left between labels come from rounds
of taking the smallest label of the neighbours and of the label's own label; links, labels and
signatures stay in tables in the shared folder.

Edge cases: null, empty and blank texts have an empty set and are linked with nothing; texts
below 5 words have one shingle, the whole sequence; rows of equal id are one document; rows
without an id are never linked (component_id null, kept); an empty table stays empty; other
columns are untouched by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import fresh, if_small, table, text_of, with_small_batches, written

WORDS = 5
PERMUTATIONS = 64
MATCHES = 28
SIMILAR = 75  # per cent
STAR_ROUNDS = 3
NEAR_ROUNDS = 3
#: Rounds go on while this part of a round's pairs are alike; what is left is for the last join.
LINKED = 0.25
CELLS = 64
MOST = 32_767  # shingles that a cell counts
LIST = 1024
#: Rows of ids, or bytes of texts, that a broadcast may have; beyond that Spark shuffles both sides.
SMALL_IDS, SMALL_BYTES = 50_000, 4 << 20
SEED = 99

_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split takes just space, tab, LF, VT, FF and CR for gaps."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(WORDS)), strict=False))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, hashes: _WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = words_of(text)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h)
    if n < WORDS:
        return _mixed((h * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)) if n else h
    s = h[: n - WORDS + 1] * _PLACE[0]
    for j in range(1, WORDS):
        s += h[j : n - WORDS + 1 + j] * _PLACE[j]
    return np.unique(_mixed(s))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of every permutation over each (non-empty) set: an array of len(sets) rows."""
    out = np.empty((len(sets), PERMUTATIONS), np.int64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:end]])[:-1]])
        for j in range(PERMUTATIONS):
            out[at:end, j] = np.minimum.reduceat((x * _A[j] + _B[j]) >> np.uint64(32), starts)
        at = end
    return out


def signed(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_id, posts): the values by coordinate; empty for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingle_hashes(t, hashes) for t in part.column(column).to_pylist()]
                full = [s for s in sets if len(s)]
                posts = signatures(full).astype(np.uint32).view(np.int32).ravel() if full else np.zeros(0, np.int32)
                lengths = np.array([PERMUTATIONS if len(s) else 0 for s in sets])
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(posts, pa.int32()))
                ids = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.string()), lists], names=["doc_id", "n_shingles", "set_id", "posts"])

    return with_small_batches(docs).select(F.col(key).cast("long").alias(key), column).mapInArrow(run, "doc_id long, n_shingles long, set_id string, posts array<int>")


class _Sets(dict):
    """The shingles of the texts seen last, a bounded number of them in all."""

    size = 0

    def of(self, ident: int, packed: bytes) -> set[tuple[bytes, ...]]:
        found = self.get((ident, len(packed)))
        if found is None or found[0] != packed:
            found = packed, _unpacked(packed)
            if self.size > 200_000:
                self.clear()
                self.size = 0
            self[ident, len(packed)] = found
            self.size += len(found[1])
        return found[1]


def _unpacked(packed: bytes) -> set[tuple[bytes, ...]]:
    return shingle_set(zlib.decompress(packed).decode("utf-8", "surrogatepass"))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose full sets of shingles are alike; texts: (id, packed)."""
    pairs = written(pairs)
    hubs = texts.select(F.col("id").alias("b"), F.col("packed").alias("text_b")).join(if_small(pairs.select("b").distinct(), SMALL_IDS), "b", "left_semi")
    size = hubs.agg(F.sum(F.octet_length("text_b") + 64)).first()[0] or 0
    own = texts.select(F.col("id").alias("a"), F.col("packed").alias("text_a"))
    both = own.join(if_small(pairs, SMALL_IDS), "a").join(F.broadcast(hubs) if size <= SMALL_BYTES else hubs, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Sets()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                keep = []
                for b, x, y in zip(*(part.column(c).to_pylist() for c in ("b", "text_a", "text_b")), strict=True):
                    of_b, of_a = known.of(b, y), _unpacked(x)
                    common = len(of_a & of_b)
                    keep.append(100 * common >= SIMILAR * (len(of_a) + len(of_b) - common))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _tag(set_id: Column) -> Column:
    """A 60-bit number for a set id."""
    return F.conv(F.substring(set_id, 1, 15), 16, 10).cast("long")


def own_shingles(texts: DataFrame) -> DataFrame:
    """(tag, own): how many shingles of each cell no other of the texts has; texts: (packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                packed = batch.column("packed").slice(i, 256).to_pylist()
                sets = [shingle_hashes(zlib.decompress(x).decode("utf-8", "surrogatepass"), hashes) for x in packed]
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                tags = np.repeat(np.array([_set_tag(x) for x in sets], np.int64), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(tags)], names=["h", "tag"])

    rows = texts.select("packed").mapInArrow(run, "h long, tag long")
    alone = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("tag")).where("n = 1")
    cell = F.pmod("h", F.lit(CELLS))
    counts = alone.groupBy("tag").agg(*[F.count_if(cell == i).alias(f"n{i}") for i in range(CELLS)])
    return counts.select("tag", F.array(*[F.col(f"n{i}").cast("int") for i in range(CELLS)]).alias("own"))


def _set_tag(hashes: np.ndarray) -> int:
    return int(hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()[:15], 16)


def _packed(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(id, tag, cells, packed): the text compressed, and its shingles counted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(column).to_pylist()
                sets = [shingle_hashes(t, hashes) for t in texts]
                cells = [np.bincount((x.view(np.int64) % CELLS), minlength=CELLS) for x in sets]
                made = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in texts]
                tags = pa.array([_set_tag(x) for x in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(key), tags, pa.array(cells, pa.list_(pa.int32())), pa.array(made, pa.binary())], names=["id", "tag", "cells", "packed"])

    return with_small_batches(docs).select(F.col(key).cast("long").alias(key), column).mapInArrow(run, "id long, tag long, cells array<int>, packed binary")


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id in links (a, b); the label is the component's smallest id."""
    ways = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = ways.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("id"), F.least("a", "near").alias("label"))
    while True:
        state = written(state)
        of = if_small(state.select(F.col("id").alias("b"), F.col("label").alias("seen")), SMALL_IDS)
        near = ways.join(of, "b").groupBy("a").agg(F.min("seen").alias("seen"))
        low = near.join(state, near["a"] == state["id"]).select("id", "label", F.least("label", "seen").alias("low"))
        up = if_small(state.select(F.col("id").alias("low"), F.col("label").alias("up")), SMALL_IDS)
        moved = written(low.join(up, "low", "left").select("id", "label", F.least("low", F.coalesce("up", "low")).alias("new")))
        if not moved.where("new < label").limit(1).count():
            return moved.select("id", F.col("new").alias("label"))
        state = moved.select("id", F.col("new").alias("label"))


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) of the labels that links join, where they differ; labels: (id, label) of every class."""
    small = if_small(labels, SMALL_IDS)
    of_a, of_b = (small.select(F.col("id").alias(c), F.col("label").alias(f"of_{c}")) for c in "ab")
    return links.join(of_a, "a").join(of_b, "b").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after two steps to the smallest label that links lead to: equal ones still mean
    one component, and the classes that were linked with one hub get one label."""
    pairs = _between(links, labels)
    ways = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    up = written(ways.groupBy("a").agg(F.min("b").alias("up")).where("up < a"))
    up = if_small(up, SMALL_IDS)
    for _ in range(2):
        labels = labels.join(up, F.col("label") == F.col("a"), "left").select("id", F.coalesce("up", "label").alias("label"))
    return written(labels)


def _mixed_lists(lists: DataFrame, turn: int) -> DataFrame:
    """Of rows (key, id, label, weight) the keys with more than one label, their hub and their rows."""
    first = F.col("weight") if turn == 0 else F.xxhash64(F.lit(turn), "id")
    hub = F.max(F.struct(first.alias("first"), (-F.col("id")).alias("neg"), "label"))
    keys = lists.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), hub.alias("hub"), F.count(F.lit(1)).alias("rows"))
    return keys.where("low <> high").select("key", (-F.col("hub.neg")).alias("hub"), F.col("hub.label").alias("hub_label"), "rows")


def _enough(most: Column | np.ndarray, n: Column | np.ndarray) -> Column | np.ndarray:
    """Whether sets of n shingles together that share ``most`` at best can be alike."""
    return (100 + SIMILAR) * most >= SIMILAR * n


def candidates_of(marks: DataFrame) -> DataFrame:
    """(id, tag, n_shingles, posts, signature): classes with enough postings that others share,
    the rarest posting first; a posting's key is coordinate << 32 | value."""
    one = F.min_by(F.struct("n_shingles", "posts"), "doc_id")
    classes = marks.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("id"), one.alias("of"))
    key = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    single = classes.select("id", F.posexplode("of.posts").alias("at", "value")).select("id", key.alias("key"))
    shared = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    left = single.join(shared, "key").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("posts"))
    left = left.where(F.size("posts") >= MATCHES)
    sizes = classes.select("id", _tag(F.col("set_id")).alias("tag"), F.col("of.n_shingles").alias("n_shingles"), F.col("of.posts").alias("signature"))
    return left.join(sizes, "id")


def _in_blocks(lists: DataFrame) -> DataFrame:
    """Each row of lists (key, id, rows) once for each pair (low, high) of blocks of its list
    that its own block belongs to; lists of up to LIST rows are one block."""
    blocks = F.ceil(F.col("rows") / LIST).cast("int")
    own = lists.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return met.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}).drop("_other", "rows")


def _prefix_lists(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes under the keys of their prefixes, in blocks, where lists hold more than one label."""
    first = f"slice(keys, 1, size(keys) - {MATCHES - 1})"
    mask = F.expr(f"aggregate({first}, 0L, (acc, k) -> acc | shiftleft(1L, cast(shiftright(k, 32) as int)))")
    labelled = posts.join(if_small(labels, SMALL_IDS), "id")
    prefix = labelled.select("id", "n_shingles", "shared", "cells", "signature", mask.alias("mask"), "label", F.explode(F.expr(first)).alias("key"))
    keys = labelled.select("id", "label", "weight", F.explode(F.expr(first)).alias("key"))
    return _in_blocks(prefix.join(_mixed_lists(keys, 0).select("key", "rows"), "key"))


def _alike_in_lists(lists: DataFrame, nearest: bool = False) -> DataFrame:
    """(a, b, n): pairs of different labels in one list (key, low, high) that share n coordinates,
    MATCHES or more, the list's the first of both masks, and are within the bound; ``nearest``:
    for each a of a list only the b with the largest n."""
    names = ["key", "low", "high", "block", "id", "label", "n_shingles", "shared", "mask"]

    def apart(c: dict[str, np.ndarray], first: int, last: int, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the rows from first to last with later ones of their list, the pairs that labels, blocks and sizes allow."""
        x, y = slice(first, last), slice(s, e)
        may = np.arange(first, last)[:, None] < np.arange(s, e)
        may &= c["label"][x, None] != c["label"][y]
        if c["low"][s] != c["high"][s]:
            may &= c["block"][x, None] != c["block"][y]
        may &= _enough(np.minimum(c["shared"][x, None], c["shared"][y]), c["n_shingles"][x, None] + c["n_shingles"][y])
        i, j = np.nonzero(may)
        return i + first, j + s

    def pairs(c: dict[str, np.ndarray], s: int, e: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = (np.concatenate(x) for x in zip(*(apart(c, at, min(at + 256, e), s, e) for at in range(s, e, 256)), strict=True))
        bits = (c["mask"][s:e, None] >> np.arange(PERMUTATIONS)) & 1 == 1
        keep, shared = np.zeros(len(i), bool), np.zeros(len(i), np.int64)
        for at in range(0, len(i), 20_000):
            x, y = i[at : at + 20_000], j[at : at + 20_000]
            same = c["signature"][x] == c["signature"][y]
            shared[at : at + 20_000] = same.sum(1)
            found = np.flatnonzero((shared[at : at + 20_000] >= MATCHES) & ((same & bits[x - s] & bits[y - s]).argmax(1) == c["key"][s] >> 32))
            x, y = x[found], y[found]
            least = np.minimum(c["cells"][x], c["cells"][y])
            keep[at + found] = _enough(least.sum(1, dtype=np.int64), c["n_shingles"][x] + c["n_shingles"][y]) | (least == MOST).any(1)
        a, b, n = c["id"][i[keep]], c["id"][j[keep]], shared[keep]
        if not nearest:
            return np.minimum(a, b), np.maximum(a, b), n
        a, b, n = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([n, n])
        order = np.lexsort((b, -n, a))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero(np.diff(a, prepend=a[:1] - 1))
        return a[first], b[first], n[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in _and_end(batches):
            if batch is not None:
                c = {n: batch.column(n).to_numpy() for n in names}
                for n in ("cells", "signature"):
                    c[n] = batch.column(n).flatten().to_numpy().reshape(batch.num_rows, -1)
                held = c if held is None else {n: np.concatenate([held[n], c[n]]) for n in c}
            if held is None:
                continue
            new = np.diff(held["key"]) | np.diff(held["low"]) | np.diff(held["high"])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()] + ([len(held["key"])] if batch is None else [])
            made = [pairs(held, s, e) for s, e in zip(cuts, cuts[1:], strict=False) if e - s > 1]
            if made:
                columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])
            held = {n: v[cuts[-1] :] for n, v in held.items()}

    longs = [F.col(n).cast("long").alias(n) for n in names]
    return lists.select(*longs, "cells", "signature").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(run, "a long, b long, n long")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (b for b in batches if b.num_rows)
    yield None


def labels_of(docs: DataFrame, marks: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, label) of classes that confirmed links join, each under its smallest id, the label
    being its component's smallest id; marks from ``signed``."""
    found = written(candidates_of(marks))
    texts = written(_packed(docs.select(key, column).join(if_small(found.select(F.col("id").alias(key)).distinct(), SMALL_IDS), key, "left_semi"), key, column))
    counted = texts.select("tag", "cells").dropDuplicates(["tag"]).join(own_shingles(texts), "tag", "left")
    counted = counted.select("tag", F.when(F.col("own").isNull(), F.col("cells")).otherwise(F.zip_with("cells", "own", lambda n, own: n - own)).alias("cells"))
    found = found.join(counted, "tag")
    total = F.aggregate("cells", F.lit(0), lambda acc, n: acc + n)
    weight = F.aggregate("posts", F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    cells = F.transform("cells", lambda n: F.least(n, F.lit(MOST)).cast("smallint"))
    posts = found.select("id", "n_shingles", total.cast("long").alias("shared"), cells.alias("cells"), "signature", weight.alias("weight"), F.col("posts.key").alias("keys"))
    posts = written(posts.where(F.col("shared") * 100 >= F.col("n_shingles") * SIMILAR))

    links = None
    labels = written(posts.select("id", F.col("id").alias("label")))
    one = posts.select("id", F.struct("n_shingles", "shared").alias("s"))
    one = if_small(one, SMALL_IDS)
    sizes = {c: one.select(F.col("id").alias(c), F.col("s").alias(f"of_{c}")) for c in "ab"}
    for turn in range(STAR_ROUNDS):
        lists = posts.join(if_small(labels, SMALL_IDS), "id").select("id", "label", "weight", F.explode("keys").alias("key"))
        meets = lists.join(_mixed_lists(lists, turn), "key").where("label <> hub_label")
        counted = meets.groupBy(F.col("id").alias("a"), F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        counted = counted.join(sizes["a"], "a").join(sizes["b"], "b")
        counted = counted.where(_enough(F.least("of_a.shared", "of_b.shared"), F.col("of_a.n_shingles") + F.col("of_b.n_shingles")))
        best = counted.groupBy("a").agg(F.max_by("b", F.struct("n", (-F.col("b")).alias("neg"))).alias("b"))
        new = written(confirmed(best, texts))
        links = new if links is None else links.unionByName(new)
        labels = _relabelled(labels, new)

    for _ in range(NEAR_ROUNDS):
        near = _alike_in_lists(_prefix_lists(posts, labels), nearest=True)
        near = near.groupBy("a").agg(F.min_by("b", F.struct(-F.col("n"), "b")).alias("b"))
        near = written(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if near.isEmpty():
            return _joined(labels, links)  # no pair is apart
        new = written(confirmed(near, texts))
        links = links.unionByName(new)
        if new.count() < LINKED * near.count():
            break  # most are apart: the last join tells them all at once
        labels = _joined(labels, new)

    enough = _alike_in_lists(_prefix_lists(posts, labels)).select("a", "b").distinct()
    new = written(confirmed(enough, texts))
    return _joined(labels, links.unionByName(new))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels with those that links join as one, the smallest."""
    joined = components(_between(links, labels))
    joined = if_small(written(joined.select(F.col("id").alias("label"), F.col("label").alias("low"))), SMALL_IDS)
    return written(labels.join(joined, "label", "left").select("id", F.coalesce("low", "label").alias("label")))


def clustered(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    marks = written(signed(docs, key, column))
    labels = labels_of(docs, marks, key, column)
    first = marks.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"))
    by_set = first.join(labels, "id", "left").select("set_id", F.coalesce("label", "id").alias("component_id"), "last")
    by_set = written(by_set.where(F.col("last") != F.col("component_id")).drop("last"))  # all others are alone
    out = marks.select("doc_id", "n_shingles", "set_id").join(if_small(by_set), "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows of docs that are the first of their component, columns unchanged."""
    own = fresh(docs, "_gone")
    gone = written(clustered(docs, key, column).where(~F.col("kept")).select(F.col("doc_id").alias(own)).distinct())
    return docs.join(if_small(gone, SMALL_IDS), F.col(key) == F.col(own), "left_anti")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text")))


#: Brute force over all pairs of sets; for small tables.
ORACLE = """
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
sorted AS (SELECT doc_id, len(sh)::BIGINT AS n, md5(array_to_string(list_sort(sh), chr(10))) AS set_id, sh FROM s),
cls AS (SELECT set_id, min(doc_id) AS id, any_value(n) AS n, any_value(sh) AS sh FROM sorted WHERE n > 0 GROUP BY set_id),
post AS (SELECT id, n, hash(unnest(sh)) AS h FROM cls),
common AS (SELECT h FROM post GROUP BY h HAVING count(*) > 1),
hit AS (SELECT p.* FROM post p SEMI JOIN common c ON p.h = c.h),
link AS (SELECT x.id AS a, y.id AS b FROM hit x JOIN hit y ON x.h = y.h AND x.id < y.id GROUP BY x.id, y.id, x.n, y.n
         HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(id, label) AS (SELECT id, id FROM cls UNION SELECT ways.b, reach.label FROM reach JOIN ways ON ways.a = reach.id WHERE reach.label < ways.b),
low AS (SELECT id, min(label) AS label FROM reach GROUP BY id)
SELECT sorted.doc_id, sorted.n AS n_shingles, coalesce(low.label, sorted.doc_id) AS component_id,
       sorted.doc_id = coalesce(low.label, sorted.doc_id) AS kept
FROM sorted LEFT JOIN cls USING (set_id) LEFT JOIN low ON low.id = cls.id
"""

QUERIES = {"op9_minhash": op9_minhash}
ORACLE_SQL: dict[str, str] = {"op9_minhash": ORACLE}
