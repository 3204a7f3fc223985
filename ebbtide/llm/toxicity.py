"""Toxicity: a convolutional text classifier in numpy.

Words (ASCII letters lower-cased, ASCII punctuation as gaps) and their prefixes of 4 to 6
bytes are hashed into a table of embeddings, and a word is the sum of its own and its
prefixes'; filters of several widths run over the whole text, each keeps its largest answer,
and a logistic layer makes the score.  One dimension of the embeddings starts as the bucket's
log-odds in the training rows, the rest as small seeded noise; all of it is then trained with
Adam.  A Platt step on a fifth of the training rows, set aside by hash, places the
best cut of the score at 0.5, and a threshold for each language is calibrated on the same
part.  The threshold is the only thing that depends on the language; scores do not.

Training sees every labelled row that is not held out, as whole texts of hashed words, dealt by
hash into shards of about ``shard_rows``.  Log-odds are counted over all shards; in every epoch
each shard's task goes on from the common model with its own rows, and the changes are averaged,
block by block of the parameters, by the number of rows.  Texts cross one shuffle, to their shard,
where they meet their labels; bitmaps of the labelled ids' hashes keep nearly all other texts out of
it.  Cuts are found on counts of rows by score
(log odds to two decimals).  A task holds one shard; the driver gets the parameters (2 MB) and
those counts.  Scoring is one pass over every text; the weights are broadcast (2 MB, whatever the
corpus).

Edge cases: null or wordless texts get the score of an empty window; labels that are null, or
whose row has no document, are left out; of several labels for a document the largest
counts; without labels of both kinds every score is the share of toxic labels (0.5 without
any); languages without labelled rows, and null, take the cut 0.5; other columns pass
through.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import table, with_small_batches, written

BUCKETS = (1 << 16) - 1
PAD = BUCKETS  # of words shorter than a prefix, and beyond a text's ends; its embedding stays zero
PREFIXES = (4, 5, 6)
PARTS = 1 + len(PREFIXES)
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PRIOR = 10
SHARD_ROWS = 8000
EPOCHS = 3
#: Parameters that are summed in one group, rows set aside (one in so many), and steps of log odds in one.
BLOCK, ASIDE, STEPS = 8192, 5, 100
#: Bits of one bitmap, bits for each labelled id, and the most bitmaps broadcast (8 MB).
BITS, BITS_AN_ID, MOST_BITMAPS = 1 << 15, 8, 2048
SEED = 7
FOLDS = 5
#: Texts made Python strings at a time, and words whose buckets a task remembers.
SLICE, MAX_WORDS = 512, 100_000

#: ASCII other than letters and digits separates words; upper case becomes lower; bytes of
#: other characters stay.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32) for c in range(256))


class _Words(dict):
    """Numbers of the words seen so far, and the buckets of each: its own and its prefixes'."""

    def __init__(self) -> None:
        super().__init__()
        self.parts: list[tuple[int, ...]] = []
        self.made = np.zeros((0, PARTS), np.uint16)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.parts)
        prefixes = [zlib.crc32(word[:k], k) % BUCKETS if len(word) >= k else PAD for k in PREFIXES]
        self.parts.append((zlib.crc32(word) % BUCKETS, *prefixes))
        return n

    def buckets(self, numbers: list[int]) -> np.ndarray:
        if len(self.made) < len(self.parts):
            self.made = np.concatenate([self.made, np.array(self.parts[len(self.made) :], np.uint16)])
        return self.made[numbers] if numbers else np.zeros((0, PARTS), np.uint16)

    def of(self, text: str) -> np.ndarray:
        """The buckets of a text's words: an array of PARTS columns."""
        if len(self) > MAX_WORDS:
            self.clear()
            self.__init__()
        return self.buckets([self[w] for w in text.encode("utf-8", "surrogatepass").translate(_TABLE).split()])


@dataclass
class Model:
    """Embeddings by bucket, filters of each width, the output layer, and what was calibrated."""

    embed: np.ndarray | None = None
    filters: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    offset: float = 0.0
    platt: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Scores of texts given as buckets.  Texts lie one after the other, padded so that no
        window reaches from one into the next."""
        if self.constant is not None or not docs:
            return np.full(len(docs), self.constant if self.constant is not None else 0.5)
        pad = max(WIDTHS) - 1
        sizes = np.array([max(len(d), 1) for d in docs])
        starts = np.concatenate([[0], np.cumsum(sizes + pad)[:-1]])
        total = int((sizes + pad).sum())
        flat = np.full((total, PARTS), PAD, np.uint16)
        for d, at in zip(docs, starts, strict=True):
            flat[at : at + len(d)] = d
        x = self.embed[flat[:, 0]]
        for j in range(1, PARTS):
            x += self.embed[flat[:, j]]
        n = total - pad
        edges = np.stack([starts, starts + sizes], 1).ravel()
        features = []
        for w, f, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            answer = x[:n] @ f[:DIMENSION]
            for j in range(1, w):
                answer += x[j : j + n] @ f[j * DIMENSION : (j + 1) * DIMENSION]
            top = np.maximum.reduceat(answer, edges[:-1], axis=0)[::2]  # windows that begin inside each text
            features.append(np.maximum(top + bias, 0.0))
        raw = np.concatenate(features, 1) @ self.weights + self.offset
        a, b = self.platt
        return 1.0 / (1.0 + np.exp(-np.clip(a * raw + b, -35, 35)))


def _counted(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Documents by bucket: of the clean ones, then of the toxic ones."""
    seen = [np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)]
    for d, label in zip(docs, y, strict=True):
        seen[int(label)][np.unique(d)] += 1
    return np.concatenate(seen)


def _first(seen: np.ndarray, n1: int, n0: int, seed: int) -> list[np.ndarray]:
    """The parameters before training: embeddings, filters, their biases, the output layer and its offset."""
    rng = np.random.default_rng(seed)
    seen = seen.reshape(2, -1)
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    sure = (seen[0] + seen[1]) / (seen[0] + seen[1] + 20)
    embed = rng.normal(0, 0.02, (BUCKETS + 1, DIMENSION)).astype(np.float32)
    embed[:, 0] = np.clip(odds * sure, -2, 4)
    embed[PAD] = 0
    filters, bias = [], []
    for w in WIDTHS:
        f = rng.normal(0, 0.1, (w * DIMENSION, FILTERS)).astype(np.float32)
        f[::DIMENSION] += 0.5 / w  # every filter starts by looking at the log-odds
        filters.append(f)
        bias.append(np.full(FILTERS, -1.0, np.float32))
    out = np.full(FILTERS * len(WIDTHS), 2.0 / (FILTERS * len(WIDTHS)), np.float32)
    offset = np.full(1, -2.0, np.float32)
    return [embed, *filters, *bias, out, offset]


def _epoch(docs: list[np.ndarray], y: np.ndarray, params: list[np.ndarray], seed: list[int]) -> None:
    """One pass of Adam over the rows, which changes the parameters."""
    rng = np.random.default_rng(seed)
    embed, filters, bias, (out, offset) = params[0], params[1 : 1 + len(WIDTHS)], params[1 + len(WIDTHS) : -2], params[-2:]
    rates = [0.002, *[0.01] * (len(params) - 1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, batch, k, pad = 0, 32, len(WIDTHS), max(WIDTHS) - 1
    tail = np.full((pad, PARTS), PAD, np.uint16)
    order = rng.permutation(len(docs))
    for at in range(0, len(order), batch):
        grads = [None, *[np.zeros_like(p) for p in params[1:]]]
        rows, steps = [], []
        for i in order[at : at + batch]:
            d = np.concatenate([docs[i] if len(docs[i]) else tail[:1], tail])
            x = embed[d].sum(1)
            n = len(d) - pad
            hidden, places = [], []
            for w, f, b in zip(WIDTHS, filters, bias, strict=True):
                answer = sum(x[j : j + n] @ f[j * DIMENSION : (j + 1) * DIMENSION] for j in range(w))
                best = answer.argmax(0)
                places.append((best, np.concatenate([x[best + j] for j in range(w)], 1)))
                hidden.append(answer[best, np.arange(FILTERS)] + b)
            h = np.concatenate(hidden)
            active = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ out + offset[0], -30, 30)))
            g = float(p - y[i]) / batch
            grads[1 + 2 * k] += g * active
            grads[2 + 2 * k] += g
            gh = g * out * (h > 0)
            for j, w in enumerate(WIDTHS):
                own = gh[j * FILTERS : (j + 1) * FILTERS]
                best, windows = places[j]
                grads[1 + j] += windows.T * own
                grads[1 + k + j] += own
                back = (filters[j] * own).T.reshape(FILTERS * w, DIMENSION)
                rows.append(d[(best[:, None] + np.arange(w)).ravel()].ravel())
                steps.append(np.repeat(back, PARTS, 0))
        step += 1
        fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        which, inverse = np.unique(np.concatenate(rows), return_inverse=True)
        sparse = np.zeros((len(which), DIMENSION), np.float32)
        np.add.at(sparse, inverse, np.concatenate(steps))
        sparse[which == PAD] = 0
        for j, p in enumerate(params):
            at_ = which if j == 0 else slice(None)
            grad = sparse if j == 0 else grads[j]
            first[j][at_] = 0.9 * first[j][at_] + 0.1 * grad
            second[j][at_] = 0.999 * second[j][at_] + 0.001 * grad * grad
            p[at_] -= rates[j] * fix * first[j][at_] / (np.sqrt(second[j][at_]) + 1e-8)


def _model_of(params: list[np.ndarray]) -> Model:
    k = len(WIDTHS)
    return Model(params[0], params[1 : 1 + k], params[1 + k : -2], params[-2].astype(np.float64), float(params[-1][0]))


def _parts(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays of a flat one, of the shapes of others."""
    ends = np.cumsum([p.size for p in like])
    return [x.reshape(p.shape) for x, p in zip(np.split(flat, ends[:-1]), like, strict=True)]


def _best_cut(scores: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> float:
    """The cut in the widest gap among those of best F1, by numbers of toxic and clean rows of
    ascending scores; 0.5 if there is only one kind."""
    if not (ones.sum() and zeros.sum()):
        return 0.5
    ranked, ones, zeros = scores[::-1], ones[::-1], zeros[::-1]
    f1 = 2 * np.cumsum(ones) / (np.cumsum(ones + zeros) + ones.sum())
    below = np.append(ranked[1:], 0.0)
    f1[ranked == below] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    i = best[np.argmax((ranked - below)[best])]
    return float((ranked[i] + below[i]) / 2)


def _calibrate(model: Model, counts: list[tuple[str | None, int, int, int]]) -> None:
    """Set the Platt step and the languages' thresholds.  counts: (language, log odds, toxic rows,
    clean rows); without a language they are of all rows."""

    def arrays(lang: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = np.array(sorted(c[1:] for c in counts if c[0] == lang), np.float64).reshape(-1, 3)
        return own[:, 0] / STEPS, own[:, 1], own[:, 2]

    raw, ones, zeros = arrays(None)
    cut = _best_cut(1 / (1 + np.exp(-raw)), ones, zeros)
    middle = float(np.log(max(cut, 1e-12) / max(1 - cut, 1e-12)))
    spread = max(0.25, min(4.0, 6.0 / ((np.abs(raw - middle) * (ones + zeros)).sum() / (ones + zeros).sum() + 1e-9)))
    model.platt = (spread, -spread * middle)
    for lang in sorted({c[0] for c in counts if c[0] is not None}):
        raw, ones, zeros = arrays(lang)
        scores = 1 / (1 + np.exp(-np.clip(spread * (raw - middle), -35, 35)))
        # the language's own cut moves the common one, 0.5, the further (in log odds) the more labels
        # of its rarer kind there are; PRIOR of them move it half the way
        n = min(ones.sum(), zeros.sum())
        at = np.clip(_best_cut(scores, ones, zeros), 1e-9, 1 - 1e-9)
        model.thresholds[lang] = float(1 / (1 + ((1 - at) / at) ** (n / (n + PRIOR))))


def buckets_of(df: DataFrame, column: str = "text", out: str = "buckets") -> DataFrame:
    """Replace a text column by its words' buckets, as unsigned 16-bit integers in a binary column."""
    kept = [c for c in df.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            made = [words.of(t or "").astype("<u2").tobytes() for i in range(0, batch.num_rows, SLICE) for t in batch.column(column).slice(i, SLICE).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.binary())], names=[*kept, out])

    return with_small_batches(df).select(*kept, column).mapInArrow(run, df.select(*kept).schema.add(out, "binary"))


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def _marked(docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """The documents whose id's hash is marked by one of the ``n`` known ids: all those known, and few others.

    Past 8 million ids the bitmaps stay as large and let more of the others through."""
    bitmaps = min(MOST_BITMAPS, math.ceil(n * BITS_AN_ID / BITS))
    place = F.xxhash64(F.lit(SEED + 2), "doc_id")
    which, bit = F.pmod(F.shiftright(place, 15), F.lit(bitmaps)), F.pmod(place, F.lit(BITS))
    marks = known.groupBy(which.alias("_which")).agg(F.bitmap_construct_agg(bit).alias("_marks"))
    byte = F.conv(F.hex(F.substr("_marks", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return docs.join(F.broadcast(marks), (which == F.col("_which")) & (F.getbit(byte, bit % 8) == 1), "left_semi")


def _dealt(docs: DataFrame, known: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    """(shard, aside, lang, toxic, text) of the known documents, a shard a partition, in order of their places.

    Labels and texts are dealt alike, and a label stands before the texts of its id."""
    texts = _marked(docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id"))), known, n)
    both = texts.unionByName(known.select("doc_id", F.col("toxic").alias("told")), allowMissingColumns=True)
    place = F.xxhash64(F.lit(seed), "doc_id")
    shard = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(shards)).cast("int")
    both = both.withColumns({"place": place, "aside": F.pmod(place, F.lit(ASIDE)) == 0, "shard": shard, "mark": F.xxhash64("text")}).repartitionById(shards, "shard")
    own = Window.partitionBy("shard", "place", "doc_id").orderBy(F.col("told").asc_nulls_last(), "mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("toxic", F.max("told").over(own)).where("told IS NULL AND toxic IS NOT NULL").select("shard", "aside", "lang", "toxic", "text")


def _of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(v, "<u2").reshape(-1, PARTS) for v in batch.column("buckets").to_pylist()]


def _summed(rows: DataFrame, made: Callable[[int, list[np.ndarray], np.ndarray], np.ndarray], kind: type) -> np.ndarray:
    """The sum of the arrays made of each shard: of its number, its buckets and its labels."""

    def blocks(shard: int, docs: list[np.ndarray], y: list[int]) -> Iterator[pa.RecordBatch]:
        flat = made(shard, docs, np.array(y, np.float64)).astype(kind)
        cut = [flat[at : at + BLOCK].tobytes() for at in range(0, len(flat), BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array([shard] * len(cut), pa.int32()), pa.array(cut, pa.binary())], names=["block", "shard", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, docs, y = -1, [], []
        for batch in batches:
            for n, d, toxic in zip(batch.column("shard").to_pylist(), _of(batch), batch.column("toxic").to_pylist(), strict=True):
                if n != shard and docs:
                    yield from blocks(shard, docs, y)
                    docs, y = [], []
                shard = n
                docs.append(d)
                y.append(toxic)
        if docs:
            yield from blocks(shard, docs, y)

    def total(part: pa.Table) -> pa.Table:
        part = part.sort_by("shard")
        whole = sum(np.frombuffer(v, kind).astype(np.float64) for v in part.column("part").to_pylist())
        return pa.table({"block": part.column("block").slice(0, 1), "part": pa.array([whole.tobytes()], pa.binary())})

    sums = rows.select("shard", "buckets", "toxic").mapInArrow(run, "block int, shard int, part binary").groupBy("block").applyInArrow(total, "block int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], np.float64) for r in sorted(sums, key=lambda r: r["block"])])


def _trained(rows: DataFrame, n1: int, n0: int, seed: int, epochs: int) -> Model:
    """A model of all rows, by rounds: a shard's task goes on from the common parameters, and its
    changes count by its number of rows."""
    params = _first(_summed(rows, lambda _, docs, y: _counted(docs, y), np.float64), n1, n0, seed)
    for epoch in range(epochs):
        shared = rows.sparkSession.sparkContext.broadcast(params)

        def changes(shard: int, docs: list[np.ndarray], y: np.ndarray, shared=shared, epoch: int = epoch) -> np.ndarray:  # noqa: ANN001
            mine = [p.copy() for p in shared.value]
            _epoch(docs, y, mine, [seed, epoch, shard])
            return np.concatenate([(p - q).ravel() for p, q in zip(mine, shared.value, strict=True)]) * len(docs)

        moved = _parts(_summed(rows, changes, np.float32) / (n1 + n0), params)
        params = [(p + d).astype(np.float32) for p, d in zip(params, moved, strict=True)]
    return _model_of(params)


def fitted(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS, seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """Train on all labelled documents that are not held out, in shards of about ``shard_rows``."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.withColumn("aside", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(ASIDE)) == 0)
    toxic, aside = F.col("toxic") > 0, F.col("aside")
    kinds = [F.count_if(toxic & ~aside), F.count_if(~toxic & ~aside), F.count_if(toxic & aside), F.count_if(~toxic & aside)]
    n1, n0, a1, a0 = docs.select("doc_id").join(known, "doc_id").agg(*kinds).first()
    if not (n1 + a1 and n0 + a0):
        return Model(constant=1.0 if n1 + a1 else 0.0 if n0 + a0 else 0.5)
    shards = math.ceil((n1 + n0 + a1 + a0) / shard_rows)
    rows = written(buckets_of(_dealt(docs, known, n1 + n0 + a1 + a0, shards, seed)))
    apart = bool(n1 and n0 and a1 and a0)  # else all rows train, and calibrate
    model = _trained(rows.where(~aside), n1, n0, seed, epochs) if apart else _trained(rows, n1 + a1, n0 + a0, seed, epochs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.zeros(0), *(shared.value.score(_of(batch.slice(i, SLICE))) for i in range(0, batch.num_rows, SLICE))]
            s = np.clip(np.concatenate(made), 1e-12, 1 - 1e-12)
            steps = np.rint(STEPS * np.log(s / (1 - s))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(steps)], names=["lang", "toxic", "step"])

    checked = (rows.where(aside) if apart else rows).select("lang", "toxic", "buckets")
    sums = [F.count_if(toxic).alias("ones"), F.count_if(~toxic).alias("zeros")]
    counts = written(checked.mapInArrow(score, checked.select("lang", "toxic").schema.add("step", "long")).groupBy("lang", "step").agg(*sums))
    sums = [F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")]
    enough = counts.where("lang <> ''").groupBy("lang").agg(*sums).where("ones >= 10 AND zeros >= 10")
    told = counts.join(enough.select("lang"), "lang", "left_semi").select("lang", "step", "ones", "zeros")
    every = counts.groupBy("step").agg(*sums).select(F.lit(None).cast("string").alias("lang"), "step", "ones", "zeros")
    _calibrate(model, [tuple(r) for r in every.unionByName(told).collect()])
    return model


def with_scores(docs: DataFrame, model: Model, column: str = "text", score: str = "score", lang_threshold: str = "lang_threshold", flagged: str = "flagged") -> DataFrame:
    """Add ``score``, ``lang_threshold`` and ``flagged`` (score at or above the language's
    threshold); columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c not in (score, lang_threshold, flagged)])
    schema = docs.select("*").schema.add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, m = _Words(), shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                scores: list[np.ndarray] = [np.zeros(0)]
                held: list[np.ndarray] = []
                size = 0
                for t in part.column(column).to_pylist():
                    held.append(words.of(t or ""))
                    size += len(held[-1])
                    if size > 100_000:
                        scores.append(m.score(held))
                        held, size = [], 0
                scores.append(m.score(held))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.concatenate(scores), pa.float64())], names=[*part.schema.names, score])

    scored = with_small_batches(docs).mapInArrow(run, schema)
    cut = F.lit(0.5)
    if "lang" in docs.columns:
        for lang, at in sorted(model.thresholds.items()):
            cut = F.when(F.col("lang") == lang, F.lit(at)).otherwise(cut)
    return scored.withColumn(lang_threshold, cut).withColumn(flagged, F.col(score) >= F.col(lang_threshold))


def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return with_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang_threshold", "flagged"
    )


QUERIES = {"op7_toxicity_cnn": op7_toxicity_cnn}
ORACLE_SQL: dict[str, str] = {}
