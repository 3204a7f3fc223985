"""Secret scans: fixed patterns, and character Markov models told apart by likelihood.

Two first-order Markov models over an alphabet of 66 symbols are counted from labelled
samples: random strings (keys, digests, tokens) and ordinary runs (identifiers, paths, long
words, rulers, sequences).  A pair of symbols that a run (in stretches of 64 pairs) had before
tells nothing new: each model has one probability of such a repeat, and a table of the pairs
that are no repeats, unseen ones priced by how often their second symbol occurs.  So a ruler,
whatever its symbol, is no secret.  A run of 20 or more such symbols is a secret if the
log-likelihood ratio of the two models, per pair of characters, is above a limit.  The limit is set on samples that the models have not seen: at
most one in a thousand of their ordinary ones exceeds it, and where the random ones lie
further up it is the middle between the two.  The model is a table of 66 x 66 + 2 numbers,
whatever the samples' size; scans are DataFrame expressions on each text alone, without any
shuffle.

``samples`` may be any table (text, label); by default they are made from a seed and from
the words below.

Edge cases: null is the empty text, without spans; spans count code points, end exclusive;
spans of a pattern never overlap, those of different kinds may, and all are listed; equal
texts have equal spans; a text with many thousands of spans is handled in blocks of them; an
empty table stays empty; other columns pass through ``with_spans``, where columns named as
its outputs (parameters ``base`` and ``spans``) are replaced; without samples no run is a
secret.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import fresh, table, text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The same matches as AKIA[A-Z0-9]+ of 16 and [0-9a-f]+ of 32 or more: both take whole runs.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
N = len(SYMBOLS)
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
SEED = "ebbtide"
SAMPLES = 6000
FALSE_RATE = 0.001
#: One in so many samples sets the limit and trains nothing.
ASIDE = 4
#: Spans of a text are found in blocks of so many.
BLOCK = 256
SCALE = 1000
#: Repeated pairs are told within so many pairs.
STRETCH = 64
#: An unseen pair weighs as much as so many seen ones, dealt by its second symbol's share.
BACK_OFF = 20.0

#: Words that ordinary identifiers are made of, in the default samples.
ORDINARY = (
    "account action active address after album amount answer array author backup balance batch before billing block border branch "
    "buffer button cache calendar camera cancel catalog category change channel charge child class client cluster color column comment "
    "common company config connect content context control count country create currency current customer data database date debug "
    "default delete deliver detail device digest direct display document domain download driver editor element email enable engine "
    "entry error event example export factory failed family feature field filter final find first folder format forward frame friend "
    "function gateway general global group handle header height history home image import index input insert instance integer "
    "invoice item journal language large last layer layout length level library limit line list local location logger machine main "
    "manager margin market master maximum member memory merge message method middle minimum missing model module monitor month name "
    "network normal notice number object offset option order origin output owner package page parent partner payment people period "
    "person picture platform player point policy position price print process product profile program project property provider public "
    "query question queue random range record reference region release remote report request reset resource response result return "
    "review right route sample schedule schema score screen script search second section select sender sequence server service session "
    "setting shadow simple single source special start state station status storage store stream string structure style subject "
    "system table target task team template text theme thread through ticket time title total track transfer tree trigger type under "
    "unit update upload user valid value vector version video view visible volume warning water width window within worker writer year "
    "bearbeitung einstellung entwicklung gesellschaft geschwindigkeit verantwortung wissenschaft zeitung zusammenarbeit nachricht "
    "aujourd développement gouvernement maintenant mouvement nouvelle première toujours travailler "
    "administracion ciudadanos comunicacion conocimiento desarrollo educacion informacion siempre trabajadores universidad"
).split()


#: Long words of four languages, in the default samples.
LONG_WORDS = (
    "internationalization telecommunications misunderstanding responsibilities uncharacteristically disproportionately "
    "counterproductive straightforwardness neighbourhood throughout knowledgeable acknowledgement "
    "Geschwindigkeitsbegrenzung Bundesverfassungsgericht Rechtsschutzversicherung Aufmerksamkeitsdefizit Wirtschaftswissenschaften "
    "Krankenversicherungskarte Freundschaftsbeziehungen Arbeitsunfaehigkeitsbescheinigung Haushaltswaren Jahreszeiten "
    "anticonstitutionnellement gouvernementalisation professionnellement reconnaissances bouleversement developpement "
    "quotidiennement malheureusement environnementales electromagnetique "
    "desafortunadamente responsabilidades electrodomesticos otorrinolaringologo ayuntamientos agradecimiento "
    "extraordinariamente constitucionalidad independientemente correspondencia"
).split()


def default_samples(spark: SparkSession, n: int = SAMPLES, seed: str = SEED) -> DataFrame:
    """(text, label): n random strings in six alphabets (1) and n ordinary runs (0): identifiers,
    paths, long words, rulers and short patterns said again, and parts of the alphabet."""
    words = F.split(F.lit(" ".join(w for w in ORDINARY if w.isascii())), " ")
    number = lambda salt, of: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("id")), F.lit(of)).cast("int")
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col("id")), 512)
    b64 = F.base64(F.unhex(digest))
    alnum = F.translate(b64, "+/=", "x7Q")
    shapes = (b64, digest, F.upper(digest), alnum, F.upper(alnum), F.translate(b64, "+/=", "-_z"))
    kind = F.pmod(F.col("id"), F.lit(len(shapes)))
    random = F.element_at(F.array(*[F.regexp_replace(s, r"[^A-Za-z0-9+/_-]", "") for s in shapes]), (kind + 1).cast("int"))
    random = F.substring(random, F.lit(1), 20 + number("length", 44))
    word = lambda salt: F.element_at(words, 1 + number(salt, sum(w.isascii() for w in ORDINARY)))
    several = F.slice(F.array(*[word(f"w{i}") for i in range(6)]), F.lit(1), 3 + number("words", 4))
    long_words = F.array(*[F.lit(w) for w in LONG_WORDS])
    long_word = lambda salt: F.element_at(long_words, 1 + number(salt, len(LONG_WORDS)))
    length = 20 + number("run", 60)
    symbols = F.concat(*[F.substring(F.lit(SYMBOLS), 1 + number(f"s{i}", N), F.lit(1)) for i in range(4)])
    year = (1950 + number("year", 100)).cast("string")
    forms = (
        F.array_join(several, "_"),
        F.array_join(several, "-"),
        F.array_join(F.transform(several, F.initcap), ""),
        F.upper(F.array_join(several, "_")),
        F.array_join(several, "/"),
        F.array_join(several, ""),
        F.concat(F.array_join(several, "_"), F.lit("_"), number("n", 2100).cast("string")),
        F.concat_ws("/", word("w0"), year, F.lpad((1 + number("month", 12)).cast("string"), 2, "0"), word("w1"), F.array_join(F.slice(several, F.lit(1), F.lit(3)), "-")),
        F.concat(F.lit("/"), F.array_join(several, "/"), (number("n", 30)).cast("string"), F.lit("/"), F.initcap(word("w0"))),
        F.concat(long_word("l0"), F.lit("-"), F.lower(long_word("l1"))),
        F.concat(F.lower(long_word("l0")), F.lower(long_word("l1"))),
        # a symbol, or a pattern of two to four, said again
        F.substring(F.repeat(F.substring(symbols, F.lit(1), 1 + number("period", 4)), 80), F.lit(1), length),
        F.substring(F.repeat(F.lit(SYMBOLS), 3), 1 + number("s0", N), length),
    )
    ordinary = F.element_at(F.array(*forms), 1 + number("form", len(forms)))
    ids = spark.range(0, n, 1, 1)
    return ids.select(random.alias("text"), F.lit(1).alias("label")).unionByName(ids.select(ordinary.alias("text"), F.lit(0).alias("label")))


def _pairs(run: Column) -> Column:
    """The indexes of the pairs of symbols of a run, in order."""
    symbols = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(SYMBOLS)) - 1)
    pairs = lambda at: F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: a * N + b)
    # transform over a one-element array binds the symbols once
    return F.element_at(F.transform(F.array(symbols), pairs), 1)


def _new_pairs(pairs: Column) -> Column:
    """The pairs of each stretch that the stretch had not before."""
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(pairs), F.lit(1)) - 1) / STRETCH).cast("int"))
    return F.flatten(F.transform(starts, lambda i: F.array_distinct(F.slice(pairs, i * STRETCH + 1, F.lit(STRETCH)))))


def fit(samples: DataFrame) -> list[int]:
    """The log-likelihood ratios, in thousandths: of all pairs of symbols, of a repeated pair,
    and of a pair that is none.

    Pairs are counted by Spark; what reaches the driver has at most 2 x 66 x 66 + 2 rows."""
    runs = samples.select("label", F.explode(F.regexp_extract_all(text_of(), F.lit(r"[A-Za-z0-9+/_-]{2,}"), F.lit(0))).alias("run"))
    runs = runs.select("label", (F.char_length("run") - 1).alias("pairs"), _new_pairs(_pairs(F.col("run"))).alias("new"))
    pairs = runs.select("label", F.explode("new").alias("pair"))
    counts = {(r["label"], r["pair"]): r["n"] for r in pairs.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}
    sums = runs.groupBy("label").agg(F.sum("pairs").alias("pairs"), F.sum(F.size("new")).alias("new")).collect()
    totals = {r["label"]: (r["pairs"] - r["new"], r["new"]) for r in sums}

    def model(label: int) -> list[float]:
        seen = [[counts.get((label, a * N + b), 0) for b in range(N)] for a in range(N)]
        second = [sum(row[b] for row in seen) + 0.5 for b in range(N)]
        share = [n / sum(second) for n in second]
        out = [math.log((n + BACK_OFF * p) / (sum(row) + BACK_OFF)) for row in seen for n, p in zip(row, share, strict=True)]
        repeated, new = totals.get(label, (0, 0))
        return out + [math.log((n + 0.5) / (repeated + new + 1)) for n in (repeated, new)]

    return [round(SCALE * (x - y)) for x, y in zip(model(1), model(0), strict=True)]


def ratio(run: Column, model: list[int]) -> Column:
    """Mean log-likelihood ratio of a run's pairs, in thousandths."""
    numbers = F.split(F.lit(",".join(map(str, model[: N * N]))), ",").cast("array<int>")  # folded to a constant
    repeated, new = model[N * N :]
    pairs = F.char_length(run) - 1

    def of_new(found: Column) -> Column:
        told = F.aggregate(found, F.lit(0).cast("long"), lambda acc, p: acc + F.element_at(numbers, p + 1))
        return told + F.size(found) * new + (pairs - F.size(found)) * repeated

    bound = F.transform(F.array(_pairs(run)), _new_pairs)  # transform over one element binds it once
    return F.element_at(F.transform(bound, of_new), 1) / pairs


def threshold(samples: DataFrame, model: list[int], false_rate: float = FALSE_RATE) -> float:
    """The ratio that at most ``false_rate`` of the ordinary samples exceed, or the middle
    between it and the ratio that all but a hundredth of the random ones exceed, if that is more."""
    scored = samples.where(F.col("text").rlike(f"^{CANDIDATE}$")).select("label", ratio(F.col("text"), model).alias("r"))
    high = F.percentile(F.when(F.col("label") == 0, F.col("r")), 1.0 - false_rate)
    low = F.percentile(F.when(F.col("label") == 1, F.col("r")), 0.01)
    row = scored.agg(high.alias("high"), low.alias("low")).first()
    if row["high"] is None:
        return math.inf
    return max(row["high"], (row["high"] + row["low"]) / 2 if row["low"] is not None else row["high"])


def _spans(text: Column, pattern: str, rank: int, keep) -> Column:
    """Sorted array of (start, kind, end) of a pattern's matches for which keep(match) holds.

    Where matches begin follows from the lengths of the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern), lambda x: F.char_length(x))
    kind = "array<struct<start:int,kind:int,end:int>>"
    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.char_length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(keep(pair["match"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def of_block(pairs: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(pairs, F.lit(1), i * BLOCK), F.lit(0), lambda acc, p: acc + p["gap"] + F.char_length(p["match"]))
        zero = F.struct(before.alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(F.slice(pairs, i * BLOCK + 1, F.lit(BLOCK)), zero, step, lambda acc: acc["out"])

    zipped = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    blocks = lambda pairs: F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")), lambda i: of_block(pairs, i)))
    # transform over a one-element array binds the matches once
    return F.when(text.rlike(pattern), F.element_at(F.transform(F.array(zipped), blocks), 1)).otherwise(F.array().cast(kind))


def with_spans(df: DataFrame, model: list[int], limit: float, column: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """Add ``base`` (the fixed patterns') and ``spans`` (all): sorted arrays of (start, kind, end), kind by place in KINDS."""
    text = text_of(column)
    always = lambda m: F.lit(True)
    fixed = F.concat(
        _spans(text, ASSIGN, 0, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
        _spans(text, ACCESS, 1, always),
        _spans(text, HEX, 2, always),
    )
    markov = _spans(text, CANDIDATE, 3, lambda m: ratio(m, model) > F.lit(limit))
    own = fresh(df, "_markov")
    found = df.withColumns({own: markov, base: F.array_sort(fixed)})
    return found.withColumn(spans, F.array_sort(F.concat(base, own))).drop(own)


def rendered(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span (those that overlap an earlier one joined to it) masked."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.when(fresh, F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))


def trained(spark: SparkSession, samples: DataFrame | None = None) -> tuple[list[int], float]:
    """The model, from most of the samples, and its limit, from the others."""
    samples = default_samples(spark) if samples is None else samples
    aside = F.pmod(F.xxhash64(F.lit(SEED), "text"), F.lit(ASIDE)) == 0
    model = fit(samples.where(~F.coalesce(aside, F.lit(False))))
    return model, threshold(samples.where(aside), model)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, *trained(spark))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    apart = F.filter("spans", lambda s: (s["kind"] == 3) & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(rendered(F.col("base")), 256).alias("base_sha256"),
        rendered(F.col("spans")).alias("spans"),
        count(3).alias("n_markov"),
        F.size(apart).cast("long").alias("n_markov_apart"),
    )


QUERIES = {"op2_secret_scan": op2_secret_scan}
ORACLE_SQL: dict[str, str] = {}
