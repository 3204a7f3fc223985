"""PII: surrogates for detected entities, keyed and type-consistent.

Detection is one alternation of patterns per text: e-mail and IPv4 addresses, IBANs, social
security, telephone and card numbers, and persons' names (a given name of the lexicon, alone
or before a capitalised word, or titles before one or two capitalised words, or before one word
of a script without capitals; of Han, written without spaces, two to four characters).  An entity is a
type and a normal form: lower case for e-mail, digits for numbers (the last ten of a telephone
number, so that its country code makes no other number).  A name is its words: each given name
and each surname is an entity of its own, so "Peter Brown" and "Mr Brown" keep their surname
in common.

Surrogates are drawn from a keyed digest of type, normal form and attempt: digits become
digits (a valid card number stays valid, an octet an octet, a country code stays), letters
letters of the same script, case and kind (vowel or consonant; in scripts but Latin, Greek and
Cyrillic letters and marks of the same Unicode block).  No letter stays because its script is
unknown: those of other blocks become Latin ones.  Given names are permuted among those of
their gender and script, each to the next one of a circle whose order the key gives.  Of all other types distinct entities get distinct
surrogates, none of which is an entity of the corpus: in rounds, all but the first of those
that collide move to their next attempt, words growing longer now and then.  Numbers that
still collide after ``ROUNDS`` are of a type and length whose values are nearly used up; all
entities of that type and length are then permuted in an order by the key, so they stay
distinct though their surrogates are other entities' values.  The table of entities is all
that is shuffled, with a row per word of an occurrence joined to it; texts move only if they
have an entity.

Edge cases: null is the empty text; texts without entities stay as they are; repeated rows
get equal results; rows of equal or null id are told apart by their text; an empty table stays
empty; other columns pass through, whatever their names, but for ``n_entities`` and
``entities``, which are replaced.
"""

from __future__ import annotations

import hashlib
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import if_small, table, text_of, written
from ebbtide.llm.sketches import _next_bucket

ROUNDS = 24
#: Words grow by a letter after so many attempts.
GROWS = 4

#: Given names by (script, gender); the lexicon finds names and supplies their surrogates.
GIVEN = {
    ("latin", "f"): "Anna Maria Sofia Laura Julia Clara Elena Marie Emma Lucia Sarah Alice Helen Ingrid Carmen Monika Jane Emily Hannah Susan Katharina Birgit Giulia Chiara Isabel Pilar Camille Amélie Margaret Elizabeth Rebecca Ursula",
    ("latin", "m"): "Thomas Peter Michael David Daniel Paul Martin Lucas Robert Hans Pierre Carlos Miguel Stefan Henri Oliver John James William George Andrew Matthew Joseph Anthony Kevin Jürgen Wolfgang Marco Antonio José Javier Philippe",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил",
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία",
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας",
}
TITLES = "Mrs|Ms|Miss|Frau|Mme|Señora|Mr|Herr|Monsieur|Señor|Dr|Prof"

_NAMES = "|".join(n for names in GIVEN.values() for n in names.split())
_CAP = r"(?:\p{Lu}\p{L}+|\p{Lu}['’]\p{Lu}\p{L}+)(?:-\p{Lu}\p{L}+)*"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
IBAN = r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])"
PHONE = r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d.-])(?:\d{3}[ .-])?\d{3}-\d{4}(?![\d-])"
_LAST = rf"(?: (?!(?:{TITLES})\b){_CAP})?"
_TITLED = rf"(?:(?:{TITLES})\.? ){{1,2}}"
#: A word of a script that has neither capitals nor words run together; or of Han.
_CASELESS = r"(?:[\p{Lo}\p{IsGeorgian}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]][\p{Lo}\p{IsGeorgian}\p{M}]+|\p{IsHan}{2,4}(?!\p{L})|\p{IsHan}{2,3})"
PERSON = rf"(?<!\p{{L}})(?:(?:{_TITLED}{_CAP}{_LAST}|(?:{_NAMES}){_LAST})(?!\p{{L}})|{_TITLED}{_CASELESS})"
TYPES = {"email": EMAIL, "ipv4": IPV4, "iban": IBAN, "ssn": SSN, "card": CARD, "phone": PHONE, "person": PERSON}
# Looking ahead at one character first keeps the search from trying every pattern everywhere.
PATTERN = rf"{EMAIL}|(?=[\d+(])(?:{IPV4}|{SSN}|{CARD}|{PHONE})|(?=\p{{Lu}})(?:{IBAN}|{PERSON})"
_NAME_WORDS = [*_NAMES.split("|"), *TITLES.split("|")]
_NAMED = "[A-ZΑ-ΩА-Я](?:" + "|".join(f"(?<={c})(?:{'|'.join(w[1:] for w in _NAME_WORDS if w[0] == c)})" for c in sorted({w[0] for w in _NAME_WORDS})) + ")"


def maybe(text: Column) -> Column:
    """A cheap test that every text with an entity passes: a sign, a digit, or a known name or
    title (a capital first, as most characters are none)."""
    return text.contains("@") | text.rlike("[0-9]") | text.rlike(_NAMED)


def type_of(raw: Column) -> Column:
    out = F.lit("person")
    for name in reversed([t for t in TYPES if t != "person"]):
        out = F.when(raw.rlike(f"^(?:{TYPES[name]})$"), F.lit(name)).otherwise(out)
    return out


def normal_form(kind: Column, raw: Column) -> Column:
    digits = F.regexp_replace(raw, r"\D", "")
    return (
        F.when(kind == "phone", F.right(digits, F.lit(10)))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind == "ipv4", raw)
        .otherwise(F.lower(raw))
    )


def _stream(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """128 hexadecimal digits from the key, the entity and the attempt."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, norm, attempt), 512)


def _byte(stream: Column, i: Column | int) -> Column:
    """A number from the stream: two hexadecimal digits, by place, wrapping around."""
    at = (F.pmod(i if isinstance(i, Column) else F.lit(i), F.lit(63)) * 2 + 1).cast("int")
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


#: Letters by script and kind, and the ranges whose other letters (with marks) become vowels.
_ALPHABETS = (
    ("bcdfghjklmnpqrstvwxz", "aeiouy", ("Àɏ", "Ḁỿ")),
    ("бвгджзйклмнпрстфхцчшщьъ", "аеиоуыэюя", ("Ѐԯ",)),
    ("βγδζθκλμνξπρστφχψ", "αεηιουω", ("Ͱ\u03ff", "ἀ\u1fff")),
)
#: First and last code points of other scripts, whose letters are drawn from their own block.
_BLOCKS = (
    (0x530, 0x58F), (0x590, 0x5FF), (0x600, 0x6FF), (0x700, 0x74F),  # Armenian, Hebrew, Arabic, Syriac
    *((at, at + 0x7F) for at in range(0x900, 0xF00, 0x80)),  # Devanagari to Lao, a script each
    (0xF00, 0xFFF), (0x1000, 0x109F), (0x10A0, 0x10FF), (0x1100, 0x11FF), (0x1200, 0x137F),  # Tibetan, Myanmar, Georgian, Jamo, Ethiopic
    (0x1780, 0x17FF), (0x1800, 0x18AF), (0x3041, 0x309F), (0x30A0, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3),  # Khmer, Mongolian, Kana, Han, Hangul
)
#: So many letters of a block are drawn from, spread over it.
_DRAWN = 200


def _letters_of(first: int, last: int, category: str) -> str:
    """The block's letters of a Unicode category, thinned evenly to at most _DRAWN."""
    found = [chr(c) for c in range(first, last + 1) if unicodedata.category(chr(c)).startswith(category)]
    return "".join(found[:: -(-len(found) // _DRAWN) or 1])


#: For each block and category: the category's last letter, the block's ends, the letters drawn from.
_DRAWS = " ".join(
    c[-1].lower() + chr(first) + chr(last) + _letters_of(first, last, c) for first, last in _BLOCKS for c in ("Lu", "Ll", "Lo", "M") if _letters_of(first, last, c)
)


def _alike(char: Column, n: Column) -> Column:
    """A character of the same class as char, chosen by n."""
    draw = lambda letters: F.substring(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
    out = F.when(char.between("0", "9"), draw("0123456789"))
    for consonants, vowels, ranges in _ALPHABETS:
        for change in (str.lower, str.upper):
            out = out.when(F.lit(change(consonants)).contains(char), draw(change(consonants)))
            out = out.when(F.lit(change(vowels)).contains(char), draw(change(vowels)))
        for first, last in ranges:
            marked = char.between(first, last) & char.rlike(r"^\p{L}$")
            out = out.when(marked, F.when(char != F.lower(char), draw(vowels.upper())).otherwise(draw(vowels)))
    at = lambda b, i: F.substring(b, F.lit(i), F.lit(1))
    category = F.when(char.rlike(r"^\p{Lu}$"), "u").when(char.rlike(r"^\p{Ll}$"), "l").when(char.rlike(r"^\p{Lo}$"), "o").otherwise("m")
    own = F.filter(F.split(F.lit(_DRAWS), " "), lambda b: char.between(at(b, 2), at(b, 3)) & (at(b, 1) == category))
    drawn = F.get(F.transform(own, lambda b: F.substring(b, F.pmod(n, F.char_length(b) - 3) + 4, F.lit(1))), F.lit(0))
    latin = "".join(_ALPHABETS[0][:2])
    other = F.when(category == "u", draw(latin.upper())).when(char.rlike(r"^\p{L}$"), draw(latin)).otherwise(char)
    return out.when(char.rlike(r"^[\p{L}\p{M}]$"), F.coalesce(drawn, other)).otherwise(char)


def _letters_alike(text: Column, stream: Column) -> Column:
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: _alike(c, _byte(stream, i))), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn's sum, each second digit from the right but one doubled."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + F.pmod(i, F.lit(2)))
        return F.when(d > 9, d - 9).otherwise(d)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, b: a + b)


def _card(norm: Column, stream: Column) -> Column:
    drawn = F.concat(F.substring(norm, F.lit(1), F.lit(1)), _letters_alike(F.substring(norm, F.lit(2), F.char_length(norm)), stream))
    open_ = F.concat(F.substring(drawn, F.lit(1), F.char_length(drawn) - 1), F.lit("0"))
    valid = F.concat(F.substring(drawn, F.lit(1), F.char_length(drawn) - 1), F.pmod(10 - F.pmod(_luhn_sum(open_), F.lit(10)), F.lit(10)).cast("string"))
    return F.when(F.pmod(_luhn_sum(norm), F.lit(10)) == 0, valid).otherwise(drawn)


def _ipv4(stream: Column) -> Column:
    return F.concat_ws(".", 1 + F.pmod(_byte(stream, 0), F.lit(223)), _byte(stream, 1), _byte(stream, 2), 1 + F.pmod(_byte(stream, 3), F.lit(254)))


def _email(norm: Column, stream: Column, attempt: Column) -> Column:
    """Letters and digits change, up to the top-level domain, which stays."""
    head, tail = F.regexp_extract(norm, r"^(.*)(\.[a-z]+)$", 1), F.regexp_extract(norm, r"^(.*)(\.[a-z]+)$", 2)
    return F.concat(_word(head, stream, attempt), tail)


def _given(key: str, norm: Column) -> Column:
    """Another given name of the same gender and script: the next of a circle in an order by the
    key, which may be any circle through the list, so one name's surrogate tells of no other's."""
    out = norm
    for kind, names in GIVEN.items():
        own = [n.lower() for n in names.split()]
        own.sort(key=lambda n, kind=kind: hashlib.sha256(f"{key}\1{kind}\1{n}".encode()).digest())
        turned = F.element_at(F.array(*[F.lit(n) for n in own[1:] + own[:1]]), F.greatest(F.array_position(F.array(*[F.lit(n) for n in own]), norm), F.lit(1)).cast("int"))
        out = F.when(norm.isin(own), turned).otherwise(out)
    return out


def _word(norm: Column, stream: Column, attempt: Column) -> Column:
    """A word alike, with more letters of its last one's script after some attempts."""
    longer = F.rpad(norm, (F.char_length(norm) + F.floor(attempt / GROWS)).cast("int"), F.right(norm, F.lit(1)))
    return _letters_alike(longer, stream)


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    stream = _stream(key, kind, norm, attempt)
    iban = F.concat(F.substring(norm, F.lit(1), F.lit(2)), _letters_alike(F.substring(norm, F.lit(3), F.char_length(norm)), stream))
    return (
        F.when(kind == "email", _email(norm, stream, attempt))
        .when(kind == "ipv4", _ipv4(stream))
        .when(kind == "card", _card(norm, stream))
        .when(kind == "iban", iban)
        .when(kind == "given", _given(key, norm))
        .when(kind == "surname", _word(norm, stream, attempt))
        .otherwise(_letters_alike(norm, stream))
    )


def formatted(kind: Column, raw: Column, made: Column) -> Column:
    """The surrogate in the raw entity's spelling: its separators, its case."""
    chars = F.filter(F.split(raw, ""), lambda c: c != "")
    digits = F.regexp_replace(raw, r"\D", "")
    made = F.when(kind == "phone", F.concat(F.left(digits, F.greatest(F.char_length(digits) - 10, F.lit(0))), made)).otherwise(made)
    zero = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        own = F.when(kind == "iban", c != " ").otherwise(c.rlike(r"^\d$"))
        return F.struct(
            F.when(own, acc["at"] + 1).otherwise(acc["at"]).alias("at"),
            F.concat(acc["out"], F.when(own, F.substring(made, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
        )

    numeric = F.aggregate(chars, zero, step, lambda acc: acc["out"])
    cased = F.when((raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(made)).when(kind.isin("given", "surname") & (raw != F.lower(raw)), F.initcap(made)).otherwise(made)
    return F.when(kind.isin("phone", "card", "ssn", "iban"), numeric).when(kind.isin("email", "given", "surname"), cased).when(kind == "title", raw).otherwise(made)


def surrogates(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, norm, made) for distinct entities (kind, norm), all of ``made`` distinct by kind
    and, but for given names and used-up numbers, none of them an entity itself."""
    taken = entities.select("kind", F.col("norm").alias("made"), F.lit(True).alias("real"))
    state = entities.withColumn("attempt", F.lit(0))
    at = 0
    while True:
        state = written(state.withColumn("made", surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))))
        order = Window.partitionBy("kind", "made").orderBy("norm")
        checked = state.join(taken, ["kind", "made"], "left").withColumn("place", F.row_number().over(order))
        collides = (F.col("kind") != "given") & (F.col("real").isNotNull() | (F.col("place") > 1))
        checked = written(checked.withColumn("attempt", F.col("attempt") + collides.cast("int")).withColumn("moved", collides).drop("real", "place"))
        at += 1
        words = F.col("kind").isin("email", "surname")
        if not checked.where(F.col("moved") & (words | F.lit(at < rounds))).limit(1).count():
            break
        state = checked.drop("made", "moved")
    shape = F.char_length("norm").alias("length")
    full = checked.where("moved").select("kind", shape).distinct()
    if not full.limit(1).count():
        return checked.select("kind", "norm", "made")
    full = written(full)
    used_up = checked.withColumn("length", F.char_length("norm")).join(F.broadcast(full), ["kind", "length"])  # some dozens of types and lengths
    turned = used_up.select(F.struct("kind", "length", F.xxhash64(F.lit(key), "norm").alias("h"), "norm").alias("b"))
    firsts = turned.groupBy("b.kind", "b.length").agg(F.min("b").alias("first"))
    turned = _next_bucket(turned).select("b.kind", "b.length", "b.norm", "after").join(F.broadcast(firsts), ["kind", "length"])
    same = (F.col("after.kind") == F.col("kind")) & (F.col("after.length") == F.col("length"))
    turned = turned.select("kind", "norm", F.when(same, F.col("after.norm")).otherwise(F.col("first.norm")).alias("made"))
    others = checked.withColumn("length", F.char_length("norm")).join(F.broadcast(full), ["kind", "length"], "left_anti")
    return others.select("kind", "norm", "made").unionByName(turned)


def _pieces(kind: Column, raw: Column) -> Column:
    """The entities of an occurrence: a name's words, or the occurrence itself."""
    one = lambda k, r: F.struct(k.alias("kind"), r.alias("raw"))
    given = F.array(*[F.lit(n.lower()) for names in GIVEN.values() for n in names.split()])
    of_word = lambda w: F.when(w.rlike(rf"^(?:{TITLES})\.?$"), F.lit("title")).when(F.array_contains(given, F.lower(w)), F.lit("given")).otherwise(F.lit("surname"))
    return F.when(kind == "person", F.transform(F.split(raw, " "), lambda w: one(of_word(w), w))).otherwise(F.array(one(kind, raw)))


def with_surrogates(df: DataFrame, key: str, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Replace entities in a text column; adds ``n_entities`` and ``entities`` (kind:start:end,
    in code points of the text as it was).  key: a secret that surrogates follow from."""
    kept = [c for c in df.columns if c not in ("n_entities", "entities")]
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("of"), F.col(id_column).alias("id"), text_of(column).alias("text"))
    has = maybe(F.col("text")) & F.col("text").rlike(PATTERN)
    clean = docs.where(~has).select("of", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entities"))
    hit = written(docs.where(has).withColumn("tie", F.xxhash64("text")))
    found = hit.select("id", "tie", F.posexplode(F.regexp_extract_all(F.col("text"), F.lit(PATTERN), F.lit(0))).alias("at", "raw")).distinct()
    found = found.withColumn("type", type_of(F.col("raw")))
    found = found.select("id", "tie", "at", "raw", "type", F.posexplode(_pieces(F.col("type"), F.col("raw"))).alias("place", "piece"))
    found = found.withColumns({"kind": F.col("piece.kind"), "norm": normal_form(F.col("piece.kind"), F.col("piece.raw"))})
    found = written(found)
    made = written(surrogates(found.where("kind <> 'title'").select("kind", "norm").distinct(), key))
    said = found.join(if_small(made), ["kind", "norm"], "left").withColumn("new", formatted(F.col("kind"), F.col("piece.raw"), F.col("made")))
    said = said.groupBy("id", "tie", "at", "raw", "type").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("words"))
    said = said.select("id", "tie", F.struct("at", "raw", F.array_join(F.transform("words", lambda w: w["new"]), " ").alias("new"), F.col("type").alias("kind")).alias("x"))
    by_doc = said.groupBy(F.col("id").alias("own"), F.col("tie").alias("own_tie")).agg(F.array_sort(F.collect_list("x")).alias("found"))
    joined = hit.join(by_doc, F.col("id").eqNullSafe(F.col("own")) & (F.col("tie") == F.col("own_tie")))
    gaps = F.split(F.col("text"), PATTERN)
    pieces = F.transform("found", lambda x, i: F.concat(F.element_at(gaps, (i + 1).cast("int")), x["new"]))
    rebuilt = F.concat(F.array_join(pieces, ""), F.element_at(gaps, -1))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.element_at("lengths", x["at"] + 1)
        end = start + F.char_length(x["raw"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.concat_ws(":", x["kind"], start, end))).alias("out"))

    spans = F.aggregate("found", zero, step, lambda acc: F.array_join(acc["out"], ","))
    done = joined.withColumn("lengths", F.transform(gaps, lambda g: F.char_length(g)))
    done = done.select("of", rebuilt.alias("text"), F.size("found").cast("long").alias("n_entities"), spans.alias("entities"))
    own = [F.col("text").alias(c) if c == column else F.col("of").getField(c).alias(c) for c in kept]
    return done.unionByName(clean).select(*own, "n_entities", "entities")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the key of a public example; a real one comes from a secret store
    return with_surrogates(docs, key="ebbtide-example").select("doc_id", "n_entities", "entities", "text")


QUERIES = {"op3_pii_surrogates": op3_pii_surrogates}
ORACLE_SQL: dict[str, str] = {}
