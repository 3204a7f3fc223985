"""Cleaning of call transcripts, chats and complaints, as column expressions.

All functions take and give columns; nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words and character classes that the results depend on.
FILLERS = ("喂", "嗯", "啊", "那个", "那啥", "这个", "就是", "的话", "吧", "呢", "呀", "哦", "欸", "哈", "吗", "了", "嘛", "你好", "您好", "对", "诶", "哎")
CN_DIGITS = "零一二三四五六七八九十百千万亿〇壹贰叁肆伍陆柒捌玖拾佰仟"
PUNCTUATION = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~，。、；：？！…—·《》【】（）〈〉〔〕｛｝～﹏﹑﹔﹖﹗﹐﹒﹕﹔"""
LEADING = r",，.。;；:：!！?？、\-—…·"
GREETINGS = (
    "你好", "您好", "你好！", "您好！", "你好，请问有什么可以帮您？", "您好，请问有什么可以帮您？", "你好，有什么可以帮你的吗？", "您好，有什么可以帮你的吗？",
    "你好，请问有什么可以帮助您的？", "您好，请问有什么可以帮助您的？", "你好，我是智能助手，请问有什么可以帮您？", "您好，我是智能助手，请问有什么可以帮您？",
    "你好，欢迎咨询", "您好，欢迎咨询", "你好，欢迎咨询！", "您好，欢迎咨询！", "您好！很高兴为您服务", "你好！很高兴为您服务", "您好！很高兴为您服务！", "你好！很高兴为您服务！",
    "您好，很高兴为您服务", "你好，很高兴为您服务", "您好，很高兴为您服务！", "你好，很高兴为您服务！", "您好，请问您需要什么帮助？", "你好，请问你需要什么帮助？",
    "你好呀", "您好呀", "在吗", "在吗？", "在的", "在的亲", "亲，在的", "在呢", "嗯嗯", "好的", "好的呢", "好的哦", "收到", "嗯", "哦", "哈喽",
    "hello", "Hello", "hi", "Hi", "HI", "HELLO",
)

LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
CALL_HEADER = r"^【通话\d+(?U:\s)+[^】]*】$"
ANY_HEADER = r"^【(?:通话|会话|投诉)\d+(?U:\s)+[^】]*】$"
HEADER_TIME = r"【(?:投诉|通话|会话)\d+\s+(\d{4}-\d{2}-\d{2}\s+\d{1,2}:\d{1,2}:\d{1,2})】"
MAX_TURNS = 30


def stripped(text: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def lines_of(text: Column) -> Column:
    """The stripped lines that are not empty."""
    return F.filter(F.transform(F.split(text, LINE_BREAK), stripped), lambda x: x != "")


def none_as_empty(text: Column, *also: str) -> Column:
    """Null, blank and the words None and null are the empty text."""
    return F.when(text.isNull() | stripped(text).isin("", "None", "null", *also), F.lit("")).otherwise(text)


def only_punctuation(line: Column) -> Column:
    return line.rlike(rf"(?U)^[\s{PUNCTUATION}]+$")


def short_number(line: Column) -> Column:
    return line.rlike(rf"^[\p{{Nd}}{CN_DIGITS}]{{1,10}}$")


def folded_repeats(line: Column) -> Column:
    """Pieces of up to four characters that repeat are kept once, but for lines of digits."""
    return F.when(line.rlike(rf"^[\p{{Nd}}{CN_DIGITS}]+$"), line).otherwise(F.regexp_replace(line, r"(.{1,4})\1+", "$1"))


def without_adjacent(lines: Column) -> Column:
    """Lines that differ from the one before."""
    return F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))


_BLANK = r"\s\x1c-\x1f&&[^\n]"
_ENDS_OF_LINES = rf"(?Umd)^[{_BLANK}]+|[{_BLANK}]+$"


def _without_noise(text: Column, fillers: Iterable[str]) -> Column:
    """Lines of a text, in one pass a rule over the whole text; lines that are noise become empty."""
    words = "|".join(["呃+", *sorted(fillers, key=len, reverse=True)])
    digits = rf"[\p{{Nd}}{CN_DIGITS}]"
    for pattern, made in (
        (rf"(?md)^{digits}{{1,10}}$", ""),  # short numbers
        (words, ""),
        (rf"(?md)^({digits}+)$|(.{{1,4}})\2+", "$1$2"),  # repeats, but for lines of digits
        (rf"(?Umd)^[{LEADING}{_BLANK}]+", ""),
        (r"(?md)[。.]+$", ""),
        (_ENDS_OF_LINES, ""),
        (rf"(?Umd)^[{PUNCTUATION}{_BLANK}]+$", ""),
        (r"(?md)^[^\p{L}\p{N}\n]{1,2}$", ""),
    ):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(made))
    kept = F.filter(F.split(text, "\n"), lambda x: x != "")
    return F.element_at(F.transform(F.array(kept), without_adjacent), 1)


def denoised_lines(lines: Column, fillers: Iterable[str] = FILLERS) -> Column:
    return _without_noise(F.array_join(lines, "\n"), fillers)


def denoised(text: Column, fillers: Iterable[str] = FILLERS) -> Column:
    """Fillers, repeats, lines of marks or few digits, and adjacent equal lines are gone."""
    lines = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), LINE_BREAK, "\n"), F.lit(_ENDS_OF_LINES), F.lit(""))
    return F.array_join(_without_noise(lines, fillers), "\n")


def without_headers(text: Column) -> Column:
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~stripped(x).rlike(ANY_HEADER)), "\n")
    return F.when(text.contains("【"), kept).otherwise(text)


def chat_content(line: Column) -> Column:
    """What follows the sender's number, or the whole line."""
    return F.when(line.rlike(r"^\d+:"), stripped(F.regexp_replace(line, r"^\d+:(?U:\s)*", ""))).otherwise(line)


def chat_sender(line: Column) -> Column:
    return F.regexp_extract(line, r"^(\d+):", 1)


def clean_chat_lines(text: Column, greetings: Iterable[str] = GREETINGS) -> Column:
    """Lines that are no greeting, each once."""
    known = F.array(*[F.lit(g) for g in greetings])
    return F.array_distinct(F.filter(lines_of(text), lambda x: ~F.array_contains(known, chat_content(x))))


def turns_kept(lines: Column, most: int = MAX_TURNS) -> Column:
    """Contents of chat lines; of more than ``most`` turns (runs of one sender) the second to the last
    allowed.  Only the places where turns begin are looked for, so a long chat costs its length."""

    def cut(senders: Column) -> Column:
        begins = F.transform(senders, lambda x, i: F.when((i == 0) | ~x.eqNullSafe(F.get(senders, i - 1)), i))
        return F.filter(begins, lambda i: i.isNotNull())

    def kept(given: Column) -> Column:
        starts, said = given["starts"], F.transform(given["lines"], chat_content)
        first, end = F.get(starts, F.lit(1)), F.get(starts, F.lit(most))
        return F.when(F.size(starts) <= most, said).otherwise(F.slice(said, first + 1, end - first))

    starts = F.element_at(F.transform(F.array(F.transform(lines, chat_sender)), cut), 1)
    return F.element_at(F.transform(F.array(F.struct(lines.alias("lines"), starts.alias("starts"))), kept), 1)


def flat_chat(text: Column) -> Column:
    return F.array_join(denoised_lines(F.filter(turns_kept(clean_chat_lines(F.coalesce(text, F.lit("")))), lambda x: x != "")), "\n")


def _is_array(text: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY"), F.lit(False))


def _item_text(item: Column) -> Column:
    return stripped(F.coalesce(F.get_json_object(item, "$.text"), F.lit("")))


def _array_texts(text: Column, by_begin: bool) -> Column:
    items = F.filter(F.from_json(text, "array<string>"), lambda x: x.isNotNull())
    if by_begin:
        keyed = F.transform(items, lambda x, i: F.struct(F.coalesce(F.try_to_number(F.get_json_object(x, "$.begin"), F.lit("999999999999D999")).cast("double"), F.lit(0.0)).alias("b"), i.alias("i"), x.alias("x")))
        items = F.transform(F.array_sort(keyed), lambda k: k["x"])
    return F.filter(F.transform(items, _item_text), lambda x: x != "")


def _segment_texts(lines: Column) -> Column:
    """Texts of a call's lines: a JSON array, objects without brackets, or line by line."""
    joined = F.array_join(lines, "\n")
    wrapped = F.concat(F.lit("["), joined, F.lit("]"))

    def one(line: Column) -> Column:
        line = F.regexp_replace(line, r",+$", "")
        good = F.try_parse_json(line).isNotNull()
        return F.when(good, _item_text(line)).when(only_punctuation(line), F.lit("")).otherwise(line)

    each = F.filter(F.transform(lines, one), lambda x: x != "")
    return F.when(_is_array(joined), _array_texts(joined, False)).when(_is_array(wrapped), _array_texts(wrapped, False)).otherwise(each)


def flat_calls(text: Column) -> Column:
    """The words of a call transcript: one JSON array, or calls under header lines."""
    text = none_as_empty(text, "[]")
    lines = lines_of(text)
    at = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(CALL_HEADER), i)), lambda i: i.isNotNull())

    def segment(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(at, k + 1), F.size(lines))
        body = F.slice(lines, start + 2, stop - start - 1)
        texts = F.element_at(F.transform(F.array(body), _segment_texts), 1)
        return F.when((F.size(body) > 0) & (F.size(texts) > 0), F.concat(F.array(F.get(lines, start)), texts)).otherwise(F.array().cast("array<string>"))

    many = F.flatten(F.transform(at, segment))
    single = F.when(_is_array(text), _array_texts(text, True)).otherwise(lines)
    out = F.when(text.contains("【通话"), many).otherwise(single)
    return F.array_join(denoised_lines(F.flatten(F.transform(out, lines_of))), "\n")


def header_times(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HEADER_TIME), F.lit(1))


def earliest_plain(text: Column) -> Column:
    """The first of the header times in string order."""
    return F.array_min(header_times(text))


def earliest_padded(text: Column) -> Column:
    """The header time that is first once its parts are padded, as it is written."""
    def padded(x: Column) -> Column:
        part = lambda i: F.lpad(F.regexp_extract(x, r"(\d{1,2}):(\d{1,2}):(\d{1,2})$", i), 2, "0")
        return F.concat(F.substring(x, 1, 10), F.lit(" "), part(1), F.lit(":"), part(2), F.lit(":"), part(3))

    return F.array_min(F.transform(header_times(text), lambda x: F.struct(padded(x).alias("key"), x.alias("raw"))))["raw"]


def preview(text: Column, length: int = 120, empty: str = "-") -> Column:
    one = stripped(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    return F.when(one == "", F.lit(empty)).when(F.char_length(one) > length, F.concat(F.substring(one, 1, length), F.lit("…"))).otherwise(one)
