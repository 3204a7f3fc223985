"""Filter audit, product codes and line dedup, beside brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from ebbtide import llm
from ebbtide.llm import filteraudit, linededup, vectorcodes

SPACES = " \t\n\x0b\x0c\r"


def folded(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACES))


def lines_by_hand(rows, least=linededup.MIN_DOCS):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(folded(line)) >= linededup.MIN_CHARS:
                holders[folded(line)].add(doc)
    order = lambda d: (d is not None, d or 0)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [len(holders.get(folded(x), ())) >= least and max(holders[folded(x)], key=order) != doc for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(5)
    shared = [f"  Passage Éclair number {i} that is found in many of the documents {'x' * i}\t" for i in range(12)]
    rows = []
    for i in range(300):
        lines = [f"own line {i} {j} which is long enough to be looked at by the rule" for j in range(3)] + ["short", ""]
        lines += rng.sample(shared, rng.randint(0, 3)) + [shared[0].upper().replace("É", "é")] * rng.randint(0, 2) + ["y" * 39, "z" * 40]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, shared[5] * 2000), (304, "z" * 40 + "\r\n" + "Z" * 40), (None, "z" * 40 + "\nmore"), (7, "z" * 40 + "\nanother text of this id")]
    return [*rows, rows[3]]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_line_dedup_by_hand(spark, partitions):
    rows = line_rows()
    df = spark.createDataFrame([(d, t, 1, "b") for d, t in rows], "doc_id long, text string, _of int, bitmap string").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the hot line is cut into many ranges
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if partitions == 4 else "1000")
    try:
        got = linededup.deduplicated(df)
        assert got.columns == ["doc_id", "text", "_of", "bitmap", "n_lines", "n_dropped", "kept"]
        found = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()], key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == lines_by_hand(rows)
    assert sum(x[2] for x in found) > 300


def test_line_dedup_of_other_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.deduplicated(empty).count() == 0
    names = spark.createDataFrame([(f"d{i}", "q" * 50 + "\nx") for i in range(6)], "id string, body string")
    got = {r.id: r.kept for r in linededup.deduplicated(names, "id", "body").collect()}
    assert got == {f"d{i}": "x" for i in range(5)} | {"d5": "q" * 50 + "\nx"}
    bits = linededup.unpacked(linededup.packed(np.array([0, 9])))
    assert list(np.flatnonzero(~bits)) == [0, 9] and linededup.kept_text("a\nb", linededup.packed(np.array([0, 1]))) == ""


def nearest_by_hand(points, entries):
    gaps = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in points]
    return [g.index(min(g)) for g in gaps], [min(g) for g in gaps]


@pytest.mark.parametrize("entries", [1, 2, 7, 64])
def test_orchard_finds_the_nearest(entries):
    rng = np.random.default_rng(entries)
    for spread in (2, 40, 300):  # few values: many ties and equal entries
        book = vectorcodes.Book.of(rng.integers(-spread, spread, (entries, 4)))
        points = rng.integers(-spread, spread, (500, 4))
        code, far = book.nearest(points)
        assert (list(code), list(far)) == nearest_by_hand(points, book.entries)


def codes_by_hand(rows, parts, entries):
    whole = sorted((i, [int(np.floor(np.float64(x) * 256)) for x in v], label) for i, v, label in rows)
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]
    for _ in range(2):
        for p, book in enumerate(books):
            points = [cut(v, p) for _, v, _ in whole]
            code, _ = nearest_by_hand(points, book)
            members = [[x for x, c in zip(points, code, strict=True) if c == e] for e in range(len(book))]
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else book[e] for e, m in enumerate(members)]
    out = []
    for i, v, _ in whole:
        found = [nearest_by_hand([cut(v, p)], book) for p, book in enumerate(books)]
        out.append((i, "".join(f"{c[0]:02x}" for c, _ in found), sum(d[0] for _, d in found)))
    return sorted(out), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vector_rows(n, size, seed):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, size)], int(i) % 3 or None) for i in rng.permutation(n)]


@pytest.mark.parametrize(("n", "parts", "size"), [(150, 16, 64), (40, 16, 16), (90, 2, 6)])
def test_codes_by_hand(spark, n, parts, size):
    rows = vector_rows(n, size, n)
    rows += [(r[0], r[1], r[2]) for r in rows[:5]]  # repeated rows
    odd = [(-5, None, 1), (-4, [None] * size, 1), (-3, [float("nan")] * size, 1), (-2, [float("inf")] * size, 1), (-1, [], 2), (n + 9, [0.5] * (size + 1), 2), (n + 10, [0.5] * (2 * size), 2)]
    df = spark.createDataFrame([(*r, "c") for r in rows + odd], "vec_id long, embedding array<float>, label int, code string").repartition(3)
    got, books = vectorcodes.compressed(df, parts=parts)
    assert got.columns == ["vec_id", "embedding", "label", "code", "code_", "error"]
    codes, digest = codes_by_hand(rows, parts, 64)
    assert sorted((r.vec_id, r.code_, r.error) for r in got.collect()) == codes
    assert vectorcodes.books_sha256(books) == digest


def test_codes_query_and_edges(spark, tmp_path):
    rows = vector_rows(80, 32, 1)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = llm.queries()["op12_vector_codes"](spark, str(tmp_path)).collect()
    codes, digest = codes_by_hand(rows, 16, 64)
    labels = {i: label for i, _, label in rows}
    of_label = Counter()
    for i, _, error in codes:
        of_label[labels[i]] += error
    assert sorted(tuple(r) for r in got) == [(i, c, e, of_label[labels[i]], digest) for i, c, e in codes]
    empty, books = vectorcodes.compressed(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>"))
    assert empty.count() == 0 and books == [] and empty.columns == ["vec_id", "embedding", "code", "error"]
    large = spark.createDataFrame([(1, [1e30] * 16)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="larger than"):
        vectorcodes.compressed(large)


def audit_by_hand(docs, labels):
    good, toxic = ({d for d, *v in labels if v[i] == 1 and d is not None} for i in (0, 1))
    smallest = {}
    for doc, text, _ in docs:
        if doc is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc), doc)
    rows = []
    for doc, text, part in docs:
        t = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), doc is not None and smallest[t] < doc)
        rows.append((part or "", {f for f, x in zip("ABCDE", fails, strict=True) if x}, doc in good, doc in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        removed_by, own = Counter(), {}
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in rows if r[0] == part and f in r[1]]
                removed_by[f] += len(gone)
                own[part, "".join(order), step + 1] = (len(left), len(gone), len(failing) - len(gone), sum(len(r[1]) == 1 for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone), f)
        out |= {k: (*v[:6], removed_by[v[6]]) for k, v in own.items()}
    return out


def audit_rows():
    rng = random.Random(9)
    texts = [None, "", " \n", "A B C", "word " * 250, "a # b", "É" * 50 + "ABC", *[" ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([50, 220]))) + rng.choice(["", " $", " LOUD" * 9]) for _ in range(25)]]
    docs = [(i, rng.choice(texts) if i % 3 else texts[8], rng.choice(["en", "de", None])) for i in range(240)]
    docs += [(5, docs[5][1], "de"), (None, texts[8], "en"), (None, texts[8], "en"), docs[7]]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None])) for i in range(0, 240, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("backwards", [True, False])
def test_filter_audit_by_hand(spark, tmp_path, backwards):
    """Small ids last: each micro-batch retracts what the earlier ones counted."""
    docs, labels = audit_rows()
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    parts = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0), reverse=backwards)
    for i in range(8):
        spark.createDataFrame([(*r, 1) for r in parts[i * 31 : (i + 1) * 31]], "doc_id long, text string, lang string, mask int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    got = llm.queries()["op11_filter_audit"](spark, str(tmp_path))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert found == audit_by_hand(docs, labels) and len(found) == 3 * 600


def test_filter_audit_retracts(spark):
    fields = "key binary, known boolean, part string, mask int, good boolean, toxic boolean, first long, at_first long, n long"
    first = spark.createDataFrame([(b"k", True, "en", 1, True, False, 9, 1, 3)], fields)
    state = filteraudit.fates(first, None)
    assert [(r.holds, r.plain, r.copies) for r in state.collect()] == [(True, 1, 2)]
    later = filteraudit.fates(spark.createDataFrame([(b"k", True, "de", 1, False, False, 4, 1, 1)], fields), state.where("holds"))
    assert sorted((r.part, r.holds, r.plain, r.copies) for r in later.collect()) == [("de", True, 1, 0), ("en", False, -1, 1)]
    larger = filteraudit.fates(spark.createDataFrame([(b"k", True, "de", 1, False, False, 11, 1, 2)], fields), state.where("holds"))
    assert [(r.part, r.holds, r.plain, r.copies) for r in larger.collect()] == [("de", False, 0, 2)]


def test_filter_audit_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert llm.queries()["op11_filter_audit"](spark, str(tmp_path)).count() == 0
