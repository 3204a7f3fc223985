"""The pipeline's stages on odd tables: null texts, clashing columns, repeated rows, no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, flagged int, base string, spans string, packed int, key int, copies int, m int"
TEXTS = [None, "", "my token = abcdefghijkl0123 here", "one two three four five six seven", "one two three four five six seven", "x " * 40_000]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(3)], "doc_id long, quality int, toxic int")
    labels.limit(0).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 1 else "en", None if i == 2 else "s", 3, "sc", 1, "b", "sp", 2, 3, 4, 5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, *rows[2][1:])], SCHEMA)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, docs, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    made = stage(spark, docs, folder)
    rows = made.collect()
    if name != "bpe":
        assert made.columns == docs.columns
        assert {(r.score, r.flagged, r.base, r.spans, r.packed, r.key, r.copies, r.m) for r in rows} <= {("sc", 1, "b", "sp", 2, 3, 4, 5)}
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in rows)
    if name in ("secrets", "bpe"):
        assert ids == [-1, 0, 1, 2, 3, 3, 4, 5]
    if name == "near_copies":  # a document's rows stay together, the copy with the larger id goes
        assert ids == [-1, 0, 1, 2, 3, 3, 5]
    if name == "secrets":
        assert [r.text for r in rows if r.doc_id in (None, 2)] == ["my [SECRET] here"] * 2
    if name == "mixing":
        assert set(ids) >= {5} and max(ids.count(i) for i in ids if i not in (3,)) <= 2
    none = stage(spark, docs.limit(0), folder)
    assert none.columns == made.columns and none.where(F.lit(True)).count() == 0
