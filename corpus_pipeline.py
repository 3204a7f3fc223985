"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
in the shared folder and read again as the next stage's docs.  All but the last return the
columns of documents.  Belongs to the subpackage ``ebbtide.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, minhash, mixing, secrets, toxicity
from ebbtide.llm.common import fresh, table, text_of, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at or above their language's threshold go."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    names = {n: fresh(docs, n) for n in ("score", "lang_threshold", "flagged")}
    return toxicity.with_scores(docs, model, **names).where(~F.col(names["flagged"])).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of smallest id stays."""
    return minhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; all documents stay, and n_chars follows the text."""
    base, spans = fresh(docs, "base"), fresh(docs, "spans")
    found = secrets.with_spans(docs, *secrets.trained(spark), base=base, spans=spans)
    found = found.withColumn("text", F.when(F.size(spans) > 0, secrets.masked(text_of(), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, their number, and a digest of their decoding."""
    ranks = bpe.vocabulary()
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, ranks)
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_bpe),
]

#: SQL can express neither the trained models nor the merges of the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
