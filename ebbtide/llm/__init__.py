"""Operators of a training-data pipeline; nothing else in the library imports this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import bpe, filteraudit, linededup, media, minhash, mixing, pii, secrets, sketches, toxicity, vectorcodes, warc, wrappers

_MODULES = (bpe, filteraudit, linededup, media, minhash, mixing, pii, secrets, sketches, toxicity, vectorcodes, warc, wrappers)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
