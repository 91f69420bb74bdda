"""All queries of the ingestion and curation operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curation, extraction, flagship, scalars, streams, texts

BOOKS = [flagship.book, scalars.book, extraction.book, curation.book, streams.book, texts.book]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for b in BOOKS for k, f in b.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for b in BOOKS for k, q in b.oracles.items()}
