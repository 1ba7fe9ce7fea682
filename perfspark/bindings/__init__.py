"""Registered queries: each operator bound to the driver tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import body, identity, ingest, norms, retrieval, series, stock

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (series, norms, body, identity, stock, ingest, retrieval)


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
