"""Registered queries over the driver's tables, each with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basetide.catalog import alignments, formats, intervals, segments, sites, trees
from basetide.catalog.common import ORACLES, QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


__all__ = ["alignments", "formats", "intervals", "oracle_sql", "queries", "segments", "sites", "trees"]
