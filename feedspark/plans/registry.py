"""All queries of the library, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedspark.plans import compression, coverage, evidence, feeds, manifests, presence, revisions, shapes, verdicts, versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for module in (revisions, compression, presence, versions, coverage, shapes, evidence, manifests, verdicts, feeds):
    QUERIES |= module.QUERIES
    SQL |= module.SQL
