"""Flattening of nested snapshots to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_outer_rows(df: DataFrame, items: str, fields: list[str], ordinal: str, sequence: str | None = None, fallback: str = "fallback_index") -> DataFrame:
    """One row for each item, one with nulls for an empty list; its ordinal from 0; the ordinal again where the item has no sequence."""
    out = df.select("*", F.posexplode_outer(items).alias(ordinal, "_item")).drop(items)
    out = out.withColumns({f: F.col(f"_item.{f}") for f in fields}).drop("_item")
    if sequence:
        out = out.withColumn(fallback, F.when(F.col(ordinal).isNotNull() & F.col(sequence).isNull(), F.col(ordinal)))
    return out


def canonical_json(value: Column, keep_nulls: bool = True) -> Column:
    """Compact JSON; the struct's fields must be declared in sorted order. An empty list is '[]'."""
    return F.to_json(value, {"ignoreNullFields": "false" if keep_nulls else "true"})


def content_digest(df: DataFrame, poll: list[str], entity: str) -> DataFrame:
    """SHA-256 over the poll's entities, each with its length in 8 bytes, in sorted order: independent of their order in the poll."""
    raw = F.col(entity).cast("binary")
    framed = F.transform(F.array_sort(F.collect_list(raw)), lambda x: F.concat(F.lpad(F.hex(F.octet_length(x)), 16, "0"), F.hex(x)))
    return df.groupBy(*poll).agg(F.sha2(F.unhex(F.array_join(framed, "")), 256).alias("digest"), F.count(F.lit(1)).alias("n_entities"))
