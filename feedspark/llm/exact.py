"""Exact dedup with a split of the heavy hitters. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import filter_rows, fresh, materialize, order_id, table, text_of

#: A digest in more than this share of the rows is surely among the candidates, of which there are at most 1 / SUPPORT.
SUPPORT = 1 / 2000


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, twin, text_sha256, n_chars, text_key.

    Texts are equal when they are identical without white space; the longest original stays,
    then the smallest identifier (null last), then one row of those that repeat both.

    1. A narrow table of digests is written once.
    2. Misra-Gries (``freqItems``) finds candidates for frequent digests: a bounded number,
       none of the truly frequent ones missing. One exact count over the candidates verifies
       them and finds the winner of each.
    3. The verified winners are broadcast (1 / support rows at most) and settle the rows of
       frequent digests where they are, without a shuffle.
    4. The remaining digests are grouped by an ordinary shuffle.

    ``twin`` marks a row that goes although it repeats identifier and text of the one that stays.
    Null text counts as empty. Very long texts are hashed whole, where they are. Null
    identifiers sort last and stay null. Empty table: no rows. Other columns are not read."""
    text = text_of(text_col)
    digests = materialize(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), order_id(id_col).alias("_o"), F.sha2(normalized(text), 256).alias("text_sha256"), F.char_length(text).cast("long").alias("n_chars"), F.xxhash64(text).alias("text_key")).withColumn("_r", F.monotonically_increasing_id())
    )
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("_o").alias("o"), F.col("_r").alias("r"), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("k"))).alias("_w")
    size = F.count(F.lit(1)).alias("group_size")
    candidates = digests.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    counted = digests.join(F.broadcast(candidates), "text_sha256", "left_semi").groupBy("text_sha256").agg(size, best)
    heavy = materialize(counted.filter(F.col("group_size") > 1))
    frequent = digests.join(F.broadcast(heavy), "text_sha256")
    rest = digests.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    grouped = rest.groupBy("text_sha256").agg(size, best)
    both = frequent.unionByName(rest.join(grouped, "text_sha256"))
    kept = F.col("_r") == F.col("_w.r")
    twin = ~kept & (F.col("_o") == F.col("_w.o")) & (F.col("text_key") == F.col("_w.k"))
    return both.select("doc_id", F.col("_w.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), twin.alias("twin"), "text_sha256", "n_chars", "text_key")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group.

    Rows are dropped by the narrow keys of those that go (an anti join, see ``filter_rows``), so
    texts are not shuffled. Of rows that repeat identifier and text both, one comes back. Null
    and empty texts are one group; an empty table stays empty."""
    gone = materialize(exact_duplicates(docs, id_col, text_col).filter("not kept").select("doc_id", "text_key", "twin"))
    rows = filter_rows(docs, gone, "left_anti", id_col, text_col)
    twins = gone.filter("twin")
    if twins.isEmpty():
        return rows
    o, k = fresh(docs, "_order_id", "_text_key")
    repeated = filter_rows(docs, twins, "left_semi", id_col, text_col).withColumns({o: order_id(id_col), k: F.xxhash64(text_of(text_col))})
    return rows.unionByName(repeated.dropDuplicates([o, k]).drop(o, k))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm, length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
