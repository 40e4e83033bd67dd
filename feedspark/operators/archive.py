"""Archive decisions: reconciliation, backlog, classification, eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedspark.operators.coverage import flag_list


def reconcile(expected: DataFrame, observed: DataFrame, path: str = "path", size: str = "size", checksum: str = "sha256") -> DataFrame:
    """Status of every path: match, missing, unexpected, size_mismatch, checksum_unavailable or sha256_mismatch."""
    a = expected.select(path, F.col(size).alias("_es"), F.col(checksum).alias("_ec"), F.lit(True).alias("_e"))
    b = observed.select(path, F.col(size).alias("_os"), F.col(checksum).alias("_oc"), F.lit(True).alias("_o"))
    status = (
        F.when(F.col("_o").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(~F.col("_es").eqNullSafe(F.col("_os")), "size_mismatch")
        .when(F.col("_ec").isNull() | F.col("_oc").isNull(), "checksum_unavailable").when(F.col("_ec") != F.col("_oc"), "sha256_mismatch").otherwise("match")
    )
    return a.join(b, path, "full_outer").select(path, status.alias("status"))


def pending(completed: DataFrame, *done: DataFrame, key: str = "date") -> DataFrame:
    """Keys that are completed and in none of the others."""
    out = completed.select(key).distinct()
    for d in done:
        out = out.join(d.select(key), key, "left_anti")
    return out


def oldest(backlog: DataFrame, n: int, key: str = "date") -> DataFrame:
    return backlog.orderBy(key).limit(n)


def extra_files(local: DataFrame, receipt: DataFrame, pruned: DataFrame, key: str = "path") -> DataFrame:
    """Local files that no receipt names, and receipted files that are gone without a prune plan."""
    unknown = local.select(key).join(receipt, key, "left_anti").withColumn("problem", F.lit("not_in_receipt"))
    gone = receipt.select(key).join(local, key, "left_anti").join(pruned, key, "left_anti").withColumn("problem", F.lit("gone_without_plan"))
    return unknown.unionByName(gone)


def inventory_rollup(files: DataFrame, date: str, size: str, problem: Column, complete: Column) -> DataFrame:
    """By date: files, bytes, problems, class."""
    got = files.groupBy(date).agg(F.count(F.lit(1)).alias("n_files"), F.sum(size).alias("bytes"), F.count(F.when(problem, 1)).alias("n_problems"), F.bool_and(F.coalesce(complete, F.lit(False))).alias("_complete"))
    kind = F.when(F.col("n_problems") > 0, "corrupt_or_missing").when(F.col("_complete"), "v2_complete").otherwise("legacy_present_but_completeness_unverifiable")
    return got.withColumn("class", kind).drop("_complete")


def eligibility(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``rules``: what must hold, by the reason for refusal; unknown refuses too."""
    out = df.withColumn("reasons", flag_list([(name, ~F.coalesce(cond, F.lit(False))) for name, cond in rules]))
    return out.withColumn("eligible", F.size("reasons") == 0)


def newest(backlog: DataFrame, n: int, key: str = "date") -> DataFrame:
    return backlog.orderBy(F.desc(key)).limit(n)


#: Days for which each kind is kept; 0 switches its retention off.
KEEP_DAYS = {"raw": 3, "parquet": 7}


def retention(days: DataFrame, artifacts: DataFrame, inventory: DataFrame, today: Column, repository: str, feeds: list[str], keep: dict[str, int] | None = None, planned: DataFrame | None = None) -> DataFrame:
    """(kind, date, eligible, reasons): whether a day's local files may go, and every reason why not.

    ``days``: date, version, repo_id, remote_verified, manifest_sha256, manifest_complete,
    pending_work; ``artifacts`` (of receipts): date, kind, feed, path, size, sha256;
    ``inventory`` (local): date, kind, feed, path, size, sha256; ``planned``: kind, date of
    deletions that were begun: only there may files be gone already."""
    keep = KEEP_DAYS if keep is None else keep
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(d).alias("keep")) for k, d in sorted(keep.items())]))
    own = artifacts.groupBy("date", "path").agg(F.count(F.lit(1)).alias("_times"), F.first("kind").alias("kind"), F.first("feed").alias("feed"), F.first("size").alias("size"), F.first("sha256").alias("sha256"))
    of_day = own.groupBy("date").agg(
        F.bool_and((F.col("_times") == 1) & (F.col("size") >= 0) & F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("_valid"),
        F.max(F.when(F.col("kind") == "manifest", F.col("sha256"))).alias("_manifest"),
    )
    by_feed = own.groupBy("date", "kind").agg(F.collect_set("feed").alias("_feeds"))
    local = inventory.select("date", "path", F.col("kind").alias("_lk"), F.col("size").alias("_ls"), F.col("sha256").alias("_lh"), F.lit(True).alias("_local"))
    files = own.filter(F.col("kind").isin(*keep)).join(local, ["date", "path"], "full_outer").withColumn("kind", F.coalesce("kind", "_lk"))
    state = files.groupBy("date", "kind").agg(
        F.count("_local").alias("_n_local"), F.count_if(F.col("_times").isNull()).alias("_extra"), F.count_if(F.col("_local").isNull()).alias("_gone"),
        F.count_if(F.col("_local") & F.col("_times").isNotNull() & ((F.col("size") != F.col("_ls")) | ~F.col("sha256").eqNullSafe(F.col("_lh")))).alias("_changed"),
    )
    begun = (planned.select("kind", "date").distinct().withColumn("_begun", F.lit(True))) if planned is not None else days.limit(0).select(F.lit("").alias("kind"), "date", F.lit(True).alias("_begun"))
    got = days.withColumn("_k", kinds).select("*", "_k.kind", "_k.keep").join(of_day, "date", "left").join(by_feed, ["date", "kind"], "left").join(state, ["date", "kind"], "left").join(begun, ["kind", "date"], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    rules = [
        ("retention_off", F.col("keep") > 0), ("too_recent", F.col("date") < F.date_sub(today, F.col("keep"))), ("nothing_local", n("_n_local") > 0),
        ("receipt_not_verified", (F.col("version") == 2) & F.col("remote_verified") & (F.col("repo_id") == repository)), ("receipt_artifacts_invalid", F.col("_valid")),
        ("manifest_not_authenticated", F.col("_manifest") == F.col("manifest_sha256")), ("manifest_incomplete", F.col("manifest_complete")),
        ("feeds_missing", F.size(F.array_except(F.array(*map(F.lit, feeds)), F.coalesce("_feeds", F.array().cast("array<string>")))) == 0), ("files_not_in_receipt", n("_extra") == 0),
        ("files_gone_without_plan", (n("_gone") == 0) | F.coalesce("_begun", F.lit(False))), ("files_changed", n("_changed") == 0), ("pending_work", ~F.col("pending_work")),
    ]
    return eligibility(got, rules).select("kind", "date", "eligible", "reasons")
