"""URL filter: exact host and path rules, then gradient-boosted trees on lexical features. DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import materialize, sampled, table

#: Verdict and 'host/path' of each rule.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Different labelled URLs that the trees are fitted on, about this many at most, chosen by a hash of the url.
TRAIN_ROWS = 8_000
FEATURES = ("n_url", "n_host", "n_path", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens", "n_suffix", "suffix_rate", "suffix_share", "segment_rate")
#: Weight of the prior in a suffix's rate; share of the hosts (1 / HELD_OUT) that ``held_out_accuracy`` leaves out of the fit.
SMOOTHING, HELD_OUT = 5, 4


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without '://'."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits: struct(rule, verdict), or null. Equal lengths: the first in order."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits a character, over the ASCII characters that urls use."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    terms = [F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in "abcdefghijklmnopqrstuvwxyz0123456789-./_=&?:"]
    return sum((F.when(k > 0, -(k / n) * F.log2(k / n)).otherwise(0.0) for k in terms), F.lit(0.0))


def with_rules(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, u (the url, empty for null), host, path, hit (rule and verdict, or null), suffix, site (the host's last two labels), segment (the path's first)."""
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("u"), host.alias("host"), path.alias("path"))
    return rows.withColumns({"hit": rule_of(F.col("host"), F.col("path"), rules), "suffix": F.substring_index("host", ".", -1), "site": F.substring_index("host", ".", -2), "segment": F.lower(F.substring_index(F.substring("path", 2, 256), "/", 1))})


def with_features(rows: DataFrame) -> DataFrame:
    """Adds FEATURES to the result of ``with_rules``: lexical ones, and statistics of the host's suffix.

    suffix_rate is the smoothed share of blocked among the suffix's labelled urls *of other
    sites*, suffix_share the share of all urls that other sites of the suffix have: what a site
    itself counts is not among its features, so that no url meets its own label there, nor its
    site's name under another number. segment_rate is the same rate over urls of other sites whose
    path begins with the same segment. All are counted over all urls and written once, so that
    Spark knows their size when it plans the joins and can split a frequent site's rows."""
    blocked, labelled = F.count_if(F.col("hit.verdict") == "block"), F.count("hit")
    sites = materialize(rows.groupBy("suffix", "site").agg(blocked.alias("b"), labelled.alias("l"), F.count(F.lit(1)).alias("n")))
    suffixes = materialize(sites.groupBy("suffix").agg(F.sum("b").alias("sb"), F.sum("l").alias("sl"), F.sum("n").alias("sn")))
    total = suffixes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sb", "sl", "sn")]).first()
    prior = total.sb / total.sl if total.sl else 0.5
    rate = (F.col("sb") - F.col("b") + F.lit(SMOOTHING * prior)) / (F.col("sl") - F.col("l") + SMOOTHING)
    known = sites.join(suffixes, "suffix").select("site", rate.alias("suffix_rate"), ((F.col("sn") - F.col("n")) / F.lit(float(max(1, total.sn)))).alias("suffix_share"))
    paths = materialize(rows.groupBy("segment", "site").agg(blocked.alias("b"), labelled.alias("l")).filter("l > 0"))
    segments = materialize(paths.groupBy("segment").agg(F.sum("b").alias("tb"), F.sum("l").alias("tl")))
    u = F.col("u")
    count = lambda c, sign: (F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))).cast("double")
    lexical = {
        "n_url": F.length(u).cast("double"), "n_host": F.length("host").cast("double"), "n_path": F.length("path").cast("double"), "n_suffix": F.length("suffix").cast("double"),
        "depth": count(F.col("path"), "/"), "labels": count(F.col("host"), "."), "hyphens": count(F.col("host"), "-"),
        "digit_ratio": F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1)),
        "entropy": entropy(F.lower(u)), "parameters": F.when(F.contains(u, F.lit("?")), count(u, "&") + 1).otherwise(0.0),
    }
    own = lambda c: F.coalesce(F.col(c), F.lit(0))
    segment_rate = (own("tb") - own("b") + F.lit(SMOOTHING * prior)) / (own("tl") - own("l") + SMOOTHING)
    counted = rows.join(known, "site").join(segments, "segment", "left").join(paths, ["segment", "site"], "left").withColumn("segment_rate", segment_rate).drop("tb", "tl", "b", "l")
    return counted.withColumns(lexical)


def fit(full: DataFrame, train_rows: int = TRAIN_ROWS) -> GBTClassificationModel | None:
    """Trees on about ``train_rows`` different labelled urls; none if these are all of one verdict."""
    own = full.filter(F.col("hit").isNotNull())
    seen = own.agg(F.approx_count_distinct(F.xxhash64("u")).alias("urls"), F.min("hit.verdict").alias("x"), F.max("hit.verdict").alias("y")).first()
    if seen.x == seen.y:
        return None
    sample = own.filter(sampled(F.col("u"), F.lit(min(1.0, train_rows / max(1, seen.urls))))).dropDuplicates(["u"]).withColumn("label", (F.col("hit.verdict") == "block").cast("double"))
    sample = _assembled(sample).select("features", "label")
    if len(sample.select("label").distinct().take(2)) < 2:
        return None
    return GBTClassifier(maxIter=10, maxDepth=3, maxBins=32, stepSize=0.3, seed=7, featuresCol="features", labelCol="label").fit(sample)


def _assembled(full: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(full)


def _scored(full: DataFrame, model: GBTClassificationModel) -> DataFrame:
    return model.transform(_assembled(full)).withColumn("p", vector_to_array("probability")[1])


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict, score.

    The rules label the urls that they fit; gradient-boosted trees learn these labels from
    lexical features and suffix statistics (``with_features``) and judge the others. The trees
    are fitted on about ``train_rows`` different ones. score: the trees' probability of
    'block'; null where they were not asked (a rule fits) or not fitted.

    If the labelled urls are all of one verdict, that is the verdict of the others too; if
    there are none, they are allowed. Null urls: empty host and path. Very long urls count
    whole. Ids may be null or repeat; repeated urls are judged alike. Empty table: no rows.
    Other columns are not read."""
    rows = with_rules(pages, rules, id_col, url_col)
    full = with_features(rows)
    model = fit(full, train_rows)

    def judged(df: DataFrame, other: Column, score: Column) -> DataFrame:
        return df.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", other).alias("verdict"), F.when(F.col("hit").isNull(), score).alias("score"))

    if model is None:
        only = rows.agg(F.max("hit.verdict")).first()[0] or "allow"
        return judged(rows, F.lit(only), F.lit(None).cast("double"))
    return judged(_scored(full, model), F.when(F.col("p") >= 0.5, "block").otherwise("allow"), F.col("p"))


def held_out_accuracy(pages: DataFrame, rules=RULES, url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row: n labelled urls of hosts that the fit did not see, the share judged as their rule, the share of their commoner verdict.

    Whole hosts are left out, by a hash of the host: their labels count in no statistic either."""
    rows = with_rules(pages.withColumn("_id", F.lit(0)), rules, "_id", url_col)
    out = F.pmod(F.xxhash64("host"), F.lit(HELD_OUT)) == 0
    truth = rows.withColumn("truth", F.col("hit.verdict"))
    full = with_features(truth.withColumn("hit", F.when(~out, F.col("hit"))))
    model = fit(full, train_rows)
    asked = full.filter(out & F.col("truth").isNotNull())
    got = asked.withColumn("p", F.lit(None).cast("double")) if model is None else _scored(asked, model)
    right = F.when(F.col("p") >= 0.5, "block").otherwise("allow") == F.col("truth")
    blocked = F.avg((F.col("truth") == "block").cast("double"))
    return got.agg(F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"), F.greatest(blocked, 1 - blocked).alias("commoner"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
