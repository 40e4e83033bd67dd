"""License scans by a positional index of rare words. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import materialize, table, text_of, word_array
from feedspark.llm.notices import BASE, COMMON, TEMPLATES

#: Least IDF-weighted share of a template's words that stand at their places.
COVERAGE = 0.6
ENTRY = "word string, entry int, kind string, label string, q int, must boolean, n_must int, n_words_must int, n_all int, share double, idf double"


def entries_of(base: dict[str, str], templates: tuple) -> list[tuple[str, str, list[str], set[int]]]:
    """(kind, label, words, places of the mandatory phrase) of each base phrase and template."""
    out = [("base", label, phrase.split(), set(range(len(phrase.split())))) for phrase, label in base.items()]
    for label, notice, mandatory in templates:
        words, key = notice.split(), mandatory.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out.append(("template", label, words, set(range(at, at + len(key)))))
    return out


def license_scan(docs: DataFrame, base: dict[str, str] | None = None, templates: tuple = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, best, score.

    The index lists every word of the base phrases and templates (licence notices, and the
    clauses of licence bodies, each a template) with its positions; the commonest English
    words are left out of it and match anything.

    1. One pass keeps, of each text, the indexed words with their positions.
    2. Document frequencies of these words, over all documents, give their IDF.
    3. Of each file, only templates all of whose mandatory words it has are looked at. Their
       key is chosen by file: the mandatory word of the highest IDF, less the logarithm of its
       occurrences in this file. Postings of the key propose starts: an occurrence at word p
       whose place in the phrase is q proposes p - q. As a match has the whole phrase in place,
       its key is there: no match is lost. Starts at which the other mandatory words do not
       stand at their places are dropped.
    4. At the others, the template's words are intersected with the file's by
       relative position: coverage is the IDF-weighted share of the template's words that
       stand at their places. A match has the whole mandatory phrase in place and coverage of
       COVERAGE or more.
    Base phrases are found in the same way, with all their words in place.

    The index is a fixed, small table and is broadcast. Only files with licence words take part
    in steps 2 to 4. score: the best coverage, 1 where a base phrase stands; best: the match of
    the best coverage, of equal ones the last by label and start. Null and empty texts: no
    words. Very long texts count whole. Ids may be null or repeat: rows are told apart by
    position. Empty table: no rows. Other columns are not read."""
    spark = docs.sparkSession
    entries = entries_of(BASE if base is None else base, templates)
    if not entries:
        raise ValueError("no phrases and no templates")
    vocabulary = sorted({w for _, _, ws, _ in entries for w in ws if w not in COMMON})
    w = F.col("w")
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_array(text_of(text_col)).alias("w"))
    placed = F.filter(F.transform(w, lambda x, i: F.when(x.isin(vocabulary), F.struct(x.alias("word"), i.alias("at")))), lambda x: x.isNotNull())
    scanned = materialize(words.select(F.monotonically_increasing_id().alias("_r"), "doc_id", F.size("w").cast("long").alias("n_words"), placed.alias("occ")))
    with_words = scanned.filter(F.size("occ") > 0)
    own_words = F.array_distinct(F.transform("occ", lambda o: o["word"]))
    in_file = with_words.select("_r", F.explode(own_words).alias("word"))

    n_docs, frequency = scanned.count(), {x.word: x.n for x in in_file.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = {x: math.log((n_docs + 1) / (frequency.get(x, 0) + 1)) + 1e-3 for x in vocabulary}
    rows = []
    for n, (kind, label, ws, must) in enumerate(entries):
        held = [i for i, x in enumerate(ws) if x in idf]
        weight, needed = sum(idf[ws[i]] for i in held), must & set(held)
        rows += [(ws[i], n, kind, label, i, i in must, len(needed), len({ws[j] for j in needed}), len(held), idf[ws[i]] / weight, idf[ws[i]]) for i in held]
    postings = spark.createDataFrame(rows, ENTRY)

    mandatory = sorted({r[0] for r in rows if r[5]})
    keyed = F.transform(F.filter(own_words, lambda x: x.isin(mandatory)), lambda x: F.struct(x.alias("word"), F.size(F.filter("occ", lambda o: o["word"] == x)).alias("n")))
    phrase = F.broadcast(postings.filter("must").groupBy("word", "entry", "n_words_must", "idf").agg(F.min("q").alias("q")))
    asked = with_words.select("_r", F.explode(keyed).alias("k")).select("_r", "k.word", "k.n").join(phrase, "word").withColumn("weight", F.col("idf") - F.ln("n"))
    best_key = F.max_by(F.struct("word", "q"), F.struct("weight", "word")).alias("key")
    keys = materialize(asked.groupBy("_r", "entry", "n_words_must").agg(F.count(F.lit(1)).alias("found"), best_key).filter("found = n_words_must").select("_r", "entry", "key.word", "key.q"))
    at_words = F.explode(F.filter("occ", lambda o: o["word"].isin(mandatory))).alias("o")
    occurrences = materialize(with_words.join(keys.select("_r").distinct(), "_r", "left_semi").select("_r", at_words).select("_r", "o.word", "o.at"))
    proposed = occurrences.join(keys, ["_r", "word"]).select("_r", "entry", (F.col("at") - F.col("q")).alias("start"))
    wanted = proposed.join(F.broadcast(postings.filter("must").select("entry", "word", "q", "n_must")), "entry").withColumn("at", F.col("start") + F.col("q"))
    stands = wanted.join(occurrences, ["_r", "word", "at"]).groupBy("_r", "entry", "start", "n_must").agg(F.count(F.lit(1)).alias("n")).filter("n = n_must")
    verified = materialize(stands.select("_r", "entry", "start"))
    template = F.broadcast(postings.groupBy("entry", "kind", "label", "n_all").agg(F.map_from_entries(F.collect_list(F.struct("q", F.struct("word", "share").alias("v")))).alias("places")))
    with_places = verified.join(with_words.select("_r", "occ"), "_r").join(template, "entry")
    aligned = F.filter(F.transform("occ", lambda o: F.when(F.element_at("places", o["at"] - F.col("start"))["word"] == o["word"], F.element_at("places", o["at"] - F.col("start")))), lambda v: v.isNotNull())
    found = with_places.select("_r", "kind", "label", "n_all", "start", aligned.alias("a"))
    coverage = F.aggregate("a", F.lit(0.0), lambda s, v: s + v["share"])
    measured = found.select("_r", "kind", "label", "start", (F.size("a") == F.col("n_all")).alias("whole"), coverage.alias("coverage"))
    is_base = F.col("kind") == "base"
    places = measured.filter(F.when(is_base, F.col("whole")).otherwise(F.col("coverage") >= COVERAGE))
    matches = places.groupBy("_r").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.struct("coverage", "label", "start")).alias("best"),
        F.least(F.max("coverage"), F.lit(1.0)).alias("score"),
    )
    got = scanned.select("_r", "doc_id", "n_words").join(matches, "_r", "left")
    return got.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), "best", F.coalesce("score", F.lit(0.0)).alias("score"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("best")
