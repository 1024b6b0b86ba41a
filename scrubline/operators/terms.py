"""Large lists of terms, of one word or several, found in texts by joins.

A pattern of all terms ends at some thousands of them.  Here the words of a text,
and runs of as many words as the terms have, are keys that are joined with the
list, so a list may have any size.  A text is searched once however often it is
repeated, and words that stand in very many texts are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.spans import FINDINGS, find_spans, none_found
from scrubline.operators.skew import split_join
from scrubline.plans.config import register_action
from scrubline.sources.scratch import new_path

FOUND_BY = "deid-term"
WORD = r"[\p{L}\p{Nd}]+(?:['’-][\p{L}\p{Nd}]+)*"


def _words(text: Column) -> Column:
    """(word, start, end) of each word, in order."""
    found = find_spans(text, WORD, "", None, "")
    return F.transform(found, lambda f: F.struct(F.lower(f["word"]).alias("word"), f["start"].alias("start"), f["end"].alias("end")))


def term_keys(terms: DataFrame, term_col: str = "term") -> DataFrame:
    """``(key, words)``: the words of each term in lower case, one blank apart, and their number; each once."""
    words = F.regexp_extract_all(F.col(term_col), F.lit(WORD), F.lit(0))  # places do not matter here, so no spans are cut
    found = terms.where(F.col(term_col).isNotNull()).select(words.alias("found"))
    rows = found.select(F.lower(F.array_join("found", " ")).alias("key"), F.size("found").alias("words"))
    return rows.where("words > 0").distinct()


def with_terms(notes: DataFrame, terms: DataFrame, text_col: str, term_col: str = "term", out: str = "listed") -> DataFrame:
    """notes plus ``out``: findings of all places of listed terms, in any case and with any
    blanks or marks between their words.

    Terms may overlap each other.  A null or empty text and an empty list give no
    findings; terms without letters and digits are none.  The action
    ``replace_listed`` takes such a column.
    """
    spark = notes.sparkSession
    listed = term_keys(terms, term_col)
    path = new_path(spark, "terms")
    listed.write.parquet(path)
    listed = spark.read.parquet(path)
    lengths = [r.words for r in listed.select("words").distinct().orderBy("words").collect()]  # as many as terms have lengths
    if not lengths:
        return notes.withColumn(out, none_found())
    hashes = {"__t1": F.xxhash64(text_col), "__t2": F.xxhash64(F.lit(1), text_col)}
    texts = notes.where(F.col(text_col) != "").select(F.col(text_col).alias("__text"), *[h.alias(n) for n, h in hashes.items()])
    texts = texts.groupBy("__t1", "__t2").agg(F.first("__text").alias("__text"))

    def runs(words: Column) -> Column:
        def run(n: int) -> Column:
            if n == 1:
                return F.transform(words, lambda w: F.struct(w["word"].alias("key"), w["start"].alias("start"), w["end"].alias("end")))
            at = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda i: F.struct(
                F.array_join(F.transform(F.slice(words, i + 1, F.lit(n)), lambda w: w["word"]), " ").alias("key"),
                F.try_element_at(words, i + 1)["start"].alias("start"), F.try_element_at(words, i + n)["end"].alias("end")))

        return F.concat(*[run(n) for n in lengths])

    each = texts.withColumn("__words", _words(F.col("__text"))).select("__t1", "__t2", F.explode_outer(runs(F.col("__words"))).alias("x")).where("x IS NOT NULL")
    grams = each.select("__t1", "__t2", F.col("x.key").alias("key"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    path = new_path(spark, "grams")
    grams.write.parquet(path)
    found = split_join(spark.read.parquet(path), listed, [("key", "key")], "inner", [])
    each = found.groupBy("__t1", "__t2").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__found"))
    back = each.select(F.col("__t1").alias("__b1"), F.col("__t2").alias("__b2"), F.col("__found").alias("__at"))
    joined = split_join(notes.drop(out).withColumns(hashes), back, [("__t1", "__b1"), ("__t2", "__b2")], "left", ["__at"])
    # places alone went through the joins; the words come out of the text that they were found in
    findings = F.transform("__at", lambda x: F.struct(
        F.substring(text_col, x["start"] + 1, x["end"] - x["start"]).alias("word"), x["start"], x["end"], F.lit("term").alias("type"),
        F.lit(None).cast("string").alias("replacement"), F.lit(FOUND_BY).alias("found_by"))).cast(FINDINGS)
    return joined.withColumn(out, F.coalesce(findings, none_found())).drop("__t1", "__t2", "__at")


def _listed(df: DataFrame, spec, text: Column, earlier: Column) -> Column | None:
    given = [F.col(f"`{f}`") for f in spec.fields if f in df.columns]
    if not given:
        return None
    return F.transform(F.concat(*given), lambda f: f.withField("type", F.lit(spec.item)).withField("replacement", F.lit(spec.params[0] if spec.params else f"[{spec.item}]")))


register_action("replace_listed", _listed)
