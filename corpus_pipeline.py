"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last keep the
columns of docs, extra ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import langid, mixing, packing, simhash, substrings
from scrubline.llm.base import dropped, stored, table

#: A text that the best language codes in more than its plain bytes by this many
#: bits is no language's; a few rare letters at a short text's start are no evidence.
MOST_EXCESS = 64.0


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that no language's model
    compresses.  The models learn from the labelled documents of docs; a
    document's label is no part of its judgement.  Without labels all stay."""
    model = langid.fit(docs)
    if not model.languages:
        return docs
    found = langid.predict(docs, model, prefix="__")
    excess = (F.col("__bits_per_byte") - 8) * F.octet_length("text")
    known = (F.col("__lang_pred") != langid.NONE) & (excess < MOST_EXCESS)
    return found.where(known).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: texts whose sets of
    five-word shingles have a similarity of 0.8 or more, also over others.  SimHash
    fingerprints and the generalised pigeonhole give the candidates.  The
    smallest id stays, then the smallest hash of the text; rows without an id come
    last.  Of rows with the same id and text one stays."""
    found, linked = simhash.similar_texts(docs)
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "t", "n")
    each = found.groupBy("key", "doc_id", "t").agg(F.count("*").alias("n")).groupBy("key").agg(F.min(first).alias("best"))
    joined = each.join(linked, each.key == linked.id, "left").groupBy(F.coalesce("component", "key").alias("component"))
    kept = joined.agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias("__id"), F.col("best.t").alias("__t"), F.col("best.n").alias("__n"))
    kept = stored(kept, "kept")
    rows = docs.withColumn("__text", F.xxhash64("text"))
    one = lambda k: rows.join(k, rows.doc_id.cast("long").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__t")), "left_semi")
    if kept.where("__n > 1").isEmpty():
        return one(kept).select(*docs.columns)
    again = one(kept.where("__n > 1")).groupBy("doc_id", "__text").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    return one(kept.where("__n = 1")).select(*docs.columns).union(again.select("row.*"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; n_chars follows.  A document that
    loses all its words stays, with an empty text."""
    cut = substrings.remove_repeats(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.  A null
    source is a source of its own, a null text has no words, and repeated rows count
    for themselves; rows that differ in anything are told apart by a hash, so reruns
    agree.  An empty table stays empty."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in the sequences.  An empty or
    null text is one piece, its separator; documents that the mix has taken twice
    are packed twice; null ids stay null.  An empty table stays empty."""
    return packing.place(packing.pieces(docs))


STAGES = [
    ("language identification", keep_languages),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

#: Hashes, context trees and tokenisers have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
            if before is not None:
                dropped(before)
            before = docs
    return docs
