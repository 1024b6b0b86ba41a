"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``rate = target / source size`` times.
The expectations are summed along a fixed order of the source's documents, one
random offset (drawn from the seed) is added to the sums, and a document is
emitted once for each integer that its step crosses.  The order runs through
the sizes upwards and then downwards, so neighbouring documents are alike in
size and the words taken come near the target.

The sums are found in two levels: a window within small buckets, and a window
over the totals of a source's buckets.  No task holds a whole source.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.base import SPACES, stored, table

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    parts = F.split(F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), " +")
    # leading blanks give one empty part, an empty text too
    return F.coalesce(F.size(parts) - F.when(parts[0] == "", 1).otherwise(0), F.lit(0)).cast("long")


def offset_of(seed: int) -> float:
    return random.Random(seed).random()


def source_targets(totals: DataFrame, weights=WEIGHTS, percent: int = 150, most: int = 2) -> DataFrame:
    """``totals(source, source_size long)`` plus ``weight`` and ``target``.

    The sources share percent % of all sizes by weight; a target stops at
    ``most`` times the source's size and the excess goes to the others by weight
    until none is above.  That is a level ``t`` with target = min(cap, t * weight):
    with the sources sorted by cap / weight, t is the first share left over that
    its own source can take, and the largest of that kind.  One row for each
    source goes through one task.
    """
    n = len(weights)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % n + 1).cast("int")).cast("long")
    x = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    x = x.withColumn(
        "share",
        (F.sum("source_size").over(everything) * percent - F.coalesce(F.sum("cap").over(before), F.lit(0)) * 100)
        / (F.sum("weight").over(after) * 100),
    )
    level = F.max(F.when(F.col("share") <= F.col("cap") / F.col("weight"), F.col("share"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return x.select("source", "source_size", "weight", target.alias("target"))


def with_copies(docs: DataFrame, size_col: str, id_col: str = "doc_id", source_col: str = "source", seed: int = 7,
                weights=WEIGHTS, percent: int = 150, most: int = 2, tie: Column | None = None) -> DataFrame:
    """docs plus ``__source_size long``, ``__target double`` and ``__copies long``.

    size_col: words of a document (long, 0 or more).  Repeated rows count as
    documents of their own; a null source is a source of its own, after the
    others.  Documents of size 0 get copies too (of no words).  An empty input
    gives an empty result.  docs is read twice; a column of docs called as one that is
    added on the way is an error (``mix`` takes any names).

    tie: a number that tells rows of one id and size apart, so that reruns draw
    the same rows, and stands for null ids; without it these are all one id, and
    rows that only their id and size tell apart are interchangeable.
    """
    own = ("__step", "__part", "__place", "__copies", "__source_size", "__target", "__s", "__st", "__p", "__ahead")
    if taken := [c for c in docs.columns if c.lower() in own]:
        raise ValueError(f"docs has columns called {', '.join(taken)}")
    ident, source, size = F.col(id_col), F.col(source_col), F.col(size_col)
    deal = max(1, round(math.sqrt(docs.count()) / 16))
    mixed = F.pmod(F.pmod(F.coalesce(ident, F.lit(-1) if tie is None else tie), F.lit(2147483647)) * F.lit(2654435761), F.lit(2147483647))
    level = F.floor(F.log2(size + 1) * 4).cast("int")
    keyed = docs.withColumns({
        "__step": F.when(F.floor(mixed / 7) % 2 == 0, level).otherwise(1000 - level),
        "__part": (F.floor(mixed / 16).cast("long") % deal).cast("int"),
    })
    buckets = stored(
        keyed.groupBy(source.alias("__s"), F.col("__step").alias("__st"), F.col("__part").alias("__p"))
        .agg(F.count("*").alias("__n"), F.sum(size).alias("__words")),
        "buckets",
    )
    totals = source_targets(
        buckets.groupBy(F.col("__s").alias("source")).agg(F.sum("__words").alias("source_size")), weights, percent, most
    ).select(F.col("source").alias("__s2"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    before = Window.partitionBy("__s").orderBy("__st", "__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    starts = starts.join(totals, F.col("__s").eqNullSafe(F.col("__s2"))).select("__s", "__st", "__p", "__ahead", "__source_size", "__target")
    inside = Window.partitionBy(source, "__step", "__part").orderBy(F.when(F.col("__step") < 500, size).otherwise(-size), ident, *([] if tie is None else [tie]))
    ranked = keyed.withColumn("__place", F.row_number().over(inside))
    joined = ranked.join(
        starts, source.eqNullSafe(F.col("__s")) & (F.col("__step") == F.col("__st")) & (F.col("__part") == F.col("__p"))
    )
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    last = F.col("__ahead") + F.col("__place")
    copies = F.floor(rate * last + offset_of(seed)) - F.floor(rate * (last - 1) + offset_of(seed))
    return joined.withColumn("__copies", F.least(copies, F.lit(most)).cast("long")).select(
        *[docs[c] for c in docs.columns], "__source_size", "__target", "__copies"
    )


def mix(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The mixed corpus: each row of docs as often as it is drawn, with docs' columns.

    A null text has no words; null sources, null ids and repeated rows are as in
    with_copies.  Rows of one id and size go by a hash of all their columns but
    maps, so reruns agree.  Columns of docs may have any names.
    """
    own = {name: f"__c{i}" for i, name in enumerate(docs.columns)}  # so that none clashes with those of this module
    plain = docs.select(*[F.col(f"`{name}`").alias(c) for name, c in own.items()])
    tie = F.xxhash64(*[F.col(f.name) for f in plain.schema.fields if "map<" not in f.dataType.simpleString()])
    sized = plain.withColumn("__size", word_count(F.col(own[text_col])))
    drawn = with_copies(sized, "__size", own[id_col], own[source_col], seed, tie=tie).where("__copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy")
    return drawn.select(*own.values(), times).select(*[F.col(c).alias(name) for name, c in own.items()])


def op2_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    drawn = with_copies(stored(docs, "sizes"), "size")
    return drawn.select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__copies") * F.col("size")).alias("taken"),
    )


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^{SPACES}]+')), 0)::BIGINT AS size FROM documents),
n AS (SELECT greatest(1, round(sqrt(count(*)) / 16))::BIGINT AS deal FROM d),
m AS (SELECT *, (((coalesce(doc_id, -1) % 2147483647 + 2147483647) % 2147483647) * 2654435761) % 2147483647 AS mixed FROM d),
k AS (
  SELECT doc_id, source, size, (mixed // 16) % deal AS part,
         CASE WHEN (mixed // 7) % 2 = 0 THEN floor(log2(size + 1) * 4) ELSE 1000 - floor(log2(size + 1) * 4) END AS step
  FROM m, n),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight, source_size * 2 AS cap FROM t),
s AS (
  SELECT *, (sum(source_size) OVER () * 150 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100)::DOUBLE
           / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 100)::DOUBLE AS share
  FROM w),
l AS (SELECT max(CASE WHEN share <= cap / weight THEN share END) AS level FROM s),
g AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target FROM s, l),
r AS (
  SELECT k.doc_id, k.size, g.source_size, g.target,
         row_number() OVER (PARTITION BY k.source ORDER BY step, part, CASE WHEN step < 500 THEN size ELSE -size END, doc_id) AS place
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
c AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM r)
SELECT doc_id, size, source_size, target,
       (least(2, floor(rate * place + {offset_of(7)!r}::DOUBLE) - floor(rate * (place - 1) + {offset_of(7)!r}::DOUBLE)) * size)::BIGINT AS taken
FROM c
"""
