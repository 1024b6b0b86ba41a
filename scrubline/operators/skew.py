"""Equi-joins of which one side has few heavy keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than this part of a shuffle partition's fair share of rows.
SHARE = 4


def split_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], how: str = "left", columns: list[str] | None = None) -> DataFrame:
    """left joined to right (a row a key, or few) on pairs of columns; the rows of left's heavy keys are dealt out.

    A count of left's keys, of which Spark reads these columns alone, tells the keys
    with more rows than 1 / (SHARE * shuffle partitions) of all; there are at most
    SHARE * shuffle partitions of them, so that list, and only that, is broadcast.
    Their rows get a number, and right's rows for them are repeated for each.  Rows
    with a null key find nothing, as in any join.  columns: what to keep of right.
    A stream cannot be counted beforehand, so it is joined as it comes.
    """
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mine, others = [a for a, _ in keys], [b for _, b in keys]
    kept = [c for c in (columns or right.columns) if c not in others]
    both = lambda conditions: conditions[0] if len(conditions) == 1 else conditions[0] & both(conditions[1:])
    if left.isStreaming:
        plain = right.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(others)], *kept)
        return left.join(plain, both([F.col(c) == F.col(f"__k{i}") for i, c in enumerate(mine)]), how).drop(*[f"__k{i}" for i in range(len(mine))])
    counts = left.groupBy(*mine).count().where(" AND ".join(f"`{c}` IS NOT NULL" for c in mine))
    total = left.select(*mine).count()
    least = max(1000, total // (SHARE * parts))
    heavy = counts.where(F.col("count") > least).select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(mine)], F.ceil(F.col("count") / least).cast("int").alias("__n"))
    heavy = spark.createDataFrame(heavy.collect(), heavy.schema)  # SHARE * parts rows at most
    on = lambda names: [F.col(c) == F.col(f"__h{i}") for i, c in enumerate(names)]
    drop = [f"__h{i}" for i in range(len(mine))]
    a = left.join(F.broadcast(heavy), both(on(mine)), "left").withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col("__n"), F.lit(1)))).drop(*drop, "__n")
    b = right.join(F.broadcast(heavy), both(on(others)), "left").withColumn("__part2", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__n"), F.lit(1)) - 1)))
    b = b.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(others)], F.col("__part2").cast("long").alias("__part2"), *kept)
    same = both([F.col(c) == F.col(f"__k{i}") for i, c in enumerate(mine)] + [F.col("__part") == F.col("__part2")])
    return a.join(b, same, how).drop("__part", "__part2", *[f"__k{i}" for i in range(len(mine))])
