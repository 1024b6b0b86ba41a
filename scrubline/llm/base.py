"""Shared helpers: tables, shared scratch storage, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.sources.readers import spread  # noqa: F401  (for the operators' modules)
from scrubline.sources.scratch import new_path

#: Word separators of the contracts that split on ASCII white space.
SPACES = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back.

    This cuts the lineage: later steps survive the loss of executors without
    running the earlier ones again, and a costly input is computed once.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a folder, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dropped(df: DataFrame) -> None:
    """Deletes what stored() wrote, where nothing reads it any more."""
    deleted(df.sparkSession, df.stored_at)


def laid_out(df: DataFrame, name: str, keys: list[str], bucket_bytes: int = 256 << 20) -> DataFrame:
    """df dealt by keys once, as a bucketed table in the shared folder: any number of
    joins by keys then move the other side alone.  There are as many buckets as Spark
    has shuffle partitions, or more, so that none is over bucket_bytes by the
    optimiser's estimate.  unlaid() takes the table away again."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = size if size < 1 << 53 else 0  # what Spark says of data whose size it does not know
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, -(-size // bucket_bytes)))
    called = f"{name}_{uuid.uuid4().hex}"
    path = new_path(spark, called)
    df.repartition(n, *keys).write.bucketBy(n, *keys).option("path", path).saveAsTable(called)
    out = spark.table(called)
    out.stored_at, out.called = path, called
    return out


def unlaid(df: DataFrame) -> None:
    """Takes a table of laid_out() out of the catalog and deletes it."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.called}")
    dropped(df)


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``(id, component)``.

    An error where max_rounds are not enough (a chain of some 2^max_rounds/2 links).

    Alternates large-star and small-star steps until the edges are stars: every
    step is a grouped minimum and a join, so a component may hold any share of
    all rows.  Ids without an edge are absent; ``component`` is the smallest id.
    Each round's edges are written to the shared folder, and those before deleted.
    """
    e = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, before = state, e
        e = stored(_small_star(_large_star(e)), "edges")
        dropped(before)
    else:
        raise RuntimeError(f"no fixed point within {max_rounds} rounds")
    return e.select(F.col("v").alias("id"), F.col("u").alias("component")).union(
        e.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to its smallest neighbour (or itself)."""
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m"))
    # e has one row for each pair of x = u and a larger neighbour v
    out = e.join(least, e.u == least.k).select("v", F.col("m").alias("u"))
    return out.where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the smallest of them."""
    least = e.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("k"), "m")
    out = e.join(least, e.v == least.k).select(F.col("u").alias("v"), F.col("m").alias("u"))
    return out.union(least.select(F.col("k").alias("v"), F.col("m").alias("u"))).where("u != v").distinct()


def slices(batch, column: str, most_bytes: int = 4 << 20):
    """Splits an Arrow batch so that each part holds about most_bytes of a text or
    binary column (a longer value makes a part of its own)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at, n = 0, batch.num_rows
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def with_fields(schema, *fields):
    """schema without the fields' names, then the fields (name, type)."""
    from pyspark.sql import types as T

    new = [T.StructField(n, T._parse_datatype_string(t) if isinstance(t, str) else t) for n, t in fields]
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + new)
