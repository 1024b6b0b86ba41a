"""Notes and what is known about their persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.operators.skew import split_join
from scrubline.sources.files import contents, full_uri, is_folder, listed

#: Texts that a task searches.
ROWS = 1 << 15


def spread(scan: DataFrame) -> DataFrame:
    """A scan dealt out to all cores if it has fewer partitions than there are cores.

    Patterns cost a hundred times the reading, and a row group cannot be split by
    reading.  A larger input has partitions enough and stays as it is, unshuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def dealt(rows: DataFrame, counted: DataFrame | None = None, each: int = ROWS) -> DataFrame:
    """Rows dealt out evenly to all cores, in tasks of at most about ``each`` rows.

    Patterns cost a hundred times the reading.  A scan's partitions say little: a row
    group is read by one of them whole, a join's output is put together by bytes, and a
    task of millions of short texts takes the longest.  counted: what gives the
    number of rows if that is cheaper than counting rows themselves (the scan behind a join).
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = (rows if counted is None else counted).count()
    return rows.repartition(cores * max(1, -(-n // (cores * each))))  # no wave of tasks leaves cores idle


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON object a line; with a schema nothing is inferred."""
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def read_table(spark: SparkSession, source: str | DataFrame, id_fields: list[str], text_fields: list[str]) -> DataFrame:
    """A typed table (of the catalog, a Parquet path, or any DataFrame) as notes: ids and texts
    become strings, bytes are read as UTF-8, dates and times as ISO; other columns keep their types.

    A field that the table lacks is an error here, not an empty output later.
    """
    df = source if isinstance(source, DataFrame) else spark.read.parquet(source) if "/" in source else spark.table(source)
    if missing := [c for c in [*id_fields, *text_fields] if c not in df.columns]:
        raise ValueError(f"the table has no {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def text(c: str) -> Column:
        if isinstance(kinds[c], (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(F.col(f"`{c}`"))
        return F.col(f"`{c}`").cast("string")

    return df.withColumns({c: text(c) for c in dict.fromkeys([*id_fields, *text_fields])})


def read_text_folder(spark: SparkSession, path: str, id_col: str = "id", text_col: str = "note") -> DataFrame:
    """A row for each file below path (or the file itself): its bare name and content,
    with line ends as \\n and without the last one.

    A folder is listed by a task and its names are dealt out, so the driver does not hold
    them.  Only where Python has no way into the store, and for a pattern or a file, Spark's
    reader lists it, on the driver, and passes over empty files.
    """
    uri = full_uri(spark, path)
    if is_folder(uri):
        files = contents(dealt(listed(spark, uri)), uri)
        name = F.col("name")
    else:
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        name = F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("+"), F.lit("%2B")))
    text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "\n$", "")
    return files.select(name.alias(id_col), text.alias(text_col))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header: all strings, empty values stay empty."""
    return spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"').na.fill("")


def read_dictionary(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A headerless CSV with a given schema."""
    return spark.read.csv(path, header=False, schema=schema, quote='"', escape='"')


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """``(word)``: the non-empty lines, once each."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def key_values(spark: SparkSession, path: str, reverse: bool = False) -> DataFrame:
    """``(key, value)`` of lines ``a,b`` (reverse: b is the key); what follows a second comma is dropped."""
    parts = F.split("value", ",")
    a, b = F.trim(parts[0]), F.trim(parts[1])
    rows = spark.read.text(path).where(F.size(parts) > 1)
    return rows.select((b if reverse else a).alias("key"), (a if reverse else b).alias("value"))


def with_person(notes: DataFrame, persons: DataFrame, note_id: str = "id", key: str = "note_id") -> DataFrame:
    """notes plus the person of each (one row each; the first by person where there are more)."""
    one = persons.groupBy(F.col(key).alias("__note")).agg(F.min("person_id").alias("__person"))
    out = split_join(notes.drop("person_id"), one, [(note_id, "__note")], columns=["__person"])
    return out.withColumnRenamed("__person", "person_id")


def with_known(notes: DataFrame, known: DataFrame, key: str = "person_id") -> DataFrame:
    """notes plus known values by person.

    Where a person is known, its values replace columns of the same name, also
    with empty strings; notes without one keep theirs.  Of several rows of a person
    the least counts.  The sizes decide between a broadcast and a shuffled join, and
    persons with very many notes are dealt out (``skew.split_join``).
    """
    columns = [c for c in known.columns if c != key]
    maps = {f.name for f in known.schema.fields if "map<" in f.dataType.simpleString()}  # which have no order
    order = F.struct(*[F.to_json(F.struct(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`") for c in columns])
    one = known.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*columns), order).alias("__row"))
    one = one.select("__key", *[F.col("__row")[c].alias(f"__{c}") for c in columns])
    out = split_join(notes, one.withColumn("__known", F.lit(True)), [(key, "__key")], columns=["__known", *[f"__{c}" for c in columns]])
    values = {c: (F.when(F.col("__known"), F.col(f"__{c}")).otherwise(F.col(c)) if c in notes.columns else F.col(f"__{c}")) for c in columns}
    return out.withColumns(values).drop("__known", *[f"__{c}" for c in columns])
