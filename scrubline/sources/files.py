"""A file for each row: a Spark data source that stages, commits and aborts; and a row for each file.

Tasks write their files below a folder of their own; the commit, which Spark runs
once all tasks are through, moves them to where they belong, and an abort takes
the staged ones away.  So a task that fails or runs twice leaves nothing.

Files may be millions: what tasks tell the driver is the names of folders of at
most EACH files, and a folder is listed by a task, which the driver's listing for
Spark's readers is not.
"""

from __future__ import annotations

import bz2
import gzip
import os
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: The name of a null id; no other name has a percent sign without two hexadecimal digits behind it.
NULL_NAME = "%null"
#: Bytes of an encoded id that a name may have; of a longer one the begin and a digest.
LONGEST = 180
#: Files that a staged folder holds at most.
EACH = 1 << 12
#: Rows and bytes from which a batch of texts goes on.
ROWS, BYTES = 1 << 10, 1 << 23


def file_name(id_: Column) -> Column:
    """A file name for each id, different for different ids: percent-encoded, with a
    leading dot or underscore too, since such files are hidden from readers."""
    text = id_.cast("string")
    name = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    name = F.regexp_replace(F.regexp_replace(name, r"^\.", "%2E"), "^_", "%5F")
    name = F.when(F.octet_length(name) > LONGEST, F.concat(F.substring(name, 1, LONGEST - 80), F.lit("%-"), F.sha2(text, 256))).otherwise(name)
    return F.when(text.isNull(), F.lit(NULL_NAME)).when(text == "", F.lit("%empty")).otherwise(name)


def id_of(name: Column) -> Column:
    """The id of a file name (null for a null id; a name that was cut has no id to be read, and stays)."""
    cut = F.contains(name, F.lit("%-"))
    return F.when(name == NULL_NAME, F.lit(None).cast("string")).when(name == "%empty", F.lit("")).when(cut, name).otherwise(F.try_url_decode(name))


def numbered(files: DataFrame, repeats: str = "error") -> DataFrame:
    """files (name, value) where a name stands once: rows that repeat an id are an error, or
    (``number``) have the number of their row behind ``%~`` in the name.

    Ids are counted without the texts; only those that repeat are joined back."""
    again = files.groupBy("name").count().where("count > 1").select(F.col("name").alias("__again"))
    if repeats == "error":
        if few := [r[0] for r in again.limit(5).collect()]:
            raise ValueError(f"more than one row for {', '.join(few)}, …: one file each; repeats='number' tells them apart")
        return files
    if repeats != "number":
        raise ValueError(f"repeats is error or number, not {repeats!r}")
    told = files.withColumn("__row", F.monotonically_increasing_id()).join(again, F.col("name") == F.col("__again"), "left")
    name = F.when(F.col("__again").isNotNull(), F.concat("name", F.lit("%~"), F.lower(F.hex("__row")))).otherwise(F.col("name"))
    return told.withColumn("name", name).drop("__row", "__again")


def store_of(path: str):
    """(file system, path there) for a full URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    parts: int  # folders in it, by number


class _Writer(DataSourceArrowWriter):
    def __init__(self, uri: str, suffix: str):
        self.uri, self.suffix, self.stage = uri, suffix, f"_staged-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> _Written:
        store, base = store_of(self.uri)
        folder = f"{base}/{self.stage}/{uuid.uuid4().hex}"
        store.create_dir(folder, recursive=False)  # not the stage, which an abort may have taken away
        n = 0
        for batch in iterator:
            for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if n % EACH == 0:
                    store.create_dir(f"{folder}/{n // EACH}", recursive=False)
                with store.open_output_stream(f"{folder}/{n // EACH}/{name}{self.suffix}") as f:
                    f.write((value or "").encode())
                n += 1
        return _Written(folder, -(-n // EACH))

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        store, base = store_of(self.uri)
        for m in messages:
            for k in range(m.parts if m is not None else 0):
                for found in store.get_file_info(fs.FileSelector(f"{m.folder}/{k}")):
                    store.move(found.path, f"{base}/{found.base_name}")
        self._clear(store, base)

    def abort(self, messages: list) -> None:
        self._clear(*store_of(self.uri))

    def _clear(self, store, base: str) -> None:
        """Takes the stage away, of which a task that is being ended may still write into a folder for a moment."""
        from pyarrow import fs

        for wait in (0.1, 0.2, 0.4, 0.8, 1.6, 3.2, 0):
            if store.get_file_info(f"{base}/{self.stage}").type != fs.FileType.Directory:
                return
            try:
                store.delete_dir(f"{base}/{self.stage}")
            except OSError:
                if not wait:
                    raise
                time.sleep(wait)


class EachFile(DataSource):
    """``df.write.format("each_file").mode("append").option("path", …)``: rows (name, value) as files."""

    @classmethod
    def name(cls) -> str:
        return "each_file"

    def writer(self, schema, overwrite: bool) -> _Writer:
        if [f.name for f in schema.fields] != ["name", "value"]:
            raise ValueError("rows are (name, value)")
        made = _Writer(self.options["path"], self.options.get("suffix", ""))
        store, base = store_of(made.uri)
        store.create_dir(f"{base}/{made.stage}")
        return made


def full_uri(spark: SparkSession, path: str) -> str:
    """path with the scheme of the store that it is in (the cluster's default store's if it has none)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write_each(files: DataFrame, folder: str, suffix: str = "") -> None:
    """Rows (name, value) as ``folder/<name><suffix>``.

    Where Python has no way into the store, Spark's own writer makes
    ``folder/name=<name>/part-…``.
    """
    spark = files.sparkSession
    uri = full_uri(spark, folder)
    if uri.startswith("file:"):
        os.makedirs("/" + uri.removeprefix("file:").lstrip("/"), exist_ok=True)
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    else:
        try:
            store, base = store_of(uri)
            store.create_dir(base)
        except Exception:  # whatever the store's library raises where it is not there
            files.select("value", "name").write.partitionBy("name").text(folder)
            return
    spark.dataSource.register(EachFile)
    files.select("name", "value").write.format("each_file").mode("append").option("path", uri).option("suffix", suffix).save()


# --- a row for each file

#: Compressed files, by their ending: what they begin with, and how they are read.
_PACKED = {".gz": (b"\x1f\x8b", gzip.decompress), ".bz2": (b"BZh", bz2.decompress), ".deflate": (b"\x78", zlib.decompress)}
_OTHERS = (".lz4", ".snappy", ".zst")


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder."""
    of_spark = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return of_spark and not name.startswith(("_metadata", "_common_metadata"))


def _entries(uri: str, folder: str) -> Iterator[tuple[str, str, bool]]:
    """(path, name, whether it is a folder) of what is in a folder; of a local one, as it is read."""
    if uri.startswith("file:"):
        with os.scandir(folder) as found:
            for x in found:
                yield x.path, x.name, x.is_dir()
        return
    from pyarrow import fs

    for x in store_of(uri)[0].get_file_info(fs.FileSelector(folder)):
        yield x.path, x.base_name, x.type == fs.FileType.Directory


def _base(uri: str) -> str:
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else store_of(uri)[1]


def _walk(uri: str) -> Iterator[str]:
    folders = [_base(uri)]
    while folders:
        for path, name, is_folder in _entries(uri, folders.pop()):
            if not _hidden(name):
                if is_folder:
                    folders.append(path)
                else:
                    yield path


def _content(uri: str, store, path: str) -> bytes:
    if store is None:
        with open(path, "rb") as f:
            value = f.read()
    else:
        with store.open_input_stream(path, compression=None) as f:
            value = f.read()
    ending = os.path.splitext(path)[1]
    if ending in _OTHERS:
        raise ValueError(f"{path}: files packed as {ending} are not read")
    begin, unpacked = _PACKED.get(ending, (b"", bytes))
    return unpacked(value) if value.startswith(begin) else value


def is_folder(uri: str) -> bool:
    """Whether uri is a folder that Python can list."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return os.path.isdir(_base(uri))
    try:
        store, base = store_of(uri)
        return store.get_file_info(base).type == fs.FileType.Directory
    except Exception:  # whatever the store's library raises where it is not there
        return False


def listed(spark: SparkSession, uri: str) -> DataFrame:
    """(path binary) of each file below a folder, but hidden ones.  One task lists it, since a
    folder can only be read from its begin; the driver does not hold the names."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for _ in range(batch.num_rows):
                paths: list[bytes] = []
                for path in _walk(uri):
                    paths.append(os.fsencode(path))
                    if len(paths) == EACH:
                        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.binary())})
                        paths = []
                if paths:
                    yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.binary())})

    return spark.range(0, 1, 1, 1).mapInArrow(run, "path binary")


def contents(files: DataFrame, uri: str) -> DataFrame:
    """(name, value): the bare name and the content of each file of ``listed``."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        store = None if uri.startswith("file:") else store_of(uri)[0]
        of = lambda names, values: pa.RecordBatch.from_pydict({"name": pa.array(names, pa.binary()), "value": pa.array(values, pa.binary())})
        for batch in batches:
            names, values, size = [], [], 0
            for path in batch.column("path").to_pylist():
                names.append(path.rpartition(b"/")[2])
                values.append(_content(uri, store, os.fsdecode(path)))
                size += len(values[-1])
                if len(names) == ROWS or size >= BYTES:
                    yield of(names, values)
                    names, values, size = [], [], 0
            if names:
                yield of(names, values)

    read = files.mapInArrow(run, "name binary, value binary")
    return read.select(F.col("name").cast("string").alias("name"), F.col("value").cast("string").alias("value"))
