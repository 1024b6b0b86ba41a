"""URL filter lists in a sorted digest array.

The rules are hashed to 64-bit xxhash keys and sorted by that; in that order they
are written to one file with their full strings and verdicts.  Rules that come as
a DataFrame are hashed and sorted by Spark, and the driver holds a partition of
them at a time; a list, which the driver has anyway, takes no Spark job.  Spark ships the file to every executor,
tasks memory-map it, hash the host suffixes and path prefixes of a batch of URLs,
find them all with one vectorised binary search, and compare the stored string
of each hit, so that two strings with one digest are never mistaken.
"""

from __future__ import annotations

import mmap
import os
import shutil
import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.base import table

#: Of XXH64, as Spark's function of that name has it.
SEED = 42

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict); of the rules that fit, the longest string wins.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

#: Hosts that are blocked where no rule fits, whatever their path.
BLOCKED = [
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
]


def key(host: str, path: str) -> bytes:
    """A host has no slash but a path may lack one, so a byte that no host holds separates them."""
    return host.encode() + b"\0" + path.encode()


def digest(k: bytes) -> int:
    return xxhash.xxh64_intdigest(k, SEED)


def write_index(path: str, entries: Iterable[tuple[int, bytes, str]]) -> None:
    """entries: (digest, key, verdict), different keys by rising digests.  They are
    written as they come: digests, ends of the strings, lengths of the paths, strings."""
    n, end, lengths = 0, 0, set()
    names = [f"{path}.{x}" for x in ("digests", "ends", "strings")]
    with open(names[0], "wb") as digests, open(names[1], "wb") as ends, open(names[2], "wb") as strings:
        ends.write(struct.pack("<q", 0))
        for d, k, verdict in entries:
            text = k + b"\0" + verdict.encode()
            end += len(text)
            n += 1
            lengths.add(len(k.partition(b"\0")[2]))
            digests.write(struct.pack("<Q", d))
            ends.write(struct.pack("<q", end))
            strings.write(text)
    with open(path, "wb") as f:
        f.write(struct.pack("<qq", n, len(lengths)))
        for name, more in zip(names, (b"", struct.pack(f"<{len(lengths)}q", *sorted(lengths)), b""), strict=True):
            with open(name, "rb") as part:
                shutil.copyfileobj(part, f)
            f.write(more)
            os.remove(name)


class Index:
    """A memory-mapped list of (host, path, verdict) entries."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, m = struct.unpack_from("<qq", self.map)
        self.digests = np.frombuffer(self.map, np.uint64, n, 16)
        self.ends = np.frombuffer(self.map, np.int64, n + 1, 16 + 8 * n)
        #: distinct path lengths in bytes: only these prefixes can be entries
        self.path_lengths = np.frombuffer(self.map, np.int64, m, 24 + 16 * n).tolist()
        self.text = 24 + 16 * n + 8 * m

    def entry(self, i: int) -> tuple[bytes, str]:
        k, _, verdict = self.map[self.text + self.ends[i] : self.text + self.ends[i + 1]].rpartition(b"\0")
        return k, verdict.decode()

    def find(self, keys: list[bytes]) -> list[str | None]:
        """The verdict of each key, or None."""
        found: list[str | None] = [None] * len(keys)
        if not keys or not len(self.digests):
            return found
        digests = np.fromiter((digest(k) for k in keys), np.uint64, len(keys))
        low = np.searchsorted(self.digests, digests, "left")
        high = np.searchsorted(self.digests, digests, "right")
        for i in np.flatnonzero(high > low):
            for j in range(low[i], high[i]):  # more than one where digests collide
                k, verdict = self.entry(j)
                if k == keys[i]:
                    found[i] = verdict
        return found


def candidates(host: str, path: str, path_lengths: list[int]) -> Iterator[bytes]:
    p, suffix = path.encode(), host.encode()
    prefixes = [p[:n] for n in path_lengths if n <= len(p)]
    while True:
        for x in prefixes:
            yield suffix + b"\0" + x
        if b"." not in suffix:
            return
        suffix = suffix.partition(b".")[2]


def longest(index: Index, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
    """For each URL the longest entry that fits it (ties by bytes): host + path, verdict."""
    keys: list[bytes] = []
    counts = []
    for h, p in zip(hosts, paths, strict=True):
        before = len(keys)
        keys += candidates(h, p, index.path_lengths)
        counts.append(len(keys) - before)
    found = index.find(keys)
    out, at = [], 0
    for n in counts:
        best = max((i for i in range(at, at + n) if found[i] is not None), key=lambda i: (len(keys[i]), keys[i]), default=None)
        out.append(None if best is None else (keys[best].replace(b"\0", b"").decode(), found[best]))
        at += n
    return out


def listed(rules: Iterable[tuple]) -> list[tuple[int, bytes, str]]:
    """The entries of an index from a list of rules, as ship() takes them."""
    least: dict[bytes, str] = {}
    for host, path, verdict in rules:
        if host is not None and path is not None and verdict is not None:
            k = key(host, path)
            least[k] = min(verdict, least.get(k, verdict))
    return sorted((digest(k), k, v) for k, v in least.items())


def ordered(rules: DataFrame) -> Iterator[tuple[int, bytes, str]]:
    """The same from a DataFrame, a partition at a time."""
    one = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    digests = F.xxhash64(F.concat("host", F.lit("\0"), "path"))
    # digests are unsigned: those with the highest bit come last
    found = one.withColumn("digest", digests).orderBy(F.col("digest") < 0, "digest")
    return ((r.digest & (1 << 64) - 1, key(r.host, r.path), r.verdict) for r in found.toLocalIterator())


#: Folders of index files that executors may still ask the driver for; they go when Python ends.
_served: list[tempfile.TemporaryDirectory] = []


def ship(spark: SparkSession, entries: Iterable[tuple[int, bytes, str]]) -> str:
    """Writes the index of entries and hands it to every executor; gives its name there.
    Of rules with the same host and path the least verdict holds."""
    name = f"urls-{uuid.uuid4().hex}.idx"
    _served.append(tempfile.TemporaryDirectory(prefix="scrubline-"))
    path = os.path.join(_served[-1].name, name)
    write_index(path, entries)
    spark.sparkContext.addFile(path)
    return name


_open: dict[str, Index] = {}


def opened(name: str) -> Index:
    if name not in _open:
        _open[name] = Index(SparkFiles.get(name))
    return _open[name]


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """df plus ``host`` and ``path`` (empty where the URL is null or has no ``://``)."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    return df.withColumns({"host": host, "path": F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)})


def judge(df: DataFrame, url_col: str = "url", rules=RULES, blocked=BLOCKED) -> DataFrame:
    """df plus ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    rules: (host, path, verdict) triples, or a DataFrame of them, of any size that
    fits an executor's disk; those with a null are left out.  A rule fits its host
    and all subdomains if the path starts with the rule's.  Of those that fit the
    longest wins.  Where none fits, the hosts of ``blocked`` and their subdomains
    are blocked and others allowed.  Null URLs and URLs without ``://`` have an
    empty host and path and are allowed.  Rows do not see each other, so repeated
    ones get the same; an empty table gives no rows.  Columns of df with one of the
    four names (in any case) are replaced, but url_col itself is read first.
    """
    spark = df.sparkSession
    names = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c.lower() not in names]
    source = split_url(df.select(*kept, F.col(url_col).alias("__url")), "__url").drop("__url")
    first = ship(spark, ordered(rules.toDF("host", "path", "verdict")) if isinstance(rules, DataFrame) else listed(rules))
    second = ship(spark, listed((h, "", "block") for h in blocked))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, more = opened(first), opened(second)
        for b in batches:
            hosts, paths = b.column("host").to_pylist(), b.column("path").to_pylist()
            best, other = longest(index, hosts, paths), longest(more, hosts, [""] * len(hosts))
            rule = pa.array([k and k[0] for k in best], pa.string())
            verdict = [k[1] if k else "block" if o else "allow" for k, o in zip(best, other, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, rule, pa.array(verdict, pa.string())], [*b.schema.names, "rule", "verdict"]
            )

    schema = T.StructType([*source.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return source.mapInArrow(tasks, schema)


def op8_filter_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


_HOST = "translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH u AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT * FROM (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}) t(h, p, v)),
b AS (SELECT * FROM (VALUES {', '.join(f"('{h}')" for h in BLOCKED)}) t(h)),
f AS (
  SELECT page_id, host, path,
    (SELECT max_by(h || p || ' ' || v, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best,
    EXISTS (SELECT 1 FROM b WHERE host = h OR ends_with(host, '.' || h)) AS bad
  FROM u)
SELECT page_id, host, path, split_part(best, ' ', 1) AS rule,
       CASE WHEN best IS NOT NULL THEN split_part(best, ' ', 2) WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM f
"""
