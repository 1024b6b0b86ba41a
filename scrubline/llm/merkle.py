"""A manifest of a dataset: Merkle trees with the authentication path of every row.

Rows of a group are numbered in order by range partitions and two-level sums, so
no task holds a group.  Aligned blocks of ``ARITY ** HEIGHT`` leaves are one
task's work each.  A task goes over a block by fractal traversal: the levels of
the block's tree are stacked in layers of a few levels.  Of each layer the
existing subtree, over the leaf at hand, gives the siblings, while the desired
one, next to it, grows by a leaf for every leaf that goes by and takes its place
when the leaf leaves it.  So successive paths come out with two small subtrees a
layer in memory.  The blocks' roots are hashed upwards by grouping, level by
level, and the paths from there to the root come back down by joins; each block's
upper path is appended to the paths of its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.base import stored, table

#: Nodes in a run, levels of a block (its leaves are ARITY ** HEIGHT) and of a layer of it.
ARITY, HEIGHT, LAYER = 8, 4, 2
_PATH = "array<struct<place:int,siblings:string>>"
_DIGEST = 64


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and itself, ``-`` for null."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]), 256)


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path lead to."""
    def up(n: Column, step: Column) -> Column:
        at = step["place"] * _DIGEST
        return F.sha2(F.concat(F.substring(step["siblings"], F.lit(1), at), n, F.substring(step["siblings"], at + 1, F.lit(ARITY * _DIGEST))), 256)

    return F.aggregate(path, node, up)


def joined(path: Column) -> Column:
    """The siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: step["siblings"]), "")


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows plus ``place`` (from 0 in each group, in order) and ``total`` (rows of the group).

    The row's number in the input is the last key, so that repeated rows can be split.
    """
    keys = [group, *order, "__row"]
    ordered = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    kept = stored(ordered.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()), "ordered")
    sizes = kept.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    own = Window.partitionBy("__g")
    runs = sizes.select("__g", "__p", "first", (F.sum("n").over(own.orderBy("__p")) - F.col("n")).alias("before"), F.sum("n").over(own).alias("total"))
    found = kept.join(runs, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return found.withColumn("place", F.col("__at") - F.col("first") + F.col("before")).drop("__at", "__part", "__g", "__p", "first", "before")


def _hash(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


class Subtree:
    """The nodes of the levels from ``base`` up to below ``top`` over leaves that come one after the other."""

    def __init__(self, base: int, top: int):
        self.base, self.top = base, top
        self.open: list[list[bytes]] = [[] for _ in range(top)]
        self.nodes: list[list[bytes]] = [[] for _ in range(base, top)]
        self.root: bytes | None = None

    def add(self, node: bytes, level: int = 0) -> None:
        while level < self.top:
            if level >= self.base:
                self.nodes[level - self.base].append(node)
            run = self.open[level]
            run.append(node)
            if len(run) < ARITY:
                return
            node, self.open[level] = _hash(run), []
            level += 1
        self.root = node

    def close(self) -> None:
        """There are no more leaves: what is open is hashed as it is."""
        for level in range(self.top):
            if run := self.open[level]:
                self.open[level] = []
                self.add(_hash(run), level + 1)


def height_of(total: int, most: int = HEIGHT) -> int:
    """Levels that the tree of a block has: ``most`` if the group has more blocks than one."""
    h = 0
    while h < most and ARITY**h < total:
        h += 1
    return h


def block_root(leaves: list[bytes], height: int) -> bytes:
    tree = Subtree(0, height)
    for x in leaves:
        tree.add(x)
    tree.close()
    return tree.root


class Traversal:
    """The authentication paths of a block's leaves, one after the other: step() gives, from
    the lowest level up, the place in its run and the siblings of each node above a leaf."""

    def __init__(self, leaves: list[bytes], height: int, layer: int = LAYER):
        self.leaves, self.k = leaves, 0
        self.layers = [(b, min(b + layer, height)) for b in range(0, height, layer)]
        self.existing = [self._grown(b, t, 0, ARITY**t) for b, t in self.layers]
        self.desired = [Subtree(b, t) for b, t in self.layers]
        self.path: list[tuple[int, bytes]] = [(0, b"")] * height

    def _grown(self, base: int, top: int, begin: int, end: int) -> Subtree:
        out = Subtree(base, top)
        for x in self.leaves[begin:end]:
            out.add(x)
        out.close()
        return out

    def step(self) -> list[tuple[int, bytes]]:
        k = self.k
        for i, (base, top) in enumerate(self.layers):
            span = ARITY**top
            if k and k % span == 0:
                self.existing[i], self.desired[i] = self.desired[i], Subtree(base, top)
            for level in range(base, top):
                if k % ARITY**level == 0:  # else the node above is still the same
                    at = k % span // ARITY**level
                    place = at % ARITY
                    run = self.existing[i].nodes[level - base][at - place : at - place + ARITY]
                    self.path[level] = (place, b"".join(run[:place] + run[place + 1 :]))
            if k + span < len(self.leaves):
                self.desired[i].add(self.leaves[k + span])
                if k + span == len(self.leaves) - 1:
                    self.desired[i].close()
        self.k += 1
        return self.path


def _blocks(batches: Iterator[pa.RecordBatch], first) -> Iterator[pa.Table]:
    """The rows of each block; first(batch): where blocks begin."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        at = 0
        for s in np.flatnonzero(first(b)).tolist():
            held += [b.slice(at, s - at)] * (s > at)
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], s
        held += [b.slice(at)] * (b.num_rows > at)
    if held:
        yield pa.Table.from_batches(held)


def _digests(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def block_roots(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(g, j, m, node)``: the root of each block j of a group, and the number m of its blocks;
    rows: (g, place, total, leaf)."""
    size = ARITY**height
    dealt = rows.withColumn("unit", F.xxhash64("g", F.floor(F.col("place") / size)))
    ordered = dealt.select("unit", "g", "place", "total", "leaf").repartition("unit").sortWithinPartitions("unit", "g", "place")
    group = rows.schema["g"].dataType

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches, lambda b: b.column("place").to_numpy() % size == 0):
            total, place = t["total"][0].as_py(), t["place"][0].as_py()
            node = block_root(_digests(t["leaf"]), height_of(total, height))
            yield pa.RecordBatch.from_arrays(
                [t["g"].slice(0, 1).combine_chunks(), pa.array([place // size]), pa.array([-(-total // size)]), pa.array([node.decode()])], ["g", "j", "m", "node"])

    fields = [T.StructField("g", group), T.StructField("j", T.LongType()), T.StructField("m", T.LongType()), T.StructField("node", T.StringType())]
    return ordered.mapInArrow(tasks, T.StructType(fields))


def upward(nodes: DataFrame) -> DataFrame:
    """``(g, j, root, path)`` of nodes (g, j, m, node), the m nodes of each group numbered from 0:
    the group's root and the path to it.

    A level is a grouping by runs, and the way back a join with the parents; groups
    that are down to one node wait.  One number, the largest m, comes to the driver.
    """
    level = stored(nodes, "nodes")
    most = level.agg(F.max("m")).first()[0] or 0
    ended, runs = [], []
    while True:
        ended.append(level.where("m = 1").select("g", "j", F.col("node").alias("root"), F.array().cast(_PATH).alias("path")))
        if most <= 1:
            break
        run = F.transform(F.array_sort(F.collect_list(F.struct("j", "node"))), lambda x: x["node"])
        grouped = level.where("m > 1").groupBy("g", F.floor(F.col("j") / ARITY).alias("j"), "m").agg(run.alias("run"))
        runs.append(stored(grouped, "runs"))
        level = runs[-1].select("g", "j", F.ceil(F.col("m") / ARITY).alias("m"), F.sha2(F.array_join("run", ""), 256).alias("node"))
        most = -(-most // ARITY)
    found = ended.pop()
    for own in reversed(runs):
        one = own.select("g", F.col("j").alias("up"), "run", F.posexplode("run").alias("place", "node"))
        others = F.array_join(F.concat(F.slice("run", F.lit(1), F.col("place")), F.slice("run", F.col("place") + 2, F.lit(ARITY))), "")
        step = F.array(F.struct("place", others.alias("siblings"))).cast(_PATH)
        one = one.select(F.col("g").alias("g1"), "up", (F.col("up") * ARITY + F.col("place")).alias("j1"), step.alias("step"))
        below = one.join(found, F.col("g1").eqNullSafe(F.col("g")) & (F.col("up") == F.col("j")))
        found = ended.pop().union(below.select(F.col("g1").alias("g"), F.col("j1").alias("j"), "root", F.concat("step", "path").alias("path")))
    return found


def block_paths(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(g, j, subroot, root, path)``: the manifest of the blocks; rows: (g, place, total, leaf).
    path leads from a block over its group's root to the root of all."""
    lower = stored(upward(block_roots(rows, height)), "lower")
    groups = lower.where("j = 0").select("g", "root", F.lit(0).alias("all"))
    groups = stored(placed(groups, "all", ["g"]).select("g", "root", "place", "total"), "groups")
    upper = stored(upward(groups.select(F.lit(0).alias("g"), F.col("place").alias("j"), F.col("total").alias("m"), F.col("root").alias("node"))), "upper")
    named = groups.join(upper.select("j", F.col("root").alias("top"), F.col("path").alias("more")), F.col("place") == F.col("j"))
    named = named.select(F.col("g").alias("g2"), "top", "more")
    out = lower.join(named, F.col("g").eqNullSafe(F.col("g2")))
    return out.select("g", "j", F.col("root").alias("subroot"), F.col("top").alias("root"), F.concat("path", "more").alias("path"))


def authenticated(df: DataFrame, leaf_col: str, group: str, order: list[str], keep: list[str], height: int = HEIGHT, layer: int = LAYER) -> DataFrame:
    """The columns ``keep`` of df, and ``leaf, subroot, root, path`` of every row.

    leaf_col: the digest of each row (hexadecimal, as ``leaf`` makes it).  The rows
    of a group are its leaves by ``order`` (nulls first), then by their digest;
    repeated rows are leaves of their own.  While a group has more nodes than one,
    every ARITY consecutive ones become the digest of their digests; what is left
    are subroots, by group (null first), which give the root likewise.  path: for
    each level from the leaf's to the root's, the place of the node in its run and
    the digests of the others there in a row.  Other columns are ignored, as are
    their names; an empty table gives no rows.
    """
    mine = [f"__keep{i}" for i in range(len(keep))]
    rows = df.select(F.col(group).alias("g"), F.col(leaf_col).alias("leaf"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                     *[F.col(c).alias(m) for c, m in zip(keep, mine, strict=True)])
    rows = stored(rows, "digests")  # dealing by ranges reads its input twice
    rows = stored(placed(rows, "g", [*[f"__o{i}" for i in range(len(order))], "leaf"]).select("g", "leaf", "place", "total", *mine), "leaves")
    paths = block_paths(rows, height)
    size = ARITY**height
    unit = F.xxhash64("g", "j").alias("unit")
    block = F.floor(F.col("place") / size).alias("j")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    types = [rows.schema[m].dataType for m in mine]
    leaves = rows.select("g", block, "place", "total", "leaf", none("string", "subroot"), none("string", "root"), none(_PATH, "path"), *mine)
    heads = paths.select("g", "j", F.lit(-1).cast("long").alias("place"), none("long", "total"), none("string", "leaf"), "subroot", "root", "path",
                         *[none(t, m) for t, m in zip(types, mine, strict=True)])
    dealt = leaves.union(heads).select(unit, "*").repartition("unit").sortWithinPartitions("unit", "g", "j", "place")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches, lambda b: b.column("place").to_numpy() == -1):
            head, t = t.slice(0, 1), t.slice(1).combine_chunks()
            upper = [(x["place"], x["siblings"].encode()) for x in head["path"][0].as_py()]
            leaves = _digests(t["leaf"])
            height_ = height_of(t["total"][0].as_py(), height)
            walk = Traversal(leaves, height_, layer)
            for at in range(0, len(leaves), 1024):
                part = t.slice(at, 1024).combine_chunks()
                n = part.num_rows
                steps = [s for _ in range(n) for s in (*walk.step(), *upper)]
                places = pa.array([s[0] for s in steps], pa.int32())
                siblings = pa.array([s[1] for s in steps], pa.binary()).cast(pa.string())
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * (height_ + len(upper)))
                path = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([places, siblings], ["place", "siblings"]))
                same = lambda c: pa.array([head[c][0].as_py()] * n, pa.string())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [*(part[m].combine_chunks() for m in mine), part["leaf"].combine_chunks(), same("subroot"), same("root"), path],
                    [*mine, "leaf", "subroot", "root", "path"])

    fields = [*(T.StructField(m, t) for m, t in zip(mine, types, strict=True)), *(T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root"))]
    out = dealt.drop("unit", "g", "j").mapInArrow(tasks, T.StructType([*fields, T.StructField("path", T._parse_datatype_string(_PATH))]))
    return out.select(*[F.col(m).alias(c) for c, m in zip(keep, mine, strict=True)], "leaf", "subroot", "root", "path")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_dataset_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = [F.col(c) for c in docs.columns]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(changed, leaf([*columns[:-1], F.translate("text", UPPER, LOWER)]))
    rows = docs.select("doc_id", "lang", leaf(columns).alias("digest"), tampered.alias("other"))
    found = authenticated(rows, "digest", "lang", ["doc_id"], ["doc_id", "other"])
    folded = found.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(joined(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _levels(of: str, name: str, n: int) -> str:
    """SQL of the levels {name}0 … {name}n of nodes (g, j, m, node), and of their runs."""
    out = f"{name}0 AS (SELECT g, j, m, node FROM {of})"
    for t in range(n):
        out += (f", {name}r{t} AS (SELECT g, j // 8 AS j, m, list(node ORDER BY j) AS run FROM {name}{t} GROUP BY g, j // 8, m)"
                f", {name}{t + 1} AS (SELECT g, j, CASE WHEN m = 1 THEN 1 ELSE (m + 7) // 8 END AS m, "
                f"CASE WHEN m = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM {name}r{t})")
    return out


def _walks(of: str, name: str, levels: str, n: int) -> str:
    """SQL of the paths of rows (r, g, j, s, f) over n levels: siblings so far, node so far."""
    out, before = "", of
    for t in range(n):
        left, right = "array_to_string(run[1:p.j % 8], '')", "array_to_string(run[p.j % 8 + 2:], '')"
        out += (f", {name}{t} AS (SELECT r, p.g, p.j // 8 AS j, CASE WHEN q.m = 1 THEN s ELSE s || {left} || {right} END AS s, "
                f"CASE WHEN q.m = 1 THEN f ELSE sha256({left} || f || {right}) END AS f "
                f"FROM {before} p JOIN {levels}r{t} q ON p.g IS NOT DISTINCT FROM q.g AND p.j // 8 = q.j)")
        before = f"{name}{t}"
    return out


_field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
_leaf = lambda text: "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
_BITS = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"
_CRC = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: {_BITS}))"

#: Seven levels in a language and three above: up to two million rows a language and 512 languages.
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents),
l AS (SELECT r, doc_id, lang AS g, leaf AS node, coalesce(other, leaf) AS f, '' AS s, count(*) OVER (PARTITION BY lang) AS m,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j FROM d),
{_levels("l", "a", 7)}{_walks("l", "w", "a", 7)},
k AS (SELECT g AS lang, 0 AS g, node, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS j, count(*) OVER () AS m FROM a7),
{_levels("k", "b", 3)},
v AS (SELECT r, k.g, k.j, s, f FROM w6 JOIN k ON w6.g IS NOT DISTINCT FROM k.lang){_walks("v", "x", "b", 3)}
SELECT l.doc_id, l.node AS leaf, k.node AS subroot, b3.node AS root, sha256(x2.s) AS proof_sha256, x2.f AS folded_root, x2.f = b3.node AS verified
FROM l JOIN x2 USING (r) JOIN k ON l.g IS NOT DISTINCT FROM k.lang, b3
"""
