"""Embedding near-duplicates with an inverted multi-index.

The two halves of the unit vectors have codebooks of their own; a pair of
centroids is a cell of the product grid.  Each vector visits cells in the order
of a multi-sequence traversal, by the sum of their centroids' distances, as many
as the target recall needs, and its cosine with every vector in those cells is
computed in double precision.  How many that are is calibrated on vectors which
the codebooks have not seen.

A vector travels once for each left centroid among its cells, with the right ones
it visits there, to the vectors that have this left centroid.  Such groups are
split into blocks where they are large, so no cell is one task's work, and no
pairs are written out: a task gives link counts and star edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.base import components, dropped, stored, table

THRESHOLD = 0.9
#: The index is fitted on at most this many vectors, chosen by hash: one half makes the codebooks, the other calibrates.
SAMPLE = 65_536
#: Calibration takes this many of the other half as queries.
QUERIES = 2_000
#: The recall that is aimed at: of the links within the other half, of links made at random between
#: the threshold and 1, which are farther apart than real ones, and of those in the band above the threshold.
TARGET_RECALL, MADE_RECALL, EDGE_RECALL, EDGE = 0.99, 0.98, 0.95, 0.02
#: Vectors a cell should hold, those that a centroid is made of, and the largest codebook.
PER_CELL, PER_CODE, MAX_CODES = 16, 30, 8_192
#: The vectors of a left centroid and their visitors are split into blocks of about this many.
BLOCK = 8_192
#: Visitors that are compared at once.
CHUNK = 512


@dataclass
class Grid:
    left: np.ndarray
    right: np.ndarray
    visits: int

    def visited(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells, bound): the cells i * codes + j that each vector visits, its own first, and a sum
        of distances that those lie under and all others over."""
        half = unit.shape[1] // 2
        return traverse(far(unit[:, :half], self.left), far(unit[:, half:], self.right), self.visits)


def far(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Places of the n least numbers of each row, in order."""
    at = np.argpartition(x, n - 1, axis=1)[:, :n] if n < x.shape[1] else np.broadcast_to(np.arange(n), x.shape)
    return np.take_along_axis(at, np.argsort(np.take_along_axis(x, at, 1), axis=1, kind="stable"), 1)


def traverse(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n cells (i * codes + j) of least a[i] + b[j] of each row, in order, and the bound behind them.

    With both sequences sorted, a cell has all that are no later in either before
    it, so only cells (x, y) with (x + 1)(y + 1) <= n + 1 can be among the first n
    or next to come: that front is laid out for all rows at once.
    """
    k, cells = a.shape[1], a.shape[1] * b.shape[1]
    n = min(n, cells)
    deep = min(n + 1, cells)
    u, v = _least(a, min(k, deep)), _least(b, min(b.shape[1], deep))
    x = np.concatenate([np.full(min(v.shape[1], deep // (i + 1)), i) for i in range(u.shape[1])])
    y = np.concatenate([np.arange(min(v.shape[1], deep // (i + 1))) for i in range(u.shape[1])])
    sums = np.take_along_axis(a, u, 1)[:, x] + np.take_along_axis(b, v, 1)[:, y]
    order = _least(sums, deep)
    ranked = np.take_along_axis(sums, order, 1)
    i, j = np.take_along_axis(u, x[order[:, :n]], 1), np.take_along_axis(v, y[order[:, :n]], 1)
    bound = (ranked[:, n - 1] + ranked[:, n]) / 2 if deep > n else np.full(len(a), np.inf)
    return i * b.shape[1] + j, bound


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([far(x[i : i + 2048], centres).argmin(1) for i in range(0, len(x), 2048)])
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _ranks(grid: Grid, unit: np.ndarray, to: np.ndarray) -> np.ndarray:
    """How many cells each vector visits before the own cell of the vector beside it.
    They are counted, not laid out: memory does not depend on the answer."""
    half = unit.shape[1] // 2
    i, j = far(to[:, :half], grid.left).argmin(1), far(to[:, half:], grid.right).argmin(1)
    a, b = far(unit[:, :half], grid.left), far(unit[:, half:], grid.right)
    rows = np.arange(len(unit))
    goal = a[rows, i] + b[rows, j]
    b = np.sort(b, axis=1)
    return np.array([np.searchsorted(b[r], goal[r] - a[r] - 1e-12).sum() for r in rows], np.int64)


def _needed(ranks: np.ndarray, recall: float) -> int:
    return int(np.sort(ranks)[min(len(ranks), math.ceil(recall * len(ranks))) - 1]) + 1 if len(ranks) else 1


def turned(base: np.ndarray, low: float, high: float, rng: np.random.Generator) -> np.ndarray:
    """Unit vectors of a random cosine between low and high with those of base."""
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(1, keepdims=True) * base
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    cosine = rng.uniform(low, high, (len(base), 1))
    return cosine * base + np.sqrt(1 - cosine**2) * turn


def fit(sample: np.ndarray, n: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, seed: int = 5) -> Grid:
    """The index for n vectors from a sample of unit vectors, in random order.

    One half makes the codebooks.  visits: enough for ``recall`` of the links
    among the other half, and for MADE_RECALL and EDGE_RECALL of links made by
    turning its vectors by a random angle within the threshold, or within EDGE of
    it, up to all cells.
    """
    rng = np.random.default_rng(seed)
    half = sample.shape[1] // 2
    train, held = (sample[: (len(sample) + 1) // 2], sample[(len(sample) + 1) // 2 :]) if len(sample) > 1 else (sample, sample)
    k = int(min(MAX_CODES, max(1, round(math.sqrt(n / PER_CELL))), max(1, len(train) // PER_CODE)))
    grid = Grid(codebook(train[:, :half], k, rng), codebook(train[:, half:], k, rng), 1)
    queries = held[rng.choice(len(held), min(QUERIES, len(held)), replace=False)]
    one, other = [], []
    for at in range(0, len(queries), 256):
        cosines = queries[at : at + 256] @ held.T
        i, j = np.nonzero((cosines >= threshold) & (cosines < 1 - 1e-12))  # a vector is no link of its own
        some = rng.permutation(len(i))[: 32 * 256]
        one.append(queries[at + i[some]])
        other.append(held[j[some]])
    cases = [(np.concatenate(one), np.concatenate(other), recall)]
    for high, goal in ((1.0, MADE_RECALL), (min(1.0, threshold + EDGE), EDGE_RECALL)):
        cases.append((queries, turned(queries, threshold, high, rng), goal))
    # a link counts as found if either end visits the other's cell
    need = [_needed(np.concatenate([np.minimum(_ranks(grid, a[i : i + 512], b[i : i + 512]), _ranks(grid, b[i : i + 512], a[i : i + 512]))
                                    for i in range(0, len(a), 512)] or [np.zeros(0, np.int64)]), goal) for a, b, goal in cases]
    grid.visits = min(max(need), k * k)
    return grid


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    flat = flat / np.abs(flat).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _meet(cell: int, q: dict, m: dict, threshold: float, grid: Grid) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Visitors q and members m of a cell: (key, links) and star edges (a, b)."""
    near = q["unit"] @ m["unit"].T >= threshold
    near &= q["key"][:, None] != m["key"]
    i, j = np.nonzero(near)
    if not len(i):
        return (np.zeros(0, np.int64),) * 4
    # a pair of two cells is also found from the other side if that end visits this end's cell;
    # otherwise both ends count here
    half, codes = m["unit"].shape[1] // 2, len(grid.right)
    own = q["own"][i]
    alone = own != cell
    i1, j1 = i[alone], j[alone]
    to = ((m["unit"][j1, :half] - grid.left[own[alone] // codes]) ** 2).sum(1) + ((m["unit"][j1, half:] - grid.right[own[alone] % codes]) ** 2).sum(1)
    apart = to > m["bound"][j1]
    keys = np.concatenate([q["key"], m["key"]])
    links = np.concatenate([near @ m["copies"], np.bincount(j1[apart], q["copies"][i1[apart]], len(m["key"]))]).astype(np.int64)
    a, b = q["key"].copy(), m["key"].copy()  # least key reached so far
    top = np.iinfo(np.int64).max
    while True:
        b2 = np.minimum(b, np.where(near, a[:, None], top).min(0))
        a2 = np.minimum(a, np.where(near, b2, top).min(1))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    root = np.concatenate([a, b])
    linked, moved = links > 0, root != keys
    return keys[linked], links[linked], keys[moved], root[moved]


_OUT = "key long, links long, root long"
_BASE = ["key", "own", "bound", "copies"]


def _verified(dealt: DataFrame, dim: int, threshold: float, shared) -> DataFrame:
    """``(key, links, root)`` from rows ``(left, group, visitor, cells, key, own, bound, copies, v)``:
    either the number of links (root null) or a star edge (links null)."""
    ordered = dealt.repartition("left", "group").sortWithinPartitions("left", "group", "visitor", "own", "key")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        held: dict | None = None
        members: dict | None = None

        def read(b: pa.RecordBatch) -> dict:
            rows = {k: b.column(k).to_numpy(zero_copy_only=False) for k in _BASE}
            rows["unit"] = _unit(b.column("v"), dim)
            return rows

        def visited(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """The visitors of a batch, cell by cell."""
            q, cells = read(b), b.column("cells")
            who = np.repeat(np.arange(b.num_rows), np.diff(cells.offsets.to_numpy()))
            cell = cells.flatten().to_numpy()
            order = np.argsort(cell, kind="stable")
            who, cell = who[order], cell[order]
            here = np.unique(members["own"])
            lows, highs = np.searchsorted(members["own"], here, "left"), np.searchsorted(members["own"], here, "right")
            froms, tos = np.searchsorted(cell, here, "left"), np.searchsorted(cell, here, "right")
            parts = [
                _meet(int(c), {k: x[who[s:e]] for k, x in q.items()}, {k: x[lo:hi] for k, x in members.items()}, threshold, grid)
                for c, lo, hi, s, e in zip(here, lows, highs, froms, tos, strict=True) if e > s
            ]
            if parts:
                keys, links, a, b_ = (np.concatenate(x) for x in zip(*parts, strict=True))
                columns = [[pa.array(keys), pa.array(a)], [pa.array(links), pa.nulls(len(a), pa.int64())], [pa.nulls(len(keys), pa.int64()), pa.array(b_)]]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], ["key", "links", "root"])

        at: tuple | None = None
        for batch in batches:
            left, group, visitor = (batch.column(c).to_numpy() for c in ("left", "group", "visitor"))
            change = np.flatnonzero((np.diff(left) != 0) | (np.diff(group) != 0) | (np.diff(visitor) != 0)) + 1
            for s, e in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                if s == e:
                    continue
                if (left[s], group[s]) != at:
                    at, held, members = (left[s], group[s]), None, None
                b = batch.slice(s, e - s)
                if not visitor[s]:  # members come first, by cell
                    held = [*(held or []), read(b)]
                    continue
                if held:
                    members, held = {k: np.concatenate([x[k] for x in held]) for k in held[0]}, None
                if members is not None:
                    for i in range(0, b.num_rows, CHUNK):
                        yield from visited(b.slice(i, CHUNK))

    return ordered.mapInArrow(tasks, _OUT)


def _dealt(placed: DataFrame, visitors: DataFrame) -> DataFrame:
    """Members and visitors of every left centroid, in groups of a block of each."""
    none = F.lit(None).cast("array<int>").alias("cells")
    member = placed.select("left", F.lit(0).alias("visitor"), none, *_BASE, "v")
    visitor = visitors.select("left", F.lit(1).alias("visitor"), "cells", *_BASE, "v")
    rows = member.union(visitor)
    sizes = member.select("left", "visitor").union(visitor.select("left", "visitor")).groupBy("left").agg(F.sum(1 - F.col("visitor")).alias("m"), F.sum("visitor").alias("q"))
    sizes = sizes.where("m > 0").select(F.col("left").alias("l"), F.ceil(F.col("m") / BLOCK).alias("mb"), F.ceil(F.col("q") / BLOCK).alias("qb"))
    sizes = stored(sizes, "sizes")  # a row for each left centroid: MAX_CODES at most
    rows = rows.join(F.broadcast(sizes), rows.left == sizes.l)
    mine = F.xxhash64("key")
    groups = F.when(
        F.col("visitor") == 1, F.transform(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1), lambda x: x * F.col("qb") + F.pmod(mine, "qb"))
    ).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1), lambda x: F.pmod(mine, "mb") * F.col("qb") + x))
    return rows.select("left", F.explode(groups).alias("group"), "visitor", "cells", *_BASE, "v")


def _linked(unique: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``(key, links, component)`` of those of unique ``(key, v, copies)`` (vectors of one
    length, all different) that have links; copies count in links, but for the own ones."""
    sample = unique.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).toArrow()
    grid = fit(_unit(sample["v"].combine_chunks(), dim), unique.count(), threshold)
    shared = unique.sparkSession.sparkContext.broadcast(grid)
    kind = unique.schema["v"].dataType.simpleString()
    codes, step = len(grid.right), max(1, min(2000, (1 << 22) // (grid.visits + len(grid.left))))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                cells, bound = shared.value.visited(_unit(b.column("v"), dim))
                own = cells[:, 0].astype(np.int32)
                new = [pa.array(own // codes), pa.array(own), pa.array(bound)]
                yield pa.RecordBatch.from_arrays([b.column("key"), *new, b.column("copies"), b.column("v")], ["key", "left", "own", "bound", "copies", "v"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                cells = np.sort(shared.value.visited(_unit(b.column("v"), dim))[0], axis=1).astype(np.int32)
                left = cells // codes
                new = np.ones(left.shape, bool)
                new[:, 1:] = left[:, 1:] != left[:, :-1]
                starts = np.flatnonzero(new.ravel())
                who = pa.array(starts // cells.shape[1])
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, cells.size).astype(np.int32)), pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(left.ravel()[starts]), lists, *(b.column(c).take(who) for c in [*_BASE, "v"])], ["left", "cells", *_BASE, "v"])

    placed = stored(unique.select("key", "v", "copies").mapInArrow(locate, f"key long, left int, own int, bound double, copies long, v {kind}"), "placed")
    visitors = placed.select(*_BASE, "v").mapInArrow(send, f"left int, cells array<int>, key long, own int, bound double, copies long, v {kind}")
    found = stored(_verified(_dealt(placed, visitors), dim, threshold, shared), "found")
    dropped(placed)
    links = found.where("root IS NULL").groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("root IS NOT NULL").select(F.col("key").alias("a"), F.col("root").alias("b")))
    joined = links.join(groups, F.col("key") == F.col("id"), "left")
    return joined.select("key", "links", F.coalesce("component", "key").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each row of df.

    Rows link where their vectors have the same length and a cosine of at least
    threshold.  Vectors that are null, empty or zero or that hold null or
    non-finite components, and rows with a null id, link with nothing.  Each
    length of vectors has an index of its own, one after the other.  Equal
    vectors are one row until the end; rows that repeat an id count as vectors of
    their own, in links as in components.  Components may be of any number type.
    Other columns are ignored, and an empty table gives no rows.  A component
    that takes more than 50 rounds to close (a chain of some 2^25 links) is an error.
    """
    v = F.col(vec_col)
    if df.schema[vec_col].dataType.elementType.simpleString() not in ("float", "double"):
        v = v.cast("array<double>")
    whole = F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.coalesce(
        F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)
    )
    usable = F.when(F.col(id_col).isNotNull() & whole & F.exists(v, lambda x: x != 0), v)
    rows = stored(df.select(F.col(id_col).alias("vec_id"), usable.alias("v")).withColumns({
        "h1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))}), "rows")
    unique = rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    # a number stands for a vector, whatever ids it has
    unique = stored(unique.withColumns({"dim": F.size("v"), "key": F.monotonically_increasing_id()}), "vectors")
    dims = [r.dim for r in unique.select("dim").distinct().orderBy("dim").collect()]
    parts = [_linked(unique.where(F.col("dim") == d), d, threshold) for d in dims]
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    linked = stored(reduce(DataFrame.union, parts).withColumnRenamed("key", "k"), "linked")
    named = unique.select("h1", "h2", "key", "least", "copies").join(linked, F.col("key") == F.col("k"), "left")
    named = stored(named.select("h1", "h2", "least", "copies", "links", F.coalesce("component", "key").alias("c")), "named")
    # the smallest id of a component of several vectors; a vector by itself has its own
    smallest = named.where("links IS NOT NULL").groupBy(F.col("c").alias("c2")).agg(F.min("least").alias("component"))
    told = named.join(smallest, F.col("c") == F.col("c2"), "left").select(
        F.col("h1").alias("k1"), F.col("h2").alias("k2"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "least").alias("component"),
    )
    out = rows.join(told, (rows.h1 == told.k1) & (rows.h2 == told.k2), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op4_embedding_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
