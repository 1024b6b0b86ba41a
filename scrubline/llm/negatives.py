"""Hard negatives by inner product, from K-means inverted lists with radii.

Vectors become integers, so scores are exact.  A K-means codebook, fitted on a
bounded sample, deals all rows into clusters, each with the largest distance of
its rows from the centroid.  By Cauchy and Schwarz the score of anchor q with a
row of a cluster is at most q·c + |q| r and at least q·c - |q| r.  An anchor
visits clusters from the highest upper bound down, leaves out those that lie
outside its window of scores, and stops once the bound is strictly below the
score of its kth best row so far; so nothing that could count is missed.

Clusters travel in groups of about the same size (one that is larger is split),
and anchors go to groups.  First each goes to the group with its best cluster,
then, with the kth scores from there, to every other group that has a cluster
whose bound reaches them.  Tasks hold one group and the anchors that visit it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.base import stored, table
from scrubline.llm.embeddings import codebook, far

#: A component x becomes floor(SCALE * x), and no more than MOST either way.
SCALE, MOST = 256, 1 << 24
#: The codebook is fitted on at most so many rows, chosen by hash, and has at most so many centroids.
SAMPLE, MAX_CLUSTERS = 20_000, 4_096
#: Rows of a group: about GROUP times the square root of all, within bounds; anchors that a task takes.
GROUP, LEAST_GROUP, MOST_GROUP, ANCHORS = 16, 1_024, 65_536, 65_536
#: Anchors that are compared at once.
CHUNK = 512
_NONE = np.iinfo(np.int64).min


@dataclass
class Index:
    centres: np.ndarray
    radius: np.ndarray  # under 0: no row
    first: np.ndarray  # of each cluster: its first group
    pieces: np.ndarray  # and how many groups it is split over (else 1)

    def bounds(self, q: np.ndarray, clusters: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of scores (anchors x clusters), with room for rounding."""
        c, r = self.centres[clusters], self.radius[clusters]
        size = np.linalg.norm(q, axis=1)[:, None]
        middle, spread = q @ c.T, size * r
        slack = 1e-9 * (size * np.linalg.norm(c, axis=1) + spread) + 1e-3
        return middle - spread - slack, middle + spread + slack

    def groups_of(self, cluster: int, row: int) -> int:
        return int(self.first[cluster]) + row % int(self.pieces[cluster])


@dataclass
class Windows:
    """Of anchors (rows) and their slots (columns): the scores that count, and the kth best so far."""

    low: np.ndarray
    high: np.ndarray
    kth: np.ndarray

    @classmethod
    def of(cls, scores: list[list[int | None]], kths: list[list[int | None]], low: int, high: int) -> Windows:
        """low and high: in percent of a slot's score; a slot without a score takes all.
        Anchors with fewer slots than others have empty ones behind."""
        n, width = len(scores), max(map(len, scores), default=0)
        lo, hi = np.full((n, width), 1, np.int64), np.full((n, width), 0, np.int64)
        kth = np.full((n, width), _NONE, np.int64)
        for i, (ps, ks) in enumerate(zip(scores, kths, strict=True)):
            for j, (p, k) in enumerate(zip(ps, ks, strict=True)):
                lo[i, j], hi[i, j] = (_NONE + 1, np.iinfo(np.int64).max) if p is None else (-(-low * p // 100), high * p // 100)
                kth[i, j] = _NONE if k is None else k
        return cls(lo, hi, kth)

    def wanted(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Whether a cluster with these bounds (anchors x clusters) may hold a row for any slot."""
        least = np.maximum(self.low, self.kth).astype(float)
        ok = (upper[:, :, None] >= least[:, None]) & (lower[:, :, None] <= self.high[:, None].astype(float)) & (self.low <= self.high)[:, None]
        return ok.any(2)


def scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floating point while every sum stays under 2^53."""
    top = int(np.abs(q).max(initial=0)) * int(np.abs(m).max(initial=0)) * q.shape[1]
    if top < 1 << 53:
        return (q.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ m.astype(np.int64).T


@dataclass
class Members:
    """Rows of a group by cluster, then by id: of equal scores the first comes first."""

    cluster: np.ndarray
    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray

    def __post_init__(self) -> None:
        order = np.lexsort((self.row, self.id, self.cluster))
        for f in ("cluster", "row", "id", "label", "v"):
            setattr(self, f, getattr(self, f)[order])
        self.clusters, self.starts = np.unique(self.cluster, return_index=True)
        self.ends = np.append(self.starts[1:], len(self.cluster))


def visit(index: Index, m: Members, q: np.ndarray, row: np.ndarray, label: np.ndarray, w: Windows, same: bool, k: int):
    """The k best rows of a group for each anchor and slot: scores and places in m (-1: none)."""
    n, width = w.low.shape
    best, place = np.full((n, width, k), _NONE, np.int64), np.full((n, width, k), -1, np.int64)
    lower, upper = index.bounds(q.astype(np.float64), m.clusters)
    order = np.argsort(-upper, axis=1, kind="stable")
    for t in range(len(m.clusters)):
        at = order[:, t]
        i = np.arange(n)
        open_ = np.flatnonzero(w.wanted(lower[i, at][:, None], upper[i, at][:, None])[:, 0])
        if not len(open_):
            continue
        for c in np.unique(at[open_]).tolist():
            who = open_[at[open_] == c]
            s, e = int(m.starts[c]), int(m.ends[c])
            found = scores(q[who], m.v[s:e])
            kind = m.label[s:e] == label[who][:, None]
            fits = (kind if same else ~kind) & (m.row[s:e] != row[who][:, None])
            for j in range(width):
                low = np.maximum(w.low[who, j], w.kth[who, j])[:, None]
                x = np.where(fits & (found >= low) & (found <= w.high[who, j][:, None]), found, _NONE)
                new, where = np.full((len(who), k), _NONE, np.int64), np.full((len(who), k), -1, np.int64)
                mine = np.arange(len(who))
                for r in range(min(k, e - s)):
                    top = x.argmax(1)  # the first of equal ones
                    new[:, r] = x[mine, top]
                    where[:, r] = np.where(new[:, r] > _NONE, s + top, -1)
                    x[mine, top] = _NONE
                    if not (new[:, r] > _NONE).any():
                        break
                both, places = np.concatenate([best[who, j], new], 1), np.concatenate([place[who, j], where], 1)
                ids, rows = np.where(places >= 0, m.id[places], 0), np.where(places >= 0, m.row[places], 0)
                kept = np.lexsort((rows, ids, ~both), axis=1)[:, :k]
                best[who, j], place[who, j] = np.take_along_axis(both, kept, 1), np.take_along_axis(places, kept, 1)
                w.kth[who, j] = np.maximum(w.kth[who, j], best[who, j, k - 1])
    return best, place


def _vectors(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim)


def _numbers(column, kind=np.int64) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy(), kind)


def layout(counts: np.ndarray, centres: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first group, pieces) of each cluster: neighbours share a group while it has room, a large one has groups to itself."""
    first, pieces = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    open_, group, held = set(np.flatnonzero(counts).tolist()), 0, 0
    at = min(open_, default=None)
    while at is not None:
        open_.discard(at)
        n = int(counts[at])
        if n > size:
            pieces[at] = -(-n // size)
            group += held > 0
            first[at], held = group, 0
            group += int(pieces[at])
        else:
            if held and held + n > size:
                group, held = group + 1, 0
            first[at] = group
            held += n
        rest = np.array(sorted(open_))
        at = int(rest[far(centres[at][None], centres[rest]).argmin()]) if len(rest) else None
    return first, pieces


class Search:
    """The index over rows (row, id, label, v array<int>, anchor)."""

    def __init__(self, rows: DataFrame, dim: int):
        self.spark, self.dim = rows.sparkSession, dim
        n = rows.count()
        sample = rows.select("v").orderBy(F.xxhash64("id", "v"), "row").limit(SAMPLE).toArrow()["v"].to_pylist()
        x = np.zeros((len(sample), dim))
        for i, v in enumerate(sample):
            x[i, : len(v)] = v
        k = int(min(MAX_CLUSTERS, max(1, round(math.sqrt(n) / 2)), max(1, len(x) // 4)))
        centres = codebook(x, k, np.random.default_rng(7))
        shared = self.spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    b = batch.slice(at, 2000)
                    v = np.zeros((b.num_rows, dim), "<i4")
                    lists = b.column("v")
                    sizes = np.diff(lists.offsets.to_numpy())
                    i = np.repeat(np.arange(b.num_rows), sizes)
                    v[i, np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
                    d = far(v.astype(np.float64), c)
                    near = d.argmin(1)
                    away = np.linalg.norm(v - c[near], axis=1)
                    new = [pa.array(near.astype(np.int32)), pa.array(away), pa.array([r.tobytes() for r in v], pa.binary())]
                    yield pa.RecordBatch.from_arrays([*(b.column(x) for x in ("row", "id", "label", "anchor")), *new],
                                                     ["row", "id", "label", "anchor", "cluster", "away", "v"])

        placed = rows.select("row", "id", "label", "anchor", "v").mapInArrow(
            assign, "row long, id long, label long, anchor boolean, cluster int, away double, v binary")
        self.placed = stored(placed, "placed")
        radius, counts = np.full(k, -1.0), np.zeros(k, np.int64)
        for r in self.placed.groupBy("cluster").agg(F.max("away").alias("away"), F.count("*").alias("n")).collect():  # at most MAX_CLUSTERS
            radius[r.cluster], counts[r.cluster] = r.away, r.n
        size = int(min(MOST_GROUP, max(LEAST_GROUP, GROUP * math.sqrt(n))))
        first, pieces = layout(counts, centres, size)
        self.counts = counts
        self.index = Index(centres, radius * (1 + 1e-12), first, pieces)
        self.shared = self.spark.sparkContext.broadcast(self.index)
        groups = self.spark.createDataFrame([(c, int(f), int(p)) for c, (f, p) in enumerate(zip(first, pieces, strict=True))], "c int, first long, pieces long")
        group = F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces"))
        # MAX_CLUSTERS rows at most
        self.members = self.placed.join(F.broadcast(groups), F.col("cluster") == F.col("c")).select(group.alias("group"), "cluster", "row", "id", "label", "v")

    def _sent(self, asked: DataFrame, low: int, high: int, again: bool) -> DataFrame:
        """asked by the group that each anchor goes to: first to the one with its best cluster, then
        to all others that its windows reach."""
        shared, dim = self.shared, self.dim

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            filled = np.flatnonzero(index.radius >= 0)
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    b = batch.slice(at, CHUNK)
                    lower, upper = index.bounds(_vectors(b.column("v"), dim).astype(np.float64), filled)
                    ps, ks, rows = b.column("ps").to_pylist(), b.column("ks").to_pylist(), b.column("row").to_pylist()
                    start = Windows.of(ps, [[None] * len(k) for k in ks], low, high).wanted(lower, upper)
                    reached = Windows.of(ps, ks, low, high).wanted(lower, upper) if again else start
                    take, group = [], []
                    for i, row in enumerate(rows):
                        if not start[i].any():
                            continue
                        best = int(filled[np.where(start[i], upper[i], -np.inf).argmax()])
                        home = index.groups_of(best, row)
                        if again:
                            to = {int(index.first[c]) + p for c in filled[reached[i]].tolist() for p in range(int(index.pieces[c]))} - {home}
                        else:
                            to = {home}
                        take += [i] * len(to)
                        group += sorted(to)
                    names = b.schema.names
                    yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(take, pa.int32())) for c in names), pa.array(group, pa.int64())], [*names, "group"])

        return asked.mapInArrow(tasks, "row long, label long, v binary, ps array<long>, ks array<long>, group long")

    def _found(self, asked: DataFrame, same: bool, k: int, low: int, high: int, again: bool) -> DataFrame:
        """``(row, slot, score, id, other)``: the k best rows of each visited group."""
        sent = stored(self._sent(asked, low, high, again), "sent")
        sizes = sent.groupBy(F.col("group").alias("g")).agg(F.ceil(F.count("*") / ANCHORS).alias("blocks"))
        sizes = stored(sizes, "visits")  # a row for each group that is visited
        none = lambda kind, name: F.lit(None).cast(kind).alias(name)
        members = self.members.join(sizes, F.col("group") == F.col("g")).select(
            "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("anchor"), "cluster", "row", "id", "label", "v",
            none("array<long>", "ps"), none("array<long>", "ks"))
        anchors = sent.join(sizes, F.col("group") == F.col("g")).select(
            "group", F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block"), F.lit(1).alias("anchor"), F.lit(-1).alias("cluster"), "row", none("long", "id"), "label", "v", "ps", "ks")
        dealt = members.union(anchors).repartition("group", "block").sortWithinPartitions("group", "block", "anchor", "row")
        shared, dim = self.shared, self.dim

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value

            def compared(m: Members, b: pa.Table) -> pa.RecordBatch:
                q, row, label = _vectors(b["v"], dim), _numbers(b["row"]), _numbers(b["label"])
                w = Windows.of(b["ps"].to_pylist(), b["ks"].to_pylist(), low, high)
                best, place = visit(index, m, q, row, label, w, same, k)
                i, j, r = np.nonzero(place >= 0)
                p = place[i, j, r]
                return pa.RecordBatch.from_arrays([pa.array(row[i]), pa.array(j.astype(np.int32)), pa.array(best[i, j, r]), pa.array(m.id[p]), pa.array(m.row[p])],
                                                  ["row", "slot", "score", "id", "other"])

            key, held, m, waiting = None, [], None, []

            def flush() -> Iterator[pa.RecordBatch]:
                if m is not None and waiting:
                    t = pa.Table.from_batches(waiting)
                    for at in range(0, t.num_rows, CHUNK):
                        yield compared(m, t.slice(at, CHUNK))

            for batch in batches:
                group, block, kind = (_numbers(batch.column(c)) for c in ("group", "block", "anchor"))
                change = np.flatnonzero((np.diff(group) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
                for s, e in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                    if s == e:
                        continue
                    b = batch.slice(s, e - s)
                    if (int(group[s]), int(block[s])) != key:
                        yield from flush()
                        key, held, m, waiting = (int(group[s]), int(block[s])), [], None, []
                    if kind[s] == 0:
                        held.append(b)
                        continue
                    if m is None and held:  # all members are there before the first anchor
                        t = pa.Table.from_batches(held)
                        m, held = Members(*(_numbers(t[c]) for c in ("cluster", "row", "id", "label")), _vectors(t["v"], dim)), []
                    waiting.append(b)
                    if sum(x.num_rows for x in waiting) >= CHUNK:
                        yield from flush()
                        waiting = []
            yield from flush()

        return dealt.mapInArrow(tasks, "row long, slot int, score long, id long, other long")

    def best(self, asked: DataFrame, same: bool, k: int, low: int = 0, high: int = 0) -> DataFrame:
        """``(row, slot, rank, score, id, other)``: for each anchor and slot of asked (row, label, v, ps)
        the first k rows (from rank 1) of the same label, or of others, within the slot's window."""
        asked = asked.withColumn("ks", F.transform("ps", lambda p: F.lit(None).cast("long")))
        first = stored(self._found(asked, same, k, low, high, False), "first")
        full = first.groupBy("row", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
        known = full.groupBy(F.col("row").alias("r")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "kth"))).alias("known"))
        told = asked.join(known, F.col("row") == F.col("r"), "left")
        told = told.withColumn("ks", F.transform("ps", lambda p, j: F.try_element_at("known", j))).select(*asked.columns)
        found = first.union(self._found(told, same, k, low, high, True))
        order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id", "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("row", "slot", "rank", "score", "id", "other")


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Every row for which ``anchor`` holds is an anchor.  Rows score by the inner
    product of their integer vectors, higher ones come first, of equal ones the
    smaller id.  An anchor's positives are its first ``positives`` other rows of its
    label; for each of them the first ``negatives`` rows of other labels count whose
    score is from low to high percent of the positive's.  A pair without any has no
    row, as has an anchor without positives; a positive score under 0 has an empty
    window, and with 0 only scores of 0 count.

    Rows with a null id, label or vector, or a null or non-finite component, take
    no part.  Components over 65,536 either way count as that; a shorter vector
    counts as followed by zeros.  Rows that repeat an id, or all of a row, are rows
    of their own.  Other columns are ignored; an empty table gives no rows.
    """
    v = F.col(vec_col).cast("array<double>")
    finite = ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(F.greatest(F.lit(-2.0 * MOST), F.least(F.lit(2.0 * MOST), x * SCALE))))).cast("int"))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = stored(rows, "rows")
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return rows.select(F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(1).alias("rank"), F.col("id").alias("negative_id"),
                           F.col("id").alias("positive_score"), F.col("id").alias("negative_score"))
    search = Search(rows, max(1, dim))
    anchors = search.placed.where("anchor").select("row", "id", "label", "v")
    asked = anchors.select("row", "label", "v", F.array(F.lit(None).cast("long")).alias("ps"))
    near = stored(search.best(asked, True, positives).select("row", (F.col("rank") - 1).alias("slot"), F.col("score").alias("p"), F.col("id").alias("positive")), "positives")
    each = near.groupBy(F.col("row").alias("r")).agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "p"))), lambda x: x["p"]).alias("ps"))
    found = search.best(anchors.join(each, F.col("row") == F.col("r")).select("row", "label", "v", "ps"), False, negatives, low, high)
    named = near.join(anchors.select(F.col("row").alias("r"), F.col("id").alias("anchor_id")), F.col("row") == F.col("r")).select(
        F.col("row").alias("r"), F.col("slot").alias("s"), "p", "positive", "anchor_id")
    out = found.join(named, (F.col("row") == F.col("r")) & (F.col("slot") == F.col("s")))
    return out.select("anchor_id", F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("p").alias("positive_score"),
                      F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.try_add(F.col("label").cast("long"), F.lit(1)) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


#: Rows are told apart by their number, so that repeated ids are rows of their own.
OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.id AS anchor_id, b.r AS br, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.r <> b.r WHERE a.id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.id, n.br) AS rank
  FROM p JOIN s n ON p.ar = n.ar AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
WHERE rank <= 3
"""
