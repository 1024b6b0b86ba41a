"""The exact similarity of texts' sets of word shingles.

Groups of sets are verified on the whole sets, each of which travels once for
each block of its group; groups over a bound are split into blocks that meet in
pairs, and no pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.base import slices
from scrubline.llm.windows import Words

SHINGLE = 5
SIMILARITY = 0.8
#: A group with more sets is split into blocks of about this many.
BLOCK = 256
SLICE = 900_000


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's shingles; a shorter text is one shingle."""
    words = Words([t.lower() for t in texts])
    all_of_them, out = words.windows(shingle), []
    for s, n in zip(words.starts.tolist(), words.counts.tolist(), strict=True):
        h = all_of_them[s : s + n - shingle + 1] if n >= shingle else words.windows(n, np.array([s])) if n else all_of_them[:0]
        out.append(np.unique(h))
    return out


def set_key(h: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(h.tobytes()), np.uint64).view(np.int64))


def texts_of(b: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]


def sets_of(rows: DataFrame, shingle: int) -> DataFrame:
    """``(key, component, blocks, shingles)`` of rows with a text."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SLICE):
                sets = pa.array([h.view(np.int64) for h in shingle_sets(texts_of(b), shingle)], pa.list_(pa.int64()))
                names = ["key", "component", "blocks"]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), sets], [*names, "shingles"])

    return rows.select("key", "component", "blocks", "text").mapInArrow(tasks, "key long, component long, blocks long, shingles array<long>")


def links(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Edges that connect the sets that are linked."""
    n, sizes = len(sets), np.array([len(h) for h in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(number, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    count = np.bincount(number)
    start, first = np.cumsum(count) - count, np.cumsum(sizes) - sizes
    open_, out = np.ones(n, bool), []
    for i in range(n):
        if not open_[i]:
            continue
        open_[i] = False
        queue = [i]
        while queue and open_.any():  # every set is taken once and compared with those still open
            j = queue.pop()
            mine = number[first[j] : first[j] + sizes[j]]
            many = count[mine]
            at = np.repeat(start[mine] - np.cumsum(many) + many, many) + np.arange(many.sum())
            common = np.bincount(owner[at], minlength=n)
            near = np.flatnonzero(open_ & (common >= similarity * (sizes + sizes[j] - common) - 1e-9))
            open_[near] = False
            queue += near.tolist()
            out += [(j, k) for k in near.tolist()]
    return out


def verified(sets: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: edges between keys whose sets are similar enough."""
    mine, n = F.pmod(F.xxhash64("key"), F.col("blocks")), F.col("blocks")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda c: F.least(mine, c) * n + F.greatest(mine, c))
    dealt = sets.select("component", "key", "shingles", F.explode(pairs).alias("pair"))
    ordered = dealt.select(F.xxhash64("component", "pair").alias("group"), "key", "shingles").repartition("group").sortWithinPartitions("group")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, {}

        def found() -> pa.RecordBatch:
            keys = list(rows)
            edges = links([rows[k] for k in keys], similarity) if len(keys) > 1 else []
            a, b = [keys[i] for i, _ in edges], [keys[j] for _, j in edges]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            shingles = batch.column("shingles")
            for i, (g, k) in enumerate(zip(batch.column("group").to_pylist(), batch.column("key").to_pylist(), strict=True)):
                if g != group:
                    if rows:
                        yield found()
                    group, rows = g, {}
                rows[k] = shingles[i].values.to_numpy(zero_copy_only=False).view(np.uint64).copy()
        if rows:
            yield found()

    return ordered.mapInArrow(tasks, "a long, b long")
