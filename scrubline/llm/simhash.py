"""SimHash near-duplicates by the generalised pigeonhole principle.

64-bit fingerprints within ``radius`` bits are linked.  The bits are grouped
into partitions (correlated bits together); partition i gets a threshold t_i of
-1, 0 or 1 with sum(t_i + 1) = radius + 1, so two linked fingerprints differ in
at most t_i bits of some partition.  A dynamic program chooses the number of
partitions and the thresholds with the least estimated work, from a bounded
sample.  Fingerprints that meet under a partition's bits (or, for t_i = 1, with
one more bit set) are verified together in one task; equal fingerprints are one
row all along, and buckets over a bound are split into blocks that meet in
pairs, so no bucket is one task's whole work and no pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm import similar
from scrubline.llm.base import components, slices, spread, stored, table
from scrubline.llm.windows import mixed

SEED = 42
SHINGLE = 3
RADIUS = 3
SAMPLE = 4096
#: A bucket with more rows is split into blocks of about this many.
BLOCK = 2048
#: Estimated cost of a row that is dealt to a bucket, in verified pairs.
ROW_COST = 40.0
#: Groups of up to this many rows are verified by shifts over all groups at once.
SMALL = 24


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is in over half of the shingles' hashes; 0 without words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(n - shingle + 1)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp long)`` of every whole text; null counts as empty."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                found = [fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tasks, "doc_id long, fp long")


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the 64 bits, correlated bits together; bits: (rows, 64) of 0 and 1."""
    centred = bits - bits.mean(0)
    scale = np.sqrt((centred**2).sum(0)) + 1e-9
    alike = np.abs(centred.T @ centred) / np.outer(scale, scale)
    np.fill_diagonal(alike, 0)
    left, out = list(range(64)), []
    for i in range(m):
        size = len(left) // (m - i)
        part = [max(left, key=lambda b: alike[b, left].max())] if left else []
        left.remove(part[0])
        while len(part) < size:
            nearest = max(left, key=lambda b: alike[b, part].mean())
            part.append(nearest)
            left.remove(nearest)
        out.append(sorted(part))
    return out


def _work(bits: np.ndarray, part: list[int], n: int) -> list[float]:
    """Estimated work of thresholds -1, 0 and 1: dealt rows and pairs to verify.

    A share of pairs within t bits is the larger of the sample's and of that
    under independent bits, which stands in where the sample has no such pair.
    """
    x = bits[:, part]
    differ = _distances(x)
    pairs = differ[np.triu_indices(len(differ), 1)] if len(differ) > 1 else np.array([64])
    p = x.mean(0) if len(x) else np.full(len(part), 0.5)
    agree = np.clip(p**2 + (1 - p) ** 2, 1e-6, 1 - 1e-6)
    same = agree.prod()
    near = same * (1 + ((1 - agree) / agree).sum())
    half = n * n / 2
    zero = max((pairs == 0).mean(), same) * half
    one = max((pairs <= 1).mean(), near) * half
    return [0.0, ROW_COST * n + zero, ROW_COST * n * (1 + len(part) / 2) + one]


def _distances(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float32)
    return (y @ (1 - y).T + (1 - y) @ y.T).astype(np.int16)


def plan(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use."""
    bits = np.unpackbits(sample.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    best: tuple[float, list] = (float("inf"), [])
    for m in range(-(-(radius + 1) // 2), radius + 2):
        parts = group_bits(bits, m)
        # least[u]: (work, thresholds) that use up u of radius + 1 units, t + 1 in each partition
        least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in parts:
            work, new = _work(bits, part, n), {}
            for u, (w, ts) in least.items():
                for t in (-1, 0, 1):
                    v = u + t + 1
                    if v <= radius + 1 and (v not in new or w + work[t + 1] < new[v][0]):
                        new[v] = (w + work[t + 1], [*ts, t])
            least = new
        if radius + 1 in least and least[radius + 1][0] < best[0]:
            best = (least[radius + 1][0], [(p, t) for p, t in zip(parts, least[radius + 1][1], strict=True) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def keys_of(fp: Column, partitions: list[tuple[list[int], int]], first: int = 0) -> Column:
    """Array of ``(part, key)``: where a fingerprint meets others; parts count from first."""
    def rows(i: int, bits: list[int], threshold: int) -> Column:
        own = fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        keys = F.array(own)
        if threshold == 1:
            single = F.array(*[F.lit(_signed(1 << b)) for b in bits])
            clear = F.filter(single, lambda b: fp.bitwiseAND(b) == 0)
            keys = F.concat(keys, F.transform(clear, lambda b: own.bitwiseOR(b)))
        return F.transform(keys, lambda k: F.struct(F.lit(i).alias("part"), k.alias("key")))

    return F.flatten(F.array(*[rows(first + i, bits, threshold) for i, (bits, threshold) in enumerate(partitions)]))


def buckets(unique: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, key, fp, rep)``: where fingerprints meet.  With threshold 1 each also
    meets those that have one more bit set, so a pair one bit apart meets once."""
    return unique.select(F.explode(keys_of(F.col("fp"), partitions)).alias("at"), "fp", "rep").select("at.part", "at.key", "fp", "rep")


def _links(key: np.ndarray, fps: list[np.ndarray], rep: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (least rep, rep) of what is linked inside groups; rows are sorted by key.
    fps: the fingerprints, of which the differing bits are added up."""
    fps = [np.ascontiguousarray(f).view(np.uint64) for f in fps]  # bitwise_count takes the absolute value of signed numbers

    def apart(x, y) -> np.ndarray:
        return sum(np.bitwise_count(f[x] ^ f[y]).astype(np.int16) for f in fps)

    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    least = rep.copy()
    small = np.repeat(sizes <= SMALL, sizes)
    one, other = [], []
    for d in range(1, min(int(sizes[sizes <= SMALL].max(initial=1)), len(key))):
        i = np.flatnonzero(small[d:] & (key[d:] == key[:-d]))
        i = i[apart(i, i + d) <= radius]
        one.append(i)
        other.append(i + d)
    if one:
        i, j = np.concatenate(one), np.concatenate(other)
        while (changed := least[i] != least[j]).any():  # the least rep goes from hand to hand
            i, j = i[changed], j[changed]
            lower = np.minimum(least[i], least[j])
            np.minimum.at(least, i, lower)
            np.minimum.at(least, j, lower)
            i, j = np.concatenate(one), np.concatenate(other)
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        group, open_ = slice(s, s + n), np.ones(n, bool)
        for first in range(n):
            if not open_[first]:
                continue
            open_[first] = False
            queue, members = [first], [first]
            while queue:  # every row is taken once and compared with those still open
                near = np.flatnonzero(open_ & (apart(group, s + queue.pop()) <= radius))
                open_[near] = False
                queue += near.tolist()
                members += near.tolist()
            members = s + np.array(members)
            least[members] = rep[members].min()
    moved = np.flatnonzero(least != rep)
    return least[moved], rep[moved]


def verified(met: DataFrame, radius: int = RADIUS, block: int = BLOCK, fps: tuple[str, ...] = ("fp",)) -> DataFrame:
    """``(a, b)``: edges between reps that connect what is linked within a bucket of
    met ``(part, key, rep)`` and the fingerprints fps."""
    met = met.select(F.xxhash64("part", "key").alias("at"), "rep", *fps)
    hot = met.groupBy("at").count().where(F.col("count") > block)
    hot = stored(hot.select(F.col("at").alias("__at"), F.ceil(F.col("count") / block).alias("blocks")), "hot")
    if hot.isEmpty():
        dealt = met.select(F.col("at").alias("group"), "rep", *fps)
    else:
        split = met.join(hot, met["at"] == hot["__at"], "left")
        n = F.coalesce(F.col("blocks"), F.lit(1)).cast("long")
        mine = F.pmod(F.xxhash64("rep"), n)
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda c: F.least(mine, c) * n + F.greatest(mine, c))
        # a block meets itself within its meetings with the others; alone there is nothing else
        dealt = split.select("at", F.explode(pairs).alias("pair"), "rep", *fps).select(F.xxhash64("at", "pair").alias("group"), "rep", *fps)
    ordered = dealt.repartition("group").sortWithinPartitions("group")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple | None = None

        def found(key: np.ndarray, rep: np.ndarray, *fp: np.ndarray) -> pa.RecordBatch:
            a, b = _links(key, list(fp), rep, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "rep", *fps))
            if rest is not None:
                rows = tuple(np.concatenate(p) for p in zip(rest, rows, strict=True))
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))  # the last group may go on
            if cut:
                yield found(*(r[:cut] for r in rows))
            rest = tuple(r[cut:] for r in rows)
        if rest is not None:
            yield found(*rest)

    return ordered.mapInArrow(tasks, "a long, b long")


def thinned(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of verified() that connect the same with about one for each b.

    A rep has an edge to the least one of every bucket where it is linked, so a large
    group has as many for each of its members as they meet in buckets.  Here each rep
    keeps the least of these, which takes the others over; most of those are the
    same for all members.  An array holds no more than the meetings of one rep.
    """
    each = edges.groupBy("b").agg(F.sort_array(F.collect_set("a")).alias("to"))
    ends = F.concat(F.slice("to", 2, F.size("to")), F.array("b"))
    return each.select(F.col("to")[0].alias("a"), F.explode(ends).alias("b")).distinct()


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, component_id)``, a row for each row of df.

    component_id: the smallest id reachable over links of at most radius bits.
    Null texts and texts without words have fingerprint 0 and are linked like any
    others.  Rows with a null id take part in no link of their own: they get the
    component of their fingerprint, null if all its ids are null.  Repeated rows
    and ids keep a row each; other columns are ignored; an empty table gives none.
    """
    found = stored(fingerprints(df, text_col, id_col, shingle), "fingerprints")
    unique = stored(found.groupBy("fp").agg(F.min("doc_id").alias("rep")), "unique")
    known = unique.where(F.col("rep").isNotNull())
    n = known.count()
    sample = known.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).toArrow()["fp"].to_numpy() if n else np.zeros(0, np.int64)
    if n > 1:
        groups = components(thinned(verified(buckets(known, plan(sample, n, radius)), radius)))
        linked = unique.join(groups, unique.rep == groups.id, "left").select(
            F.col("fp").alias("__fp"), F.coalesce("component", "rep").alias("component_id")
        )
    else:
        linked = unique.select(F.col("fp").alias("__fp"), F.col("rep").alias("component_id"))
    linked = stored(linked, "linked")
    return found.join(linked, found.fp == F.col("__fp")).select("doc_id", "fp", "component_id")


#: Wide search: fingerprints a text has, and the sample that plans the partitions of each.
WORDS, WIDE_SAMPLE = 16, 512
#: Candidates differ in at most this many bits of two other fingerprints: at a similarity of
#: 0.8 these are 19 with a deviation of 4, of unlike texts 64 with one of 6.
APART = 32
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def wide_fingerprints(sets: list[np.ndarray], words: int = WORDS) -> np.ndarray:
    """(texts, words) fingerprints from sets of 64-bit shingle hashes: a bit is set if it
    is in over half of a set's hashes under the word's own mixing."""
    sizes = np.array([len(h) for h in sets])
    filled = np.flatnonzero(sizes)
    out = np.zeros((len(sets), words), np.uint64)
    if not len(filled):
        return out
    h, sizes = np.concatenate(sets), sizes[filled]
    starts = np.cumsum(sizes) - sizes
    # eight counters share a number, so at most 255 hashes are added up at once
    chunks = -(-sizes // 255)
    first = np.cumsum(chunks) - chunks
    edges = np.repeat(starts, chunks) + 255 * (np.arange(chunks.sum()) - np.repeat(first, chunks))
    for w in range(words):
        x = np.ascontiguousarray(mixed(h + np.uint64(0x9E3779B97F4A7C15 * (w + 1) % (1 << 64)))).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            part = np.add.reduceat(_SPREAD[x[:, k]], edges)
            ones = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), first)
            out.view(np.uint8).reshape(len(sets), words, 8)[filled, w, k] = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").ravel()
    return out


def _sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, t, key, fps)`` of rows (doc_id, t, text); key stands for the set of shingles."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", similar.SLICE):
                sets = similar.shingle_sets(similar.texts_of(b), shingle)
                fps = wide_fingerprints(sets).view(np.int64)
                found = [pa.array([similar.set_key(h) for h in sets], pa.int64()),
                         pa.array([f if len(h) else f[:0] for f, h in zip(fps, sets, strict=True)], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t"), *found], ["doc_id", "t", "key", "fps"])

    return rows.mapInArrow(tasks, "doc_id long, t long, key long, fps array<long>")


def similar_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", similarity: float = similar.SIMILARITY,
                  shingle: int = similar.SHINGLE, block: int = similar.BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, t, key)``, a row for each row of df, and ``(id, component)`` of the linked keys.

    Near-duplicates by similarity: texts whose sets of word shingles have a
    Jaccard similarity of at least ``similarity`` are linked, also over others.  t
    is xxhash64 of the text, key stands for its set.  Each text has WORDS
    fingerprints; two that meet in a partition of any of them, as the
    generalised pigeonhole deals them, and are not too far apart in two others
    are candidates, and candidates are verified on the whole sets.  A pair of
    similarity 0.8 is found in 99 % of cases, closer ones oftener.

    Words are runs other than ASCII white space, with A-Z in lower case.  Texts
    without words are equal.  Null texts are empty, null ids are kept; repeated
    rows have equal keys; an empty table gives none; other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    found = stored(_sketches(rows, shingle), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "t")).alias("best")
    unique = stored(found.groupBy("key").agg(first, F.first("fps").alias("fps")).select(
        F.col("key").alias("rep"), F.col("best.doc_id").alias("__i"), F.col("best.t").alias("__t"), "fps"), "unique")
    known = unique.where(F.size("fps") > 0)
    n = known.count()
    if n < 2:
        return found.select("doc_id", "t", "key"), df.sparkSession.createDataFrame([], "id long, component long")
    sample = known.select("fps").orderBy(F.xxhash64("rep")).limit(WIDE_SAMPLE).toArrow()["fps"].combine_chunks()
    bits = sample.flatten().to_numpy(zero_copy_only=False).reshape(-1, WORDS)
    met, parts = [], 0
    for w in range(WORDS):
        partitions = plan(bits[:, w], n)
        met.append(F.transform(keys_of(F.col("fps")[w], partitions, parts), lambda k: F.struct(
            k["part"].alias("part"), k["key"].alias("key"), F.col("fps")[(w + 1) % WORDS].alias("f1"), F.col("fps")[(w + 2) % WORDS].alias("f2"))))
        parts += len(partitions)
    met = known.select("rep", F.explode(F.flatten(F.array(*met))).alias("at")).select("rep", "at.part", "at.key", "at.f1", "at.f2")
    near = stored(components(thinned(verified(met, APART, fps=("f1", "f2")))), "near")
    sizes = near.groupBy("component").agg(F.ceil(F.count("*") / block).alias("blocks")).select(F.col("component").alias("__c"), "blocks")
    sized = near.join(sizes, near.component == F.col("__c")).select("id", "component", "blocks")
    asked = unique.join(sized, unique.rep == sized.id).select(F.col("rep").alias("key"), "component", "blocks", "__i", "__t")
    asked = stored(asked, "asked")
    texts = rows.join(asked, rows.doc_id.eqNullSafe(F.col("__i")) & (rows.t == F.col("__t")))
    linked = stored(components(thinned(similar.verified(similar.sets_of(texts, shingle), similarity))), "linked")
    return found.select("doc_id", "t", "key"), linked


def op10_simhash_duplicates(spark, sf_dir):
    found = near_duplicates(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
