"""Token ids as binary files, compressed by Re-Pair grammars.

Documents are dealt by ranges of their ids, so that the files' order is that of
the documents.  A task cuts its documents into shards of about ``SHARD`` bytes
and gives each a grammar of its own: pairs of neighbouring symbols that occur
often enough are replaced by new symbols, again and again, until no pair does.
Rules never reach over the end of a document.  A shard stores its rules, the length of each rule's expansion, the
symbols that are left and where each document's begin, so that any stretch of
any document is decoded by itself.

A file is a row of shards, each behind its length, and a line feed after each.
Spark's own writer puts the files in place, so they are committed as a whole in
any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrubline.llm.base import deleted, slices, stored, table
from scrubline.llm.packing import tokenizer, vocabulary_path
from scrubline.sources.scratch import new_path

#: Bytes of text in a shard (the document that reaches this closes it), and how often a pair has to occur.
SHARD, LEAST = 1 << 20, 16
#: The id behind every document.
END = 1
MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sQ")  # magic, bytes that follow
_SIZES = struct.Struct("<iiIIIIBQ")  # part, shard, documents, rules, symbols, first rule's symbol, bytes of a symbol, tokens


def replace_pairs(symbols: np.ndarray, last: np.ndarray, first: int, least: int = LEAST):
    """Re-Pair over a row of symbols: what is left of it (int64), the places that are left, and the rules (left, right).

    No pair goes beyond a symbol that is ``last`` (it may be its right half).
    Rule k is the symbol first + k.  Each round counts the pairs, and where pairs
    overlap the more frequent one is replaced.  A pair's count only falls once no
    new symbol comes into it, so a round looks at those pairs alone that were
    frequent before or hold a symbol of the last round.
    """
    n = len(symbols)
    s, last, alive = symbols.astype(np.int64), last.copy(), np.ones(n, bool)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    rank = np.zeros(n + 1, np.int64)  # of the pair at each place, while a round lasts; before the first and behind the last place 0
    left, right = [], []
    at = np.flatnonzero(~last[:-1]).astype(np.int32) if n else np.zeros(0, np.int32)
    while len(at):
        key = s[at] << 32 | s[after[at]]
        if len(at) > 1 << 12:  # most rare pairs are told by the size of a bucket of hashes that they share
            bucket = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(47)).view(np.int64)
            full = (np.bincount(bucket) >= least)[bucket]
            at, key = at[full], key[full]
        code, pairs = pd.factorize(key)
        count = np.bincount(code, minlength=len(pairs))
        often = (count >= least)[code]
        at, code = at[often], code[often]
        if not len(at):
            break
        # of pairs that are as frequent any may go first, so that of a passage that is repeated as a
        # whole a third of the pairs goes in a round and not the last one alone
        turn = np.random.default_rng(len(pairs)).permutation(len(pairs))
        own = count[code] * len(pairs) + turn[code]
        rank[at] = own
        behind, ahead = rank[before[at]], rank[after[at]]
        taken = (behind <= own) & (ahead <= own)
        if (follows := behind == own).any():  # where a pair overlaps itself (aaaa), every second place of the row is taken
            i = np.arange(len(at))
            taken &= (i - np.maximum.accumulate(np.where(follows, 0, i))) % 2 == 0
        rank[at] = 0
        used = np.bincount(code[taken], minlength=len(pairs)) > 0
        a, new = at[taken], (first - 1 + np.cumsum(used))[code[taken]]
        b = after[a]
        left.append(pairs[used] >> 32)
        right.append(pairs[used] & 0xFFFFFFFF)
        first += int(used.sum())
        s[a], last[a], alive[b] = new, last[b], False
        far = after[b]
        after[a] = far
        inside = far < n
        before[far[inside]] = a[inside]
        beside = before[a]
        if 8 * (len(at) + 2 * len(a)) < n:
            at = np.concatenate([at, a, beside[beside >= 0]])
            at.sort()
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        else:
            open_ = np.zeros(n, bool)
            open_[at] = open_[a] = open_[beside[beside >= 0]] = True
            at = np.flatnonzero(open_).astype(np.int32)
        at = at[alive[at] & ~last[at]]
    none = [np.zeros(0, np.int64)]
    return s[alive], np.flatnonzero(alive), np.concatenate(left or none), np.concatenate(right or none)


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for."""
    s = symbols.astype(np.int64)
    while (rule := s >= first).any():
        size = 1 + rule
        end = np.cumsum(size)
        out = np.empty(end[-1], np.int64)
        out[end - size] = np.where(rule, left[np.where(rule, s - first, 0)], s)
        out[end[rule] - 1] = right[s[rule] - first]
        s = out
    return s


def expand_all(symbols: np.ndarray, lengths: np.ndarray, left: np.ndarray, right: np.ndarray, first: int) -> np.ndarray:
    """As expand(), for many symbols: each rule is expanded once and copied to where it stands."""
    ids = np.arange(first)
    listed = np.concatenate([ids, expand(np.arange(first, first + len(left)), left, right, first)])
    size = np.concatenate([np.ones(first, np.int64), lengths.astype(np.int64)])
    start = np.cumsum(size) - size
    s = symbols.astype(np.int64)
    n = size[s]
    return listed[np.arange(n.sum()) + np.repeat(start[s] - np.cumsum(n) + n, n)]


def expansion_lengths(left: np.ndarray, right: np.ndarray, first: int) -> np.ndarray:
    """Of each rule; a rule's halves are ids or earlier rules, and those of one round know of each other in order."""
    out = np.zeros(len(left), np.int64)
    open_ = np.arange(len(left))
    while len(open_):
        a, b = left[open_] - first, right[open_] - first
        x = np.where(a < 0, 1, out[np.maximum(a, 0)])
        y = np.where(b < 0, 1, out[np.maximum(b, 0)])
        out[open_] = np.where((x > 0) & (y > 0), x + y, 0)
        open_ = open_[out[open_] == 0]
    return out


def encode_shard(part: int, shard: int, doc_ids: list, ids: list[bytes], vocabulary: int, least: int = LEAST) -> bytes:
    """A shard's bytes from each document's ids (little-endian unsigned 32-bit, END behind them)."""
    id_starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
    row = np.frombuffer(b"".join(ids), "<u4")
    last = np.zeros(len(row), bool)
    last[id_starts[1:] - 1] = True
    s, places, left, right = replace_pairs(row, last, vocabulary, least)
    # a document's first place begins a symbol, since no rule reaches over an end
    first_symbol = np.searchsorted(places, id_starts)
    width = 2 if vocabulary + len(left) <= 1 << 16 else 4
    symbol = f"<u{width}"
    body = b"".join([
        _SIZES.pack(part, shard, len(doc_ids), len(left), len(s), vocabulary, width, int(id_starts[-1])),
        left.astype(symbol).tobytes(), right.astype(symbol).tobytes(), expansion_lengths(left, right, vocabulary).astype("<u4").tobytes(), s.astype(symbol).tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        first_symbol.astype("<u8").tobytes(), id_starts.astype("<u8").tobytes(),
    ])
    return _HEAD.pack(MAGIC, len(body)) + body


class Shard:
    """One shard of a file, read in place."""

    def __init__(self, body: memoryview):
        self.part, self.shard, docs, rules, symbols, self.first, width, self.n_ids = _SIZES.unpack_from(body)
        at, symbol = _SIZES.size, f"<u{width}"

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out

        self.left, self.right = take(symbol, rules).astype(np.int64), take(symbol, rules).astype(np.int64)
        self.lengths = take("<u4", rules)
        self.symbols = take(symbol, symbols)
        ids, known = take("<i8", docs), take(np.uint8, docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.first_symbol, self.starts = take("<u8", docs + 1).astype(np.int64), take("<u8", docs + 1).astype(np.int64)

    def ids(self, doc: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """The ids [begin, end) of a document; only the symbols that reach into them are expanded."""
        s = self.symbols[self.first_symbol[doc] : self.first_symbol[doc + 1]].astype(np.int64)
        end = self.starts[doc + 1] - self.starts[doc] if end is None else end
        size = np.where(s >= self.first, self.lengths[np.maximum(s - self.first, 0)] if len(self.lengths) else 1, 1)
        ends = np.cumsum(size)
        low, high = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left") + 1
        skipped = int(ends[low - 1]) if low else 0
        return expand(s[low:high], self.left, self.right, self.first)[begin - skipped : end - skipped]

    def all_ids(self) -> np.ndarray:
        return expand_all(self.symbols, self.lengths, self.left, self.right, self.first)


def shards_of(content) -> Iterator[Shard]:
    """The shards of a file's bytes, in order."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, n = _HEAD.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError(f"no shard at byte {at}")
        at += _HEAD.size
        yield Shard(view[at : at + n])
        at += n + 1


def _shard_rows(df: DataFrame, path: str, most: int, least: int) -> DataFrame:
    """``(content binary)``: the shards of each partition of df (doc_id, text), in its order."""
    end = END.to_bytes(4, "little")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        t = tokenizer(path)
        docs, ids, size = [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([encode_shard(part, shard, docs, ids, len(t.packed), least)], pa.binary())], ["content"])

        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                texts = [x or b"" for x in b.column("text").cast(pa.binary()).to_pylist()]
                for doc, text, found in zip(b.column("doc_id").to_pylist(), texts, t.ids(texts), strict=True):
                    docs.append(doc)
                    ids.append(found + end)
                    size += len(text)
                    if size >= most:
                        yield closed()
                        docs, ids, size, shard = [], [], 0, shard + 1
        if docs:
            yield closed()

    return df.mapInArrow(tasks, "content binary")


def write_shards(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", vocabulary: str | None = None,
                 most: int = SHARD, least: int = LEAST) -> None:
    """Writes the ids of all rows of df below path, by ascending id (null first).

    Every document is its text's ids and END; a null text counts as empty, a text
    of any length is in one shard.  Rows with the same id go by a hash of their
    text, repeated rows one after the other.  Other columns are ignored; an empty
    table leaves a folder without shards.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # the last key tells repeated rows apart, so that any number of them can be split
    docs = docs.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = ["doc_id", "hash", "row"]
    ordered = docs.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    _shard_rows(ordered, vocabulary or vocabulary_path(), most, least).select(F.col("content").cast("string")).write.text(path)


def read_shards(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``(part, shard, place, doc_id, start, n_tokens, ids_crc32)`` (and ``ids``) from the
    files below path; start counts from the shard's begin."""
    names = ["part", "shard", "place", "doc_id", "start", "n_tokens", "ids_crc32"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    schema = "part int, shard int, place int, doc_id long, start long, n_tokens long, ids_crc32 long"
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.list_(pa.int32())], schema + ", ids array<int>"

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for s in shards_of(content.as_buffer()):
                    out = []
                    whole = s.all_ids().astype("<u4")
                    for k, doc in enumerate(s.doc_ids):
                        ids = whole[s.starts[k] : s.starts[k + 1]]
                        row = (s.part, s.shard, k, doc, int(s.starts[k]), len(ids), zlib.crc32(ids))
                        out.append((*row, ids.astype(np.int32)) if with_ids else row)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(tasks, schema)


def with_starts(read: DataFrame) -> DataFrame:
    """read with start counted from the first document of all: shards are summed up
    within their part, and parts (one for each file) in one row each."""
    sizes = read.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        F.col("part").alias("__p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    firsts = sizes.withColumn("within", within).join(parts, F.col("part") == F.col("__p")).select(
        F.col("part").alias("__part"), F.col("shard").alias("__shard"), (F.col("within") + F.col("before")).alias("__first"))
    out = read.join(firsts, (read["part"] == F.col("__part")) & (read["shard"] == F.col("__shard")))
    return out.withColumn("start", F.col("start") + F.col("__first")).drop("__part", "__shard", "__first")


def op11_token_files(spark, sf_dir):
    path = new_path(spark, "tokens")
    write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    read = stored(read_shards(spark, path), "read")
    deleted(spark, path)
    return with_starts(read).select("doc_id", "start", "n_tokens", "ids_crc32")
