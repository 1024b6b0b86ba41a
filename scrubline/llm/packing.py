"""Best-fit packing of tokenised documents into sequences, by moves and swaps.

Documents are tokenised and cut into pieces of at most one sequence.  The
pieces' lengths (not their tokens) are dealt into groups of a few thousand.
Within a group the pieces are first strung together as they come, in half octaves
of length, which leaves about a fifth too many sequences.  The search then moves
documents to where they fit best, in sweeps, and takes the emptiest sequences
apart by moves and by exchanges of one for one, two for one or one for two with
fuller sequences.  Each step raises the sum of squared fills; sequences that are
emptied go.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.base import slices, spread, stored, table

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
SEPARATOR = 0
#: Pieces in a group; a group leaves about one sequence part empty.
GROUP = 4096

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: ASCII marks but for the apostrophe, with which some endings begin, and <, with which special tokens do.
_MARKS = r"!-&(-/:;=-@\[-`{-~"
#: Texts without a match are letter runs, digits, runs of marks and white space.  Their
#: letters are single code points that NFC keeps, and letter runs, single digits and runs of
#: marks are tokenised apart, so in lower case they can be looked up one by one.
_HARD = re.compile(f"[^{_LETTERS}0-9{_MARKS} \\t\\n\\x0b\\x0c\\r]")
_EASY = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")

#: Every byte of Latin-1 that makes a text hard, as 1.
_MARKED = bytes(1 if _HARD.match(chr(c)) else c for c in range(256))


def _easy(text: str) -> list[str]:
    return _EASY.findall(text.lower())


class WordTokenizer:
    """Token ids of texts, word by word.

    The vocabulary drops white space and never joins tokens across it, so a
    text's ids are those of its words (split at ASCII white space) in a row.
    The ids of words are kept, as bytes, in two generations of bounded size.
    """

    def __init__(self, path: str, most_words: int = 150_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.shown = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        self.most = most_words
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.new, self.old = _Words(self), {}

    def _parts(self, raw: bytes) -> list[str]:
        """Letter runs, digits and runs of marks in lower case, and hard words behind a blank, in order."""
        text = raw.decode()
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:  # a character that is no single byte, so one word at least is hard
            words, kind = raw.split(), "utf-8"
            hard = [i for i, w in enumerate(words) if _HARD.search(w.decode())]
        else:  # what makes a word hard becomes the byte 1, which is looked for faster than by a pattern
            marked = plain.translate(_MARKED)
            if 1 not in marked:
                return _easy(text)
            words, kind = plain.split(), "latin-1"
            hard = [i for i, w in enumerate(marked.split()) if 1 in w]
        out, at = [], 0
        for i in hard:
            if i > at:
                out += _easy(b" ".join(words[at:i]).decode(kind))
            out.append(" " + words[i].decode(kind))
            at = i + 1
        return out + _easy(b" ".join(words[at:]).decode(kind))

    def learned(self, w: str) -> bytes:
        """The ids of a part that is not among the new ones."""
        if (found := self.old.get(w)) is not None:
            return found
        if w[0] == " ":
            ids = self.tokenizer.encode(w[1:], add_special_tokens=False).ids
        else:  # past the normaliser and the splitter, which would keep it as it is
            ids = [t.id for t in self.tokenizer.model.tokenize(w if w.isascii() else w.translate(self.shown))]
        return b"".join([self.packed[i] for i in ids])

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as little-endian unsigned 32-bit numbers."""
        out = []
        for t in texts:
            if len(self.new) > self.most:
                self.new, self.old = _Words(self), self.new
            out.append(b"".join(map(self.new.__getitem__, self._parts(t))))
        return out


class _Words(dict):
    """The ids of the parts that a tokeniser has met, learned when they are first asked for."""

    def __init__(self, words: WordTokenizer):
        self.words = words

    def __missing__(self, w: str) -> bytes:
        found = self[w] = self.words.learned(w)
        return found


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker and vocabulary."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pieces(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    A document's ids, followed by one separator, are cut every ``capacity``
    tokens, however many that makes.  A null or empty text is one piece, the
    separator alone; a null id stays null.  Repeated rows and ids have pieces of
    their own, an empty table has none, and other columns are ignored.
    """
    path = vocabulary or vocabulary_path()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.list_(pa.int32())], schema + ", ids array<int>"
    step = 4 * capacity
    tail = np.array([SEPARATOR], "<u4").tobytes()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
                out = []
                for doc, ids in zip(b.column("doc_id").to_pylist(), words.ids(texts), strict=True):
                    ids += tail
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part))
                        out.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tasks, schema)


class Bins:
    """Sequences under construction: what is in them and how much room they have."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[tuple[int, int]] = []  # (room, bin) of bins with room, sorted
        self.steps = self.exchanges = self.emptied = 0
        # as they come, by half octaves of length, long ones first; a bin is closed by the first length that is too much
        for i in sorted(range(len(lengths)), key=lambda i: -int(2 * math.log2(lengths[i]))):
            n = lengths[i]
            if not self.items or self.room[-1] < n:
                self.items.append([])
                self.room.append(capacity)
            self.items[-1].append(i)
            self.room[-1] -= n
        self.by_room = sorted((r, b) for b, r in enumerate(self.room) if r > 0)

    def change(self, b: int, out: list[int], into: list[int]) -> None:
        key = (self.room[b], b)
        at = bisect_left(self.by_room, key)
        if at < len(self.by_room) and self.by_room[at] == key:
            del self.by_room[at]
        for i in out:
            self.items[b].remove(i)
        self.items[b] += into
        self.room[b] += sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in into)
        if self.room[b] > 0 and self.items[b]:
            insort(self.by_room, (self.room[b], b))

    def move(self, i: int, a: int) -> int | None:
        """Document i of bin a goes where it leaves the least room, if the sum of
        squared fills rises by that: if that bin is then fuller than a was."""
        n = self.lengths[i]
        at = bisect_left(self.by_room, (n, -1))
        if at < len(self.by_room) and self.by_room[at][1] == a:
            at += 1
        if at == len(self.by_room) or self.by_room[at][0] - n >= self.room[a]:
            return None
        b = self.by_room[at][1]
        self.change(a, [i], [])
        self.change(b, [], [i])
        self.steps += 1
        self.emptied += not self.items[a]
        return b

    def sweep(self) -> bool:
        """Moves every document that can be moved once, long ones first."""
        before = self.steps
        where = {i: b for b, items in enumerate(self.items) for i in items}
        for i in sorted(where, key=lambda i: (-self.lengths[i], i)):
            self.move(i, where[i])
        return self.steps > before

    def exchange(self, a: int, looked: int) -> bool:
        """One or two documents of bin a against one of a fuller bin, or one against two,
        so that as much length as possible leaves a.

        looked: how many of the fuller bins, by room from the most, are looked at.
        """
        mine = np.array(self.items[a])
        size = np.array(self.lengths)[mine]
        i, j = np.triu_indices(len(mine), 1)
        totals = np.concatenate([size, size[i] + size[j]])
        end = bisect_right(self.by_room, (self.room[a], a))
        best, swap = 0, None
        for room, b in reversed(self.by_room[max(0, end - looked) : end]):
            if b == a or best >= room:
                continue
            theirs = np.array(sorted(self.items[b], key=self.lengths.__getitem__))
            t = np.array([self.lengths[k] for k in theirs])
            top = np.append(t, self.capacity + 1)
            # against one: the smallest that makes enough room
            at = np.searchsorted(t, totals - room)
            gain = totals - top[at]
            k = int(gain.argmax())
            if gain[k] > best:
                out = [k] if k < len(mine) else [int(i[k - len(mine)]), int(j[k - len(mine)])]
                best, swap = int(gain[k]), (b, mine[out].tolist(), [int(theirs[at[k]])])
            # one against two: for each of theirs the smallest longer one that makes enough room with it
            need = (size - room)[:, None] - t
            at = np.maximum(np.searchsorted(t, need), np.arange(len(t)) + 1)
            gain = size[:, None] - t - top[at]
            k, low = divmod(int(gain.argmax()), len(t))
            if gain[k, low] > best:
                best, swap = int(gain[k, low]), (b, [int(mine[k])], [int(theirs[low]), int(theirs[at[k, low]])])
        if swap is None:
            return False
        b, out, into = swap
        self.change(a, out, into)
        self.change(b, into, out)
        self.steps += 1
        self.exchanges += 1
        return True

    def drain(self, a: int, looked: int) -> bool:
        """Takes bin a apart as far as steps go; whether it is empty then."""
        longest = lambda: sorted(self.items[a], key=lambda i: -self.lengths[i])
        while self.items[a] and (any(self.move(i, a) is not None for i in longest()) or self.exchange(a, looked)):
            pass
        return not self.items[a]

    def improve(self, tries: int = 12, looked: int = 64) -> None:
        """Sweeps until nothing moves, then empties the emptiest bins by moves and
        exchanges, until the number of bins is the least there can be or ``tries``
        bins have resisted.  Every step raises the sum of squared fills."""
        least = -(-sum(self.lengths) // self.capacity)
        while len(self.items) - self.emptied > least and self.sweep():
            pass
        resisting: set[int] = set()
        while len(self.items) - self.emptied > least and len(resisting) < tries:
            a = next((b for _, b in reversed(self.by_room) if b not in resisting), None)
            if a is None:
                return
            if not self.drain(a, looked):
                resisting.add(a)


def fill(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; bins count from 0 without gaps."""
    bins = Bins(lengths.tolist(), capacity)
    bins.improve()
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for items in bins.items:
        at = 0
        for i in items:
            where[i], offset[i] = n, at
            at += bins.lengths[i]
        n += bool(items)
    return where, offset


def place(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """pieces plus ``sequence_id`` and ``offset`` (from 0 without gaps).

    Pieces are dealt by hash into groups of about ``group``; each is packed by
    itself and leaves about one sequence part empty.  Repeated rows are pieces of
    their own and are dealt apart.  Pieces of equal length are interchangeable:
    which of them goes where depends on their order in a group (by id, piece and
    place), nothing else does.  An empty table gives no rows.
    """
    kept = stored(cut, "pieces")
    groups = max(1, -(-kept.count() // group))
    dealt = kept.withColumns({
        # rows are numbered as they were stored, so that repeated ones do not share a group
        "part": F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)),
        "known": F.col("doc_id").isNotNull(), "doc_id": F.coalesce("doc_id", F.lit(0)),  # pandas has no null longs
    })
    columns = ["doc_id", "known", "piece", "start", "length", "ids_crc32"]

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(columns, kind="stable")  # the order in which rows arrive must not matter
        where, offset = fill(rows["length"].to_numpy(), capacity)
        return rows[columns].assign(sequence_id=rows["part"].to_numpy() * (1 << 20) + where, offset=offset)

    placed = dealt.groupBy("part").applyInPandas(
        pack, "doc_id long, known boolean, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


def assemble(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the token ids of each sequence; with_ids: pieces(..., with_ids=True)."""
    keys = ["doc_id", "piece", "ids_crc32"]
    one = with_ids.dropDuplicates(keys).select(*[F.col(k).alias(f"__{k}") for k in keys], "ids")
    same = [placed[k].eqNullSafe(one[f"__{k}"]) for k in keys]
    parts = placed.join(one, same[0] & same[1] & same[2]).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def op3_pack_documents(spark, sf_dir):
    return place(pieces(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))))
