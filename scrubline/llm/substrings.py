"""Substring deduplication by level-wise doubling of repeated windows.

A window of ``window`` words is judged by the shorter windows inside it.  The
lengths double from ``shortest`` or fewer words up: 35 is judged by 9, 18 and 35.  At each
length only the window that is the least by hash inside each full-length one is
looked at (winnowing: equal full windows have equal least ones).  Windows that
are repeated at one length are extended to twice that length, alone: a full
window whose least part is repeated nowhere is out.  Where nothing survives the
search is over.  At the last length the full windows that are left are looked
at themselves.

Windows are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.base import SPACES, dropped, laid_out, slices, stored, table, unlaid
from scrubline.llm.windows import Words, anchors, least

WINDOW, SHORTEST = 35, 9
#: Bytes of text that are hashed at once: a worker holds some tens of 8-byte numbers for each.
SLICE = 900_000
#: Each row is known by its number, so repeated rows lie in different buckets.
_KEY = ["__row"]


def _bytes(b: pa.RecordBatch, text: str) -> list[bytes]:
    return [t or b"" for t in b.column(text).cast(pa.binary()).to_pylist()]


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _first_in_doc(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first row of each (doc, h), and how often it occurs."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    d, x = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1])])) if len(h) else np.zeros(0, int)
    return order[new], np.diff(np.append(new, len(h)))


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """The lengths of windows that are looked at, each about half of the next."""
    out = [window]
    while out[0] > shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def _repeated(rows: DataFrame) -> DataFrame:
    """The hashes of rows (h, n) that occur at least twice."""
    return rows.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("h").alias("r"))


def _open(words: Words, known: list, below: int | None, window: int) -> np.ndarray:
    """Where full windows start whose least part of ``below`` words is among the known ones of its text."""
    ok = words.valid(window)
    if below is not None:
        parts = least(words, below, window)
        for s, n, hashes in zip(words.starts.tolist(), words.counts.tolist(), known, strict=True):
            ok[s : s + n] &= np.isin(parts[s : s + n], np.array(hashes, np.int64).view(np.uint64))
    return ok


def _rows(docs: DataFrame, text: str, length: int, window: int, below: int | None) -> DataFrame:
    """``(h, n, pos, __row)``: the windows of a length that are to be looked at, each
    once for each text with its number and first place.  below: the length before,
    whose repeated windows of a text are in ``__known``."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text, SLICE):
                words = Words(_bytes(b, text))
                known = b.column("__known").to_pylist() if below is not None else []
                ok = _open(words, known, below, window)
                if length < window:
                    at, h = anchors(words, length, window, ok)
                else:
                    at = np.flatnonzero(ok)
                    h = words.windows(window, at)
                first, n = _first_in_doc(words.doc[at], h)
                doc, pos = pa.array(words.doc[at][first]), words.place()[at][first]
                yield pa.RecordBatch.from_arrays(
                    [_long(h[first]), pa.array(n.astype(np.int64)), pa.array(pos.astype(np.int32)), *(b.column(k).take(doc) for k in _KEY)],
                    ["h", "n", "pos", *_KEY])

    columns = [text, *_KEY] + (["__known"] if below is not None else [])
    return docs.select(*columns).mapInArrow(tasks, "h long, n long, pos int, __row long")


def candidates(laid: DataFrame, text: str, window: int = WINDOW, shortest: int = SHORTEST) -> tuple[DataFrame, list[tuple[int, DataFrame]], list[DataFrame]]:
    """laid with ``__known`` (the texts that have windows to look at in full; all
    without __known if there is one length alone), and for each length before the
    last that was reached (length, its repeated windows' hashes ``r``); and what was stored for that."""
    x, below, reached, kept = laid, None, [], []
    for length in levels(window, shortest)[:-1]:
        rows = stored(_rows(x, text, length, window, below).drop("pos"), f"windows{length}")
        again = stored(_repeated(rows), f"again{length}")
        known = rows.join(again, rows.h == again.r, "left_semi").groupBy(*_KEY).agg(F.collect_set("h").alias("__known"))
        kept.append(stored(known, f"known{length}"))
        x, below = laid.join(kept[-1], _KEY), length
        dropped(rows)
        kept.append(again)
        reached.append((length, again))
        if again.isEmpty():
            break
    return x, reached, kept


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, shortest: int = SHORTEST,
                   then: Callable[[DataFrame], DataFrame] = lambda cut: cut) -> DataFrame:
    """df with ``text_col`` cut, plus ``__words`` and ``__removed`` (long).

    Words are runs of characters other than ASCII white space, unchanged.  Each
    word covered by a window of ``window`` words whose sequence also starts
    anywhere else in the input, the same text included, is removed; the others
    are joined by one blank.  A null text has no words and becomes empty, as do
    texts without words; shorter texts keep all words; repeated rows repeat
    each other's windows.  An empty table gives none.  Columns of df called
    ``__words`` or ``__removed`` are replaced, all others stay, whatever their names.

    The result is ``then`` of that, written to the shared folder: the texts, which
    every level reads, are then deleted.
    """
    given = [c for c in df.columns if c.lower() not in ("__words", "__removed")]
    # own names, so that df's cannot clash with those of this module
    columns = [f"__c{i}" for i in range(len(given))]
    named, text_name = dict(zip(columns, given, strict=True)), text_col
    text_col = columns[given.index(text_col)]
    docs = df.select(*[F.col(f"`{n}`").alias(c) for c, n in named.items()]).withColumn("__row", F.monotonically_increasing_id())
    laid = laid_out(docs, "texts", _KEY)  # every level and the final cut read the texts where they lie
    x, reached, kept = candidates(laid, text_col, window, shortest)
    full = _rows(x, text_col, window, window, reached[-1][0] if reached else None)
    # the key is negated so that both sides are dealt anew: then a skewed one can be split
    again = _repeated(full.select("h", "n")).select(F.bitwise_not("r").alias("r"))
    hits = full.join(again, F.bitwise_not(full.h) == again.r, "left_semi")
    places = hits.groupBy(*_KEY).agg(F.collect_set("pos").alias("__places"))
    y = laid.join(places, _KEY, "left").select(*columns, "__places")
    fields = [f for f in y.schema.fields if f.name != "__places"]
    at_text = columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text_col, SLICE):
                texts = _bytes(b, text_col)
                kept, total, removed = [], [], []
                for text, at in zip(texts, b.column("__places").to_pylist(), strict=True):
                    words = text.split()
                    total.append(len(words))
                    if at:
                        gone = _covered(text, len(words), np.array(at), window)
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    removed.append(total[-1] - len(words))
                    kept.append(b" ".join(words))
                out = [b.column(c) for c in columns]
                out[at_text] = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*out, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], [*columns, "__words", "__removed"]
                )

    fields += [T.StructField("__words", T.LongType()), T.StructField("__removed", T.LongType())]
    done = y.mapInArrow(cut, T.StructType(fields)).select(*[F.col(c).alias(n) for c, n in named.items()], "__words", "__removed")
    out = stored(then(done), "cut")
    unlaid(laid)
    for x in kept:
        dropped(x)
    return out


def _covered(text: bytes, n: int, at: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window equal to one of those at the given places."""
    words = Words([text])
    all_of_it = words.windows(window)[: max(0, n - window + 1)]
    starts = np.flatnonzero(np.isin(all_of_it, all_of_it[at]))
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:n]) > 0


def op9_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), then=lambda cut: cut.select(
        "doc_id", F.col("__words").alias("n_words"), F.col("__removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")))


OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+') AS w FROM documents),
p AS (SELECT r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM d, unnest(range(1, len(w) - {WINDOW - 2})) t(i)),
s AS (SELECT r, i FROM p WHERE h IN (SELECT h FROM p GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS j FROM s),
k AS (SELECT d.r, string_agg(w[j], ' ' ORDER BY j) AS kept, count(*) AS n
      FROM d, unnest(range(1, len(w) + 1)) t(j) WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.r = d.r AND g.j = t.j) GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
