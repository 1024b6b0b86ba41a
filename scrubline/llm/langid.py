"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``order`` bytes.  A byte that
was seen in a context costs its share of the context's count; an unseen one
costs an escape to the next shorter context, where the bytes of the longer one
are excluded, down to a uniform code over all 256 bytes.  After fitting the
statistics are frozen, so the exact code length of a byte in its context is a
fixed number.  A language's tree is a few sorted arrays of what was seen in it,
and what it costs to go on to the shorter context; the code lengths of a slice of
texts are found once for each different byte in its context.  The shortest code
wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.base import slices, spread, table, with_fields

#: Bounds of a model: fitting takes about MAX_DOCS different texts of each language
#: (all where there are fewer), chosen by a hash of the text.
MAX_DOCS = 500
ORDER = 3
PAD = b" " * ORDER
NONE = "und"


@dataclass
class Tree:
    """Contexts of one length of one language; codes are bytes as big-endian numbers."""

    seen: np.ndarray  # codes of the contexts and bytes that were seen in them, sorted
    bits: np.ndarray  # log2 of their counts
    contexts: np.ndarray  # codes of the contexts, sorted
    total: np.ndarray  # log2 of a context's total and distinct bytes: what a seen byte costs, without its own count
    next_total: np.ndarray  # the same for a byte that only the shorter context has, with the escape
    beyond: np.ndarray  # the escapes before a byte that neither has, less the one which the shorter context charges for it


@dataclass
class Model:
    languages: list[str]
    trees: list[list[Tree]]  # of each language: by length of contexts, from 0


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, gram long, n long)``: each byte with the ORDER bytes before it, big-endian."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text_col):
                langs = np.array(b.column(lang_col).to_pylist())
                texts = b.column(text_col).cast(pa.binary()).to_pylist()
                for lang in np.unique(langs):
                    grams = []
                    for i in np.flatnonzero(langs == lang):
                        x = np.frombuffer(PAD + texts[i], np.uint8).astype(np.int64)
                        grams.append(sum(x[k : len(x) - ORDER + k] << 8 * (ORDER - k) for k in range(ORDER + 1)))
                    gram, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([str(lang)] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                    )

    out = docs.select(text_col, lang_col).mapInArrow(tasks, "lang string, gram long, n long")
    return out.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> Model:
    """Learns from rows whose text and language are not null.

    A text counts once in a language, however often it is repeated there and under
    whatever ids, so copies neither crowd out other texts nor a language.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(text_col, lang_col, F.xxhash64(text_col).alias("__hash"))
    counts = {r[0]: r[1] for r in known.groupBy(lang_col, "__hash").agg(F.lit(1)).groupBy(lang_col).count().collect()}
    if not counts:
        return Model([], [])
    place = F.pmod(F.xxhash64(F.lit(1), text_col), F.lit(1 << 20)) / float(1 << 20)
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, max_docs / n))])
    sample = known.where(place < rate[F.col(lang_col)]).groupBy(lang_col, "__hash").agg(F.first(text_col).alias(text_col))
    grams = count_grams(sample, text_col, lang_col).toArrow()
    languages = sorted(set(grams["lang"].to_pylist()))
    lang = np.array(grams["lang"].to_pylist())
    return tabulate({x: (grams["gram"].to_numpy()[lang == x], grams["n"].to_numpy()[lang == x]) for x in languages})


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted number in the sorted keys (not empty), and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _low(codes: np.ndarray, n: int) -> np.ndarray:
    """The last n bytes of codes."""
    return codes & np.int64((1 << 8 * n) - 1)


def _trees(gram: np.ndarray, n: np.ndarray) -> list[Tree]:
    out: list[Tree] = []
    before: tuple | None = None
    for k in range(ORDER + 1):
        seen, of = np.unique(_low(gram, k + 1), return_inverse=True)
        count = np.bincount(of, n)
        contexts, owner = np.unique(seen >> 8, return_inverse=True)
        total, distinct = np.bincount(owner, count), np.bincount(owner).astype(float)
        escape = np.log2(total + distinct) - np.log2(distinct)
        if before is None:  # the last escape is to all bytes that were not seen
            left = np.maximum(256 - distinct, 1)
            rest, beyond = np.zeros(1), escape + np.log2(left)
        else:
            seen1, count1, contexts1, total1, distinct1, escape1 = before
            up, _ = _find(contexts1, _low(contexts, k - 1))
            also, _ = _find(seen1, _low(seen, k))  # what a context has its shorter one has too
            t2 = total1[up] - np.bincount(owner, count1[also])
            d2 = distinct1[up] - distinct
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = escape + np.log2(t2 + d2)
                beyond = escape + np.where(d2 > 0, np.log2(t2 + d2) - np.log2(d2), 0) - escape1[up]
        out.append(Tree(seen, np.log2(count), contexts, np.log2(total + distinct), rest, beyond))
        before = (seen, count, contexts, total, distinct, escape)
    return out


def tabulate(grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of the languages' (grams, counts)."""
    languages = sorted(grams)
    return Model(languages, [_trees(*grams[x]) for x in languages])


def _bits(trees: list[Tree], grams: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each gram (ORDER bytes and the next)."""
    out, below = None, None
    for k, t in enumerate(trees):
        at, there = _find(t.seen, _low(grams, k + 1))
        context, known = _find(t.contexts, _low(grams, k + 1) >> 8)
        if below is None:
            bits = np.where(there, t.total[context] - t.bits[at], t.beyond[context])
        else:
            at1, there1 = below
            bits = np.where(there1, t.next_total[context] - trees[k - 1].bits[at1], t.beyond[context] + out)
            bits = np.where(there, t.total[context] - t.bits[at], bits)
            bits = np.where(known, bits, out)
        out, below = bits, (at, there)
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language."""
    lengths = np.array([len(t) for t in texts], np.int64)
    x = np.frombuffer(b"".join(PAD + t for t in texts) + PAD, np.uint8).astype(np.int64)
    grams = sum(x[k : len(x) - ORDER + k] << 8 * (ORDER - k) for k in range(ORDER + 1))  # of the byte ORDER places on
    of, different = pd.factorize(grams)
    order = np.argsort(different)  # what is looked up in order is found faster
    ordered, bits = different[order], np.empty(len(different))
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
    edges = np.stack([starts, starts + lengths], 1).ravel()
    sums = np.empty((len(texts), len(model.languages)))
    for j, trees in enumerate(model.trees):
        bits[order] = _bits(trees, ordered)
        sums[:, j] = np.add.reduceat(bits[of], edges)[::2]
    sums[lengths == 0] = 0
    return sums


def predict(df: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """df plus ``lang_pred``, ``score`` (the best language's share when each has
    the weight 2^-bits) and ``bits_per_byte`` (null for an empty text).

    Texts that are null or have no letter, and all texts under a model without
    languages, are ``und`` with score 0.  Ties go to the first language by name.
    Rows do not see each other, so repeated ones get the same; an empty table gives
    no rows; texts of any length are coded whole.  The names get ``prefix``;
    columns of df with them (or called ``__has_letter``) are replaced.
    """
    added = [(prefix + n, t) for n, t in (("lang_pred", "string"), ("score", "double"), ("bits_per_byte", "double"))]
    letter = "__has_letter"
    df = df.drop(letter)
    schema = with_fields(df.schema, *added)
    names = [n for n in schema.names if n not in dict(added)]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for b in slices(batch, text_col, 1 << 20):
                texts = [t or b"" for t in b.column(text_col).cast(pa.binary()).to_pylist()]
                lang, score, rate = [NONE] * len(texts), np.zeros(len(texts)), [None] * len(texts)
                if m.languages:
                    bits = code_lengths(m, texts)
                    best = bits.argmin(1)
                    low = bits.min(1)
                    share = 1 / np.exp2(np.minimum(0, low[:, None] - bits)).sum(1)
                    for i, has in enumerate(b.column(letter).to_pylist()):
                        if has:
                            lang[i], score[i] = m.languages[best[i]], share[i]
                        if texts[i]:
                            rate[i] = low[i] / len(texts[i])
                new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *new], [*names, *dict(added)])

    has = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    return df.withColumn(letter, has).mapInArrow(tasks, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, mod 3, is 1 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op5_language_id(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
