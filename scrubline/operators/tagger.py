"""A trained recogniser of persons and places: a structured perceptron over hashed features.

It learns from all texts with marked spans that it is given.  Spark deals the texts
out by a hash into parts, the more of them the more texts there are; in each round
every part goes through its texts from the weights that all share, and what it has
changed is added up by weight and averaged, so the weights, a fixed number of them,
are all that comes to the driver.  The weights used in the end are the average over
all steps.  Updates are whole numbers and are added as such, so the same rows give
the same weights however they arrive.  A sentence's tags are the best path by
Viterbi, of many texts at once, in Arrow batches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import resources as R
from scrubline.functions.spans import FINDINGS
from scrubline.operators.ner import PERSON, PLACE
from scrubline.sources.scratch import new_path

TAGS = ["O", "B-PERSON", "I-PERSON", "B-LOCATION", "I-LOCATION"]
_TAG = {(t[:2], t[2:]): i for i, t in enumerate(TAGS)}
#: Places of the hashed features, and the rounds.
SIZE, ROUNDS = 1 << 18, 5
#: Parts whose weights are averaged, at least; texts and bytes of a part, about, at most.
PARTS, EACH, BYTES = 8, 1 << 12, 1 << 22
#: Texts that are tagged at once; words whose hashes are kept.
AT_ONCE, KNOWN = 1 << 9, 1 << 16
_SCALE = 1 << 20
_TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*\.?|[^\w\s]|_")
_FIRST = {x.lower() for names in R.FIRST_NAMES.values() for x in names}
_PLACES = {w.lower() for c in R.CITIES for w in c.split()}
_FAR = -1e9


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, token): words, with a dot behind a short one (titles, initials), and marks."""
    out = []
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        word = m[0]
        if e - s > 4 and word[-1] == ".":
            out += [(s, e - 1, word[:-1]), (e - 1, e, ".")]
        else:
            out.append((s, e, word))
    return out


def _shape(w: str) -> str:
    c = w[0]
    kind = "X" if c.isupper() else "x" if c.islower() else "d" if c.isdigit() else c
    if len(w) > 1:
        kind += ("X" if w.isupper() else "") + ("." if w[-1] == "." else "")
    return kind + "'" if "'" in w else kind


#: Checksums of what features begin with.
_W, _S, _E, _A, _P, _N, _PP, _PS, _NS, _PN, _PPP = (zlib.crc32(x) for x in (b"w=", b"s=", b"e=", b"a=", b"p=", b"n=", b"pp=", b"ps=", b"ns=", b"pn=", b"ppp="))


@cache
def _of_shape(shape: str, first: bool, place: bool) -> tuple:
    """What a word's shape and whether it is listed give to features."""
    crc, kind, x = zlib.crc32, shape[0], shape.encode()
    return (crc(x, _S), crc(x, _PS), crc(x, _NS), x, b"|" + x, b"|" + x + b"|",
            (crc(f"f={first}False{kind}".encode()), crc(f"f={first}True{kind}".encode())), first, crc(f"l={place}{kind}".encode()))


def _hashes(low: str, shape: str) -> tuple:
    """What a word gives to the features of its own place and of those beside it: hashes, and begins and ends of them."""
    crc, x = zlib.crc32, low.encode()
    s, ps, ns, y, bar, bars, f, first, place = _of_shape(shape, low in _FIRST, low in _PLACES)
    return (crc(x, _W), s, crc(low[-3:].encode(), _E), crc(low[:2].encode(), _A), crc(x, _P), crc(x, _N), crc(x, _PP), ps, ns, crc(x, _PN), crc(x, _PPP),
            x, y, b"|" + x, bar, bars, f, first, place)


_ONE, _BEGIN, _END = zlib.crc32(b"b"), _hashes("<s>", "<s>"), _hashes("</s>", "</s>")
_known: dict[str, tuple] = {}


def _of_word(word: str) -> tuple:
    if (found := _known.get(word)) is None:
        if len(_known) >= KNOWN:
            _known.clear()
        found = _known[word] = _hashes(word.lower(), _shape(word))
    return found


def features(texts: list[list[str]]) -> np.ndarray:
    """The hashed features of each word of texts, a row for each word: itself, its parts and shape, and those beside it.

    A checksum of joined strings goes on from that of the first, so each is taken of what is not known yet.
    """
    crc = zlib.crc32
    out: list[int] = []
    for words in texts:
        # two places before, the one before, the word itself, the next one
        q, p, *rest = [_BEGIN, _BEGIN, *map(_of_word, words), _END]
        for c, n in zip(rest, rest[1:]):
            out += (_ONE, c[0], c[1], c[2], c[3], p[4], n[5], q[6], crc(c[12], p[7]), crc(n[12], c[8]),
                    crc(n[11], crc(c[15], p[9])), crc(c[14], crc(p[13], q[10])), c[16][p[17]], c[18])
            q, p = p, c
    return (np.array(out, np.int64) % SIZE).reshape(-1, 14)


def allowed() -> np.ndarray:
    """0 where a tag may follow another (the last row: at the begin), very little elsewhere."""
    out = np.zeros((len(TAGS) + 1, len(TAGS)))
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            for i, before in enumerate([*TAGS, ""]):
                if before[1:] != t[1:]:
                    out[i, j] = _FAR
    return out


_ALLOWED = allowed()


def best_path(emitted: np.ndarray, moves: np.ndarray) -> list[int]:
    """Viterbi: the tags of the highest sum; of equal ones the first."""
    n = len(emitted)
    score = emitted[0] + moves[-1]
    back = np.zeros((n, len(TAGS)), np.int64)
    for t in range(1, n):
        all_ = score[:, None] + moves[:-1]
        back[t] = all_.argmax(0)
        score = all_[back[t], np.arange(len(TAGS))] + emitted[t]
    path = [int(score.argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


def best_paths(emitted: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """best_path of many texts, one behind the other: emitted and tags by word, lengths of the texts (none of them 0)."""
    order = np.argsort(-lengths, kind="stable")  # so those that are longer than t come first
    begin, n = (np.cumsum(lengths) - lengths)[order], lengths[order]
    longer = np.searchsorted(-n, -np.arange(n[0] + 1))  # how many have a word t
    back = np.zeros(emitted.shape, np.int8)
    score = emitted[begin] + moves[-1]
    for t in range(1, n[0]):
        at = begin[: longer[t]] + t
        all_ = score[: longer[t], :, None] + moves[None, :-1]
        back[at] = all_.argmax(1)
        score[: longer[t]] = all_.max(1) + emitted[at]
    tags = np.zeros(len(emitted), np.int8)
    last = score.argmax(1)
    for t in range(n[0] - 1, -1, -1):
        if t + 1 < n[0]:
            at = begin[: longer[t + 1]] + t + 1
            last[: longer[t + 1]] = back[at, last[: longer[t + 1]]]
        tags[begin[: longer[t]] + t] = last[: longer[t]]
    return tags


def _emitted(w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sums of the features' weights; one feature after the other, so not all weights are laid out at once."""
    out = w[at[:, 0]]
    for j in range(1, at.shape[1]):
        out += w[at[:, j]]
    return out


@dataclass
class Weights:
    features: np.ndarray  # SIZE x tags
    moves: np.ndarray  # tags and begin x tags

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """(start, end, label) of each text."""
        cut = [tokens(t) for t in texts]
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        lengths = np.array([len(c) for c in cut], np.int64)
        if not lengths.any():
            return out
        at = features([[w for *_, w in c] for c in cut])
        tags = best_paths(_emitted(self.features, at), lengths[lengths > 0], self.moves + _ALLOWED)
        begin = np.cumsum(lengths) - lengths
        named = np.flatnonzero(tags)
        text = np.searchsorted(begin, named, "right") - 1  # of equal begins the last, which is the text that has words
        for i, k, tag in zip((named - begin[text]).tolist(), text.tolist(), tags[named].tolist(), strict=True):
            s, e, _ = cut[k][i]
            kind, _, label = TAGS[tag].partition("-")
            if kind == "B":
                out[k].append((s, e, label))
            else:
                out[k][-1] = (out[k][-1][0], e, label)
        return out


def gold(text: str, spans: list[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    """The words of a text and their tags; a word counts to a span that it overlaps."""
    found, tags = tokens(text), []
    last = None
    for s, e, _ in found:
        at, tag = None, 0
        for i, (a, b, label) in enumerate(spans):
            if a < e and s < b:
                at, tag = i, _TAG["I-" if i == last else "B-", label]
                break
        tags.append(tag)
        last = at
    return [w for *_, w in found], tags


def _round(rows: list[tuple[list[str], list[int]]], start: Weights) -> tuple[dict[int, int], dict[int, int]]:
    """One pass over texts: what it adds to each weight in the end, and on average over its steps (times _SCALE).

    The texts go one after the other; since few of them change the weights, those ahead
    are tagged at once, and anew behind each that does.
    """
    k = len(TAGS)
    w, moves = start.features.copy(), start.moves.copy()
    end: dict[int, int] = {}
    mean: dict[int, int] = {}
    n = len(rows)

    def add(i: int, d: int, left: int) -> None:
        end[i] = end.get(i, 0) + d
        mean[i] = mean.get(i, 0) + d * left * _SCALE // n

    steps = [step for step, (words, _) in enumerate(rows) if words]
    at = features([rows[step][0] for step in steps])
    right = np.array([t for step in steps for t in rows[step][1]], np.int8)
    lengths = np.array([len(rows[step][0]) for step in steps], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    here, ahead = 0, 8
    while here < len(steps):
        upto = min(here + ahead, len(steps))
        a, b = first[here], first[upto]
        guesses = best_paths(_emitted(w, at[a:b]), lengths[here:upto], moves + _ALLOWED)
        wrong = guesses != right[a:b]
        if not wrong.any():
            here, ahead = upto, min(2 * ahead, AT_ONCE)
            continue
        j = int(np.searchsorted(first, a + wrong.argmax(), "right")) - 1
        left, tags, guess = n - steps[j], rows[steps[j]][1], guesses[first[j] - a : first[j + 1] - a].tolist()
        for t, (g, bad) in enumerate(zip(tags, guess, strict=True)):
            if g != bad:
                for f in at[first[j] + t].tolist():
                    w[f, g] += 1
                    w[f, bad] -= 1
                    add(f * k + g, 1, left)
                    add(f * k + bad, -1, left)
            before = (tags[t - 1], guess[t - 1]) if t else (k, k)
            if (before[0], g) != (before[1], bad):
                for x, y, d in ((before[0], g, 1), (before[1], bad, -1)):
                    moves[x, y] += d
                    add((SIZE + x) * k + y, d, left)
        here, ahead = j + 1, max(8, min(2 * (j + 1 - here), AT_ONCE))
    return end, mean


def _marked(texts: pa.StructArray) -> list[tuple[list[str], list[int]]]:
    """Words and tags of a part's texts."""
    spans = texts.field("spans")
    at = spans.offsets.to_pylist()
    inside = spans.values.slice(at[0], at[-1] - at[0])
    each = list(zip(*[inside.field(f).to_pylist() for f in ("start", "end", "label")], strict=True))
    return [gold(t, each[a - at[0] : b - at[0]]) for t, a, b in zip(texts.field("text").to_pylist(), at, at[1:], strict=False)]


def _pass(shared, as_weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What goes through the texts of parts."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("texts"):
                end, mean = _round(_marked(part.values), as_weights(shared.value))
                columns = (list(end), list(end.values()), [mean[i] for i in end])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["i", "end", "mean"])

    return passed


def _kept(rows: DataFrame) -> DataFrame:
    """rows, written to the shared folder and read back."""
    path = new_path(rows.sparkSession, "marked")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def learn(marked: DataFrame, rounds: int = ROUNDS) -> Weights:
    """Weights from marked (id, text, spans array<struct<start int, end int, label string>>).

    Labels are PERSON and LOCATION.  All texts with an id are learned from; null texts do
    not count, and such without spans teach what is no name.  Rows that are the same in id
    and text are of one part.
    """
    rows = marked.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "text", "spans")
    n, size = rows.agg(F.count("text"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(PARTS, -(-n // EACH), -(-size // BYTES))
    # a part is a row of what is kept, so a round deals nothing out and does not run the query behind the texts again
    part = F.pmod(F.xxhash64(F.lit(1), "id", "text"), F.lit(parts)).alias("part")
    dealt = rows.where("text IS NOT NULL").groupBy(part).agg(F.sort_array(F.collect_list(F.struct("id", "text", "spans"))).alias("texts")).select("texts")
    cores = marked.sparkSession.sparkContext.defaultParallelism
    dealt = _kept(dealt.repartition(cores * -(-parts // (cores * 2))))  # small files, so a task's batches of parts are, too
    k = len(TAGS)
    size = (SIZE + k + 1) * k
    weights, total = np.zeros(size), np.zeros(size)
    as_weights = lambda x: Weights(x[: SIZE * k].reshape(SIZE, k), x[SIZE * k :].reshape(k + 1, k))
    for _ in range(rounds):
        shared = marked.sparkSession.sparkContext.broadcast(weights)  # SIZE * 5 numbers
        changed = dealt.mapInArrow(_pass(shared, as_weights), "i long, end long, mean long")
        changed = changed.groupBy("i").agg(F.sum("end").alias("end"), F.sum("mean").alias("mean"))
        found = changed.toArrow()  # at most one row a weight
        i = found["i"].to_numpy()
        total += weights
        total[i] += found["mean"].to_numpy() / _SCALE / parts
        weights = weights.copy()
        weights[i] += found["end"].to_numpy() / parts
        shared.unpersist()
    return as_weights(total / rounds)


class TaggerBackend:
    """A recogniser from learned weights, for jobs (``deidentify(…, ner=TaggerBackend(…))``)."""

    def __init__(self, spark, weights: Weights):
        self.shared = spark.sparkContext.broadcast(weights)
        shared = self.shared

        @F.arrow_udf("array<struct<start:int,end:int,label:string>>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = shared.value
            for batch in batches:
                found = []
                for k in range(0, len(batch), AT_ONCE):
                    found += model.spans([t or "" for t in batch.slice(k, AT_ONCE).to_pylist()])
                start, end, label = zip(*[x for each in found for x in each], strict=True) if any(found) else ((), (), ())
                inside = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(label, pa.string())], ["start", "end", "label"])
                yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), inside)

        self.run = run

    def _found(self, text: Column, label: str, type_: str, by: str) -> Column:
        own = F.filter(self.run(text), lambda x: x["label"] == label)
        return F.transform(own, lambda x: F.struct(
            F.substring(text, x["start"] + 1, x["end"] - x["start"]).alias("word"), x["start"], x["end"], F.lit(type_).alias("type"),
            F.lit(None).cast("string").alias("replacement"), F.lit(by).alias("found_by"))).cast(FINDINGS)

    def persons(self, text: Column) -> Column:
        return self._found(text, "PERSON", *PERSON)

    def places(self, text: Column) -> Column:
        return self._found(text, "LOCATION", *PLACE)
