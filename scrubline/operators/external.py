"""External inspection services: what goes out, and their findings as ours.

The service is a function over a batch of texts that runs in Arrow batches; any
client can stand behind it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.spans import FINDINGS
from scrubline.operators.analytics import EXTERNAL
from scrubline.operators.dates import shifted
from scrubline.plans.config import Job

# The service's limit and back-off.
MAX_BYTES = 524_288
DELAYS = (1, 2, 4)
#: Characters that two successive pieces of a long text share.  A finding belongs to the piece in
#: whose half of them it begins, so one over half of this long may be cut short at a cut.
OVERLAP = 4096


def plain_text(text: Column) -> Column:
    """ASCII only: other characters become ``*``."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "*")


def pieces(text: str, most: int = MAX_BYTES, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, piece) of the whole text, cut at blanks where there are any near the limit."""
    out, at = [], 0
    while len(text) - at > most:
        blanks = [m.start() for m in re.finditer(r"[ \t\n\x0b\f\r]", text[at + most - overlap : at + most])]
        end = at + most - overlap + blanks[-1] if blanks else at + most
        out.append((at, text[at:end]))
        back = re.search(r"[ \t\n\x0b\f\r]", text[end - overlap : end])
        at = end - overlap + (back.start() + 1 if back and overlap > back.start() + 1 else 0)
    return [*out, (at, text[at:])]


def owned(cut: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """Where the findings of each piece begin: pieces part at the middle of what they share."""
    middles = [(b + a + len(text)) // 2 for (a, text), (b, _) in zip(cut, cut[1:], strict=False)]
    return list(zip([0, *middles], [*middles, cut[-1][0] + len(cut[-1][1]) + 1], strict=True))


def retried(call: Callable, *args, delays=DELAYS, sleep=time.sleep):
    """call(*args), tried again after each delay."""
    for delay in delays:
        try:
            return call(*args)
        except Exception:  # whatever a client raises counts as a failed try
            sleep(delay)
    return call(*args)


def type_names(types: dict[str, str], prefix: str = "dlp_") -> Callable[[Column], Column]:
    """The item name of an info type, else the type behind a prefix."""
    if not types:
        return lambda t: F.concat(F.lit(prefix), t)
    listed = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return lambda t: F.coalesce(F.try_element_at(listed, t), F.concat(F.lit(prefix), t))


_DATED = FINDINGS.replace("found_by:string", "found_by:string,day:date")


def detector(service: Callable[[list[str]], list[list[tuple]]], types: dict[str, str] | None = None,
             replacements: dict[str, str] | None = None, batch: int = 64) -> Callable[..., Column]:
    """A detector (text, jitter=None) from a service that gives (start, end, info type),
    and behind them the date where it has read one, for each text.

    A text over the limit goes out in pieces, each as a text of its own; what is found
    in it is the same as in one piece, findings inside others and repeated ones too.
    replacements by info type, else ``[info type]``; a date is shifted where the
    jitter is neither null nor 0.
    """
    names, given = dict(types or {}), dict(replacements or {})

    @F.pandas_udf(_DATED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values, out = texts.fillna("").tolist(), []
            parts = [(i, at, piece, own) for i, text in enumerate(values) for cut in [pieces(text)] for (at, piece), own in zip(cut, owned(cut), strict=True)]
            found_in: list[list[tuple]] = [[] for _ in values]
            for k in range(0, len(parts), batch):
                part = parts[k : k + batch]
                for (i, at, _, (low, high)), found in zip(part, retried(service, [p[2] for p in part]), strict=True):
                    found_in[i] += [(at + f[0], at + f[1], f[2], f[3] if len(f) > 3 else None) for f in found if low <= at + f[0] < high]
            for text, found in zip(values, found_in, strict=True):
                out.append([{"word": text[s:e], "start": s, "end": e, "type": names.get(t, f"dlp_{t}"),
                             "replacement": given.get(t, f"[{t}]"), "found_by": EXTERNAL, "day": day} for s, e, t, day in found])
            yield pd.Series(out, dtype=object)

    def detect(text: Column, jitter: Column | None = None) -> Column:
        days = F.coalesce(jitter.cast("int"), F.lit(0)) if jitter is not None else F.lit(0)

        def settled(f: Column) -> Column:
            new = F.when(f["day"].isNotNull() & (days != 0), shifted(f["day"], days)).otherwise(f["replacement"])
            return F.struct(f["word"], f["start"], f["end"], f["type"], new.alias("replacement"), f["found_by"])

        return F.transform(run(plain_text(text)), settled).cast(FINDINGS)

    return detect


def for_job(service: Callable[[list[str]], list[list[tuple]]], job: Job, batch: int = 64) -> Callable[..., Column]:
    """The detector of a job: its specs for info types name the items and replacements,
    ``[info type]`` in lower case with blanks where they give none."""
    types, new = {}, {}
    for spec in job.external_specs:
        for t in map(str.upper, spec.info_types):
            types[t] = spec.item
            new[t] = spec.params[0] if spec.params else f"[{t.lower().replace('_', ' ')}]"
    return detector(service, types, new, batch)
