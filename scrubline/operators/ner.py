"""Name recognition behind a small protocol.

A backend gives two columns of findings (persons, places) for a text column.
The built-in one goes by titles, a dictionary and capital letters, as column
expressions.  Models join in as Arrow-batched functions: see ``ModelBackend``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline import resources as R
from scrubline.functions.spans import FINDINGS, find_spans
from scrubline.operators.names import without_titles

PERSON, PLACE = ("ner-PERSON", "deid-person-ner"), ("ner-LOCATION", "deid-location-ner")


class Backend(Protocol):
    def persons(self, text: Column) -> Column: ...

    def places(self, text: Column) -> Column: ...


class GazetteerBackend:
    """Dictionary first names, and capitalised words behind a title; dictionary cities."""

    def persons(self, text: Column) -> Column:
        first = "|".join(sorted(x for names in R.FIRST_NAMES.values() for x in names))
        word = r"\p{Lu}[\p{L}'-]+"
        pattern = rf"\b(?:(?:Dr|Mr|Mrs|Ms|Prof)\.?\s+(?:{word}\s+)?{word}|(?:{first})(?:\s+{word})?)\b"
        return self.unlisted(find_spans(text, pattern, PERSON[0], None, PERSON[1]))

    def places(self, text: Column) -> Column:
        cities = "|".join(x.replace(" ", r"\s+") for x in sorted(R.CITIES, key=lambda c: (-len(c), c)))
        return find_spans(text, rf"\b(?:{cities})\b", PLACE[0], None, PLACE[1])

    @staticmethod
    def unlisted(found: Column, ignored: list[str] | None = None) -> Column:
        """Without findings that are an ignored word once titles are gone; the span keeps them."""
        words = F.array(*[F.lit(w.lower()) for w in (ignored or R.IGNORED_WORDS)])
        bare = lambda f: F.lower(F.trim(without_titles(f["word"])))
        return F.filter(found, lambda f: ~F.array_contains(words, bare(f)) & (bare(f) != ""))


class ModelBackend:
    """A model as a function from a text to (start, end, label) triples.

    load() runs once for each Python worker.  A model that fails on a text is asked
    once more and then fails the task: no text may pass as clean uninspected.
    """

    def __init__(self, load: Callable[[], Callable[[str], list[tuple[int, int, str]]]]):
        self.load = load

    def _found(self, text: Column, label: str, type_: str, found_by: str) -> Column:
        load = self.load

        @F.pandas_udf(FINDINGS)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                yield texts.map(lambda t: _rows(model, t, label, type_, found_by))

        return run(text)

    def persons(self, text: Column) -> Column:
        return self._found(text, "PERSON", *PERSON)

    def places(self, text: Column) -> Column:
        return self._found(text, "LOCATION", *PLACE)


def _rows(model, text, label: str, type_: str, found_by: str) -> list[dict]:
    if not text:
        return []
    try:
        found = model(text)
    except Exception:  # whatever a model raises counts as a failed try
        found = model(text)
    return [{"word": text[s:e], "start": s, "end": e, "type": type_, "replacement": None, "found_by": found_by} for s, e, x in found if x == label]
