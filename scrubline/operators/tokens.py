"""Known values of a row, found in the same row's text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.spans import Kept, cut, find_spans, findings_of, let, none_found

FOUND_BY = "deid-token"


def token_set(values: list[Column], ignore: list[str] | None = None, min_length: int = 1, strict: bool = False) -> Column:
    """Lower-case tokens of the values: split at blanks and commas (strict: at dashes
    too), without "null", the ignored words (strict keeps them) and short ones."""
    text = F.lower(F.concat_ws(" ", *[v.cast("string") for v in values]))
    parts = F.split(text, "[ ,-]+" if strict else "[ ,]+")
    kept = F.filter(parts, lambda t: (F.length(t) >= max(1, min_length)) & (t != "null"))
    if ignore and not strict:
        kept = F.filter(kept, lambda t: ~t.isin([w.lower() for w in ignore]))
    return F.array_distinct(kept)


def token_pattern(tokens: Column) -> Column:
    """Any of the tokens (over one character) as whole words in any case: a dash stands
    for any character and blanks for white space.  Null where none is left."""
    return _any_of(F.filter(tokens, lambda t: F.length(t) > 1))


def _any_of(long: Column) -> Column:
    # by plain order, which needs no comparing function: longer ones first, then by bytes
    keyed = F.transform(long, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    quoted = F.transform(F.sort_array(keyed), lambda x: _quoted(x["t"]))
    return F.when(F.size(long) > 0, F.concat(F.lit(r"(?i)\b("), F.array_join(quoted, "|"), F.lit(r")\b")))


def _quoted(t: Column) -> Column:
    return F.regexp_replace(F.replace(F.regexp_replace(t, r"([^\p{L}\p{N}\s-])", r"\\$1"), F.lit("-"), F.lit(".")), r"\s+", r"\\s")


def tokens(text: Column, found: Column, item: str, replacement: str = "[REMOVED]", keep: Kept | None = None) -> Column:
    """All places of the tokens.  Rows without tokens cost no regex."""
    def use(pattern: Column) -> Column:
        return F.when(pattern.isNotNull(), find_spans(text, pattern, item, replacement, FOUND_BY)).otherwise(none_found())

    if keep is None:
        return let(token_pattern(found), use)
    long = keep(1, F.filter(keep(0, found), lambda t: F.length(t) > 1))
    one = F.concat(F.lit(r"(?i)\b("), _quoted(long[0]), F.lit(r")\b"))
    pattern = keep(2, F.when(F.size(long) == 1, one).otherwise(_any_of(long)))
    return findings_of(*cut(text, pattern, pattern.isNotNull(), keep, 3), text, item, replacement, FOUND_BY)
