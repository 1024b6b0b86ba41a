"""Person names: known ones of a row, and those a name recogniser finds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline import resources as R
from scrubline.functions.hashing import keyed_index, permuted, pick, skewed_index
from scrubline.functions.spans import FINDINGS, find_spans, let, none_found

FOUND_BY = "deid-name-knownNames"


def without_titles(name: Column) -> Column:
    """Titles and pronouns are taken out of a name as words."""
    return F.regexp_replace(name, r"(?i)\b(" + "|".join(R.TITLES) + r")\b", "")


def _at(salt: str, person: Column, word: Column, n: int, skew: float | None) -> Column:
    return keyed_index(salt, person, word, n) if skew is None else skewed_index(salt, person, word, n, skew)


def last_name(word: Column, person: Column, salt: str, skew: float | None = None) -> Column:
    """skew: the first names of the dictionary are taken oftener (see skewed_index)."""
    return pick(R.LAST_NAMES, _at(salt, person, word, len(R.LAST_NAMES), skew), word)


def first_name(word: Column, person: Column, salt: str, skew: float | None = None) -> Column:
    """Of the same sex as the name where the dictionary has it, else a woman's."""
    men = F.array(*[F.lit(x.lower()) for x in R.FIRST_NAMES["M"]])
    of = lambda sex: pick(R.FIRST_NAMES[sex], _at(salt, person, word, len(R.FIRST_NAMES[sex]), skew), word)
    return F.when(F.array_contains(men, F.lower(word)), of("M")).otherwise(of("F"))


def full_name(name: Column, person: Column, salt: str) -> Column:
    """Two parts with a comma: last, first; two parts: first, last; else a last name."""
    parts = F.filter(F.split(name, "[ ,]+"), lambda p: p != "")
    two = F.size(parts) == 2
    comma = F.contains(name, F.lit(","))
    a, b = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    return (F.when(two & comma, F.concat_ws(" ", last_name(a, person, salt), first_name(b, person, salt)))
            .when(two, F.concat_ws(" ", first_name(a, person, salt), last_name(b, person, salt)))
            .otherwise(last_name(name, person, salt)))


def typed_words(value: Column, layout: str, ignore: list[str]) -> Column:
    """Lower-case words of a name with their kind (L or F) by layout, such as ``L,F``;
    words past its end have the last kind, a kind other than L, M and F is none."""
    kinds = [{"L": "L", "M": "L", "F": "F"}.get(k.strip().upper()) for k in layout.split(",")]
    last = next((k for k in reversed(kinds) if k), None)
    stop = F.array(*[F.lit(w.lower()) for w in ignore]) if ignore else F.array().cast("array<string>")
    words = F.filter(F.split(F.lower(F.coalesce(value.cast("string"), F.lit(""))), "[ ,-]+"),
                     lambda w: (w != "") & (w != "null") & ~F.array_contains(stop, w))
    listed = F.array(*[F.lit(k).cast("string") for k in kinds])
    return F.transform(words, lambda w, i: F.struct(
        w.alias("word"), F.when(i < len(kinds), F.try_element_at(listed, (i + 1).cast("int"))).otherwise(F.lit(last).cast("string")).alias("kind")))


def distinct_surrogates(words: Column, person: Column, salt: str) -> Column:
    """A map from the words (word, kind) of a person's names to surrogates, all different and none of
    them one of the person's names: the words, in order, are numbered, and each kind's list is
    gone through by a permutation that the person keys.  As the numbers go by all names of
    a row, a person's rows should hold the same ones.  More names than a list has keep none."""
    def listed(words_: Column, own: Column, kind: str, options: list[str]) -> Column:
        mine = F.filter(words_, lambda w: w["list"] == kind)
        names = F.array(*[F.lit(x) for x in options])
        key = F.concat_ws("|", F.lit(salt), F.lit(kind), F.coalesce(person.cast("string"), F.lit("")))
        # as many as there can be names to leave out, and more
        tried = F.sequence(F.lit(0), F.least(F.size(mine) + F.size(own), F.lit(len(options))) - 1)
        new = F.transform(F.transform(tried, lambda i: permuted(i, len(options), key)), lambda i: F.try_element_at(names, (i + 1).cast("int")))
        free = F.filter(new, lambda x: x.isNotNull() & ~F.array_contains(own, F.lower(x)))
        return let(free, lambda n: F.transform(mine, lambda w, i: F.struct(w["word"].alias("key"), F.try_element_at(n, i + 1).alias("value"))))

    def named(words_: Column) -> Column:
        own = F.transform(words_, lambda w: w["word"])
        lists = (("L", R.LAST_NAMES), ("M", R.FIRST_NAMES["M"]), ("F", R.FIRST_NAMES["F"]))
        return F.map_from_entries(F.concat(*[listed(words_, own, kind, options) for kind, options in lists]))

    men = F.array(*[F.lit(x.lower()) for x in R.FIRST_NAMES["M"]])
    kinds = F.transform(words, lambda w: F.struct(w["word"].alias("word"), F.when(w["kind"] == "L", F.lit("L")).when(F.array_contains(men, w["word"]), F.lit("M")).otherwise(F.lit("F")).alias("list")))
    # a word that is both kinds counts once, as the first by kind
    one = let(F.array_sort(kinds), lambda k: F.filter(k, lambda w, i: (i == 0) | (F.try_element_at(k, i)["word"] != w["word"])))
    return let(one, named)


def known_names(text: Column, fields: list[tuple[Column, str]], person: Column, salt: str, item: str = "patient_name",
                ignore: list[str] | None = None, distinct: bool = False, surrogates: Column | None = None,
                skew: float | None = None) -> Column:
    """Surrogates for the words (over two characters) of known names, wherever they
    stand as whole words.  fields: (value, layout).  One name has one surrogate.

    distinct: and different names of a row have different ones (see
    ``distinct_surrogates``).  surrogates: a map from lower-case words to names, from a
    dictionary table; words that it lacks are treated as without it.  skew (not with
    distinct): names at the begin of the lists are taken oftener."""
    kept = _kept(fields, ignore)

    def search(names: Column) -> Column:
        def by_hash(hit: Column) -> Column:
            kind = F.filter(names, lambda w: w["word"] == F.lower(hit))[0]["kind"]
            return F.when(kind == "F", first_name(hit, person, salt, skew)).otherwise(last_name(hit, person, salt, skew))

        def found(new: Callable[[Column], Column]) -> Column:
            given = (lambda hit: F.coalesce(F.try_element_at(surrogates, F.lower(hit)), new(hit))) if surrogates is not None else new
            return find_spans(text, _pattern(names), item, None, FOUND_BY, given)

        by_map = lambda: let(distinct_surrogates(names, person, salt), lambda m: found(lambda hit: F.coalesce(F.try_element_at(m, F.lower(hit)), F.lit("[REMOVED]"))))
        return F.when(F.size(names) > 0, by_map() if distinct else found(by_hash)).otherwise(none_found())

    return let(kept, search).cast(FINDINGS)


def _kept(fields: list[tuple[Column, str]], ignore: list[str] | None) -> Column:
    words = F.flatten(F.array(*[typed_words(v, layout, ignore or []) for v, layout in fields]))
    return F.filter(words, lambda w: (F.length(w["word"]) > 2) & w["kind"].isNotNull())


def _pattern(names: Column) -> Column:
    """Any of the words as a whole word in any case, longer ones first."""
    only = F.array_distinct(F.transform(names, lambda w: w["word"]))
    longest = F.array_sort(only, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    quoted = F.transform(longest, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.concat(F.lit(r"(?iu)\b("), F.array_join(quoted, "|"), F.lit(r")\b"))


def known_of_person(fields: list[tuple[Column, str]], person: Column, salt: str, ignore: list[str] | None = None) -> Column:
    """What ``placed`` needs: the pattern of a person's names and the map to their distinct
    surrogates; null for a person without names.  Taken once a person and joined to the notes, it
    spares each note the numbering of the lists, which costs far more than the search."""
    return let(_kept(fields, ignore), lambda names: F.when(F.size(names) > 0, F.struct(
        _pattern(names).alias("pattern"), distinct_surrogates(names, person, salt).alias("surrogates"))))


def placed(text: Column, known: Column, item: str = "patient_name") -> Column:
    """The findings of ``known_names(…, distinct=True)`` from a column of ``known_of_person``."""
    new = lambda hit: F.coalesce(F.try_element_at(known["surrogates"], F.lower(hit)), F.lit("[REMOVED]"))
    return F.when(known.isNotNull(), find_spans(text, known["pattern"], item, None, FOUND_BY, new)).otherwise(none_found()).cast(FINDINGS)


def recognised_names(ner: Column, earlier: Column, person: Column, salt: str) -> Column:
    """Surrogates for recognised persons that no earlier finding has at the same place."""
    new = F.filter(ner, lambda n: ~F.exists(earlier, lambda f: (f["start"] == n["start"]) & (f["end"] == n["end"])))
    return F.transform(new, lambda n: n.withField("replacement", full_name(n["word"], person, salt))).cast(FINDINGS)
