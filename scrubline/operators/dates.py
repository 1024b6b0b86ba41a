"""Dates in texts, shifted by a number of days or told as an age.

Twelve forms are tried in order.  A match that starts within an earlier finding
(of a form tried before, or of any detector before this one) with a replacement
is no finding.  A missing day counts as the 15th, a missing year as the
reference year; two-digit years up to the reference year's are of this century.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.spans import BLOCK, FINDINGS, Kept, cut, find_spans, findings_of, let, none_found, walk

# The parts of the date forms.
_DAY = "(0[1-9]|[12][0-9]|3[01]|[1-9])"
_NUMBER = "(0[1-9]|1[0-2]|[1-9])"
_MONTH = ("((?=[jfmasond])(?:J(?:an(?:uary)?|une?|uly?)|Feb(?:ruary)?|Ma(?:r(?:ch)?|y)|A(?:pr(?:il)?|ug(?:ust)?)"
          "|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?))")
_SUFFIX = "(?:st|nd|rd|th)?"
_YEAR = "((?:19|20)[0-9][0-9])"
_TIME = r"(?:(?:2[0-3]|1[0-9]|0?[0-9]):[0-5][0-9](?::[0-5][0-9])?(?:\s*(?:AM|A|PM|P))?(?:\s*CT)?(?:\s*h)?)"
_THEN = rf"(?:\s*{_TIME})?"
_CUT = r"(?=[^0-9]*\b)"
#: The forms as they are matched for compatibility have the one-digit days first.
_LAX_DAY = "([1-9]|0[1-9]|[12][0-9]|3[01])"
_LAX_NUMBER = "([1-9]|0[1-9]|1[0-2])"

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
FOUND_BY = "deid-date"


@dataclass(frozen=True)
class Form:
    pattern: str
    month: int
    year: int | None
    day: int | None
    short_year: bool = False


def forms(compat: bool = False) -> list[Form]:
    """compat: an ISO date before a ``T`` and eight digits lose their last digits."""
    iso = Form(rf"\b{_YEAR}(/|-){_NUMBER}\2{_DAY}(?:T{_TIME}?)?\b", 3, 1, 4)
    compact = Form(rf"\b{_YEAR}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])(?:[0-2][0-9][0-5][0-9](?:[0-5][0-9])?)?\b", 2, 1, 3)
    if compat:
        iso = Form(rf"\b{_YEAR}(/|-){_LAX_NUMBER}\2{_LAX_DAY}(?:T?:\s*{_TIME})?", 3, 1, 4)
        compact = Form(rf"\b{_YEAR}{_LAX_NUMBER}{_LAX_DAY}{_THEN}", 2, 1, 3)
    return [
        Form(rf"\b{_DAY}(/|-){_MONTH}\2{_YEAR}{_THEN}\b", 3, 4, 1),
        Form(rf"\b{_YEAR}(/|-){_NUMBER}\2{_DAY}{_THEN}\b", 3, 1, 4),
        Form(rf"\b{_MONTH}(/|-){_DAY}\2{_YEAR}{_THEN}{_CUT}", 1, 4, 3),
        Form(rf"\b{_NUMBER}(/|-){_DAY}\2{_YEAR}{_THEN}{_CUT}", 1, 4, 3),
        Form(rf"\b{_NUMBER}(/|-){_DAY}\2([0-2][0-9]){_THEN}{_CUT}", 1, 4, 3, True),
        Form(rf"\b{_NUMBER}(/|-){_DAY}\2([3-9][0-9]){_THEN}\b", 1, 4, 3, True),
        Form(rf"\b{_MONTH} +{_DAY}{_SUFFIX}(?:,|\s)+{_YEAR}{_THEN}\b", 1, 3, 2),
        Form(rf"\b{_NUMBER}(?:/|-){_YEAR}\b", 1, 2, None),
        Form(rf"\b{_MONTH}\s+(?:of\s+)?{_YEAR}", 1, 2, None),
        Form(rf"\b{_MONTH}\s+{_DAY}{_SUFFIX}\b", 1, None, 2),
        iso,
        compact,
    ]


def shifted(day: Column, jitter: Column) -> Column:
    return F.date_format(F.date_add(day, jitter), "MM/dd/yyyy")


def age_and_year(birth: Column, day: Column) -> Column:
    """``age 42.123 in 2020`` (years of 365 days), just the year at or before birth; null if either is."""
    days = F.datediff(day, birth)
    year = F.date_format(day, "yyyy")
    return F.when(days <= 0, year).otherwise(F.format_string("age %.3f in %s", days / F.lit(365.0), year))


#: Numbers and months of a match, in order; all else in it (suffixes, marks, letters of a time) says nothing.
_PARTS = "(?i)[0-9]+|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
#: Forms by what a text must have for them to match: they are tried only where it has.
_YEAR_FIRST, _YEAR_LAST, _SHORT_YEAR, _NAMED, _COMPACT = (1, 10), (3, 7), (4, 5), (0, 2, 6, 8, 9), (11,)
GUARDS = {
    _YEAR_FIRST: "[12](?:9(?<=19)|0(?<=20))[0-9][0-9][/-][0-9]",
    _YEAR_LAST: "[0-9][/-](?:19|20)[0-9][0-9]",
    # a digit right behind the year is none of the number's only if a time begins with it
    _SHORT_YEAR: r"[0-9]([/-])[0-9]{1,2}\1[0-9][0-9](?![0-9](?!:|[0-9]:))",
    # single characters first: alternatives and boundaries cost more
    _NAMED: r"(?i)[jfmasond][aepuco][bcglnprtvy](?<=\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))[a-z]*[\s/-]+(?:of\s+)?[0-9]",
    _COMPACT: "[12](?:9(?<=19)|0(?<=20))[0-9]{4}",
}


def _begun(form: Form) -> str:
    """A form's pattern, its first character looked at before the boundary, which costs more."""
    return f"(?i)(?={'[jfmasond]' if form.pattern.startswith(rf'\b{_MONTH}') else '[0-9]'}){form.pattern}"


def _parts(word: Column, known: list[Form], form: Column) -> Column:
    """Month, day and year (strings; null where there is none) by a match's form, without matching it again."""
    return let(F.regexp_extract_all(word, F.lit(_PARTS), F.lit(0)), lambda found: _picked(found, known, form))


def _picked(found: Column, known: list[Form], form: Column) -> Column:
    """The same from the numbers and months in it."""
    order = [sorted((x for x in (f.month, f.day, f.year) if x is not None)) for f in known]
    place = {n: F.array(*[F.lit(o.index(getattr(f, n)) + 1 if getattr(f, n) is not None else None).cast("int") for f, o in zip(known, order, strict=True)])
             for n in ("month", "day", "year")}
    compact = F.lit(len(known) - 1)  # the last form is one run of digits

    digits = found[0]
    of = lambda n: F.try_element_at(found, F.try_element_at(place[n], form + 1))
    cut_ = {"month": (5, 2), "day": (7, 2), "year": (1, 4)}
    return F.struct(*[F.when(form == compact, F.substring(digits, *cut_[n])).otherwise(of(n)).alias(n) for n in cut_])


def _parts_again(word: Column, known: list[Form], form: Column) -> Column:
    """The same for forms whose parts only their own pattern tells."""
    def of(n: str) -> Column:
        out = F.lit(None).cast("string")
        for i, f in enumerate(known):
            if getattr(f, n) is not None:
                out = F.when(form == i, F.regexp_extract(word, "(?i)" + f.pattern, getattr(f, n))).otherwise(out)
        return out.alias(n)

    return F.struct(of("month"), of("day"), of("year"))


def _day(p: Column, short: Column, reference_year: int) -> Column:
    """The date of month, day and year; a 30 February rolls over."""
    by_name = ((F.instr(F.lit(_MONTHS), F.lower(F.substring(p["month"], 1, 3))) + 2) / 3).cast("int")
    month = F.when(F.substring(p["month"], 1, 1) <= "9", p["month"].try_cast("int")).otherwise(by_name)
    y = p["year"].try_cast("int")
    year = F.when(y.isNull(), F.lit(reference_year)).when(short, y + F.when(y <= reference_year % 100, 2000).otherwise(1900)).otherwise(y)
    return F.date_add(F.make_date(year, month, F.lit(1)), F.coalesce(p["day"].try_cast("int"), F.lit(15)) - 1)


_ORDER = "struct<rank:int,start:int,end:int,word:string>"


def _alone(x: Column) -> Column:
    """Whether of candidates (by rank, then start) the first alone stays: of one, or of two if the other starts in it (11/1998 in 05/11/1998)."""
    first, other = F.try_element_at(x, F.lit(1)), F.try_element_at(x, F.lit(2))
    return (F.size(x) == 1) | ((F.size(x) == 2) & (first["start"] <= other["start"]) & (other["start"] <= first["end"]))


def _settled(candidates: Column) -> Column:
    """(rank, start, end, word) without those that start in one of a lower rank, or of
    the same rank before it, that stays.  Rank -1 is always there and never comes out."""
    def fold(xs: Column) -> Column:
        def step(acc: Column, one: Column) -> Column:
            taken = F.exists(acc, lambda f: (f["start"] <= one["start"]) & (one["start"] <= f["end"]))
            return F.when((one["rank"] < 0) | ~taken, F.concat(acc, F.array(one))).otherwise(acc)

        return F.filter(F.aggregate(F.sort_array(xs), F.array().cast(f"array<{_ORDER}>"), step), lambda f: f["rank"] >= 0)

    def apart(xs: Column) -> Column:
        """The places in xs (by start) where nothing before reaches: what lies between two of them settles alone."""
        def step(reach: Column, i: Column) -> tuple[Column, Column]:
            x = F.try_element_at(xs, i + 1)
            here = F.when(x["start"] > reach, F.array(i)).otherwise(F.array().cast("array<int>"))
            return F.greatest(reach, x["end"]), here

        return let(F.sequence(F.lit(0), F.size(xs) - 1), lambda n: walk(n, F.lit(-1), "int", "int", step))

    def parts(xs: Column) -> Column:
        def cut(at: Column) -> Column:
            few = F.filter(at, lambda _, i: i % 64 == 0)
            return let(few, lambda s: F.flatten(F.transform(s, lambda b, i: fold(
                F.slice(xs, b + 1, F.coalesce(F.try_element_at(s, i + 2), F.size(xs)) - b)))))

        return let(apart(xs), cut)

    by_start = F.transform(candidates, lambda c: F.struct(c["start"].alias("at"), c.alias("c")))
    sorted_ = F.transform(F.sort_array(by_start), lambda x: x["c"])
    return F.when(F.size(candidates) <= BLOCK // 4, fold(candidates)).otherwise(let(sorted_, parts))


def dates(text: Column, jitter: Column | None = None, birth: Column | None = None, item: str = "phi_date", replacement: str = "[DATE]",
          earlier: Column | None = None, reference_year: int | None = None, compat: bool = False,
          keep: Kept | None = None) -> Column:
    """Dates of a text.  A jitter other than 0 gives the shifted date; else a known
    birth date gives age and year (for dates with a year); else ``replacement``."""
    today = reference_year or date.today().year
    days = F.coalesce(jitter.cast("int"), F.lit(0)) if jitter is not None else F.lit(0)
    known = forms(compat)
    short = [i for i, f in enumerate(known) if f.short_year]
    yearless = [i for i, f in enumerate(known) if f.year is None]

    def moved(day: Column, rank: Column) -> Column:
        out = F.when((days != 0) & day.isNotNull(), shifted(day, days))
        if birth is not None:
            out = out.when(birth.isNotNull() & day.isNotNull() & ~rank.isin(yearless), age_and_year(birth, day))
        return out.otherwise(F.lit(replacement))

    def told(f: Column) -> Column:
        parts = (_parts_again if compat else _parts)(f["word"], known, f["rank"])
        return let(let(parts, lambda p: _day(p, f["rank"].isin(short), today)), lambda day: moved(day, f["rank"]))

    def finding(f: Column, new: Column) -> Column:
        return F.struct(f["word"].alias("word"), f["start"].alias("start"), f["end"].alias("end"), F.lit(item).alias("type"),
                        new.alias("replacement"), F.lit(FOUND_BY).alias("found_by"))

    def read(f: Column) -> Column:
        return finding(f, told(f))

    def ranked(fs: Column, rank: int) -> Column:
        return F.transform(fs, lambda f: F.struct(F.lit(rank).alias("rank"), f["start"].alias("start"), f["end"].alias("end"), f["word"].alias("word")))

    # matches carry their form's number until the conflicts are settled, so that only what stays is read as a date
    def found(passed: Column) -> Column:
        each = {i: F.when(passed[g], find_spans(text, _begun(known[i]), str(i), None, FOUND_BY)).otherwise(none_found())
                for g, of in enumerate(GUARDS) for i in of}
        all_ = F.transform(F.concat(*[each[i] for i in sorted(each)]), lambda f: F.struct(
            f["type"].cast("int").alias("rank"), f["start"].alias("start"), f["end"].alias("end"), f["word"].alias("word")))
        return F.when(F.array_contains(passed, True), let(all_, lambda x: F.when(
            F.size(x) > 0, F.transform(stays(x), read)).otherwise(none_found()))).otherwise(none_found())

    def free(c: Column) -> Column:
        if earlier is None:
            return F.lit(True)
        return ~F.exists(earlier, lambda f: f["replacement"].isNotNull() & (f["start"] <= c["start"]) & (c["start"] <= f["end"]))

    def stays(x: Column) -> Column:
        if earlier is None:  # the usual text has one date, which conflicts with nothing
            return F.when(_alone(x), F.slice(x, 1, 1)).otherwise(_settled(x))
        before = F.filter(earlier, lambda f: f["replacement"].isNotNull())
        return F.when(F.size(x) == 1, F.filter(x, free)).otherwise(_settled(F.concat(x, ranked(before, -1))))

    if keep is not None:
        return _kept(text, known, compat, keep, today, short, free, stays, read, finding, moved)
    return F.coalesce(let(F.array(*[text.rlike(g) for g in GUARDS.values()]), found), none_found()).cast(FINDINGS)


def _kept(text: Column, known: list[Form], compat: bool, keep: Kept, today: int, short: list[int], free: Callable[[Column], Column],
          stays: Callable[[Column], Column], read: Callable[[Column], Column], finding: Callable[[Column, Column], Column], moved: Callable[[Column, Column], Column]) -> Column:
    """dates() with its steps in projections of their own; a text's only match is read as a date there, too."""
    none = F.array().cast(f"array<{_ORDER}>")
    passed = {i: keep(0, text.rlike(g)) for of, g in GUARDS.items() for i in of}
    each = []
    for i, form in enumerate(known):
        parts, held = cut(text, _begun(form), passed[i], keep)
        word = F.when(held, F.substring(text, F.length(parts[0]) + 1, F.length(parts[1]))).otherwise(parts[1])
        one = F.array(F.struct(F.lit(i).alias("rank"), F.length(parts[0]).alias("start"), (F.length(parts[0]) + F.length(parts[1])).alias("end"), word.alias("word")))
        several = F.transform(findings_of(parts, held, text, str(i), None, FOUND_BY), lambda f, i=i: F.struct(
            F.lit(i).alias("rank"), f["start"].alias("start"), f["end"].alias("end"), f["word"].alias("word")))
        each.append(F.when(F.size(parts) == 3, one).when(F.size(parts) > 3, several).otherwise(none))
    some = reduce(Column.__or__, [F.coalesce(p, F.lit(False)) for p in dict((str(p), p) for p in passed.values()).values()])
    all_ = keep(2, F.when(some, F.concat(*each)).otherwise(none))
    if compat:
        return F.when(F.size(all_) > 0, F.transform(stays(all_), read)).otherwise(none_found()).cast(FINDINGS)
    lone = keep(3, F.when(_alone(all_), all_[0]))
    found = keep(4, F.regexp_extract_all(lone["word"], F.lit(_PARTS), F.lit(0)))
    parts = keep(5, _picked(found, known, lone["rank"]))
    day = keep(6, F.when(lone.isNotNull(), _day(parts, lone["rank"].isin(short), today)))
    own = keep(7, F.when(lone.isNotNull(), moved(day, lone["rank"])))
    return (F.when(F.size(all_) == 0, none_found()).when(lone.isNotNull() & free(lone), F.array(finding(lone, own)))
            .otherwise(F.transform(stays(all_), read))).cast(FINDINGS)
