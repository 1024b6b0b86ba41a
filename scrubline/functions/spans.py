"""Findings: where something was found in a text, as column expressions.

A finding is a struct (word, start, end, type, replacement, found_by); offsets
are code points of the original text, end exclusive.  Every detector is a
function from columns to a column of ``array<finding>``, so Catalyst sees one
projection and no Python runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDING = "struct<word:string,start:int,end:int,type:string,replacement:string,found_by:string>"
FINDINGS = f"array<{FINDING}>"
#: Stands around a match while a text is cut, and what takes its place in a text that holds it: control
#: characters, neither words nor blanks for any pattern. With a wider one the JVM would copy each text to two bytes a character.
MARK, NO_MARK = "\x01", "\x02"
#: Items that are folded into one array before the next is begun: appending copies an array.
BLOCK = 256


def none_found() -> Column:
    return F.array().cast(FINDINGS)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


class Kept:
    """Columns that later ones use more than once, each in a projection of its own level.

    What ``let`` gives to one expression this gives to a frame: a lambda is interpreted
    node by node, while projections without any become generated code.  Level n sees what
    the levels below it keep.
    """

    def __init__(self, prefix: str = "__kept"):
        self.prefix, self.levels, self.names = prefix, {}, {}

    def __call__(self, level: int, value: Column) -> Column:
        key = (level, str(value))
        if key not in self.names:
            self.names[key] = f"{self.prefix}_{level}_{len(self.names)}"
            self.levels.setdefault(level, {})[self.names[key]] = value
        return F.col(self.names[key])

    def onto(self, df: DataFrame) -> DataFrame:
        for level in sorted(self.levels):
            df = df.withColumns(self.levels[level])
        return df

    def off(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.names.values())


def blocks(items: Column, size: int = BLOCK) -> Column:
    """A non-empty array as an array of arrays of at most size items."""
    return F.transform(F.sequence(F.lit(0), F.size(items) - 1, F.lit(size)), lambda i: F.slice(items, i + 1, F.lit(size)))


def walk(items: Column, state: Column, state_type: str, out_type: str, step: Callable[[Column, Column], tuple[Column, Column]],
         end: Callable[[Column, Column], Column] = lambda state, out: out) -> Column:
    """Goes through items (not empty) with a state: step(state, item) gives the next
    state and an array of what comes out; end(state, all that came out) is the result.

    Time and memory grow about in proportion to the items, however many one row has.
    """
    none = F.array().cast(f"array<{out_type}>").alias("out")
    begin = F.struct(state.cast(state_type).alias("s"), F.array().cast(f"array<array<{out_type}>>").alias("out"))

    # only what is new is cast: a cast of all that is there would go through it at every step
    def one(acc: Column, x: Column) -> Column:
        s, out = step(acc["s"], x)
        return F.struct(s.cast(state_type).alias("s"), F.concat(acc["out"], out.cast(f"array<{out_type}>")).alias("out"))

    def block(acc: Column, xs: Column) -> Column:
        done = F.aggregate(xs, F.struct(acc["s"].alias("s"), none), one)
        return let(done, lambda d: F.struct(d["s"].alias("s"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    return F.aggregate(blocks(items), begin, block, lambda acc: end(acc["s"], F.flatten(acc["out"])))


#: Findings of p (a text cut at its marks to gap, match, gap, match, …, gap) with at least one match; they
#: are folded in blocks, as in walk().  t: text, held: whether it holds a mark itself, k, r, by.  As SQL text,
#: since a plan has dozens of these, and SQL is parsed faster than columns are put together.
_FOLD = f"""aggregate(sequence(0, cast(size(%p) div 2 as int) - 1, {BLOCK}), struct(0 AS s, cast(array() AS array<{FINDINGS}>) AS out), (acc, b) ->
    transform(array(aggregate(sequence(b, least(b + {BLOCK - 1}, cast(size(%p) div 2 as int) - 1)), struct(acc.s AS s, cast(array() AS {FINDINGS}) AS out), (a, i) ->
      struct(a.s + length(%p[2 * i]) + length(%p[2 * i + 1]) AS s, concat(a.out, array(struct(
        CASE WHEN %held THEN substring(%t, a.s + length(%p[2 * i]) + 1, length(%p[2 * i + 1])) ELSE %p[2 * i + 1] END AS word,
        a.s + length(%p[2 * i]) AS start, a.s + length(%p[2 * i]) + length(%p[2 * i + 1]) AS end, %k AS type, %r AS replacement, %by AS found_by))) AS out))),
      d -> struct(d.s AS s, concat(acc.out, array(d.out)) AS out))[0],
    acc -> flatten(acc.out))"""
#: One match is a finding at once.
_ONE = """array(struct(
    CASE WHEN %held THEN substring(%t, length(%p[0]) + 1, length(%p[1])) ELSE %p[1] END AS word,
    length(%p[0]) AS start, length(%p[0]) + length(%p[1]) AS end, %k AS type, %r AS replacement, %by AS found_by))"""


def _filled(sql: str, **names: str) -> str:
    for k in ("held", "by", "p", "t", "k", "r"):
        sql = sql.replace("%" + k, names.get(k, f"x.{k}"))
    return sql


#: From (t, m: text with marks, held, k, r, by) the findings.
_CUT = (f"x -> CASE WHEN contains(x.m, '{MARK}') THEN transform(array(split(x.m, '{MARK}', -1)), p -> CASE WHEN size(p) = 3 THEN "
        + _filled(_ONE, p="p") + " ELSE " + _filled(_FOLD, p="p") + f" END)[0] ELSE cast(array() AS {FINDINGS}) END")
_SEVERAL = "x -> " + _filled(_FOLD)


def cut(text: Column, pattern: str | Column, here: Column, keep: Kept, level: int = 1, behind: bool = False) -> tuple[Column, Column]:
    """A text cut at the marks around a pattern's matches, kept (null unless ``here``), and whether it holds a mark itself."""
    held = keep(0, F.contains(text, F.lit(MARK)))
    plain = F.when(held, F.translate(text, MARK, NO_MARK)).otherwise(text)
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    marked = F.regexp_replace(plain, p, F.lit(f"$1{MARK}$2{MARK}" if behind else f"{MARK}$0{MARK}"))
    return keep(level, F.when(here, F.split(marked, MARK, -1))), held


def findings_of(parts: Column, held: Column, text: Column, type_: str, replacement: str | None, found_by: str) -> Column:
    """The findings of what ``cut`` gives."""
    k, r, by = F.lit(type_), F.lit(replacement).cast("string"), F.lit(found_by)
    before, word = F.length(parts[0]), F.when(held, F.substring(text, F.length(parts[0]) + 1, F.length(parts[1]))).otherwise(parts[1])
    one = F.array(F.struct(word.alias("word"), before.alias("start"), (before + F.length(parts[1])).alias("end"), k.alias("type"),
                           r.alias("replacement"), by.alias("found_by")))
    given = F.struct(parts.alias("p"), text.alias("t"), held.alias("held"), k.alias("k"), r.alias("r"), by.alias("by"))
    several = F.call_function("transform", F.array(given), F.expr(_SEVERAL))[0]
    return F.when(F.size(parts) == 3, one).when(F.size(parts) > 3, several).otherwise(none_found())


def find_spans(text: Column, pattern: str | Column, type_: str | Column, replacement: str | Column | None, found_by: str,
               replace_word: Callable[[Column], Column] | None = None, behind: bool = False) -> Column:
    """All non-overlapping matches of a pattern, left to right.

    replace_word gives the replacement from the matched word where it depends on
    it.  behind: what counts is the pattern's second group, right behind its first.  One pass puts marks around the matches, and the text is cut at the marks
    where there are any; a null text has no findings.
    """
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    kind = F.lit(type_) if isinstance(type_, str) else type_
    fixed = replacement if isinstance(replacement, Column) else F.lit(replacement).cast("string")
    held = F.contains(text, F.lit(MARK))
    marked = F.regexp_replace(F.when(held, F.translate(text, MARK, NO_MARK)).otherwise(text), p, F.lit(f"$1{MARK}$2{MARK}" if behind else f"{MARK}$0{MARK}"))
    given = F.struct(text.alias("t"), marked.alias("m"), held.alias("held"), kind.alias("k"), fixed.alias("r"), F.lit(found_by).alias("by"))
    found = F.coalesce(F.call_function("transform", F.array(given), F.expr(_CUT))[0], none_found())
    return F.transform(found, lambda f: f.withField("replacement", replace_word(f["word"]))) if replace_word else found


def joined(*found: Column) -> Column:
    """Findings of several detectors, in order."""
    return F.concat(*found) if found else none_found()


def utf16_offset(text: Column, at: Column) -> Column:
    """The UTF-16 offset of a code point offset (code points over U+FFFF count twice)."""
    before = F.substring(text, F.lit(1), at)
    wide = F.length(before) - F.length(F.regexp_replace(before, "[\\x{10000}-\\x{10FFFF}]", ""))
    return at + wide


def clean_text(text: Column) -> Column:
    """Replacement characters (U+FFFD) become line breaks."""
    return F.when(F.contains(text, F.lit("�")), F.translate(text, "�", "\n")).otherwise(text)
