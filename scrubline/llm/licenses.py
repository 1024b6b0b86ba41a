"""Licence scans with ordered signature rules, in DataFrame functions only.

A text is reduced to its lower-case words.  One regex pass lets the texts
without any rule's keyword go; of the others, the rules whose keyword is there
are searched.  A detection inside another of at least its priority is
suppressed; of two with the same words the one of higher priority stays, then
the one first in the list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.spans import BLOCK, let, walk
from scrubline.llm.base import spread, table
from scrubline.llm.license_rules import CONFIDENCE, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_FOUND = "struct<first:int,upto:int,rank:int,order:int,label:string,base:boolean,confidence:double>"
#: Stands around a match while a text is cut; no word holds it.
_MARK = "\x01"


def words_joined(text: Column) -> Column:
    """The words of a text after lower-casing A-Z, joined by single blanks."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(plain, NOT_WORD, " "))


def _blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def gate_pattern() -> str:
    """Finds any keyword at the start of a word; keywords are grouped by their first letter."""
    groups: dict[str, set[str]] = {}
    for _, _, keyword, _, _ in rules():
        groups.setdefault(keyword[0], set()).add(re.escape(keyword[1:]))
    return " (?:" + "|".join(f"{c}(?:{'|'.join(sorted(rest))})" for c, rest in sorted(groups.items())) + ")"


#: From (r: rule, m: the words with marks around the rule's matches) the detections.  m is cut at
#: its marks to gap, match, gap, match, …, gap; a place is the number of blanks before it.  Matches
#: are folded in blocks, as appending to an array copies it.
_BLANKS = "(length({0}) - length(replace({0}, ' ', '')))"
_GAP, _HIT = _BLANKS.format("p[2 * i]"), _BLANKS.format("p[2 * i + 1]")
_PLACES = f"""x -> CASE WHEN contains(x.m, '{_MARK}') THEN transform(array(split(x.m, '{_MARK}', -1)), p ->
  aggregate(sequence(0, cast(size(p) div 2 as int) - 1, {BLOCK}), struct(-1 AS s, cast(array() AS array<array<{_FOUND}>>) AS out), (acc, b) ->
    transform(array(aggregate(sequence(b, least(b + {BLOCK - 1}, cast(size(p) div 2 as int) - 1)), struct(acc.s AS s, cast(array() AS array<{_FOUND}>) AS out), (a, i) ->
      struct(a.s + {_GAP} + {_HIT} AS s, concat(a.out, array(struct(
        a.s + {_GAP} AS first, -(a.s + {_GAP} + {_HIT} + 1) AS upto, -x.r.priority AS rank, x.r.order AS order, x.r.label AS label,
        x.r.base AS base, x.r.confidence AS confidence))) AS out))),
      d -> struct(d.s AS s, concat(acc.out, array(d.out)) AS out))[0],
    acc -> flatten(acc.out)))[0] ELSE cast(array() AS array<{_FOUND}>) END"""


def _places(padded: Column, rule: Column) -> Column:
    """All places of one rule, as word numbers; upto and rank are negated for sorting."""
    marked = F.regexp_replace(padded, rule["pattern"], F.lit(f"{_MARK}$0{_MARK}"))
    return F.call_function("transform", F.array(F.struct(rule.alias("r"), marked.alias("m"))), F.expr(_PLACES))[0]


def _unsuppressed(found: Column) -> Column:
    """Detections by place (longer first), without those inside one of at least their priority.

    One walk: for each priority the furthest end so far is kept.
    """
    def step(ends: Column, d: Column) -> tuple[Column, Column]:
        upto, priority = -d["upto"], -d["rank"]
        inside = F.exists(F.slice(ends, priority, F.lit(5)), lambda e: e >= upto)
        out = F.when(d["base"] | ~inside, F.array(d)).otherwise(F.array().cast(f"array<{_FOUND}>"))
        further = F.transform(ends, lambda e, i: F.when(i + 1 == priority, F.greatest(e, upto)).otherwise(e))
        return F.when(d["base"], ends).otherwise(further), out

    kept = let(F.array_sort(found), lambda x: walk(x, F.array_repeat(F.lit(0), 5), "array<int>", _FOUND, step))
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast(f"array<{_FOUND}>"))


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df plus ``n_words`` and ``detections`` (array of: label, first and last word
    counted from 0, priority, confidence, base), ordered by place.

    A null text is empty; a text without words or licences has no detections, and
    an empty table gives no rows.  Rows do not see each other: repeated rows and
    null ids are scanned like others.  Of detections with the same words one stays,
    by priority, then by the rules' order; base phrases always stay.  Whole texts of
    any length are scanned, in time about in proportion to their matches.  Columns
    of df called ``n_words`` or ``detections`` are replaced, all others stay.
    """
    listed = F.array(*[
        F.struct(
            F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(f" {k}").alias("keyword"),
            F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"), F.lit(base).alias("base"),
            F.lit(CONFIDENCE[p]).alias("confidence"), F.lit(i).alias("order"),
        )
        for i, (p, label, k, pattern, base) in enumerate(rules())
    ])
    words = "__licence_words"
    x = df.withColumn(words, words_joined(F.col(text_col)))
    n = F.when(F.col(words) == "", F.lit(0)).otherwise(_blanks(F.col(words)) + 1).cast("long")
    padded = F.concat(F.lit(" "), F.col(words), F.lit(" "))
    gate = padded.rlike(gate_pattern())
    here = F.filter(listed, lambda r: F.contains(padded, r["keyword"]))
    found = let(F.flatten(F.transform(here, lambda r: _places(padded, r))), _unsuppressed)
    out = F.transform(found, lambda d: F.struct(
        d["label"].alias("label"), d["first"].alias("first_word"), (-d["upto"] - 1).alias("last_word"),
        (-d["rank"]).alias("priority"), d["confidence"].alias("confidence"), d["base"].alias("base"),
    ))
    none = F.array().cast("array<struct<label:string,first_word:int,last_word:int,priority:int,confidence:double,base:boolean>>")
    return x.withColumns({"n_words": n, "detections": F.when(gate, out).otherwise(none)}).drop(words)


def op1_license_scan(spark, sf_dir):
    found = scan(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")
    base = F.filter("detections", lambda d: d["base"])
    joined = lambda ds: F.array_join(F.array_sort(F.array_distinct(F.transform(ds, lambda d: d["label"]))), ",")
    firsts = F.transform(base, lambda d: d["first_word"].cast("long"))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )
