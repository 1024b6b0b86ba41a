"""Splicing findings into a text.

``safe`` (the default): findings that share a character form a cluster, which is
replaced once over its whole extent, so nothing that any finding covers
survives.  ``compat``: the order-dependent walk from the text's end that keeps
one replacement for overlapping or touching findings and can leave the left part
of a wider one; for comparison with old outputs only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.spans import BLOCK, let, walk

REMOVED = "[REMOVED]"
_CLUSTER = "struct<start:int,end:int,best:int,replacement:string>"


def valid(findings: Column, text: Column) -> Column:
    """Findings that lie in the text and cover something."""
    fit = lambda n: F.filter(findings, lambda f: (f["start"] >= 0) & (f["end"] <= n) & (f["end"] > f["start"]))
    return let(F.length(text), fit)


def clusters(findings: Column) -> Column:
    """Disjoint (start, end, best, replacement) in order; the longest member gives the
    replacement, of equals the first by start, then by order in the list."""
    none = F.array().cast(f"array<{_CLUSTER}>")
    keyed = F.transform(findings, lambda f, i: F.struct(
        f["start"].alias("start"), (f["start"] - f["end"]).alias("minus"), i.alias("i"), f["end"].alias("end"),
        F.coalesce(f["replacement"], F.lit(REMOVED)).alias("replacement")))

    def step(last: Column, f: Column) -> tuple[Column, Column]:
        size = f["end"] - f["start"]
        longer = size > last["best"]
        wider = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], f["end"]).alias("end"), F.greatest(last["best"], size).alias("best"),
            F.when(longer, f["replacement"]).otherwise(last["replacement"]).alias("replacement"))
        own = F.struct(f["start"].alias("start"), f["end"].alias("end"), size.alias("best"), f["replacement"].alias("replacement"))
        meets = last["end"] > f["start"]  # null before the first
        out = F.when(last.isNull() | meets, none).otherwise(F.array(last))
        return F.when(meets, wider).otherwise(own), out

    def end(last: Column, out: Column) -> Column:
        return F.when(last.isNull(), out).otherwise(F.concat(out, F.array(last)))

    def apart(x: Column) -> Column:
        """Findings by start, none of which meets the next, are clusters of their own."""
        own = F.transform(x, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), (-f["minus"]).alias("best"), f["replacement"].alias("replacement")))
        meet = F.exists(F.sequence(F.lit(2), F.size(x)), lambda k: F.element_at(x, k - 1)["end"] > F.element_at(x, k)["start"])
        return F.when(F.size(x) == 1, own).when(~meet, own).otherwise(walk(x, F.lit(None), _CLUSTER, _CLUSTER, step, end))

    return F.when(F.size(findings) > 0, let(F.sort_array(keyed), apart)).otherwise(none)


def splice_safe(text: Column, findings: Column) -> Column:
    """Each block of clusters is joined within its own part of the text, so that no
    place is looked for from the text's start more than once for each block."""
    def upto(all_: Column, i: Column) -> Column:
        return F.when(i > 0, F.try_element_at(all_, i)["end"]).otherwise(F.lit(0))

    def one_block(all_: Column, i: Column) -> Column:
        n = F.least(F.lit(BLOCK), F.size(all_) - i)
        own = F.struct(F.slice(all_, i + 1, n).alias("own"), upto(all_, i).alias("low"),
                       F.substring(text, upto(all_, i) + 1, upto(all_, i + n) - upto(all_, i)).alias("text"))

        def join(x: Column) -> Column:
            def piece(c: Column, k: Column) -> Column:
                at = F.when(k > 0, F.try_element_at(x["own"], k)["end"]).otherwise(x["low"])
                return F.concat(F.substring(x["text"], at - x["low"] + 1, c["start"] - at), c["replacement"])

            return F.array_join(F.transform(x["own"], piece), "")

        return let(own, join)

    def few(all_: Column) -> Column:
        def piece(c: Column, k: Column) -> Column:
            return F.concat(F.substring(text, upto(all_, k) + 1, c["start"] - upto(all_, k)), c["replacement"])

        return F.array_join(F.transform(all_, piece), "")

    def whole(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(all_) - 1, F.lit(BLOCK))
        parts = F.when(F.size(all_) <= BLOCK, few(all_)).otherwise(F.array_join(F.transform(starts, lambda i: one_block(all_, i)), ""))
        rest = F.substring(text, F.element_at(all_, -1)["end"] + 1, F.length(text))
        return F.when(F.size(all_) > 0, F.concat(parts, rest)).otherwise(text)

    return F.when(F.size(findings) > 0, let(valid(findings, text), lambda ok: let(clusters(ok), whole))).otherwise(text)


def by_end(findings: Column) -> Column:
    """Findings from the last end to the first; at equal ends the larger replacement first, null last."""
    # by plain order, which needs no comparing function
    keyed = F.transform(findings, lambda f, i: F.struct(f["end"].alias("end"), f["replacement"].alias("replacement"), (-i).alias("i"), f.alias("f")))
    return F.transform(F.sort_array(keyed, asc=False), lambda x: x["f"])


_WALK = "struct<out:string,first:int,last:int>"


def splice_compat(text: Column, findings: Column) -> Column:
    n = F.length(text)

    def walk(ordered: Column) -> Column:
        def step(acc: Column, f: Column) -> Column:
            new = F.coalesce(f["replacement"], F.lit(REMOVED))
            upto = F.when(acc["last"] < 0, n).otherwise(acc["first"])
            placed = F.struct(F.concat(new, F.substring(text, f["end"] + 1, upto - f["end"]), acc["out"]).alias("out"),
                              f["start"].alias("first"), f["end"].alias("last")).cast(_WALK)
            wider = F.struct(acc["out"].alias("out"), f["start"].alias("first"), acc["last"].alias("last")).cast(_WALK)
            bad = (f["start"] < 0) | (f["end"] < 0) | (f["start"] > n) | (f["end"] > n)
            return (F.when(bad, acc).when(acc["last"] < 0, placed)
                    .when((f["end"] < acc["last"]) & (f["start"] >= acc["first"]), acc)
                    .when((f["end"] < acc["last"]) & (f["end"] >= acc["first"]), wider)
                    .when(f["end"] < acc["first"], placed).otherwise(acc))

        begin = F.struct(F.lit("").alias("out"), F.lit(-1).alias("first"), F.lit(-1).alias("last")).cast(_WALK)
        last = F.element_at(ordered, -1)
        fits = (last["start"] >= 0) & (last["end"] >= 0) & (last["start"] <= n) & (last["end"] <= n)
        head = F.when(fits, F.substring(text, F.lit(1), last["start"])).otherwise(F.lit(""))
        return F.aggregate(ordered, begin, step, lambda acc: F.concat(head, acc["out"]))

    return F.when(F.size(findings) > 0, let(by_end(findings), walk)).otherwise(text)


def splice(text: Column, findings: Column, mode: str = "safe") -> Column:
    """The text with its findings replaced; a null text stays null."""
    if mode not in ("safe", "compat"):
        raise ValueError(f"unknown merge mode {mode!r}")
    return (splice_safe if mode == "safe" else splice_compat)(text, findings)
