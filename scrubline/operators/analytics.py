"""Counts over findings."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

EXTERNAL = "google-dlp"


def exploded(result: DataFrame, text_field: str = "note") -> DataFrame:
    """One row for each finding.  The outer form, since for the inner one Spark puts a
    filter on the array below, which runs all patterns twice."""
    return result.select(F.explode_outer(f"FINDING_{text_field}").alias("f")).where("f IS NOT NULL").select("f.*")


def by_type(result: DataFrame, text_field: str = "note", external: bool = False) -> DataFrame:
    """``(key, count)`` by type: of the external detector, or of all others."""
    rows = exploded(result, text_field)
    rows = rows.where(F.col("found_by") == EXTERNAL) if external else rows.where(F.col("found_by") != EXTERNAL)
    return rows.groupBy(F.col("type").alias("key")).count()


def by_detector(result: DataFrame, text_field: str = "note") -> DataFrame:
    return exploded(result, text_field).groupBy(F.col("found_by").alias("key")).count()


def _size(found: Column, external: bool) -> Column:
    same = lambda f: (f["found_by"] == EXTERNAL) if external else (f["found_by"] != EXTERNAL)
    return F.coalesce(F.size(F.filter(found, same)), F.lit(0))


def counters(result: DataFrame, text_field: str = "note") -> DataFrame:
    """One row: findings of the external detector and of the others, texts without any."""
    found = F.col(f"FINDING_{text_field}")
    return result.agg(
        F.coalesce(F.sum(_size(found, True)), F.lit(0)).cast("long").alias("total_stage1"),
        F.coalesce(F.sum(_size(found, False)), F.lit(0)).cast("long").alias("total_stage2"),
        F.coalesce(F.sum((F.coalesce(F.size(found), F.lit(0)) == 0).cast("int")), F.lit(0)).cast("long").alias("zero_change"),
    )


def distribution(result: DataFrame, text_field: str = "note") -> DataFrame:
    """Findings a text, by stage: ``(stage, count, sum, min, max)``."""
    found = F.col(f"FINDING_{text_field}")
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), _size(found, s == 1).alias("n")) for s in (1, 2)]))
    return result.select(each.alias("x")).groupBy("x.stage").agg(
        F.count("*").alias("count"), F.sum("x.n").cast("long").alias("sum"), F.min("x.n").cast("long").alias("min"), F.max("x.n").cast("long").alias("max"))


@dataclass
class Counts:
    """What a run has counted beside its output."""

    types: dict[str, int] = field(default_factory=dict)
    external: dict[str, int] = field(default_factory=dict)
    detectors: dict[str, int] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    stages: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)  # count, sum, min and max of findings a text
    complete: bool = True  # whether every finding had one of the names that were given


def _of(values: Column, name: str) -> Column:
    """How often a name stands in an array of them."""
    return F.size(values) - F.size(F.array_remove(values, F.lit(name)))


def observed(result: DataFrame, seen: Observation, fields: Iterable[str], types: list[str], detectors: list[str]) -> DataFrame:
    """result, of which ``seen`` observes: counts by type (of the external detector and of
    the others) and detector, counters, and the distributions.

    Names have to be given since a measure is one number; the totals tell whether
    any is missing.  They are taken while the rows go by, so no second pass is made;
    a finding's names are taken out of it once, into columns that go again.
    """
    out: list[Column] = []
    fields = list(fields)
    names: dict[str, Column] = {}
    for i, f in enumerate(fields):
        found = F.col(f"FINDING_{f}")
        names[f"__own{i}"] = F.transform(F.filter(found, lambda x: x["found_by"] != EXTERNAL), lambda x: x["type"])
        names[f"__given{i}"] = F.transform(F.filter(found, lambda x: x["found_by"] == EXTERNAL), lambda x: x["type"])
        names[f"__by{i}"] = F.transform(found, lambda x: x["found_by"])
    own, given, by = ([F.col(f"__{kind}{i}") for i in range(len(fields))] for kind in ("own", "given", "by"))
    size = [(F.coalesce(F.size(g), F.lit(0)), F.coalesce(F.size(o), F.lit(0))) for g, o in zip(given, own, strict=True)]

    def total(columns: list[Column], name: str) -> None:
        added = columns[0] if len(columns) == 1 else sum(columns[1:], columns[0])
        out.append(F.coalesce(F.sum(added), F.lit(0)).cast("long").alias(name))

    for k, t in enumerate(types):
        total([F.coalesce(_of(x, t), F.lit(0)) for x in own], f"t{k}")
        total([F.coalesce(_of(x, t), F.lit(0)) for x in given], f"x{k}")
    for k, d in enumerate(detectors):
        total([F.coalesce(_of(x, d), F.lit(0)) for x in by], f"d{k}")
    total([s[0] for s in size], "total_stage1")
    total([s[1] for s in size], "total_stage2")
    total([(a + b == 0).cast("int") for a, b in size], "zero_change")
    out.append(F.count("*").alias("rows"))
    for stage in (1, 2):
        each = [s[stage - 1] for s in size]
        out += [F.min(F.least(*each) if len(each) > 1 else each[0]).cast("long").alias(f"min{stage}"),
                F.max(F.greatest(*each) if len(each) > 1 else each[0]).cast("long").alias(f"max{stage}")]
    return result.withColumns(names).observe(seen, *out).drop(*names)


def counted(measured: dict, n_fields: int, types: list[str], detectors: list[str]) -> Counts:
    """Counts from what was observed."""
    m = {k: v or 0 for k, v in measured.items()}
    named = lambda mark, names: {x: m[f"{mark}{k}"] for k, x in enumerate(names) if m[f"{mark}{k}"]}
    out = Counts(named("t", types), named("x", types), named("d", detectors), {k: m[k] for k in ("total_stage1", "total_stage2", "zero_change")})
    out.stages = {s: (m["rows"] * n_fields, m[f"total_stage{s}"], m[f"min{s}"], m[f"max{s}"]) for s in (1, 2)}
    whole = m["total_stage1"] + m["total_stage2"]
    out.complete = sum(out.types.values()) + sum(out.external.values()) == whole == sum(out.detectors.values())
    return out
