"""A job specification as one projection over a DataFrame of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline import resources as R
from scrubline.functions.hashing import jitter_from
from scrubline.functions.spans import FINDING, FINDINGS, Kept, clean_text, joined, none_found
from scrubline.operators import addresses, dates, merge, names, patterns, tokens
from scrubline.operators.ner import Backend, GazetteerBackend
from scrubline.plans.config import CUSTOM, Job, Spec

ONLY_MAPPED = "include-types-in-map-only"


def _present(df: DataFrame, fields) -> list[Column]:
    return [F.col(f"`{f}`") for f in fields if f in df.columns]


class Plan:
    """Turns specs into findings for one text column; the specs' order is the findings'."""

    def __init__(self, df: DataFrame, job: Job, ner: Backend | None = None, compat: bool = False, reference_year: int | None = None,
                 external: Callable[[Column, Column | None], Column] | None = None):
        self.df, self.job, self.compat, self.year = df, job, compat, reference_year
        self.ner = (ner or GazetteerBackend()) if job.ner else None
        self.external = external if job.external else None
        self.ignored = R.IGNORED_WORDS if job.ignore_words is None else list(job.ignore_words)
        self.keep = Kept()
        self.person = F.col(job.person_field) if job.person_field in df.columns else F.lit("")

    def jitter(self, spec: Spec) -> Column:
        """The last jitter field that has a number, else days hashed from the seed field."""
        salt = spec.params[0] if spec.params else ""
        seed = self.job.jitter_seed_field
        hashed = jitter_from(F.col(seed).cast("string"), salt, self.job.jitter_range) if seed in self.df.columns else F.lit(0)
        given = _present(self.df, spec.fields) if spec.action == "jitter_date_from_field" else []
        if not given:
            return hashed
        return F.coalesce(*[c.cast("string").try_cast("int") for c in reversed(given)], F.lit(0))

    def found(self, spec: Spec, text: Column, earlier: Column) -> Column | None:
        """Findings of one spec, None where it has nothing to do."""
        a, df, salt = spec.action, self.df, self.job.salt
        first = spec.params[0] if spec.params else None
        if a in ("general", "general_number"):
            detect = patterns.general if a == "general" else patterns.numbers
            return detect(text, spec.param_map, ONLY_MAPPED in spec.params, self.keep)
        if a == "remove_mrn":
            return patterns.mrn(text, spec.item, first or "[MRN]", self.keep)
        if a == "replace_har":
            return patterns.har(text, spec.item, patterns.HAR_REPLACEMENT if self.compat else first or patterns.HAR_REPLACEMENT, self.keep)
        if a == "remove_age":
            return patterns.age(text, spec.item, patterns.AGE_REPLACEMENT if self.compat else first or patterns.AGE_REPLACEMENT, self.keep)
        if a in ("jitter_date_from_field", "jitter_date_randomly"):
            default = (first if a == "jitter_date_from_field" else spec.params[1] if len(spec.params) > 1 else None) or merge.REMOVED
            return dates.dates(text, self.jitter(spec), None, spec.item, default, earlier, self.year, self.compat, self.keep)
        if a == "jitter_birth_date":
            given = _present(df, spec.fields)
            if not given:
                return None
            birth = F.to_date(F.timestamp_millis(given[0].cast("string").try_cast("bigint")))
            return dates.dates(text, None, birth, spec.item, first or merge.REMOVED, earlier, self.year, self.compat, self.keep)
        if a in ("replace_with", "replace_minimumlengthword_with", "replace_strictly_with"):
            given = _present(df, spec.fields)
            if not given:
                return None
            least = 1
            if a == "replace_minimumlengthword_with":
                least = int(spec.params[1]) if len(spec.params) > 1 and spec.params[1].isdigit() else 3
            known = tokens.token_set(given, self.ignored, least, a == "replace_strictly_with")
            return tokens.tokens(text, known, spec.item, first or merge.REMOVED, self.keep)
        if a == "replace_ner_name":
            if self.ner is None:
                return None
            persons = F.transform(self.ner.persons(text), lambda f: F.lower(f["word"]))
            return tokens.tokens(text, F.array_distinct(persons), spec.item, first or merge.REMOVED)
        if a == "surrogate_name":
            given = [(F.col(f), spec.param_map.get("format", "L,F")) for f in spec.fields if f in df.columns]
            if given:
                listed, skew = spec.param_map.get("surrogates"), spec.param_map.get("skew")
                return names.known_names(text, given, self.person, salt, spec.item, self.ignored, distinct=skew is None,
                                         surrogates=F.col(f"`{listed}`") if listed in df.columns else None, skew=None if skew is None else float(skew))
            if self.ner is None:
                return None
            return names.recognised_names(self.ner.persons(text), earlier, self.person, salt)
        if a == "surrogate_address":
            if spec.param_map:
                at = {k: F.col(v) if v in df.columns else None for k, v in spec.param_map.items()}
                known = addresses.Known(*(at.get(k) for k in ("f_address_1", "f_address_2", "f_city", "f_zip", "f_state_code")))
                if all(c is None for c in (known.line1, known.line2, known.city, known.zip)):
                    return None
                return addresses.known(text, known, self.person, salt, self.compat)
            general = addresses.general(text, self.person, salt)
            return general if self.ner is None else joined(general, addresses.recognised(self.ner.places(text), self.person, salt))
        if a in CUSTOM:
            return CUSTOM[a](df, spec, text, earlier)
        return None  # keep, remove

    def findings(self, text: Column) -> list[tuple[str, Callable[[Column], Column | None]]]:
        """Steps in order; each takes the findings so far."""
        steps = [(s.item, lambda earlier, s=s: self.found(s, text, earlier)) for s in self.job.specs]
        if self.external is not None:
            field = self.job.external_date_field
            jitter = F.col(f"`{field}`").cast("string").try_cast("int") if field in self.df.columns else None
            steps.append(("external", lambda earlier: self.external(text, jitter)))
        return steps


def with_findings(df: DataFrame, job: Job, text_field: str, out: str, **options) -> DataFrame:
    """df with the cleaned text and its findings in column ``out`` (null for an empty text).

    The findings so far are a column between the steps, so that no expression is
    planned twice; what the detectors keep is computed before the first of them.
    """
    out_df = df.withColumn(text_field, clean_text(F.col(text_field)))
    text = F.col(text_field)
    plan = Plan(out_df, job, **options)
    steps = [new for _, step in plan.findings(text) if (new := step(F.col(out))) is not None]
    out_df = plan.keep.onto(out_df).withColumn(out, none_found())
    for new in steps:
        out_df = out_df.withColumn(out, F.concat(F.col(out), F.coalesce(new.cast(FINDINGS), none_found())))
    return plan.keep.off(out_df.withColumn(out, F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.col(out))))


def deidentify(df: DataFrame, job: Job, mode: str = "safe", keep_columns: bool = False, **options) -> DataFrame:
    """One row for each row: the id fields (as strings) and for each text field ``t``
    the cleaned text, ``TEXT_DEID_t``, ``FINDING_t`` (array, in merge order) and
    ``FINDING_CNT_t``.  An empty text has count 0 and null texts and findings."""
    rows = df
    for t in job.text_fields:
        rows = with_findings(rows, job, t, f"FINDING_{t}", **options)
    out: list[Column] = [F.col(c).cast("string").alias(c) for c in job.id_fields if c in df.columns]
    for t in job.text_fields:
        text, found = F.col(t), F.col(f"FINDING_{t}")
        known = found.isNotNull()
        out += [
            F.when(known, text).alias(t), F.when(known, merge.splice(text, found, mode)).alias(f"TEXT_DEID_{t}"),
            F.when(known, merge.by_end(found)).alias(f"FINDING_{t}"), F.coalesce(F.size(found), F.lit(0)).alias(f"FINDING_CNT_{t}"),
        ]
    if keep_columns:
        taken = {*job.id_fields, *job.text_fields}
        out += [F.col(f"`{c}`") for c in df.columns if c not in taken]
    return rows.select(*out)


def inspect(df: DataFrame, job: Job, **options) -> DataFrame:
    """The findings alone, one row each: id fields, ``field`` and the finding's columns.
    All text fields are searched in one pass over df."""
    rows = df
    for t in job.text_fields:
        rows = with_findings(rows, job, t, f"FINDING_{t}", **options)
    ids = [F.col(c).cast("string").alias(c) for c in job.id_fields if c in df.columns]

    def named(t: str) -> Column:
        found = F.transform(f"FINDING_{t}", lambda f: F.struct(F.lit(t).alias("field"), f.alias("f")))
        return F.coalesce(found, F.array().cast(f"array<struct<field:string,f:{FINDING}>>"))

    each = F.concat(*[named(t) for t in job.text_fields])
    # the outer form: for the inner one Spark puts a filter on the array below, which runs all patterns twice
    return rows.select(*ids, F.explode_outer(each).alias("x")).where("x IS NOT NULL").select(*[c for c in job.id_fields if c in df.columns], "x.field", "x.f.*")
