"""De-identified notes, annotations, findings and counts as files."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.spans import let
from scrubline.sources.files import file_name, numbered, write_each

# Labels of finding types in annotation records.
LABELS = {
    "general-phone": "PHONE/FAX", "general-email": "EMAIL/URL", "general-url": "EMAIL/URL", "general-ip": "IP", "general-ssn": "SSN",
    "general-account": "ACCOUNT", "general-order": "ORDER", "general-accession": "ACCESSION", "ner-PERSON": "NAME", "ner-LOCATION": "LOCATION",
    "location": "LOCATION", "phi_date": "DATE", "mrn": "MRN", "har": "HAR", "age": "AGE",
}


def stamped(path: str) -> str:
    """A folder of this run below path."""
    return f"{path.rstrip('/')}/{int(time.time() * 1000)}"


def label(type_: Column, labels: dict[str, str] | None = None) -> Column:
    """The label of a finding's type, else the type itself."""
    pairs = LABELS if labels is None else labels
    listed = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(listed, type_), type_)


def as_json(result: DataFrame) -> DataFrame:
    """One string column ``value``: the row as JSON, findings as a JSON string."""
    columns = [F.to_json(c).alias(c) if c.startswith("FINDING_") and not c.startswith("FINDING_CNT_") else F.col(f"`{c}`") for c in result.columns]
    return result.select(F.to_json(F.struct(*columns)).alias("value"))


def write_jsonl(result: DataFrame, path: str, compression: str | None = None) -> None:
    """``DeidNote``: a line for each row.  compression: a codec of Spark's text files; lines hold a text twice
    and its findings besides, so gzip makes less than a tenth of them; readers unpack it by the file's ending."""
    as_json(result).write.text(f"{path.rstrip('/')}/DeidNote", compression=compression)


def write_individual(result: DataFrame, path: str, text_field: str = "note", id_field: str = "id", repeats: str = "error") -> None:
    """``individual/<id>`` for each note: its clean text.  Ids are percent-encoded, so different
    ones have different files; a repeated id is an error, or its rows are told apart (``number``)."""
    out = result.select(file_name(F.col(id_field)).alias("name"), F.coalesce(F.col(f"TEXT_DEID_{text_field}"), F.lit("")).alias("value"))
    write_each(numbered(out, repeats), f"{path.rstrip('/')}/individual")


def annotations(result: DataFrame, text_field: str = "note", id_field: str = "id", labels: dict[str, str] | None = None) -> DataFrame:
    """``(id, text, label)``: label is an array of [start, end, name] (start and end as
    text there), one for each place, in order: the last finding of a place wins."""
    found = F.coalesce(F.col(f"FINDING_{text_field}"), F.array().cast(result.schema[f"FINDING_{text_field}"].dataType))
    # by place, the last of each first; by plain order, which needs no comparing function
    placed = F.sort_array(F.transform(found, lambda f, i: F.struct(f["start"].alias("start"), f["end"].alias("end"), (-i).alias("i"), f["type"].alias("type"))))
    last = let(placed, lambda all_: F.filter(all_, lambda f, i: (i == 0) | (F.try_element_at(all_, i)["start"] != f["start"]) | (F.try_element_at(all_, i)["end"] != f["end"])))
    spans = F.transform(last, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), label(f["type"], labels).alias("label")))
    return result.select(F.col(id_field).cast("string").alias("id"), F.coalesce(F.col(text_field), F.lit("")).alias("text"), spans.alias("label"))


def annotation_json(annotated: DataFrame) -> DataFrame:
    """``(id, value)``: ``{"text":…,"label":[[start,end,"NAME"],…],"id":…}``."""
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    spans = F.array_join(F.transform("label", lambda x: F.concat(
        F.lit("["), x["start"].cast("string"), F.lit(","), x["end"].cast("string"), F.lit(","), quoted(x["label"]), F.lit("]"))), ",")
    value = F.concat(F.lit('{"text":'), quoted(F.col("text")), F.lit(',"label":['), spans, F.lit('],"id":'), quoted(F.col("id")), F.lit("}"))
    return annotated.select("id", value.alias("value"))


def write_annotations(result: DataFrame, path: str, text_field: str = "note", id_field: str = "id", repeats: str = "error") -> None:
    """``annotator/<id>.json`` for each note; ids as in write_individual."""
    out = annotation_json(annotations(result, text_field, id_field)).select(file_name(F.col("id")).alias("name"), "value")
    write_each(numbered(out, repeats), f"{path.rstrip('/')}/annotator", ".json")


def write_stats(counts: DataFrame, path: str, name: str) -> None:
    """Lines ``key:count``."""
    counts.select(F.concat_ws(":", "key", "count").alias("value")).write.text(f"{path.rstrip('/')}/{name}")


def write_findings(findings: DataFrame, target: str, table: bool = False) -> None:
    """The findings table of an inspection, as Parquet files or a catalog table."""
    findings.write.saveAsTable(target) if table else findings.write.parquet(target)
