"""A job as a whole: the notes are searched once, all outputs come from that."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.spans import FINDINGS
from scrubline.operators import analytics
from scrubline.plans.config import Job
from scrubline.plans.deidentify import deidentify
from scrubline.sources.writers import write_annotations, write_individual, write_jsonl, write_stats

# detectors' names and types that do not depend on a job.
DETECTORS = ["deid-general", "deid-number-general", "deid-mrn", "deid-harNum", "deid-age", "deid-date", "deid-token", "deid-name-knownNames",
             "deid-location-knownaddr", "deid-location-general", "deid-person-ner", "deid-location-ner", analytics.EXTERNAL]
TYPES = ["general-phone", "general-email", "general-ip", "general-url", "general-ssn", "000000", "general-account", "general-order", "general-accession",
         "location", "ner-PERSON", "ner-LOCATION"]


def names_of(job: Job) -> list[str]:
    """The types that findings of a job have."""
    external = [s.item for s in job.external_specs] + [f"dlp_{t}" for t in job.external_types]
    return list(dict.fromkeys([*TYPES, *(s.item for s in job.specs), *external]))


def read_result(spark: SparkSession, path: str, job: Job) -> DataFrame:
    """What run() has written to path/DeidNote, with findings as arrays again."""
    kinds = {c: "string" for c in job.id_fields}
    for t in job.text_fields:
        kinds |= {t: "string", f"TEXT_DEID_{t}": "string", f"FINDING_{t}": "string", f"FINDING_CNT_{t}": "int"}
    rows = spark.read.schema(", ".join(f"`{c}` {k}" for c, k in kinds.items())).json(f"{path.rstrip('/')}/DeidNote")
    return rows.withColumns({f"FINDING_{t}": F.from_json(f"FINDING_{t}", FINDINGS) for t in job.text_fields})


def _recounted(back: DataFrame, job: Job) -> tuple[dict[str, int], dict[str, int], dict[str, int]]:
    """By type (of the others, of the external detector) and by detector; kinds are few, so they fit the driver."""
    each = reduce(DataFrame.union, [analytics.exploded(back, t).select("type", "found_by") for t in job.text_fields])
    own, external, detectors = Counter(), Counter(), Counter()
    for r in each.groupBy("type", "found_by").agg(F.count("*").alias("n")).collect():
        (external if r.found_by == analytics.EXTERNAL else own)[r.type] += r.n
        detectors[r.found_by] += r.n
    return dict(own), dict(external), dict(detectors)


def run(notes: DataFrame, job: Job, path: str, files: bool = False, mode: str = "safe", compression: str | None = None, **options) -> analytics.Counts:
    """Writes a job's outputs below path and gives its counts.

    ``DeidNote`` are the notes as JSON lines.  With job.analytic ``statsPhiType``,
    ``statsDlpPhiType`` and ``statsPhiFoundBy`` are lines ``key:count``.  files:
    ``individual/<id>`` for each note, and ``annotator/<id>.json`` with
    job.annotator.  compression: of DeidNote's files (``gzip``, say); without it they
    are plain and many times as large as the notes.

    The notes are searched once, while their lines are written; what is counted is
    observed on the way.  A finding of a type that the job does not name (of a
    detector of one's own, say) is noticed by the totals; then the counts are taken
    from the written lines.  Files for each note come from these, too.
    """
    spark = notes.sparkSession
    types = names_of(job)
    seen = Observation()
    result = deidentify(notes, job, mode, **options)
    write_jsonl(analytics.observed(result, seen, job.text_fields, types, DETECTORS), path, compression)
    counts = analytics.counted(seen.get, len(job.text_fields), types, DETECTORS)
    if not counts.complete:
        counts.types, counts.external, counts.detectors = _recounted(read_result(spark, path, job), job)
        counts.complete = True
    if job.analytic:
        for name, found in (("statsPhiType", counts.types), ("statsDlpPhiType", counts.external), ("statsPhiFoundBy", counts.detectors)):
            write_stats(spark.createDataFrame(sorted(found.items()), "key string, count long").coalesce(1), path, name)
    if files:
        back = read_result(spark, path, job)
        write_individual(back, path, job.text_fields[0], job.id_fields[0])
        if job.annotator:
            write_annotations(back, path, job.text_fields[0], job.id_fields[0])
    return counts
