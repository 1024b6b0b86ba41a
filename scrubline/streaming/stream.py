"""The same plan over streams: every detector is local to a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scrubline.plans.config import Job
from scrubline.plans.deidentify import deidentify
from scrubline.sources.writers import as_json


def deidentify_stream(notes: DataFrame, job: Job, path: str, checkpoint: str, available_now: bool = True, **options) -> StreamingQuery:
    """Appends each new note's JSON line to path, exactly once."""
    out = as_json(deidentify(notes, job, **options)).writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()


def type_counts(notes: DataFrame, job: Job, text_field: str, time_col: str, window: str = "1 hour", late: str = "10 minutes", **options) -> DataFrame:
    """Findings by window of time and type; a window closes when its watermark is past."""
    rows = deidentify(notes.withWatermark(time_col, late), job, keep_columns=True, **options)
    each = rows.select(time_col, F.explode_outer(f"FINDING_{text_field}").alias("f")).where("f IS NOT NULL")
    return each.groupBy(F.window(time_col, window), F.col("f.type").alias("type")).count()
