"""An inspection of a large table that can be stopped and goes on where it was."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from scrubline.plans.config import Job
from scrubline.plans.deidentify import inspect
from scrubline.sources.readers import dealt


@dataclass
class Progress:
    """What the batches that are through have read."""

    batches: int = 0
    rows: int = 0


def inspect_table(spark: SparkSession, source: str, schema: StructType | str, job: Job, target: str, checkpoint: str, files_a_batch: int = 64,
                  on_batch: Callable[[int], None] | None = None, **options) -> Progress:
    """Writes the findings of all rows below source (Parquet) to ``target/batch=<n>``, and returns once all are through.

    A batch is a number of the table's files; its rows are dealt out to all cores, however few
    the files are.  The checkpoint knows which batches
    are through; a batch that was cut off is done anew and overwrites its own folder,
    so that the findings are those of one clean run, however often it was stopped.
    New files in source are taken by the next call.  on_batch is called with a
    batch's number after it has been written.
    """

    def write(batch: DataFrame, number: int) -> None:
        inspect(dealt(batch), job, **options).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")
        if on_batch is not None:
            on_batch(number)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"]]
    return Progress(len(done), sum(p["numInputRows"] for p in done))
