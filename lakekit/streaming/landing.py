"""Incremental landing of raw deliveries with Structured Streaming.

A file-source stream remembers (in its checkpoint's file log) which raw
files it has already processed, so each delivery is read exactly once and
an unchanged re-delivery costs nothing.  With ``availableNow`` the query
processes everything new and stops, which suits scheduled jobs; the
checkpoint lives under the shared folder so a restarted job on another
executor set resumes where it stopped (sink commits are idempotent).

Files that are *rewritten* under the same name are not new to the stream;
``lakekit.sources.manifest.changed_files`` reports those for a batch
re-land.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakekit.sources.files import all_text_schema


def land_raw_csv(
    spark: SparkSession,
    source_dir: str,
    columns: Sequence[str],
    target_path: str,
    checkpoint: str | None = None,
    quoted: bool = True,
    max_files_per_trigger: int | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append every not-yet-landed CSV under ``source_dir`` to Parquet.

    Rows keep their text columns plus ``_source_file`` and ``_landed_at``.
    The checkpoint lies in the target (a later call on it goes on where the
    last one stopped) unless another is given.
    """
    reader = spark.readStream.schema(all_text_schema(columns)).option("header", True)
    if quoted:
        reader = reader.option("quote", '"').option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    landed = raw.select(
        *columns,
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_landed_at"),
    )
    query = (
        landed.writeStream.format("parquet")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint or f"{target_path.rstrip('/')}/_landing_checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
