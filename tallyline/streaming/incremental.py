"""Incremental runs: new CSV files in a folder are processed once each.

A file-source stream (paths only) with ``trigger(availableNow=True)`` takes the files
present at start, processes them in micro-batches and stops; the checkpoint's
source log is the bookmark, so the next run sees only files added since.
Each micro-batch is a whole batch run under its own run id: load, archive,
quarantine and reports go to folders of that id and are written anew, so a
batch repeated after an executor or driver loss changes nothing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.table import DEFAULT_BUCKETS
from tallyline.plans.batch_run import RunConfig, RunPaths, run_batch
from tallyline.sources.csv_files import escape_path


def _file_stream(spark: SparkSession, folder: str, clean_source: str = "off",
                 archive_dir: str | None = None, max_files: int = 100_000) -> DataFrame:
    """New CSV files as a stream of paths; file content is never read here."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = (spark.readStream.format("binaryFile").schema(schema)
              .option("pathGlobFilter", "*.csv")
              .option("cleanSource", clean_source)
              .option("maxFilesPerTrigger", max_files))
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(folder).select("path")


def run_incremental(spark: SparkSession, incoming: str, checkpoint: str, paths: RunPaths, cfg: RunConfig = RunConfig(),
                    buckets: int = DEFAULT_BUCKETS, clean_source: str = "off", archive_dir: str | None = None,
                    max_files_per_batch: int = 100_000) -> int:
    """Process every file not yet seen; returns the number of micro-batches run.

    The stream only discovers files (its checkpoint is the bookmark). A
    micro-batch of at most ``max_files_per_batch`` files is one batch run; take
    few large batches, since each writes the touched buckets of the table."""
    seen = {"batches": 0}

    def body(batch: DataFrame, batch_id: int) -> None:
        files = sorted(escape_path(r["path"]) for r in batch.collect())   # bounded by maxFilesPerTrigger
        if files:
            run_batch(spark, files, paths, replace(cfg, run_id=f"{cfg.run_id}-{batch_id}"), buckets)
            seen["batches"] += 1

    q = (_file_stream(spark, incoming, clean_source, archive_dir, max_files_per_batch)
         .writeStream.foreachBatch(body)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return seen["batches"]
