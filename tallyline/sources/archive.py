"""Raw archive: every processed raw row kept with its file and archive date.

The original copies each processed file under ``YYYY/MM/DD/<name>`` and
deletes the source. Here the archive is a Parquet table with a folder per run and the
``archive_date`` in each row; moving or deleting the source files is left to the stream
source option ``cleanSource`` (archive / delete / off).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import schema as S


def archive_rows(raw: DataFrame, archive_path: str, run_id: str, on: date | None = None) -> None:
    """Raw rows (text columns, source_file) with their archive date, under run_id=<run>.

    A run writes its own folder anew, so running it twice archives once."""
    day = on or date.today()
    cols = [c for c in raw.columns if c != S.ROW_ORDINAL and not c.startswith("_")]
    raw.select(*cols, F.lit(day).alias("archive_date")).write.mode("overwrite").parquet(f"{archive_path}/run_id={run_id}")


def archive_paths(read: Callable[[list[str]], DataFrame], paths: list[str], archive_path: str, run_id: str,
                  on: date | None = None) -> tuple[list[str], dict[str, str]]:
    """Archive what `read` gives for the paths, and go on after an error of one file: (archived paths, error by path).

    All paths are written by one job. If it fails its paths are halved until
    the failing ones stand alone: k bad files of n cost about 2 k log n jobs.
    Each job has a folder of its own below the run's, named by its place in the
    list, so a repeated run writes the same folders anew."""
    archived, errors = [], {}
    todo = [(0, len(paths))] if paths else []
    while todo:
        a, b = todo.pop()
        try:
            rows = read(paths[a:b])
            cols = [c for c in rows.columns if c != S.ROW_ORDINAL and not c.startswith("_")]
            (rows.select(*cols, F.lit(on or date.today()).alias("archive_date")).write.mode("overwrite")
             .parquet(f"{archive_path}/run_id={run_id}/files={a}-{b}"))
            archived += paths[a:b]
        except Exception as e:                      # whatever a reader may raise, it concerns these files only
            if b - a == 1:
                errors[paths[a]] = str(e).splitlines()[0] if str(e) else type(e).__name__
            else:
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
    return sorted(archived), errors


def archived_files(spark, archive_path: str) -> DataFrame:
    """run_id, source_file, archive_date, rows: what the archive holds per file."""
    return (spark.read.parquet(archive_path)
            .groupBy("run_id", S.SOURCE_FILE, "archive_date").agg(F.count(F.lit(1)).alias("rows")))


def archive_key(name: str, on: date) -> str:
    """Dated location the original uses for one archived file."""
    return f"{on:%Y/%m/%d}/{name}"
