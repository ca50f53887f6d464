"""Replay of a table as a stream of micro-batches, with a stop and a restart between any two.

Each batch of rows is added to a folder, and a query is started from its
checkpoint, takes what is new and ends. So every batch meets state, watermark
and bookmark as a restarted job would.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyline.session import keep, note, remove, work_path


@dataclass
class Replay:
    """Where the outputs are, and what each micro-batch reported."""

    outputs: DataFrame                       # rows of all micro-batches with `_batch_id`
    progress: list[dict] = field(default_factory=list)
    folder: str = ""

    def figure(self, name: str) -> list[int]:
        """A figure of the stateful operator, per micro-batch (numRowsTotal, numRowsDroppedByWatermark, ...)."""
        ops = [op for p in self.progress for op in p["stateOperators"]]
        return [op[name] if name in op else op["customMetrics"].get(name, 0) for op in ops]

    def latest(self, keys: list[str]) -> DataFrame:
        """Of the rows that one key has over the micro-batches, the last (for outputs in update mode)."""
        rest = [c for c in self.outputs.columns if c not in (*keys, "_batch_id")]
        last = self.outputs.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch_id").alias("_x"))
        return last.select(*keys, *[F.col("_x")[c].alias(c) for c in rest])

    def discard(self) -> None:
        remove(self.outputs.sparkSession, self.folder)


def replay(rows: DataFrame, batch: str, plan: Callable[[DataFrame], DataFrame], mode: str = "append", stop_after: int | None = None) -> Replay:
    """Run `plan` over `rows` as a stream whose batches are the values of the column `batch`, in ascending order.

    Outputs go to a folder per micro-batch that a repeated micro-batch writes anew,
    so a failure between output and commit leaves no rows twice. `batch` is meant
    to have a few values; a batch may be of any size."""
    spark = rows.sparkSession
    folder = note(spark, work_path(spark, f"replay-{uuid.uuid4().hex}"))
    # kept by batch, so each is read alone
    kept = f"{folder}/rows"
    rows.withColumn("_arrival", F.col(batch)).write.partitionBy("_arrival").parquet(kept)
    whole = spark.read.schema(_with(rows.schema, "_arrival")).parquet(kept)
    numbers = sorted(r[0] for r in whole.select("_arrival").distinct().collect())           # one per batch
    progress: list[dict] = []
    state = {}

    def body(out: DataFrame, batch_id: int) -> None:
        state["schema"] = out.schema
        out.write.mode("overwrite").parquet(f"{folder}/out/_batch_id={batch_id}")

    for n in numbers[:stop_after]:
        whole.where(F.col("_arrival") == n).drop("_arrival").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        out = plan(stream)
        q = (out.writeStream.foreachBatch(body).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        progress += [dict(p) if isinstance(p, dict) else _json(p) for p in q.recentProgress]
    if not numbers:
        empty = plan(spark.readStream.schema(rows.schema).parquet(_empty(rows, folder)))
        outputs = spark.createDataFrame([], empty.schema).withColumn("_batch_id", F.lit(0))
    else:
        outputs = spark.read.schema(_with(state["schema"], "_batch_id")).option("basePath", f"{folder}/out").parquet(f"{folder}/out")
    return Replay(outputs, progress, folder)


def _with(schema: StructType, number: str) -> StructType:
    return StructType([*schema.fields, StructField(number, LongType())])


def _json(progress) -> dict:
    import json

    return json.loads(progress.json)


def _empty(rows: DataFrame, folder: str) -> str:
    path = f"{folder}/in"
    rows.limit(0).write.mode("append").parquet(path)
    return path


def kept_result(result: DataFrame, run: Replay, name: str) -> DataFrame:
    """The result as a table of its own, with the replay's files removed."""
    out, _ = keep(result, name)
    run.discard()
    return out
