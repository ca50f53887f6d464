"""Helpers shared by the training-data operators.

Texts reach Python in Arrow batches. A batch is cut into slices of bounded
size and each slice is handled as one flat byte array plus document offsets,
so that numpy works on many documents at once and memory does not depend on
the batch or on the length of a document's neighbours.
"""

from __future__ import annotations

import gc
import hashlib
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyline.session import checkpoint_dir

SLICE_BYTES = 2 << 20

# Fixed values of the contract: ASCII white space, and the A-Z folding.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACE_BYTES)] = False

_written: dict[str, list[str]] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor repeats at most the work after this point.
    `release` removes the tables written so far by the session, `discard` one.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more, and let Spark drop the shuffles of finished jobs."""
    for t in tables:
        _written[t.sparkSession.sparkContext.applicationId].remove(t.scratch_path)
        _delete(t.sparkSession, t.scratch_path)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session; call it when their results are no longer needed."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        _delete(spark, p)
    return len(paths)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, through the shared checkpoint folder.

    Then a job needs no installed copy on the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(package)):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(path := os.path.join(folder, n), os.path.relpath(path, os.path.dirname(package)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{os.path.basename(package)}.zip")
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, tasks: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(tasks, schema)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows (null rows are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()[:3]
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # a null slot may still span bytes; such rows count as empty
        valid = np.asarray(column.is_valid())
        if (np.diff(off)[~valid] != 0).any():
            return flat_text(column.fill_null("" if pa.types.is_string(column.type) else b""))
    return buf[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch in runs of at most `limit` text bytes (one longer row stands alone)."""
    buf, off = flat_text(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i), buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words as maximal runs of word bytes inside a row; row r holds words first[r]:first[r+1]."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = is_word[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True                       # a row boundary ends a word
    change = np.empty(n + 1, dtype=bool)
    change[0] = change[n] = True
    np.not_equal(w[1:], w[:-1], out=change[1:n])
    change |= edge
    starts = np.flatnonzero(change[:n] & w)
    ends = np.flatnonzero(change[1:] & w) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply, bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


LONG_WORD = 256


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run buf[s:e]; equal runs have equal hashes in every process."""
    lens = ends - starts
    order = np.argsort(-lens, kind="stable")
    s, n_by = starts[order], lens[order]
    h = n_by.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xCBF29CE484222325)
    long = int(np.searchsorted(-n_by, -LONG_WORD, side="left"))  # longer than LONG_WORD
    for k in range(int(n_by[long]) if long < len(n_by) else 0):
        m = int(np.searchsorted(-n_by, -k, side="left"))         # words with more than k bytes
        part = h[long:m]
        part ^= buf[s[long:m] + k]
        part *= np.uint64(0x100000001B3)
    for i in range(long):
        d = hashlib.blake2b(buf[s[i]:s[i] + n_by[i]].tobytes(), digest_size=8).digest()
        h[i] = np.frombuffer(d, "<u8")[0]
    out = np.empty_like(h)
    out[order] = mix64(h)
    return out
