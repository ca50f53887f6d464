"""Centroid clustering with scalar lookup tables.

Vectors of floats become vectors of integers, floor(scale * x). Since a
component then takes few values, a round does not subtract and square row by
row: for each dimension it tabulates the squared difference of every occurring
integer value and every centroid, and a distance is a sum of entries that numpy
gathers from these tables by the component's value.

The tables are made inside the tasks, one set for a block of vectors, from the
values that occur in that block: they are bounded by the block whatever the
range of the values. Tasks receive the centroids only (k * dims integers) and
return one row of sums per cluster, so a cluster that holds most vectors costs
a shuffle no more than any other. All sums are exact: long inside a task,
decimal between tasks, Python integers for the floored means.

A round reads the integer vectors from a table in the shared checkpoint folder;
a lost executor repeats at most its tasks of one round.

Defined cases: a vector that is null, of another length, or with a null or
non-finite component is left out; a component beyond +-2^27 after scaling
counts as that bound, which keeps distances inside a long; repeated rows are
vectors of their own, and of rows with one hash the lesser vector is the
earlier start; a null vec_id is clustered but is no start; with fewer vectors
than k each one with an id is a start; without any start, and on an empty
table, there are no rows; an inertia beyond a long is null; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, materialize, read

DIMS = 64
SCALE = 64
K = 16
ROUNDS = 3
SEED = "1"
BOUND = 1 << 27
BLOCK = 8192
LONG_MAX = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and v: the components as integers, of every usable vector."""
    inf = F.lit(float("inf"))
    e = F.col("embedding")
    usable = (F.size(e) == dims) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    # clamped as a double, before it becomes an integer
    whole = lambda x: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), x.cast("double") * scale))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(whole(x)).cast("int")).alias("v"))


def starts(vectors: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """The k vectors of least sha256(`seed:vec_id`), in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(h.alias("h"), "v").where("h is not null").orderBy("h", "v").limit(k).collect()   # k rows
    return np.array([r["v"] for r in rows], np.int64)


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a column in ascending order, and the place of each row's value among them."""
    lo = int(column.min())
    span = int(column.max()) - lo + 1
    if span > 4 * len(column):
        return np.unique(column, return_inverse=True)
    here = np.zeros(span, bool)
    here[column - lo] = True
    return np.flatnonzero(here) + lo, (np.cumsum(here) - 1)[column - lo]


def table_distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `block` to all centroids, by table gathers and sums."""
    out = np.zeros((len(block), len(centroids)), np.int64)
    for d in range(block.shape[1]):
        values, code = occurring(block[:, d])
        table = (values[:, None] - centroids[:, d]) ** 2
        out += table[code]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(-1, dims).astype(np.int64)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of every vector; of equally near centroids the first."""
    dims = centroids.shape[1]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _blocks(batches, dims):
            far = table_distances(block, centroids)
            near = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])],
                ["vec_id", "cluster", "distance"])

    return map_arrow(vectors, tasks, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored means of the vectors nearest to each; one without vectors stays."""
    k, dims = centroids.shape

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, block in _blocks(batches, dims):
            near = table_distances(block, centroids).argmin(axis=1)
            n += np.bincount(near, minlength=k)
            for c in np.unique(near):
                sums[c] += block[near == c].sum(axis=0)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])

    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    out = centroids.copy()
    for r in map_arrow(vectors, tasks, "cluster int, n long, sums array<long>").groupBy("cluster").agg(
            F.sum("n").alias("n"), *total).collect():                                                     # k rows
        out[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dims)]
    return out


def cluster(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, k: int = K, rounds: int = ROUNDS,
            seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector after `rounds` rounds, and the centroids."""
    whole = materialize(integer_vectors(vectors, dims, scale), "centroid-vectors")
    centroids = starts(whole, k, seed)
    if not len(centroids):
        return whole.where(F.lit(False)).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    return materialize(assign(whole, centroids), "centroid-assigned"), centroids


def op13_lookup_centroids(spark, sf_dir: str) -> DataFrame:
    near, centroids = cluster(read(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: int(r["s"]) for r in near.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}                             # k rows

    def by_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster"))

    fits = lambda x: x if x <= LONG_MAX else None
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return near.select(
        "vec_id", "cluster", "distance",
        by_cluster([fits(sums.get(c, 0)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(fits(sum(sums.values()))).cast("long").alias("inertia"),
        by_cluster(names, "string").alias("centroid_sha256"))


def _oracle(dims: int = DIMS, scale: int = SCALE, k: int = K, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same rows in DuckDB SQL, components in long form, one step per round."""
    parts = [f"""WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
q AS (SELECT r, vec_id, unnest(range({dims})) AS d,
  unnest(list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM kept),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM kept
  QUALIFY c < {k}),
c0 AS (SELECT f.c, q.d, q.v FROM first f JOIN q ON q.r = f.r)"""]
    for i in range(rounds + 1):
        parts.append(f"""far{i} AS (SELECT q.r, m.c, sum((q.v - m.v) * (q.v - m.v)) AS s FROM q JOIN c{i} m ON m.d = q.d GROUP BY q.r, m.c),
near{i} AS (SELECT r, c, CAST(s AS BIGINT) AS s FROM far{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, c) = 1)""")
        if i < rounds:
            parts.append(f"""mean{i} AS (SELECT n.c, q.d, sum(q.v) AS t, count(*) AS n FROM near{i} n JOIN q ON q.r = n.r GROUP BY n.c, q.d),
c{i + 1} AS (SELECT p.c, p.d, CAST(CASE WHEN m.n IS NULL THEN p.v ELSE (m.t - (m.t % m.n + m.n) % m.n) // m.n END AS BIGINT) AS v
  FROM c{i} p LEFT JOIN mean{i} m ON m.c = p.c AND m.d = p.d)""")
    parts.append(f"""name AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)""")
    return ",\n".join(parts) + f"""
SELECT k.vec_id, CAST(n.c AS INTEGER) AS cluster, n.s AS distance,
  CAST(sum(n.s) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(n.s) OVER () AS BIGINT) AS inertia,
  name.h AS centroid_sha256
FROM near{rounds} n JOIN kept k ON k.r = n.r JOIN name ON name.c = n.c"""


ORACLE_SQL = _oracle()
