"""Near-duplicates by min-max hashing.

Under each hash function both the least and the greatest value of a document's
shingle set are kept: two signature values for one evaluation, each equal for
two sets with probability equal to their Jaccard similarity. The values are cut
into bands; documents that share a band's key are candidates, and a candidate
pair is a link only if its full shingle sets reach the threshold.

How the work is spread:

* documents with the same shingle set are one class from the start;
* in each bucket (documents with one band key) every document is tried against
  one leader, so a bucket of n needs n pairs, not n * n. The leader is the
  document that meets most others over all its buckets: in a group of edited
  copies that is the text closest to all of them;
* documents of buckets that then still hold several components are joined by
  rare shingles: two sets of similarity t or more share one of the first few
  shingles of both when these are ordered from rare to frequent, and what may
  follow the first shared one must suffice for t. That is exact. A passage that
  many unrelated texts share is frequent, so it makes no pair of them; an edited
  copy whose own edits already rule out t makes none either. Only pairs of
  different components are formed, and those of the component that has most
  of a shingle's documents are not tried among themselves.

With `rows` 4 and `bands` 32 a pair of similarity 0.75 shares no band with a
chance of 5e-6; higher similarities far less. That is the only way to miss a link
that joins components. Links inside a component change nothing and are not all
tried.

Defined cases: a text with fewer than `width` words is one shingle; a null or
wordless text has an empty set, is linked with nothing and is its own
component; rows with one doc_id are one document if their texts agree, and
otherwise all are linked under that id; a null doc_id is never linked; an empty
table yields no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import FOLD, NOT_SPACE, hash_words, map_arrow, materialize, mix64, read, slices, word_spans
from tallyline.llm.components import components

WIDTH = 5
PERCENT = 75
BANDS = 32
ROWS = 4
SLICE = 1 << 20
COUNTER_BITS = 20        # counters of the shingle frequencies by which prefixes are ordered: 4 MB
SEED = 20240229


def hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    return draw(), draw() * np.uint64(2) + np.uint64(1)


def shingles(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin."""
    starts, ends, first = word_spans(buf, off, NOT_SPACE)
    h = hash_words(FOLD[buf], starts, ends)
    n_words = np.diff(first)
    size = np.minimum(n_words, width)
    n = np.where(n_words > 0, n_words - size + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][row]
    out = size[row].astype(np.uint64)
    for k in range(width):
        live = size[row] > k
        part = out[live] * np.uint64(0x9E3779B97F4A7C15) + h[at[live] + k]
        out[live] = mix64(part)
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    out, row = out[new], row[new]
    return out, np.searchsorted(row, np.arange(len(n) + 1))


def min_max(values: np.ndarray, first: np.ndarray, functions: int) -> np.ndarray:
    """Signature rows [least of each function, greatest of each]; only for rows with shingles."""
    xor, odd = hash_functions(functions)
    rows = np.flatnonzero(np.diff(first))
    at = first[:-1][rows]
    sig = np.empty((len(rows), 2 * functions), np.uint64)
    for k in range(functions):
        h = (values ^ xor[k]) * odd[k]
        h ^= h >> np.uint64(32)
        sig[:, k] = np.minimum.reduceat(h, at)
        sig[:, functions + k] = np.maximum.reduceat(h, at)
    return sig


def band_columns(bands: int, rows: int) -> np.ndarray:
    """Signature columns of each band's rows; turned from row to row, so no band holds both values of one function."""
    return np.stack([np.roll(np.arange(r * bands, (r + 1) * bands), r) for r in range(rows)])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band: a hash of its values and its number."""
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    for columns in band_columns(bands, rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, columns])
    return out


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (two hashes of the whole set, null if empty), keys: one per band."""
    functions = -(-bands * rows // 2)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in slices(batch, limit=SLICE):
                values, first = shingles(buf, off, width)
                n = np.diff(first)
                rows_with = np.flatnonzero(n)
                keys = np.zeros((part.num_rows, bands), np.uint64)
                pair = np.zeros((part.num_rows, 2), np.uint64)
                if len(rows_with):
                    at = first[:-1][rows_with]
                    keys[rows_with] = band_keys(min_max(values, first, functions), bands, rows)
                    pair[rows_with, 0] = np.add.reduceat(mix64(values), at)
                    pair[rows_with, 1] = np.bitwise_xor.reduceat(mix64(values + np.uint64(SEED)), at)
                empty = n == 0
                flat = pa.array(keys.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n.astype(np.int64)),
                    pa.array(pair[:, 0].copy().view(np.int64), mask=empty),
                    pa.array(pair[:, 1].copy().view(np.int64), mask=empty),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (part.num_rows + 1) * bands, bands, dtype=np.int32)), flat),
                ], ["doc_id", "n_shingles", "set_a", "set_b", "keys"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), tasks,
                     "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>")


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and its sorted shingle hashes."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in slices(batch):
                values, first = shingles(buf, off, width)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "shingles"])

    return map_arrow(docs, tasks, "doc_id long, shingles array<long>")


def _reaches(a: str, b: str, percent: int):
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = materialize(signatures(texts, width, bands, rows), "near-signatures")
    known = sig.where(F.col("doc_id").isNotNull())

    # one class per shingle set; rows that share a doc_id are linked as well
    members = known.where(F.col("set_a").isNotNull())
    classes = materialize(members.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("rep")), "near-classes")
    doc_rep = members.join(classes, ["n_shingles", "set_a", "set_b"]).select("doc_id", "rep").distinct()
    same = materialize(doc_rep.where("doc_id <> rep"), "near-same").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    reps = members.join(classes.select("n_shingles", "set_a", "set_b", F.col("rep").alias("doc_id")),
                        ["n_shingles", "set_a", "set_b", "doc_id"]).select("doc_id", "keys")

    shared = materialize(_shared(reps.select("doc_id", F.explode("keys").alias("key")).distinct()), "near-shared")
    stars = materialize(_stars(shared), "near-stars")
    wanted = materialize(shared.select("doc_id").distinct(), "near-wanted")
    sets = materialize(shingle_sets(texts.join(wanted, "doc_id").dropDuplicates(["doc_id", "text"]), width), "near-sets")
    links = materialize(_confirmed(stars, sets, percent), "near-links")

    comp = components(links, "near-first")
    rest = materialize(_confirmed(_by_rare_shingles(_unsettled(shared, comp), sets, percent), sets, percent), "near-rest")
    every = components(links.unionByName(rest).unionByName(same), "near-components")
    out = sig.select("doc_id", "n_shingles").join(every.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of the keys that two documents or more have, with the number of rows `n` of the key."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return rows.join(sizes.where("lo <> hi").select("key", "n"), "key")


def _stars(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's leader and its other documents."""
    meets = shared.groupBy("doc_id").agg(F.sum("n").alias("meets"))
    leader = shared.join(meets, "doc_id").groupBy("key").agg(F.max(F.struct("meets", (-F.col("doc_id")).alias("d"))).alias("x"))
    return shared.join(leader.select("key", (-F.col("x.d")).alias("a")), "key").where("doc_id <> a").select(
        F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(right, "b").join(left, "a").where(_reaches("sa", "sb", percent)).select("a", "b").distinct()


def _unsettled(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(doc_id, component) of the documents in buckets that hold several components."""
    at = shared.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return materialize(at.join(mixed, "key").select("doc_id", "component").distinct(), "near-unsettled")


PART = 1 << 18          # shingles that a step sorts at once


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in runs of at most PART shingles (one larger set stands alone), their shingles, and where each row's begin."""
    for batch in batches:
        off = np.asarray(batch.column("shingles").offsets)
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + PART, side="right")) - 1)
            part = batch.slice(i, j - i)
            yield part, np.asarray(part.column("shingles").flatten()).view(np.uint64), off[i:j + 1] - off[i]
            i = j


def shingle_counts(sets: DataFrame, bits: int = COUNTER_BITS) -> np.ndarray:
    """How often shingles occur over `sets`, in 2^bits counters by the shingle's highest bits."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << bits, np.int64)
        for _, values, _ in _lists(batches):
            n += np.bincount((values >> np.uint64(64 - bits)).astype(np.int32), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["i", "n"])

    got = map_arrow(sets.select("shingles"), tasks, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()   # at most 2^bits rows
    out = np.zeros(1 << bits, np.uint32)
    out[got.column("i").to_numpy()] = np.minimum(got.column("n").to_numpy(), (1 << 32) - 1)
    return out


def _prefixes(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(shingle, doc_id, component, n, pos): each document's rarest shingles, as many as any partner must share one of."""
    bits = np.uint64(64 - (len(counts).bit_length() - 1))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, off in _lists(batches):
            size = np.diff(off)
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((values, counts[(values >> bits).astype(np.int32)], row))
            pos = np.arange(len(values)) - off[row]
            keep = pos < (size - -(-percent * size // 100) + 1)[row]
            order, row, pos = order[keep], row[keep], pos[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[order].view(np.int64)), part.column("doc_id").take(pa.array(row)), part.column("component").take(pa.array(row)),
                 pa.array(size[row].astype(np.int64)), pa.array(pos)], ["shingle", "doc_id", "component", "n", "pos"])

    return map_arrow(sets, tasks, "shingle long, doc_id long, component long, n long, pos long")


def _by_rare_shingles(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among `docs` (doc_id, component) that can reach the threshold; no such pair is left out."""
    own = materialize(sets.join(docs, "doc_id").select("doc_id", "component", "shingles"), "near-own")
    rows = materialize(_prefixes(own, shingle_counts(own), percent), "near-prefixes")
    spread = rows.groupBy("shingle", "component").count().groupBy("shingle").agg(
        F.count("*").alias("c"), F.max(F.struct("count", "component")).alias("top")).where("c > 1")
    rows = materialize(rows.join(spread.select("shingle", F.col("top.component").alias("top")), "shingle"), "near-rare")
    x = rows.where("component <> top").select("shingle", *[F.col(c).alias(f"x_{c}") for c in ("doc_id", "component", "n", "pos")])
    y = rows.select("shingle", *[F.col(c).alias(f"y_{c}") for c in ("doc_id", "component", "n", "pos")])
    # at the first shingle that both share, what is left of either must hold the overlap that is needed
    enough = (100 + percent) * F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos")) >= percent * (F.col("x_n") + F.col("y_n"))
    met = x.join(y, (x.shingle == y.shingle) & (F.col("x_component") != F.col("y_component")) & enough)
    return materialize(met.select(F.least("x_doc_id", "y_doc_id").alias("a"), F.greatest("x_doc_id", "y_doc_id").alias("b")).distinct(), "near-tries")


def op8_min_max(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
