"""Exact removal of repeated byte strings by column-wise construction of suffix order.

A byte goes if a string of `length` bytes that covers it also starts elsewhere,
in any document. Which strings repeat is read from the common prefixes of
neighbours in suffix order:

* Anchors. Every string of `length` bytes picks the least hash among its grams
  of GRAM bytes, leftmost first. Equal strings pick the same place in
  themselves, so a string can only repeat if its anchor's gram does. A maximal
  run of neighbouring strings with one anchor is a segment; segments whose gram
  occurs once are dropped by a count.
* Collections. Segments with the same gram, aligned at it, are a collection of
  short texts. It is built from the last column to the first. In each round one
  symbol of every text is inserted: the texts, in the order of their suffixes
  behind the column, are dealt stably by the new symbol, which gives the order
  with it (and, read in that order, the symbols before it are the
  Burrows-Wheeler transform of this round). The common prefix of two neighbours
  is one more than the least one between them in the round before, or zero. As
  the texts are aligned, suffixes of one column never compete with another's,
  so a round costs the number of texts.
* A window is repeated if its neighbour's common prefix reaches `length`, or if
  its segment occurs twice as a whole.

The sequential files are Spark's: segments reach a task sorted by gram, and are
read once in runs of bounded size. Equal segments are counted before the
shuffle, so a passage in a third of all documents is one text with a count. The
collection of a gram with more than `hot` different segments is split by longer
grams: a window holds the gram and LENGTH - GRAM bytes around it, so either half
of these to its right or more than the other half to its left; its part of the
segment goes to the collection of the gram so extended. That repeats, eight times
at most, until no collection is larger; equal windows stay together throughout.

Defined cases: a null or short text loses nothing; repeated documents lose all
their bytes if they have `length`; a null or repeated doc_id is carried as it
is; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import discard, map_arrow, materialize, mix64, read, slices

LENGTH = 200
GRAM = 64      # a power of two; longer grams repeat less often by chance, shorter ones make fewer segments
HOT = 8192
STEP = 1 << 20
RUN_TEXTS = 16384
N_BITS = 16

_rng = np.random.default_rng(20240301)
BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_POWERS = _rng.integers(0, 1 << 63, 7, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_key(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text."""
    return F.xxhash64(text).alias("ta"), F.xxhash64(F.lit(7), text).alias("tb")


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place, by doubling."""
    h, have = BYTE_HASH[buf], 1
    while have < GRAM:
        h = h[:-have] * BYTE_POWERS[have % len(BYTE_POWERS)] + h[have:]
        h ^= h >> np.uint64(29)
        have *= 2
    return mix64(h)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours."""
    m, have = keys, 1
    while 2 * have <= width:
        m, have = np.minimum(m[:-have], m[have:]), 2 * have
    rest = width - have
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def segments(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, anchor offset, gram hash) of all runs of windows with one anchor; start is within the row."""
    out = []
    ends = np.repeat(off[1:], np.diff(off))
    for x in range(0, len(buf) - length + 1, STEP):
        part = buf[x:x + STEP + length - 1]
        h = gram_hashes(part)
        keys = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_least(keys, length - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.arange(len(anchor))
        valid = start + x + length <= ends[x:x + len(anchor)]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (ends[x + 1:x + len(anchor)] != ends[x:x + len(anchor) - 1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        n = np.add.reduceat(valid, first)
        row = np.searchsorted(off, first + x, side="right") - 1
        out.append((row, first + x - off[row], n, anchor[first] - first, h[anchor[first]]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(gram, ta, tb, place): a row per segment; place holds its start, its number of windows and its anchor offset."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, off in slices(batch):
                row, start, n, at, h = segments(buf, off, length)
                place = (start << 2 * N_BITS) | (n << N_BITS) | at
                ta, tb = np.asarray(part.column("ta"))[row], np.asarray(part.column("tb"))[row]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ta), pa.array(tb), pa.array(place)], ["gram", "ta", "tb", "place"])

    return map_arrow(texts.select("text", "ta", "tb"), tasks, "gram long, ta long, tb long, place long")


def _strings(held: DataFrame, length: int) -> DataFrame:
    """The bytes of every listed segment of the held texts, with its text, start and the text's number of rows `m`."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb, m = (batch.column(c).to_pylist() for c in ("ta", "tb", "m"))
            for r in range(batch.num_rows):
                raw = batch.column("text")[r].as_buffer().to_pybytes()
                places = batch.column("places")[r].values
                gram, place = np.asarray(places.field("gram")), np.asarray(places.field("place"))
                start, n, at = place >> 2 * N_BITS, place >> N_BITS & 0xFFFF, place & 0xFFFF
                for i in range(0, len(gram), 8192):
                    s, e = start[i:i + 8192], (start + n + length - 1)[i:i + 8192]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(gram[i:i + 8192]), pa.array(at[i:i + 8192].astype(np.int32)),
                        pa.array([raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)], pa.binary()),
                        pa.array([ta[r]] * len(s), pa.int64()), pa.array([tb[r]] * len(s), pa.int64()), pa.array(s),
                        pa.array([m[r]] * len(s), pa.int64()),
                    ], ["gram", "at", "bytes", "ta", "tb", "start", "m"])

    return map_arrow(held, tasks, "gram long, at int, bytes binary, ta long, tb long, start long, m long")


def build(gram: np.ndarray, at: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each aligned text of the collections (sorted by gram): which of its windows a neighbour repeats."""
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    left = int(at.max())
    lo = left - at                                        # column of a text's first byte
    columns = int((lo + size).max())
    symbols = np.zeros((columns, n), np.uint16)           # column by column, 0 outside a text
    flat = np.frombuffer(b"".join(texts), np.uint8)
    which = np.repeat(np.arange(n), size)
    symbols[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + lo[which], which] = flat.astype(np.uint16) + 1
    group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1]))).astype(np.int64) * 257
    order = np.arange(n)
    common = np.zeros(n + 1, np.int64)                    # common prefix of a text and the one before it
    repeated = np.zeros((columns, n), dtype=bool)
    for k in range(columns - 1, -1, -1):
        inserted = symbols[k, order]
        key = group[order] + inserted
        dealt = np.argsort(key, kind="stable")
        ranked = key[dealt]
        same = (ranked[1:] == ranked[:-1]) & (inserted[dealt[1:]] > 0)
        grown = np.zeros(n + 1, np.int64)
        if same.any():
            pairs = np.empty((int(same.sum()), 2), np.int64)
            pairs[:, 0], pairs[:, 1] = dealt[:-1][same] + 1, dealt[1:][same] + 1
            least = np.minimum.reduceat(common, pairs.reshape(-1))[::2]
            grown[1:n][same] = np.minimum(least + 1, length)
        order, common = order[dealt], grown
        full = (common[:n] >= length) | (common[1:] >= length)
        repeated[k, order[full]] = True
    return [repeated[a:a + s - length + 1, i] for i, (a, s) in enumerate(zip(lo.tolist(), size.tolist(), strict=True))]


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


FOUND = "sa long, sb long, gram long, at int, windows array<struct<start:long,stop:long>>"


def _collections(strings: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the segments (gram, at, bytes, n); rows of a gram lie together in a partition."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(t: pa.Table) -> pa.RecordBatch:
            gram, at, n = (np.asarray(t.column(c).combine_chunks()) for c in ("gram", "at", "n"))
            texts = t.column("bytes").to_pylist()
            flags = build(gram, at, texts, length)
            found = [_runs(f if k == 1 else np.ones(len(f), bool)) for f, k in zip(flags, n.tolist(), strict=True)]
            some = np.array([bool(x) for x in found])
            t = t.select(["sa", "sb", "gram", "at"]).filter(pa.array(some))
            return t.append_column("windows", pa.array([x for x in found if x], kind)).combine_chunks()

        for batch in batches:
            held.append(batch)
            t = pa.Table.from_batches(held)
            if t.num_rows >= RUN_TEXTS:
                gram = np.asarray(t.column("gram").combine_chunks())
                cut = int(np.flatnonzero(gram == gram[-1])[0])           # the last gram may go on
                if cut:
                    yield from done(t.slice(0, cut)).to_batches()
                    held = t.slice(cut).to_batches()
        if held and (t := pa.Table.from_batches(held)).num_rows:
            yield from done(t).to_batches()

    return map_arrow(strings, tasks, FOUND)


OWN = ["osa", "osb", "ogram", "oat", "shift"]          # the segment that a part comes from, and where the part begins in it


def _extended(parts: DataFrame, length: int) -> DataFrame:
    """Parts of segments by grams extended to the right or to the left; `l` and `r` are the bytes beside the first gram that all share."""
    free = length - GRAM - F.col("l") - F.col("r")
    half = F.ceil(free / 2).cast("int")
    # a window that begins d bytes before the gram; here d lies in l .. l + free
    first, last = F.col("at") - (F.octet_length("bytes") - length), F.col("at")
    edge = F.col("l") + free - half
    right = F.struct(F.greatest(F.col("l"), first).alias("lo"), F.least(edge, last).alias("hi"), F.col("l").alias("l"), (F.col("r") + half).alias("r"),
              F.xxhash64("gram", F.lit("r"), F.substring(F.col("bytes"), F.col("at") + GRAM + F.col("r") + 1, half)).alias("gram"))
    left = F.struct(F.greatest(edge + 1, first).alias("lo"), F.least(F.col("l") + free, last).alias("hi"), (edge + 1).alias("l"), F.col("r").alias("r"),
             F.xxhash64("gram", F.lit("l"), F.substring(F.col("bytes"), F.col("at") - edge, edge + 1 - F.col("l"))).alias("gram"))
    two = parts.select("bytes", "n", "at", *OWN, F.explode(F.array(right, left)).alias("p")).where("p.lo <= p.hi")
    begin = F.col("at") - F.col("p.hi")
    part = F.substring(F.col("bytes"), begin + 1, F.col("p.hi") - F.col("p.lo") + length)
    return two.select("p.gram", F.col("p.hi").alias("at"), "p.l", "p.r", part.alias("bytes"), "n", "osa", "osb", "ogram", "oat",
                      (F.col("shift") + begin).alias("shift")).withColumns({"sa": F.xxhash64("bytes"), "sb": F.xxhash64(F.lit(7), "bytes")})


def _split_up(many: DataFrame, length: int, hot: int) -> DataFrame:
    """The repeated windows of the segments of crowded grams, from collections of longer grams."""
    zero = F.lit(0).cast("int")
    parts = many.select("gram", "at", zero.alias("l"), zero.alias("r"), "bytes", "n", F.col("sa").alias("osa"), F.col("sb").alias("osb"),
                        F.col("gram").alias("ogram"), F.col("at").alias("oat"), zero.alias("shift"))
    out = None
    while True:
        parts = materialize(_extended(parts, length), "repeat-parts")
        sizes = parts.select("gram", "at", "sa", "sb").distinct().groupBy("gram").count()
        crowd = materialize(sizes.where(F.col("count") > hot).select("gram"), "repeat-crowd")
        few = parts.join(crowd, "gram", "left_anti")
        counted = few.groupBy("gram", "at", "sa", "sb", "bytes").agg(F.sum("n").alias("n")).repartition("gram").sortWithinPartitions("gram")
        found = _collections(counted.select("gram", "at", "bytes", "n", "sa", "sb"), length)
        back = found.join(few.select("gram", "at", "sa", "sb", *OWN).distinct(), ["gram", "at", "sa", "sb"])
        back = back.select(F.col("osa").alias("sa"), F.col("osb").alias("sb"), F.col("ogram").alias("gram"), F.col("oat").alias("at"),
                           F.transform("windows", lambda w: F.struct((w["start"] + F.col("shift")).alias("start"), (w["stop"] + F.col("shift")).alias("stop"))).alias("windows"))
        out = back if out is None else out.unionByName(back)
        if crowd.isEmpty():
            return out
        parts = parts.join(crowd, "gram", "left_semi").drop("sa", "sb")


def _cut(held: DataFrame, length: int) -> DataFrame:
    """Removes the union of the repeated windows (starts of runs in `windows`) from each text."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                raw = np.frombuffer(batch.column("text")[r].as_buffer(), np.uint8)
                w = batch.column("windows")[r].values
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, np.asarray(w.field("start")), 1)
                np.add.at(edge, np.asarray(w.field("stop")) + length - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = raw[~gone].tobytes()
                out.append((int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            a, b, c, d = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("ta"), batch.column("tb"), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                              pa.array(c, pa.string()), pa.array(d, pa.binary())],
                                             ["ta", "tb", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_arrow(held, tasks, "ta long, tb long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining bytes `kept` (null: nothing was removed)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = texts.select("doc_id", "text", *text_key(F.col("text")))

    places = materialize(_anchors(keyed.where(F.octet_length("text") >= length), length), "repeat-places")
    often = places.groupBy("gram").agg(F.count("*").alias("uses")).where("uses > 1").select("gram")
    listed = materialize(places.join(often, "gram").distinct().groupBy("ta", "tb").agg(
        F.collect_list(F.struct("gram", "place")).alias("places")), "repeat-listed")
    discard(places)

    # a row per different text from here on, with its number of rows; copies are combined before the shuffle
    one = keyed.where(F.octet_length("text") >= length).groupBy("ta", "tb").agg(F.first("text").alias("text"), F.count("*").alias("m"))
    held = materialize(one.join(listed, ["ta", "tb"]), "repeat-texts")
    discard(listed)

    strings = _strings(held, length).withColumns({"sa": F.xxhash64("bytes"), "sb": F.xxhash64(F.lit(7), "bytes")})
    counted = materialize(strings.groupBy("gram", "at", "sa", "sb", "bytes").agg(F.sum("m").alias("n")), "repeat-strings")
    # grams with very many different segments: few, as each has more than `hot`
    crowd = materialize(counted.groupBy("gram").count().where(F.col("count") > hot).select("gram"), "repeat-crowd")
    few = counted.join(crowd, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram").select("gram", "at", "bytes", "n", "sa", "sb")
    found = _collections(few, length)
    if not crowd.isEmpty():
        found = found.unionByName(_split_up(counted.join(crowd, "gram", "left_semi"), length, hot))
    found = materialize(found, "repeat-found")
    discard(counted)

    spans = strings.select("ta", "tb", "start", "gram", "at", "sa", "sb").distinct().join(found, ["gram", "at", "sa", "sb"])
    spans = spans.select("ta", "tb", F.explode(F.transform("windows", lambda w: F.struct(
        (w["start"] + F.col("start")).alias("start"), (w["stop"] + F.col("start")).alias("stop")))).alias("w"))
    spans = materialize(spans.groupBy("ta", "tb").agg(F.collect_list("w").alias("windows")), "repeat-spans")
    cut = materialize(_cut(held.select("ta", "tb", "text").join(spans, ["ta", "tb"]), length), "repeat-cut")
    discard(held)

    rows = keyed.select("doc_id", "ta", "tb", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return rows.join(cut, ["ta", "tb"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept")


def op3_column_bwt(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
