"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items are folded (A-Z to lower case) and reduced to words
of letters, digits and non-ASCII characters, joined by one space. The test
strings are all windows of 13 consecutive words of an item; an item with fewer
words is one window. A text position is looked at through the block of bytes
that ends the window: a shift table says how far the window may move without
skipping an occurrence, and only where it says zero does the block's hash pick
a bucket of test strings, which are then compared byte by byte.

Test strings are grouped by length, so that a short item does not shorten the
steps of all others. Many stretches of a batch of texts move together, one
numpy step each. The items (a stated set of queries against all rows) are folded
and cut into pieces by Spark, and taken in blocks of about `block_bytes` of
folded text: that is what the driver holds and sends at a time. A task makes its
tables from the block: a test string is a place in the block's bytes, so a
window costs some 40 bytes beside them, not its text. Each block is one more pass
over the same rows, without a shuffle; what a pass has found is written before
the next one, so a task never holds two blocks.

Defined cases: a null text has no words; a null or wordless item has no
window; a repeated item_id counts once, a null one is written as ''; repeated
documents are judged alike; an empty table yields no rows; other columns of
the documents are carried in `row` and cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import FOLD, hash_words, map_arrow, materialize, mix64, read, slices, word_spans

WINDOW = 13
BLOCK_BYTES = 16 << 20
PIECE_WORDS = 50_000
LANE = 512
TABLE_BITS = 20
HASH = np.uint64(0x9E3779B97F4A7C15)
# (shortest test string of a class, bytes of its blocks)
CLASSES = [(1, 1), (2, 2), (4, 4), (8, 4), (24, 8)]

# Fixed values of the contract: bytes of words after folding are 0-9, a-z and all above ASCII.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
WORDS_FOLDED = WORD_BYTES[FOLD]

FOUND = "spans array<struct<start:long,stop:long>>, item_ids array<string>"


def item_words(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), WORDS_FOLDED)
    folded = FOLD[raw].tobytes()
    return [folded[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]


def item_pieces(items: DataFrame, window: int) -> DataFrame:
    """item_id and folded words, joined by a space, of every item with words; long items in pieces that share window - 1 words."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
                words = item_words(text.as_py())
                cut = [b" ".join(words[i:i + PIECE_WORDS + window - 1]) for i in range(0, max(1, len(words) - window + 1), PIECE_WORDS)] if words else []
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(cut), pa.string()), pa.array(cut, pa.binary())], ["item_id", "words"])

    return map_arrow(items, tasks, "item_id string, words binary")


class Windows:
    """The test strings of a block of pieces, each once: places in `text`, and the items that hold it."""

    def __init__(self, pieces: list[tuple[str, bytes]], size: int):
        self.ids = [key for key, _ in pieces]
        self.text = b" ".join(words for _, words in pieces) + b" " * 8
        buf = np.frombuffer(self.text, np.uint8)
        off = np.concatenate([[0], np.cumsum([len(w) + 1 for _, w in pieces])]).astype(np.int64)
        starts, ends, first = word_spans(buf[:off[-1]], off, np.arange(256) != 32)
        n_words = np.diff(first)
        width = np.minimum(n_words, size)
        n = np.where(n_words > 0, n_words - width + 1, 0)
        owner = np.repeat(np.arange(len(pieces)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][owner]
        width = width[owner]
        # equal strings have equal pairs of hashes of their words
        one, two = (np.zeros(len(owner), np.uint64) for _ in range(2))
        h = hash_words(buf, starts, ends)
        for k in range(size):
            live = width > k
            one[live] = mix64(one[live] * np.uint64(0x9E3779B97F4A7C15) + h[at[live] + k])
            two[live] = mix64(two[live] * np.uint64(0xD6E8FEB86659FD93) + mix64(h[at[live] + k] + np.uint64(1)))
        order = np.lexsort((owner, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        heads = order[new]
        self.start, self.n_words = starts[at[heads]], width[heads]
        self.size = ends[at[heads] + width[heads] - 1] - self.start
        self.owner = owner[order].astype(np.int32)
        self.first = np.append(np.flatnonzero(new), len(order))

    def items(self, window: int) -> set[str]:
        return {self.ids[o] for o in self.owner[self.first[window]:self.first[window + 1]].tolist()}


class Searcher:
    """Shift table and suffix buckets for the test strings `numbers` (of similar length) of a block."""

    def __init__(self, found: Windows, numbers: np.ndarray, block: int):
        self.text, self.numbers, self.block = found.text, numbers, block
        self.start, self.size = found.start[numbers], found.size[numbers]
        self.m = int(self.size.min())
        self.mask = np.uint64((1 << 8 * block) - 1)
        self.reach = self.m - block + 1
        self.shift = np.full(1 << TABLE_BITS, min(self.reach, 65535), dtype=np.uint16)
        buf = np.frombuffer(self.text, np.uint8)
        for at in range(self.reach):
            h = self.hashes(buf, self.start + at)
            np.minimum.at(self.shift, h, np.uint16(min(self.reach - 1 - at, 65535)))
        last = self.hashes(buf, self.start + self.reach - 1)
        self.order = np.argsort(last, kind="stable")
        self.bucket = np.searchsorted(last[self.order], np.arange((1 << TABLE_BITS) + 1)).astype(np.int32)

    def hashes(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        words = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
        return ((words[at] & self.mask) * HASH >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, text: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(position, test string) of every occurrence in text[:n]; text has 8 spare bytes behind."""
        stop = n - self.m + 1
        if stop <= 0:
            return
        at = np.arange(0, stop, LANE, dtype=np.int64)
        end = np.minimum(at + LANE, stop)
        raw = text.tobytes()
        while len(at):
            h = self.hashes(text, at + self.reach - 1)
            step = self.shift[h].astype(np.int64)
            zero = step == 0
            for p, b in zip(at[zero].tolist(), h[zero].tolist(), strict=True):
                for k in self.order[self.bucket[b]:self.bucket[b + 1]].tolist():
                    start, size = self.start[k], self.size[k]
                    if raw.startswith(self.text[start:start + size], p):
                        yield p, int(self.numbers[k])
            at = at + np.maximum(step, 1)
            go = at < end
            at, end = at[go], end[go]


def build(found: Windows) -> list[Searcher]:
    limits = [c[0] for c in CLASSES] + [1 << 62]
    groups = [np.flatnonzero((found.size >= limits[i]) & (found.size < limits[i + 1])) for i in range(len(CLASSES))]
    return [Searcher(found, g, CLASSES[i][1]) for i, g in enumerate(groups) if len(g)]


def compact(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded words, each after one separator: a space, or byte 1 before a row's first word. Also where words begin."""
    lens = ends - starts
    begin = np.cumsum(lens + 1) - lens
    n = int(begin[-1] + lens[-1]) if len(lens) else 0
    out = np.full(n + 9, 32, np.uint8)
    inside = np.ones(n, dtype=bool)
    inside[begin - 1] = False
    out[:n][inside] = FOLD[buf[WORDS_FOLDED[buf]]]
    heads = first[:-1][first[:-1] < first[1:]]
    out[begin[heads] - 1] = 1
    out[n] = 1
    return out, begin


_built: dict[str, tuple] = {}


def decontaminate(docs: DataFrame, items: DataFrame, row: Column | None = None, text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row (all columns of `docs` unless given), n_words, spans of hit words [start, stop) and the items found."""
    spark = docs.sparkSession
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where(F.col("text").isNotNull())
    pieces = materialize(item_pieces(items, window), "benchmark-pieces")
    total = pieces.agg(F.sum(F.octet_length("words") + 1)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if row is None else row
    out = docs.select(row.alias("row"), F.col(text).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.expr("cast(array() as array<struct<start:long,stop:long>>)").alias("spans"),
                      F.expr("cast(array() as array<string>)").alias("item_ids"))
    for b in range(blocks):
        part = pieces.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == b)
        block = [(r[0], bytes(r[1])) for r in part.collect()]             # about block_bytes
        out = map_arrow(out, _scan(spark.sparkContext.broadcast(block), uuid.uuid4().hex, window), out.schema)
        if b + 1 < blocks:
            out = materialize(out, "decontaminate")
    return out.select("row", "n_words", "spans", "item_ids")


def _scan(shared, key: str, window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:                   # tables are built once in a worker
            _built.clear()
            found = Windows(shared.value, window)
            _built[key] = build(found), found
        searchers, found = _built[key]
        for batch in batches:
            for part, buf, off in slices(batch):
                yield _hits(part, buf, off, searchers, found)
    return scan


def _hits(part, buf, off, searchers, found: Windows) -> pa.RecordBatch:
    starts, ends, first = word_spans(buf, off, WORDS_FOLDED)
    text, begin = compact(buf, starts, ends, first)
    n = len(text) - 9
    cover = np.zeros(len(starts) + 1, np.int64)
    rows = [set(x or ()) for x in part.column("item_ids").to_pylist()]
    begins = {}
    for s in searchers:
        for p, k in s.find(text, n):
            if text[p - 1] not in (1, 32) or p == 0 or text[p + found.size[k]] not in (1, 32):
                continue                                # inside a word
            word = int(np.searchsorted(begin, p))
            cover[word] += 1
            cover[word + found.n_words[k]] -= 1
            begins.setdefault(word, []).append(k)
    for word, numbers in begins.items():
        r = int(np.searchsorted(first, word, side="right")) - 1
        for k in numbers:
            rows[r].update(found.items(k))
    hit = np.cumsum(cover[:-1]) > 0
    spans = [list(x or ()) for x in part.column("spans").to_pylist()]
    for r in np.unique(np.searchsorted(first, np.flatnonzero(hit), side="right") - 1).tolist():
        own = hit[first[r]:first[r + 1]].copy()
        for old in spans[r]:
            own[old["start"]:old["stop"]] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0]))))
        spans[r] = [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
    t = part.schema
    return pa.RecordBatch.from_arrays([
        part.column("row"), part.column("text"), pa.array(np.diff(first), pa.int64()),
        pa.array(spans, t.field("spans").type),
        pa.array([sorted(x) for x in rows], t.field("item_ids").type),
    ], names=["row", "text", "n_words", "spans", "item_ids"])


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit and the contract's contamination rule: hit words are at least a twentieth of all."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op2_wu_manber(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = judged(decontaminate(docs, read(spark, sf_dir, "benchmark"), row=F.struct("doc_id")))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"), "contaminated")
