"""Document likelihood over all segmentations into the pieces of a public vocabulary.

A text is its words, each with a space before it, and one end symbol. The
pieces are the byte strings of an existing subword vocabulary; every way to cut
a word into pieces counts, weighted by the pieces' unigram scores, and the
forward recursion in log space sums them all. Piece scores start from the
vocabulary's order (a piece's rank) and are set by `rounds` of expected counts,
forward and backward over the distinct words of the training texts (each once,
as the paths are there to spell words that were not seen).

A word seen in training has one more edge in its lattice, which spans it whole,
with its count as weight against `V` (number of distinct training tokens) for
the paths through pieces: P(w) = (c(w) + V * paths(w)) / (N + V + 1), and the
end symbol has (c(end) + 1) / (N + V + 1). Only a word's first piece starts
with a space, so paths(w) sums to one over all words, and so do the
probabilities of all words and the end; an unseen word is spelt.

How the work is spread: texts are cut into chunks of bounded size inside their
tasks; a chunk becomes one row of words as numbers (by document) and one row
per distinct word. Word rows are counted and scored by word and come back to
their chunk, where documents are summed up. No text is shuffled and no count
table is sent to every task; the piece scores (bounded by the vocabulary) are.

Defined cases: a null text has the end symbol only; a null doc_id is trained
on; repeated documents count as often as they occur; an empty table yields no
rows; a table without training texts scores by pieces alone; other columns are
ignored.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import discard, map_arrow, materialize, read

CHUNK_BYTES = 16 << 20
CHUNK_BITS = 33
HALVES = 16          # bytes of a piece that two 64-bit halves hold; longer ones are few and looked up where one's first half occurs
WORDS_A_TASK = 100_000
WORDS_AT_ONCE = 50_000
WIDE = 40
ROUNDS = 2
GROUP = 4096
FOLDS, HELD_OUT = 5, 1
NONE = -1e30


def ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Vocabulary:
    """All pieces, those of at most HALVES bytes with a lookup by two 64-bit halves; all single bytes are among them."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.pieces = [base64.b64decode(line.split()[0]) for line in f]
        self.number = {p: k for k, p in enumerate(self.pieces)}
        self.short = np.array([k for k, p in enumerate(self.pieces) if len(p) <= HALVES])
        self.lengths = sorted({len(p) for p in self.pieces})
        self.long = [n for n in self.lengths if n > HALVES]
        self.heads = np.unique(np.frombuffer(b"".join(p[:8] for p in self.pieces if len(p) > HALVES), "<u8"))
        short = [self.pieces[k] for k in self.short]
        self.bits = (len(short) - 1).bit_length() + 3
        self.slots = np.full(1 << self.bits, -1, np.int32)
        padded = np.frombuffer(b"".join(p.ljust(HALVES, b"\0") for p in short), "<u8").reshape(-1, 2)
        self.size = np.array([len(p) for p in short], np.uint64)
        self.lo, self.hi = padded[:, 0].copy(), padded[:, 1].copy()
        home = self.home(self.lo, self.hi, self.size)
        self.probes = 0
        left = np.arange(len(short))
        while len(left):                       # linear probing, one step for all that have no slot
            at = (home[left] + self.probes) & ((1 << self.bits) - 1)
            free = self.slots[at] < 0
            order, first = np.unique(at[free], return_index=True)
            self.slots[order] = left[free][first]
            left = left[self.slots[at] != left]
            self.probes += 1

    def home(self, lo, hi, size):
        h = (lo ^ (hi * np.uint64(0x9E3779B97F4A7C15)) ^ (size << np.uint64(57))) * np.uint64(0xFF51AFD7ED558CCD)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, lo, hi, size):
        """Piece number of each byte string (two halves, length), or -1."""
        out = np.full(len(lo), -1, np.int32)
        home, todo = self.home(lo, hi, size), np.arange(len(lo))
        for k in range(self.probes):
            at = self.slots[(home[todo] + k) & ((1 << self.bits) - 1)]
            hit = (at >= 0) & (self.lo[at] == lo[todo]) & (self.hi[at] == hi[todo]) & (self.size[at] == size[todo])
            out[todo[hit]] = self.short[at[hit]]
            todo = todo[~hit & (at >= 0)]
            if not len(todo):
                break
        return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def first_scores(v: Vocabulary) -> np.ndarray:
    """Natural log scores by rank, 1 / (rank + 10), summing to one."""
    w = 1.0 / (np.arange(len(v.pieces)) + 10.0)
    return np.log(w / w.sum())


def _edges(v: Vocabulary, words: list[bytes], length: int):
    """Piece number of words[:, i:j] for all i < j that are a piece in some word, as a dict (i, j) -> array."""
    raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length).astype(np.uint64)
    out = {}
    for i in range(length):
        lo, hi = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
        for j in range(i + 1, min(length, i + HALVES) + 1):
            k = j - i - 1
            if k < 8:
                lo = lo | (raw[:, j - 1] << np.uint64(8 * k))
            else:
                hi = hi | (raw[:, j - 1] << np.uint64(8 * (k - 8)))
            ids = v.find(lo, hi, np.full(len(words), k + 1, np.uint64))
            if (ids >= 0).any():
                out[i, j] = ids
        if length - i > HALVES:
            head = v.heads[np.minimum(np.searchsorted(v.heads, lo), len(v.heads) - 1)] == lo
            for k in np.flatnonzero(head).tolist():
                for n in v.long:
                    if n <= length - i and (number := v.number.get(words[k][i:i + n])) is not None:
                        out.setdefault((i, i + n), np.full(len(words), -1, np.int32))[k] = number
    return out


def _forward(edges: dict, length: int, n: int, scores: np.ndarray) -> np.ndarray:
    """alpha[j]: log probability of the first j bytes over all segmentations."""
    into = defaultdict(list)
    for (i, j), ids in edges.items():
        into[j].append((i, ids))
    none = scores.dtype.type(NONE)
    alpha = np.full((length + 1, n), none)
    alpha[0] = 0.0
    for j in range(1, length + 1):
        terms = np.stack([np.where(ids >= 0, alpha[i] + scores[ids], none) for i, ids in into[j]])
        top = terms.max(axis=0)
        alpha[j] = top + np.log(np.exp(terms - top).sum(axis=0))
    return alpha


def _backward(edges: dict, length: int, n: int, scores: np.ndarray) -> np.ndarray:
    out_of = defaultdict(list)
    for (i, j), ids in edges.items():
        out_of[i].append((j, ids))
    none = scores.dtype.type(NONE)
    beta = np.full((length + 1, n), none)
    beta[length] = 0.0
    for i in range(length - 1, -1, -1):
        terms = np.stack([np.where(ids >= 0, beta[j] + scores[ids], none) for j, ids in out_of[i]])
        top = terms.max(axis=0)
        beta[i] = top + np.log(np.exp(terms - top).sum(axis=0))
    return beta


def _long_forward(v: Vocabulary, scores: np.ndarray, word: bytes, counts: np.ndarray | None, weight: float) -> float:
    """One long word: the recursion in a loop over its bytes, memory in proportion to its length."""
    number, lengths = v.number, v.lengths
    n = len(word)
    alpha = [0.0] + [NONE] * n
    into = []
    for j in range(1, n + 1):
        terms = [(j - m, k) for m in lengths if m <= j and (k := number.get(word[j - m:j])) is not None]
        values = [alpha[i] + scores[k] for i, k in terms]
        top = max(values)
        alpha[j] = top + math.log(sum(math.exp(x - top) for x in values))
        if counts is not None:
            into.append(terms)
    if counts is not None:
        beta = [NONE] * n + [0.0]
        for j in range(n, 0, -1):             # beta of j is complete: all its successors were handled
            for i, k in into[j - 1]:
                x = scores[k] + beta[j]
                m = max(beta[i], x)
                beta[i] = m + math.log(math.exp(beta[i] - m) + math.exp(x - m))
                counts[k] += weight * math.exp(alpha[i] + x - alpha[n])
    return alpha[n]


def path_scores(v: Vocabulary, scores: np.ndarray, words: list[bytes], counts: np.ndarray | None = None,
                weights: np.ndarray | None = None) -> np.ndarray:
    """Natural log of the sum over all segmentations of each word; adds expected piece counts to `counts`."""
    out = np.empty(len(words))
    by_length = defaultdict(list)
    for k, w in enumerate(words):
        by_length[len(w)].append(k)
    for length, at in by_length.items():
        if length > WIDE:
            for k in at:
                out[k] = _long_forward(v, scores, words[k], counts, 1.0 if weights is None else float(weights[k]))
            continue
        for g in range(0, len(at), GROUP):
            part = at[g:g + GROUP]
            edges = _edges(v, [words[k] for k in part], length)
            alpha = _forward(edges, length, len(part), scores)
            out[part] = alpha[length]
            if counts is not None:
                beta = _backward(edges, length, len(part), scores)
                for (i, j), ids in edges.items():
                    ok = ids >= 0
                    p = np.exp(alpha[i][ok] + scores[ids[ok]] + beta[j][ok] - alpha[length][ok])
                    counts += np.bincount(ids[ok], p * weights[part][ok], minlength=len(counts))
    return out


def held_out(doc_id: int | None) -> bool:
    """Remainder 1 of the crc32 of the id as text; a null id is not held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


ROWS = "chunk long, word binary, number int, train long, docs binary, tokens binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a chunk's documents (docs, tokens), and its distinct words with their training counts."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_chunks = 0
        base = TaskContext.get().partitionId() << CHUNK_BITS
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, held, size, n_chunks
            chunk = base + n_chunks
            lens = np.array([len(x) for x in held], np.int64)
            tokens = np.concatenate(held)
            out = np.array([held_out(i) for i in ids], bool)
            train = np.bincount(tokens[~np.repeat(out, lens)], minlength=len(number))
            about = np.zeros(len(ids), [("id", "<i8"), ("null", "?"), ("out", "?"), ("n", "<i8")])
            about["id"], about["null"] = [i or 0 for i in ids], [i is None for i in ids]
            about["out"], about["n"] = out, lens
            names = ["chunk", "word", "number", "train", "docs", "tokens"]
            nothing = lambda kind: pa.array([None], kind)
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk]), nothing(pa.binary()), nothing(pa.int32()), nothing(pa.int64()),
                pa.array([about.tobytes()], pa.binary()), pa.array([tokens.astype("<i4").tobytes()], pa.binary())], names)
            words = list(number)
            for i in range(0, len(words), 1 << 16):
                part = words[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), chunk)), pa.array(part, pa.binary()), pa.array(np.arange(i, i + len(part), dtype=np.int32)),
                    pa.array(train[i:i + len(part)].astype(np.int64)), pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.binary())], names)
            number.clear()
            number.default_factory = number.__len__
            ids, held, size, n_chunks = [], [], 0, n_chunks + 1

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = (text.as_py() or "").encode().lower()
                held.append(np.fromiter(map(number.__getitem__, raw.split()), np.int32))
                ids.append(key)
                size += len(raw) + 64
                if size >= CHUNK_BYTES:
                    yield from flush()
        if ids:
            yield from flush()

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), tasks, ROWS)


def _spread(words: DataFrame, n: int) -> DataFrame:
    """The words over tasks by their number: a word costs far more than reading its few bytes."""
    return words.repartition(max(1, -(-n // WORDS_A_TASK)), "word")


def _many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to WORDS_AT_ONCE rows or more: numpy then works on many words of one length in a step."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= WORDS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _expected(words: DataFrame, path: str, scores: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over the distinct training words; one partial row set per task."""
    shared = words.sparkSession.sparkContext.broadcast(scores.astype(np.float32))     # counts need no more

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        counts = np.zeros(len(v.pieces))
        for b in _many(batches):
            w = [b" " + x for x in b.column("word").to_pylist()]
            path_scores(v, shared.value, w, counts, np.ones(len(w)))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["piece", "n"])

    out = np.zeros(len(scores))
    for r in map_arrow(words, tasks, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        out[r["piece"]] = r["n"]
    return out


def score_documents(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Per document: tokens, known tokens, the add-half unigram base and the lattice score (log10 probabilities)."""
    path = path or ranks_file()
    spark = docs.sparkSession
    rows = materialize(_chunks(docs), "lattice-chunks")
    uses = rows.where("word is not null").select("chunk", "word", "number", "train")
    counts = materialize(uses.groupBy("word").agg(F.sum("train").alias("c")), "lattice-counts")
    known = counts.where("c > 0").agg(F.count("*"), F.sum("c")).first()
    blobs = rows.where("docs is not null").select("chunk", "docs", "tokens")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for x in b.column("docs").to_pylist():
                n += int((~np.frombuffer(x, [("id", "<i8"), ("null", "?"), ("out", "?"), ("n", "<i8")])["out"]).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    c_end = map_arrow(blobs.select("docs"), ends, "n long").agg(F.sum("n")).first()[0] or 0
    total, distinct = (known[1] or 0) + c_end, known[0] + (c_end > 0)

    v = vocabulary(path)
    scores = first_scores(v)
    for _ in range(rounds if known[0] else 0):
        expected = _expected(_spread(counts.where("c > 0").select("word"), known[0]), path, scores)
        smooth = expected + expected.sum() * np.exp(first_scores(v)) * 1e-3 + 1e-9
        scores = np.log(smooth / smooth.sum())
    shared = spark.sparkContext.broadcast(scores)
    mu = float(max(1, distinct))
    p_end = (c_end + 1.0) / (total + mu + 1.0)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in _many(batches):
            c = np.asarray(b.column("c"), dtype=float)
            spelt = path_scores(v, shared.value, [b" " + x for x in b.column("word").to_pylist()])
            with np.errstate(divide="ignore"):
                p = (np.logaddexp(np.log(c), math.log(mu) + spelt) - math.log(total + mu + 1.0)) / math.log(10)
            yield from b.append_column("p", pa.array(p)).to_batches()

    weighed = materialize(map_arrow(_spread(counts, counts.count()), weigh, "word binary, c long, p double"), "lattice-weighed")
    discard(counts)
    scored = uses.select("chunk", "word", "number").join(weighed, "word").select(F.col("chunk").alias("of"), "number", "c", "p")
    base_of = lambda c: np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
    out_schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        number = np.asarray(right.column("number").combine_chunks())
        c, p = np.zeros(len(number), np.int64), np.zeros(len(number))
        c[number], p[number] = np.asarray(right.column("c").combine_chunks()), np.asarray(right.column("p").combine_chunks())
        base = base_of(c)
        for docs_, tokens in zip(left.column("docs").to_pylist(), left.column("tokens").to_pylist(), strict=True):
            about = np.frombuffer(docs_, [("id", "<i8"), ("null", "?"), ("out", "?"), ("n", "<i8")])
            at = np.frombuffer(tokens, "<i4")
            doc = np.repeat(np.arange(len(about)), about["n"])
            add = lambda x: np.bincount(doc, x[at], minlength=len(about)) if len(at) else np.zeros(len(about))  # noqa: B023, E731
            parts.append(pa.table({
                "doc_id": pa.array(about["id"], mask=about["null"]), "held_out": pa.array(about["out"]),
                "n_tokens": pa.array(about["n"] + 1), "n_known": pa.array((add((c > 0).astype(float)) + (c_end > 0)).round().astype(np.int64)),
                "base_score": pa.array(add(base) + base_of(np.array([c_end]))[0]),
                "score": pa.array(add(p) + math.log10(p_end))}))
        return pa.concat_tables(parts)

    result = blobs.groupBy("chunk").cogroup(scored.groupBy("of")).applyInArrow(sum_up, out_schema)
    return result.withColumn("train_tokens", F.lit(int(total)).cast("long"))


def op1_subword_lattice(spark, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
