"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Each document becomes token ids plus an end id. A piece of n tokens costs
``linear * n + quadratic * n * n`` (projections and feed-forward layers grow
with n, attention inside the piece with its square). Documents are taken in
descending cost; each goes to the sequence of lowest cost that has room for it,
and is cut only where no sequence has. Sequences are kept in a heap per room
left, with a tree of minima over the rooms.

Packing works inside blocks of about `block_tokens` tokens of one task, so it
needs no shuffle, no driver and bounded memory. The sequences of a block are
opened with capacities that add up to its tokens exactly: full ones, and for
the rest (less than one sequence) the powers of two that sum to it. So nothing
is padded.

Defined cases: a null text is empty and yields the end id alone; a null or
repeated doc_id is carried as it is; an empty table yields no rows; other
columns of the input are ignored. Sequence ids are unique in a result and the
same when a task is repeated: task number and a running number.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, read

CAPACITY = 1024
END_ID = 0
BLOCK_TOKENS = 1 << 21
SEQUENCE_BITS = 33
CACHE_UNITS = 300_000
CACHE_UNIT_CHARS = 64

PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes.

    Units that start at a single space and hold no other one never share a
    token with their neighbours under the vocabulary's splitting pattern, so
    ids are kept per unit. Texts where that does not hold (runs of spaces, a
    space at an end) and texts with a special token's string are encoded whole.
    """

    def __init__(self, tokenizer_json: str, ranks_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(tokenizer_json)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.units: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return self._plain(text)
        first, *rest = text.split(" ")
        units, out = self.units, [self._plain(first)]
        for word in rest:
            ids = units.get(word)
            if ids is None:
                ids = self._plain(" " + word)
                if len(word) <= CACHE_UNIT_CHARS:
                    if len(units) >= CACHE_UNITS:
                        units.clear()
                    units[word] = ids
            out.append(ids)
        return b"".join(out)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(files: tuple[str, str]) -> Encoder:
    if files not in _encoders:
        _encoders[files] = Encoder(*files)
    return _encoders[files]


def capacities(total: int, capacity: int) -> list[int]:
    """Sequence lengths that add up to `total`: full ones, then the powers of two of the rest."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if rest >> b & 1]


def pack(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; all sequences end exactly full."""
    cost = lambda n: linear * n + quadratic * n * n
    size = capacities(sum(lengths), capacity)
    used = [0] * len(size)
    none = (float("inf"), -1)
    rooms: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    half = 1 << capacity.bit_length()
    least = [none] * (2 * half)

    def settle(room: int) -> None:
        i = half + room
        least[i] = rooms[room][0] if rooms[room] else none
        while i > 1:
            i >>= 1
            least[i] = min(least[2 * i], least[2 * i + 1])

    def cheapest(room: int) -> tuple[float, int]:
        """The cheapest sequence with at least so much room."""
        i, stop, best = half + room, 2 * half, none
        while i < stop:
            if i & 1:
                best = min(best, least[i])
                i += 1
            i, stop = i >> 1, stop >> 1
        return best

    for s, n in enumerate(size):
        rooms[n].append((0.0, s))
    for n in set(size):
        settle(n)
    pieces = []
    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, left = 0, lengths[d]
        while left:
            want = min(left, capacity)
            c, s = cheapest(want)
            if s < 0:                            # no room in one place: cut, the cheapest takes what it can
                c, s = cheapest(1)
            room = size[s] - used[s]
            heapq.heappop(rooms[room])
            settle(room)
            n = min(want, room)
            pieces.append((d, start, n, s, used[s]))
            used[s] += n
            start, left = start + n, left - n
            if used[s] < size[s]:
                heapq.heappush(rooms[room - n], (c + cost(n), s))
                settle(room - n)
    return pieces


def pack_documents(docs: DataFrame, files: tuple[str, str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   linear: float = 1.0, quadratic: float = 1.0 / CAPACITY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents (doc_id, text): their ids (little-endian 32-bit), place in the document and in a sequence."""
    files = files or default_files()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(files)
        end = np.array([end_id], dtype="<u4").tobytes()
        base, n_sequences = TaskContext.get().partitionId() << SEQUENCE_BITS, 0
        ids: list[bytes] = []
        keys: list[int | None] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, keys, held, n_sequences
            lengths = [len(x) // 4 for x in ids]
            pieces = pack(lengths, capacity, linear, quadratic)
            for i in range(0, len(pieces), 4096):
                part = pieces[i:i + 4096]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[p[0]] for p in part], pa.int64()),
                    pa.array([p[1] for p in part], pa.int64()),
                    pa.array([p[2] for p in part], pa.int64()),
                    pa.array([ids[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in part], pa.binary()),
                    pa.array([lengths[p[0]] for p in part], pa.int64()),
                    pa.array([base + n_sequences + p[3] for p in part], pa.int64()),
                    pa.array([p[4] for p in part], pa.int64()),
                ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            n_sequences += len(capacities(held, capacity))
            ids, keys, held = [], [], 0

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                x = encode(text.as_py() or "") + end
                ids.append(x)
                keys.append(key)
                held += len(x) // 4
                if held >= block_tokens:
                    yield from flush()
        if ids:
            yield from flush()

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), tasks, PIECE_SCHEMA)


def op9_cost_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
