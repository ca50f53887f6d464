"""Merkle manifest of a dataset by time-forward processing.

A tree node has a label, (last leaf below it, level); in label order every node
comes after its children. A forward sweep meets the nodes in that order: each
node sends its digest to its parent through a priority queue ordered by label,
and a parent, when its label is reached, takes its children's digests from the
head of the queue. A second sweep runs through the labels in reverse: each
parent sends every child the siblings of that child followed by its own proof,
so each leaf finds its whole proof at the head of the queue.

On a cluster the labels are dealt into blocks of `fan ** height` leaves. A block
is a complete subtree, so no message leaves it but that of its top node; the
tops, one row per block, are the leaves of the next pass, and passes repeat
until each group has one node. What is external is a written table: the nodes of
a pass with their children, which the reverse sweep reads, and the tops and
proofs that go from pass to pass. Inside a block the queue holds at most
(fan - 1) * height messages forward and fan * height in reverse. Blocks are of
one size whatever the group, so a language with most rows is many tasks.

Leaves are numbered without a window over a group: they are range-partitioned
by (group, id, digest), counted per partition, and the counts added up.

Defined cases: nulls in any column are part of a leaf's text (`-`); a null
language is a group of its own, the first; rows of one doc_id stand in the order
of their digests, equal rows are leaves of their own; a null doc_id comes first
and is not tampered with; a lone leaf is its group's subroot, and if it is the
only row, the root with an empty proof; an empty table yields no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, materialize, read

FAN = 8
HEIGHT = 4                    # levels of a block
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 3

PROOF = "array<struct<l:string,r:string>>"
PROOF_TYPE = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _item(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(row: dict[str, Column]) -> Column:
    """Digest of a row: each field as its byte count and value, or `-`."""
    return F.sha2(F.concat(*[_item(row[c].cast(kind)) for c, kind in FIELDS.items()]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """g (the group's key: orders nulls first, then by bytes), doc_id, digest, tampered (null where the row is untouched)."""
    row = {c: F.col(c) for c in FIELDS}
    lang = F.col("lang").cast("string")
    touched = F.crc32(F.col("doc_id").cast("long").cast("string")) % TAMPER_EVERY == 0
    return docs.select(
        F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), lang)).alias("g"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(row).alias("digest"),
        F.when(touched, leaf_digest(row | {"text": F.translate(F.col("text"), UPPER, LOWER)})).alias("tampered"))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """`rows` (a written table) with `pos`, the place in its group from 0, and `n`, the group's size."""
    fields = rows.schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(range(at, at + b.num_rows), pa.int64())],
                [*b.schema.names, "part", "seq"])
            at += b.num_rows

    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", part int, seq long"
    placed = materialize(map_arrow(ranged, number, spec), name)
    # a row per partition and group in it
    counts = placed.groupBy(group, "part").agg(F.min("seq").alias("lo"), F.count("*").alias("k"))
    w = Window.partitionBy(group)
    starts = materialize(counts.select(
        group, "part", (F.sum("k").over(w.orderBy("part")) - F.col("k") - F.col("lo")).alias("add"), F.sum("k").over(w).alias("n")), f"{name}-starts")
    return placed.join(starts, [group, "part"]).select(*fields.names, (F.col("seq") + F.col("add")).alias("pos"), "n")


def levels(n: int, most: int, fan: int = FAN) -> int:
    """Levels above the leaves of a tree of n leaves, `most` at most."""
    h = 0
    while n > 1 and h < most:
        n, h = -(-n // fan), h + 1
    return h


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, 1024):
            yield from b.slice(i, 1024).to_pylist()


def _tables(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


NODES = pa.schema([("g", pa.string()), ("block", pa.int64()), ("end", pa.int64()), ("level", pa.int32()),
                   ("n", pa.int64()), ("children", pa.list_(pa.string())), ("top", pa.string())])
NODES_DDL = "g string, block long, end long, level int, n long, children array<string>, top string"


def forward(rows: Iterator[dict], fan: int, height: int) -> Iterator[tuple]:
    """Nodes of all blocks from their leaves (g, block, pos, n, digest) in order; `top` is the digest of a block's top node."""
    queue: list[tuple[int, int, int, str]] = []          # (last leaf, level, slot, digest): messages to the node of that label

    def send(idx: int, level: int, n: int, d: str) -> None:
        up = idx // fan
        heapq.heappush(queue, (min((up + 1) * fan ** (level + 1), n) - 1, level + 1, idx % fan, d))

    def reach(key: tuple, n: int, before: int | None) -> Iterator[tuple]:
        """All nodes whose last leaf lies before `before` (all, if None)."""
        most = levels(n, height, fan)
        while queue and (before is None or queue[0][0] < before):
            end, level = queue[0][:2]
            children = []
            while queue and queue[0][:2] == (end, level):
                children.append(heapq.heappop(queue)[3])
            d = digest("".join(children))
            if level < most:
                send(end // fan**level, level, n, d)
            yield (*key, end, level, n, children, None if level < most else d)

    key, n = None, 0
    for r in rows:
        if (r["g"], r["block"]) != key:
            if key is not None:
                yield from reach(key, n, None)
            key, n = (r["g"], r["block"]), r["n"]
        yield from reach(key, n, r["pos"])
        if n == 1:
            yield (*key, 0, 0, n, [], r["digest"])
        else:
            send(r["pos"], 0, n, r["digest"])
    if key is not None:
        yield from reach(key, n, None)


def reverse(rows: Iterator[dict], fan: int) -> Iterator[tuple[dict, list, str]]:
    """(leaf row, proof, subroot) of all leaves. A block's rows come in reverse order of labels: the
    proof of its top (level null), then nodes (children) and leaves (level 0)."""
    queue: list[tuple[int, int, list]] = []              # (-last leaf, -level, proof): the message to the node of that label
    top, subroot = None, None
    for r in rows:
        if r["level"] is None:
            top, subroot = [(x["l"], x["r"]) for x in r["proof"]], r["subroot"]
            continue
        if top is not None:                              # the first row behind it is the block's top
            proof, top = top, None
        else:
            proof = heapq.heappop(queue)[2]
        if r["level"] == 0:
            yield r, proof, subroot
            continue
        c, level, n = r["children"], r["level"], r["n"]
        first = r["end"] // fan**level * fan
        for k in range(len(c)):
            end = min((first + k + 1) * fan ** (level - 1), n) - 1
            heapq.heappush(queue, (-end, 1 - level, [("".join(c[:k]), "".join(c[k + 1:])), *proof]))


def passes(nodes: DataFrame, largest: int, name: str, fan: int = FAN, height: int = HEIGHT) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Forward sweeps over `nodes` (g, pos, n, digest and more) until a group has one node.

    Returns per pass its leaves and the nodes above them, and the subroots (g, digest)."""
    done = []
    size = fan**height
    while True:
        at = nodes.withColumn("block", F.floor(F.col("pos") / size))
        stream = at.select("g", "block", "pos", "n", "digest").repartition("g", "block").sortWithinPartitions("g", "block", "pos")
        up = materialize(map_arrow(stream, lambda batches: _tables(forward(_rows(batches), fan, height), NODES), NODES_DDL), f"{name}-nodes")
        done.append((at, up))
        nodes = up.where("top is not null").select(
            "g", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("digest"))
        largest = -(-largest // size)
        if largest == 1:
            return done, nodes.select("g", "digest")


def _down(leaf_rows: DataFrame, up: DataFrame, tops: DataFrame, payload: list[str]) -> DataFrame:
    """The rows of a reverse sweep: proofs of the tops, nodes and leaves, dealt by block in reverse order of labels."""
    none = lambda kind, c: F.lit(None).cast(kind).alias(c)
    kinds = {f.name: f.dataType.simpleString() for f in leaf_rows.schema}
    rest = [none(kinds[c], c) for c in payload]
    a = tops.select("g", F.col("pos").alias("block"), none("long", "end"), none("int", "level"), none("long", "n"),
                    none("array<string>", "children"), "proof", "subroot", *rest)
    b = up.where("level > 0").select("g", "block", "end", "level", "n", "children", none(PROOF, "proof"), none("string", "subroot"), *rest)
    c = leaf_rows.select("g", "block", F.col("pos").alias("end"), F.lit(0).alias("level"), "n",
                         none("array<string>", "children"), none(PROOF, "proof"), none("string", "subroot"), *payload)
    return (a.unionByName(b).unionByName(c).repartition("g", "block")
            .sortWithinPartitions("g", "block", F.col("end").desc_nulls_first(), F.col("level").desc_nulls_first()))


def proofs(done: list[tuple[DataFrame, DataFrame]], tops: DataFrame, name: str, fan: int = FAN) -> DataFrame:
    """(g, pos, proof, subroot) of the nodes that entered the first of the passes `done`, but that pass is left to the caller:
    the tops of its blocks. `tops` holds the proof of each group's one node."""
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("proof", PROOF_TYPE), ("subroot", pa.string())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ((r["g"], r["end"], [{"l": a, "r": b} for a, b in p], s) for r, p, s in reverse(_rows(batches), fan))
        yield from _tables(out, schema)

    for at, up in reversed(done):
        tops = materialize(map_arrow(_down(at, up, tops, []), tasks, f"g string, pos long, proof {PROOF}, subroot string"), name)
    return tops


def manifest(docs: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (left and right siblings by level), proof_sha256 and folded_root of every row."""
    spark = docs.sparkSession
    rows = numbered(materialize(leaves(docs), "manifest-leaves"), "g", ["doc_id", "digest"], "manifest-numbered")
    rows = materialize(rows, "manifest-rows")
    largest = rows.agg(F.max("n")).first()[0]
    spec = f"doc_id long, leaf string, subroot string, root string, proof {PROOF}, proof_sha256 string, folded_root string"
    if largest is None:
        return spark.createDataFrame([], spec)
    done, subroots = passes(rows, largest, "manifest", fan, height)

    # the subroots are the leaves of one more tree
    named = materialize(subroots.select(F.lit("").alias("g"), F.col("g").alias("own"), "digest"), "manifest-subroots")
    upper = materialize(numbered(named, "g", ["own"], "manifest-groups"), "manifest-upper")
    over, roots = passes(upper, upper.agg(F.max("n")).first()[0], "manifest-root", fan, height)
    root = roots.first()["digest"]                                       # one row
    start = roots.select("g", F.lit(0).cast("long").alias("pos"), F.expr(f"cast(array() as {PROOF})").alias("proof"), F.lit(None).cast("string").alias("subroot"))
    given = proofs(over, start, "manifest-root-proofs", fan)
    tops = upper.join(given.select("pos", "proof"), "pos").select(
        F.col("own").alias("g"), F.lit(0).cast("long").alias("pos"), "proof", F.col("digest").alias("subroot"))
    tops = proofs(done[1:], materialize(tops, "manifest-group-proofs"), "manifest-proofs", fan)

    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("proof", PROOF_TYPE), ("proof_sha256", pa.string()), ("folded_root", pa.string())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for r, proof, subroot in reverse(_rows(batches), fan):
                d = r["tampered"] or r["digest"]
                for left, right in proof:
                    d = digest(left + d + right)
                yield (r["doc_id"], r["digest"], subroot, root, [{"l": a, "r": b} for a, b in proof],
                       digest("".join(a + b for a, b in proof)), d)
        yield from _tables(out(), schema)

    return map_arrow(_down(*done[0], tops, ["doc_id", "digest", "tampered"]), tasks, spec)


def op11_time_forward(spark, sf_dir: str) -> DataFrame:
    out = manifest(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree_sql(name: str, leaves_sql: str, most: int) -> list[str]:
    """Levels 0..most of the trees over `leaves_sql` (g, idx, d, n) as CTEs, with each node's siblings."""
    out = [f"{name}0 AS ({leaves_sql})"]
    for k in range(most):
        out.append(f"""{name}{k + 1} AS (SELECT g, idx // {FAN} AS idx, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d,
  (n + {FAN - 1}) // {FAN} AS n FROM {name}{k} GROUP BY g, idx // {FAN}, n)""")
        run = f"PARTITION BY g, idx // {FAN} ORDER BY idx ROWS BETWEEN"
        out.append(f"""{name}_s{k} AS (SELECT g, idx, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
    return out


def _fold_sql(name: str, start: str, most: int) -> list[str]:
    """Climb from `start` (id, g, pos, x, proof) to the top of the trees `name`."""
    out = [f"{name}_f0 AS ({start})"]
    for k in range(most):
        out.append(f"""{name}_f{k + 1} AS (SELECT f.id, f.g, f.pos, CASE WHEN s.n = 1 THEN f.x ELSE sha256(s.l || f.x || s.r) END AS x,
  CASE WHEN s.n = 1 THEN f.proof ELSE f.proof || s.l || s.r END AS proof
  FROM {name}_f{k} f JOIN {name}_s{k} s ON s.g = f.g AND s.idx = f.pos // {FAN**k})""")
    return out


def _oracle(group_levels: int = 7, root_levels: int = 3) -> str:
    """The same rows in DuckDB SQL, for up to 8^7 rows of a language and 8^3 languages."""
    def item(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(item(text if c == "text" else c) for c in FIELDS) + ")"

    crc = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""
    parts = [
        f"""raw AS (SELECT doc_id, coalesce(':' || lang, '-') AS g, {leaf("text")} AS leaf,
  CASE WHEN {crc} % {TAMPER_EVERY} = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed FROM documents)""",
        """leaves AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY g) AS n FROM raw)""",
        *_tree_sql("t", "SELECT g, pos AS idx, leaf AS d, n FROM leaves", group_levels),
        f"tops AS (SELECT g AS own, d, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM t{group_levels})",
        *_tree_sql("u", "SELECT '' AS g, idx, d, n FROM tops", root_levels),
        *_fold_sql("t", "SELECT id, g, pos, coalesce(changed, leaf) AS x, '' AS proof FROM leaves", group_levels),
        *_fold_sql("u", f"SELECT f.id, '' AS g, o.idx AS pos, f.x, f.proof FROM t_f{group_levels} f JOIN tops o ON o.own = f.g", root_levels),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT l.doc_id, l.leaf, o.d AS subroot, z.d AS root, sha256(f.proof) AS proof_sha256, f.x AS folded_root, f.x = z.d AS verified
FROM leaves l JOIN u_f{root_levels} f ON f.id = l.id JOIN tops o ON o.own = l.g CROSS JOIN u{root_levels} z"""


ORACLE_SQL = _oracle()
