import zlib

import brute
import corpus_pipeline as C
from pyspark.sql import functions as F
from tallyline.llm.common import materialize, read, release

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = read(spark, SF, "documents")
    again = docs.where("doc_id % 10 = 3")                      # repeated rows
    odd = docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")})
    docs = docs.unionByName(again).unionByName(odd).withColumns({"row": F.lit("x"), "spans": F.lit(1), "base": F.col("lang")})
    tables = [materialize(docs, "test-docs")]
    for i, (_, stage) in enumerate(C.STAGES):
        tables.append(materialize(stage(spark, tables[-1], SF), f"test-{i}"))
    given, quality, near, clean, redacted, packed = tables
    assert all(t.columns == given.columns for t in tables[:-1])
    text = lambda t: [(r["doc_id"], r["text"]) for r in t.select("doc_id", "text").collect()]

    failed = {d for d, t in text(given) if brute.quality(t)[-1]}
    kept = text(quality)
    assert not failed & {d for d, _ in kept} and len(kept) > 100
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert {d for d, _ in text(given)} & good - failed <= {d for d, _ in kept}     # clean documents stay

    want = {d: c for d, _, c in brute.near_components(kept)}
    assert sorted(d for d, _ in text(near)) == sorted({d for d, c in want.items() if d == c})

    items = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    assert sorted(text(clean)) == sorted((d, t) for (d, t), hit in zip(text(near), brute.contamination(text(near), items), strict=True) if not hit[-1])

    before, after = dict(text(clean)), dict(text(redacted))
    assert set(before) == set(after)
    for d, t in after.items():
        assert not [s for s in brute.base_secrets(t) if s[0] != "assign"]
        assert (t == before[d]) == ("[SECRET]" not in t)
    assert {r["doc_id"]: r["n_chars"] for r in redacted.collect()} == {d: len(t) for d, t in after.items()}

    pieces = packed.collect()
    assert {p["doc_id"] for p in pieces} == set(after)
    total = {}
    for p in pieces:
        total[p["sequence_id"]] = total.get(p["sequence_id"], 0) + p["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in total.values())
    assert sum(p["length"] for p in pieces) == sum({p["doc_id"]: p["doc_tokens"] for p in pieces}.values())
    assert zlib.crc32(bytes(pieces[0]["ids"])) >= 0
    release(spark)


def test_pipeline_of_an_empty_table(spark):
    docs = read(spark, SF, "documents").limit(0)
    for i, (_, stage) in enumerate(C.STAGES):
        docs = materialize(stage(spark, docs, SF), f"empty-{i}")
    assert docs.count() == 0
    release(spark)


def test_the_catalog_names_queries_and_sql():
    from tallyline.llm.catalog import ORACLE_SQL, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and all(map(callable, QUERIES.values()))
    assert set(ORACLE_SQL) < set(QUERIES) and all(isinstance(x, str) for x in ORACLE_SQL.values())
