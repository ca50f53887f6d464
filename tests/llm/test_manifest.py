import hashlib
import random
import zlib

import pytest

from tallyline.llm import manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, block long, digest string, pos long"


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], SCHEMA)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def climb(nodes):
    """All levels of a tree over `nodes`, and for each of them its siblings by level as (left, right)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            proofs[k].append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        at = [i // 8 for i in at]
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        rows = sorted(groups[lang], key=lambda d: (d[0] is not None, d[0], leaf(*d)))
        trees[lang] = (rows, *climb([leaf(*d) for d in rows]))
    root, over = climb([trees[x][1] for x in order]) if order else (None, [])
    out = []
    for lang, above in zip(order, over, strict=True):
        rows, subroot, proofs = trees[lang]
        for d, proof in zip(rows, proofs, strict=True):
            text = d[1]
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            x = leaf(d[0], text, *d[2:])
            for left, right in proof + above:
                x = h(left, x, right)
            out.append((d[0], leaf(*d), subroot, root, h(*[a + b for a, b in proof + above]), x, x == root))
    return out


def docs(sizes, seed=2):
    r = random.Random(seed)
    langs = [None, "", "en", "de", "é", "zz", "日本"] + [f"l{k}" for k in range(30)]
    out, n = [], 0
    for lang, size in zip(langs, sizes, strict=False):
        for _ in range(size):
            text = r.choice([None, "", "Words And été", "plain", "X" * 50_000, "a\tb\n"])
            out.append((n, text, lang, r.choice([None, "web", ""]), r.choice([None, 3, 10**12])))
            n += 1
    r.shuffle(out)
    return out


CASES = [docs([1]), docs([0, 0, 2]), docs([1, 1, 1]), docs([7, 8, 9, 64, 65, 1, 0]), docs([3, 0, 530, 73]), docs([2] * 20),
         docs([5, 20]) + [(3, "again", None, "web", 1), (3, "again", None, "web", 1), (None, "no ID", "en", None, None), (None, None, None, None, None)]]
key = lambda x: tuple((v is None, v) for v in x)


def columns(df):
    return df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (df.folded_root == df.root).alias("verified"))


@pytest.mark.parametrize("data", CASES)
@pytest.mark.parametrize("height", [1, 4])
def test_manifest_equals_brute_force(spark, data, height):
    got = columns(M.manifest(frame(spark, data), height=height)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(data), key=key)
    assert any(not r["verified"] for r in got) or len(data) < 10


def test_proofs_lead_to_the_root(spark):
    data = docs([0, 0, 100, 9])
    for r in M.manifest(frame(spark, data)).collect():
        x = r["leaf"]
        for s in r["proof"]:
            x = h(s["l"], x, s["r"])
        assert x == r["root"]


def test_empty_table_has_no_rows(spark):
    assert M.manifest(frame(spark, [])).collect() == []


def test_the_same_root_for_any_order_and_partitioning(spark):
    data = docs([4, 0, 90])
    roots = {M.manifest(frame(spark, d).repartition(n)).first()["root"] for d, n in ((data, 1), (data[::-1], 7))}
    assert len(roots) == 1


def test_query_equals_sql(spark, tmp_path):
    import duckdb

    data = [d for d in CASES[6] if d[0] is not None]
    frame(spark, data).select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.execute(M.ORACLE_SQL)
    names = [d[0] for d in rel.description]
    assert sorted(map(tuple, M.op11_time_forward(spark, str(tmp_path)).select(*names).collect())) == sorted(rel.fetchall())
