import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tallyline.llm import near_duplicates as N
from tallyline.llm import repeats as R
from tallyline.llm.components import components
from test_scoring_and_search import frame


def edited(r, words, n):
    w = list(words)
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return w


def near_docs(seed=3):
    r = random.Random(seed)
    fresh = lambda n: [f"v{r.randrange(5000)}" for _ in range(n)]
    docs, base, passage = [], fresh(120), fresh(60)
    for k in range(120):                       # a large group of near copies, some too far from the rest
        docs.append(" ".join(edited(r, base, r.choice([0, 1, 2, 3, 4, 6, 9]))))
    for k in range(80):                        # texts that share a passage only
        docs.append(" ".join(fresh(100) + passage))
    for k in range(40):
        docs.append(" ".join(fresh(r.randint(1, 60))))
    docs += [docs[0].upper(), "one two", "One  TWO", "a b c d e", "a b c d e", "", " ", None, None, "w " * 3000, "w " * 4000]
    out = list(enumerate(docs))
    return out + [(5, docs[5]), (7, docs[130]), (None, docs[0]), (None, "one two")]


def test_near_duplicates_equal_brute_force(spark):
    docs = near_docs()
    got = N.near_duplicates(frame(spark, docs)).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute.near_components(docs), key=key)


@pytest.mark.parametrize("bands", [(0, 10), (0, 31), (7,)])
def test_documents_that_share_one_band_only_are_compared(spark, monkeypatch, bands):
    r = random.Random(11)
    base = [f"v{r.randrange(5000)}" for _ in range(200)]
    docs = [(k, " ".join([*base, f"own{k}"])) for k in range(40)]
    signatures = N.signatures

    def few(*args):
        own = [F.lit(-1 - b) if b in bands else F.xxhash64("doc_id", F.lit(b)) for b in range(N.BANDS)]
        return signatures(*args).withColumn("keys", F.array(*[x.cast("long") for x in own]))

    monkeypatch.setattr(N, "signatures", few)
    got = N.near_duplicates(frame(spark, docs)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 40


def edited_docs(seed):
    """A chain of edits, so most links are between documents far from any leader, and texts that share a passage."""
    r = random.Random(seed)
    fresh = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    out, now, passage = [], fresh(100), fresh(70)
    for _ in range(80):
        out.append(" ".join(now))
        for _ in range(r.choice([1, 2, 3, 4])):
            now[r.randrange(len(now))] = fresh(1)[0]
        if r.random() < 0.2:
            now = now[r.choice([0, 5, 20]):] + fresh(r.choice([0, 5, 20]))
    out += [" ".join(passage + fresh(r.randrange(0, 60))) for _ in range(60)]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_one_bucket_for_all_is_still_exact(spark, monkeypatch, seed):
    """Every document in one bucket: all links between components come from rare shingles."""
    docs = edited_docs(seed)
    signatures = N.signatures
    monkeypatch.setattr(N, "signatures", lambda *args: signatures(*args).withColumn("keys", F.array(F.lit(5).cast("long"))))
    got = N.near_duplicates(frame(spark, docs)).collect()
    want = brute.near_components(docs)
    assert sorted(map(tuple, got)) == sorted(want)
    assert 10 < len({c for _, _, c in want}) < len(docs)


def test_an_edited_group_makes_few_pairs(spark, monkeypatch):
    """Of n copies with edits of their own, far and near ones, the pairs tried grow with n, not with n * n."""
    r = random.Random(3)
    base = [f"v{k}" for k in range(150)]
    def copies(n):
        out = [" ".join(base)]
        for k in range(n):
            w = list(base)
            for i in r.sample(range(150), r.choice([2, 3, 8, 9])):
                w[i] = f"e{k}-{i}"
            out.append(" ".join(w))
        return list(enumerate(out))
    tried = []
    original = N._by_rare_shingles
    def counted(*args):
        out = original(*args)
        tried.append(out.count())
        return out
    monkeypatch.setattr(N, "_by_rare_shingles", counted)
    docs = copies(300)
    got = N.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_components(docs))
    assert tried[0] <= 2 * len(docs)


def test_signature_values_estimate_similarity():
    """Least and greatest values agree as often as the sets do, so their mean has no bias."""
    r = np.random.default_rng(5)
    errors = []
    for _ in range(40):
        pool = r.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = np.sort(pool[:300]), np.sort(pool[75:375])
        s = N.min_max(np.concatenate([a, b]), np.array([0, 300, 600]), 64)
        errors.append((s[0] == s[1]).mean() - 225 / 375)
    assert abs(np.mean(errors)) < 0.02


def test_bands_do_not_pair_a_functions_two_values():
    functions = N.BANDS * N.ROWS // 2
    column = N.band_columns(N.BANDS, N.ROWS) % functions
    assert all(len(set(column[:, b])) == N.ROWS for b in range(N.BANDS))


@pytest.mark.parametrize("docs", [[], [(1, None)], [(None, "a b c d e f")]])
def test_near_duplicates_of_empty_tables(spark, docs):
    assert N.near_duplicates(frame(spark, docs)).count() == len(docs)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert got == want


def repeat_docs(seed=4):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    passage, other = text(300), text(260)
    docs = [text(r.randint(0, 500)) for _ in range(40)]
    docs += [text(r.randint(0, 90)) + passage + text(r.randint(0, 90)) for _ in range(30)]
    docs += [text(50) + passage[40:270], text(10) + other + text(30) + other[5:], "ab" * 400, "x" * 199, "y" * 200, "z" * 201, "x" * 199]
    docs += [docs[0] + passage, docs[45], docs[45], "", None]
    return list(enumerate(docs)) + [(45, docs[45]), (None, docs[50])]


@pytest.mark.parametrize("hot", [R.HOT, 4])
def test_repeats_equal_brute_force(spark, hot):
    docs = repeat_docs()
    got = R.remove_repeats(frame(spark, docs), hot=hot).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.repeats(docs, R.LENGTH), key=str)


@pytest.mark.parametrize("hot", [1, 3])
def test_crowded_grams_are_split_until_each_collection_is_small(spark, hot):
    """One line in very many different surroundings, partly shared to its left or right, at all distances from the ends."""
    r = random.Random(31)
    text = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    line = text(90)
    lefts, rights = [text(160) for _ in range(4)], [text(160) for _ in range(4)]
    docs = []
    for k in range(70):
        a, b = r.choice(lefts)[r.randrange(0, 150):], r.choice(rights)[:r.randrange(10, 160)]
        docs.append(text(r.randrange(0, 60)) + (a if k % 3 else text(len(a))) + line + (b if k % 4 else text(len(b))) + text(r.randrange(0, 60)))
    docs = list(enumerate([*docs, docs[3], docs[9] + docs[9]]))
    got = R.remove_repeats(frame(spark, docs), hot=hot).drop("kept").collect()
    want = brute.repeats(docs, R.LENGTH)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[2] > 0 for w in want) > 20


def test_repeats_over_step_borders(spark, monkeypatch):
    r = random.Random(9)
    long = "".join(r.choice("abcdefgh") for _ in range(60_000))
    docs = [(1, long), (2, long[30_000:30_400]), (3, "q" + long[59_700:])]
    out = []
    for step in (R.STEP, 1000):
        monkeypatch.setattr(R, "STEP", step)
        buf = np.frombuffer(long.encode(), np.uint8)
        row, start, n, at, h = R.segments(buf, np.array([0, len(buf)]), R.LENGTH)
        out.append({int(s + k): int(s + a) for s, m, a in zip(start, n, at, strict=True) for k in range(m)})
    assert out[0] == out[1] and len(out[0]) == len(long) - R.LENGTH + 1
    got = R.remove_repeats(frame(spark, docs)).drop("kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute.repeats(docs, R.LENGTH))


def test_order_built_by_columns_finds_neighbours():
    texts = [b"xxabcdefgh", b"yyabcdefgz", b"zzabcdqqqq", b"ababababab"]
    at = np.array([2, 2, 2, 2])
    flags = R.build(np.array([1, 1, 1, 2]), at, texts, 6)
    assert [np.flatnonzero(f).tolist() for f in flags] == [[2, 3], [2, 3], [], []]


def test_repeats_of_empty_table(spark):
    assert R.remove_repeats(frame(spark, [])).count() == 0
