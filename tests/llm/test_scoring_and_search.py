import math
import random

import numpy as np
import pytest

import brute
from tallyline.llm import decontaminate as D
from tallyline.llm import lattice as L

DOCS = "doc_id long, text string, row string, chunk long, spans string"


def frame(spark, docs):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", 7, "y") for d, t in docs], DOCS)


def sample(seed=1, n=60):
    r = random.Random(seed)
    words = ["the", "of", "and", "Straße", "été", "x1", "token-piece", "A", "b,c", "日本"] + [f"w{k}" for k in range(40)]
    docs = [(k, " ".join(r.choices(words, k=r.randint(0, 80)))) for k in range(n)]
    return docs + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, docs[3][1]), (None, "no id"), (1004, "z" * 5000), (1005, "long " * 20000)]


def test_base_score_and_fold(spark):
    docs = sample()
    want = brute.unigram_base(docs)
    got = {r["doc_id"]: r for r in L.score_documents(frame(spark, docs)).collect()}
    assert set(got) == set(want)
    for d, (held, n, known, total, base) in want.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_lattice_sums_all_segmentations():
    v = L.vocabulary(L.ranks_file())
    scores = L.first_scores(v)
    number = {p: k for k, p in enumerate(v.pieces)}

    def every(w):
        if not w:
            return 1.0
        return sum(math.exp(scores[number[w[:k]]]) * every(w[k:]) for k in range(1, len(w) + 1) if w[:k] in number)

    words = [b" the", b" thinking", " été".encode(), b" a", b" zzqx9"]
    got = L.path_scores(v, scores, words)
    assert got == pytest.approx([math.log(every(w)) for w in words])
    # the loop for long words agrees with the grouped recursion, also in its expected counts
    a, b = np.zeros(len(scores)), np.zeros(len(scores))
    L.path_scores(v, scores, [b" thinking"], a, np.ones(1))
    L._long_forward(v, scores, b" thinking", b, 1.0)
    assert np.allclose(a, b) and a.sum() > 1


def test_word_and_end_probabilities_sum_to_one():
    """Over a closed vocabulary of pieces the paths of all words sum to one: one first piece, any others after it."""
    first, other = 0.3, 0.7          # share of pieces that start with a space, and of those that do not
    assert first * sum(other ** k for k in range(200)) == pytest.approx(1.0)


def test_held_out_texts_are_not_learnt_from(spark):
    import zlib
    held = next(d for d in range(50) if zlib.crc32(str(d).encode()) % 5 == 1)
    seen = [d for d in range(50) if zlib.crc32(str(d).encode()) % 5 != 1][:5]
    docs = [(d, "common words here") for d in seen] + [(held, "unseen words here")]
    r = {x["doc_id"]: x for x in L.score_documents(frame(spark, docs)).collect()}
    assert r[held]["n_known"] == 3 and r[held]["train_tokens"] == 20      # words, here, end
    assert r[held]["score"] < r[seen[0]]["score"]


@pytest.mark.parametrize("docs", [[], [(1, None)]])
def test_scores_of_empty_tables(spark, docs):
    assert L.score_documents(frame(spark, docs)).count() == len(docs)


def segmentations(word, number):
    if not word:
        yield []
    for j in range(1, len(word) + 1):
        if (k := number.get(word[:j])) is not None:
            for rest in segmentations(word[j:], number):
                yield [k, *rest]


def test_expected_counts_equal_enumeration():
    v = L.vocabulary(L.ranks_file())
    scores = L.first_scores(v)
    words = [b" the", b" token", b" straight", "\u00e9t\u00e9".encode(), b" aaaaaaa", b"q", b" unhappy", b" the"]
    weights = np.array([1.0, 2.0, 1.0, 3.0, 1.0, 1.0, 0.5, 1.0])
    counts = np.zeros(len(v.pieces))
    got = L.path_scores(v, scores, words, counts, weights)
    want = np.zeros(len(v.pieces))
    for w, weight, score in zip(words, weights, got, strict=True):
        paths = list(segmentations(w, v.number))
        p = np.array([math.exp(sum(scores[k] for k in path)) for path in paths])
        assert score == pytest.approx(math.log(p.sum()))
        for path, x in zip(paths, p / p.sum(), strict=True):
            for k in path:
                want[k] += weight * x
    assert np.allclose(counts, want, atol=1e-9)


def test_every_piece_counts_however_long():
    v = L.vocabulary(L.ranks_file())
    scores = L.first_scores(v)
    longest = [p for p in v.pieces if len(p) > L.HALVES]
    assert len(v.pieces) == 50_256 and len(longest) == 72

    def plain(word):
        alpha = [0.0] + [-math.inf] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(j):
                if (k := v.number.get(word[i:j])) is not None:
                    alpha[j] = np.logaddexp(alpha[j], alpha[i] + scores[k])
        return alpha[-1]

    words = [*longest, b" telecommunicationsx", b"un" + b" unconstitutional", b"-" * 40, b"-" * 64, b"=" * 100, b" ab" + longest[0] * 2]
    got = L.path_scores(v, scores, words)
    assert np.allclose(got, [plain(w) for w in words])
    counts = np.zeros(len(v.pieces))
    L.path_scores(v, scores, longest, counts, np.ones(len(longest)))
    assert all(counts[v.number[p]] > 0.5 for p in longest)


def items_and_docs(seed=2):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["Ünï", "X9"]
    items = [(k, " ".join(r.choices(words, k=r.randint(14, 40)))) for k in range(12)]
    items += [(50, "Two words"), (51, None), (52, "..."), (50, "two  WORDS"), (53, "w1"[:1] + "q")]
    docs = []
    for k in range(40):
        w = r.choices(words, k=r.randint(0, 120))
        if k % 3 == 0:
            x = r.choice(items[:12])[1].upper().split()
            at = r.randint(0, len(w))
            w[at:at] = x[r.randint(0, 1):][:r.randint(10, 20)]
        docs.append((k, ", ".join(w)))
    return items, docs + [(100, None), (101, ""), (102, "say two words twice: two\nwords"), (103, docs[0][1]), (None, "wq"), (104, "two wordsy")]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 600])
def test_wu_manber_equals_brute_force(spark, block_bytes):
    items, docs = items_and_docs()
    table = spark.createDataFrame(items, "item_id long, text string")
    found = D.judged(D.decontaminate(frame(spark, docs), table, block_bytes=block_bytes))
    got = sorted(((r["row"]["doc_id"], r["n_words"], r["n_hit"], sorted(r["item_ids"]), r["contaminated"]) for r in found.collect()), key=str)
    assert got == sorted(brute.contamination(docs, items), key=str)
    assert found.first()["row"]["spans"] == "y"


def test_search_over_lane_borders():
    pattern = b"alpha beta gamma delta epsilon zeta"
    windows = D.Windows([("1", pattern), ("2", b"beta")], 13)
    string = lambda k: windows.text[windows.start[k]:windows.start[k] + windows.size[k]]
    for gap in (0, 1, D.LANE - 20, D.LANE - 1, 3 * D.LANE + 5):
        raw = b"\x01" + b"x" * gap + b" " + pattern + b"\x01"
        text = np.frombuffer(raw + bytes(9), np.uint8)
        found = {(p, string(k)) for x in D.build(windows) for p, k in x.find(text, len(raw))}
        assert found == {(gap + 2, pattern), (gap + 8, b"beta")}


def test_windows_are_places_in_the_block(spark):
    """Equal strings of several items are one, and a window costs bytes in proportion to nothing but its number."""
    import pickle

    r = random.Random(2)
    words = [" ".join(r.choices([f"w{k}" for k in range(30)], k=r.randint(1, 60))).encode() for _ in range(50)]
    pieces = [(str(k), w) for k, w in enumerate([*words, words[0], words[3] + b" " + words[0]])]
    got = D.Windows(pieces, 13)
    want = {}
    for key, w in pieces:
        w = w.split()
        for i in range(max(1, len(w) - 12)):
            want.setdefault(b" ".join(w[i:i + 13]), set()).add(key)
    assert {got.text[a:a + n]: got.items(k) for k, (a, n) in enumerate(zip(got.start, got.size, strict=True))} == want
    assert (got.n_words == [got.text[a:a + n].count(b" ") + 1 for a, n in zip(got.start, got.size, strict=True)]).all()
    big = D.Windows([("x", " ".join(f"word{k}" for k in range(100_000)).encode())], 13)
    assert len(pickle.dumps(big)) < len(big.text) + 50 * len(big.start)


def test_long_items_are_cut_into_pieces_without_loss(spark, monkeypatch):
    monkeypatch.setattr(D, "PIECE_WORDS", 40)
    items, docs = items_and_docs()
    items.append((77, " ".join(f"long{k}" for k in range(400))))
    docs.append((500, "x " + " ".join(f"long{k}" for k in range(30, 160)) + " y"))
    table = spark.createDataFrame(items, "item_id long, text string")
    pieces = D.item_pieces(table.selectExpr("string(item_id) AS item_id", "text").where("text is not null"), 13).collect()
    assert sum(r["item_id"] == "77" for r in pieces) == 10
    found = D.judged(D.decontaminate(frame(spark, docs), table, block_bytes=2000))
    got = sorted(((r["row"]["doc_id"], r["n_words"], r["n_hit"], sorted(r["item_ids"]), r["contaminated"]) for r in found.collect()), key=str)
    assert got == sorted(brute.contamination(docs, items), key=str)


def test_decontamination_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(frame(spark, []), items).count() == 0
    assert D.judged(D.decontaminate(frame(spark, [(1, "a b")]), items)).first()["n_hit"] == 0
