import itertools
import random
import re

import numpy as np
import pytest

from tallyline.llm import personal_data as P
from test_scoring_and_search import frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def plain(text):
    """The contract's patterns as they stand."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    parts = ["a", "B.", "@", "@@", "x-y", ".com", "1", "25", "255", "256", ".", "..", " ", "-", "+", "+1", "(", ")", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "0.0.0.1", "é", "日本", "\n", "%", "_", "0005", "mail@host.de", "+49 30 1234567", "\x20"]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(0, 25)))
        assert P.base_spans(text) == plain(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "1 ", "+1", "+1(", "a@", "@", "a@b", "1.2.3.4 ", "x1 ", "a.b-", "+1 (303) 555-0199 "])
def test_long_texts_take_time_in_proportion(unit):
    import time

    text = unit * (400_000 // len(unit))
    t = time.perf_counter()
    base = P.base_spans(text)
    assert time.perf_counter() - t < 4
    P.Graph(text, base)
    assert time.perf_counter() - t < 12


def enumerate_marginals(own, edges, tables):
    n, k = own.shape
    out = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(own[i, v] for i, v in enumerate(y)) + sum(tables[t][y[a], y[b]] for a, b, t in edges))
        for i, v in enumerate(y):
            out[i, v] += w
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(5))
def test_messages_are_exact_on_forests(seed):
    g = np.random.default_rng(seed)
    n, k = 6, 3
    own, tables = g.normal(size=(n, k)), g.normal(size=(2, k, k))
    edges = [(int(g.integers(0, i)), i, int(g.integers(0, 2))) for i in range(1, n) if i != 4]
    a, b, t = (np.array(x) for x in zip(*edges, strict=True))
    got = P.marginals(own, a, b, t, tables, rounds=200)
    assert np.allclose(got, enumerate_marginals(own, edges, tables), atol=1e-5)


def test_messages_on_loops_are_near_and_agree_with_single_updates():
    g = np.random.default_rng(9)
    n, k = 6, 3
    own, tables = g.normal(size=(n, k)), 0.3 * g.normal(size=(2, k, k))
    edges = [(0, 1, 0), (1, 2, 0), (2, 3, 0), (3, 4, 0), (4, 5, 0), (0, 3, 1), (1, 5, 1), (2, 5, 1)]
    a, b, t = (np.array(x) for x in zip(*edges, strict=True))
    got = P.marginals(own, a, b, t, tables, rounds=300)
    assert np.abs(got - enumerate_marginals(own, edges, tables)).max() < 0.02
    msg = {(x, y): np.ones(k) for i, j, _ in edges for x, y in ((i, j), (j, i))}
    pair = {(i, j): tables[t] for i, j, t in edges} | {(j, i): tables[t].T for i, j, t in edges}
    for _ in range(300):
        for i, j in msg:
            m = np.exp(own[i])
            for (x, y), v in msg.items():
                if y == i and x != j:
                    m = m * v
            m = m @ np.exp(pair[i, j])
            msg[i, j] = m / m.sum()
    for i in range(n):
        p = np.exp(own[i])
        for (_x, y), v in msg.items():
            if y == i:
                p = p * v
        assert np.allclose(got[i], p / p.sum(), atol=1e-4)


def corpus(seed=3, n=300):
    """Documents whose personal data the patterns mostly find, and plain numbers."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 8)))
    def card():
        while True:
            d = "".join(r.choices("0123456789", k=16))
            if luhn(d):
                return d
    made = [lambda: f"{word()}.{r.randint(10, 99)}@{word()}.example.com", lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
            lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), card, lambda: str(r.randint(1, 9999)), lambda: str(r.randint(1900, 2030)) + "."]
    out = []
    for k in range(n):
        items = [r.choice(made)() for _ in range(3)]
        items += [items[0]] if k % 3 == 0 else []
        out.append((k, " ".join(" ".join([word() for _ in range(r.randint(3, 9))] + [x]) for x in items) + " " + word()))
    return out


def test_links_decide_and_plain_texts_stay_clean(spark):
    phone, name = "+1 (303) 555-0147", "quixby.77"
    extra = [(900, f"mail {name}@host.example.com now. some more words here, then {name.upper()} wrote again"),
             (901, f"the name {name} alone"), (902, "in 1998 we had 25 of 300 items, 7 left"), (903, f"call {phone} or later 555-0147 there"),
             (904, "no digits at all"), (905, None), (906, ""), (None, f"call {phone}"), (907, "word " * 60_000 + phone),
             (908, f"host 10.1.2.3 and {phone} {phone}"), (909, extra_card := "number 4929123412341234 twice 4929 1234 1234 1234"), (910, extra_card)]
    docs = corpus() + extra
    rows = {r["doc_id"]: r for r in P.find(frame(spark, docs)).collect()}
    assert len(rows) == len(docs)
    texts = dict(docs)
    def added(d):
        base = {(s["kind"], s["start"], s["stop"]) for s in rows[d]["base"]}
        return [(s["kind"], texts[d][s["start"]:s["stop"]]) for s in rows[d]["spans"] if (s["kind"], s["start"], s["stop"]) not in base]
    for d, text in docs:
        assert [(P.KINDS.index(s["kind"]), s["start"], s["stop"]) for s in rows[d]["base"]] == plain(text or "")
        assert {(s["kind"], s["start"], s["stop"]) for s in rows[d]["base"]} <= {(s["kind"], s["start"], s["stop"]) for s in rows[d]["spans"]}
    assert added(900) == [("email", name.upper())] and added(901) == []          # the same token without its address is none
    assert added(902) == [] == added(904) == added(905) == added(906) == added(907)
    assert added(903) == [("phone", "555-0147")]
    assert ("card", "4929123412341234") in added(909) and added(909) == added(910)
    plain_numbers = [d for d, t in corpus() if re.search(r"\b\d{1,4}\.?(\s|$)", t)]
    assert not any(k for d in plain_numbers for k, w in added(d) if len(w) <= 5)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "call 5 of 7"), (2, "x")]])
def test_without_base_spans_nothing_is_added(spark, docs):
    got = P.find(frame(spark, docs)).collect()
    assert len(got) == len(docs) and all(r["spans"] == [] for r in got)


def test_query_columns(spark, tmp_path):
    import hashlib

    docs = corpus(n=40) + [(500, None)]
    frame(spark, docs).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    for r in P.op12_skip_chain(spark, str(tmp_path)).collect():
        base = plain(dict(docs)[r["doc_id"]] or "")
        text = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == i for x in base) for i in range(4)]
