import random
from collections import Counter

import pytest

from tallyline.llm import licenses as L
from test_scoring_and_search import frame


def plain(text, threshold):
    """Every unit against every template, without bounds or index."""
    out = []
    text = text or ""
    for unit, a, b in L.units(text):
        x = L.bigrams(text[a:b])
        scores = []
        for name in sorted(L.TEMPLATES):
            for t in L.TEMPLATES[name]:
                y = L.bigrams(t)
                if x and 2 * sum((x & y).values()) >= threshold * (sum(x.values()) + sum(y.values())):
                    scores.append((-2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values())), name))
        if scores:
            out.append((min(scores)[1], -min(scores)[0], unit, a, b))
    return out


def docs():
    r = random.Random(2)
    lines = [t for texts in L.TEMPLATES.values() for t in texts]
    out = []
    for k in range(60):
        w = r.choice(lines).split()
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            w[r.randrange(len(w))] = "other"
        notice = " ".join(w) if k % 3 else " ".join(w[:5]) + "\n" + " ".join(w[5:])
        out.append((k, f"some words before it\n\n{notice}\n\nand after, 日本 été"))
    return out + [(100, None), (101, ""), (102, "ALL  RIGHTS-reserved"), (103, "Licence " * 40_000), (104, "all rights"), (105, out[1][1]),
                  (None, "Released under the MIT Licence"), (106, "\n\n\n"), (107, "MIT")]


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_dice_equals_brute_force(spark, threshold):
    got = sorted(((r["row"]["doc_id"], [tuple(m) for m in r["matches"]]) for r in L.scan_licenses(frame(spark, docs()), threshold=threshold).collect()), key=str)
    want = sorted(((d, plain(t, threshold)) for d, t in docs()), key=str)
    assert [(d, [(m[0], *m[2:]) for m in x]) for d, x in got] == [(d, [(m[0], *m[2:]) for m in x]) for d, x in want]
    assert [m[1] for _, x in got for m in x] == pytest.approx([m[1] for _, x in want for m in x])
    found = dict(got)
    assert found[102][0][0] == "all-rights-reserved" and found[None][0][0] == "mit" and not found[100] and bool(found[104]) == (threshold < 0.6)


def test_notices_inside_longer_text_are_found(spark):
    mit, bsd, isc = (L.TEMPLATES[x][-1] for x in ("mit", "bsd-2-clause", "isc"))
    rows = [(1, "Copyright (c) 2020 Foo Inc. All rights reserved."), (2, "İ see this file. Licensed under the Apache License, Version 2.0."),
            (3, "int x;\n/*\n" + " * ".join(w + ("\n" if k % 9 == 8 else " ") for k, w in enumerate(mit.split())) + "*/\nint main() { return 0; }"),
            (4, "a b c " * 300 + bsd + " d e f" * 300), (5, isc + " and " + "Released under the MIT License."), (6, "nothing of the kind " * 50), (7, None)]
    got = {r["row"]["doc_id"]: r["passages"] for r in L.scan_licenses(frame(spark, rows)).collect()}
    names = {d: [p["license"] for p in x] for d, x in got.items()}
    assert names == {1: ["all-rights-reserved"], 2: ["apache-2.0"], 3: ["mit"], 4: ["bsd-2-clause"], 5: ["isc", "mit"], 6: [], 7: []}
    text = dict(rows)
    assert text[1][got[1][0]["start"]:got[1][0]["stop"]] == "All rights reserved"
    assert text[2][got[2][0]["start"]:got[2][0]["stop"]] == "Licensed under the Apache License, Version 2.0"


def test_windows_equal_brute_force():
    r = random.Random(5)
    templates = {"x": ["a b c d e f"], "y": ["a b a b", "c a b d"], "z": ["e f g h a b c d"]}
    counts = [(n, L.bigrams(t)) for n in templates for t in templates[n]]
    m = L.Matcher(templates, 0.8)

    def reach(w):
        x = Counter(zip(w, w[1:]))
        return max((2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values())) for _, y in counts), default=0) if x else 0

    for _ in range(150):
        w = r.choices("abcdefgh", k=r.randint(0, 25)) if r.random() < 0.5 else r.choices(["a b c d", "e f", "c a b d", "q"], k=6)
        w = " ".join(w).split()
        got = m.passages(w)
        assert all(reach(w[a:b + 1]) >= 0.8 for _, _, a, b in got)
        every = [(reach(w[a:b + 1]), a, b) for a in range(len(w)) for b in range(a + 1, min(len(w), a + 14)) if reach(w[a:b + 1]) >= 0.8]
        assert max((d for d, _, _ in every), default=None) == max((d for _, d, _, _ in got), default=None)
        assert all(any(a <= q and p <= b for _, _, p, q in got) for _, a, b in every)


def test_size_bounds_are_exact():
    m = L.Matcher(L.TEMPLATES, 0.8)
    for a in range(1, 200):
        reachable = [k for k, b in enumerate(m.sizes) if 2 * min(a, b) / (a + b) >= 0.8]
        lo = next((k for k, b in enumerate(m.sizes) if b >= a * m.low), len(m.sizes))
        assert all(k >= lo and m.sizes[k] <= a / m.low for k in reachable)


def test_empty_table(spark):
    assert L.scan_licenses(frame(spark, [])).count() == 0


def test_bigrams_are_a_multiset():
    assert L.bigrams("a b a b") == Counter({("a", "b"): 2, ("b", "a"): 1})


def licence_folder(tmp_path):
    r = random.Random(7)
    p = lambda n: " ".join(r.choices([f"term{k}" for k in range(60)] + ["of", "the", "license", "you"], k=n))
    shared = p(40)
    long, other = [p(50) for _ in range(60)], [p(60) for _ in range(5)]
    (tmp_path / "Long-3").write_text("\n\n".join([*long[:30], shared, *long[30:]]))
    (tmp_path / "other").write_text("\n\n".join([shared, *other, "too short"]))
    (tmp_path / "alias").symlink_to(tmp_path / "other")
    return long, other, shared


def test_whole_licences_from_a_folder(spark, tmp_path):
    long, other, shared = licence_folder(tmp_path)
    templates = L.folder_templates(str(tmp_path))
    assert {k: len(v) for k, v in templates.items()} == {"long-3.0": 61, "other": 6}          # the shared paragraph belongs to none
    whole = templates["long-3.0"][0]
    rows = [(1, whole), (2, "int x; " * 200 + " ".join(long[7].split()) + " while true " * 100), (3, "some code\n\n" + other[2] + "\n\nmore code"), (4, shared),
            (5, whole.replace("term3 ", "termX ")), (6, "of the license you " * 50), (7, None)]
    got = {r["row"]["doc_id"]: r for r in L.scan_licenses(frame(spark, rows), templates=templates).collect()}
    units = {d: {m["license"] for m in r["matches"]} for d, r in got.items()}
    assert "long-3.0" in units[1] and any(m["unit"] == "text" and m["dice"] == 1.0 for m in got[1]["matches"])
    assert [p["license"] for p in got[2]["passages"]] == ["long-3.0"] and "other" in units[3]
    assert any(m["unit"] == "text" and m["license"] == "long-3.0" for m in got[5]["matches"])
    assert all(not got[d]["matches"] and not got[d]["passages"] for d in (4, 6, 7))
    assert L.folder_templates(str(tmp_path / "none")) == {} and L.all_templates(str(tmp_path / "none")) == dict(sorted(L.TEMPLATES.items()))


def test_anchors_lose_no_template(tmp_path):
    """Against all templates compared in full, for units cut from and mixed of them."""
    licence_folder(tmp_path)
    templates = {**L.folder_templates(str(tmp_path)), **L.TEMPLATES}
    m = L.Matcher(templates, 0.8)
    r = random.Random(3)
    texts = [t for own in templates.values() for t in own if len(t) < 5000]
    for _ in range(300):
        w = r.choice(texts).split()
        a = r.randrange(max(1, len(w) // 3))
        w = w[a:] if r.random() < 0.5 else w[:len(w) - a]
        w = L.words(" ".join("x" if r.random() < 0.08 else x for x in w))
        own = Counter(zip(w, w[1:]))
        n = sum(own.values())
        want = max((2 * sum((own & b).values()) / (n + s) for b, s in zip(m.counts, m.sizes, strict=True)), default=0) if n else 0
        got = m.best(w)
        assert (got[1] if got else 0) == (pytest.approx(want) if want >= 0.8 else 0)
