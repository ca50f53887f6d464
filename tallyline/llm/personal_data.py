"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans (email, ip, card, phone). The field labels the
tokens that could be personal data, with O or one of these kinds, from three
sorts of potentials:

* a token's own: how often tokens of its signature (digits, letters, marks,
  length, neighbour) lie in base spans of each kind;
* chain: the label pairs of tokens that stand side by side;
* skip: the label pairs of tokens that a document repeats at any distance. It
  also holds for similar tokens: the same digits with other separators, the
  name of an address standing alone.

All are counted over the whole input with the base spans as labels. Since the
patterns find only some of what they look for (a number must pass Luhn, a
phone number must have its plus), labelled tokens are a sample of the positive
ones: the share of a signature that is labelled is divided by the mean share
among labelled tokens of the kind (learning from positive and unlabelled
examples). Luhn is therefore no part of a signature. A signature that is seen
seldom counts as O nearly, so only its links can decide otherwise.

Labels of tokens in base spans are given; the others' marginals come from loopy
belief propagation over the document's whole graph, so one certain token decides
for its repetitions far away. A token whose best label is a kind with at least
`least` probability becomes a span; neighbours of one phone or card label join.
Each of a token's keys links it to the next token of that key, so a key that
fills a document costs one edge per token, never all pairs.

The model is at most SIGNATURES x 5 counts and two 5 x 5 tables, whatever the
input's size. A document is handled whole by one task, in memory in proportion
to its text; documents are independent, so nothing is shuffled but the counts.

Defined cases: a null text is empty and has no spans; repeated documents are
judged alike; an empty table, or one without base spans, adds nothing; other
columns are ignored. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, read

# Fixed patterns of the contract, each written so that a search is linear in the
# text (a run is entered at its start only, and never given back).
KINDS = ["email", "ip", "card", "phone"]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IP_MOST = 255
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)

LABELS = ["O", *KINDS]
CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
WORD = re.compile(r"\S+")
MARKS = "\"'`()[]{}<>,;:!?.*#$%&|=/\\"
SIGNATURES = 1 << 17
PSEUDO = 4.0           # added to a signature's counts
PAIR_PSEUDO = 1.0      # added to those of a pair of labels, seen and expected
DOUBT = 0.02           # share of a kind among tokens of a signature never seen
LEAST = 0.6
ROUNDS = 12
DAMPING = 0.3
KEY_DIGITS = 6
KEY_NAME = 4

SPANS = "array<struct<kind:string,start:int,stop:int,p:double>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        name = text[done:at]
        start = done + len(name.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    own = [int(c) for c in reversed(digits)]
    return (sum(own[::2]) + sum(d * 2 - 9 * (d > 4) for d in own[1::2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= IP_MOST for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, stop) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            d = _digits(m.group())
            if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and _luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text)
                if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]]
    return out


def _bucket(n: int, *bounds: int) -> int:
    return sum(n >= b for b in bounds)


def _shape(core: str) -> tuple[int, ...]:
    """What a token looks like, in few values each; (number of values) is stated in SIZES."""
    digits = len(_digits(core))
    letters = [c for c in core if c.isalpha()]
    case = 0 if not letters else 1 if all(c.islower() for c in letters) else 2 if all(c.isupper() for c in letters) else 3
    dots, dashes = core.count("."), core.count("-")
    quad = dots == 3 and digits + 3 == len(core)
    return (2 if "@" in core else int(core[0] == "+"), _bucket(digits, 1, 2, 4, 7, 8, 12, 16, 20), case, min(dots, 4), min(dashes, 3),
            _bucket(len(core), 4, 8, 16, 32), int(quad))


SIZES = (3, 9, 4, 5, 4, 5, 2, 3, 2)       # the shape, then the left neighbour's kind and the brackets around the token
PLAIN = 0                                 # signature of words that are tokens for their links only


def signature(core: str, bracketed: bool, left: int) -> int:
    out = 0
    for v, n in zip((*_shape(core), left, int(bracketed)), SIZES, strict=True):
        out = out * n + v
    return 1 + out % (SIGNATURES - 1)


class Graph:
    """Tokens of one text that could be personal data, and the edges between them."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.start: list[int] = []
        self.stop: list[int] = []
        self.sig: list[int] = []
        self.label: list[int] = []           # given by a base span; -1: open
        self.chain: list[int] = []           # i: an edge (i, i + 1)
        self.skip: list[tuple[int, int, bool]] = []     # the third: whether the tokens are equal
        spans = sorted((a, b, k) for k, a, b in base)
        names = {text[a:text.index("@", a)].lower() for k, a, b in base if k == 0}
        names = {x for x in names if len(x) >= KEY_NAME}
        found = CANDIDATE.finditer(text) if not names else self._with_names(text, names)
        held: dict[str, int] = {}
        before, s = -1, 0
        for m in found:
            raw = m.group()
            core = raw.strip(MARKS)
            if not core:
                continue
            a = m.start() + raw.index(core)
            b = a + len(core)
            plain = not any("0" <= c <= "9" or c == "@" for c in core)
            close = before >= 0 and m.start() - before == 1
            i = len(self.start)
            while s < len(spans) and spans[s][1] <= a:
                s += 1
            here = spans[s] if s < len(spans) and spans[s][0] < b else None
            left = 0 if not close else 1 if plain else 2
            self.start.append(a)
            self.stop.append(b)
            self.sig.append(PLAIN if plain else signature(core, raw[0] == "(", left))
            self.label.append(1 + here[2] if here else -1)
            if close:
                self.chain.append(i - 1)
            before = m.end()
            folded = core.lower()
            keys = {"=" + folded}
            d = _digits(core)
            if here and here[1] <= b:                         # the span's last token stands for all its digits
                d = _digits(text[here[0]:here[1]]) if here[2] >= 2 else d
            if len(d) >= KEY_DIGITS and "@" not in core:
                keys.add("#" + d)
            if folded in names:
                keys.add("@" + folded)
            elif "@" in folded and len(n := folded.split("@")[0]) >= KEY_NAME:
                keys.add("@" + n)
            linked = set()
            for key in sorted(keys):
                j = held.get(key)
                if j is not None and j not in linked:
                    linked.add(j)
                    self.skip.append((j, i, key[0] == "="))
                held[key] = i

    @staticmethod
    def _with_names(text: str, names: set[str]) -> Iterator[re.Match]:
        for m in WORD.finditer(text):
            w = m.group()
            if any("0" <= c <= "9" or c == "@" for c in w) or w.strip(MARKS).lower() in names:
                yield m


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("doc_id")[i].as_py(), b.column("text")[i].as_py() or ""


def _has_candidates(text: str) -> bool:
    return "@" in text or DIGIT.search(text) is not None


DIGIT = re.compile("[0-9]")


def counts(docs: DataFrame) -> DataFrame:
    """(factor, a, b, n): tokens by signature and label, and label pairs of chain and skip edges, over all documents."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, text in _texts(batches):
            if not _has_candidates(text):
                continue
            g = Graph(text, base_spans(text))
            y = [max(0, x) for x in g.label]
            seen.update(("own", s, v) for s, v in zip(g.sig, y, strict=True))
            seen.update(("chain", y[i], y[i + 1]) for i in g.chain)
            seen.update(("skip", y[i], y[j]) for i, j, equal in g.skip if equal)
        if seen:
            f, a, b = zip(*seen, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(seen.values()), pa.int64())],
                                             ["factor", "a", "b", "n"])

    return map_arrow(docs, tasks, "factor string, a int, b int, n long").groupBy("factor", "a", "b").agg(F.sum("n").alias("n"))


class Model:
    """Log potentials: own[signature] (5), chain and skip (5 x 5)."""

    def __init__(self, rows: list[tuple[str, int, int, int]]):
        k = len(LABELS)
        own: dict[int, np.ndarray] = {}
        pairs = {"chain": np.zeros((k, k)), "skip": np.zeros((k, k))}
        for factor, a, b, n in rows:
            if factor == "own":
                own.setdefault(a, np.zeros(k))[b] += n
            else:
                pairs[factor][a, b] += n
        total = sum(own.values(), np.zeros(k))
        self.usable = bool(total[1:].sum())
        self.own = {s: (n[1:] + PSEUDO * DOUBT) / (n.sum() + PSEUDO) for s, n in own.items()}
        # of all tokens of a kind, the share that the patterns label: its mean over labelled tokens
        found = sum((own[s][1:] * p for s, p in self.own.items()), np.zeros(k - 1))
        share = np.where(total[1:] > 0, found / np.maximum(total[1:], 1), 1.0)
        for s, p in self.own.items():
            q = np.where(own[s][1:] > 0, np.minimum(p / np.maximum(share, 1e-9), 1.0), p)
            self.own[s] = self._logs(q / max(1.0, q.sum()))
        self.unseen = self._logs(np.full(k - 1, DOUBT))
        self.chain = self._attraction(pairs["chain"])
        # one weight for equal labels and one for different ones, so kinds that seldom repeat profit from the others
        both = pairs["skip"] + pairs["skip"].T
        total, apart = both.sum(), np.outer(both.sum(axis=1), both.sum(axis=1)) / max(1.0, both.sum())
        same, by_chance = np.trace(both), np.trace(apart)
        weight = lambda n, e: math.log((n + PAIR_PSEUDO) / (e + PAIR_PSEUDO))
        self.skip = np.full((k, k), weight(total - same, total - by_chance))
        np.fill_diagonal(self.skip, weight(same, by_chance))

    @staticmethod
    def _logs(q: np.ndarray) -> np.ndarray:
        return np.log(np.concatenate([[max(1e-6, 1.0 - q.sum())], np.maximum(q, 1e-9)]))

    @staticmethod
    def _attraction(n: np.ndarray) -> np.ndarray:
        """log p(a, b) / (p(a) p(b)), drawn towards independence by pseudo-counts."""
        alone = np.outer(n.sum(axis=1), n.sum(axis=0)) / max(1.0, n.sum())
        return np.log((n + PAIR_PSEUDO) / (alone + PAIR_PSEUDO))

    def node(self, sig: int) -> np.ndarray:
        return self.own.get(sig, self.unseen)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(own: np.ndarray, a: np.ndarray, b: np.ndarray, kind: np.ndarray, tables: np.ndarray, rounds: int = ROUNDS,
              damping: float = DAMPING) -> np.ndarray:
    """Label probabilities of every node by loopy belief propagation (exact on a forest).

    own: log potentials (nodes x labels); edges a[e] - b[e] with tables[kind[e]] (label of a, label of b)."""
    n, k = own.shape
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    e = len(a)
    pair = np.concatenate([tables[kind], tables[kind].transpose(0, 2, 1)]) if e else np.zeros((0, k, k))
    back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    msg = np.zeros((2 * e, k))
    belief = own.copy()
    for _ in range(rounds if e else 0):
        new = _log_sum((belief[src] - msg[back])[:, :, None] + pair, axis=1)
        new -= _log_sum(new, axis=1)[:, None]
        change = np.abs(new - msg).max()
        msg = damping * msg + (1.0 - damping) * new if damping else new
        belief = own.copy()
        for y in range(k):
            belief[:, y] += np.bincount(dst, weights=msg[:, y], minlength=n)
        if change < 1e-6:
            break
    return np.exp(belief - _log_sum(belief, axis=1)[:, None])


def label(graph: Graph, model: Model) -> np.ndarray:
    """Label probabilities of a text's tokens; those in base spans are given."""
    own = np.array([model.node(s) for s in graph.sig]).reshape(-1, len(LABELS))
    for i, y in enumerate(graph.label):
        if y >= 0:
            own[i] = -30.0
            own[i, y] = 0.0
    a = np.array([*graph.chain, *[i for i, _, _ in graph.skip]], np.int64)
    b = np.array([*[i + 1 for i in graph.chain], *[j for _, j, _ in graph.skip]], np.int64)
    kind = np.repeat([0, 1], [len(graph.chain), len(graph.skip)])
    return marginals(own, a, b, kind, np.stack([model.chain, model.skip]))


JOINED = (1 + KINDS.index("card"), 1 + KINDS.index("phone"))


def added_spans(text: str, base: list[tuple[int, int, int]], model: Model, least: float = LEAST) -> list[tuple[int, int, int, float]]:
    """(kind's number, start, stop, probability) of what the field finds outside the base spans."""
    if not model.usable or not _has_candidates(text):
        return []
    g = Graph(text, base)
    if all(y >= 0 for y in g.label):
        return []
    p = label(g, model)
    best = p.argmax(axis=1)
    side = set(g.chain)
    out: list[list] = []
    last = -2
    for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= least)).tolist():
        if g.label[i] >= 0:
            continue
        y = int(best[i])
        if last == i - 1 and last in side and out[-1][0] == y - 1 and y in JOINED:
            out[-1][2], out[-1][3] = g.stop[i], min(out[-1][3], float(p[i, y]))
        else:
            out.append([y - 1, g.start[i], g.stop[i], float(p[i, y])])
        last = i
    return [tuple(x) for x in out]


def train(docs: DataFrame) -> Model:
    rows = counts(docs).collect()             # at most SIGNATURES * 5 + 50 rows
    return Model([(r["factor"], r["a"], r["b"], r["n"]) for r in rows])


def find(docs: DataFrame, model: Model | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, `base` and `spans` (kind, start, stop, p) of every row of `docs`, by kind and start."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = model or train(docs)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])
    named = lambda spans: [{"kind": KINDS[k], "start": a, "stop": b, "p": p} for k, a, b, p in spans]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for _, text in _texts([batch]):
                b = base_spans(text) if _has_candidates(text) else []
                certain = [(*x, 1.0) for x in b]
                base.append(named(certain))
                every.append(named(sorted(certain + added_spans(text, b, model, least))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(every, pa.list_(span))],
                                             ["doc_id", "base", "spans"])

    return map_arrow(docs, tasks, f"doc_id long, base {SPANS}, spans {SPANS}")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op12_skip_chain(spark, sf_dir: str) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find(read(spark, sf_dir, "documents")).select(
        "doc_id", *[n(k) for k in KINDS], F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
