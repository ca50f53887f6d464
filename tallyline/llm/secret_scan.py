"""Secret scan: fixed patterns, and character Markov models with a log-likelihood ratio.

DataFrame functions only. Three fixed patterns give the base spans. The method
adds further tokens: two first-order models over the token alphabet, one of
secrets and one of ordinary identifiers, are counted over the whole input from
labelled samples (a long token that overlaps a base span is a secret, any other
is ordinary). The secrets' model is half uniform, as a random string need not
be of the alphabet that the fixed patterns know. A token outside the base spans is added when the mean of
log2 P(next | char, secret) / P(next | char, ordinary) over its transitions and
the sum both exceed their thresholds. The models are tables of at most
67 x 67 transitions, so they travel as a literal.

Positions come from the pieces between matches (split) and the matches
themselves, added up along the text; both run only on texts that have one. An
array of n that grows by one element a step costs n * n; so sums along an array,
the search for base spans at a token, and the redacted text are made from
stretches of STRETCH elements, whose results are put together at the end, and
no step takes a substring from the start of a long text.

Defined cases: a null text is empty; repeated documents are judged alike; an
empty table or one without samples adds nothing; other columns travel in `row`
and cannot clash. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, read

# Fixed patterns of the contract. Runs too short are left out: in `access` and
# `hex` a run that fails can hide no other, so its length is part of the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]"
MIN_SAMPLE = 12
MIN_TOKEN = 20
MIN_BITS_PER_CHAR = 0.6
MIN_BITS = 12.0
PRIOR = 67.0
UNIFORM = 0.5

SPAN = "struct<start:int,rank:int,stop:int,kind:string>"
STRETCH = 128
PIECE = 1024          # code points

INTS = "array<int>"


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as {kind})")


def _bound(value: Column, then: Callable[[Column], Column], last: bool = False) -> Column:
    """`then` of a value that is computed once: an array of one element binds it (with `last`, the array is given out)."""
    one = F.transform(F.array(value), then)
    return one if last else F.get(one, F.lit(0))


def _stretches(values: Column) -> Column:
    """The array in slices of STRETCH; none for an empty one."""
    n = F.size(values)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STRETCH).cast("int")), lambda k: F.slice(values, k * STRETCH + 1, STRETCH))
                  ).otherwise(F.array().cast(f"array<{INTS}>"))


def before(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each int of an array, what `step` has made of those before it, from 0."""
    zero = F.lit(0)

    def running(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.struct(start.alias("at"), _none(INTS).alias("out")), lambda acc, x: F.struct(
            step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    parts = _stretches(values)
    starts = running(F.transform(parts, lambda xs: F.aggregate(xs, zero, step)), zero)
    return F.flatten(F.zip_with(parts, starts, running))


def _span_of(kind: str) -> Callable[[Column, Column], Column]:
    return lambda start, x: F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(x)).alias("stop"),
                                     F.lit(kind).alias("kind"), x.alias("text"))


def _long_enough(spans: Column, groups: Column, least: int) -> Column:
    both = F.arrays_zip(spans.alias("s"), groups.alias("v"))
    return F.transform(F.filter(both, lambda x: F.length(x["v"]) >= least), lambda x: x["s"])


def _with_found(t: DataFrame, patterns: dict[str, tuple[str, str, tuple[int, int] | None]], where: Column | None = None) -> DataFrame:
    """Adds, per name -> (pattern, kind, least), the array of all its matches from left to right: a span and its text each;
    `least` (group, n) drops matches whose group is shorter. Texts that are not `where` have none."""
    text = F.col("text")
    arrays, spans = {}, {}
    for name, (pattern, kind, least) in patterns.items():
        has = text.rlike(pattern) if where is None else where & text.rlike(pattern)
        arrays[f"_{name}_m"] = F.coalesce(F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), _none("array<string>"))
        arrays[f"_{name}_g"] = F.coalesce(F.when(has, F.split(text, pattern, -1)), _none("array<string>"))
        if least:
            arrays[f"_{name}_v"] = F.coalesce(F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(least[0]))), _none("array<string>"))
        m, g = F.col(f"_{name}_m"), F.col(f"_{name}_g")
        lengths = F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda a, b: F.length(a) + F.length(b))
        starts = F.zip_with(before(lengths, lambda x, y: x + y), F.slice(g, F.lit(1), F.size(m)), lambda a, gap: a + F.length(gap))
        made = F.zip_with(starts, m, _span_of(kind))
        spans[name] = _long_enough(made, F.col(f"_{name}_v"), least[1]) if least else made
    return t.withColumns(arrays).withColumns(spans).drop(*arrays)


def _spans(found: Column) -> Column:
    """Spans without their texts."""
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))


def base_spans(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """row, text and `base`: the spans of the fixed patterns, by start and kind."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if row is None else row
    t = docs.select(row.alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = _with_found(t, {"_assign": (ASSIGN, "assign", (2, ASSIGN_LEAST)), "_access": (ACCESS, "access", None), "_hex": (HEX, "hex", None)})
    return t.withColumn("base", F.sort_array(F.concat(*[_spans(F.col(c)) for c in ("_assign", "_access", "_hex")]))).select("row", "text", "base")


def _in_base(tokens: Column, base: Column) -> Column:
    """Of each token whether it overlaps a base span. Tokens are in order; a stretch of them looks at the spans of its part of the text."""
    n = F.size(tokens)

    def stretch(k: Column) -> Column:
        def inside(p: Column) -> Column:
            return F.transform(p["xs"], lambda x: F.exists(p["near"], lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))

        def near(p: Column) -> Column:
            return F.struct(p["xs"].alias("xs"), F.filter(base, lambda b: (b["start"] < p["hi"]) & (p["lo"] < b["stop"])).alias("near"))

        def bounds(xs: Column) -> Column:
            return F.struct(xs.alias("xs"), F.get(xs, F.lit(0))["start"].alias("lo"), F.element_at(xs, -1)["stop"].alias("hi"))

        return F.flatten(_bound(_bound(_bound(F.slice(tokens, k * STRETCH + 1, STRETCH), bounds), near), inside, last=True))

    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STRETCH).cast("int")), stretch))).otherwise(_none("array<boolean>"))


def train(docs: DataFrame, min_sample: int = MIN_SAMPLE) -> list[float] | None:
    """log2 ratio of every transition, row by row over ALPHABET; None without samples of both kinds."""
    t = base_spans(docs, F.struct(F.lit(0).alias("_")))
    sample = f"{TOKEN}{{{min_sample},}}"
    # only texts with base spans need positions: elsewhere every token is ordinary
    some = F.size("base") > 0
    t = _with_found(t, {"found": (sample, "markov", None)}, some).withColumn("inside", _in_base(F.col("found"), F.col("base")))
    token = lambda x, secret: F.struct(x.alias("token"), secret.alias("secret"))
    t = t.select(F.when(some, F.zip_with("found", "inside", lambda x, y: token(x["text"], y))).otherwise(
        F.transform(F.regexp_extract_all("text", F.lit(sample), F.lit(0)), lambda x: token(x, F.lit(False)))).alias("tokens"))
    # written first: a filter on what is exploded would be pushed into the projections and repeat them
    samples = materialize(t, "secret-samples")
    labelled = samples.select(F.explode("tokens").alias("x")).select("x.token", "x.secret")
    chars = labelled.select("secret", F.split("token", "").alias("c"))
    pairs = chars.select("secret", F.explode(F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: F.concat(a, b))).alias("pair"))
    counts = {True: {}, False: {}}
    for r in pairs.groupBy("secret", "pair").count().collect():   # at most 2 x 67 x 67 rows
        counts[r["secret"]][r["pair"]] = r["count"]
    if not counts[True] or not counts[False]:
        return None
    n = len(ALPHABET)

    def share(own: dict[str, int], a: str, uniform: float) -> list[float]:
        total = sum(own.get(a + b, 0) for b in ALPHABET)
        return [uniform / n + (1 - uniform) * (own.get(a + b, 0) + PRIOR / n) / (total + PRIOR) for b in ALPHABET]

    return [math.log2(p / q) for a in ALPHABET for p, q in zip(share(counts[True], a, UNIFORM), share(counts[False], a, 0.0), strict=True)]


def scan(docs: DataFrame, row: Column | None = None, model: list[float] | None | str = "train", min_token: int = MIN_TOKEN,
         per_char: float = MIN_BITS_PER_CHAR, bits: float = MIN_BITS) -> DataFrame:
    """row, text, `base` and `spans`: base spans and those that the models add, by start and kind."""
    model = train(docs) if model == "train" else model
    t = base_spans(docs, row)
    if model is None:
        return t.withColumn("spans", F.col("base"))
    # one constant, not thousands of literals
    table = F.expr(f"cast(split('{','.join(map(repr, model))}', ',') as array<double>)")
    index = lambda c: F.instr(F.lit(ALPHABET), c) - 1

    def score(token: Column) -> Column:
        c = F.transform(F.split(token, ""), lambda x: index(x))
        return F.aggregate(F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
                                      lambda a, b: F.get(table, a * len(ALPHABET) + b)), F.lit(0.0), lambda s, x: s + x)

    t = _with_found(t, {"tokens": (f"{TOKEN}{{{min_token},}}", "markov", None)}).withColumn("inside", _in_base(F.col("tokens"), F.col("base")))

    def is_secret(x: Column) -> Column:
        return score(x["text"]) >= F.greatest(F.lit(bits), per_char * (F.length(x["text"]) - 1))

    free = F.transform(F.filter(F.arrays_zip(F.col("tokens").alias("x"), F.col("inside").alias("y")), lambda p: ~p["y"]), lambda p: p["x"])
    return t.withColumn("more", F.filter(free, is_secret)).select("row", "text", "base", F.sort_array(F.concat("base", _spans(F.col("more")))).alias("spans"))


def redact(mark: str = "[SECRET]") -> Column:
    """The text with every run of touching or overlapping spans replaced by `mark`.

    A run begins at a span that starts behind all ends before it. What lies between
    two runs is put together from pieces of PIECE code points."""
    text, spans = F.col("text"), F.col("spans")
    ends = before(F.transform(spans, lambda s: s["stop"]), lambda x, y: F.greatest(x, y))
    cuts = F.filter(F.zip_with(spans, ends, lambda s, e: F.struct(e.alias("a"), s["start"].alias("b"))),
                    lambda c: (c["b"] >= c["a"]) & ((c["b"] > c["a"]) | (c["a"] == 0)))
    tail = F.struct(F.array_max(F.transform(spans, lambda s: s["stop"])).alias("a"), F.length(text).alias("b"))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(all_pieces: Column, c: Column) -> Column:
        first, last = F.floor(c["a"] / PIECE).cast("int"), F.floor((c["b"] - 1) / PIECE).cast("int")

        def part(k: Column) -> Column:
            lo, hi = F.greatest(c["a"] - k * PIECE, F.lit(0)), F.least(c["b"] - k * PIECE, F.lit(PIECE))
            return F.substring(F.get(all_pieces, k), lo + 1, hi - lo)

        return F.when(c["b"] > c["a"], F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))

    # the pieces are made once: an array of one element hands them to all cuts
    done = F.array_join(F.flatten(F.transform(F.array(pieces), lambda ps: F.transform(
        F.concat(cuts, F.array(tail)), lambda c: between(ps, c)))), mark)
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op7_markov_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"), F.struct("doc_id"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("row.doc_id", n("assign"), n("access"), n("hex"), F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))
