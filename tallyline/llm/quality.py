"""Quality rules by distribution divergence, with DataFrame functions only.

A document's characters are counted by class (white space, symbols, upper case,
other ASCII punctuation, the bytes that non-ASCII adds, the rest), and its words,
lower-cased and cut at ASCII punctuation too, by the common words of its language
(all other words are one more bin). The common words are learnt: the
COMMON_WORDS words that most documents of a language hold. Both histograms are
compared with references by the Jensen-Shannon distance (base 2, 0 to 1):
characters with the nearest language, since the `lang` column may be wrong, and
words with the document's own language. A language's reference is taken over all
its documents in one aggregate. A reference of n documents may itself be off, so
it allows MARGIN / n more; a distance counts only where the text is long enough
for the histogram to mean something (MIN_CHARS, MIN_HISTOGRAM_WORDS), and none
where the document's language has no such text at all.

The texts are read twice: once for the words' document frequencies (combined
before the shuffle, by language and word), once to be measured; counts, shares
and the carried `row` are written to the shared checkpoint folder. Word lists and
references are tables of a row per language (about 1 KB) that are joined to the
documents; Spark knows their size. No shuffle of texts.

Defined cases: a null text has no words (and fails the base rule); a null
language is a language of its own; repeated documents are judged alike; an
empty table yields no rows; other columns travel in `row` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, read

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

MARKS = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"

GAPS = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"

COMMON_WORDS = 32        # of a language
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS = 200
MIN_HISTOGRAM_WORDS = 100
MARGIN = 0.5
MAX_CHAR_DISTANCE = 0.14
MAX_WORD_DISTANCE = 0.4
FEW_REPEATS = 64
N_CHAR_BINS = 6


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _lang(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def _folded(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAPS), "")


def common_words(docs: DataFrame, n: int = COMMON_WORDS) -> DataFrame:
    """lang, words: the n words of each language that most of its documents hold, the most frequent first, ties by the word."""
    words = F.array_distinct(_folded(F.col("text").cast("string")))
    # the outer form: for the plain one Spark would filter by the array's size first, and make every array twice
    seen = docs.select(_lang(docs).alias("lang"), F.explode_outer(words).alias("word")).where("word is not null").groupBy("lang", "word").agg(
        F.count("*").alias("docs"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("docs").desc(), "word"))
    top = seen.withColumn("place", place).where(F.col("place") <= n)
    return top.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("words"))


def measure(docs: DataFrame, row: Column | None = None, common: DataFrame | None = None) -> DataFrame:
    """row, lang, the counts of the base rules and both histograms (as shares, null where a text is too short)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if row is None else row
    common = materialize(common_words(docs), "quality-words") if common is None else common
    own = common.select(F.col("lang").alias("_lang"), F.col("words").alias("common"))
    base = docs.select(row.alias("row"), _lang(docs).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn(
        "common", F.coalesce("common", F.array().cast("array<string>"))).drop("_lang")
    t = F.col("text")
    base = base.withColumns({
        "words": F.array_remove(F.split(t, SPACE), ""),
        "n_symbols": _removed(t, SYMBOLS),
        "n_upper": _removed(t, r"\p{Lu}+"),
        "n_marks": _removed(t, MARKS),
        "n_chars": F.length(t).cast("long"),
        "n_wide": (F.octet_length(t) - F.length(t)).cast("long"),
        "lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    n = F.size("words")
    base = base.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        # of each folded word its place among the common ones, 0 for all others
        "at": F.when(n >= MIN_HISTOGRAM_WORDS, F.transform(_folded(t), lambda w: F.array_position("common", w))),
        "tri": F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
            F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))),
    }).drop("text")
    base = base.withColumn("hits", F.array_remove("at", F.lit(0).cast("long")))
    base = base.withColumn("in_order", F.sort_array("tri"))
    base = base.withColumn("repeated", F.array_distinct(F.filter("in_order", lambda x, k: F.get("in_order", k + 1) == x)))
    # where the windows found twice begin: few such windows are looked up, many come from sorting windows with their places
    base = base.withColumn("by_window", F.when(F.size("repeated") > FEW_REPEATS, F.sort_array(
        F.transform("tri", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    base = base.withColumn("twice", F.when(F.size("repeated") > FEW_REPEATS, F.filter(F.transform("by_window", lambda x, k: F.when(
        (F.get("by_window", k - 1)["h"] == x["h"]) | (F.get("by_window", k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        .when(F.size("repeated") > 0, F.filter(F.transform("tri", lambda x, i: F.when(
            F.array_contains("repeated", x), i)), lambda i: i.isNotNull())))
    space = F.col("n_chars") - F.col("word_chars")
    rest = F.greatest(F.lit(0).cast("long"), F.col("word_chars") - F.col("n_upper") - F.col("n_marks") - F.col("n_wide"))
    base = base.select(
        "row", "lang", "n_words", "word_chars", "n_symbols", "n_chars", F.size("at").alias("n_folded"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice").isNull(), 0).otherwise(F.size(F.array_union(F.array_union(
            "twice", F.transform("twice", lambda i: i + 1)), F.transform("twice", lambda i: i + 2)))).cast("long").alias("n_repeat_words"),
        F.array(space, "n_symbols", "n_upper", F.col("n_marks") - F.col("n_symbols"), "n_wide", rest).alias("char_bins"),
        F.concat(F.transform("common", lambda w, i: (F.size("hits") - F.size(F.array_remove(F.col("hits"), (i + 1).cast("long")))).cast("long")),
                 F.array((F.size("at") - F.size("hits")).cast("long"))).alias("word_bins"),
    )
    base = base.withColumn("char_sum", F.greatest(F.lit(1), sum((F.col("char_bins")[i] for i in range(1, N_CHAR_BINS)), F.col("char_bins")[0])))
    return base.select(
        "row", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(F.col("n_chars") >= MIN_CHARS, F.transform("char_bins", lambda x: x / F.col("char_sum"))).alias("char_shares"),
        F.when(F.col("n_folded") > 0, F.transform(
            "word_bins", lambda x: x / F.col("n_folded"))).alias("word_shares"))


def references(measured: DataFrame) -> DataFrame:
    """lang, n (documents with both histograms), and their reference histograms c and w.

    Character classes take the median share over a language's documents, so
    that its junk, if less than half, does not move them; words take the mean.
    """
    h = measured.where("char_shares is not null and word_shares is not null")
    made = [F.percentile_approx(F.col("char_shares")[i], 0.5, 1000).alias(f"c{i}") for i in range(N_CHAR_BINS)]
    made += [F.avg(F.get("word_shares", i)).alias(f"w{i}") for i in range(COMMON_WORDS + 1)]
    total = sum((F.col(f"c{i}") for i in range(1, N_CHAR_BINS)), F.col("c0"))
    per = h.groupBy("lang").agg(F.count("*").alias("n"), *made).where(total > 0)
    return per.select("lang", "n", F.array(*[F.col(f"c{i}") / total for i in range(N_CHAR_BINS)]).alias("c"),
                      F.filter(F.array(*[F.col(f"w{i}") for i in range(COMMON_WORDS + 1)]), lambda x: x.isNotNull()).alias("w"))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits; both arrays are shares that sum to 1."""
    side = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))),
        F.lit(0.0), lambda s, x: s + x)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), (side(p, q) + side(q, p)) / 2)))


def judge(docs: DataFrame, row: Column | None = None, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """row, base counts, both distances (null where a text is too short for one or its language has no reference) and the verdict `kept`."""
    measured = materialize(measure(docs, row), "quality")
    refs = materialize(references(measured), "quality-references")
    every = refs.agg(F.collect_list("c").alias("refs"))                       # a row; six numbers per language
    own = refs.select(F.col("lang").alias("_lang"), F.col("n").alias("ref_docs"), F.col("w").alias("own_words"))
    h = measured.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").crossJoin(every)
    has = F.col("ref_docs").isNotNull()
    nearest = F.array_min(F.transform("refs", lambda c: js_distance(F.col("char_shares"), c)))
    h = h.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ref_docs",
                 F.when(has, nearest).alias("char_distance"), F.when(has, js_distance(F.col("word_shares"), F.col("own_words"))).alias("word_distance"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    spare = MARGIN / F.col("ref_docs")
    bad = F.coalesce(F.col("char_distance") > max_char + spare, F.lit(False)) | F.coalesce(F.col("word_distance") > max_word + spare, F.lit(False))
    return h.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~bad).drop("ref_docs")


def op5_js_divergence(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, F.struct("doc_id")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance")
