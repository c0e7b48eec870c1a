"""Quality rules: base counts of a text and the divergence of its histograms from its language's.

A document is compared with the whole corpus of its language by two histograms: classes of characters and
the language's commonest words, which are learned here (the words that stand in most of its texts). The Jensen-Shannon
distance (base 2, between 0 and 1) of either may not exceed its limit. Histograms of too few characters or
words, and references made of too little text, judge nothing.

Defined cases: null and empty texts have no words and fail the base rule; each ``lang`` value is a reference of its own, null
and empty ones share one; words of equally many texts rank by code point; a very long text is counted whole, in the task that
holds it, and each of its different words counts once as a text of that word; repeated rows are judged alike and each counts in
the references; an empty table gives no rows. Input columns are packed away while measures are computed, so any names may occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import packed, words
from rollcall.session import materialize

#: The base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Limits of the distances, and the least amounts that they are judged on.
FIRST_CLASS_DISTANCE = 0.25
MAX_CLASS_DISTANCE = 0.33
MAX_WORD_DISTANCE = 0.25
MIN_CHARS = 200
MIN_HISTOGRAM_WORDS = 100
MIN_REFERENCE_WORDS = 1000

CLASSES = ["uppers", "digits", "punctuation", "n_symbols", "spaces", "wide", "others"]
#: Common words of a language that have a share of their own in the word histogram.
WORD_BINS = 12

_REPEATS = """
aggregate(
  transform(at, (p, i) -> least(3, coalesce(get(at, i + 1) - p, 3))),
  0L, (total, x) -> total + x)
"""
_REPEATED_AT = """
sort_array(filter(
  transform(grams, (x, i) -> IF(get(grams, i - 1).h = x.h OR get(grams, i + 1).h = x.h, x.i, -1)),
  p -> p >= 0))
"""


def _share(text: Column, drop: str) -> Column:
    """Number of characters of ``text`` that match ``drop``."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, drop, ""))).cast("long")


def _ref() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("ref")


def common_words(docs: DataFrame) -> DataFrame:
    """The WORD_BINS words that stand in most texts of MIN_WORDS words or more, by language: (ref, common), commonest first.

    Texts are counted per (language, word) before they are shuffled, and a task hands on WORD_BINS words of
    a language at most.
    """
    texts = (
        docs.select(_ref(), words(F.col("text")).alias("w"))
        .where(F.size("w") >= MIN_WORDS)
        .select("ref", F.explode(F.array_distinct("w")).alias("word"))
        .groupBy("ref", "word")
        .agg(F.count(F.lit(1)).alias("texts"))
    )
    first = Window.partitionBy("ref").orderBy(F.col("texts").desc(), "word")
    return (
        texts.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= WORD_BINS)
        .groupBy("ref")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x.word).alias("common"))
    )


def measured(docs: DataFrame, common: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Base counts and both histograms of every row (columns ``keep``, or all, packed as ``row``).

    Everything is counted inside the row. Three-word windows are hashed to 64 bits and sorted
    within the document; only documents in which one repeats are sorted with their places.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = packed(
        docs,
        keep,
        text.alias("t"),
        _ref(),
        words(F.col("text")).alias("w"),
    ).join(common, "ref", "left")
    hashed = split.withColumns(
        {
            "common": F.coalesce("common", F.array().cast("array<string>")),
            "n_words": F.size("w").cast("long"),
            "word_chars": F.char_length(F.array_join("w", "")).cast("long"),
            "h": F.expr(
                "IF(size(w) < 3, CAST(array() AS array<bigint>), transform(sequence(1, size(w) - 2),"
                " i -> xxhash64(element_at(w, i), element_at(w, i + 1), element_at(w, i + 2))))"
            ),
        }
    )
    counted = hashed.withColumns(
        {
            "hits": F.filter("w", lambda x: F.array_contains(F.col("common"), x)),
            "lines": F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
            "grams": F.expr(
                "IF(size(array_distinct(h)) = size(h), CAST(array() AS array<struct<h: bigint, i: int>>),"
                " array_sort(transform(h, (x, i) -> named_struct('h', x, 'i', i))))"
            ),
        }
    ).drop("w", "h")
    placed = counted.withColumns(
        {
            "at": F.expr(_REPEATED_AT),
            "chars": F.char_length("t").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_symbols": _share(F.col("t"), "[#*$%&|<>]"),
            "uppers": _share(F.col("t"), "[A-Z]"),
            "digits": _share(F.col("t"), "[0-9]"),
            "punctuation": _share(F.col("t"), "[!\"'()+,./:;=?@\\[\\\\\\]^_`{}~-]"),
            "wide": (F.octet_length("t") - F.char_length("t")).cast("long"),
        }
    ).drop("lines", "grams", "t")
    bins = {
        f"w{k}": F.expr(f"CAST(size(filter(hits, x -> x = get(common, {k}))) AS BIGINT)")
        for k in range(WORD_BINS)
    }
    return (
        placed.withColumn("n_repeat_words", F.expr(_REPEATS))
        .withColumn("spaces", F.col("chars") - F.col("word_chars"))
        .withColumn(
            "others",
            F.greatest(
                F.lit(0).cast("long"),
                F.col("chars") - F.col("uppers") - F.col("digits") - F.col("punctuation")
                - F.col("n_symbols") - F.col("spaces") - F.col("wide"),
            ),
        )
        .withColumns(bins)
        .withColumn("w_rest", F.col("n_words") - F.size("hits"))
        .drop("at", "hits", "common")
    )


def _shares(names: list[str]) -> Column:
    total = sum((F.col(n) for n in names), F.lit(0))
    return F.array(*[F.col(n) / F.greatest(total, F.lit(1)) for n in names])


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(F.lit(2.0) * a / (a + b))).otherwise(0.0) + F.when(
            b > 0, b * F.log2(F.lit(2.0) * b / (a + b))
        ).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda total, x: total + x)
    return F.sqrt(F.greatest(F.lit(0.0), divergence / 2))


_WORDS = [f"w{k}" for k in range(WORD_BINS)] + ["w_rest"]


def references(measures: DataFrame) -> DataFrame:
    """Histograms of all these texts taken together, by reference; stored, so that Spark joins by the measured size."""
    summed = measures.groupBy("ref").agg(*[F.sum(n).alias(n) for n in ["n_words", *CLASSES, *_WORDS]])
    shares = summed.select(
        "ref",
        F.col("n_words").alias("ref_words"),
        _shares(CLASSES).alias("ref_classes"),
        _shares(_WORDS).alias("ref_common"),
    )
    return materialize(shares, "quality-references")


def judged(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every row with its base counts, both distances, base_failed and kept.

    The texts are read twice, for the common words and for the measures. Measures are stored once; references and
    comparison read them back. The first references come from all rows that pass the base rule, the final ones
    from those among them that lie near the first, so that junk does not set the standard.
    """
    common = materialize(common_words(docs), "quality-words")
    measures = materialize(measured(docs, common, keep), "quality-measures")
    enough = F.col("ref_words") >= MIN_REFERENCE_WORDS
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    measures = measures.withColumn("base_failed", base_failed)
    passed = measures.filter(~F.col("base_failed"))
    near = passed.join(references(passed), "ref").filter(
        distance(_shares(CLASSES), F.col("ref_classes")) <= FIRST_CLASS_DISTANCE
    )
    compared = measures.join(references(near.select(measures.columns)), "ref", "left")
    return (
        compared.withColumn(
            "class_distance",
            F.when(enough & (F.col("chars") >= MIN_CHARS), distance(_shares(CLASSES), F.col("ref_classes"))),
        )
        .withColumn(
            "word_distance",
            F.when(
                enough & (F.col("n_words") >= MIN_HISTOGRAM_WORDS),
                distance(_shares(_WORDS), F.col("ref_common")),
            ),
        )
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE)
            & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE),
        )
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The input rows that pass."""
    return judged(docs).filter("kept").select("row.*")
