"""Quality rules by distribution divergence, in SQL functions only.

A document is compared with a reference of its language (the value of the ``lang`` column; null is
a language of its own) by the Jensen-Shannon distance (base 2, so 0 to 1) of two histograms:

* character classes: upper-case letters, other letters, digits, white space, symbols, the rest;
* common words: one bin for each of the words that most documents of the language have, one for all other
  words. These words are learned from the table itself, whatever its languages are: lower case (A to Z),
  without ``PUNCTUATION``, by the number of documents, then in code-point order.

References are sums over the documents of a language that pass the base rules. Documents or references
that are too short to say anything are not judged by that histogram (the guards below). Rows with null or empty text have
no words and fail the base rules; null ``lang`` or ``doc_id`` are ordinary values; repeated rows are
judged one by one; very long texts are one row's arrays. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.llm.frames import boxed, unboxed, words_of
from vanewatch.session import materialized

WINDOW = 8
#: Characters that do not belong to a word when words are compared over documents.
PUNCTUATION = ".,;:!?\"'()[]{}"
#: Common words of a language.
COMMON = 16
#: Dup hashes of a text up to which windows are looked up one by one; above, they are sorted.
FEW = 64


@dataclass(frozen=True)
class Limits:
    least_words: int = 20
    #: most percent of words in repeated windows
    repeat_percent: int = 30
    #: guards: a document's characters and words, and a reference's words
    guard_chars: int = 400
    guard_words: int = 128
    guard_reference: int = 5_000
    #: greatest Jensen-Shannon distances of a document that stays
    class_distance: float = 0.28
    word_distance: float = 0.27


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _left(text: Column, pattern: str) -> Column:
    """Code points that remain after deleting a pattern."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def _pairs(hashes: Column, apart: int) -> Column:
    """Hash of each element with the one ``apart`` places later; the last ``apart`` are to be cut."""
    later = F.slice(hashes, apart + 1, F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))


def _first(hashes: Column, n: Column) -> Column:
    return F.slice(hashes, 1, F.greatest(n, F.lit(0)).cast("int"))


def _repeats(hashes: Column) -> Column:
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def _repeated_values(hashes: Column) -> Column:
    ordered = F.sort_array(hashes)
    equal = F.zip_with(
        ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.when(a == b, a)
    )
    return F.array_distinct(F.filter(equal, lambda h: h.isNotNull()))


def _starts_by_lookup(windows: Column, again: Column) -> Column:
    marked = F.transform(windows, lambda h, i: F.when(F.array_contains(again, h), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _starts_by_sort(windows: Column) -> Column:
    """Places of windows that have an equal one: neighbours after sorting (hash, place)."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before = F.concat(nothing, F.slice(ordered, 1, F.size(ordered) - 1))
    after = F.concat(F.slice(ordered, 2, F.size(ordered)), nothing)
    second = F.zip_with(ordered, before, lambda x, y: F.when(x["h"] == y["h"], x["i"]))
    first = F.zip_with(ordered, after, lambda x, y: F.when(x["h"] == y["h"], x["i"]))
    both = F.array_distinct(F.concat(first, second))
    return F.sort_array(F.filter(both, lambda i: i.isNotNull()))


def _covered(starts: Column) -> Column:
    """Words under windows that start at the given places, in ascending order."""
    gaps = F.zip_with(
        starts,
        F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)


def plain_words(text: Column) -> Column:
    """Words in lower case without punctuation."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return words_of(F.translate(text, upper + PUNCTUATION, lower + " " * len(PUNCTUATION)))


def common_words(texts: DataFrame, most: int = COMMON) -> DataFrame:
    """(common_lang, common): hashes of the words that most documents of a language have; stored.

    A document counts once for a word, however often it repeats it.
    """
    found = texts.select("_lang", F.explode(F.array_distinct(plain_words(F.col("_text")))).alias("word"))
    counts = found.groupBy("_lang", "word").agg(F.count(F.lit(1)).alias("n"))
    # Spark keeps ``most`` rows a language in each task before the shuffle
    first = counts.selectExpr("*", "row_number() over (partition by _lang order by n desc, word) as place").where(F.col("place") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("place", F.xxhash64("word").alias("h"))))
    lists = first.groupBy(F.col("_lang").alias("common_lang")).agg(ordered.getField("h").alias("common"))
    return materialized(lists, "common")


def _hits(hashes: Column, wanted: Column) -> Column:
    """How often each wanted word occurs."""
    return F.transform(wanted, lambda h: (F.size(hashes) - F.size(F.array_remove(hashes, h))).cast("bigint"))


def with_histograms(df: DataFrame, common: DataFrame) -> DataFrame:
    """From ``_text``: word count, base counts and both histograms; ``_hashes`` are the words' hashes."""
    text, words = F.col("_text"), F.col("_words")
    # one row a language: Spark broadcasts it by its written size, or else splits hot languages
    df = df.join(common, F.col("_lang").eqNullSafe(F.col("common_lang")), "left").drop("common_lang")
    df = df.withColumns({"_words": words_of(text), "_plain": plain_words(text)})
    df = df.withColumns(
        {
            "_hashes": F.transform(words, lambda w: F.xxhash64(w)),
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": F.length(text).cast("bigint") - _left(text, r"[#*$%&|<>]+"),
            "_upper": _left(text, r"[^\p{Lu}]+"),
            "_letters": _left(text, r"\P{L}+"),
            "_digits": _left(text, r"\P{Nd}+"),
            "_plain": F.transform("_plain", lambda w: F.xxhash64(w)),
        }
    ).drop("_words")
    space = F.length(text).cast("bigint") - F.col("word_chars")
    rest = F.col("word_chars") - F.col("_letters") - F.col("_digits") - F.col("n_symbols")
    shape = [F.col("_upper"), F.col("_letters") - F.col("_upper"), F.col("_digits"), space]
    df = df.withColumns(
        {
            "_shape": F.array(*shape, F.col("n_symbols"), rest),
            "_hits": F.coalesce(_hits(F.col("_plain"), F.col("common")), F.array().cast("array<bigint>")),
        }
    )
    known = F.aggregate("_hits", F.lit(0).cast("bigint"), lambda s, n: s + n)
    others = F.array(F.size("_plain").cast("bigint") - known)
    # languages with fewer words have empty bins
    empty = F.array_repeat(F.lit(0).cast("bigint"), F.lit(COMMON) - F.size("_hits"))
    return df.withColumn("_hits", F.concat("_hits", empty, others)).drop("_upper", "_letters", "_digits", "_plain", "common")


def with_repeats(df: DataFrame) -> DataFrame:
    """From ``_text`` and ``_hashes``: repeated lines and words in repeated windows.

    A run of eight words is hashed from word hashes, combined by doubling. Eight equal words hold four
    equal ones, so the last doubling is left out for texts without a repeated run of four.
    """
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.col("n_words")
    df = df.withColumns({"_lines": lines, "_two": _pairs(F.col("_hashes"), 1)}).drop("_hashes")
    df = df.withColumn("_four", _pairs(F.col("_two"), 2)).drop("_two")
    eight = F.when(
        (n > WINDOW) & _repeats(_first(F.col("_four"), n - 3)),
        _first(_pairs(F.col("_four"), 4), n - (WINDOW - 1)),
    )
    df = df.withColumn("_windows", eight).drop("_four")
    df = df.withColumn(
        "_again", F.when(_repeats(F.col("_windows")), _repeated_values(F.col("_windows")))
    )
    starts = F.when(
        F.size("_again") <= FEW, _starts_by_lookup(F.col("_windows"), F.col("_again"))
    ).otherwise(_starts_by_sort(F.col("_windows")))
    df = df.withColumn("_starts", F.when(F.col("_again").isNotNull(), starts))
    return df.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": F.when(F.col("_starts").isNotNull(), _covered(F.col("_starts")))
            .otherwise(0)
            .cast("bigint"),
        }
    ).drop("_lines", "_windows", "_again", "_starts")


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )


def references(figures: DataFrame, limits: Limits) -> DataFrame:
    """One row per language: the sums of ``_shape`` and ``_hits`` and the words of the documents that pass the base rules."""

    def sums(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.col(name)[i]) for i in range(size)])

    return figures.where(~base_failed(limits)).groupBy(F.col("_lang").alias("ref_lang")).agg(
        F.sum("n_words").alias("ref_total"),
        sums("_shape", 6).alias("ref_shape"),
        sums("_hits", COMMON + 1).alias("ref_hits"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts of equal length; null for an empty one."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double"))

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def share(x: Column) -> Column:
        whole = total(x)
        return F.transform(x, lambda v: v / whole)

    parts = F.zip_with(share(p), share(q), lambda a, b: (term(a, b) + term(b, a)) / 2)
    distance = F.sqrt(F.greatest(total(parts), F.lit(0.0)))
    return F.when((total(p) > 0) & (total(q) > 0), distance)


def _with_verdict(df: DataFrame, refs: DataFrame, limits: Limits) -> DataFrame:
    df = df.join(refs, F.col("_lang").eqNullSafe(F.col("ref_lang")), "left")
    known = F.coalesce(F.col("ref_total") >= limits.guard_reference, F.lit(False))
    n_chars = F.aggregate("_shape", F.lit(0).cast("bigint"), lambda s, n: s + n)
    df = df.withColumns(
        {
            "class_distance": F.when(
                known & (n_chars >= limits.guard_chars),
                js_distance(F.col("_shape"), F.col("ref_shape")),
            ),
            "word_distance": F.when(
                known & (F.col("n_words") >= limits.guard_words),
                js_distance(F.col("_hits"), F.col("ref_hits")),
            ),
        }
    )
    near = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= limits.class_distance) & (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) <= limits.word_distance
    )
    df = df.withColumn("base_failed", base_failed(limits)).withColumn("kept", ~F.col("base_failed") & near)
    return df.drop("ref_lang", "ref_total", "ref_shape", "ref_hits", "_shape", "_hits", "_lang")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("_row.text"), F.lit("")).alias("_text")
    return boxed(docs).select("_row", text, F.col("_row.lang").alias("_lang"))


def judged(docs: DataFrame, row: Column, limits: Limits) -> DataFrame:
    """``row`` of each document with the base figures, both distances and ``kept``.

    Texts are read twice: for the common words, and for the figures. These are stored; the references and
    then the verdicts come from there.
    """
    texts = _texts(docs)
    df = with_repeats(with_histograms(texts, common_words(texts)))
    figures = materialized(df.select(row, *BASE, "_lang", "_shape", "_hits"), "figures")
    # one row a language: Spark broadcasts it by its written size, or else splits hot languages
    refs = materialized(references(figures, limits), "references")
    return _with_verdict(figures, refs, limits)


def quality_verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: doc_id, the base figures, both distances and ``kept``."""
    return judged(docs, F.col("_row.doc_id").alias("doc_id"), limits)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that the rules keep, with all their columns; they are stored with their figures."""
    df = judged(docs, F.col("_row"), limits).where("kept")
    return df.select(*unboxed(df, docs.columns))
