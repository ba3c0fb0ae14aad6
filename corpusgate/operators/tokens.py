"""Tokenising and word censuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..functions.prefix import explode_runs


def tokenise(
    docs: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text", *, context: tuple[int, int] | None = None
) -> DataFrame:
    """Gap-free letter / non-letter runs: ``key, pos, off, run, is_word``.

    Narrow: runs are cut and given their offsets inside the row, so neither tokens nor texts are shuffled.  Runs
    alternate by construction, so one look at the first run settles the kind of all of them.
    """
    first = F.substring(F.col(text), 1, 1).rlike(f"^[{t.LETTER}]").alias("_k_first")
    runs = F.regexp_extract_all(F.col(text), F.lit(t.ANY_RUN), F.lit(0))
    base = docs.select(*key, text, first)
    d = explode_runs(base, runs, [*key, "_k_first"], context=context)
    return d.withColumn("is_word", (F.col("pos") % 2 == 0) == F.col("_k_first")).drop("_k_first")


def words(docs: DataFrame, keep: Sequence[str | Column], text: str = "text") -> DataFrame:
    """Kept columns and ``word``, one row per letter run; the cheap form for counts that need no offset."""
    return docs.select(*keep, F.explode(F.regexp_extract_all(F.col(text), F.lit(t.LETTER_RUN), F.lit(0))).alias("word"))


def blocked_words(docs: DataFrame, keep: Sequence[str | Column], text: str = "text") -> DataFrame:
    """:func:`words` that may not be projected; what stands between them stays one piece and makes no row."""
    parts = F.filter(fx.stretches(F.col(text)), lambda x: ~fx.is_stretch(x))
    return docs.select(*keep, F.explode(parts).alias("word"))


def locate_blocked_words(docs: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``key, off, word`` of every word that may not be projected."""
    d = explode_runs(docs, fx.stretches(F.col(text)), key, wanted=lambda x: ~fx.is_stretch(x))
    return d.select(*key, "off", F.col("run").alias("word"))


def surface_counts(docs: DataFrame, by: Sequence[str], text: str = "text") -> DataFrame:
    """``by, word, n``: the pre-aggregate every word census starts from.

    Counting equal surfaces first means classification runs once per distinct surface, and that a group holding most
    of the corpus is spread over its surfaces before anything is grouped by ``by`` alone.
    """
    return words(docs, by, text).groupBy(*by, "word").agg(F.count("*").alias("n"))


def one_letter_tokens(tokens: DataFrame, letters: Sequence[str]) -> DataFrame:
    """Stand-alone one-letter words out of a given set."""
    return tokens.where(F.col("is_word") & (F.length("run") == 1) & F.col("run").isin(*letters))


def blocked_word_census(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Words, distinct surfaces and block counts per group; the sub-counts overlap by design."""
    n = surface_counts(docs, by).withColumn("low", F.lower("word"))
    reasons = fx.block_reasons(F.col("word"))
    n = n.select(
        *by, "low", "n",
        fx.has_mapping_block(reasons).alias("mapping"),
        fx.is_roman(F.col("word")).alias("roman"),
    )

    def times(flag: Column, alias: str) -> Column:
        return F.sum(F.when(flag, F.col("n")).otherwise(0)).alias(alias)

    low = n.groupBy(*by, "low").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("surfaces"),
        times(F.col("mapping"), "unsupported"),
        times(F.col("roman"), "roman"),
        times(F.col("mapping") | F.col("roman"), "blocked"),
    )
    return low.groupBy(*by).agg(
        F.sum("n").alias("words"),
        F.sum("surfaces").alias("distinct_surfaces"),
        F.count("*").alias("distinct_lower"),
        F.sum("unsupported").alias("unsupported"),
        F.sum("roman").alias("roman"),
        F.sum("blocked").alias("blocked"),
    )


def conversion_census(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Occurrences per conversion class, per group and in total (``NULL`` group)."""
    n = surface_counts(docs, by).withColumn("class", fx.conversion_class(F.col("word")))
    per = n.groupBy(*by, "class").agg(F.sum("n").alias("n"))
    sets = [[*by, "class"], ["class"]]
    return per.groupingSets([[F.col(c) for c in s] for s in sets], *by, "class").agg(F.sum("n").alias("n"))


def issue_type_counts(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """One issue may have several reasons; each reason is counted."""
    n = surface_counts(docs, by)
    return (
        n.select(*by, "n", F.explode(fx.block_reasons(F.col("word"))).alias("reason"))
        .groupBy(*by, "reason")
        .agg(F.sum("n").alias("n"))
    )


def signature_multiset(tokens: DataFrame, by: Sequence[str], word: str = "run") -> DataFrame:
    """Count per ``(by, word, reasons)`` over blocked words; the reasons are one sorted, joined key."""
    n = tokens.groupBy(*by, word).agg(F.count("*").alias("n"))
    n = n.withColumn("reasons", F.array_join(fx.block_reasons(F.col(word)), ","))
    return n.where(F.col("reasons") != "")


def _flagged_counts(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    word = F.col("word")
    return surface_counts(docs, by).select(
        *by, "n", (fx.has_unmapped(word) | fx.has_wrong_script(word)).alias("u"), fx.is_roman(word).alias("r")
    )


def _total(cond: Column, alias: str) -> Column:
    return F.sum(F.when(cond, F.col("n")).otherwise(0)).alias(alias)


def overlapping_inventories(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sub-inventories of blocked words, which overlap, and the identity that ties them together."""
    u, r = F.col("u"), F.col("r")
    out = _flagged_counts(docs, by).groupBy(*by).agg(
        _total(u, "unsupported"), _total(r, "roman"), _total(u & r, "both"), _total(u | r, "blocked")
    )
    return out.withColumn("pass", F.col("blocked") == F.col("unsupported") + F.col("roman") - F.col("both"))


def blocked_rollup(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counters per group, per prefix of the groups, and over the whole corpus."""
    u, r = F.col("u"), F.col("r")
    per = _flagged_counts(docs, by).groupBy(*by).agg(
        F.sum("n").alias("words"), _total(u, "unsupported"), _total(r, "roman"), _total(u | r, "blocked")
    )
    names = ("words", "unsupported", "roman", "blocked")
    return per.rollup(*by).agg(*[F.sum(n).alias(n) for n in names])
