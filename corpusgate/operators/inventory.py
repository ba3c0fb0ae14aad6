"""Inventories of spans that need a disposition, and the policies that give one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions.prefix import context_of
from ..session import stored
from . import matches, spans

KEY = ("doc_id",)
_S = f"[{t.SPACE}]"
COVERED = "PRESERVE_COVERED_BY_ALLOWED_LETTER_FOREIGN_RANGE"
CITATION = "PRESERVE_FOREIGN_INITIAL_OR_CITATION_ABBREVIATION"
DOTTED = "PRESERVE_DOTTED_INITIAL_OR_ROMAN_ORDINAL"
LABEL = "PRESERVE_STRUCTURAL_ROMAN_LABEL"
LEXICAL = "PROJECT_LEXICAL_WORD"


@dataclass(frozen=True)
class NeighbourRule:
    """Gives ``disposition`` to a lone letter if all its patterns hold.

    ``letter`` is the letter itself; ``before`` must match at the end of the text before it, ``after`` at the start of the
    text after it.
    """

    disposition: str
    letter: str | None = None
    before: str | None = None
    after: str | None = None

    def holds(self, letter: Column, before: Column, after: Column) -> Column:
        tests = [letter == self.letter] if self.letter else []
        tests += [before.rlike(f"(?:{self.before})\\z")] if self.before else []
        tests += [after.rlike(f"^(?:{self.after})")] if self.after else []
        return reduce(and_, tests, F.lit(True))


def first_rule(letter: Column, before: Column, after: Column, rules: Sequence[NeighbourRule], default: str) -> Column:
    """Disposition of the first rule that holds."""
    found = [F.when(r.holds(letter, before, after), F.lit(r.disposition)) for r in rules]
    return F.coalesce(*found, F.lit(default))


def label_rules(label_words: Sequence[str]) -> list[NeighbourRule]:
    """Rules for numbering letters, given the words of a language that announce a label; ``*`` ends a stem."""
    def pattern(word: str) -> str:
        return f"\\Q{word.removesuffix('*')}\\E" + (r"[\p{L}\p{N}_]*" if word.endswith("*") else "")

    gap = rf"(?:{_S}|~|\\[,;])*"
    numeral = t.ROMAN_DIGITS
    announced = rf"(?:{'|'.join(map(pattern, label_words))}){_S}*(?:\\(?:emph|textit|textbf)\{{)?{_S}*"
    return [
        NeighbourRule(CITATION, letter="M"),
        NeighbourRule(DOTTED, after=rf"\.{t.TEX_SPACE}*(?:\\foreign\{{)?{t.LABEL_INITIALS}"),
        NeighbourRule(LABEL, after=rf"{_S}*[.:)\]]"),
        *([NeighbourRule(LABEL, before=announced)] if label_words else []),
        NeighbourRule(LABEL, after=rf"{gap}(?:{t.DASHES}|i){_S}*{numeral}"),
        NeighbourRule(LABEL, before=rf"{numeral}{gap}{t.DASHES}{_S}*"),
    ]


def one_letter_inventory(
    docs: DataFrame, protected: DataFrame, rules: Sequence[NeighbourRule], *, letters: Sequence[str] = ("I", "V", "M"),
    key: Sequence[str] = KEY, exact: DataFrame | None = None, default: str = LEXICAL,
) -> DataFrame:
    """Lone letters with their disposition: ``key, off, surface, disposition``.

    ``protected`` holds ranges in any order and overlap; ``exact`` holds locators ``key, off, surface`` that are
    labels whatever stands around them.  Of the rest ``rules`` decide, the first that holds.
    """
    # The window may end with the line feed put after the text: it can only trail, and every rule ignores that.
    tok = matches.lone_letters(docs, key, letters, (120, 121))
    tok = tok.select(
        *key, "off", (F.col("off") + 1).alias("end"), F.col("run").alias("surface"),
        context_of(F.col("off"), 120, 0).alias("before"), context_of(F.col("off") + 1, 0, 120).alias("after"),
    )
    # One character lies inside some range exactly when it lies inside their union.
    tok = spans.flag_covered(tok, spans.merge_ranges(protected, key), key, start="off", end="end")
    rule = F.coalesce(
        F.when(F.col("covered"), F.lit(COVERED)), first_rule(F.col("surface"), F.col("before"), F.col("after"), rules, default)
    )
    if exact is not None:
        tok = tok.join(exact.select(*key, "off", "surface", F.lit(True).alias("exact")).distinct(), [*key, "off", "surface"], "left")
        rule = F.coalesce(F.when(F.col("exact"), F.lit(LABEL)), rule)
    return tok.select(*key, "off", "end", "surface", rule.alias("disposition"))


def keyword_context(locators: DataFrame, word: str, keyword: str) -> DataFrame:
    """Occurrences of a word with ``pass``: does its line hold the keyword, ignoring case?"""
    return locators.where(F.col("word") == word).withColumn("pass", F.contains(F.lower("line"), F.lit(keyword.lower())))


def surface_disposition(rows: DataFrame, policy: DataFrame, *, default: str, surface: str = "surface") -> DataFrame:
    """Disposition of each row from a list of exact surfaces; the default where the list is silent.

    The list is stored first, so that Spark joins by its measured size: a small one leaves the rows where they are, and beside a large
    one only rows of a common surface are split.
    """
    p = stored(policy.groupBy("surface").agg(F.min("disposition").alias("_d")).withColumnRenamed("surface", "_surface"))
    j = rows.join(p, F.col(surface) == F.col("_surface"), "left")
    return j.withColumn("disposition", F.coalesce("_d", F.lit(default))).drop("_d", "_surface")


def payload_disposition(
    rows: DataFrame, line_policy: DataFrame, payload_policy: DataFrame, *, default: str, key: Sequence[str] = KEY,
) -> DataFrame:
    """Line-level rule first, then the exact payload on its line, then the default."""
    lp = line_policy.groupBy(*key, "line_no").agg(F.min("disposition").alias("_line"))
    pp = payload_policy.groupBy(*key, "line_no", "surface").agg(F.min("disposition").alias("_exact"))
    j = rows.join(lp, [*key, "line_no"], "left").join(pp, [*key, "line_no", "surface"], "left")
    return j.withColumn("disposition", F.coalesce("_line", "_exact", F.lit(default))).drop("_line", "_exact")


def summarise(rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Occurrences by text, by surface, by disposition and in total, as one long table."""
    per = rows.groupBy(*key, "surface", "disposition").agg(F.count("*").alias("n"))
    sets = [[F.col(k) for k in key], [F.col("surface")], [F.col("disposition")], []]
    return per.groupingSets(sets, *key, "surface", "disposition").agg(F.sum("n").alias("n"))


def attested_words(visible: DataFrame, islands: DataFrame, word: str = "word") -> DataFrame:
    """Visible words of two or more letters that also occur, whatever their case, inside protected islands.

    The two vocabularies meet first, each word once, counted out where it stands; what they share is stored and measured, and only then
    do the occurrences meet it.  So a stop word is one row of the vocabulary, and its occurrences are shuffled only if the shared
    vocabulary is too large to be sent to them.
    """
    low = F.lower(F.col(word)).alias("_low")
    lexicon = islands.where(F.length(word) >= 2).select(low).distinct()
    shared = stored(visible.where(F.length(word) >= 2).select(low).distinct().join(lexicon, "_low", "left_semi"))
    v = visible.where(F.length(word) >= 2).withColumn("_low", F.lower(F.col(word)))
    return v.join(shared, "_low", "left_semi").drop("_low")
