"""Positions of pattern matches, found by cutting the whole text into matches and filler."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..functions.prefix import explode_runs

_NOT_AFTER_LETTER = rf"(?<![{t.LETTER}])"
_CAP, _LET, _SP = t.NAME_CAPITAL, f"[{t.LETTER}]", t.TEX_SPACE

_SURNAME = (
    rf"(?:{t.NAME_PARTICLES}{_SP}+)*{_CAP}{_LET}+(?:[-'’]{_CAP}?{_LET}+)?"
    rf"(?:{_SP}+(?:{t.NAME_PARTICLES}{_SP}+)*{_CAP}{_LET}+)?"
)
INITIAL_NAME = rf"(?:{_CAP}\.{_SP}+)+{_SURNAME}"
#: What is left of such a name behind its first initial's point.
AFTER_INITIAL = rf"{_SP}+(?:{_CAP}\.{_SP}+)*{_SURNAME}"
TWO_CAPITALISED = rf"{_CAP}{_LET}{{2,}}{_SP}+{_CAP}{_LET}{{2,}}"
# --- fixed values: name subtypes, in rank order ---
NAME_SUBTYPES = (("initial_plus_surname", INITIAL_NAME), ("two_capitalized_words", TWO_CAPITALISED))


def name_surfaces(text: Column, pattern: str) -> Column:
    """All matches of a name pattern that do not continue a letter run."""
    return F.regexp_extract_all(text, F.lit(_NOT_AFTER_LETTER + pattern), F.lit(0))


def name_spans(docs: DataFrame, key: Sequence[str], subtype: str, pattern: str, text: str = "text") -> DataFrame:
    """``key, start, end, surface, subtype`` of one name pattern.

    A name starts with a capital, so the filler is a stretch without capitals (ASCII apart, which short ranges
    settle) or one lone character.
    """
    cut = rf"{_NOT_AFTER_LETTER}{pattern}|[\x00-@\[-\x7f]++|[^{_CAP[1:-1]}\x00-\x7f]++|(?s:.)"
    d = explode_runs(
        docs, F.regexp_extract_all(F.col(text), F.lit(cut), F.lit(0)), key,
        wanted=lambda r: (F.length(r) > 1) & r.rlike(f"^{_CAP}"),
    )
    return d.select(
        *key, F.col("off").alias("start"), (F.col("off") + F.length("run")).alias("end"),
        F.col("run").alias("surface"), F.lit(subtype).alias("subtype"),
    )


def lone_letters(docs: DataFrame, key: Sequence[str], letters: Sequence[str], context: tuple[int, int], text: str = "text") -> DataFrame:
    """Letters that no other letter touches: ``key, off, run, win, win_off``.

    The text is cut at the wanted letters only, which are rare, so few rows carry a window.  Every other run that
    starts with such a letter takes what follows it along (a line feed is put after the text for the last one), so a
    run of one wanted letter is a lone letter and nothing else.
    """
    some = "[" + "".join(letters) + "]"
    cut = rf"{_NOT_AFTER_LETTER}{some}(?![{t.LETTER}])|{some}++[^{some[1:-1]}]*+|[^{some[1:-1]}]++"
    return explode_runs(
        docs, F.regexp_extract_all(F.concat(F.col(text), F.lit("\n")), F.lit(cut), F.lit(0)), key, context=context,
        wanted=lambda r: (F.length(r) == 1) & r.rlike(some),
    )


def unit_spans(docs: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """``key, start, end, surface`` of dimension units.

    Filler runs to the next digit or, with a line feed put after the text, to that line feed; so no filler can spell a
    unit, and the run alone tells which it is.
    """
    cut = rf"{fx.UNIT_RUN}|[^0-9]*+[0-9]++|[^0-9]++"
    d = explode_runs(
        docs, F.regexp_extract_all(F.concat(F.col(text), F.lit("\n")), F.lit(cut), F.lit(0)), key,
        wanted=lambda r: r.rlike(rf"(?iu)^(?:true[ \t]*)?(?:{t.UNIT_ALTERNATION})\z"),
    )
    return d.select(
        *key, F.col("off").alias("start"), (F.col("off") + F.length("run")).alias("end"), F.col("run").alias("surface")
    )


def secret_hits(docs: DataFrame, key: Sequence[str], patterns: Sequence[tuple[str, str]] = t.SECRET_PATTERNS, text: str = "text") -> DataFrame:
    """``key, pattern_id, n`` for every secret-like pattern that a text holds; one narrow pass, no pattern join."""
    counts = F.array(*[
        F.struct(F.lit(i).alias("pattern_id"), F.regexp_count(F.col(text), F.lit(p)).cast("bigint").alias("n"))
        for i, p in patterns
    ])
    return docs.select(*key, F.inline(F.filter(counts, lambda c: c["n"] > 0)))
