"""Scalar text functions as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables as t

# The full class costs tens of comparisons per character, so plain ASCII words are settled by short classes first.
_ASCII_WORD = "^[a-zA-Z]+$"
_ASCII_SUPPORTED = "^[a-pr-vyzA-PR-VYZ]+$"
_ASCII_UNMAPPED = "[qwxQWX]"
_SUPPORTED_WORD = f"^[{t.SUPPORTED}]+$"
_HAS_UNMAPPED = rf"[^{t.SUPPORTED}\p{{IsCyrillic}}]"


def sha256_upper(value: Column) -> Column:
    return F.upper(F.sha2(value, 256))


def identity(value: Column) -> list[Column]:
    """Byte count and SHA-256 of a text or binary value."""
    return [F.octet_length(value).cast("bigint").alias("bytes"), sha256_upper(value).alias("sha256")]


# ---- words ---------------------------------------------------------------------------------------------------

def is_word(run: Column) -> Column:
    return run.rlike(f"^{t.LETTER_RUN}$")


def is_roman(word: Column) -> Column:
    """Canonical upper-case numeral of two or more letters; one-letter words are ordinary words."""
    return word.rlike(f"^{t.ROMAN_DIGITS}{{2,15}}$") & word.rlike(f"^{t.ROMAN}$")


def has_unmapped(word: Column) -> Column:
    return word.rlike(_ASCII_UNMAPPED) | (~word.rlike(_ASCII_WORD) & word.rlike(_HAS_UNMAPPED))


def has_wrong_script(word: Column) -> Column:
    return word.rlike(r"\p{IsCyrillic}")


def block_reasons(word: Column) -> Column:
    """Sorted reasons why a word may not be projected; empty when it may."""
    reasons = F.array(
        F.when(is_roman(word), F.lit(t.REASON_ROMAN)),
        F.when(has_unmapped(word), F.lit(t.REASON_UNMAPPED)),
        F.when(has_wrong_script(word), F.lit(t.REASON_SCRIPT)),
    )
    return F.array_compact(reasons)


def has_mapping_block(reasons: Column) -> Column:
    return F.arrays_overlap(reasons, F.array(*[F.lit(r) for r in t.MAPPING_REASONS]))


def is_projectable(run: Column) -> Column:
    """True for a word with no block reason; false for blocked words and for everything that is not a word."""
    supported = run.rlike(_ASCII_SUPPORTED) | (~run.rlike(_ASCII_UNMAPPED) & run.rlike(_SUPPORTED_WORD))
    return supported & ~is_roman(run)


def simplify(word: Column) -> Column:
    """Reduce etymological letters to their plain spelling."""
    out = F.translate(word, "".join(t.ONE_TO_ONE_REDUCTIONS), "".join(t.ONE_TO_ONE_REDUCTIONS.values()))
    return F.replace(F.replace(out, F.lit("đ"), F.lit("dž")), F.lit("Đ"), F.lit("DŽ"))


def project_word(word: Column) -> Column:
    """Latin to Cyrillic for a projectable word.

    One ``translate`` maps every single letter (etymological letters straight to their plain letter's image); the
    digraphs are then repaired on the Cyrillic side, where their letter-by-letter image is unambiguous because no
    projectable word holds Cyrillic letters of its own.
    """
    letters = dict(t.LATIN_TO_CYRILLIC)
    letters.update({k: t.LATIN_TO_CYRILLIC[v] for k, v in t.ONE_TO_ONE_REDUCTIONS.items()})
    out = F.translate(word, "".join(letters), "".join(letters.values()))
    repairs = [("đ", "дж"), ("Đ", "ДЖ"), ("дЖ", "дж")]
    for pair, one in (("лј", "љ"), ("нј", "њ")):
        a, b = pair
        repairs += [(a + b, one), (a.upper() + b, one.upper()), (a.upper() + b.upper(), one.upper()), (a + b.upper(), one)]
    for old, new in repairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def conversion_class(word: Column) -> Column:
    return (
        F.when(~is_projectable(word), "blocked")
        .when(simplify(word) != word, "converted_after_simplification")
        .otherwise("converted_standard")
    )


def rewrite_words(text: Column, rewrite, allowed=is_projectable) -> Column:
    """Rewrite every allowed letter run of a text in place; all other characters stay as they are."""
    runs = F.regexp_extract_all(text, F.lit(t.ANY_RUN), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(allowed(r), rewrite(r)).otherwise(r)), "")


# Java looks a class of single ASCII characters up in a table, but tests ranges and other members one by one.
_LETTERS = "".join(c for c in t.SUPPORTED if ord(c) < 128)
_BETWEEN = "".join(rf"\x{{{i:x}}}" for i in range(128) if not chr(i).isalpha())
_OTHER_SUPPORTED = "".join(c for c in t.SUPPORTED if ord(c) > 127)
_PROJECTABLE_WORD = (
    rf"(?!(?={t.ROMAN_DIGITS}{{2,15}}(?![{t.LETTER}])){t.ROMAN}(?![{t.LETTER}]))"
    rf"(?:[{_LETTERS}]++|(?![\x00-\x7f])[{_OTHER_SUPPORTED}])++(?:(?=[{_BETWEEN}])|(?![{t.LETTER}]))"
)
# Projectable words and what stands between them, as far as the next blocked word; then that word.
_STRETCH = rf"(?:[{_BETWEEN}]++|{_PROJECTABLE_WORD}|[^{t.LETTER}]++)++"
_STRETCH_OR_BLOCKED = rf"{_STRETCH}|[{t.LETTER}]++"
_IS_STRETCH = rf"^(?:[^{t.LETTER}]|{_PROJECTABLE_WORD})"


def project_text(text: Column) -> Column:
    """Every projectable word of a text projected.

    A stretch without a blocked word is projected at once: only letters change, and digraphs do not reach over a word's edge.
    """
    return F.array_join(F.transform(stretches(text), lambda x: F.when(is_stretch(x), project_word(x)).otherwise(x)), "")


def stretches(text: Column) -> Column:
    """A text cut into blocked words and the stretches between them."""
    return F.regexp_extract_all(text, F.lit(_STRETCH_OR_BLOCKED), F.lit(0))


def stretches_beside(apart: str) -> str:
    """The pattern of :func:`stretches` that also ends before a word at which ``apart`` matches."""
    return rf"(?:[{_BETWEEN}]++|(?!{apart}){_PROJECTABLE_WORD}|[^{t.LETTER}]++)++|[{t.LETTER}]++"


def is_stretch(part: Column) -> Column:
    """Its first character or word tells: a part of :func:`stretches` that begins with a blocked word is that word."""
    return part.rlike(_IS_STRETCH)


# ---- units -----------------------------------------------------------------------------------------------------

_WORD_EDGE = rf"(?![{t.LETTER}\p{{Nd}}_])"
UNIT_RUN = rf"(?iu)(?<=[0-9])(?:true[ \t]*)?(?:{t.UNIT_ALTERNATION}){_WORD_EDGE}"
PROJECTED_UNIT_RUN = rf"(?iu)(?<=[0-9])(?:труе[ \t]*)?(?:{t.PROJECTED_UNIT_ALTERNATION}){_WORD_EDGE}"


def dimension_units(text: Column) -> Column:
    """Units that directly follow a digit, with an optional ``true``; every occurrence in order."""
    return F.regexp_extract_all(text, F.lit(UNIT_RUN), F.lit(0))


def has_projected_units(text: Column) -> Column:
    return text.rlike(PROJECTED_UNIT_RUN)


# ---- text quality ------------------------------------------------------------------------------------------------

def nonletter_signature(text: Column) -> Column:
    """SHA-256 of what is left when letters and marks are taken out; equal across scripts."""
    return sha256_upper(F.regexp_replace(text, r"[\p{L}\p{M}]+", ""))


def script_census(text: Column) -> list[Column]:
    return [
        F.regexp_count(text, F.lit(r"[\p{IsLatin}&&\p{L}]")).cast("bigint").alias("latin"),
        F.regexp_count(text, F.lit(r"[\p{IsCyrillic}&&\p{L}]")).cast("bigint").alias("cyrillic"),
    ]


def _count_literal(text: Column, literal: str) -> Column:
    """Non-overlapping occurrences, from the length lost when they are removed: no regex needed."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)).cast("bigint")


def integrity_metrics(text: Column) -> list[Column]:
    return [
        F.length(text).cast("bigint").alias("characters"),
        F.length(F.regexp_replace(text, f"[{t.SPACE}]+", "")).cast("bigint").alias("non_whitespace"),
        _count_literal(text, "\ufffd").alias("replacement_characters"),
        _count_literal(text, "\f").alias("form_feeds"),
    ]


def phrase_hits(text: Column, phrases: Sequence[str]) -> Column:
    """The phrases a text contains, ignoring case, in list order."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p.lower())), F.lit(p)) for p in phrases]))


def fatal_patterns(text: Column) -> Column:
    return phrase_hits(text, t.FATAL_PHRASES)


def warning_summary(text: Column) -> list[Column]:
    low = F.lower(text)

    def guarded(word: str, trigger: str) -> Column:
        return F.when(F.contains(low, F.lit(trigger)), _count_literal(low, word)).otherwise(F.lit(0).cast("bigint"))

    return [
        _count_literal(low, "missing character:").alias("missing_character"),
        guarded("reference", "there were undefined references").alias("undefined_reference"),
        guarded("citation", "there were undefined citations").alias("undefined_citation"),
        _count_literal(low, "overfull \\hbox").alias("overfull_hbox"),
        _count_literal(low, "overfull \\vbox").alias("overfull_vbox"),
    ]


# ---- member names and fields -------------------------------------------------------------------------------------

def is_forbidden_name(path: Column, fragments: Sequence[str]) -> Column:
    return F.size(phrase_hits(path, fragments)) > 0


def is_unsafe_path(path: Column) -> Column:
    return F.startswith(path, F.lit("/")) | F.array_contains(F.split(path, "/"), "..")


def first_truthy(*fields: Column, default: str) -> Column:
    """First field that is neither null nor empty, as the ``or`` chain reads."""
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in fields], F.lit(default))


def canonical_json(**fields: Column) -> Column:
    """Compact JSON object with sorted keys and a terminal line feed; null members are written as ``null``."""
    members = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return F.concat(F.to_json(members, {"ignoreNullFields": "false"}), F.lit("\n"))
