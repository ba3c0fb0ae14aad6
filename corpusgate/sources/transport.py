"""Transport checks: byte-level defects that make a text unfit before any of it is read."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


@F.pandas_udf(BooleanType())
def _is_nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda s: None if s is None else unicodedata.is_normalized("NFC", s)).astype(object)


def is_nfc(text: Column) -> Column:
    """NFC test, the one rule Spark has no function for.

    Characters below U+0300 are always normal, so only texts that hold a higher one are handed to Python; for the
    others the argument is NULL and nothing but a null bit crosses over.
    """
    suspect = F.when(text.rlike(r"[\x{0300}-\x{10ffff}]"), text)
    return F.coalesce(_is_nfc(suspect), F.lit(True))


def transport_code(content: Column) -> Column:
    """First defect of a BINARY value, or ``ok``: BOM, CR, no terminal LF, invalid UTF-8, not NFC."""
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    return (
        F.when(F.startswith(content, F.lit(b"\xef\xbb\xbf")), "utf8_bom")
        .when(F.contains(content, F.lit(b"\r")), "non_lf_newline")
        .when(~F.endswith(content, F.lit(b"\n")), "missing_terminal_lf")
        .when(~valid, "invalid_utf8")
        .when(~is_nfc(F.when(valid, text)), "non_nfc")
        .otherwise("ok")
    )


def strict_json_code(text: Column) -> Column:
    """First defect of a JSON text, or ``ok``; duplicate keys count as invalid JSON."""
    return (
        F.when(F.startswith(text, F.lit("\ufeff")) | F.contains(text, F.lit("\r")), "non_canonical_transport")
        .when(~F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\n\n")), "terminal_lf")
        .when(F.try_parse_json(text).isNull(), "invalid_json")
        .otherwise("ok")
    )
