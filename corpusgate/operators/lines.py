"""Line tables, locators and line manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..functions.prefix import explode_runs

KEY = ("doc_id",)


def line_table(
    docs: DataFrame, key: Sequence[str] = KEY, text: str = "text", *, context: tuple[int, int] | None = None
) -> DataFrame:
    """``key, line_no`` (1-based), ``line_off``, ``line_byte_off``, ``physical`` (with its break) and ``line``.

    ``context`` adds ``win`` and ``win_off``, as :func:`explode_runs` does.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(t.PHYSICAL_LINE), F.lit(0))
    d = explode_runs(docs, runs, key, with_bytes=True, context=context)
    return d.select(
        *key,
        (F.col("pos") + 1).alias("line_no"),
        F.col("off").alias("line_off"),
        F.col("byte_off").alias("line_byte_off"),
        F.col("run").alias("physical"),
        F.regexp_replace("run", rf"[{t.BREAK}]+\z", "").alias("line"),
        *(["win", "win_off"] if context else []),
    )


def token_locators(docs: DataFrame, key: Sequence[str] = KEY, text: str = "text", keep_line: bool = True) -> DataFrame:
    """Words with line, column, scalar and byte offset.

    Words never span a line break, so they are cut inside their line: the line is known and no search is needed.
    """
    lines = line_table(docs, key, text)
    keep = [*key, "line_no", "line_off", "line_byte_off", *(["line"] if keep_line else [])]
    runs = F.regexp_extract_all(F.col("physical"), F.lit(t.ANY_RUN), F.lit(0))
    d = explode_runs(lines, runs, keep, with_bytes=True)
    d = d.where(fx.is_word(F.col("run")))
    return d.select(
        *key,
        "line_no",
        (F.col("off") + 1).alias("col_no"),
        (F.col("line_off") + F.col("off")).alias("off"),
        (F.col("line_byte_off") + F.col("byte_off")).alias("byte_off"),
        F.col("run").alias("word"),
        *(["line"] if keep_line else []),
    )


def changed_lines(before: DataFrame, after: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Lines that differ between two versions, each side with bytes and SHA-256; a missing side is NULL."""

    def side(lines: DataFrame, prefix: str) -> DataFrame:
        return lines.select(
            *key, "line_no",
            F.octet_length("line").cast("bigint").alias(f"{prefix}_bytes"),
            fx.sha256_upper(F.col("line")).alias(f"{prefix}_sha256"),
        )

    both = side(before, "predecessor").join(side(after, "successor"), [*key, "line_no"], "full_outer")
    return both.where(~F.col("predecessor_sha256").eqNullSafe(F.col("successor_sha256")))
