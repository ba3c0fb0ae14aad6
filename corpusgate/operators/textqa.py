"""Page and text quality jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from .totals import global_running_total

_BLANK = f"^[{t.SPACE}]*\\z"


def split_pages(docs: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Pages cut at form feeds, numbered from 1; trailing blank pages are dropped inside the row."""
    pages = F.split(F.col(text), "\f")
    flags = F.transform(pages, lambda p, i: F.when(~p.rlike(_BLANK), i + 1).otherwise(0))
    last = F.array_max(flags)
    d = docs.select(*key, pages.alias("_p"), last.alias("_n"))
    d = d.select(*key, F.posexplode(F.slice("_p", F.lit(1), F.col("_n"))).alias("_i", "page"))
    return d.select(*key, (F.col("_i") + 1).cast("bigint").alias("page_no"), "page")


def component_boundaries(pages: DataFrame, component: str, page: str, text: str = "text", least: int = 20) -> DataFrame:
    """First and last page number of each component in the whole, and whether both pages carry text.

    Page numbers run over all components in key order.  Per component only counts and the two edge pages' metrics
    are kept, so a component of any length costs one row.
    """
    metric = F.length(F.regexp_replace(text, f"[{t.SPACE}]+", "")).cast("bigint")
    per = pages.select(component, page, metric.alias("_m")).groupBy(component).agg(
        F.count("*").alias("pages"),
        F.min_by("_m", page).alias("first_page_non_whitespace"),
        F.max_by("_m", page).alias("last_page_non_whitespace"),
    )
    d = global_running_total(per, component, "pages", "_before")
    first, last = F.col("first_page_non_whitespace"), F.col("last_page_non_whitespace")
    return d.select(
        component, "pages", (F.col("_before") + 1).alias("first_page"), (F.col("_before") + F.col("pages")).alias("last_page"),
        "first_page_non_whitespace", "last_page_non_whitespace", ((first > least) & (last > least)).alias("pass"),
    )


def sorted_characters(text: Column) -> Column:
    """The characters of a text in order, white space left out: equal for equal character multisets."""
    return F.array_join(F.array_sort(F.split(F.regexp_replace(text, f"[{t.SPACE}]+", ""), "")), "")


def same_characters(left: DataFrame, right: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Page by page: do both sides hold the same characters, whatever their order?"""
    def side(d: DataFrame, name: str) -> DataFrame:
        return d.select(*key, F.sha2(sorted_characters(F.col(text)), 256).alias(name))

    j = side(left, "_a").join(side(right, "_b"), list(key), "full_outer")
    return j.select(*key, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("same"))
