"""The blocker scan: which words, elements and structures forbid a projection, by text and for the corpus, failing closed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..operators import markup, pieces
from ..operators.tokens import tokenise
from .projection import materialise

KEY = ("page_id",)
# --- fixed values: states of a scan ---
BLOCKED, READY = "BLOCKED_FAIL_CLOSED", "READY_IN_MEMORY_ONLY"


@dataclass(frozen=True)
class BlockerScan:
    """``issues``: blocked visible words with place and reasons; ``files``: a row a text; ``corpus``: one row."""

    issues: DataFrame
    files: DataFrame
    corpus: DataFrame


def _word_counts(d: DataFrame, key: Sequence[str]) -> list[Column]:
    """Occurrences, surfaces and lower-case forms of all blocked words, of those that cannot be mapped, and of numerals."""
    rows = []
    for name, flag in (("blocked", F.lit(True)), ("unsupported", F.col("mapping")), ("roman_identity_hold", F.col("roman"))):
        rows += [
            F.coalesce(F.sum(F.when(flag, F.col("n"))), F.lit(0)).alias(f"{name}_occurrences"),
            F.count_if(flag).alias(f"unique_{name}_surfaces"), F.count_distinct(F.when(flag, F.col("low"))).alias(f"unique_{name}_lower"),
        ]
    return rows


def scan(pages: DataFrame, roles: markup.Roles, known: DataFrame, key: Sequence[str] = KEY, html: str = "html") -> BlockerScan:
    """Lex and paint once, keep the lexemes, and read every report from them.

    ``known`` lists the elements (``tag``) that the policy speaks of; others block, and so do structure errors, since what they
    enclose may be painted wrongly.  Words are counted by surface before anything is grouped, so a common word is one row of its text.
    """
    lexemes = materialise(pieces.paint_pages(pages, roles, key, html))
    visible = F.col("role").isin(*t.VISIBLE_ROLES) & (F.col("kind") == "text")
    words = tokenise(lexemes.where(visible).select(*key, "start", "role", "run"), [*key, "start", "role"], "run").where("is_word")
    words = words.where(~fx.is_projectable(F.col("run"))).select(
        *key, (F.col("start") + F.col("off")).alias("off"), "role", F.col("run").alias("word"), fx.block_reasons(F.col("run")).alias("_r"))
    issues = words.where(F.size("_r") > 0)
    by_word = issues.groupBy(*key, "word", "_r").agg(F.count("*").alias("n")).select(
        *key, "word", F.lower("word").alias("low"), "n", fx.has_mapping_block(F.col("_r")).alias("mapping"),
        F.array_contains("_r", t.REASON_ROMAN).alias("roman"))
    by_word = materialise(by_word)
    counted = by_word.groupBy(*key).agg(*_word_counts(by_word, key))
    tags = lexemes.where((F.col("kind") == "tag") & F.col("run").rlike("^</?[A-Za-z]")).groupBy(*key, F.col("detail").alias("tag")).agg(F.count("*").alias("n"))
    unknown = tags.join(known.select("tag").distinct(), "tag", "left_anti").groupBy(*key).agg(F.count("*").alias("unknown_elements"))
    errors = markup.structure_errors(markup.lex_html(pages, key, html), key).groupBy(*key).agg(F.count("*").alias("structure_errors"))
    shape = lexemes.groupBy(*key).agg(
        F.max("end").alias("covered"), F.sum(F.when(~F.col("role").isin(*t.VISIBLE_ROLES), F.octet_length("run")).otherwise(0)).alias("protected_bytes"),
        F.sum(F.length("run")).alias("scalars"))
    body = F.coalesce(F.col(html), F.lit(""))
    texts = pages.select(*key, *fx.identity(body), F.length(body).cast("bigint").alias("length"))
    files = texts
    for d in (shape, counted, unknown, errors):
        files = files.join(d, list(key), "left")
    numbers = [c for c in files.columns if c not in (*key, "sha256")]
    files = files.select(*key, "sha256", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers))
    gap_free = (F.col("covered") == F.col("length")) & (F.col("scalars") == F.col("length"))
    stops = (F.col("blocked_occurrences") > 0) | (F.col("unknown_elements") > 0) | (F.col("structure_errors") > 0) | ~gap_free
    files = files.withColumns({"gap_free": gap_free, "status": F.when(stops, BLOCKED).otherwise(READY)}).drop("covered", "scalars")
    files = materialise(files)
    # Over the corpus a surface counts once: texts are summed by surface, and only then is anything told apart.
    over = by_word.groupBy("word", "low", "mapping", "roman").agg(F.sum("n").alias("n"))
    totals = files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("unknown_elements"), F.lit(0)).alias("unknown_elements"),
        F.coalesce(F.sum("structure_errors"), F.lit(0)).alias("structure_errors"), F.count_if(~F.col("gap_free")).alias("coverage_failures"),
        F.count_if(F.col("status") == BLOCKED).alias("blocked_files"))
    both = over.agg(*_word_counts(over, ())).unionByName(totals, allowMissingColumns=True)  # two rows that are one
    corpus = both.agg(*(F.max(c).alias(c) for c in both.columns))
    corpus = corpus.withColumn("status", F.when(F.col("blocked_files") > 0, BLOCKED).otherwise(READY))
    return BlockerScan(issues.select(*key, "off", "role", "word", F.array_join("_r", ",").alias("reasons")), files, corpus)
