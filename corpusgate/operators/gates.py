"""Gates: small aggregates that say PASS or name the rows that fail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens


def multiset_violations(observed: DataFrame, permitted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose observed count ``n`` is not reviewed or exceeds the reviewed maximum."""
    p = permitted.select(*key, F.col("n").alias("permitted"))
    j = observed.select(*key, F.col("n").alias("observed")).join(p, list(key), "left")
    kind = F.when(F.col("permitted").isNull(), "UNREVIEWED").when(F.col("observed") > F.col("permitted"), "EXCESS")
    return j.withColumn("violation", kind).where(F.col("violation").isNotNull())


def census_gate(observed: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """One gate row per key of either census: expected, observed, pass; a missing side counts as zero."""
    o = observed.select(*key, F.col("n").alias("observed"))
    e = expected.select(*key, F.col("n").alias("expected"))
    j = o.join(e, list(key), "full_outer")
    j = j.withColumns({"observed": F.coalesce("observed", F.lit(0)), "expected": F.coalesce("expected", F.lit(0))})
    return j.withColumn("pass", F.col("observed") == F.col("expected"))


def readiness(docs: DataFrame, issue_counts: DataFrame, unknown_counts: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """READY only where a text has neither an issue nor an unknown command."""
    d = docs.select(*key).join(issue_counts.select(*key, F.col("n").alias("issues")), list(key), "left")
    if unknown_counts is not None:
        d = d.join(unknown_counts.select(*key, F.col("n").alias("unknown")), list(key), "left")
    else:
        d = d.withColumn("unknown", F.lit(0).cast("bigint"))
    d = d.withColumns({"issues": F.coalesce("issues", F.lit(0)), "unknown": F.coalesce("unknown", F.lit(0))})
    ok = (F.col("issues") == 0) & (F.col("unknown") == 0)
    return d.withColumn("status", F.when(ok, "READY_IN_MEMORY_ONLY").otherwise("BLOCKED_FAIL_CLOSED"))


def duplicates(df: DataFrame, key: Sequence[str], id_col: str) -> DataFrame:
    """Keys held by more than one row, with the count and the smallest id; copies are counted, never gathered."""
    return df.groupBy(*key).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).where("n > 1")


def class_transition(before: DataFrame, after: DataFrame, key: Sequence[str], cls: str = "class") -> DataFrame:
    """Class counts before and after, what entered and left, and whether ``before + entered - left = after``."""
    b = before.select(*key, F.col(cls).alias("_b"))
    a = after.select(*key, F.col(cls).alias("_a"))
    moves = b.join(a, list(key), "full_outer").groupBy("_b", "_a").agg(F.count("*").alias("_n"))
    both = F.array(
        F.struct(F.col("_b").alias("c"), F.lit(True).alias("was"), F.col("_a").eqNullSafe(F.col("_b")).alias("stays")),
        F.struct(F.col("_a").alias("c"), F.lit(False).alias("was"), F.col("_a").eqNullSafe(F.col("_b")).alias("stays")),
    )
    long = moves.select("_n", F.explode(both).alias("m")).where("m.c IS NOT NULL")

    def total(cond):
        return F.sum(F.when(cond, F.col("_n")).otherwise(0))

    was, stays = F.col("m.was"), F.col("m.stays")
    out = long.groupBy(F.col("m.c").alias(cls)).agg(
        total(was).alias("before"), total(~was).alias("after"),
        total(~was & ~stays).alias("entered"), total(was & ~stays).alias("left"),
    )
    return out.withColumns({
        "delta": F.col("after") - F.col("before"),
        "pass": F.col("before") + F.col("entered") - F.col("left") == F.col("after"),
    })


def key_differences(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that only one side holds; empty when the two key sets are equal."""
    one = left.select(*key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    two = right.select(*key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    d = one.unionByName(two).groupBy(*key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r")).where("_l <> _r")
    return d.select(*key, F.when(F.col("_l") == 1, "left_only").otherwise("right_only").alias("side"))


def multiset_differences(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose number of occurrences differs between two row streams; empty when the multisets are equal.

    One union and one aggregate, combined before the shuffle, instead of two ``EXCEPT ALL`` passes.
    """
    one = left.select(*columns, F.lit(1).cast("bigint").alias("_l"), F.lit(0).cast("bigint").alias("_r"))
    two = right.select(*columns, F.lit(0).cast("bigint").alias("_l"), F.lit(1).cast("bigint").alias("_r"))
    d = one.unionByName(two).groupBy(*columns).agg(F.sum("_l").alias("left_n"), F.sum("_r").alias("right_n"))
    return d.where("left_n <> right_n")


def word_differences(left: DataFrame, right: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """:func:`multiset_differences` of the words of two editions of texts.

    Texts meet by their key before they are cut, so no word is shuffled, and texts that are the same on both sides are not cut at all.
    """
    both = left.select(*key, F.col(text).alias("_a")).unionByName(right.select(*key, F.col(text).alias("_b")), allowMissingColumns=True)
    per = both.groupBy(*key).agg(F.array_sort(F.collect_list("_a")).alias("_a"), F.array_sort(F.collect_list("_b")).alias("_b")).where("_a <> _b")
    side = lambda c, n: F.transform(c, lambda x: F.struct(x.alias("text"), F.lit(n).alias("_left")))
    d = per.select(*key, F.inline(F.concat(side("_a", True), side("_b", False))))
    words = tokens.words(d, [*key, "_left"])
    out = words.groupBy(*key, "word").agg(F.count_if("_left").alias("left_n"), F.count_if(~F.col("_left")).alias("right_n"))
    return out.where("left_n <> right_n")
