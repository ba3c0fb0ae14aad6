"""Span algebra over half-open scalar ranges ``(key, start, end)``.

Point-in-span and span-overlap joins are equi-joins on ``(key, bin)`` plus a range predicate: a span is listed in
every bin it touches, so a long text spreads over many keys and no plan falls back to a nested loop.
Whether the span side is broadcast is left to Spark's measured sizes.
Windows are keyed by the text cell; after ranges are reduced to one per start, a cell can hold no more of them than
it has characters, and the cell itself already fits one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions.arrays import inside, slices_of, starts_of, union_of

KEY = ("doc_id",)
BIN = 4096


def _bin(offset: Column) -> Column:
    return F.floor(offset / BIN)


def _list_bins(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    return spans.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start)), _bin(F.greatest(F.col(end) - 1, F.col(start))))))


def merge_ranges(ranges: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Union of ranges; overlapping and touching ranges become one.

    Ranges are shuffled once, to their text, and joined there as one list; a window over single ranges would hold each several times.
    """
    one = ranges.select(*key, "start", "end").repartition(*key).groupBy(*key, "start").agg(F.max("end").alias("end"))
    per = one.groupBy(*key).agg(F.collect_list(F.struct("start", "end")).alias("_r"))
    merged = union_of(F.transform("_r", lambda r: r["start"]), F.transform("_r", lambda r: r["end"]))
    kinds = dict(ranges.dtypes)
    return per.select(*key, F.inline(merged)).select(*key, *(F.col(c).cast(kinds[c]).alias(c) for c in ("start", "end")))


def complement(merged: DataFrame, lengths: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Gaps between merged ranges, from 0 to ``length``; texts without a range are one gap."""
    w = Window.partitionBy(*key).orderBy("start")
    rows = merged.select(*key, "start", "end").unionByName(
        lengths.select(*key, F.col("length").cast("bigint").alias("start"), F.col("length").cast("bigint").alias("end"))
    )
    # The sentinel row sorts last: merged ranges end at or before the text does.
    prev = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    gaps = rows.select(*key, prev.alias("_from"), F.col("start").alias("_to"))
    return gaps.where("_from < _to").select(*key, F.col("_from").alias("start"), F.col("_to").alias("end"))


def locate(
    points: DataFrame, spans: DataFrame, key: Sequence[str], columns: Sequence[str], *, at: str = "off",
    how: str = "left",
) -> DataFrame:
    """Attach the columns of the disjoint span that holds each point."""
    s = _list_bins(spans.select(*key, "start", "end", *columns)).select(
        *[F.col(k).alias(f"_s_{k}") for k in key], F.col("_bin").alias("_s_bin"),
        F.col("start").alias("_s_start"), F.col("end").alias("_s_end"), *columns,
    )
    p = points.withColumn("_bin", _bin(F.col(at)))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in key]
    cond += [F.col("_bin") == F.col("_s_bin"), F.col("_s_start") <= F.col(at), F.col(at) < F.col("_s_end")]
    joined = p.join(s, cond, how)
    return joined.drop("_bin", "_s_bin", *[f"_s_{k}" for k in key])


def flag_covered(
    items: DataFrame, merged: DataFrame, key: Sequence[str] = KEY, *, start: str = "start", end: str = "end",
    flag: str = "covered",
) -> DataFrame:
    """``flag`` is true where an item lies wholly inside one merged range; both ends count as inside."""
    j = locate(items, merged, key, [], at=start)
    return j.withColumn(flag, F.coalesce(F.col(end) <= F.col("_s_end"), F.lit(False))).drop("_s_start", "_s_end")


def words_covered(
    docs: DataFrame, ranges: DataFrame, key: Sequence[str] = KEY, text: str = "text", flag: str = "covered",
) -> DataFrame:
    """``key, off, word`` of every word with ``flag``: does it lie wholly inside one merged range?

    Ranges travel to their text once, as one ordered list, and words are tested in the row; no word is shuffled.
    """
    per = merge_ranges(ranges, key).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_r"))
    d = docs.select(*key, F.col(text).alias("_text")).join(per, list(key), "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    d = d.select(*key, F.regexp_extract_all("_text", F.lit(t.ANY_RUN), F.lit(0)).alias("_runs"), F.coalesce("_r", none).alias("_r"))
    sizes = F.transform("_runs", lambda r: F.length(r).cast("bigint"))
    d = d.withColumns({"_size": sizes, "_at": starts_of(sizes)})
    low, high = F.transform("_r", lambda r: r["start"]), F.transform("_r", lambda r: r["end"])
    d = d.select(*key, "_runs", "_at", inside("_at", "_size", low, high).alias("_in"))
    d = d.select(*key, F.inline(F.arrays_zip("_at", "_runs", "_in"))).where(F.col("_runs").rlike(f"^[{t.LETTER}]"))
    return d.select(*key, F.col("_at").alias("off"), F.col("_runs").alias("word"), F.col("_in").alias(flag))


def overlaps(left: DataFrame, right: DataFrame, key: Sequence[str], right_columns: Sequence[str] = ()) -> DataFrame:
    """Every overlapping pair once: left columns, ``r_start``, ``r_end`` and the right columns."""
    r = _list_bins(right.select(*key, "start", "end", *right_columns)).select(
        *[F.col(k).alias(f"_r_{k}") for k in key], F.col("_bin").alias("_r_bin"),
        F.col("start").alias("r_start"), F.col("end").alias("r_end"), *right_columns,
    )
    le = _list_bins(left)
    cond = [F.col(k) == F.col(f"_r_{k}") for k in key]
    cond += [
        F.col("_bin") == F.col("_r_bin"), F.col("r_start") < F.col("end"), F.col("r_end") > F.col("start"),
        F.col("_bin") == _bin(F.greatest(F.col("start"), F.col("r_start"))),
    ]
    return le.join(r, cond, "inner").drop("_bin", "_r_bin", *[f"_r_{k}" for k in key])


def split_segments(segments: DataFrame, merged: DataFrame, key: Sequence[str] = KEY, *, role: str, detail: str) -> DataFrame:
    """Cut segments at merged ranges: covered fragments take the given role, the rest keep theirs."""
    cols = [*key, "start", "end", "role", "detail"]
    hit = overlaps(segments.select(*cols), merged, key)
    hit = hit.select(
        *cols, F.greatest("start", "r_start").alias("_a"), F.least("end", "r_end").alias("_b")
    )
    w = Window.partitionBy(*key, "start").orderBy("_a")
    prev = F.coalesce(F.lag("_b").over(w), F.col("start"))
    last = F.lead("_a").over(w).isNull()
    piece = lambda s, e, r, d: F.struct(s.alias("s"), e.alias("e"), r.alias("r"), d.alias("d"))
    keep = (F.col("role"), F.col("detail"))
    pieces = F.array(
        piece(F.col("_prev"), F.col("_a"), *keep),
        piece(F.col("_a"), F.col("_b"), F.lit(role), F.lit(detail)),
        F.when(F.col("_last"), piece(F.col("_b"), F.col("end"), *keep)),
    )
    cut = hit.withColumns({"_prev": prev, "_last": last}).select(*key, F.explode(F.array_compact(pieces)).alias("p"))
    cut = cut.where("p.s < p.e").select(
        *key, F.col("p.s").alias("start"), F.col("p.e").alias("end"), F.col("p.r").alias("role"), F.col("p.d").alias("detail")
    )
    whole = segments.select(*cols).join(hit.select(*key, "start").distinct(), [*key, "start"], "left_anti").select(*cols)
    return cut.unionByName(whole)


def coalesce_segments(segments: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Join adjacent segments of equal role and detail; a gap or a change starts a new one."""
    w = Window.partitionBy(*key).orderBy("start")
    same = (
        F.lag("role").over(w).eqNullSafe(F.col("role"))
        & F.lag("detail").over(w).eqNullSafe(F.col("detail"))
        & F.lag("end").over(w).eqNullSafe(F.col("start"))
    )
    d = segments.withColumn("_new", F.when(same, 0).otherwise(1))
    d = d.withColumn("_grp", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        d.groupBy(*key, "_grp", "role", "detail")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("_grp")
    )


def coverage_report(segments: DataFrame, lengths: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Gap-free proof per text: ``gaps``, ``overlaps``, ``first_start``, ``last_end``, ``length`` and ``pass``."""
    w = Window.partitionBy(*key).orderBy("start", "end")
    prev = F.lag("end").over(w)
    d = segments.select(*key, "start", "end", prev.alias("_prev"))
    per = d.groupBy(*key).agg(
        F.count_if(F.col("start") > F.col("_prev")).alias("gaps"),
        F.count_if(F.col("start") < F.col("_prev")).alias("overlaps"),
        F.min("start").alias("first_start"),
        F.max("end").alias("last_end"),
    )
    j = lengths.select(*key, F.col("length").cast("bigint").alias("length")).join(per, list(key), "left")
    ok = (F.col("gaps") == 0) & (F.col("overlaps") == 0) & (F.col("first_start") == 0) & (F.col("last_end") == F.col("length"))
    return j.withColumn("pass", F.coalesce(ok, F.col("length") == 0))


def surfaces(docs: DataFrame, ranges: DataFrame, key: Sequence[str] = KEY, text: str = "text", columns: Sequence[str] = ()) -> DataFrame:
    """Ranges with the text they cover; a text meets its own ranges once, so it is not repeated per range."""
    per = ranges.groupBy(*key).agg(F.collect_list(F.struct("start", "end", *columns)).alias("_r"))
    d = docs.select(*key, text).join(per, list(key))
    d = d.withColumn("_s", slices_of(text, F.transform("_r", lambda r: r["start"]), F.transform("_r", lambda r: r["end"])))
    cut = F.zip_with("_r", "_s", lambda r, s: F.struct(r.alias("r"), s.alias("surface")))
    return d.select(*key, F.inline(cut)).select(*key, "r.*", "surface")
