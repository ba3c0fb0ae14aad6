"""Pins, manifests and approvals: exact comparison of two keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..functions.arrays import bytes_before, hashes_of, line_starts, place_of, slices_of


def identity_table(df: DataFrame, path: Column, value: Column) -> DataFrame:
    """``path, bytes, sha256`` of every member."""
    return df.select(path.alias("path"), *fx.identity(value))


def verify_pins(observed: DataFrame, expected: DataFrame, key: Sequence[str] = ("path",)) -> DataFrame:
    """Status of every pinned or present member: MATCH, DRIFT, MISSING or UNEXPECTED."""
    o = observed.select(*key, F.struct("bytes", "sha256").alias("o"))
    e = expected.select(*key, F.struct("bytes", "sha256").alias("e"))
    status = (
        F.when(F.col("o").isNull(), "MISSING")
        .when(F.col("e").isNull(), "UNEXPECTED")
        .when(F.col("o") == F.col("e"), "MATCH")
        .otherwise("DRIFT")
    )
    return o.join(e, list(key), "full_outer").select(
        *key, status.alias("status"),
        F.col("e.bytes").alias("expected_bytes"), F.col("o.bytes").alias("observed_bytes"),
        F.col("e.sha256").alias("expected_sha256"), F.col("o.sha256").alias("observed_sha256"),
    )


def topology_difference(observed: DataFrame, expected: DataFrame, key: Sequence[str] = ("path",)) -> DataFrame:
    """Keys on one side only; empty when both hold exactly the same set."""
    missing = expected.select(*key).join(observed.select(*key), list(key), "left_anti").withColumn("side", F.lit("missing"))
    extra = observed.select(*key).join(expected.select(*key), list(key), "left_anti").withColumn("side", F.lit("unexpected"))
    return missing.unionByName(extra)


def match_approvals(issues: DataFrame, approvals: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Exact two-way match of issues and approvals.

    Status per key: MATCH, FIELD_DRIFT, UNAPPROVED (issue without approval), STALE (approval without issue) or
    DUPLICATE (the key is approved more than once).  ``drift`` names the fields that differ.
    """
    a = approvals.groupBy(*key).agg(
        F.count("*").alias("_n"), *[F.min(f).alias(f"_a_{f}") for f in fields]
    )
    j = issues.select(*key, *fields, F.lit(True).alias("_i")).join(a, list(key), "full_outer")
    drift = F.array_compact(F.array(*[
        F.when(~F.col(f).eqNullSafe(F.col(f"_a_{f}")), F.lit(f)) for f in fields
    ]))
    status = (
        F.when(F.col("_n") > 1, "DUPLICATE")
        .when(F.col("_n").isNull(), "UNAPPROVED")
        .when(F.col("_i").isNull(), "STALE")
        .when(F.size(drift) > 0, "FIELD_DRIFT")
        .otherwise("MATCH")
    )
    both = F.col("_i").isNotNull() & F.col("_n").isNotNull()
    return j.select(*key, status.alias("status"), F.when(both, F.array_join(drift, ",")).alias("drift"))


def partition_issues(issues: DataFrame, approvals: DataFrame, key: Sequence[str]) -> DataFrame:
    """Issues with ``approved``: one equi-join instead of a semi and an anti pass."""
    a = approvals.select(*key, F.lit(True).alias("_a")).distinct()
    return issues.join(a, list(key), "left").withColumn("approved", F.col("_a").isNotNull()).drop("_a")


LOCATOR_FIELDS = ("surface", "surface_sha256", "line_no", "col_no", "byte_off", "line_sha256", "context_sha256")


def manifests(rows: DataFrame, docs: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``key, manifest``: what a text holds at each row's ``start, end``, as one list: surface, hashes, line, column, byte offset.

    The rows of a text travel to it once, as one list; lines are measured and hashed once, not shuffled, and not repeated for each row
    on them, since one line may be the whole text.  Rows outside the text, or without one, keep nulls.
    """
    span = F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    per = rows.groupBy(*key).agg(F.array_sort(F.collect_list(span)).alias("_rows"))
    return _told(per.join(docs.select(*key, F.col(text).alias("_text")), list(key), "left"), key, "manifest")


def _told(d: DataFrame, key: Sequence[str], name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``key, keep`` and, as ``name``, what ``_text`` holds at ``_rows``, in their order."""
    d = d.withColumn("_lines", F.regexp_extract_all("_text", F.lit(t.PHYSICAL_LINE), F.lit(0)))
    sizes = F.transform("_lines", lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("b")))
    shas = F.transform("_lines", lambda x: fx.sha256_upper(F.regexp_replace(x, rf"[{t.BREAK}]+\z", "")))
    d = d.select(*key, *keep, "_rows", "_text", line_starts(sizes).alias("_starts"), shas.alias("_shas"), F.length("_text").cast("bigint").alias("_end"))
    d = d.withColumn("_line", place_of(F.transform("_rows", lambda r: r["start"]), F.transform("_starts", lambda x: x["at"])))

    def begin(n: Column) -> Column:
        return F.get("_starts", n)["at"]

    def of_rows(f) -> Column:
        return F.transform("_rows", f)

    d = d.withColumns({
        "_s": slices_of("_text", of_rows(lambda r: r["start"]), of_rows(lambda r: r["end"])),
        "_near": hashes_of("_text", of_rows(lambda r: r["start"] - 80), of_rows(lambda r: r["start"] + 160)),
        "_byte": bytes_before("_text", of_rows(lambda r: F.coalesce(r["start"], F.lit(0)))),
    })

    def told(r: Column, i: Column) -> Column:
        n = F.get("_line", i)
        there = F.coalesce(r["start"] < F.col("_end"), F.lit(False)) & (n >= 0)
        surface = F.get("_s", i)
        fields = {
            "surface": surface, "surface_sha256": fx.sha256_upper(surface), "line_no": (n + 1).cast("bigint"), "col_no": r["start"] - begin(n) + 1,
            "byte_off": F.get("_byte", i), "line_sha256": F.get("_shas", n), "context_sha256": F.get("_near", i),
        }
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), *(F.when(there, v).alias(k_) for k_, v in fields.items()))

    return d.select(*key, *keep, of_rows(told).alias(name))


def locate_manifest(rows: DataFrame, docs: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """:func:`manifests` as rows."""
    return manifests(rows, docs, key, text).select(*key, F.inline("manifest"))


def stale_in_text(told: DataFrame, docs: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Rows of :func:`manifests` with the locator fields that no longer hold in the current text, comma-joined.

    Only the current text travels; what it holds now is compared in its row.
    """
    d = told.join(docs.select(*key, F.col(text).alias("_text")), list(key), "left")
    d = d.withColumn("_rows", F.transform("manifest", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))
    d = _told(d, key, "_now", ["manifest"])

    def judged(m: Column, i: Column) -> Column:
        now = F.get("_now", i)
        drift = F.array_compact(F.array(*[F.when(~m[f].eqNullSafe(now[f]), F.lit(f)) for f in LOCATOR_FIELDS]))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["surface"].alias("surface"), F.array_join(drift, ",").alias("drift"))

    # An inner generator would have Spark put a test of its list below the walks, and cut every text twice.
    return d.select(*key, F.explode_outer(F.transform("manifest", judged)).alias("_r")).where("_r IS NOT NULL").select(*key, "_r.*")


def stale_locators(manifest: DataFrame, docs: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """:func:`stale_in_text` of a manifest that is given as rows."""
    fields = F.struct("start", "end", *LOCATOR_FIELDS)
    return stale_in_text(manifest.groupBy(*key).agg(F.collect_list(fields).alias("manifest")), docs, key)


def companions(
    decisions: DataFrame, sidecars: DataFrame, key: str, suffix: str, suffixes: Sequence, value: Column
) -> DataFrame:
    """Sidecars of each decision, one column per known suffix (NULL if missing), and how many have an unlisted suffix.

    The suffix list is closed, so each decision keeps a fixed number of values however many sidecar rows name it.
    """
    listed = F.coalesce(F.col(suffix).isin(*suffixes), F.lit(False))
    per = sidecars.groupBy(key).agg(*[
        F.max(F.when(F.col(suffix) == s, value)).alias(f"companion_{s}") for s in suffixes
    ], F.count_if(~listed).alias("unlisted"))
    names = [f"companion_{s}" for s in suffixes]
    j = decisions.join(per, key, "left")
    count = sum((F.col(n).isNotNull().cast("bigint") for n in names), F.lit(0).cast("bigint"))
    return j.withColumns({"companion_count": count, "unlisted": F.coalesce("unlisted", F.lit(0))})


def reconcile_counts(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Counts ``n`` of two censuses side by side, with what was added, removed and the net change."""
    b = before.select(*key, F.col("n").alias("_b"))
    a = after.select(*key, F.col("n").alias("_a"))
    n_b, n_a = F.coalesce("_b", F.lit(0)), F.coalesce("_a", F.lit(0))
    return b.join(a, list(key), "full_outer").select(
        *key, n_b.alias("before"), n_a.alias("after"),
        F.greatest(n_a - n_b, F.lit(0)).alias("added"), F.greatest(n_b - n_a, F.lit(0)).alias("removed"),
        (n_a - n_b).alias("net"),
    )
