"""Append-only ledgers: ordinals, heads, links, JSON profiles and receipts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import json_members, reached_before, slices_of
from ..functions.text import sha256_upper


def ordinal_check(rows: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    """Are a ledger's ordinals exactly ``1..n``?  Counts decide, so no ledger is sorted or gathered."""
    per = rows.groupBy(*key, ordinal).agg(F.count("*").alias("_n"))
    d = per.groupBy(*key).agg(
        F.sum("_n").alias("rows"), F.count("*").alias("distinct_ordinals"),
        F.min(ordinal).cast("bigint").alias("first"), F.max(ordinal).cast("bigint").alias("last"),
    )
    ok = (F.col("first") == 1) & (F.col("last") == F.col("rows")) & (F.col("distinct_ordinals") == F.col("rows"))
    return d.withColumn("pass", ok)


def head_rows(rows: DataFrame, key: Sequence[str], ordinal: str, columns: Sequence[str]) -> DataFrame:
    """The last row of each ledger by ordinal."""
    top = F.max_by(F.struct(*columns), F.col(ordinal)).alias("_h")
    return rows.groupBy(*key).agg(F.count("*").alias("rows"), F.max(ordinal).alias(ordinal), top).select(
        *key, "rows", ordinal, *[F.col(f"_h.{c}").alias(c) for c in columns]
    )


def predecessor_links(rows: DataFrame, key: Sequence[str], ordinal: str, named: str) -> DataFrame:
    """Does row n name row n-1?  FIRST, LINKED, BROKEN (names another row) or ORPHAN (no row n-1 exists).

    Rows meet their predecessor on ``(key, ordinal)``, so one very long ledger spreads like any other.
    """
    prev = rows.select(*key, (F.col(ordinal) + 1).alias(ordinal), F.lit(True).alias("_prev")).distinct()
    status = (
        F.when(F.col(named).isNull() & F.col("_prev").isNull(), "FIRST")
        .when(F.col("_prev").isNull(), "ORPHAN")
        .when(F.col(named).eqNullSafe(F.col(ordinal) - 1), "LINKED")
        .otherwise("BROKEN")
    )
    return rows.join(prev, [*key, ordinal], "left").withColumn("link", status).drop("_prev")


def first_pattern_wins(matches: DataFrame, key: Sequence[str], rank: str, columns: Sequence[str]) -> DataFrame:
    """One row per identical span: the one whose pattern ranks first."""
    first = F.min_by(F.struct(*columns), F.col(rank)).alias("_f")
    return matches.groupBy(*key, "start", "end").agg(first).select(
        *key, "start", "end", *[F.col(f"_f.{c}").alias(c) for c in columns]
    )


def stage_counters(counts: DataFrame, key: Sequence[str], stage: str) -> DataFrame:
    """Change of a counter ``n`` from one stage to the next.

    ``counts`` holds one row per key and stage, so a window's size is the number of stages.
    """
    w = Window.partitionBy(*key).orderBy(stage)
    return counts.withColumn("previous", F.lag("n").over(w)).withColumn("delta", F.col("n") - F.col("previous"))


def append_only_violations(old: DataFrame, new: DataFrame, ordinal: str, digest: str) -> DataFrame:
    """Rows that break "the old ledger is an exact prefix of the new one"."""
    o = old.select(ordinal, F.col(digest).alias("_o"))
    n = new.select(ordinal, F.col(digest).alias("_n"))
    last = old.agg(F.max(ordinal)).scalar()
    kind = (
        F.when(F.col("_n").isNull(), "REMOVED")
        .when(F.col("_o").isNull(), F.when(F.col(ordinal) <= last, "INSERTED"))
        .when(F.col("_o") != F.col("_n"), "CHANGED")
    )
    return o.join(n, ordinal, "full_outer").select(ordinal, kind.alias("violation")).where(F.col("violation").isNotNull())


# ---- JSON ----------------------------------------------------------------------------------------------------------

def nesting(value: Column) -> Column:
    """How many objects and arrays stand inside one another in a variant."""
    marks = F.regexp_replace(F.regexp_replace(F.to_json(value), r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]+", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc, mark):
        now = acc["now"] + F.when(mark.isin("{", "["), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(F.filter(F.split(marks, ""), lambda c: c != ""), zero, step, lambda acc: acc["most"])


def walk_json(
    rows: DataFrame, id_cols: Sequence[str], value: str, is_hit: Callable[[Column, Column], Column], *,
    root: str = "$",
) -> DataFrame:
    """Every member that ``is_hit(key, value)`` accepts, at any depth, as ``path, value``; nothing below a hit.

    The text of a row is lexed once, with the path kept on a stack, so the plan is the same for every depth and no row decides over
    another's; a hit hides the members whose span it covers.
    """
    d = rows.select(*id_cols, F.to_json(F.col(value)).alias("_j"))
    d = d.withColumn("_m", json_members("_j"))
    d = d.withColumn("_v", slices_of("_j", F.transform("_m", lambda m: m["low"]), F.transform("_m", lambda m: m["high"])))
    hit = F.zip_with("_m", "_v", lambda m, v: F.coalesce(is_hit(m["key"], F.try_parse_json(v)), F.lit(False)))
    d = d.withColumn("_h", hit)
    d = d.withColumn("_b", reached_before(F.zip_with("_m", "_h", lambda m, h: F.when(h, m["high"]).otherwise(0).cast("bigint"))))
    found = F.filter(F.arrays_zip("_m", "_v", "_h", "_b"), lambda x: x["_h"] & (x["_b"] <= x["_m"]["low"]))
    d = d.select(*id_cols, F.inline(F.transform(found, lambda x: F.struct(F.concat(F.lit(root), x["_m"]["path"]).alias("path"), x["_v"].alias("value")))))
    return d


def alternative_fields(rows: DataFrame, id_cols: Sequence[str], value: str, root: str = "$") -> DataFrame:
    """Members whose key speaks of an alternative or a rejection."""
    return walk_json(rows, id_cols, value, lambda k, v: F.lower(k).rlike("alternative|reject"), root=root)


def pin_records(rows: DataFrame, id_cols: Sequence[str], value: str) -> DataFrame:
    """Objects anywhere in a receipt that pin a member: ``path, bytes, sha256``."""
    def field(v: Column, name: str, kind: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", kind)

    hit = lambda k, v: field(v, "path", "string").isNotNull() & field(v, "sha256", "string").isNotNull()
    d = walk_json(rows, id_cols, value, hit)
    v = F.parse_json("value")
    return d.select(
        *id_cols, F.col("path").alias("at"), field(v, "path", "string").alias("path"),
        field(v, "bytes", "bigint").alias("bytes"), field(v, "sha256", "string").alias("sha256"),
    )


def key_profile(rows: DataFrame, value: str) -> DataFrame:
    """Top-level keys of dynamic rows: key, kind of value and presence count."""
    spark = rows.sparkSession
    d = rows.select(F.col(value).alias("_v")).lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    return d.select("key", kind.alias("kind")).groupBy("key", "kind").agg(F.count("*").alias("n"))


def ledger_summary(rows: DataFrame, id_col: str, value: str, companion: str) -> DataFrame:
    """Rows, rows with alternative fields, those fields in all, and rows with companions."""
    per = alternative_fields(rows, [id_col], value).groupBy(id_col).agg(F.count("*").alias("_f"))
    j = rows.select(id_col, companion).join(per, id_col, "left")
    return j.agg(
        F.count("*").alias("decisions"),
        F.count_if(F.col("_f") > 0).alias("decisions_with_fields"),
        F.coalesce(F.sum("_f"), F.lit(0)).alias("fields"),
        F.count_if(F.col(companion) > 0).alias("decisions_with_companions"),
    )


def source_change_declared(v: Column) -> Column:
    """A change is declared by a truthy ``source_change``, a truthy ``claims.source_changes``, or any ``result`` key
    that names a source.  Truth goes by type: any text but the empty one is true, whatever it spells."""
    def truthy(path: str) -> Column:
        member = F.try_variant_get(v, path, "variant")
        kind, s = F.regexp_extract(F.schema_of_variant(member), "^[A-Z]+", 0), F.to_json(member)
        empty = (
            F.when(kind == "STRING", s == '""').when(kind == "BOOLEAN", s == "false")
            .when(kind.isin("OBJECT", "ARRAY"), s.isin("{}", "[]")).when(kind == "VOID", True).otherwise(s.try_cast("double") == 0)
        )
        return F.coalesce(~empty, F.lit(False))

    result = F.try_variant_get(v, "$.result", "map<string,variant>")
    named = F.coalesce(F.exists(F.map_keys(result), lambda k: F.contains(F.lower(k), F.lit("source"))), F.lit(False))
    return truthy("$.source_change") | truthy("$.claims.source_changes") | named


Shape = Mapping[str, "Shape | None"]


def _keys(v: Column, path: str) -> Column:
    return F.array_join(F.array_sort(F.map_keys(F.try_variant_get(v, path, "map<string,variant>"))), ",")


def _render(v: Column, shape: Shape, path: str, skip: str) -> Column:
    parts = []
    for k in sorted(shape):
        here = f"{path}.{k}"
        if here == skip:
            continue
        body = _render(v, shape[k], here, skip) if shape[k] else F.coalesce(F.to_json(F.try_variant_get(v, here, "variant")), F.lit("null"))
        parts.append(F.concat(F.lit(f'"{k}":'), body))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _same_keys(v: Column, shape: Shape, path: str) -> Column:
    ok = F.coalesce(_keys(v, path) == ",".join(sorted(shape)), F.lit(False))
    for k, inner in shape.items():
        if inner:
            ok = ok & _same_keys(v, inner, f"{path}.{k}")
    return ok


def receipt_check(receipts: DataFrame, value: str, shape: Shape, hash_path: str) -> DataFrame:
    """Verify receipts that carry their own hash: exact keys, and the hash of the rest against the claim.

    ``shape`` is the closed key tree; ``hash_path`` (``$.a.b``) is left out of the hashed form, nested or not.
    """
    v = F.col(value)
    body = F.concat(_render(v, shape, "$", hash_path), F.lit("\n"))
    claimed = F.try_variant_get(v, hash_path, "string")
    return receipts.withColumns({
        "keys_ok": _same_keys(v, shape, "$"),
        "observed": sha256_upper(body),
        "claimed": claimed,
    }).withColumn("pass", F.col("keys_ok") & F.coalesce(F.col("observed") == F.col("claimed"), F.lit(False)))
