"""Running totals inside one row, so that exploding a text needs no shuffle and no window.

A text is cut into runs by one regex.  Runs are grouped into leaves, leaves into blocks; a leaf's start is the
total length of what precedes it in its block, a run's start the length of what precedes it in its leaf.  Work
per run is constant, and nothing wider than a block travels with an exploded row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 16
LEAVES_PER_BLOCK = 64
BLOCK = LEAF * LEAVES_PER_BLOCK
_MEASURES = {"chars": F.length, "bytes": F.octet_length}


def running_total(sizes: Column) -> Column:
    """Exclusive running totals of an array of non-negative numbers."""
    empty = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct(F.array_append(acc["out"], acc["sum"]).alias("out"), (acc["sum"] + x).alias("sum"))

    return F.aggregate(sizes, empty, step)["out"]


def _slices(items: Column, width: int) -> Column:
    # An empty array gives one empty slice; a filter on the size would be pushed down and cut the text twice.
    last = F.greatest(F.floor((F.size(items) - 1) / width).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * width + 1, width))


def _tail(text: Column, n: int) -> Column:
    """Last ``n`` characters; empty for NULL or ``n = 0``."""
    return F.coalesce(F.substring(text, -n, n), F.lit("")) if n else F.lit("")


def _head(text: Column, n: int) -> Column:
    return F.coalesce(F.substring(text, 1, n), F.lit("")) if n else F.lit("")


def _left_of(leaves: Column, i: Column, lctx: Column, n: int) -> Column:
    """The ``n`` characters before leaf ``i``: from its neighbour, or, where leaves are short, from as many as hold
    that many (a full leaf has at least ``LEAF`` characters) and the end of the block before."""
    k = -(-n // LEAF) or 1
    near = F.get(leaves, i - 1)
    far = F.concat(lctx, F.array_join(F.slice(leaves, F.greatest(i - k, F.lit(0)) + 1, F.least(i, F.lit(k))), ""))
    return _tail(F.when(F.length(near) >= n, near).otherwise(far), n)


def _right_of(leaves: Column, i: Column, rctx: Column, n: int) -> Column:
    k = -(-n // LEAF) or 1
    near = F.get(leaves, i + 1)
    far = F.concat(F.array_join(F.slice(leaves, i + 2, F.lit(k)), ""), rctx)
    return _head(F.when(F.length(near) >= n, near).otherwise(far), n)


def explode_runs(
    df: DataFrame,
    runs: Column,
    keep: Sequence[str | Column],
    *,
    context: tuple[int, int] | None = None,
    with_bytes: bool = False,
    wanted: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per run: kept columns, ``pos`` (0-based), ``off`` (scalar offset) and ``run``.

    ``with_bytes`` adds ``byte_off``.  ``context=(before, after)`` adds ``win`` and ``win_off``: the run with that
    many characters on either side of it, and the slice's own scalar offset.  ``wanted(run)`` keeps matching runs only;
    leaves without one are dropped before they are exploded.
    """
    measures = ("chars", "bytes") if with_bytes else ("chars",)
    names = [c if isinstance(c, str) else f"_k{i}" for i, c in enumerate(keep)]
    kept = [F.col(c) if isinstance(c, str) else c.alias(n) for c, n in zip(keep, names)]

    d = df.select(*kept, runs.alias("_runs"))
    d = d.select(*names, _slices(F.col("_runs"), BLOCK).alias("_blk"))
    d = d.select(*names, "_blk", F.transform("_blk", lambda b: F.array_join(b, "")).alias("_txt"))
    cols = [F.col("_blk").alias("blk")]
    for m in measures:
        size = _MEASURES[m]
        cols.append(running_total(F.transform("_txt", lambda t: size(t))).alias(m))
    before, after = context or (0, 0)
    if context:
        cols.append(F.transform("_txt", lambda x, i: _tail(F.get(F.col("_txt"), i - 1), before)).alias("lctx"))
        cols.append(F.transform("_txt", lambda x, i: _head(F.get(F.col("_txt"), i + 1), after)).alias("rctx"))
    d = d.select(*names, *cols)
    d = d.select(*names, F.posexplode(F.arrays_zip(*[c for c in d.columns if c not in names])).alias("_b", "_z"))
    d = d.select(*names, "_b", "_z.*")

    d = d.select(*names, "_b", *[c for c in d.columns if c not in (*names, "_b", "blk")], _slices(F.col("blk"), LEAF).alias("_lf"))
    d = d.withColumn("_lt", F.transform("_lf", lambda b: F.array_join(b, "")))
    zipped = [F.col("_lf").alias("leaf")]
    for m in measures:
        size = _MEASURES[m]
        zipped.append(running_total(F.transform("_lt", lambda t: size(t))).alias(f"leaf_{m}"))
    if context:
        zipped.append(F.transform("_lt", lambda x, i: _left_of(F.col("_lt"), i, F.col("lctx"), before)).alias("left"))
        zipped.append(F.transform("_lt", lambda x, i: _right_of(F.col("_lt"), i, F.col("rctx"), after)).alias("right"))
    carried = [c for c in d.columns if c not in (*names, "_b", "_lf", "_lt", "lctx", "rctx")]
    d = d.select(*names, "_b", *carried, *zipped)
    d = d.select(
        *names, "_b", *carried,
        F.posexplode(F.arrays_zip("leaf", *[f"leaf_{m}" for m in measures], *(["left", "right"] if context else []))).alias("_l", "_z"),
    ).select(*names, "_b", *carried, "_l", "_z.*")
    at_leaf = F.col("chars") + F.col("leaf_chars")
    out = [*names, (F.col("_b") * BLOCK + F.col("_l") * LEAF).alias("_first"), "leaf", at_leaf.alias("_chars")]
    if with_bytes:
        out.append((F.col("bytes") + F.col("leaf_bytes")).alias("_bytes"))
    if context:
        out.append(F.concat("left", F.array_join("leaf", ""), "right").alias("win"))
        out.append((at_leaf - F.length("left")).alias("win_off"))
    if wanted:
        d = d.where(F.exists("leaf", wanted))
    d = d.select(*out)
    extra = ["win", "win_off"] if context else []
    d = d.select(*[c for c in d.columns], F.posexplode("leaf").alias("_p", "run"))
    if wanted:
        d = d.where(wanted(F.col("run")))
    head = F.array_join(F.slice("leaf", F.lit(1), F.col("_p")), "")
    final = [
        *names,
        (F.col("_first") + F.col("_p")).cast("bigint").alias("pos"),
        (F.col("_chars") + F.length(head)).alias("off"),
        "run",
    ]
    if with_bytes:
        final.append((F.col("_bytes") + F.octet_length(head)).alias("byte_off"))
    d = d.select(*final, *extra)
    if context:
        lo = F.greatest(F.col("off") - before, F.col("win_off"))
        width = F.col("off") - lo + F.length("run") + after
        d = d.withColumns({"win": F.substring("win", lo - F.col("win_off") + 1, width), "win_off": lo})
    return d


def context_of(off: Column, before: int, after: int) -> Column:
    """``text[off-before : off+after]`` taken from the window that :func:`explode_runs` carried along."""
    lo = F.greatest(off - before, F.lit(0))
    return F.substring(F.col("win"), lo - F.col("win_off") + 1, off + after - lo)


CHUNK = 128


def chunks(text: Column) -> Column:
    """The text in chunks of equal length, so that a slice need not be counted out from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def slice_chunks(chunked: Column, start: Column, end: Column) -> Column:
    """``text[start:end]`` from :func:`chunks`; constant work plus the slice's own length."""
    first = F.floor(start / CHUNK)
    last = F.floor(F.greatest(end - 1, start) / CHUNK)
    near = F.array_join(F.slice(chunked, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    return F.substring(near, start - first * CHUNK + 1, end - start)
