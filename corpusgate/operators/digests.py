"""Ordered digests that never gather a corpus: hash per text, then hash of hashes in fixed-size groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sha256_upper

GROUP_BITS = 12


def row_digest(rows: DataFrame, key: Sequence[str], order: str, line: Column) -> DataFrame:
    """``key, rows, digest``: SHA-256 over a text's rows, one per line, in ``order``.

    A text's rows are no more than its characters, so the list stays within what one text cell may weigh.
    """
    d = rows.select(*key, F.struct(F.col(order).alias("o"), line.alias("l")).alias("_r"))
    d = d.groupBy(*key).agg(F.array_sort(F.collect_list("_r")).alias("_rows"))
    return d.select(
        *key, F.size("_rows").cast("bigint").alias("rows"), sha256_upper(F.array_join("_rows.l", "\n")).alias("digest")
    )


def corpus_digest(digests: DataFrame, key: str, digest: str = "digest", levels: int = 6) -> DataFrame:
    """One row: the root over digests ordered by a unique, non-negative integer key.

    Each level hashes the ordered digests of at most ``2**12`` neighbouring keys; ``levels`` of 12 bits each must cover
    the key's range (6 cover 72 bits, so any bigint).
    """
    sound = F.when(F.col(key) < 0, F.raise_error(F.lit("a negative key"))).otherwise(F.col(key))
    d = digests.select(sound.cast("bigint").alias("_id"), F.col(digest).alias("_d"), F.lit(1).cast("bigint").alias("_n"))
    for _ in range(levels):
        d = d.groupBy(F.shiftright("_id", GROUP_BITS).alias("_up")).agg(
            F.array_sort(F.collect_list(F.struct("_id", "_d"))).alias("_all"), F.sum("_n").alias("_n"), F.count_distinct("_id").alias("_keys")
        )
        d = d.withColumn("_n", F.when(F.col("_keys") < F.size("_all"), F.raise_error(F.lit("a repeated key"))).otherwise(F.col("_n")))
        d = d.select(F.col("_up").alias("_id"), sha256_upper(F.array_join("_all._d", "\n")).alias("_d"), "_n")
    return d.select(F.col("_n").alias("members"), F.col("_d").alias("digest"))


def member_manifest(members: DataFrame, path: str = "path") -> DataFrame:
    """``SHA256 TAB BYTES TAB PATH`` lines in path order; partitions follow one another in that order."""
    line = F.concat_ws("\t", "sha256", F.col("bytes").cast("string"), path)
    return members.select(path, line.alias("line")).orderBy(path)
