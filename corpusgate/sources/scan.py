"""Corpus, tree and ledger scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sha256_upper


def read_corpus(spark: SparkSession, path: str, *columns: str, partitions: int | None = None) -> DataFrame:
    """Document table from parquet; order is whatever key the caller sorts by, never row order.

    Rows stay in the partitions of the scan unless the caller asks for a number, as for one small file on many cores.
    """
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df.repartition(partitions) if partitions else df


def read_tree(
    spark: SparkSession, path: str, *, exclude_names: Sequence[str] = (), pattern: str | None = None,
    content: bool = False,
) -> DataFrame:
    """Files below a folder: ``path`` (relative), ``bytes``, and on request ``content`` and ``sha256``.

    Without ``content`` Spark prunes the binary column and reads only file statuses.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    root = path.rstrip("/") + "/"
    files = reader.load(path)
    rel = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/+", "/"), "^.*?" + _quote(root), "")
    cols = [rel.alias("path"), F.col("length").alias("bytes")]
    if content:
        cols += ["content", sha256_upper(F.col("content")).alias("sha256")]
    out = files.select(*cols)
    if exclude_names:
        out = out.where(~F.element_at(F.split("path", "/"), -1).isin(*exclude_names))
    return out


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def parse_jsonl(lines: DataFrame, text: str = "value") -> DataFrame:
    """Ledger rows from JSON lines: blank lines dropped, ``row`` is a VARIANT, NULL where the line is not JSON."""
    return lines.where(F.trim(F.col(text)) != "").withColumn("row", F.try_parse_json(F.col(text)))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return parse_jsonl(spark.read.text(path))
