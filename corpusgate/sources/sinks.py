"""Sinks, the refuse-to-overwrite rule and read-back verification."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class OverwriteRefused(RuntimeError):
    """The target exists and holds something else."""


class ReadBackMismatch(RuntimeError):
    """What was written is not what was meant to be written."""


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line, keys sorted, nulls kept."""
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", "true").csv(path, sep="\t")


def table_digest(df: DataFrame) -> DataFrame:
    """One row ``rows, digest, digest2``: multiset hashes of whole typed rows, the same for any order or partitioning.

    Two independent 64-bit hashes of the values as they are, so that a microsecond or a changed type shows; nested values
    that cannot be hashed directly go through their JSON.
    """
    def value(f):
        kind = f.dataType.simpleString()
        return F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{f.name}`")

    cols = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        cols += [F.col(f"`{f.name}`").isNull(), value(f)]

    def total(seed: int):
        return F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))

    return df.agg(F.count("*").alias("rows"), total(1).alias("digest"), total(2).alias("digest2"))


def same_types(a: DataFrame, b: DataFrame) -> bool:
    """Whether both tables have the same columns of the same types, in any order."""
    return sorted(a.dtypes) == sorted(b.dtypes)


def verify_written(expected: DataFrame, written: DataFrame) -> DataFrame:
    """One gate row: row counts and digests of what should be there and what is."""
    def side(d: DataFrame, name: str) -> DataFrame:
        return table_digest(d).select(F.lit(name).alias("side"), "rows", "digest", "digest2")

    both = side(expected, "e").unionByName(side(written.select(*expected.columns), "w"))
    pick = lambda c, s: F.max(F.when(F.col("side") == s, F.col(c)))
    d = both.agg(
        pick("rows", "e").alias("expected_rows"), pick("rows", "w").alias("written_rows"),
        ((pick("digest", "e") == pick("digest", "w")) & (pick("digest2", "e") == pick("digest2", "w"))).alias("_same"),
    )
    same = (F.col("expected_rows") == F.col("written_rows")) & F.col("_same")
    return d.select("expected_rows", "written_rows", same.alias("pass"))


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_once(df: DataFrame, path: str) -> str:
    """Write parquet unless the target exists: identical content is a no-op, different content is refused.

    A fresh write goes to a folder beside the target, is read back and compared, and only then takes the target's name,
    so a failed attempt leaves the target untouched; only two counts and four sums reach the driver.
    """
    spark = df.sparkSession
    present = _existing(spark, path)
    if present is not None:
        if same_types(present, df) and verify_written(df, present).first()["pass"]:
            return "IDENTICAL"
        raise OverwriteRefused(path)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(staged)
    written = spark.read.parquet(staged)
    if not (same_types(written, df) and verify_written(df, written).first()["pass"]):
        _files(spark, staged).delete(_path(spark, staged), True)
        raise ReadBackMismatch(path)
    files = _files(spark, path)
    moved = files.rename(_path(spark, staged), _path(spark, path))
    # A target that appeared meanwhile takes the staged folder in, or the rename fails: either way what was there first stays.
    inside = _path(spark, f"{path.rstrip('/')}/{staged.rsplit('/', 1)[-1]}")
    if not moved or files.exists(inside):
        files.delete(inside if moved else _path(spark, staged), True)
        raise OverwriteRefused(path)
    return "WRITTEN"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish_if_passed(df: DataFrame, gates: DataFrame, path: str) -> str:
    """Write only when every gate row passes."""
    if not gates.agg(F.coalesce(F.bool_and("pass"), F.lit(False)).alias("ok")).first()["ok"]:
        return "BLOCKED"
    return write_once(df, path)
