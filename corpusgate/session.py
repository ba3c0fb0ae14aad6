"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session that the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusgate")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the folder every executor can reach, ``spark.checkpoint.dir``.

    A machine-local folder is used only when the session names none and runs in one process, as tests do.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/corpusgate-{uuid.uuid4().hex}"


#: Spark's settings of the rows that a Python worker and a reader of stored tables hold at a time, and how many whole texts with all their
#: pieces those may be.
BATCH, READ, TEXTS = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize", 256


@contextmanager
def few_rows_at_a_time(spark: SparkSession, rows: int = TEXTS) -> Iterator[None]:
    """What runs inside hands Python workers, and reads of stored tables, no more than ``rows`` rows at a time; the session's own settings come back."""
    before = {k: spark.conf.get(k) for k in (BATCH, READ)}
    for k, v in before.items():
        spark.conf.set(k, str(rows if int(v) <= 0 else min(rows, int(v))))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts lineage in a way that survives the loss of executors, lets several readers share one computation, and gives
    the optimizer a measured size to choose joins by.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by_text(df: DataFrame) -> DataFrame:
    """The same for tables whose rows are whole texts with arrays of their pieces: many of them at once fill a Python worker."""
    with few_rows_at_a_time(df.sparkSession):
        return stored(df)
