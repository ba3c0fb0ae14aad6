"""Column expressions and small helpers that several operators of this folder share."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper-case ASCII and its lower-case form; other scripts keep their case.
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched.  Pure ASCII texts take the fast built-in."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, ASCII_UPPER, ASCII_LOWER)).otherwise(F.lower(text))


def base32_sha1(data: Column) -> Column:
    """SHA-1 as 32 base32 characters: every five hex digits are twenty bits, four characters."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def keyed_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, so that other columns, whatever their names, never reach an operator."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))


def slices(batches, nbytes: int = 4 << 20, column: str = "text"):
    """Arrow record batches cut so that a slice has about ``nbytes`` of text, one row at least and 30,000 at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and (size + n > nbytes or i - start >= 30_000):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)


_kept: dict = {}


def kept(key, make):
    """What ``make`` gives, kept by the Python worker for its next tasks: one thing at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Spark reuses workers, so a task of another operator lets go what is kept before it needs memory itself."""
    _kept.clear()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while (name := f"_{name}").lower() in taken:
        pass
    return name


def quoted(names) -> list[str]:
    """Column names that are taken literally, whatever characters they hold."""
    return [f"`{n.replace('`', '``')}`" for n in names]


def map_texts(docs: DataFrame, keep: list[str], text: Column, made: list[tuple[str, str]], run) -> DataFrame:
    """``keep`` and the columns ``made`` (name, type) that ``run`` computes from Arrow batches.

    In the batches the kept columns go by position and the text, the last one, as ``_text``, whatever the table calls its
    columns.  ``run`` gives for each batch a record batch and the list of its new arrays.
    """
    inner = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(q).alias(k) for q, k in zip(quoted(keep), inner, strict=True)), text.alias("_text"))

    def batches_of(batches):
        for b, arrays in run(batches):
            kept = [b.column(i) for i in range(len(inner))]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], [*inner, *(n for n, _ in made)])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [f"{quoted([n])[0]} {t}" for n, t in made]
    out = source.mapInArrow(batches_of, ", ".join(fields))
    return out.select(*(F.col(k).alias(n) for k, n in zip(inner, keep, strict=True)), *quoted(n for n, _ in made))
