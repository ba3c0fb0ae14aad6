"""Walks over the arrays of one row that no built-in function makes in linear time, as small Arrow functions.

Built-in folds copy what they have gathered at every step, so running totals, searches and merges over a long text's pieces would grow
with its square.  These take whole columns of lists and work on their flat values.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows whose values are Python objects at one time.
ROWS = 16
LONGS, INTS, FLAGS = (T.ArrayType(x()) for x in (T.LongType, T.IntegerType, T.BooleanType))


def lists(values: pa.Array, sizes) -> pa.ListArray:
    """Flat values as lists of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.asarray(sizes, np.int64))), pa.int32()), values)


def rows_of(column: pa.Array):
    """The flat numbers of a list column, and how many each row has; a null list is empty."""
    sizes = np.diff(np.asarray(column.offsets)) if column.null_count == 0 else np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
    return column.flatten(), sizes.astype(np.int64)


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat numbers, where each row starts in them, and how many it has."""
    flat, sizes = rows_of(column)
    return flat.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes) - sizes, sizes


def row_by_row(make, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``make`` of every row.  Only a few rows at a time are Python objects, which take many times the room of their values."""
    done, some = [], []
    for n, row in enumerate(zip(*columns, strict=True), 1):
        some.append(make(*row))
        if n % ROWS == 0:
            done.append(pa.array(some, kind))
            some = []
    return pa.concat_arrays([*done, pa.array(some, kind)])


@F.arrow_udf(LONGS)
def starts_of(lengths: pa.Array) -> pa.Array:
    """Running totals of the lengths of a row, each without its own."""
    flat, first, sizes = numbers(lengths)
    ends = np.cumsum(flat)
    before = np.repeat(np.append(0, ends)[first], sizes)
    return lists(pa.array(ends - flat - before, pa.int64()), sizes)


@F.arrow_udf(INTS)
def place_of(points: pa.Array, starts: pa.Array) -> pa.Array:
    """For each point of a row the last of the row's ascending starts that is not beyond it; -1 before the first."""
    p, p0, n = numbers(points)
    s, s0, m = numbers(starts)
    out = [np.searchsorted(s[b : b + j], p[a : a + i], side="right") - 1 for a, i, b, j in zip(p0, n, s0, m, strict=True)]
    return lists(pa.array(np.concatenate([np.zeros(0, np.int64), *out]), pa.int32()), n)


@F.arrow_udf(FLAGS)
def inside(starts: pa.Array, lengths: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """Does each piece of a row lie wholly inside one of the row's disjoint ascending ranges?"""
    a, a0, n = numbers(starts)
    size, *_ = numbers(lengths)
    lo, l0, m = numbers(low)
    hi, *_ = numbers(high)
    out = []
    for i, k, j, r in zip(a0, n, l0, m, strict=True):
        at, here = a[i : i + k], np.searchsorted(lo[j : j + r], a[i : i + k], side="right") - 1
        out.append((here >= 0) & (at + size[i : i + k] <= hi[j : j + r][here]) if r else np.zeros(k, bool))
    return lists(pa.array(np.concatenate([np.zeros(0, bool), *out]), pa.bool_()), n)


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("a", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("held", T.BooleanType())])))
def cut_at(starts: pa.Array, lengths: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """The parts of a row's pieces between the edges of disjoint sorted ranges: piece, offset in it, length, inside a range."""
    at, p0, n = numbers(starts)
    size, *_ = numbers(lengths)
    lo, l0, m = numbers(low)
    hi, *_ = numbers(high)
    columns, sizes = [[np.zeros(0, np.int32)] for _ in range(3)] + [[np.zeros(0, bool)]], []
    for i, k, j, r in zip(p0, n, l0, m, strict=True):
        a, lows, highs = at[i : i + k], np.maximum(lo[j : j + r], 0), hi[j : j + r]
        end = int(a[-1] + size[i + k - 1]) if k else 0
        edges = np.unique(np.concatenate([a, lows[lows < end], highs[(highs > 0) & (highs < end)]])) if k else a
        piece = np.searchsorted(a, edges, side="right") - 1
        near = np.searchsorted(lows, edges, side="right") - 1
        held = (near >= 0) & (edges < highs[near]) if r else np.zeros(len(edges), bool)
        for c, v in zip(columns, (piece, edges - a[piece], np.diff(np.append(edges, end)), held), strict=True):
            c.append(v.astype(c[0].dtype))
        sizes.append(len(edges))
    flat = [pa.array(np.concatenate(c)) for c in columns]
    return lists(pa.StructArray.from_arrays(flat, ["i", "a", "n", "held"]), np.array(sizes, np.int64))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))
def union_of(low: pa.Array, high: pa.Array) -> pa.Array:
    """The union of a row's ranges, in order; overlapping and touching ranges become one."""
    a, a0, n = numbers(low)
    b, *_ = numbers(high)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((a, row))
    a, b = a[order], b[order]
    reached = np.concatenate([np.zeros(0, np.int64), *(np.maximum.accumulate(b[i : i + k]) for i, k in zip(a0, n, strict=True) if k)])
    new = np.append(True, (row[1:] != row[:-1]) | (a[1:] > reached[:-1]))[: len(a)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a))[: len(first)] - 1
    merged = pa.StructArray.from_arrays([pa.array(a[first]), pa.array(reached[last])], ["start", "end"])
    return lists(merged, np.bincount(row[first], minlength=len(n)))


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("protected", T.BooleanType())])))
def joined_by(lengths: pa.Array, flags: pa.Array) -> pa.Array:
    """Neighbouring pieces of a row with equal flags as one: the first of them, how many, their span, the flag."""
    size, s0, n = numbers(lengths)
    flag = rows_of(flags)[0].to_numpy(zero_copy_only=False).astype(bool)
    row, ends = np.repeat(np.arange(len(n)), n), np.cumsum(size)
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (flag[1:] != flag[:-1]))[: len(row)])
    last = np.append(first[1:], len(row))[: len(first)] - 1
    base = np.append(0, ends)[s0[row[first]]]
    columns = [(first - s0[row[first]]).astype(np.int32), (last - first + 1).astype(np.int32), ends[first] - size[first] - base, ends[last] - base, flag[first]]
    return lists(pa.StructArray.from_arrays([pa.array(c) for c in columns], ["first", "n", "start", "end", "protected"]), np.bincount(row[first], minlength=len(n)))


@F.arrow_udf(LONGS)
def reached_before(ends: pa.Array) -> pa.Array:
    """The greatest end before each entry of a row; 0 for the first.  Entries that do not count have end 0."""
    e, e0, n = numbers(ends)
    out = [np.append(0, np.maximum.accumulate(e[i : i + k]))[:-1] for i, k in zip(e0, n, strict=True) if k]
    return lists(pa.array(np.concatenate([np.zeros(0, np.int64), *out]), pa.int64()), n)


@F.arrow_udf(T.ArrayType(T.StringType()))
def slices_of(texts: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """``text[low:high]`` for every pair of a row: a text is decoded once and sought in, not counted out for each slice."""
    def cut(text: pa.Scalar, a: pa.Scalar, b: pa.Scalar):
        text = text.as_py()
        return [None if text is None or i is None or j is None else text[max(i, 0) : max(j, 0)] for i, j in zip(a.as_py() or [], b.as_py() or [], strict=True)]

    return row_by_row(cut, pa.list_(pa.string()), texts, low, high)


@F.arrow_udf(T.ArrayType(T.StringType()))
def hashes_of(texts: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """The SHA-256 of what :func:`slices_of` gives, in upper-case hex; slices that overlap many times never leave their text."""
    def cut(text: pa.Scalar, a: pa.Scalar, b: pa.Scalar):
        text = text.as_py()
        return [
            None if text is None or i is None or j is None else hashlib.sha256(text[max(i, 0) : max(j, 0)].encode()).hexdigest().upper()
            for i, j in zip(a.as_py() or [], b.as_py() or [], strict=True)]

    return row_by_row(cut, pa.list_(pa.string()), texts, low, high)


@F.arrow_udf(LONGS)
def bytes_before(texts: pa.Array, points: pa.Array) -> pa.Array:
    """The UTF-8 bytes before each point of a row's text; a point inside a two-character line break stands before the break."""
    p, p0, n = numbers(points)
    out = [np.zeros(0, np.int64)]
    for text, i, k in zip(texts, p0, n, strict=True):
        raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
        first = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        at = first[np.clip(p[i : i + k], 0, len(first) - 1)]
        padded = np.append(raw, [0, 0])  # the byte before the first is the last of these, which is no break
        out.append(at - ((padded[at - 1] == 13) & (padded[at] == 10)))
    return lists(pa.array(np.concatenate(out), pa.int64()), n)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("byte", T.LongType())])))
def line_starts(sizes: pa.Array) -> pa.Array:
    """Where each line of a row starts, in characters and bytes, from the lines' sizes ``n, b``."""
    flat, counts = rows_of(sizes)
    first = np.cumsum(counts) - counts
    columns = []
    for field in ("n", "b"):
        size = flat.field(field).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        columns.append(pa.array(ends - size - np.repeat(np.append(0, ends)[first], counts), pa.int64()))
    return lists(pa.StructArray.from_arrays(columns, ["at", "byte"]), counts)


@F.arrow_udf(T.ArrayType(T.StringType()))
def looked_up(items: pa.Array, old: pa.Array, new: pa.Array) -> pa.Array:
    """The items of a row, those that the row's map ``old`` to ``new`` has replaced."""
    def look(row: pa.Scalar, keys: pa.Scalar, values: pa.Scalar):
        known = dict(zip(keys.as_py() or [], values.as_py() or [], strict=True))
        return [known.get(x, x) for x in row.as_py()] if row.is_valid else None

    return row_by_row(look, pa.list_(pa.string()), items, old, new)


_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\],:]|[^\s{}\[\],:"]+', re.DOTALL)


def members_of(text: str) -> list[dict]:
    """Every member and element of a JSON text in order: ``path`` below the root, ``key`` (null for elements), and the value's span.

    A stack of open containers runs over the tokens once, so depth costs nothing.
    """
    out: list[dict] = []
    stack: list[list] = []  # path, next element's number (None in an object), key that waits for its value, member whose value this is

    def value_at(low: int) -> dict | None:
        if not stack:
            return None
        path, number, key, _ = stack[-1]
        step = f"[{number}]" if number is not None else f".{key}"
        out.append({"path": path + step, "key": key if number is None else None, "low": low, "high": low})
        if number is not None:
            stack[-1][1] += 1
        return out[-1]

    for m in _JSON_TOKEN.finditer(text):
        token = m.group()
        if token in "{[":
            member = value_at(m.start())
            stack.append([member["path"] if member else "", None if token == "{" else 0, None, member])
        elif token in "}]":
            member = stack.pop()[3]
            if member:
                member["high"] = m.end()
        elif token == ",":
            stack[-1][2] = None
        elif token != ":":
            if stack and stack[-1][1] is None and stack[-1][2] is None:
                stack[-1][2] = json.loads(token)
            elif member := value_at(m.start()):
                member["high"] = m.end()
    return out


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("path", T.StringType()), T.StructField("key", T.StringType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])))
def json_members(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("path", pa.string()), ("key", pa.string()), ("low", pa.int64()), ("high", pa.int64())]))
    return row_by_row(lambda x: members_of(x.as_py()) if x.is_valid else None, kind, texts)
