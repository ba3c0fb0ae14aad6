"""Exact removal of repeated 50-byte strings, by suffix arrays of difference-cover samples.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller key.  Sorting every
suffix of the corpus would shuffle a row per byte, so the suffixes are dealt first:

* ``dealt``: each string of 50 bytes belongs to the least hash of the 20-byte grams inside it.  Equal strings have the same
  least gram, so a document falls into fragments (runs of strings with one least gram) and only fragments of the same gram can
  hold equal strings.  Grams that one document alone uses are dropped; nothing of theirs can repeat.
* Equal fragments are counted once, with the smallest key that has them, before they are brought together by gram.
* ``classes`` builds the suffix array of the fragments of a task in blocks: sample the suffixes at positions 1 and 2 of every
  three, sort their triples, recurse on the names, merge the remaining suffixes, and compare the prefixes of neighbours.  Every class of equal strings gets its smallest key.
* A gram with very many bytes of fragments, such as one at the edge of a common phrase, is split by its strings instead, so no
  task holds it whole.
* That comes back to each occurrence by gram and fragment, and a document gathers its removed ranges.

A null text has no bytes; texts shorter than ``length`` lose nothing.  A null key counts as larger than any other and removes
nothing elsewhere.  Rows that share a key are told apart by their text and never remove each other.  Extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .columns import slices
from .minhash import mix

GRAM = 20
#: The grams are worked off in so many shares, one after another, so that the disk holds one share of their fragments.
SHARES = 4
#: Bytes of text whose grams meet in one bucket, and bytes of fragments that one suffix array covers.
BUCKET_BYTES, BLOCK_BYTES = 64 << 20, 1 << 17
#: Bytes of text whose hashes are made at a time, so that they stay near the processor.
CACHE_BYTES = 1 << 17
#: A gram with more bytes of fragments than this is split, and a string of it comes back in so many parts.
HOT_BYTES, SALTS = 4 << 20, 16
LAST = (1 << 63) - 1
_TABLE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position, by doubling."""
    block, size, power = _TABLE[data], 1, _BASE
    out, done = None, 0
    while True:
        if k & size:
            if out is None:
                out, done = block, size
            else:
                n = len(block) - done
                out = out[:n] * np.uint64(power) + block[done : done + n]
                done += size
        if done == k:
            return mix(out)
        block = block[: len(block) - size] * np.uint64(power) + block[size:]
        power = power * power & _MASK
        size *= 2


def least_grams(data: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes inside one text: where it starts, and its least gram hash."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    m = gram_hashes(data, GRAM)
    width, reach = length - GRAM + 1, 1
    while reach * 2 <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    if reach < width:
        m = np.minimum(m[: len(m) - (width - reach)], m[width - reach :])
    starts = np.flatnonzero(owner[: len(m)] == owner[length - 1 :])
    return starts, m[starts] & np.uint64((1 << 48) - 1)


def fragments(data: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram, first start and last start of each run of strings with one least gram."""
    starts, m = least_grams(data, owner, length)
    if not len(starts):
        return m, starts, starts
    new = np.append(True, (m[1:] != m[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = np.flatnonzero(new)
    return m[first], starts[first], starts[np.append(first[1:], len(starts)) - 1]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _packed(*columns: np.ndarray) -> np.ndarray:
    """One number per row that orders like the row."""
    bits = [int(c.max()).bit_length() for c in columns]
    key = columns[0]
    for c, n in zip(columns[1:], bits[1:], strict=True):
        if int(key.max()).bit_length() + n > 63:
            key = np.unique(key, return_inverse=True)[1]
        key = (key << n) | c
    return key


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` (numbers from 1) in order.

    The difference cover modulo three: suffixes at positions 1 and 2 of every three are named by their triple and sorted by
    recursion on the names; the rest is sorted by its symbol and the rank after it, and merged in by binary search.
    """
    n = len(s)
    padded = np.concatenate([s, np.zeros(4, np.int64)])
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])  # one empty suffix may keep the halves apart
    if not len(sample):
        return np.arange(n)
    triple = _packed(padded[sample], padded[sample + 1], padded[sample + 2])
    order = np.argsort(triple)
    ranked = triple[order]
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(np.append(True, ranked[1:] != ranked[:-1]))
    if names.max() < len(sample):
        order = suffix_array(names)
        names[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_packed(padded[rest], rank[rest + 1]))]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    both = np.concatenate([one, rest])
    key = _packed(padded[both], rank[both + 1])
    before = np.searchsorted(key[: len(one)], key[len(one) :])
    both = np.concatenate([two, rest])
    key = _packed(padded[both], padded[both + 1], rank[both + 2])
    before += np.searchsorted(key[: len(two)], key[len(two) :])
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    place = before + np.arange(len(rest))
    out[place] = rest
    free[place] = False
    out[free] = sampled
    return out


def classes(frags: list[bytes], keys: np.ndarray, length: int) -> list[np.ndarray]:
    """For each fragment: the smallest key that has the string from each of its starts."""
    sizes = np.array([len(f) for f in frags])
    data = np.frombuffer(b"\0".join(frags) + b"\0", np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols = data.astype(np.int64) + len(frags) + 1
    symbols[base + sizes] = np.arange(1, len(frags) + 1)  # each end differs, so no comparison runs past it
    order = suffix_array(symbols)
    owner = np.repeat(np.arange(len(frags)), sizes + 1)
    room = np.repeat(base + sizes, sizes + 1) - np.arange(len(data))
    order = order[room[order] >= length]
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    differs = np.ones(len(order), bool)
    for at in range(1, len(order), 1 << 16):
        end = min(len(order), at + (1 << 16))
        differs[at:end] = (windows[order[at:end]] != windows[order[at - 1 : end - 1]]).any(axis=1)
    first = np.flatnonzero(differs)
    least = np.minimum.reduceat(keys[owner[order]], first)
    best = np.empty(len(data), np.int64)
    best[order] = least[np.cumsum(differs) - 1]
    return [best[b : b + n - length + 1] for b, n in zip(base, sizes, strict=True)]


def stored(df: DataFrame) -> DataFrame:
    """A table in the shared scratch folder, small on disk.

    The shuffle files behind it are of no more use; the driver's garbage collection lets Spark's cleaner drop them now, not
    after half an hour, so that each step has the disk to itself.
    """
    spark, path, schema = df.sparkSession, scratch_dir(df.sparkSession), df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


# ---- Spark ----------------------------------------------------------------------------------------------------------


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("k"),
        F.xxhash64(F.coalesce(body, F.lit(""))).alias("th"), F.coalesce(body, F.lit("")).cast("binary").alias("text"))


def shared_grams(named: DataFrame, length: int) -> DataFrame:
    """``k, th, grams`` (binary, ascending): the least grams of each document that another one uses as well."""
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))

    def deal(batches):
        for b in slices(batches, 8 << 20):
            pairs, done = [], 0
            for part in slices([b], CACHE_BYTES):
                data, owner, _ = _joined(part.column("text").to_pylist())
                starts, m = least_grams(data, owner, length)
                new = np.append(True, m[1:] != m[:-1])[: len(m)]  # neighbours mostly have the same
                new[1:] |= np.diff(owner[starts]) > 0
                pairs.append(np.unique((owner[starts[new]].astype(np.uint64) + np.uint64(done) << np.uint64(48)) | m[new]))
                done += part.num_rows
            pairs = np.concatenate(pairs)
            doc, m = (pairs >> np.uint64(48)).astype(np.int64), pairs & np.uint64((1 << 48) - 1)
            bucket = (m % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            ks, ths = b.column("k").to_numpy(zero_copy_only=False), b.column("th").to_numpy(zero_copy_only=False)
            rows = []
            for i in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[i] : bounds[i + 1]]
                used, local = np.unique(doc[at], return_inverse=True)
                packed = m[at].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                rows.append((int(i), ks[used].tobytes(), ths[used].tobytes(), local.astype(np.uint16).tobytes(), packed))
            if rows:
                types = (pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["bucket", "ks", "ths", "doc", "grams"])

    def meet(batches):
        bucket, held = None, []

        def shared():
            docs = [(np.frombuffer(r[0], np.int64), np.frombuffer(r[1], np.int64), np.frombuffer(r[2], np.uint16)) for r in held]
            k = np.concatenate([x[0] for x in docs])
            th = np.concatenate([x[1] for x in docs])
            offset = np.concatenate([[0], np.cumsum([len(x[0]) for x in docs])[:-1]])
            owner = np.concatenate([x[2].astype(np.int32) + o for x, o in zip(docs, offset, strict=True)])
            six = np.frombuffer(b"".join(r[3] for r in held), np.uint8).reshape(-1, 6)
            m = np.zeros((len(six), 8), np.uint8)
            m[:, :6] = six
            m = m.view(np.uint64).ravel()
            order = np.argsort(m)
            m, owner = m[order], owner[order]
            same = m[1:] == m[:-1]
            again = np.append(same, False) | np.append(False, same)
            m, owner = m[again], owner[again]
            order = np.lexsort((m, owner))
            m, owner = m[order], owner[order]
            bounds = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, np.int64)
            lists = [x.tobytes() for x in np.split(m, bounds[1:])] if len(owner) else []
            who = owner[bounds] if len(owner) else owner
            return pa.RecordBatch.from_arrays([pa.array(k[who]), pa.array(th[who]), pa.array(lists, pa.binary())], ["k", "th", "grams"])

        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(5)]
            for row in zip(*columns, strict=True):
                if row[0] != bucket:
                    if held:
                        yield shared()
                    bucket, held = row[0], []
                held.append(row[1:])
        if held:
            yield shared()

    dealt = named.select("k", "th", "text").mapInArrow(deal, "bucket long, ks binary, ths binary, doc binary, grams binary")
    met = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "k long, th long, grams binary")
    return stored(met).groupBy("k", "th").agg(F.collect_list("grams").alias("grams"))


def occurrences(named: DataFrame, grams: DataFrame, length: int) -> DataFrame:
    """``m, frag, k, th, start`` of every fragment whose gram another document uses as well."""

    def cut(batches):
        for b in slices(batches, CACHE_BYTES):
            data, owner, base = _joined(b.column("text").to_pylist())
            m, first, last = fragments(data, owner, length)
            doc = owner[first]
            wanted = [np.frombuffer(b"".join(g), np.uint64) for g in b.column("grams").to_pylist()]
            sizes = np.array([len(w) for w in wanted])
            index = np.repeat(np.arange(len(wanted)), sizes).astype(np.uint64) << np.uint64(48)
            keep = np.isin((doc.astype(np.uint64) << np.uint64(48)) | m, index | np.concatenate(wanted))
            m, first, last, doc = m[keep], first[keep], last[keep], doc[keep]
            raw = data.tobytes()
            frags = [raw[s : e + length] for s, e in zip(first.tolist(), last.tolist(), strict=True)]
            ks, ths = b.column("k").to_numpy(zero_copy_only=False), b.column("th").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(m.astype(np.int64)), pa.array(frags, pa.binary()), pa.array(ks[doc]), pa.array(ths[doc]), pa.array(first - base[doc])],
                ["m", "frag", "k", "th", "start"])

    return named.select("k", "th", "text").join(grams, ["k", "th"]).mapInArrow(cut, "m long, frag binary, k long, th long, start long")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, one value after another, and where each begins, with the end of the last."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def _packed_longs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Flat numbers as a binary column with so many numbers a row."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * 8
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def least_of(m: np.ndarray, frags: pa.Array, k: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest key of the string at each start of each fragment, flat, and the number of starts of each.

    Rows ascend by gram and every gram is whole.  A string whose hash stands alone has no equal; the stretches of all others
    are sorted in suffix arrays, which decide.
    """
    data, at = _flat(frags)
    starts = np.diff(at) - length + 1
    least = np.repeat(k, starts)
    same = m[1:] == m[:-1]
    rows = np.flatnonzero(np.append(False, same) | np.append(same, False))
    if not len(rows):
        return least, starts
    row = np.repeat(rows, starts[rows])
    inside = np.arange(len(row)) - np.repeat(np.cumsum(starts[rows]) - starts[rows], starts[rows])
    h = gram_hashes(data, length)[at[row] + inside]
    order = np.argsort(h)
    equal = h[order[1:]] == h[order[:-1]]
    shared = np.zeros(len(h), bool)
    shared[order[1:][equal]] = True
    shared[order[:-1][equal]] = True
    some = np.flatnonzero(shared)
    if not len(some):
        return least, starts
    row, inside = row[some], inside[some]
    new = np.append(True, (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(some)) - 1
    whose, low, high = row[first], inside[first], inside[last]
    # Blocks of about BLOCK_BYTES that keep the grams whole.
    gram = np.flatnonzero(np.append(True, m[whose[1:]] != m[whose[:-1]]))
    before = np.cumsum(high - low + length + 1) - (high - low + length + 1)
    block = before[gram] // BLOCK_BYTES
    edges = np.append(gram[np.flatnonzero(np.append(True, block[1:] != block[:-1]))], len(whose))
    raw, goes = data.tobytes(), (np.cumsum(starts) - starts)[row] + inside
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        begin, end = (at[whose[a:b]] + low[a:b]).tolist(), (at[whose[a:b]] + high[a:b] + length).tolist()
        found = classes([raw[i:j] for i, j in zip(begin, end, strict=True)], k[whose[a:b]], length)
        least[goes[first[a] : last[b - 1] + 1]] = np.concatenate(found)
    return least, starts


def smallest_keys(distinct: DataFrame, length: int) -> DataFrame:
    """``m, fp, least``: for each distinct fragment the smallest key of the string at each start, from suffix arrays.

    ``distinct``: m, frag, k (smallest key of the fragment), with all fragments of a gram.  Strings that no other fragment of
    the gram can have cost nothing further.
    """

    def run(batches):
        def solved(table):
            m, k = table.column(0).to_numpy(), table.column(2).to_numpy()
            least, starts = least_of(m, table.column(1), k, length)
            return pa.RecordBatch.from_arrays([table.column(0), table.column(3), _packed_longs(least, starts)], ["m", "fp", "least"])

        held = []
        for b in batches:
            if not b.num_rows:
                continue
            # The last gram of a batch may go on in the next one.
            m = b.column(0).to_numpy()
            cut = int(np.searchsorted(m, m[-1]))
            if cut or held and held[-1].column(0)[-1].as_py() != m[-1]:
                yield solved(pa.concat_batches([*held, b.slice(0, cut)]))
                held = []
            held.append(b.slice(cut))
        if held:
            yield solved(pa.concat_batches(held))

    ordered = distinct.repartition("m").sortWithinPartitions("m").select("m", "frag", "k", F.xxhash64("frag").alias("fp"))
    return ordered.mapInArrow(run, "m long, fp long, least binary")


def hot_grams(found: DataFrame) -> DataFrame:
    """``m`` of the grams whose fragments are too many for one task."""
    return found.groupBy("m").agg(F.sum(F.octet_length("frag")).alias("n")).where(F.col("n") > HOT_BYTES).select("m")


def smallest_keys_split(distinct: DataFrame, length: int) -> DataFrame:
    """The same as ``smallest_keys`` for grams of any size: strings are grouped as they are, and those that two fragments have
    come back to each by string and salt."""

    def packed(batches):
        for b in batches:
            least = [np.array(v, np.int64).tobytes() for v in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("m"), b.column("fp"), pa.array(least, pa.binary())], ["m", "fp", "least"])

    cut = F.expr(f"transform(sequence(1, length(frag) - {length} + 1), i -> substring(frag, i, {length}))")
    strings = distinct.select("m", F.xxhash64("frag").alias("fp"), "k", F.posexplode(cut).alias("at", "string"))
    shared = strings.groupBy("string").agg(F.min("k").alias("least"), F.count("*").alias("n")).where("n > 1")
    shared = shared.select("string", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = strings.withColumn("salt", F.pmod("fp", F.lit(SALTS)).cast("int")).join(shared, ["string", "salt"], "left")
    rows = both.groupBy("m", "fp").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("least", "k").alias("v")))).alias("x"))
    return rows.select("m", "fp", F.col("x.v").alias("v")).mapInArrow(packed, "m long, fp long, least binary")


def removed_ranges(found: DataFrame, length: int) -> DataFrame:
    """``k, th, s, e``: where strings start in a fragment that a smaller key has as well, as ranges of removed bytes."""
    def own(batches):
        for b in batches:
            if not b.num_rows:
                continue
            k, th, start = (b.column(c).to_numpy() for c in ("k", "th", "start"))
            data, at = _flat(b.column("least"))
            sizes = np.diff(at) // 8
            gone = np.flatnonzero(data.view(np.int64) < np.repeat(k, sizes))
            row = np.repeat(np.arange(len(k)), sizes)[gone]
            place = start[row] + gone - at[row] // 8
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (np.diff(place) > length))[: len(row)])
            last = np.append(first[1:], len(row))[: len(first)] - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (k[row[first]], th[row[first]], place[first], place[last] + length)], ["k", "th", "s", "e"])

    return found.mapInArrow(own, "k long, th long, s long, e long")


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) for every row."""
    named = _named(docs, key, text)
    found = stored(occurrences(named, shared_grams(named, length), length))
    hot = stored(hot_grams(found))
    any_hot, shares = not hot.isEmpty(), []
    for share in range(SHARES):
        some = found.where(F.col("m") % SHARES == share)
        distinct = some.groupBy("m", "frag").agg(F.min("k").alias("k"))
        if any_hot:
            split = smallest_keys_split(distinct.join(hot, "m", "left_semi"), length)
            least = stored(smallest_keys(distinct.join(hot, "m", "left_anti"), length).unionByName(split))
        else:
            least = stored(smallest_keys(distinct, length))
        marked = some.select("m", F.xxhash64("frag").alias("fp"), "k", "th", "start").join(least, ["m", "fp"])
        shares.append(stored(removed_ranges(marked, length)))
    ranges = stored(reduce(DataFrame.unionByName, shares).groupBy("k", "th").agg(F.collect_list(F.struct("s", "e")).alias("ranges")))

    def strip(batches):
        for b in slices(batches, 4 << 20):
            sizes, gone, spans, kept = [], [], [], []
            for t, r in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                parts, at, n, lost = [], 0, 0, 0
                for s, e in sorted((x["s"], x["e"]) for x in r or ()):
                    if s > at or not n:
                        parts.append(t[at:s])
                        n += 1
                    lost += max(0, e - max(s, at))
                    at = max(at, e)
                parts.append(t[at:])
                sizes.append(len(t))
                gone.append(lost)
                spans.append(n)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return named.join(ranges, ["k", "th"], "left").select("doc_id", "text", "ranges").mapInArrow(strip, schema)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
