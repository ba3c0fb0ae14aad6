"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

A document's set is its distinct five-word shingles.  The sketch fills k coordinates in rounds: in each of the first k
rounds every shingle falls into a random bin with a random value, in each of the next k all shingles fall into one given bin,
and an earlier round always beats a later one.  So every coordinate is filled after 2k rounds whatever the size of the set, mostly
after one, and the share of equal coordinates concentrates around the similarity like that of k independent minima.

Bands of ``ROWS`` coordinates make buckets.  Documents with equal sets are one node from the start.  All members of a
bucket are first compared with one of them, the one that meets most others (twice), and members that are connected by then are settled.
Bands miss a link of similarity 0.75 with probability 2e-5, and signatures, which those that meet are matched by, with 1.2e-5.

So neither decides: a last turn finds every link between components that are still apart.  Two linked sets share one of their
rarest shingles (a quarter of each set and one more, in one order for the whole corpus), and those that more than one set has are
buckets too.  A pair meets in the bucket of the first shingle that both have; others are left out where the shingles before it are
equal or too few follow.  It is verified in full unless the sizes or the parities of the sets prove that it is no link.

Documents without words have an empty set and stand alone.  A null key stands alone with a null component and is kept.
Rows that share a key are named alike: each goes by its own text.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.projection import materialise
from .columns import let_go, slices

SHINGLE = 5
BANDS, ROWS = 40, 5
#: One bit of every coordinate makes the signature of a set.  Two sets of similarity 0.75 differ in an eighth of the bits;
#: pairs that differ in more than four and a half deviations above that (probability 1.2e-5) wait for the last turn.
COORDINATES = 512
WORDS = COORDINATES // 64
DEVIATIONS = 4.5
#: Shingles that meet in one bucket when the sets that have them are counted.
BUCKET_SHINGLES = 1 << 20
#: Shingles of the sets whose counts come back to one group.
GROUP_SHINGLES = 1 << 21
#: Bytes of text whose shingles are made at a time, so that they stay near the processor and a worker small.
CACHE_BYTES = 1 << 18
#: Sets that leave a worker at a time.
ROWS_OUT = 2048

_BYTE = np.random.default_rng(20240901).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PARITY = 0x3C79AC492BA7B653
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending, one text after another, and the number in each."""
    n_docs = len(texts)
    # A space after every text keeps words of neighbours apart.
    data = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    sizes = np.zeros(n_docs, np.int64)
    if not len(starts):
        return np.empty(0, np.uint64), sizes
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else None
    if place is None:
        place = np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))])
    longest = int((ends - starts).max())
    place = np.minimum(place, longest)
    valued = _BYTE[data] * _powers(0x9E3779B97F4A7C15, longest + 1)[place]
    valued[space] = 0
    word = mix(np.add.reduceat(valued, starts) + (ends - starts).astype(np.uint64))
    doc_end = np.cumsum([len(t) + 1 for t in texts])
    doc_of_word = np.searchsorted(doc_end, starts, side="right")
    n_words = np.bincount(doc_of_word, minlength=n_docs)
    first_word = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    grams, owners = [], []
    if len(word) >= SHINGLE:
        total = np.zeros(len(word) - SHINGLE + 1, np.uint64)
        for k, p in enumerate(_powers(0xD6E8FEB86659FD93, SHINGLE)):
            total += word[k : len(word) - SHINGLE + 1 + k] * p
        inside = doc_of_word[: len(total)] == doc_of_word[SHINGLE - 1 :]
        grams.append(mix(total[inside]))
        owners.append(doc_of_word[: len(total)][inside])
    for d in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        own = word[first_word[d] : first_word[d] + n_words[d]]
        grams.append(mix((own * _powers(0xA0761D6478BD642F, len(own))).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))))
        owners.append(np.array([d]))
    h, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
    return h[new], np.bincount(owner[new], minlength=n_docs)


def sketches(h: np.ndarray, sizes: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """An (n, k) array: round and value of the first shingle in each bin.  Rows of empty sets mean nothing."""
    n = len(sizes)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * k, empty)
    open_, owner = np.arange(n), np.repeat(np.arange(n), sizes)
    for i in range(2 * k):
        if not len(h):
            break
        x = mix(h + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bin_ = ((x >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64) if i < k else np.full(len(h), i - k)
        np.minimum.at(out, owner * k + bin_, np.uint64(i) << np.uint64(32) | x & np.uint64(0xFFFFFFFF))
        if i >= 8 and i % 8:  # a round too many changes nothing: earlier ones beat it
            continue
        still = (out.reshape(n, k)[open_] == empty).any(axis=1)
        if not still.all():
            left = np.zeros(n, bool)
            left[open_[still]] = True
            open_, left = open_[still], left[owner]
            h, owner = h[left], owner[left]
    return out.reshape(n, k)


def bands_of(sketch: np.ndarray) -> np.ndarray:
    """The bucket of each band, as signed 64-bit numbers that differ between bands."""
    parts = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for r in range(ROWS):
        total = mix(total + parts[:, :, r])
    return total.view(np.int64)


def signatures(sketch: np.ndarray) -> np.ndarray:
    """One bit of every coordinate, packed into signed 64-bit numbers."""
    bits = np.packbits((mix(sketch) & np.uint64(1)).astype(np.uint8), axis=1)
    return np.ascontiguousarray(bits).view(np.int64)


def parities(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of 512 bins, modulo two, packed like signatures.

    A shingle that only one of two sets has changes one bit, so sets differ in no more bits than shingles.
    """
    n = len(sizes)
    bins = np.repeat(np.arange(n), sizes) * COORDINATES + (mix(h ^ np.uint64(_PARITY)) >> np.uint64(32)).astype(np.int64) % COORDINATES
    bits = np.packbits((np.bincount(bins, minlength=n * COORDINATES) & 1).astype(np.uint8).reshape(n, COORDINATES), axis=1)
    return np.ascontiguousarray(bits).view(np.int64)


def _digests(h: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two numbers that name each set."""
    bounds, out = np.concatenate([[0], np.cumsum(sizes)]), []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)), dtype=np.uint64)])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out


def _names(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Both numbers and the size as one, by which a set is called where its shingles are counted."""
    return mix(d1.view(np.uint64) + mix(d2.view(np.uint64) + sizes.astype(np.uint64))).view(np.int64)


def _short(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct leading 48 bits of the shingles of each set, and their owner."""
    m, owner = h >> np.uint64(16), np.repeat(np.arange(len(sizes)), sizes)
    new = np.append(True, (m[1:] != m[:-1]) | (owner[1:] != owner[:-1]))[: len(m)]
    return m[new], owner[new]


def _six(m: np.ndarray) -> np.ndarray:
    """Numbers of 48 bits as rows of six bytes."""
    return np.ascontiguousarray(m).view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).ravel()


def _encoded(column) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _sketch_rows(batches):
    let_go()
    for b in slices(batches, 1 << 20):
        h, sizes = shingle_sets(_encoded(b.column("text")))
        sketch = sketches(h, sizes)
        digests = _digests(h, sizes)
        lists = [
            pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            for x in (bands_of(sketch), signatures(sketch), parities(h, sizes))]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("th"), pa.array(sizes.astype(np.int64)), pa.array(digests[0]), pa.array(digests[1]),
             pa.array(_names(*digests, sizes)), pa.array(np.bincount(_short(h, sizes)[1], minlength=len(sizes)).astype(np.int64)), *lists],
            ["doc_id", "th", "n_shingles", "d1", "d2", "name", "t", "bands", "signs", "parity"])


def _set_rows(batches):
    for b in slices(batches, CACHE_BYTES):
        h, sizes = shingle_sets(_encoded(b.column("text")))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        sets = [h[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _linked(least: tuple[int, int]):
    over, under = least

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(under * both >= over * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verify(pairs: DataFrame, sets: DataFrame, least: tuple[int, int] = (75, 100)) -> DataFrame:
    """The pairs whose full sets have intersection / union of at least ``least``.  A hot end is split by the join."""
    y = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    both = y.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y")
    return both.mapInArrow(_linked(least), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every end of an edge ``a, b``: alternating large and small stars.

    A node's smallest neighbour is an aggregate and comes back by a join, so the neighbours of a hub are never gathered.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())

    def mark(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = None
    while (now := mark(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = materialise(small.distinct())
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _with_component(members: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return members.withColumn("c", F.col("node"))
    found = materialise(components(links))
    return members.join(found, "node", "left").select(*members.columns, F.coalesce("component", "node").alias("c"))


def alike(least: tuple[int, int]) -> str:
    """SQL over two members (r: the other one): sizes allow a link and signatures make it likely.  Of links at the threshold, 1.2e-5 do not fit."""
    over, under = least
    differ = (1 - over / under) / 2
    most = COORDINATES * differ + DEVIATIONS * (COORDINATES * differ * (1 - differ)) ** 0.5
    bits = " + ".join(f"bit_count(signs[{i}] ^ rsigns[{i}])" for i in range(WORDS))
    return f"{under} * least(n, rn) >= {over} * greatest(n, rn) AND {bits} <= {int(most)}"


def possible(least: tuple[int, int]) -> str:
    """SQL over two members: sizes and parities do not rule a link out.  Every link fits."""
    over, under = least
    bits = " + ".join(f"bit_count(parity[{i}] ^ rparity[{i}])" for i in range(WORDS))
    return f"{under} * least(n, rn) >= {over} * greatest(n, rn) AND {under + over} * ({bits}) <= {under - over} * (n + rn)"


def first_shared(least: tuple[int, int]) -> str:
    """SQL over two members of a rare bucket: it may be the first shingle that both sets have.  Every link fits in one bucket at least.

    Nothing before the first one is shared, so no more than what follows in either set can be; and where the rare shingles
    right before are the same, it is not the first.
    """
    over, under = least
    return f"NOT coalesce(before = rbefore, false) AND {under + over} * least(n - at, rn - rat) >= {over} * (n + rn)"


def rare_shingles(docs: DataFrame, sets: DataFrame, total: int, least: tuple[int, int]) -> DataFrame:
    """``node, n, rare`` for every set (``name, node, n, t``): those of its rarest shingles that another set has as well.

    ``rare`` has each with ``at``, how many of the set come before it, and ``before``, the rare one right before it.

    Linked sets have at least ``least`` of the larger one in common, so in any order of all shingles they share one of the first
    n - ceil(least * n) + 1 of each.  The order is by the number of sets that have a shingle; those that one set alone has come
    first and meet nothing.  Shingles go by 48 bits: where two of a set coincide, the same number of first ones is still enough.
    """
    buckets, groups, (over, under) = max(8, -(-total // BUCKET_SHINGLES)), max(8, -(-total // GROUP_SHINGLES)), least

    def packed(rows, names):
        types = (pa.int64(), *[pa.binary()] * (len(names) - 1))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def deal(batches):
        let_go()
        names, owner, m = [], [], []

        def dealt():
            every, who, short = np.concatenate(names), np.concatenate(owner), np.concatenate(m)
            names.clear(), owner.clear(), m.clear()
            bucket = ((short >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable").astype(np.int32)
            bounds = np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))
            rows = []
            for i in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[i] : bounds[i + 1]]
                # Owners ascend in a bucket, so a set's name and the number of its shingles tell whose they are.
                first = np.flatnonzero(np.append(True, np.diff(who[at]) > 0))
                n = np.diff(np.append(first, len(at)))
                rows.append((int(i), every[who[at[first]]].tobytes(), n.astype(np.int32).tobytes(), _six(short[at]).tobytes()))
            return packed(rows, ["bucket", "names", "sizes", "shingles"])

        docs = held = 0
        for b in slices(batches, CACHE_BYTES):
            h, sizes = shingle_sets(_encoded(b.column("text")))
            if not len(h):
                continue
            short, who = _short(h, sizes)
            names.append(_names(*_digests(h, sizes), sizes))
            owner.append((who + docs).astype(np.int32))
            m.append(short)
            docs, held = docs + len(sizes), held + len(short)
            if held >= BUCKET_SHINGLES:
                yield dealt()
                docs = held = 0
        if held:
            yield dealt()

    def counted(held):
        names = np.concatenate([np.frombuffer(r[0], np.int64) for r in held])
        owner = np.repeat(np.arange(len(names), dtype=np.int32), np.concatenate([np.frombuffer(r[1], np.int32) for r in held]))
        m = _from_six(b"".join(r[2] for r in held))
        held.clear()
        # Equal sets are one.
        names, first, name = np.unique(names, return_index=True, return_inverse=True)
        kept = np.zeros(len(name), bool)
        kept[first] = True
        kept = kept[owner]
        m, owner = m[kept], name.astype(np.int32)[owner[kept]]
        order = np.argsort(m).astype(np.int32)
        m, owner = m[order], owner[order]
        start = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        sizes = np.diff(np.append(start, len(m)))
        used = np.repeat(np.minimum(sizes, 65535).astype(np.uint16), sizes)  # an order, so the most frequent may be equal in it
        shared = used > 1
        m, owner, used = m[shared], owner[shared], used[shared]
        order = np.argsort(owner, kind="stable").astype(np.int32)
        m, owner, used = m[order], owner[order], used[order]
        n = np.bincount(owner, minlength=len(names))
        some = np.flatnonzero(n)
        names, n = names[some], n[some]
        # Names ascend, and so do the groups they go back to: one row for each group, not one for each set.
        group = ((names.view(np.uint64) >> np.uint64(32) ^ np.uint64(1 << 31)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        new = np.flatnonzero(np.append(True, np.diff(group) > 0)[: len(group)])
        ends, entry = np.append(new[1:], len(group)), np.append(0, np.cumsum(n))
        rows = [
            (int(group[i]), names[i:j].tobytes(), n[i:j].astype(np.int32).tobytes(), _six(m[entry[i] : entry[j]]).tobytes(), used[entry[i] : entry[j]].tobytes())
            for i, j in zip(new.tolist(), ends[: len(new)].tolist(), strict=True)]
        return packed(rows, ["group", "names", "sizes", "m", "used"]) if rows else None

    def meet(batches):
        let_go()
        bucket, held = None, []
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != bucket:
                    if held and (found := counted(held)):
                        yield found
                    bucket, held = row[0], []
                held.append(row[1:])
        if held and (found := counted(held)):
            yield found

    def cut(known, blocks):
        """The rarest shingles of the sets of one group: name, node, n, t of each, and what the buckets found of them."""
        name, node, n, t = (np.concatenate(x) for x in zip(*known, strict=True))
        order = np.argsort(name)
        name, node, n, t = name[order], node[order], n[order], t[order]
        found = np.concatenate([np.frombuffer(r[0], np.int64) for r in blocks])
        whose = np.repeat(np.searchsorted(name, found).astype(np.int32), np.concatenate([np.frombuffer(r[1], np.int32) for r in blocks]))
        m = _from_six(b"".join(r[2] for r in blocks)).view(np.int64)
        used = np.frombuffer(b"".join(r[3] for r in blocks), np.uint16)
        order = np.lexsort((m, used, whose)).astype(np.int32)
        m, whose = m[order], whose[order]
        shared = np.bincount(whose, minlength=len(name))
        rank = np.arange(len(m)) - np.repeat(np.cumsum(shared) - shared, shared)
        alone = t - shared
        most = n + over * n // -under + 1 - alone
        before = np.append(-1, m)[: len(m)]
        first = rank == 0
        keep = np.flatnonzero(rank < most[whose])
        whose, rank = whose[keep], rank[keep]
        flat = [pa.array(m[keep]), pa.array(alone[whose] + rank), pa.array(before[keep], mask=first[keep])]
        sizes = np.bincount(whose, minlength=len(name))
        some = np.flatnonzero(sizes)
        ends = pa.array(np.append(0, np.cumsum(sizes[some])).astype(np.int32))
        rare = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["bucket", "at", "before"]))
        table = pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(n[some]), rare], ["node", "n", "rare"])
        for i in range(0, len(some), ROWS_OUT):
            yield table.slice(i, ROWS_OUT)

    def rarest(batches):
        group, known, blocks = None, [], []
        for b in batches:
            of = b.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, of[1:] != of[:-1]))[: len(of)]
            for i, j in zip(edges.tolist(), np.append(edges[1:], len(of)).tolist(), strict=False):
                if of[i] != group:
                    if blocks:
                        yield from cut(known, blocks)
                    group, known, blocks = of[i], [], []
                part = b.slice(i, j - i)
                sets_ = part.filter(pc.is_valid(part.column(1)))
                known.append([sets_.column(c).to_numpy() for c in range(1, 5)])
                packs = part.filter(pc.is_null(part.column(1)))
                blocks += zip(*(packs.column(c).to_pylist() for c in range(5, 9)), strict=True)
        if blocks:
            yield from cut(known, blocks)

    dealt = docs.select("text").mapInArrow(deal, "bucket long, names binary, sizes binary, shingles binary")
    met = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "group long, names binary, sizes binary, m binary, used binary")
    group = F.expr(f"shiftright((shiftrightunsigned(name, 32) ^ 2147483648L) * {groups}L, 32)").alias("group")
    both = sets.select(group, "name", "node", "n", "t").unionByName(met, allowMissingColumns=True)
    ordered = both.repartition(groups, "group").sortWithinPartitions("group")
    return ordered.mapInArrow(rarest, "node long, n long, rare array<struct<bucket:long,at:long,before:long>>")


def _buckets(placed: DataFrame) -> DataFrame:
    """The rows of ``bucket, node, n`` whose bucket has more than one member."""
    shared = placed.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    return materialise(placed.join(shared, "bucket", "left_semi"))


def _apart(members: DataFrame, links: DataFrame | None, signs: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with component, size of the bucket and signs."""
    state = _with_component(members, links)
    apart = state.groupBy("bucket", "c").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.sum("k").alias("size"), F.count("*").alias("parts"))
    return materialise(state.join(apart.where("parts > 1").select("bucket", "size"), "bucket").join(signs, "node"))


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    return materialise(docs.join(nodes, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_set_rows, "node long, shingles binary"))


def near_links(members: DataFrame, signs: DataFrame, rare: DataFrame, docs: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Verified links that connect all linked nodes.

    ``members``: bucket, node, n (size of its set); ``signs``: node, signs, parity; ``rare``: like ``members``, with at and before,
    each linked pair in one bucket at least.  Three turns: two with one member of each bucket against the others, the last with
    all of ``rare`` that are still apart.
    """
    fits, links, tested = F.expr(f"{alike(least)} AND {possible(least)}"), None, None
    involved = materialise(members.select(F.col("node").alias("doc_id")).distinct())
    sets = _sets_of(docs, involved)
    own = materialise(signs.join(involved.withColumnRenamed("doc_id", "node"), "node", "left_semi"))
    for _ in range(2):
        open_ = _apart(members, links, own)
        # The member that meets most others in all its buckets is the likeliest centre of its group.
        met = open_.groupBy("node").agg(F.sum("size").alias("met"))
        order = F.struct((-F.col("met")).alias("o"), "node", "n", "c", "signs", "parity")
        one = open_.join(met, "node").groupBy("bucket").agg(F.min(order).alias("m"))
        other = one.select("bucket", *(F.col(f"m.{x}").alias(y) for x, y in (("node", "r"), ("n", "rn"), ("c", "rc"), ("signs", "rsigns"), ("parity", "rparity"))))
        pairs = open_.join(other, "bucket").where((F.col("c") != F.col("rc")) & fits)
        pairs = pairs.select(F.least("node", "r").alias("a"), F.greatest("node", "r").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs)
        found = verify(pairs, sets, least)
        links = materialise(found if links is None else links.union(found))
        tested = pairs if tested is None else tested.union(pairs)
    open_ = _apart(rare, links, signs.select("node", "parity"))
    other = open_.select("bucket", *(F.col(x).alias(y) for x, y in (("node", "r"), ("n", "rn"), ("c", "rc"), ("at", "rat"), ("before", "rbefore"), ("parity", "rparity"))))
    meet = (F.col("c") < F.col("rc")) & F.expr(first_shared(least)) & F.expr(possible(least))
    pairs = open_.join(other, "bucket").where(meet).select(F.least("node", "r").alias("a"), F.greatest("node", "r").alias("b")).distinct()
    pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti"))
    sets = _sets_of(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    return links.union(materialise(verify(pairs, sets, least)))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: tuple[int, int] = (75, 100)) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, th`` for every row: links where under * intersection >= over * union.

    ``th`` is the 64-bit hash of the text, which with the key names a row.
    """
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("th"), F.col(text).cast("string").alias("text"))
    rows = materialise(named.mapInArrow(_sketch_rows, "doc_id long, th long, n_shingles long, d1 long, d2 long, name long, t long, bands array<long>, signs array<long>, parity array<long>"))
    real = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["d1", "d2", "n_shingles"]
    nodes = materialise(real.groupBy(*same).agg(F.min("doc_id").alias("node"), F.min_by(F.struct("name", "t", "bands", "signs", "parity"), "doc_id").alias("x")).select(*same, "node", "x.*"))
    placed = nodes.select(F.explode("bands").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    rare = rare_shingles(named.where("doc_id IS NOT NULL"), nodes.select("name", "node", F.col("n_shingles").alias("n"), "t"), total, least)
    rare = _buckets(materialise(rare.select("node", "n", F.inline("rare"))))
    signs = nodes.select("node", "signs", "parity")
    found = materialise(components(near_links(_buckets(placed), signs, rare, named, least)))
    classes = nodes.select(*same, "node").join(found, "node", "left").select(*same, F.coalesce("component", "node").alias("component_id"))
    out = rows.select("doc_id", "th", *same).join(classes, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "th")


def keep_one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: tuple[int, int] = (75, 100)) -> DataFrame:
    """The same columns, one document of each component left: the one with the smallest key."""
    dropped = near_duplicates(docs, key=key, text=text, least=least).where("NOT kept")
    dropped = materialise(dropped.select(F.col("doc_id").alias("_dropped"), F.col("th").alias("_dropped_th")).distinct())
    same = (docs[key].cast("long") == dropped["_dropped"]) & (F.xxhash64(docs[text].cast("string")) == dropped["_dropped_th"])
    return docs.join(dropped, same, "left_anti")
