"""Periodic runs of words, by recompression.

The words of many documents stand one after the other, a stop symbol of its own around each.  Block compression (equal
neighbours become one symbol for the symbol and its count) and pair compression (symbols are split into left and right ones, and each
left one followed by a right one becomes one symbol) alternate until a document is a handful of symbols.  That is a run-length
grammar: equal stretches of words are parsed alike but for one symbol at each edge and level, so how far two
places agree (the longest common extension, to the right or to the left) is found by going up while the parses agree and down
to the first difference, one step a level.

A run with at least four periods ``q`` covers four neighbouring multiples of ``q``, so it holds three neighbouring pairs ``(kq,
kq + q)`` of equal words, one of them with ``k`` divisible by three.  These places, ``n / 3q`` for each period, are the candidates; the
grammar extends each exactly in both directions.  All are looked at, in portions of bounded size.

Everything is one pass over the texts, without a shuffle; memory grows with the longest single text, which is one cell.  A null
text has no words.  Null keys, repeated rows and other columns are kept as they are.  A text without words has no run.
"""

from __future__ import annotations

import collections
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import map_texts, slices

PERIODS, SHORTEST = 4, 6  #: a run has four periods and six words at least
PORTION = 1 << 20  #: candidates looked at together
TOP = 8  #: compression ends when no document has more symbols
TEXT_BYTES = 1 << 20


# ---- grammar ----------------------------------------------------------------------------------------------------------


class Grammar:
    """Levels of a run-length grammar over one array of symbols; negative symbols are stops and are never compressed.

    ``symbols[l]`` is the string of level ``l``; ``first[l][i]`` where the ``i``-th symbol of level ``l`` starts in the level
    below (with the end as a last entry), ``parent[l][i]`` the symbol above, ``is_block[l]`` how level ``l`` was made.
    """

    def __init__(self, words: np.ndarray):
        self.symbols, self.first, self.parent, self.is_block = [words], [None], [], [None]
        self._fresh = int(words.max(initial=0)) + 1
        round_ = 0
        while self._longest() > TOP:
            self._compress_blocks()
            self._compress_pairs(round_)
            round_ += 1
        self.parent.append(None)

    def _longest(self) -> int:
        stops = np.flatnonzero(self.symbols[-1] < 0)
        return int(np.diff(stops).max(initial=0)) - 1

    def _add(self, starts: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        n = len(self.symbols[-1])
        heads = np.zeros(n, np.int32)
        heads[starts] = 1
        self.parent.append(np.cumsum(heads, dtype=np.int32) - 1)
        self.first.append(np.append(starts, n).astype(np.int32))
        self.symbols.append(symbols)
        self.is_block.append(block)

    def _name(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, equal for equal keys."""
        distinct, which = np.unique(keys, return_inverse=True)
        names = which + self._fresh
        self._fresh += len(distinct)
        return names

    def _compress_blocks(self) -> None:
        s = self.symbols[-1]
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(starts) == len(s):
            return
        lengths = np.diff(np.append(starts, len(s)))
        out = s[starts].copy()
        long = np.flatnonzero(lengths > 1)
        out[long] = self._name(out[long] * (len(s) + 1) + lengths[long])
        self._add(starts, out, True)

    def _compress_pairs(self, round_: int) -> None:
        s = self.symbols[-1]
        mixed = (s.astype(np.uint64) + np.uint64(round_ * 2 + 1)) * np.uint64(0x9E3779B97F4A7C15)
        side = (mixed >> np.uint64(40 + round_ % 20)) & np.uint64(1) == 1
        word = s >= 0
        forth = np.flatnonzero(~side[:-1] & side[1:] & word[:-1] & word[1:])
        back = np.flatnonzero(side[:-1] & ~side[1:] & word[:-1] & word[1:])
        pairs = forth if len(forth) >= len(back) else back
        if not len(pairs):
            return
        kept = np.ones(len(s), bool)
        kept[pairs + 1] = False
        starts = np.flatnonzero(kept)
        out = s[starts].copy()
        out[np.cumsum(kept)[pairs] - 1] = self._name(s[pairs] * self._fresh + s[pairs + 1])
        self._add(starts, out, False)

    def extend(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols from ``x`` and ``y`` on agree, to the right (``step`` 1) or to the left (-1).

        A stop stands before and after every document, and no two are equal, so every comparison ends.
        """
        here, there, top = x.astype(np.int64), y.astype(np.int64), len(self.symbols) - 1
        ended = np.full(len(x), top)
        active = np.arange(len(x))
        for level in range(top):  # up, as long as the parses agree
            a, b = here[active], there[active]
            differ = self.symbols[level][a] != self.symbols[level][b]
            ended[active[differ]] = level
            active, a, b = active[~differ], a[~differ], b[~differ]
            if not len(active):
                break
            pa_, pb = self.parent[level][a], self.parent[level][b]
            first = self.first[level + 1]
            # How many symbols of the parent are left in this direction, and whether it has been entered at its edge.
            left_a, left_b = (first[pa_ + 1] - a, first[pb + 1] - b) if step > 0 else (a - first[pa_] + 1, b - first[pb] + 1)
            edge = (left_a == first[pa_ + 1] - first[pa_]) & (left_b == first[pb + 1] - first[pb])
            if self.is_block[level + 1]:
                inside = ~edge & (left_a != left_b)  # the shorter rest of a block ends first
                least = np.minimum(left_a, left_b)[inside]
                ended[active[inside]] = level
                here[active[inside]], there[active[inside]] = a[inside] + step * least, b[inside] + step * least
                go = ~inside
                active, pa_, pb, edge = active[go], pa_[go], pb[go], edge[go]
            beyond = step * ~edge  # an equal symbol that ends its pair is passed, and the next parents are met at their edge
            here[active], there[active] = pa_ + beyond, pb + beyond
        while len(active):  # at the top a document has a handful of symbols
            active = active[self.symbols[top][here[active]] == self.symbols[top][there[active]]]
            here[active] += step
            there[active] += step
        for level in range(top, 0, -1):  # down to the first difference
            rows = np.flatnonzero(ended >= level)
            if not len(rows):
                continue
            first, below = self.first[level], self.symbols[level - 1]
            a, b = here[rows], there[rows]
            size = np.minimum(first[a + 1] - first[a], first[b + 1] - first[b])
            a, b = (first[a], first[b]) if step > 0 else (first[a + 1] - 1, first[b + 1] - 1)
            same = below[a] == below[b]
            passed = step * np.where(same, size if self.is_block[level] else 1, 0)
            here[rows], there[rows] = a + passed, b + passed
        return np.abs(here - x)


# ---- candidates -------------------------------------------------------------------------------------------------------


def _portions(sizes: np.ndarray):
    """Pairs of document and period, as arrays, in portions of about ``PORTION`` grid places."""
    most = sizes // PERIODS
    ends = np.cumsum(most)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, PORTION):
        pair = np.arange(low, min(low + PORTION, total))
        doc = np.searchsorted(ends, pair, side="right")
        period = pair - (ends[doc] - most[doc]) + 1
        places = (sizes[doc] - period - 1) // (3 * period) + 1
        cut = np.append(0, np.flatnonzero(np.diff(np.cumsum(places) // PORTION)) + 1)
        for a, b in itertools.pairwise(np.append(cut, len(pair))):
            yield doc[a:b], period[a:b], places[a:b]


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """``document, place, period`` of every third grid place that could lie in a run, portion by portion."""
    for doc, period, places in _portions(sizes):
        n = np.repeat(np.arange(len(doc)), places)
        k = np.arange(len(n)) - np.repeat(np.cumsum(places) - places, places)
        q, at = period[n], 3 * k * period[n]
        place = starts[doc[n]] + at
        hit = np.flatnonzero(words[place] == words[place + q])
        n, q, at, place = n[hit], q[hit], at[hit], place[hit]
        size = sizes[doc[n]]

        def equal(j):
            ok = (at + j * q >= 0) & (at + (j + 1) * q < size)
            i = np.where(ok, place + j * q, place)
            return ok & (words[i] == words[i + q])

        before, after = equal(-1), equal(1)
        found = np.flatnonzero((after & equal(2)) | (before & after) | (before & equal(-2)))
        if len(found):
            yield doc[n[found]], at[found], q[found]


def runs_of(texts: list[np.ndarray]) -> dict[int, np.ndarray]:
    """``{document: rows of start, length, period}``, sorted by start and period, for documents that have any run.

    ``texts`` are arrays of word numbers, equal for equal words across all of them.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    found = list(candidates(np.concatenate(texts), starts, sizes)) if sizes.sum() else []
    if not found:
        return {}
    chosen = np.unique(np.concatenate([d for d, _, _ in found]))
    # A stop before each chosen document and one after the last; the documents without candidates need no grammar.
    line, at = [np.array([-1], np.int64)], np.zeros(len(texts), np.int64)
    begin = 1
    for i, d in enumerate(chosen):
        at[d] = begin
        line += [texts[d], np.array([-2 - i], np.int64)]
        begin += len(texts[d]) + 1
    grammar = Grammar(np.concatenate(line))
    out = []
    for doc, place, period in found:
        x = at[doc] + place
        start = place - grammar.extend(x - 1, x + period - 1, -1)
        end = place + period + grammar.extend(x, x + period, 1)
        length = end - start
        keep = length >= np.maximum(SHORTEST, PERIODS * period)
        out.append(_primitive(np.stack([doc, start, length, period], axis=1)[keep]))
    rows = _primitive(np.concatenate(out))
    edges = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.array([], int)
    return {int(part[0, 0]): part[:, 1:] for part in np.split(rows, edges[1:]) if len(part)}


def _primitive(rows: np.ndarray) -> np.ndarray:
    """One row for each stretch, that of its smallest period: larger ones are its multiples, with the same edges."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    rows = rows[np.append(True, ~same)] if len(rows) else rows
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def strongest(runs: np.ndarray) -> tuple[int, int, int]:
    """The run with the greatest length over period, compared exactly; the first, then the shortest period, of several."""
    best = (0, 0, 1)
    for start, length, period in runs.tolist():
        if length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


# ---- documents ----------------------------------------------------------------------------------------------------------


def repeated_tail(words: list, seed: int) -> list:
    """The words with everything from ``seed % n`` on replaced by copies of what stands there first."""
    n = len(words)
    a = seed % n
    p = 1 + (n - a) // (3 + seed % 8)
    return words[:a] + list(itertools.islice(itertools.cycle(words[a : a + p]), n - a))


def collapse_runs(docs: DataFrame, keep: list[str], *, text: str = "text", tail: Column | None = None, digests: bool = False) -> DataFrame:
    """The columns of ``keep``; ``n_runs``; ``start, length, period, exponent_milli`` of the strongest run; ``runs`` and ``collapsed``.

    ``collapsed`` has the words that no run repeats, joined by one space.  ``tail``: a seed for ``repeated_tail``, or null.
    With ``digests`` the last two columns are ``runs_sha256`` and ``collapsed_sha256``.
    """
    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    made = [("n_runs", "long"), ("start", "long"), ("length", "long"), ("period", "long"), ("exponent_milli", "long")]
    made += [("runs_sha256", "string"), ("collapsed_sha256", "string")] if digests else [("runs", "array<struct<start:bigint,length:bigint,period:bigint>>"), ("collapsed", "string")]
    seed = F.lit(None).cast("long") if tail is None else tail.cast("long")
    body = F.struct(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), seed.alias("seed"))

    def run(batches):
        for whole in batches:
            parts = whole.column(whole.num_columns - 1)
            flat = pa.RecordBatch.from_arrays([*whole.columns[:-1], *parts.flatten()], [*whole.schema.names[:-1], "_text", "_seed"])
            for b in slices([flat], TEXT_BYTES, "_text"):
                yield b.select(list(range(b.num_columns - 2))), _collapsed(b, digests, struct)

    return map_texts(docs, keep, body, made, run)


def _collapsed(b, digests: bool, struct) -> list[pa.Array]:
    number = collections.defaultdict(itertools.count().__next__)
    split, ids = [], []
    for t, seed in zip(b.column("_text").to_pylist(), b.column("_seed").to_pylist(), strict=True):
        words = t.encode("utf-8", "surrogatepass").split()  # bytes part at exactly the six separators
        if seed is not None and words:
            words = repeated_tail(words, seed)
        split.append(words)
        ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    found = runs_of(ids)
    columns: list[list] = [[] for _ in range(7)]
    for i, words in enumerate(split):
        runs = found.get(i)
        row: list = [0, None, None, None, None]
        listed = []
        if runs is not None:
            start, length, period = strongest(runs)
            row = [len(runs), start, length, period, 1000 * length // period]
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            words = list(itertools.compress(words, (np.cumsum(change[:-1]) == 0).tolist()))
            listed = runs.tolist()
        data = b" ".join(words)
        if digests:
            spelled = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
            row += [hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(data).hexdigest()]
        else:
            row += [[{"start": s, "length": n, "period": q} for s, n, q in listed], data.decode("utf-8", "surrogatepass")]
        for c, v in zip(columns, row, strict=True):
            c.append(v)
    kinds = [pa.int64()] * 5 + ([pa.string()] * 2 if digests else [struct, pa.string()])
    return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
