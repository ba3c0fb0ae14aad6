"""Byte-level BPE by recursive DuckDB queries inside each partition.

A text is split by the tokenizer's pattern.  The words a task has not met before become rows (word, position, token),
one per byte, and a recursive query joins neighbouring rows with the merge table and contracts every word's leftmost pair of
least rank, until no pair is left.  Ordered aggregation gives each word's ids and, through the vocabulary, its bytes.
Texts are put together from their words, so a word costs one encoding however often a task meets it.

Narrow: no shuffle.  What a task keeps between texts is bounded (``CACHE`` words); texts themselves are never cut.  A null text is empty:
no tokens.  Rows are independent, so repeated rows and null keys are no special case.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import kept, map_texts, slices

#: Words a task keeps, and bytes of words that one recursive query takes.
CACHE, QUERY_BYTES = 800_000, 200_000

#: A contraction changes only the rows of the pair and the row before it; the others keep their rank.
CONTRACT = """
WITH RECURSIVE state(step, word, pos, token, next_pos, next_token, rank) AS (
  SELECT 0, word, pos, token, next_pos, next_token, merged
  FROM start LEFT JOIN merges ON pair = token::BIGINT << 20 | next_token
  UNION ALL (
    WITH best AS (
      SELECT word, min(rank::BIGINT << 32 | pos) AS choice FROM state WHERE rank IS NOT NULL GROUP BY word),
    pick AS (
      SELECT b.word, (b.choice >> 32)::INTEGER AS merged, l.pos AS l, r.pos AS r, r.next_pos AS after, r.next_token AS after_token
      FROM best b JOIN state l ON l.pos = (b.choice & 4294967295) JOIN state r ON r.pos = l.next_pos),
    moved AS (
      SELECT s.step + 1 AS step, s.word, s.pos,
        CASE WHEN s.pos = p.l THEN p.merged ELSE s.token END AS token,
        CASE WHEN s.pos = p.l THEN p.after ELSE s.next_pos END AS next_pos,
        CASE WHEN s.pos = p.l THEN p.after_token WHEN s.next_pos = p.l THEN p.merged ELSE s.next_token END AS next_token,
        s.rank, s.pos = p.l OR s.next_pos = p.l AS changed
      FROM state s JOIN pick p USING (word) WHERE s.pos <> p.r)
    SELECT step, word, pos, token, next_pos, next_token, CASE WHEN changed THEN merged ELSE rank END
    FROM moved LEFT JOIN merges ON pair = CASE WHEN changed THEN token::BIGINT << 20 | next_token END)),
last AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, list(token ORDER BY pos) AS ids, list(bytes ORDER BY pos) AS bytes
FROM state JOIN last USING (word, step) JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""

#: For long words: all pairs of the least rank at once, every second one where they overlap.  In a vocabulary whose tokens
#: are built from tokens of lower rank, no contraction makes a pair of lower rank than its own, so the result is the same.
#: A query stops after some steps and leaves the state to the next one, so that what it holds is bounded.
CONTRACT_LONG = """
CREATE OR REPLACE TEMP TABLE resumed AS
WITH RECURSIVE state(step, word, pos, token, next_pos, next_token, rank) AS (
  SELECT 0, word, pos, token, next_pos, next_token, rank FROM held
  UNION ALL (
    WITH best AS (SELECT word, min(rank) AS rank FROM state WHERE rank IS NOT NULL AND step < {steps} GROUP BY word),
    alike AS (
      SELECT s.*, coalesce(lag(next_pos) OVER (ORDER BY pos) <> pos, true) AS opens FROM state s JOIN best USING (word, rank)),
    runs AS (SELECT *, sum(opens::INTEGER) OVER (ORDER BY pos) AS run FROM alike),
    turns AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY pos) AS turn FROM runs),
    pick AS (
      SELECT l.rank AS merged, l.pos AS l, r.pos AS r, r.next_pos AS after, r.next_token AS after_token
      FROM turns l JOIN state r ON r.pos = l.next_pos WHERE l.turn % 2 = 1),
    moved AS (
      SELECT s.step + 1 AS step, s.word, s.pos, coalesce(p.merged, s.token) AS token,
        CASE WHEN p.l IS NULL THEN s.next_pos ELSE p.after END AS next_pos,
        CASE WHEN p.l IS NULL THEN s.next_token ELSE p.after_token END AS next_token
      FROM state s SEMI JOIN best b ON b.word = s.word LEFT JOIN pick p ON p.l = s.pos ANTI JOIN pick gone ON gone.r = s.pos),
    linked AS (
      SELECT m.step, m.word, m.pos, m.token, m.next_pos, coalesce(n.merged, m.next_token) AS next_token
      FROM moved m LEFT JOIN pick n ON n.l = m.next_pos)
    SELECT step, word, pos, token, next_pos, next_token, merged
    FROM linked LEFT JOIN merges ON pair = token::BIGINT << 20 | next_token)),
last AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, pos, token, next_pos, next_token, rank FROM state JOIN last USING (word, step)
"""
GATHER = """
SELECT word, list(token ORDER BY pos) AS ids, list(bytes ORDER BY pos) AS bytes
FROM held JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""
#: Bytes from which a word is long, and rows that one query over long words may hold.
LONG, HELD_ROWS = 64, 1_500_000

#: Letters of these ranges only, besides ASCII: such texts can be split by the standard library, which is faster.
LATIN = "À-ÖØ-öø-ÿ"


@dataclass(frozen=True)
class Tokenizer:
    """Ranks by bytes, as in a rank file, and the pattern that splits texts."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Tokenizer:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}, pattern)

    @functools.cached_property
    def digest(self) -> str:
        """Names the vocabulary and the pattern, in whatever process they are."""
        listed = "".join(f"{t.hex()} {r}\n" for t, r in sorted(self.ranks.items()))
        return hashlib.sha256(f"{self.pattern}\n{listed}".encode()).hexdigest()

    @functools.cached_property
    def splitter(self):
        return regex.compile(self.pattern)

    @functools.cached_property
    def fast_splitter(self):
        """The same pattern for texts of ASCII and LATIN, or None if it uses more than the classes known here."""
        plain = self.pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\sA-Za-z{LATIN}0-9]").replace(r"\p{L}", f"[A-Za-z{LATIN}]").replace(r"\p{N}", "[0-9]")
        return None if r"\p" in plain or r"\P" in plain else re.compile(plain, re.ASCII)

    def split(self, text: str) -> list[str]:
        simple = self.fast_splitter is not None and _SIMPLE.fullmatch(text)
        return (self.fast_splitter if simple else self.splitter).findall(text)

    @functools.cached_property
    def connection(self) -> duckdb.DuckDBPyConnection:
        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs = [
            (self.ranks[t[:i]] << 20 | self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        con.register("given", pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "merged": pa.array([m for _, m in pairs], pa.int32())}))
        con.execute("CREATE TABLE merges AS SELECT * FROM given")
        con.register("given", pa.table({"token": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(list(self.ranks), pa.binary())}))
        con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        con.unregister("given")
        return con

    @functools.cached_property
    def of_byte(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    def __getstate__(self):
        return self.ranks, self.pattern

    def __setstate__(self, state):
        object.__setattr__(self, "ranks", state[0])
        object.__setattr__(self, "pattern", state[1])

    def encode_words(self, words: list[str]) -> list[tuple[list[int], bytes]]:
        """Ids and decoded bytes of each (not empty) word."""
        datas = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list = [None] * len(words)
        for long in (False, True):
            batch, size = [], 0
            chosen = [i for i, d in enumerate(datas) if (len(d) >= LONG) == long]
            for n, i in enumerate(chosen, 1):
                batch.append(i)
                size += len(datas[i])
                if size >= QUERY_BYTES or n == len(chosen):
                    for j, found in zip(batch, self._contract([datas[j] for j in batch], long), strict=True):
                        out[j] = found
                    batch, size = [], 0
        return out

    def _contract(self, words: list[bytes], long: bool) -> list[tuple[list[int], bytes]]:
        lengths = np.array([len(w) for w in words])
        token = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        at = np.arange(len(token), dtype=np.int64)
        last = np.zeros(len(token), bool)
        last[np.cumsum(lengths) - 1] = True
        start = pa.table({
            "word": pa.array(np.repeat(np.arange(len(words), dtype=np.int32), lengths)), "pos": at, "token": token,
            "next_pos": pa.array(at + 1, mask=last), "next_token": pa.array(np.append(token[1:], np.int32(0)), mask=last),
        })
        con = self.connection
        con.register("start", start)
        if not long:
            found = con.sql(CONTRACT).to_arrow_table()
        else:
            con.execute("CREATE OR REPLACE TEMP TABLE held AS SELECT start.*, merged AS rank FROM start LEFT JOIN merges ON pair = token::BIGINT << 20 | next_token")
            while con.sql("SELECT count(rank) FROM held").fetchall()[0][0]:
                con.execute(CONTRACT_LONG.format(steps=max(1, HELD_ROWS // len(token))))
                con.execute("CREATE OR REPLACE TEMP TABLE held AS FROM resumed")
            found = con.sql(GATHER).to_arrow_table()
        return [(i, b"".join(b)) for i, b in zip(found.column("ids").to_pylist(), found.column("bytes").to_pylist(), strict=True)]


_SIMPLE = re.compile(f"[\x00-\x7f{LATIN}]*")


class WordTable:
    """What a task knows: ids and bytes by word.  Emptied when it is full, so that its size is bounded."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.ids, self.bytes = tokenizer, {}, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > CACHE:
            self.ids, self.bytes, new = {}, {}, list(words)
        for w, (ids, data) in zip(new, self.tokenizer.encode_words(new), strict=True):
            self.ids[w] = " ".join(map(str, ids))
            self.bytes[w] = data

    def rest(self) -> None:
        """Between tasks only the words stay: DuckDB holds on to what its largest query took."""
        if con := self.tokenizer.__dict__.pop("connection", None):
            con.close()


def encode(docs: DataFrame, tokenizer: Tokenizer, keep: list[str], *, text: str = "text", with_ids: bool = True) -> DataFrame:
    """The columns of ``keep``, ``n_tokens``, ``ids`` (decimal, joined by one space), ``decoded`` (bytes from the ids).

    Without ``with_ids`` the last two are replaced by their SHA-256, ``ids_sha256`` and ``decoded_sha256``.
    """
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)  # as large as the vocabulary, whatever the corpus
    names, kinds = (("ids", "decoded"), (pa.string(), pa.binary())) if with_ids else (("ids_sha256", "decoded_sha256"), (pa.string(), pa.string()))
    key = tokenizer.digest

    def run(batches):
        known = kept(("words", key), lambda: WordTable(held.value))
        try:
            yield from encoded(known, batches)
        finally:
            known.rest()

    def encoded(known, batches):
        for b in slices(batches, 1 << 20, "_text"):
            split = [held.value.split(t) for t in b.column("_text").to_pylist()]
            known.learn(set().union(*split))
            counts, first, second = [], [], []
            for words in split:
                ids, data = " ".join(map(known.ids.__getitem__, words)), b"".join(map(known.bytes.__getitem__, words))
                counts.append(ids.count(" ") + 1 if words else 0)
                first.append(ids if with_ids else hashlib.sha256(ids.encode()).hexdigest())
                second.append(data if with_ids else hashlib.sha256(data).hexdigest())
            yield b, [pa.array(counts, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])]

    spark_kinds = ("string", "binary") if with_ids else ("string", "string")
    made = [("n_tokens", "long"), *zip(names, spark_kinds, strict=True)]
    return map_texts(docs, keep, F.coalesce(F.col(text).cast("string"), F.lit("")), made, run)
