"""Cases that the findings of round 3 name."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from corpusgate.llm import bpe, columns, minhash, suffix


@pytest.mark.parametrize("block", [1 << 17, 100])
def test_only_strings_that_may_repeat_are_sorted(monkeypatch, block):
    """op1: fragments of one gram mostly have no string in common; those went through the suffix arrays whole."""
    sorted_bytes, classes = [], suffix.classes

    def watched(frags, keys, length):
        sorted_bytes.append(sum(map(len, frags)))
        return classes(frags, keys, length)

    monkeypatch.setattr(suffix, "classes", watched)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    rng, length, rows = np.random.default_rng(3), 50, []
    for m in range(40):
        base = bytes(rng.integers(97, 123, 200, dtype=np.uint8))
        for _ in range(rng.integers(1, 5)):
            a = rng.integers(0, 100)
            rows.append((m, base[a : a + rng.integers(50, 100)], int(rng.integers(0, 50))))
        rows += [(m, bytes(rng.integers(97, 123, 90, dtype=np.uint8)), 7) for _ in range(5)]
    best: dict = {}
    for m, f, k in rows:
        for i in range(len(f) - length + 1):
            best[m, f[i : i + length]] = min(best.get((m, f[i : i + length]), 99), k)
    column = pa.array([b"before", *(f for _, f, _ in rows)], pa.binary()).slice(1)
    least, starts = suffix.least_of(np.array([m for m, _, _ in rows]), column, np.array([k for *_, k in rows]), length)
    assert least.tolist() == [best[m, f[i : i + length]] for m, f, _ in rows for i in range(len(f) - length + 1)]
    assert starts.tolist() == [len(f) - length + 1 for _, f, _ in rows]
    assert 0 < sum(sorted_bytes) < sum(len(f) for _, f, _ in rows) / 2


def test_counts_come_back_by_group_not_by_set_and_bucket(spark, monkeypatch):
    """op2, pipeline (near_duplicates): every set had a row for every bucket that its shingles fall into."""
    docs = [(i, " ".join(f"w{(i // 2 * 37 + j) % 500}" for j in range(60))) for i in range(300)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    made, whole = [], type(docs).mapInArrow

    def watched(self, func, *args, **more):
        out = whole(self, func, *args, **more)
        made.extend([out] if func.__name__ == "meet" else [])
        return out

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    monkeypatch.setattr(minhash, "BUCKET_SHINGLES", 500)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert all(got[i] == got[i - 1] for i in range(1, 300, 2)) and len(made) == 1
    assert made[0].count() < 300


def test_a_worker_lets_go_of_what_another_operator_kept(spark):
    """pipeline: workers that Spark reuses held the words of the tokens stage, and DuckDB's memory, beside the stages after it."""
    tokenizer = bpe.Tokenizer({bytes([b]): b for b in range(256)} | {b"ab": 256}, r"\S+|\s+")
    table = columns.kept("words", lambda: bpe.WordTable(tokenizer))
    table.learn({"abab"})
    assert table.ids["abab"] == "256 256" and "connection" in tokenizer.__dict__
    table.rest()
    assert "connection" not in tokenizer.__dict__
    assert columns.kept("words", dict) is table
    table.learn({"ba"})
    assert table.ids == {"abab": "256 256", "ba": "98 97"}
    list(minhash._sketch_rows(iter([])))
    assert columns.kept("words", dict) == {}
