"""Cases that the findings of round 3 name."""

from __future__ import annotations

import random

from corpusgate.operators import spans


def test_union_of_ranges_without_a_window_over_single_ranges(spark):
    """a task held every range of its texts several times, in sorts, windows and a second grouping."""
    rng, rows = random.Random(21), []
    for d in range(40):
        rows += [(d if d else None, s, s + rng.choice([0, 1, 3, 9])) for s in rng.choices(range(60), k=rng.randrange(1, 30))]
    merged = spans.merge_ranges(spark.createDataFrame(rows, "doc_id long, start long, end int").repartition(5))
    want = set()
    for d in {r[0] for r in rows}:
        low = high = None
        for s, e in sorted(r[1:] for r in rows if r[0] == d):
            if high is not None and s <= high:
                high = max(high, e)
                continue
            if high is not None:
                want.add((d, low, high))
            low, high = s, e
        want.add((d, low, high))
    got = [tuple(r) for r in merged.collect()]
    assert len(got) == len(want) and set(got) == want
    assert merged.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("end", "int")]
    assert "Window" not in merged._jdf.queryExecution().optimizedPlan().toString()
