"""Models again by plain means: the byte network window by window, and expectation-maximisation row by row."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from corpusgate.llm import langid, quality, queries

SF = "/root/testdata/sf0.001"


def plain_language(model, text):
    """Label and probability by loops over windows, positions and filters."""
    if text is None or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    data = text.encode()
    total, weight = np.zeros(len(model.labels)), 0
    for at in range(0, max(len(data), 1), langid.WINDOW):
        piece = data[at : at + langid.WINDOW]
        rows = [model.embed[b].astype(float) for b in piece.ljust(langid.WINDOW, b"\0")]
        hidden = []
        for f in range(model.filters.shape[1]):
            taps = model.filters[:, f].astype(float).reshape(langid.REACH, langid.EMBED)
            best = max(sum(float(taps[j] @ rows[i + j]) for j in range(langid.REACH)) for i in range(langid.WINDOW - langid.REACH + 1))
            hidden.append(max(0.0, best + float(model.bias[f])))
        z = [sum(h * float(w) for h, w in zip(hidden, model.out[:, k], strict=True)) + float(model.out_bias[k]) for k in range(len(model.labels))]
        p = [math.exp(x - max(z)) for x in z]
        total += len(piece) * np.array(p) / sum(p)
        weight += len(piece)
    total /= weight
    return model.labels[int(total.argmax())], float(total.max())


def test_language_window_by_window(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    texts = [t[:700] for (t,) in docs.where("length(text) > 300").orderBy("doc_id").limit(3).select("text").collect()]
    texts += ["", None, "12 + 3", "é", "das ist", "x" * 256, "la casa de la " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.predict(df, model, ["doc_id"]).collect():
        label, score = plain_language(model, texts[r.doc_id])
        assert r.lang_pred == label and math.isclose(r.score, score, abs_tol=1e-4)


def votes_of(row) -> dict:
    """The rules read anew, as Python over the measures of a row."""
    def holds(text):
        text = re.sub(r"(\w+) BETWEEN ([^A]+?) AND ([^A]+)", r"\2 <= \1 <= \3", text)
        return eval(text.replace("AND", "and").replace("OR", "or"), {}, row)  # noqa: S307

    return {r.name: -1 if holds(r.bad) else 1 if holds(r.good) else 0 for r in quality.RULES}


def test_votes_are_weighed_as_row_by_row(spark):
    rows = [r.asDict() for r in quality.judge(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"]).collect()]
    votes = [votes_of(r) for r in rows]
    good, given = 0.85, {r.name: (0.03, 0.4) for r in quality.RULES}

    def posterior(v):
        odds = math.log(good / (1 - good))
        for name, (alarm, found) in given.items():
            odds += {-1: math.log(alarm / found), 0: 0.0, 1: math.log((1 - alarm) / (1 - found))}[v[name]]
        return 1 / (1 + math.exp(-odds))

    for _ in range(20):
        q = [posterior(v) for v in votes]
        new = {}
        for name in given:
            bad = [i for i, v in enumerate(votes) if v[name] == -1]
            fine = [i for i, v in enumerate(votes) if v[name] == 1]
            q_bad, q_fine = sum(q[i] for i in bad), sum(q[i] for i in fine)
            alarm = min(0.4, (q_bad + 1) / (q_fine + q_bad + 2))
            found = max(2 * alarm, (len(bad) - q_bad + 1) / (len(bad) - q_bad + len(fine) - q_fine + 2))
            new[name] = (alarm, found)
        share = min(0.99, max(0.01, (sum(q) + 1) / (len(q) + 2)))
        moved = abs(share - good) + sum(2 * abs(new[n][c] - given[n][c]) for n in given for c in (0, 1))
        good, given = share, new
        if moved < 1e-5:
            break
    for r, v in zip(rows, votes, strict=True):
        p = posterior(v)
        assert math.isclose(r["p_good"], p, abs_tol=1e-6)
        assert r["kept"] == (not r["base_failed"] and p >= 0.5)
    registered = {r.doc_id: (r.kept, r.p_good) for r in queries.QUERIES["op10_quality_rules"](spark, SF).select("doc_id", "kept", F.round("p_good", 6).alias("p_good")).collect()}
    assert registered == {r["doc_id"]: (r["kept"], round(r["p_good"], 6)) for r in rows}
