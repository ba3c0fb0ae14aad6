"""Merkle manifest, periodic runs and quality classifier: against plain versions, with hard and odd tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgate.llm import merkle, queries, recompression, subword

from . import plain

SF = "/root/testdata/sf0.001"


def crc(key) -> int:
    return zlib.crc32(("" if key is None else str(key)).encode())


def docs_of(spark, name="documents"):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]


# ---- Merkle manifest ---------------------------------------------------------------------------------------------------


def shown(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_leaf(r, text) -> str:
    return plain.sha("".join(map(shown, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf what stands left and right of its ancestors."""
    above = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            first = at - at % 16
            above[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
            place[i] = at // 16
        nodes = [plain.sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], above


def plain_manifest(rows) -> collections.Counter:
    """Rows (doc_id, leaf, subroot, root, proof, folded, verified) with how often each comes."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
        trees.append(plain_tree([leaf for *_, leaf, _ in groups[s]]))
    if not trees:
        return collections.Counter()
    root, upper = plain_tree([t[0] for t in trees])
    out = collections.Counter()
    for s, (subroot, above), over in zip(order, trees, upper, strict=True):
        for (*_, leaf, r), steps in zip(groups[s], above, strict=True):
            text = r["text"]
            if crc(r["doc_id"]) % 5 == 0 and text is not None:
                text = text.translate(plain.LOWER)
            folded = plain_leaf(r, text)
            for left, right in steps + over:
                folded = plain.sha(left + folded + right)
            proof = plain.sha("".join(a + b for a, b in steps + over))
            out[r["doc_id"], leaf, subroot, root, proof, folded, folded == root] += 1
    return out


def found_manifest(df) -> collections.Counter:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return collections.Counter(tuple(r[n] for n in names) for r in df.withColumnRenamed("key", "doc_id").collect())


def test_manifest_of_registered_table(spark):
    assert found_manifest(queries.QUERIES["op13_merkle_manifest"](spark, SF)) == plain_manifest(docs_of(spark))


def test_manifest_of_several_tiers_and_many_groups(spark):
    """A group above one block with a ragged end, several hundred groups of one, a null one, and repeated rows."""
    d = spark.range(5300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4500, "hot").when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("é"), F.col("id") % 300)).alias("source"),
        F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("Text "), F.col("id") % 7).alias("text"))
    d = d.unionByName(d.where("doc_id % 500 = 3")).withColumn("tree", F.lit("?")).repartition(7)
    rows = [r.asDict() for r in d.collect()]
    assert found_manifest(merkle.verify(merkle.build(merkle.leaves(d)))) == plain_manifest(rows)


def test_manifest_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    manifest = merkle.build(merkle.leaves(odd_docs))
    assert found_manifest(merkle.verify(manifest)) == plain_manifest(rows)
    assert merkle.verify(merkle.build(merkle.leaves(no_docs))).collect() == []


def test_versions_copy_only_the_path(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    manifest = merkle.build(merkle.leaves(docs))
    proofs = {r.key: r for r in merkle.verify(manifest).collect()}
    copies = collections.defaultdict(list)
    for r in merkle.versions(manifest).orderBy("key", "height").collect():
        copies[r.key].append(r.digest)
    assert set(copies) == {k for k in proofs if crc(k) % 5 == 0}
    assert all(v[-1] == proofs[k].folded_root for k, v in copies.items())
    assert max(map(len, copies.values())) <= 5  # a digest a level, not a tree a version


# ---- periodic runs -----------------------------------------------------------------------------------------------------


def plain_runs(w: list) -> list[tuple[int, int, int]]:
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            start = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(doc_id, text, planted=True) -> tuple:
    w = plain.SPACED.findall(text or "")
    n, h = len(w), crc(doc_id)
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = None
    for s, k, q in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or k * best[2] > best[1] * q:
            best = (s, k, q)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *top, plain.sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), plain.sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def found_runs(rows) -> collections.Counter:
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return collections.Counter((r.doc_id, *(r[n] for n in names)) for r in rows)


def test_runs_of_registered_table(spark):
    want = collections.Counter((r["doc_id"], *plain_collapsed(r["doc_id"], r["text"])) for r in docs_of(spark))
    got = found_runs(queries.QUERIES["op11_periodic_runs"](spark, SF).collect())
    assert got == want and sum(r[1] for r in got) > 20


def test_runs_of_hard_texts():
    rng = np.random.default_rng(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            letters, n, w = int(rng.choice([1, 2, 3, 40])), int(rng.choice([0, 1, 5, 6, 8, 40, 250])), []
            while len(w) < n:
                w += rng.integers(0, letters, rng.integers(1, 9)).tolist() * int(rng.choice([1, 1, 2, 4, 5, 9]))
            texts.append(w[:n])
        got = recompression.runs_of([np.array(t, np.int64) for t in texts])
        assert [sorted(map(tuple, got[i].tolist())) if i in got else [] for i in range(len(texts))] == [plain_runs(t) for t in texts]


def test_runs_of_fibonacci_words_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    for t in (b[:3000], [0] * 5000, ([0] * 7 + [1]) * 300, list(range(50)) * 4, list(range(50)) * 4 + [0]):
        got = recompression.runs_of([np.array(t, np.int64)])
        assert (sorted(map(tuple, got[0].tolist())) if got else []) == plain_runs(t)


def test_extension_answers_like_a_scan():
    rng = np.random.default_rng(2)
    w = np.concatenate([[-1], np.tile(rng.integers(0, 3, 17), 30), rng.integers(0, 3, 200), [-2], np.zeros(90, int), [-3]]).astype(np.int64)
    x, y = np.array([(i, j) for i, j in rng.integers(1, len(w) - 1, (800, 2)) if i != j]).T
    grammar = recompression.Grammar(w)
    assert len(grammar.symbols) > 5
    for step in (1, -1):
        for i, j, n in zip(x.tolist(), y.tolist(), grammar.extend(x, y, step).tolist(), strict=True):
            k = 0
            while w[i + step * k] == w[j + step * k] and w[i + step * k] >= 0:
                k += 1
            assert n == k


def test_runs_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = recompression.collapse_runs(odd_docs, ["doc_id"], digests=True).collect()
    assert found_runs(rows) == collections.Counter((r.doc_id, *plain_collapsed(r.doc_id, r.text, False)) for r in odd_docs.collect())
    assert recompression.collapse_runs(no_docs, no_docs.columns[:2]).collect() == []
    full = {r.doc_id: r for r in recompression.collapse_runs(odd_docs.where("doc_id = 14"), odd_docs.columns).collect()}[14]
    assert full.collapsed == "a" and [tuple(x) for x in full.runs] == [(0, 12, 1)]


def test_runs_of_a_long_text_in_little_time(spark):
    text = "one two three " * 60_000 + "end " + "x " * 40_000
    r = recompression.collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert [tuple(x) for x in r.runs] == [(0, 180_000, 3), (180_001, 40_000, 1)] and r.collapsed == "one two three end x"


# ---- quality classifier --------------------------------------------------------------------------------------------------


def labelled(spark, sf):
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return [(r.doc_id, r.text, good[r.doc_id]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if good.get(r.doc_id) is not None]


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op12_quality_classifier"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc(d) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in rows.items())
    right = collections.defaultdict(list)
    for d, _, q in labelled(spark, sf):
        if rows[d].held_out:
            right[q].append(rows[d].predicted == q)
    assert min(len(v) for v in right.values()) > 5 and all(np.mean(v) > 0.9 for v in right.values())


def plain_score(model, text) -> float:
    """The same model, feature by feature."""
    words, total = [], np.zeros(2)
    for i, w in enumerate(re.findall(r"[^\x20\x09-\x0D]+", text or "")):
        words.append((w, i > 0 and words[i - 1][0] == w))
    for w, again in words:
        w = " again" if again else w
        mine = [zlib.crc32(w.encode()) % subword.BUCKETS]
        points = [0x110000, *map(ord, w), 0x110001]
        for n in subword.GRAMS:
            for i in range(len(points) - n + 1):
                h = n
                for c in points[i : i + n]:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 % (1 << 64)
                    h ^= h >> 29
                h = h - (1 << 64) if h >= 1 << 63 else h
                mine.append(h % subword.BUCKETS)
        total += np.mean([model.logits[m].astype(float) for m in mine], axis=0)
    z = total / max(len(words), 1) + model.bias
    return 1 / (1 + np.exp(z[0] - z[1]))


def test_scores_feature_by_feature(spark, odd_docs):
    rows = labelled(spark, SF)
    model = subword.fit([(t, q) for d, t, q in rows if crc(d) % 5][:60], epochs=2)
    texts = [t for _, t, _ in rows[:12]] + [r.text for r in odd_docs.where("doc_id is null or doc_id <> 7").collect()]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], atol=1e-5)
    forgetful = subword.Scorer(model, most=5)
    assert np.allclose(np.concatenate([forgetful.scores([t]) for t in texts]), model.scores(texts))


def test_quality_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, "x"), (14, 0, "x"), (None, 1, "x"), (8, None, "x"), (4, 1, "y"), (1, 0, "x")], "doc_id long, quality int, text string")
    model = subword.train(odd_docs, labels)
    rows = subword.predict(odd_docs, model, odd_docs.columns).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r[-2] <= 1 for r in rows)
    assert subword.train(no_docs, labels) is None and subword.train(odd_docs, labels.limit(0)) is None
    assert {r.score for r in subword.predict(odd_docs.select("doc_id", "text"), None, ["doc_id"]).collect()} == {0.5}
    assert subword.predict(no_docs, model, ["doc_id"]).collect() == []


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_quality_classifier", "op13_merkle_manifest"])
def test_registered_columns(spark, name):
    wanted = {
        "op11_periodic_runs": ["doc_id bigint", "n_runs bigint", "start bigint", "length bigint", "period bigint", "exponent_milli bigint", "runs_sha256 string", "collapsed_sha256 string"],
        "op12_quality_classifier": ["doc_id bigint", "held_out boolean", "score double", "predicted int"],
        "op13_merkle_manifest": ["doc_id bigint", "leaf string", "subroot string", "root string", "proof_sha256 string", "folded_root string", "verified boolean"],
    }
    assert [f"{n} {t}" for n, t in queries.QUERIES[name](spark, SF).dtypes] == wanted[name]


def test_digest_of_a_node_is_of_its_hex_text():
    assert merkle.digest_of("ab") == hashlib.sha256(b"ab").hexdigest()
