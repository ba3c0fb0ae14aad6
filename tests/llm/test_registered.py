"""The eleven registered queries on the smallest tables: against their SQL, or against a plain version."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks import harness
from corpusgate.llm import langid, pii, queries, url_filter

from . import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows_of(spark, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    ok, rows, note = harness.compare(spark, harness.connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok and rows, note


def test_suffix_array(spark, texts):
    rows = rows_of(spark, "op1_suffix_array_dedup")
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in rows.items()} == plain.repeats(texts)


def test_minhash(spark, texts):
    rows = rows_of(spark, "op2_minhash_near_duplicates")
    assert {d: (r.n_shingles, r.component_id) for d, r in rows.items()} == plain.near_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in rows_of(spark, "op5_language_id").values() if r.held_out]
    assert len(rows) > 30 and np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_bpe(spark, texts):
    _, encoding = plain.tokenizer()
    rows = rows_of(spark, "op7_byte_bpe")
    for d, t in texts:
        ids = encoding.encode_ordinary(t or "")
        assert (rows[d].n_tokens, rows[d].ids_sha256, rows[d].decoded_sha256) == (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(t or ""))


def test_personal_data(spark, texts):
    rows = rows_of(spark, "op8_personal_data")
    for d, t in texts:
        base = plain.base_spans(t or "")
        r = rows[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for *_, k in base) for kind in pii.KINDS)
        assert r.base_sha256 == plain.sha(pii.spelled(base))
        assert {pii.spelled([s]) for s in base} <= set(r.spans.split(","))


def test_url_filter(spark):
    model = url_filter.train(url_filter.labelled_urls())
    for r in queries.QUERIES["op9_url_filter"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url"), "page_id").collect():
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url).groups()
        host = host.translate(plain.LOWER)
        fits = [x for x in queries.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.name), default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict == (rule.verdict if rule else "block" if model.scores([host], [path])[0] >= 0.5 else "allow")


def test_quality(spark, texts):
    rows = rows_of(spark, "op10_quality_rules")
    for d, t in texts:
        r, m = rows[d], plain.measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0]) and not (r.base_failed and r.kept)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    sound = [r for d, r in rows.items() if d in good and not r.base_failed]
    assert sum(r.kept for r in sound) >= 0.97 * len(sound)


def test_native_queries_run_no_python(spark):
    for name in ("op3_decontamination", "op10_quality_rules"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_pipeline(spark, texts):
    """Each stage again by plain means: the model text by text, pairs, windows, spans and the reference encoder."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    kept = [(d, t) for d, t in texts if t and re.search(r"[^\W\d_]", t)]
    assert model is not None
    group = plain.near_components(kept)
    kept = [(d, t) for d, t in kept if group[d][1] == d]
    windows = plain.item_windows([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    kept = [(d, t) for d, t in kept if not plain.leaks(t, windows)[1]]
    spans = pii.trained_model()
    _, encoding = plain.tokenizer()
    want = {}
    for d, t in kept:
        clean = pii.redacted(t, pii.find_spans(t, spans)[1])
        ids = encoding.encode_ordinary(clean)
        want[d] = (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(clean))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_return_the_columns_of_documents(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, SF).columns == odd_docs.columns, name
    assert odd_docs.select(F.count("*")).first()[0]
