"""Cases that the findings of round 4 name."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import harness
from corpusgate import session
from corpusgate.operators import identity, inventory, matches, projection, spans, tokens
from corpusgate.plans.projection import Projection, project_corpus, projection_gates, projection_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Some texts and pages, and empty and null ones under every remainder that the variants go by."""
    path = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    con.execute(f"CREATE TABLE d AS SELECT * FROM '{SF}/documents.parquet' WHERE doc_id < 36")
    con.execute("UPDATE d SET text = CASE WHEN doc_id < 12 THEN '' END WHERE doc_id < 24")
    con.execute(f"CREATE TABLE p AS SELECT * FROM '{SF}/pages.parquet' WHERE page_id < 20")
    con.execute("UPDATE p SET html = CASE WHEN page_id < 5 THEN '' END WHERE page_id < 10")
    for name in harness.TABLES:
        source = {"documents": "d", "pages": "p"}.get(name, f"'{SF}/{name}.parquet'")
        con.execute(f"COPY (SELECT * FROM {source}) TO '{path}/{name}.parquet'")
    return str(path)


def _same(spark, odd, name):
    ok, _, note = harness.compare(spark, harness.connect(odd), entry.queries()[name], entry.oracle_sql()[name], odd)
    assert ok, note


@pytest.mark.parametrize("name", ["g9_identity_literals", "r7_substitute_by_table", "r9_locator_edits", "r13_replay", "r1_project_documents", "r3_derivations_agree"])
def test_empty_and_null_texts_have_the_rows_of_the_sql(spark, odd, name):
    """the SQL gathers texts from their runs and has no row for one without; its concat passes over nulls."""
    _same(spark, odd, name)


def test_texts_are_cut_in_their_row_as_by_separate_operators(spark):
    """F3, F8 to F11: spans were found by four passes over exploded texts, shuffled and merged; now one cut in the row finds them."""
    rng = random.Random(4)
    parts = ["A", "I", "V", "M", "A. Novak", "I. van Bergh", "12pt", "3true em", "5ex", "7MM", "9mm5", "IX", "dom", "ljubi", "qa", "сло", ".", ",", ") ", " ", " ", "\n", "tom ", "²", "x", "-"]
    texts = ["", None, "A", "q", "A. Novak", "pt", "I. ", "A" * 130 + " I " + "-" * 130] + ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rules, letters = inventory.label_rules(["tom"]), ("A", "I", "V", "M")
    names = matches.name_spans(docs, ["doc_id"], *matches.NAME_SUBTYPES[0])
    lone = inventory.one_letter_inventory(docs, names, rules, letters=letters).where("disposition LIKE 'PRESERVE%'")
    blocked = tokens.locate_blocked_words(docs).select("doc_id", F.col("off").alias("start"), (F.col("off") + F.length("word")).alias("end"))
    rows = names.select("doc_id", "start", "end").unionByName(lone.select("doc_id", F.col("off").alias("start"), "end"))
    rows = rows.unionByName(matches.unit_spans(docs, ["doc_id"]).select("doc_id", "start", "end")).unionByName(blocked)
    want = spans.merge_ranges(rows)
    cut = projection.cut_texts(docs, rules, letters=letters)
    got = cut.select("doc_id", F.inline_outer("_spans")).where("start IS NOT NULL")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one, two = ({r.doc_id: r.text or "" for r in d.collect()} for d in (projection.project_documents(cut), projection.project_documents(docs, want)))
    assert one == two


@pytest.mark.parametrize("name", ["r2_projection_trace", "r3_derivations_agree", "r4_inverse_replay", "r5_latin_residuals"])
def test_projection_proofs_stay_in_their_row(spark, name):
    """F8 to F11: neither texts nor spans nor traces are shuffled, and a text is cut once."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan parquet") == 1


def test_gates_read_one_stored_table_and_refuse_a_spoilt_one(spark):
    """output and trace were derived once for each gate; a table whose output or trace is not what was made must fail."""
    docs = spark.createDataFrame([(1, "Dom IV moj 12pt"), (2, "dom")], "doc_id long, text string")
    done = projection_of(projection.cut_texts(docs, inventory.label_rules([])))
    assert all(r["pass"] for r in projection_gates(docs, done).collect())
    spoilt = done.table.withColumn("text", F.replace(F.replace("text", F.lit("мој"), F.lit("moj")), F.lit("pt"), F.lit("пт")))
    bad = {r.code: r.failures for r in projection_gates(docs, Projection(spoilt)).collect()}
    assert bad == {"two_derivations_agree": 1, "inverse_replay": 1, "no_unprotected_latin": 1, "units_survive": 1}


def test_corpus_with_given_spans_goes_the_same_way(spark):
    docs = spark.createDataFrame([(1, "Dom IV moj 12pt"), (2, "dom")], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, start long, end long, disposition string")
    held = spark.createDataFrame([(1, 4, 6)], "doc_id long, start long, end long")
    done = project_corpus(docs, empty, held)
    assert {r.doc_id: r.text for r in done.output.collect()} == {1: "Дом IV мој 12pt", 2: "дом"}
    assert sorted((r.doc_id, r.in_start, r.in_end, r.protected) for r in done.trace.collect()) == [
        (1, 0, 4, False), (1, 4, 6, True), (1, 6, 13, False), (1, 13, 15, True), (2, 0, 3, False)]
    assert all(r["pass"] for r in projection_gates(docs, done).collect())


def test_stale_locators_compare_in_the_row_of_the_text(spark):
    """located rows with five hashes each were shuffled twice more to meet themselves, and repeated rows met each other."""
    old = spark.createDataFrame([(1, "Dom qa\nwin dom"), (2, "qa"), (3, "wx")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "Dom qa\nwan dom"), (2, "qa")], "doc_id long, text string")
    rows = spark.createDataFrame([(1, 4, 6), (1, 7, 10), (1, 7, 10), (1, 90, 95), (2, 0, 2), (3, 0, 2)], "doc_id long, start long, end long")
    manifest = identity.locate_manifest(rows, old)
    every = ",".join(identity.LOCATOR_FIELDS)
    got = sorted(tuple(r) for r in identity.stale_locators(manifest, new).collect() if r.start < 90)
    assert got == [
        (1, 4, 6, "qa", "context_sha256"), (1, 7, 10, "win", "surface,surface_sha256,line_sha256,context_sha256"),
        (1, 7, 10, "win", "surface,surface_sha256,line_sha256,context_sha256"), (2, 0, 2, "qa", ""), (3, 0, 2, "wx", every)]
    plan = identity.stale_in_text(identity.manifests(rows, old), new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") <= 4


@pytest.mark.parametrize("name", ["p1_gates", "p1_gate_failures", "p1_project_marked", "p1_piece_census", "r_projection_gates"])
def test_tables_of_whole_texts_are_read_few_rows_at_a_time(spark, monkeypatch, name):
    """a reader's batch held 4,096 texts with all their pieces on the heap, for each running task."""
    seen, stored, before = [], session.stored, spark.conf.get(session.READ)
    monkeypatch.setattr(session, "stored", lambda d: seen.append((list(d.columns), spark.conf.get(session.READ))) or stored(d))
    df = entry.queries()[name](spark, SF)
    assert seen[-1][0] == df.columns and {r for _, r in seen} == {str(session.TEXTS)}
    assert spark.conf.get(session.READ) == before
