"""Word rules, offsets, spans, gates and sinks on small inputs."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusgate.functions import tables as t
from corpusgate.functions import text as fx
from corpusgate.functions.prefix import context_of, explode_runs
from corpusgate.operators import digests, edits, gates, identity, inventory, ledger, lines, matches, projection, spans, tokens, totals
from corpusgate.session import scratch_dir
from corpusgate.sources import sinks, transport


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, w string")
    return [r.x for r in df.orderBy("i").select(expr(F.col("w")).alias("x")).collect()]


def test_golden_words(spark):
    words = {"njivu": "њиву", "džem": "джем", "Ljubav": "Љубав", "LJubav": "Љубав", "lJ": "љ", "DŽEM": "ДЖЕМ", "Džem": "Джем", "dŽ": "дж",
             "Đak": "ДЖак", "đ": "дж", "ľj": "љ", "člověk": "чловєк", "ſ": "с", "njj": "њј", "dđ": "ддж"}
    assert column(spark, words, fx.project_word) == list(words.values())


def test_roman_grammar(spark):
    yes, no = ["IV", "XII", "MIX", "DC", "VI", "MMMDCCCLXXXVIII", "DCCC"], ["I", "IC", "CIVIL", "iv", "IIII", "Q"]
    assert all(column(spark, yes, fx.is_roman)) and not any(column(spark, no, fx.is_roman))


def test_block_reasons(spark):
    got = column(spark, ["dom", "q", "IX", "VI", "дом", "domд", "\u212a", "Straße"], fx.block_reasons)
    assert got == [[], [t.REASON_UNMAPPED], [t.REASON_ROMAN, t.REASON_UNMAPPED], [t.REASON_ROMAN], [t.REASON_SCRIPT], [t.REASON_SCRIPT],
                   [t.REASON_UNMAPPED], [t.REASON_UNMAPPED]]


def test_units(spark):
    text = "12pt 3true em 4 pt 7EM, 12emě 9em5 em 5filll 6 fil1pt x2cm"
    want = [m.group(0) for m in re.finditer(r"(?i)(?<=[0-9])(?:true[ \t]*)?(?:filll|fill|fil|pt|pc|in|bp|cm|mm|dd|cc|sp|em|ex|mu)\b", text)]
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    assert docs.select(fx.dimension_units(F.col("text")).alias("u")).first().u == want
    rows = matches.unit_spans(docs, ["doc_id"]).orderBy("start").collect()
    assert [r.surface for r in rows] == want and all(text[r.start:r.end] == r.surface for r in rows)


def brute_runs(text):
    return [(m.start(), m.group(0)) for m in re.finditer(r"[^\W\d_]+|(?:[\d_]|\W)+", text)]


def test_runs_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["", "a", " ", "𝔭a½²x_1", "a b " * 3000] + [
        "".join(rng.choice("ab č\n.1_ďß漢𝔭½") for _ in range(rng.randrange(1, 9000))) for _ in range(12)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = tokens.tokenise(docs, context=(7, 33)).withColumns({"b": context_of(F.col("off"), 7, 0), "c": context_of(F.col("off"), 5, 33)}).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.pos)):
        got.setdefault(r.doc_id, []).append((r.off, r.run))
        text = texts[r.doc_id]
        assert r.b == text[max(0, r.off - 7):r.off] and r.c == text[max(0, r.off - 5):r.off + 33]
        assert r.is_word == bool(re.match(r"[^\W\d_]", r.run))
    assert got == {i: brute_runs(x) for i, x in enumerate(texts) if x}


def test_lines_against_brute_force(spark):
    rng = random.Random(6)
    texts = ["", "\n", "a\r\nb", "a\n\nb\x0bc\x0cd\x1ce\x85f\u2028g\u2029"] + ["".join(rng.choice("abč \n\r\x0c\u2028") for _ in range(3000)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in sorted(lines.line_table(docs).collect(), key=lambda r: (r.doc_id, r.line_no)):
        got.setdefault(r.doc_id, []).append((r.line, r.line_off, r.line_byte_off))
    for i, x in enumerate(texts):
        want, at, byte = [], 0, 0
        for line, phys in zip(x.splitlines(), x.splitlines(keepends=True)):
            want.append((line, at, byte))
            at, byte = at + len(phys), byte + len(phys.encode())
        assert got.get(i, []) == want


def test_lone_letters_against_brute_force(spark):
    rng = random.Random(7)
    texts = ["I", "xI", "Ix", "I V", "II", "V.M", ""] + ["".join(rng.choice("IVMx .é") for _ in range(800)) for _ in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.off) for r in matches.lone_letters(docs, ["doc_id"], ["I", "V", "M"], (3, 4)).collect())
    assert got == [(i, m.start()) for i, x in enumerate(texts) for m in re.finditer(r"(?<![^\W\d_])[IVM](?![^\W\d_])", x)]


def brute_merge(ranges):
    out = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


@pytest.fixture(scope="module")
def ranges():
    rng = random.Random(8)
    rows = []
    for d in range(6):
        for _ in range(40 * d):
            s = rng.randrange(0, 20000)
            rows.append((d, s, s + rng.randrange(1, 300)))
    return rows + [(9, 0, 5), (9, 5, 9), (9, 10, 11)]


def test_merge_and_cover_against_brute_force(spark, ranges):
    df = spark.createDataFrame(ranges, "doc_id long, start long, end long")
    merged = spans.merge_ranges(df)
    got, want = {}, {}
    for r in merged.orderBy("start").collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end))
    for d, s, e in ranges:
        want.setdefault(d, []).append((s, e))
    assert got == {d: brute_merge(v) for d, v in want.items()}
    items = [(d, o, o + 4) for d in range(7) for o in range(0, 20000, 37)]
    flagged = spans.flag_covered(spark.createDataFrame(items, "doc_id long, start long, end long"), merged)
    assert flagged.count() == len(items)
    for r in flagged.collect():
        assert r.covered == any(a <= r.start and r.end <= b for a, b in got.get(r.doc_id, []))


def test_overlaps_against_brute_force(spark, ranges):
    left = [(d, s, s + 9000) for d in range(6) for s in range(0, 18000, 4500)]
    a = spark.createDataFrame(left, "doc_id long, start long, end long")
    b = spark.createDataFrame(ranges, "doc_id long, start long, end long")
    got = sorted(tuple(r) for r in spans.overlaps(a, b, ["doc_id"]).select("doc_id", "start", "end", "r_start", "r_end").collect())
    assert got == sorted((d, s, e, x, y) for d, s, e in left for dd, x, y in ranges if d == dd and x < e and y > s)


def test_one_hot_key_and_partitioning_do_not_matter(spark):
    """One source holds nearly all rows; results are the same for any number of partitions."""
    rows = [(i, "hot" if i % 50 else f"s{i}", f"Dom qa IV {i % 7} the") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    first = sorted(map(tuple, tokens.blocked_word_census(docs, ["source"]).collect()))
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert sorted(map(tuple, tokens.blocked_word_census(docs.repartition(n), ["source"]).collect())) == first
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    hot = next(r for r in first if r[0] == "hot")
    assert hot[1] == sum(1 for r in rows if r[1] == "hot") * 4 and hot[4:] == (hot[1] // 4, hot[1] // 4, hot[1] // 2)


def test_global_running_total(spark):
    ids = sorted(random.Random(9).sample(range(10**6), 500)) + [2**33 + 5, 2**40]
    df = spark.createDataFrame([(i, i % 11) for i in ids], "id long, v long")
    got = {r.id: r.before for r in totals.global_running_total(df, "id", "v", "before").collect()}
    run = list(itertools.accumulate((i % 11 for i in ids), initial=0))
    assert got == dict(zip(ids, run))


def test_corpus_digest_notices_any_change(spark):
    df = spark.createDataFrame([(i * 999, f"{i:064d}") for i in range(300)], "doc_id long, digest string")
    root = digests.corpus_digest(df, "doc_id").first()
    assert root.members == 300 and digests.corpus_digest(df.repartition(5), "doc_id").first() == root
    assert digests.corpus_digest(df.where("doc_id <> 0"), "doc_id").first().digest != root.digest


# ---- hostile mutations: each must be refused -------------------------------------------------------------------

ISSUES = [(1, 5, "IV", "roman"), (1, 9, "X", "unmapped"), (2, 0, "VI", "roman")]


@pytest.mark.parametrize("mutate,status", [
    (lambda a: a[1:], "UNAPPROVED"), (lambda a: a + a[:1], "DUPLICATE"), (lambda a: [(1, 5, "IV", "other")] + a[1:], "FIELD_DRIFT"),
    (lambda a: a + [(3, 1, "II", "roman")], "STALE"), (lambda a: a, "MATCH"),
])
def test_approvals(spark, mutate, status):
    schema = "doc_id long, off long, word string, reasons string"
    issues, approvals = spark.createDataFrame(ISSUES, schema), spark.createDataFrame(mutate(list(ISSUES)), schema)
    got = {r.status for r in identity.match_approvals(issues, approvals, ["doc_id", "off", "word"], ["reasons"]).collect()}
    assert status in got and (status == "MATCH") == (got == {"MATCH"})


def test_multiset_gate(spark):
    s = "word string, n long"
    permitted = spark.createDataFrame([("IV", 3), ("X", 1)], s)
    seen = lambda rows: {(r.word, r.violation) for r in gates.multiset_violations(spark.createDataFrame(rows, s), permitted, ["word"]).collect()}
    assert seen([("IV", 3)]) == set()
    assert seen([("IV", 4), ("Q", 1)]) == {("IV", "EXCESS"), ("Q", "UNREVIEWED")}


@pytest.mark.parametrize("text,code", [
    ("{}\n", "ok"), ('{"a":1,"a":2}\n', "invalid_json"), ("{}\r\n", "non_canonical_transport"), ("\ufeff{}\n", "non_canonical_transport"),
    ("{}", "terminal_lf"), ("{}\n\n", "terminal_lf"), ("{\n", "invalid_json"),
])
def test_strict_json(spark, text, code):
    assert spark.createDataFrame([(text,)], "j string").select(transport.strict_json_code(F.col("j"))).first()[0] == code


@pytest.mark.parametrize("raw,code", [
    (b"a\n", "ok"), (b"\xef\xbb\xbfa\n", "utf8_bom"), (b"a\r\n", "non_lf_newline"), (b"a", "missing_terminal_lf"),
    (b"\xff\n", "invalid_utf8"), ("e\u0301\n".encode(), "non_nfc"), ("\u00e9漢\n".encode(), "ok"),
])
def test_transport(spark, raw, code):
    df = spark.createDataFrame([(bytearray(raw),)], "content binary")
    assert df.select(transport.transport_code(F.col("content"))).first()[0] == code


def test_receipt_refuses_tampering(spark):
    body = '{"a":1,"h":{"id":"x"}}\n'
    import hashlib

    good = hashlib.sha256(body.encode()).hexdigest().upper()
    rows = [(0, f'{{"h":{{"sha":"{good}","id":"x"}},"a":1}}'), (1, f'{{"h":{{"sha":"{good}","id":"y"}},"a":1}}'),
            (2, f'{{"h":{{"sha":"{good}","id":"x"}},"a":1,"b":2}}'), (3, '{"h":{"id":"x"},"a":1}')]
    df = spark.createDataFrame(rows, "i int, j string").withColumn("v", F.parse_json("j"))
    shape = {"a": None, "h": {"id": None, "sha": None}}
    got = {r.i: r["pass"] for r in ledger.receipt_check(df, "v", shape, "$.h.sha").collect()}
    assert got == {0: True, 1: False, 2: False, 3: False}


def test_append_only(spark):
    s = "n long, d string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (4, "c")], s)
    check = lambda rows: sorted(tuple(r) for r in ledger.append_only_violations(old, spark.createDataFrame(rows, s), "n", "d").collect())
    assert check([(1, "a"), (2, "b"), (4, "c"), (5, "x")]) == []
    assert check([(1, "z"), (3, "q"), (4, "c")]) == [(1, "CHANGED"), (2, "REMOVED"), (3, "INSERTED")]


def test_locator_edits_are_refused_on_drift(spark):
    docs = spark.createDataFrame([(1, "dom moj\nža dom\n")], "doc_id long, text string")
    rows = [(1, 1, 1, "dom", "kuća"), (1, 2, 4, "dam", "x"), (1, 9, 1, "dom", "x"), (1, 1, 2, "om", "y"), (1, 2, 1, "ža", "a"), (1, 2, 1, "ža", "b")]
    resolved = edits.resolve_locators(docs, spark.createDataFrame(rows, "doc_id long, line_no long, col_no long, old string, new string"))
    assert sorted((r.line_no, r.col_no, r.state) for r in resolved.collect()) == [
        (1, 1, "APPLIES"), (1, 2, "OVERLAP"), (2, 1, "DUPLICATE"), (2, 4, "DRIFT"), (9, 1, "NO_LINE")]
    assert edits.apply_locator_edits(docs, resolved).first().text == "kuća moj\nža dom\n"


def test_tampered_output_does_not_replay(spark):
    docs = spark.createDataFrame([(1, "Dom IV moj"), (2, "dom")], "doc_id long, text string")
    held = spark.createDataFrame([(1, 4, 6)], "doc_id long, start long, end long")
    out = projection.project_documents(docs, held)
    trace = projection.projection_trace(docs, held)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Дом IV мој", 2: "дом"}
    assert {r.doc_id: r.text for r in projection.replay_inverse(trace, out).collect()} == {1: "Dom IV moj", 2: "dom"}
    bad = out.withColumn("text", F.replace("text", F.lit("IV"), F.lit("VI")))
    assert {r.doc_id: r.text for r in projection.replay_inverse(trace, bad).collect()} == {1: None, 2: "dom"}


def test_wrapping_one_blocker_removes_exactly_one(spark):
    docs = spark.createDataFrame([(1, "dom qa IV xa")], "doc_id long, text string")
    n = lambda d: tokens.words(d, []).where(~fx.is_projectable(F.col("word"))).count()
    one = spark.createDataFrame([(1, 4, 6)], "doc_id long, start long, end long")
    wrapped = projection.wrap_spans(docs, one, "⟦", "⟧").withColumn("text", F.regexp_replace("text", "⟦[^⟧]*⟧", ""))
    assert n(docs) - n(wrapped) == 1


def test_unprotected_residue_is_reported(spark):
    docs = spark.createDataFrame([(1, "Dom qa 12pt IV")], "doc_id long, text string")
    held = spark.createDataFrame([(1, 12, 14)], "doc_id long, start long, end long")
    out = projection.project_documents(docs, held)
    trace = projection.projection_trace(docs, held).where("protected")
    got = {(r.word, r.covered) for r in projection.latin_residuals(out, trace).collect()}
    assert got == {("qa", False), ("IV", True)}
    drift = gates.census_gate(projection.unit_census(out), projection.unit_census(docs), ["doc_id", "unit"]).collect()
    assert [(r.unit, r["pass"]) for r in drift] == [("pt", False)]
    assert out.select(fx.has_projected_units(F.col("text"))).first()[0]


def test_sinks_refuse_to_overwrite(spark):
    d = spark.range(10).withColumn("v", F.lit("a"))
    path = scratch_dir(spark)
    assert sinks.write_once(d, path) == "WRITTEN" and sinks.write_once(d, path) == "IDENTICAL"
    with pytest.raises(sinks.OverwriteRefused):
        sinks.write_once(d.where("id > 0"), path)
    for other in (d.withColumn("id", F.col("id").cast("int")), d.withColumn("v", F.lit("b"))):
        with pytest.raises(sinks.OverwriteRefused):
            sinks.write_once(other, path)
    moment, at = scratch_dir(spark), spark.sql("SELECT timestamp_micros(1) AS at")
    assert sinks.write_once(at, moment) == "WRITTEN"
    with pytest.raises(sinks.OverwriteRefused):
        sinks.write_once(spark.sql("SELECT timestamp_micros(2) AS at"), moment)
    assert spark.read.parquet(moment).collect() == at.collect()
    gate = spark.createDataFrame([("a", True), ("b", False)], "code string, pass boolean")
    assert sinks.publish_if_passed(d, gate, scratch_dir(spark)) == "BLOCKED"
    assert sinks.publish_if_passed(d, gate.where("pass"), scratch_dir(spark)) == "WRITTEN"


def test_json_walk_has_no_deepest_level(spark):
    deep = '{"a":' * 12 + '{"rejected": "{[{"}' + "}" * 12
    df = spark.createDataFrame([(1, deep), (2, '{"x":[{"reject":{"rejected":1}}]}')], "i int, j string").withColumn("v", F.parse_json("j"))
    got = {(r.i, r.path) for r in ledger.alternative_fields(df, ["i"], "v").collect()}
    assert got == {(1, "$" + ".a" * 12 + ".rejected"), (2, "$.x[0].reject")}


@pytest.mark.parametrize("text", ["a\nb", 'say "x"', "back\\", "\\\"{", "\u0001", "a\tb" * 5000])
def test_json_walk_goes_below_escaped_strings(spark, text):
    row = json.dumps({"t": text, text: 0, "deep": {"x": {"u": text, "rejected": [], "pin": {"path": text, "sha256": "AB"}}}})
    df = spark.createDataFrame([(1, row)], "i int, j string").withColumn("v", F.parse_json("j"))
    assert df.select(ledger.nesting(F.col("v"))).first()[0] == 4
    assert [r.path for r in ledger.alternative_fields(df, ["i"], "v").collect()] == ["$.deep.x.rejected"]
    assert [(r.at, r.path) for r in ledger.pin_records(df, ["i"], "v").collect()] == [("$.deep.x.pin", text)]


def test_functions_work_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "Dom qa"), (2, "moj")], "doc_id long, text string").write.parquet(src)
    stream = spark.readStream.schema("doc_id long, text string").parquet(src)
    q = stream.select("doc_id", fx.project_text(F.col("text")).alias("text")).writeStream.format("memory").queryName("out").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.doc_id: r.text for r in spark.table("out").collect()} == {1: "Дом qa", 2: "мој"}


def test_failed_read_back_leaves_the_target_untouched(spark, monkeypatch):
    path, d = scratch_dir(spark), spark.range(5)
    with monkeypatch.context() as m:
        m.setattr(sinks, "verify_written", lambda *_: spark.createDataFrame([(False,)], "pass boolean"))
        with pytest.raises(sinks.ReadBackMismatch):
            sinks.write_once(d, path)
    assert sinks.write_once(d, path) == "WRITTEN"


def test_running_totals_of_any_key(spark):
    d = spark.createDataFrame([(1, 5), (1 << 49, 7), (1 << 50, 9), ((1 << 62) + 3, 2)], "k long, v long")
    got = {r.k: r.t for r in totals.global_running_total(d, "k", "v", "t").collect()}
    assert got == {1: 0, 1 << 49: 5, 1 << 50: 12, (1 << 62) + 3: 21}
    with pytest.raises(ValueError):
        totals.global_running_total(d.withColumn("k", -F.col("k")), "k", "v", "t")


def test_numbering_letters_by_rules(spark):
    cases = [(r"I\;-V", "label"), ("I;-V", "word"), (r"I\,-V", "label"), ("I-V", "label"), ("Kap I tu", "label"), ("kap I tu", "word"), ("Kapitel I tu", "label"), ("I) tu", "label")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = inventory.one_letter_inventory(docs, spark.createDataFrame([], "doc_id long, start long, end long"), inventory.label_rules(["Kap*"]), letters=("I",)).collect()
    got = {r.doc_id: "word" if r.disposition == inventory.LEXICAL else "label" for r in rows if r.surface == "I"}
    assert got == {i: kind for i, (_, kind) in enumerate(cases)}


def test_word_differences_shuffle_no_word(spark):
    from corpusgate.operators import gates, tokens

    a = spark.createDataFrame([(1, "a b b"), (2, "same same"), (3, None), (4, "only left"), (6, "x"), (6, "y x")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "b a c"), (2, "same same"), (3, "new"), (5, "only right"), (6, "y x"), (6, "z")], "doc_id long, text string")
    found = gates.word_differences(a, b, ["doc_id"])
    want = gates.multiset_differences(tokens.words(a, ["doc_id"]), tokens.words(b, ["doc_id"]), ["doc_id", "word"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
