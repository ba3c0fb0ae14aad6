"""Piece tables, walks over rows, edit sets and locators: against plain versions, deep, crossing, repeated and empty."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusgate.functions import arrays
from corpusgate.operators import edits, identity, markup, pieces, spans
from corpusgate.plans import marked

ROLES = {"a": "visible_math_text", "b": "protected_foreign", "c": "visible_prose"}


def plain_enclosing(tags, size, protected):
    """Every piece against every pair."""
    open_, pairs = {}, []
    for piece, name, sign in tags:
        if sign > 0:
            open_.setdefault(name, []).append(piece)
        elif open_.get(name):
            pairs.append((open_[name].pop(), piece, name))
    out = []
    for i in range(size):
        around = [p for p in pairs if p[0] < i < p[1]]
        out.append((max(around)[2] if around else None, any(protected[n] for *_, n in around)))
    return out


def spread(stretches, size):
    out = []
    for (first, *what), (end, *_) in zip(stretches, [*stretches[1:], (size,)], strict=True):
        out += [tuple(what)] * (end - first)
    return out


def test_innermost_element_of_crossing_and_broken_tags():
    rng = random.Random(3)
    protected = {k: v.startswith("protected") for k, v in ROLES.items()}
    for _ in range(400):
        size = rng.randint(1, 40)
        tags = [(i, rng.choice("abc"), rng.choice([1, -1])) for i in range(size) if rng.random() < 0.6]
        found, want = spread(pieces.enclosing(tags, size, protected), size), plain_enclosing(tags, size, protected)
        marked_ = {i for i, *_ in tags}
        assert [x for i, x in enumerate(found) if i not in marked_] == [x for i, x in enumerate(want) if i not in marked_]


def test_painting_is_linear_on_deep_pages(spark):
    deep = 10_000
    html = "".join(f"<{'abc'[i % 3]}>t{i} " for i in range(deep)) + "".join(f"</{'abc'[i % 3]}>" for i in reversed(range(deep)))
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = {r.run: r for r in pieces.paint_pages(df, ROLES).where("kind = 'text'").collect()}
    assert len(rows) == deep and all(rows[f"t{i} "].detail == "abc"[i % 3] and rows[f"t{i} "].under == (i > 0) for i in range(deep))
    assert markup.pair_tags(markup.lex_html(df)).where("state = 'PAIRED'").count() == deep


def test_pieces_rebuild_every_text(spark):
    texts = ["", None, "<", "a<b", "<!-- x --><p>12pt 3ptx A. Novak q.e.d. VI I) </p", "<b>5em</b>5<c>em</c> 7 true  cm", "x" * 5000, "<a></a>" * 500, "😀 <a>ž 1pt</a>"]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").withColumn("pieces", F.lit("?"))
    reviewed = spark.createDataFrame([(4, 12, 20), (4, 18, 30), (6, 10, 20), (3, 100, 200), (77, 1, 2)], "page_id long, start long, end long")
    for given in (None, reviewed):
        done = marked.project_marked(df, ROLES, given)
        rows = {r.page_id: r.pieces for r in done.table.collect()}
        assert {k: "".join(p.run for p in v) for k, v in rows.items()} == {i: t or "" for i, t in enumerate(texts)}
        assert all(p.start == sum(len(q.run) for q in v[:i]) for v in rows.values() for i, p in enumerate(v[:50]))
    kinds = {(p.run, p.kind) for v in rows.values() for p in v}
    assert {("pt", "unit"), ("ptx", "blocked"), ("<!-- x -->", "markup"), ("em", "unit")} <= kinds
    assert marked.project_marked(df.limit(0), ROLES).output.collect() == []


def test_units_need_their_digit_in_the_same_stretch(spark):
    df = spark.createDataFrame([(1, "<c>5em 5<a>em</a> 9mm5 3true pt</c>")], "page_id long, html string")
    rows = marked.project_marked(df, ROLES).table.first().pieces
    assert [p.run for p in rows if p.kind == "unit"] == ["em", "true pt"]
    assert "".join(p.out for p in rows) == "<c>5em 5<a>ем</a> 9мм5 3true pt</c>"


def test_gates_refuse_what_is_spoilt(spark):
    df = spark.createDataFrame([(1, "<c>kniga 5em <b>liber</b></c>"), (2, "<c>dom</c>")], "page_id long, html string")
    done = marked.project_marked(df, ROLES)
    again = marked.second_derivation(df, ROLES)
    assert all(r["pass"] for r in marked.gate_rows(df, done, again, ROLES).collect())
    bad = marked.MarkedProjection(done.table, done.output.withColumn("html", F.replace("html", F.lit("5em"), F.lit("5ем kniga"))), done.trace)
    rows = {r.code: r.failures for r in marked.gate_rows(df, bad, again, ROLES).collect()}
    assert rows == {"two_derivations_agree": 1, "inverse_replay": 1, "no_unprotected_latin": 1, "units_survive": 1, "no_projected_unit": 1}


# ---- walks ------------------------------------------------------------------------------------------------------------


def test_walks_of_null_empty_and_sliced_rows(spark):
    rows = [([3, 0, 2],), ([],), (None,), ([5],), ([1] * 700,)] * 40
    df = spark.createDataFrame(rows, "n array<int>").repartition(1)
    got = df.select("n", arrays.starts_of("n").alias("s"), arrays.reached_before(F.col("n").cast("array<bigint>")).alias("r"),
                    arrays.place_of(F.col("n").cast("array<bigint>"), arrays.starts_of("n")).alias("p")).collect()
    assert len(got) == len(rows)
    for n, s, r, p in got:
        n = n or []
        at = [sum(n[:i]) for i in range(len(n))]
        assert s == at and r == [max(n[:i], default=0) for i in range(len(n))]
        assert p == [max((j for j, x in enumerate(at) if x <= v), default=-1) for v in n]


# ---- locators and edits -------------------------------------------------------------------------------------------------


def random_texts(rng, n=25):
    return [(i, "".join(rng.choice(["a", "b", "é", " ", "\n", "\r\n", "x ", "😀"]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


LINE = re.compile("[^\n\r\x0b\x0c\x1c-\x1e\x85  ]*(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ])|[^\n\r\x0b\x0c\x1c-\x1e\x85  ]+")


def test_locators_of_any_place(spark):
    rng = random.Random(8)
    docs = random_texts(rng)
    rows = [(i, a, a + rng.randint(0, 50)) for i, t in docs for a in (rng.randint(0, len(t) + 3) for _ in range(4))] + [(99, 0, 1)]
    rows += rows[:5]
    got = identity.locate_manifest(spark.createDataFrame(rows, "doc_id long, start long, end long"), spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start, r.end) for r in got) == sorted(rows)
    texts = dict(docs)
    for r in got:
        t = texts.get(r.doc_id)
        if t is None or r.start >= len(t):
            assert r.surface is None and r.line_no is None
            continue
        lines = LINE.findall(t)
        at = [sum(map(len, lines[:i])) for i in range(len(lines))]
        n = max(i for i, x in enumerate(at) if x <= r.start)
        body = re.sub("[\n\r\x0b\x0c\x1c-\x1e\x85  ]+$", "", lines[n])
        before = re.sub("[\n\r\x0b\x0c\x1c-\x1e\x85  ]+$", "", t[at[n] : r.start])
        assert (r.surface, r.line_no, r.col_no) == (t[r.start : r.end], n + 1, r.start - at[n] + 1)
        assert r.byte_off == len("".join(lines[:n]).encode()) + len(before.encode())
        assert r.line_sha256 == hashlib.sha256(body.encode()).hexdigest().upper()
        assert r.context_sha256 == hashlib.sha256(t[max(r.start - 80, 0) : r.start + 160].encode()).hexdigest().upper()


def test_edit_sets_apply_and_undo(spark):
    docs = [(1, "kuća moja\r\nža dom\n"), (2, ""), (3, None), (4, "abc abc")]
    rows = [(1, 1, 6, "moja", "tvoja"), (1, 2, 1, "ža", "že"), (1, 2, 4, "dom", ""), (1, 9, 1, "x", "y"), (1, 1, 1, "kuca", "x"), (1, 1, 9, "a\r", "!"),
            (4, 1, 1, "abc", "d"), (4, 1, 2, "bc ", "e"), (4, 1, 5, "abc", "q"), (4, 1, 5, "abc", "z"), (5, 1, 1, "a", "b"), (2, 1, 1, "a", "b")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    sets = edits.edit_sets(d, spark.createDataFrame(rows, "doc_id long, line_no long, col_no long, old string, new string"))
    states = {(r.doc_id, r.line_no, r.col_no): r.state for r in sets.select("doc_id", F.inline("edits")).collect()}
    assert states == {(1, 1, 6): "APPLIES", (1, 2, 1): "APPLIES", (1, 2, 4): "APPLIES", (1, 9, 1): "NO_LINE", (1, 1, 1): "DRIFT", (1, 1, 9): "DRIFT",
                      (4, 1, 1): "APPLIES", (4, 1, 2): "OVERLAP", (4, 1, 5): "DUPLICATE", (5, 1, 1): "NO_LINE", (2, 1, 1): "NO_LINE"}
    assert {r.doc_id: r.text for r in edits.apply_sets(sets).collect()} == {1: "kuća tvoja\r\nže \n", 2: "", 3: None, 4: "d abc"}
    assert {r.doc_id: r.text for r in edits.apply_sets(edits.invert_sets(sets)).collect()} == dict(docs)


def test_a_word_that_fills_a_text_is_one_row(spark):
    docs = spark.createDataFrame([(1, "the " * 5000 + "end"), (2, None), (3, "")], "doc_id long, text string")
    mapping = spark.createDataFrame([("the", "tha"), ("the", "thz"), ("end", "")], "old string, new string")
    rows = {r.doc_id: r.text for r in edits.substitute_tokens(docs, mapping).collect()}
    assert rows == {1: "tha " * 5000, 2: None, 3: ""}


@pytest.mark.parametrize("ranges", [[(0, 3), (3, 8), (20, 30)], [], [(0, 100)]])
def test_covered_words(spark, ranges):
    text = "one two three four five"
    got = spans.words_covered(
        spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"),
        spark.createDataFrame([(1, a, b) for a, b in ranges], "doc_id long, start long, end long")).collect()
    union = {i for a, b in ranges for i in range(a, b)}
    assert sorted((r.off, r.word, r.covered) for r in got) == [(m.start(), m.group(), set(range(m.start(), m.end())) <= union) for m in re.finditer(r"\w+", text)]


def test_repeated_ranges_keep_their_rows(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    rows = spans.surfaces(docs, spark.createDataFrame([(1, 1, 3), (1, 1, 3)], "doc_id long, start long, end long")).collect()
    assert [r.surface for r in rows] == ["bc", "bc"]


def test_json_members_at_any_depth(spark):
    from corpusgate.operators import ledger

    deep = '{"k":' * 200 + '[{"rejected":[1,{"reject":2}]},"x",-1.5e3,{},[]]' + "}" * 200
    rows = [(1, deep), (2, "7"), (3, '"s"'), (4, "{}"), (5, None), (6, '{"a\\"b":{"reject":null},"reject":{"reject":1}}'), (7, '[[{"reject":"{["}]]')]
    df = spark.createDataFrame(rows, "i int, j string").withColumn("v", F.parse_json("j"))
    got = {(r.i, r.path, r.value) for r in ledger.alternative_fields(df, ["i"], "v").collect()}
    assert got == {(1, "$" + ".k" * 200 + "[0].rejected", '[1,{"reject":2}]'), (6, '$.a"b.reject', "null"), (6, "$.reject", '{"reject":1}'), (7, "$[0][0].reject", '"{["')}


def test_a_target_that_appears_during_the_write_stays_as_it_is(spark, monkeypatch):
    from corpusgate.session import scratch_dir
    from corpusgate.sources import sinks

    path = scratch_dir(spark)
    first = spark.range(3)
    assert sinks.write_once(first, path) == "WRITTEN"
    monkeypatch.setattr(sinks, "_existing", lambda *_: None)
    with pytest.raises(sinks.OverwriteRefused):
        sinks.write_once(spark.range(9), path)
    assert sorted(r.id for r in spark.read.option("recursiveFileLookup", "true").parquet(path).collect()) == [0, 1, 2]


def test_literals_inside_and_around_other_pieces(spark):
    """A literal right behind a number sign is one, and a name whose initials are a literal's keeps its surname."""
    texts = {1: "slovo\u00b2Q.E.D. voda", 2: "Q. E. D. Novak voda", 3: "Q.E.D. von Berg-Mayr voda", 4: "xQ. E. D. Novak voda", 5: "dugoslovostvo voda"}
    pages = spark.createDataFrame(list(texts.items()), "page_id bigint, html string")
    reviewed = spark.createDataFrame([(5, -1, 10)], "page_id bigint, start bigint, end bigint")
    done = marked.project_marked(pages, ROLES, reviewed)
    got = {r.page_id: r.html for r in done.output.collect()}
    assert got == {
        1: "slovo\u00b2Q.E.D. вода", 2: "Q. E. D. Novak вода", 3: "Q.E.D. von Berg-Mayr вода", 4: "xQ. E. D. Novak вода", 5: "dugoslovos" + "тво вода"}
    assert all(p.run is not None for r in done.table.collect() for p in r.pieces)
    whole = pages.where("page_id < 5")
    gates = marked.gate_rows(whole, marked.project_marked(whole, ROLES), marked.second_derivation(whole, ROLES), ROLES)
    assert {r.code: r.failures for r in gates.collect() if r.failures} == {}


def test_projection_of_many_spans_in_one_text(spark):
    """A text is cut once however many spans it has, and the second derivation deals out no runs."""
    import time

    from corpusgate.operators import projection

    n = 20_000
    docs = spark.createDataFrame([(1, "slovo Ab " * n), (2, ""), (3, None)], "doc_id bigint, text string")
    held = spark.range(n).selectExpr("1L AS doc_id", "id * 9 + 6 AS start", "id * 9 + 8 AS end")
    start = time.time()
    trace = projection.projection_trace(docs.where("doc_id < 3"), held)
    assert trace.where("protected AND out_text = 'Ab'").count() == n and trace.where("NOT protected").count() == n + 1
    assert time.time() - start < 40
    two = projection.project_by_tokens(docs.where("doc_id < 3"), held)
    assert "Generate" not in two._jdf.queryExecution().executedPlan().toString()
    assert two.where("doc_id = 1").first().text == "слово Ab " * n
    assert projection.derivations_agree(projection.project_documents(docs.where("doc_id < 3"), held), two).where("NOT pass").count() == 0


def test_locators_on_one_long_line(spark):
    """Rows of one line do not repeat the line: what a task holds grows with the text and its rows, not with their product."""
    n = 15_000
    text = "ča Ab " * n + "\r\nkraj"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    end = len(text) - 6
    rows = spark.range(n).selectExpr("1L AS doc_id", "id * 6 + 3 AS start", "id * 6 + 5 AS end").unionByName(
        spark.createDataFrame([(1, end + 1, end + 2), (1, end + 2, end + 6)], "doc_id bigint, start bigint, end bigint"))
    got = identity.locate_manifest(rows, docs)
    assert got.where("surface = 'Ab' AND line_no = 1 AND col_no = start + 1").count() == n
    assert got.select("line_sha256").distinct().count() == 2
    tail = {r.start: (r.byte_off, r.line_no) for r in got.where(f"start > {end} OR start = 9").collect()}
    assert tail == {9: (len(text[:9].encode()), 1), end + 1: (len(text[:end].encode()), 1), end + 2: (len(text[: end + 2].encode()), 2)}


def test_python_workers_hold_few_texts(spark, monkeypatch):
    from corpusgate import session

    before, seen = spark.conf.get(session.BATCH), []

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    stored = session.stored
    monkeypatch.setattr(session, "stored", lambda d: seen.append(spark.conf.get(session.BATCH)) or stored(d))
    got = [r.n for r in session.stored_by_text(spark.range(0, 700, 1, 1).mapInArrow(sizes, "n long")).collect()]
    assert sum(got) == 700 and max(got) == session.TEXTS and spark.conf.get(session.BATCH) == before
    seen.clear()
    pages = spark.createDataFrame([(1, "<p>Novak i Kapitel V. 12pt</p>")], "page_id long, html string")
    done = marked.project_marked(pages, ROLES)
    marked.gate_rows(pages, done, marked.second_derivation(pages, ROLES), ROLES)
    assert seen == [str(session.TEXTS)] * 4 and spark.conf.get(session.BATCH) == before


def test_refused_edits_hand_python_few_texts(spark, monkeypatch):
    from checks import rewriting
    from corpusgate import session

    seen, stored = [], session.stored
    monkeypatch.setattr(session, "stored", lambda d: seen.append(spark.conf.get(session.BATCH)) or stored(d))
    rewriting.r9_refused(spark, "/root/testdata/sf0.001")
    assert seen == [str(session.TEXTS)]
