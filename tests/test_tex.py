"""TeX roles on generated documents: constructs are put together at random, and each states what must become of its text."""

import random
from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F

from corpusgate.functions import tables as t
from corpusgate.functions import text as fx
from corpusgate.operators import tex, tokens

WORDS = [("voda", "вода"), ("more", "море"), ("ulica", "улица"), ("Zima", "Зима"), ("nebo", "небо"), ("jutro", "јутро")]
HELD = ["qwe", "xwx", "wqa"]  # letters without a correspondence: blocked where they are shown


@dataclass
class Piece:
    """A piece of TeX, what projection makes of it, and what has to be reported."""

    source: str = ""
    projected: str = ""
    blocked: list = field(default_factory=list)
    unknown: list = field(default_factory=list)

    def __add__(self, other):
        return Piece(self.source + other.source, self.projected + other.projected, self.blocked + other.blocked, self.unknown + other.unknown)

    def inside(self, before, after):
        return Piece(before + self.source + after, before + self.projected + after, self.blocked, self.unknown)

    def hidden(self):
        """The same text where it is protected: nothing changes and no word counts."""
        return Piece(self.source, self.source)


def literal(text):
    return Piece(text, text)


class Maker:
    """Shown arguments keep what they hold visible, hidden ones protect it; top-level forms may not stand in arguments."""

    SHOWN = ("emph", "textbf", "underline", "textsc", "footnote", "caption")
    HIDDEN = ("label", "cite", "ref", "url", "pageref")

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def words(self, n=2):
        out = Piece()
        for i in range(n):
            word = self.rng.choice(HELD) if self.rng.random() < 0.2 else None
            latin, cyrillic = (word, word) if word else self.rng.choice(WORDS)
            out = out + literal(" " if i else "") + Piece(latin, cyrillic, [word] if word else [])
        return out

    def key(self):
        return "".join(self.rng.choice("abqxw") for _ in range(4))

    def formula(self, depth, display=False):
        inner = self.body(depth - 1).inside(r"+\text{", "}") if depth > 0 and self.rng.random() < 0.5 else Piece()
        left, right = (r"\[", r"\]") if display else self.rng.choice([("$", "$"), (r"\(", r"\)")])
        if "\\" in inner.source or "$" in inner.source:
            inner = self.words().inside(r"+\text{", "}")  # only prose stands inside a formula
        return (literal("x") + inner).inside(left, right)

    def part(self, depth):
        kind = self.rng.randrange(8 if depth > 0 else 3)
        if kind == 0:
            return self.words()
        if kind == 1:
            return literal(f"\\{self.rng.choice(self.HIDDEN)}{{{self.key()}}}")
        if kind == 2:
            return self.formula(depth)
        if kind == 3:
            return self.body(depth - 1).inside(f"\\{self.rng.choice(self.SHOWN)}{{", "}")
        if kind == 4:
            return self.body(depth - 1).inside("{", "}")
        if kind == 5:
            return self.words().inside(f"\\href{{https://{self.key()}.example/}}{{", "}")
        if kind == 6:
            return self.words().hidden().inside(r"\foreign{", "}")
        name = "strange" + self.rng.choice("abc")
        return Piece(unknown=[name]) + self.words().hidden().inside(f"\\{name}{{", "}")

    def body(self, depth):
        out = self.part(depth)
        for _ in range(self.rng.randrange(2)):
            out = out + literal(" ") + self.part(depth)
        return out

    def block(self):
        kind = self.rng.randrange(7)
        if kind == 6:
            return self.formula(2, display=True)
        if kind == 0:
            return literal("% ") + self.words().hidden() + literal("\n")
        if kind == 1:
            return self.words().hidden().inside("\\verb|", "|")
        if kind == 2:
            return self.words().hidden().inside("\\begin{verbatim}\n", " } $\n\\end{verbatim}")
        if kind == 3:
            return self.body(2).inside("\\begin{center}\n", "\n\\end{center}")
        if kind == 4:
            return self.words().inside("\\section*{", "}")
        return self.body(3)

    def document(self):
        out = Piece()
        for _ in range(self.rng.randrange(2, 7)):
            out = out + self.block() + literal("\n")
        return out.inside("\\documentclass{article}\n\\begin{document}\n", "\\end{document}\n")


MADE = [Maker(seed).document() for seed in range(80)]


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.createDataFrame([(i, p.source) for i, p in enumerate(MADE)], "doc_id long, text string")
    lex, policy = tex.lex_tex(docs), tex.policy_table(spark)
    segs = tex.text_segments(tex.paint_roles(lex, policy).cache()).cache()
    out = {r.doc_id: r.text for r in tex.project_tex(segs).collect()}
    visible = segs.where(F.col("role").isin(*t.VISIBLE_ROLES))
    words = tokens.words(visible, ["doc_id", "start"], "surface").where(~fx.is_projectable(F.col("word")))
    blocked, unknown = {}, {}
    for r in words.select("doc_id", "start", "word").orderBy("doc_id", "start").collect():
        blocked.setdefault(r.doc_id, []).append(r.word)
    for r in tex.unknown_commands(lex, policy).collect():
        unknown.setdefault(r.doc_id, []).append(r.command)
    errors = {r.doc_id for r in tex.structure_errors(docs).collect()}
    return out, blocked, unknown, errors


@pytest.mark.parametrize("i", range(len(MADE)))
def test_generated_document(results, i):
    out, blocked, unknown, errors = results
    want = MADE[i]
    assert i not in errors
    assert out[i] == want.projected
    assert sorted(blocked.get(i, [])) == sorted(want.blocked)
    assert set(unknown.get(i, [])) == set(want.unknown)


def test_generator_reaches_every_case():
    assert any(p.blocked for p in MADE) and any(p.unknown for p in MADE) and any(r"+\text{" in p.source for p in MADE)


@pytest.mark.parametrize(("broken", "code"), [
    (lambda s: s.replace("\\end{document}", "}\\end{document}"), "unmatched_closing_brace"),
    (lambda s: s.replace("\\begin{document}", "\\begin{document}{"), "unclosed_brace"),
    (lambda s: s.replace("\\end{document}", "\\begin{center}voda\\end{document}"), "mismatched_environment_end"),
    (lambda s: s.replace("\\end{document}", "\\begin{align}x\\end{gather}\\end{document}"), "mismatched_environment_end"),
    (lambda s: s.replace("\\end{document}", "\\[x\\)\\end{document}"), "mismatched_math_delimiter"),
    (lambda s: s.replace("\\end{document}", "$x\\end{document}"), "unclosed_math"),
    (lambda s: s.replace("\\begin{document}", "").replace("\\end{document}", ""), "document_environment_count"),
])
def test_breaking_a_sound_document(spark, broken, code):
    docs = spark.createDataFrame([(i, broken(p.source)) for i, p in enumerate(MADE[:6])], "doc_id long, text string")
    found = {}
    for r in tex.structure_errors(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.code)
    assert all(code in found.get(i, ()) for i in range(6)), found


def test_a_policy_decides_what_is_known(spark):
    source = "\\begin{document}\n\\island{voda} \\emph{more}\n\\end{document}\n"
    lex = tex.lex_tex(spark.createDataFrame([(1, source)], "doc_id long, text string"))
    full = tex.policy_table(spark, [("island", 1, "protected_foreign")])
    assert tex.project_tex(tex.text_segments(tex.paint_roles(lex, full))).first().text == source.replace("more", "море")
    assert tex.unknown_commands(lex, full).collect() == []
    less = full.where("command <> 'emph'")
    assert [r.command for r in tex.unknown_commands(lex, less).collect()] == ["emph"]


def test_three_documents_in_four_are_reported(spark):
    from checks import markup

    sf = "/root/testdata/sf0.001"
    found = markup.tex_errors(spark, sf).select("doc_id").distinct().count()
    assert found == spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 4 <> 0").count()


def test_stretches_match_brute_force():
    rng = random.Random(11)
    for _ in range(300):
        marks = sorted((a, a + rng.randrange(1, 12), rng.randrange(4)) for a in (rng.randrange(20) for _ in range(rng.randrange(9))))
        low, high, what = zip(*marks) if marks else ((), (), ())
        for at, raw, base, text, edge in tex.stretches(low, high, what):
            around = {w: [i for i in range(len(low)) if what[i] == w and low[i] <= at < high[i]] for w in range(4)}
            assert raw == min(around[tex.OPAQUE], default=-1) and base == max(around[tex.BASE], default=-1)
            assert text == bool(around[tex.BASE] and any(low[i] > low[base] for i in around[tex.MATH_TEXT]))
            assert edge == bool(around[tex.EDGE])


def test_no_lexeme_leaves_its_row(spark):
    from corpusgate.plans.tex import project_tex_corpus

    docs = spark.createDataFrame([(i, p.source) for i, p in enumerate(MADE[:6])], "doc_id long, text string")
    output = project_tex_corpus(docs, tex.policy_table(spark)).output
    plan = output._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan
    assert {r.doc_id: r.text for r in output.collect()} == {i: p.projected for i, p in enumerate(MADE[:6])}


def test_projection_by_stretches_equals_projection_by_words(spark):
    rng = random.Random(5)
    bits = ["ljubav", "NJ", "nj", "dŽ", "đ", "Đak", " ", "q", "Xw", "IV", "MMMM", "I", "слово", "mešaнo", "ſ", "́", "9", "²", "Ⅳ", "l", "j", "ďž", "\n", "𝒜", "IVa"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(2000)] + [(-1, None), (-2, "more ljudi " * 50_000)]
    d = spark.createDataFrame(rows, "id long, text string")
    by_words = fx.rewrite_words(F.col("text"), fx.project_word)
    assert d.where(~by_words.eqNullSafe(fx.project_text(F.col("text")))).count() == 0


def test_blocked_words_are_cut_without_the_others(spark):
    rng = random.Random(6)
    bits = ["ljubav", "nj", " ", "q", "Xw", "X", "IV", "MMMM", "I", "слово", "mešaнo", "́", "9", "²", "Ⅳ", "IVa", "-"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(1000)] + [(-1, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = tokens.tokenise(d).where(F.col("is_word") & ~fx.is_projectable(F.col("run"))).select("doc_id", "off", F.col("run").alias("word"))
    found = tokens.locate_blocked_words(d)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = tokens.blocked_words(d, ["doc_id"])
    assert sorted(map(tuple, plan.collect())) == sorted((r.doc_id, r.word) for r in want.collect())
