"""TeX text as tables: lexing, pairing, argument binding, role painting and validation.

No parser runs per row.  One regex cuts the lexemes, which stay in their row as arrays; only delimiters become rows of their own,
without text.  Pairs and argument chains are windows over one document's delimiters and roles come from a policy table.  What
sets a role travels back to its text once, as one list, and lexemes are painted and projected in the row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tables as t
from ..functions import texroles as r
from ..functions import text as fx
from ..functions.arrays import lists, numbers, place_of, starts_of
from ..session import stored
from . import spans

KEY = ("doc_id",)
_LITERAL = "(?:" + "|".join(rf"\Q{x}\E" for x in t.IDENTITY_LITERALS) + ")"
IDENTITY_LITERAL = rf"(?<!\p{{L}}){_LITERAL}(?!\p{{L}})"
_VERBATIM = "|".join(rf"\Q{e}\E" for e in r.VERBATIM_ENVIRONMENTS)
_STOP = r"\\%${}\[\]"
# Longest reading first; a control symbol takes its character with it, so "\\(" is a row break and a parenthesis.
TEX_LEXEME = "|".join((
    r"%[^\n]*+\n?",
    r"\\verb\*?+(?![\p{L}@])([^\n])[^\n]*?\1",
    rf"\\begin\s*\{{({_VERBATIM})\}}(?s:.*?)(?m:^)[ \t]*\\end\s*\{{\2\}}",
    r"\\(?:begin|end)(?![\p{L}@*])\s*\{[^{}\\%]*\}",
    r"\\[\p{L}@]++\*?",
    r"\\(?s:.)",
    r"\\",
    r"\$\$?",
    r"[{}\[\]]",
    IDENTITY_LITERAL,
    rf"[{t.SPACE}]++",
    rf"[^{_STOP}qQ{t.SPACE}][^{_STOP}qQ]*+",
    "[qQ]",
))


def identity_literals(text: Column) -> Column:
    """Exact identity literals that no letter touches on either side."""
    return F.regexp_extract_all(text, F.lit(IDENTITY_LITERAL), F.lit(0))


def _kind(run: Column) -> Column:
    """What a lexeme is; its first character settles most of it."""
    first = F.left(run, F.lit(1))
    return (
        F.when(first == "%", "comment")
        .when(first == "\\", F.when(run.rlike(r"^\\verb\*?(?![\p{L}@])."), "verb")
              .when(run.rlike(rf"^\\begin\s*\{{(?:{_VERBATIM})\}}(?s:.*)\\end"), "verbatim")
              .when(run.rlike(r"^\\begin\s*\{"), "begin").when(run.rlike(r"^\\end\s*\{"), "end")
              .when(run.rlike(r"^\\[\p{L}@]"), "word").otherwise("symbol"))
        .when(first == "$", "dollar").when(first == "{", "open").when(first == "}", "close")
        .when(first == "[", "left").when(first == "]", "right")
        .when(run.isin(*t.IDENTITY_LITERALS), "literal").when(first.rlike(f"[{t.SPACE}]"), "space")
        .otherwise("text")
    )


def lex_tex(docs: DataFrame, key: Sequence[str] = KEY, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``key, runs, kinds, at``: for each document the arrays of its lexemes, what each is, and where it starts."""
    d = docs.select(*key, *keep, F.regexp_extract_all(F.col(text), F.lit(TEX_LEXEME), F.lit(0)).alias("runs"))
    d = d.withColumn("kinds", F.transform("runs", _kind))
    return d.withColumn("at", starts_of(F.transform("runs", lambda x: F.length(x))))


def delimiters(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``key, pos, off, size, kind, name, n, depth, total`` and what precedes (``_p1, _p2, _p3``) of braces, brackets, dollars,
    environments and math symbols.

    ``n`` counts the lexemes that are neither space nor comment, ``depth`` the open braces, ``total`` the characters of the text.
    """
    solid = F.array_compact(F.transform("kinds", lambda k, i: F.when(~k.isin("space", "comment"), i)))
    brace = lambda k: F.when(k == "open", 1).when(k == "close", -1).otherwise(0)
    d = lexemes.withColumn("_at", solid)
    d = d.withColumn("_sign", F.transform("_at", lambda i: brace(F.get("kinds", i))))
    d = d.withColumn("_before", starts_of("_sign"))

    def name(i: Column) -> Column:
        kind, run = F.get("kinds", i), F.get("runs", i)
        return F.when(kind.isin("begin", "end"), F.regexp_extract(run, r"\{([^{}]*)\}", 1)).when(
            kind.isin("word", "symbol"), run.substr(F.lit(2), F.length(run)))

    def near(i: Column) -> Column:
        return F.when(i.isNotNull(), F.struct(F.get("kinds", i).alias("kind"), name(i).alias("name"), F.startswith(F.get("runs", i), F.lit("#")).alias("hash")))

    def row(m: Column) -> Column:
        i = F.get("_at", m)
        return F.struct(
            i.cast("bigint").alias("pos"), F.get("at", i).alias("off"), F.length(F.get("runs", i)).alias("size"), F.get("kinds", i).alias("kind"), name(i).alias("name"),
            (m + 1).alias("n"), (F.get("_before", m) + F.get("_sign", m)).alias("depth"), *[near(F.get("_at", m - k)).alias(f"_p{k}") for k in (1, 2, 3)])

    def wanted(i: Column) -> Column:
        kind = F.get("kinds", i)
        return kind.isin("open", "close", "left", "right", "dollar", "begin", "end") | ((kind == "symbol") & F.get("runs", i).isin(r"\(", r"\)", r"\[", r"\]"))

    picked = F.array_compact(F.transform("_at", lambda i, m: F.when(wanted(i), m)))
    total = F.try_element_at("at", F.lit(-1)) + F.length(F.try_element_at("runs", F.lit(-1)))
    return d.select(*key, total.alias("total"), F.explode(F.transform(picked, row)).alias("_d")).select(*key, "total", "_d.*")


def _pairs(rows: DataFrame, part: Sequence[str], sign: Column, keep: Sequence[str]) -> DataFrame:
    """Openers with the closer of their level; the rows of one level alternate, so that is the next row."""
    w = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = rows.withColumn("_s", sign)
    d = d.withColumn("_d", F.sum("_s").over(w)).withColumn("_lv", F.when(F.col("_s") == 1, F.col("_d")).otherwise(F.col("_d") + 1))
    lw = Window.partitionBy(*part, "_lv").orderBy("pos")
    nxt = F.lead(F.struct("pos", "off", "n", "name", "size")).over(lw)
    d = d.withColumns({"_next": nxt, "_prev": F.lag("_s").over(lw)})
    return d.where((F.col("_s") == 1) | F.col("_prev").isNull()).select(
        *keep, "pos", "off", "size", "name", "n", "_s", F.col("_next.pos").alias("c_pos"), F.col("_next.off").alias("c_off"),
        F.col("_next.n").alias("c_n"), F.col("_next.name").alias("c_name"), F.col("_next.size").alias("c_size"),
    )


def _in_groups(marks: DataFrame, key: Sequence[str]) -> DataFrame:
    """Brackets and dollars with the brace group ``gid`` around them."""
    w = Window.partitionBy(*key, "depth").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = marks.where("kind IN ('open', 'left', 'right', 'dollar')")
    d = d.withColumn("gid", F.coalesce(F.last(F.when(F.col("kind") == "open", F.col("pos")), True).over(w), F.lit(-1)))
    return d.where("kind <> 'open'")


def bind_groups(marks: DataFrame, policy: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Groups and brackets with their owner, argument number and role.

    Arguments form chains: each starts right after the one before has closed.  What precedes the chain owns it.
    """
    braces = _pairs(marks.where("kind IN ('open', 'close')"), key, F.when(F.col("kind") == "open", 1).otherwise(-1),
                    [*key, "kind", "depth", "_p1", "_p2", "_p3"]).where("_s = 1")
    brackets = _pairs(_in_groups(marks, key).where("kind <> 'dollar'"), [*key, "depth", "gid"],
                      F.when(F.col("kind") == "left", 1).otherwise(-1), [*key, "kind", "depth", "_p1", "_p2", "_p3"]).where("_s = 1")
    brackets = brackets.withColumn("depth", F.col("depth") + 1)
    g = braces.unionByName(brackets).where(F.col("c_pos").isNotNull())
    w = Window.partitionBy(*key, "depth").orderBy("n")
    g = g.withColumn("_start", F.when(F.lag("c_n").over(w) == F.col("n") - 1, 0).otherwise(1))
    g = g.withColumn("_chain", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cw = Window.partitionBy(*key, "depth", "_chain").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    p1, p2, p3 = F.col("_p1"), F.col("_p2"), F.col("_p3")
    definer = list(r.DEFINITION_COMMANDS)
    owner = (
        F.when((p1["kind"] == "word") & (p2["kind"] == "word") & p2["name"].isin(definer), p2["name"])
        .when((p1["kind"] == "text") & p1["hash"] & (p3["kind"] == "word") & p3["name"].isin(definer), p3["name"])
        .when(p1["kind"] == "word", p1["name"])
        .when(p1["kind"] == "begin", F.concat(F.lit("env:"), p1["name"]))
        .when((p1["kind"] == "symbol") & (p1["name"] == "\\"), F.lit("\\"))
    )
    g = g.withColumns({
        "owner": F.first(F.when(F.col("_start") == 1, owner), ignorenulls=False).over(cw),
        "arg_no": F.when(F.col("kind") == "open", F.count_if(F.col("kind") == "open").over(cw)).otherwise(0),
        # A definition may name its target bare, in which case its groups start one later.
        "_bare": F.first((p1["kind"] == "word") & (p2["kind"] == "word") & p2["name"].isin(definer)).over(cw),
    })
    j = g.join(policy.withColumnRenamed("command", "owner"), ["owner", "arg_no"], "left")
    listed = policy.select(F.col("command").alias("owner"), F.lit(True).alias("_listed")).distinct()
    j = j.join(listed, "owner", "left")
    known = F.coalesce("_listed", F.lit(False)) | F.col("owner").isin(*r.WITHOUT_ARGUMENT, *r.EMPTY_GROUP) | F.startswith("owner", F.lit("env:"))
    empty = F.col("off") + 1 == F.col("c_off")
    role = (
        F.when(F.col("owner").isin(*r.EMPTY_GROUP) & (F.col("kind") == "open"), F.when(empty, "protected_structure").otherwise("ambiguous_command_arg"))
        .when(F.col("owner") == "\\", F.when(F.col("kind") == "left", "protected_control"))
        .when(F.col("role").isNotNull(), F.col("role"))
        .when(F.col("owner").isNotNull() & ~known, "ambiguous_command_arg")
    )
    unknown = (role == "ambiguous_command_arg")
    return j.select(
        *key, "pos", "c_pos", "kind", "owner", "arg_no", F.col("off").alias("start"), (F.col("c_off") + 1).alias("end"),
        role.alias("role"), F.coalesce(unknown, F.lit(False)).alias("unknown"),
    )


def _environments(marks: DataFrame, key: Sequence[str]) -> DataFrame:
    return _pairs(marks.where("kind IN ('begin', 'end')"), key, F.when(F.col("kind") == "begin", 1).otherwise(-1), [*key, "total"])


def _symbols(marks: DataFrame, key: Sequence[str]) -> DataFrame:
    return _pairs(marks.where("kind = 'symbol'"), key, F.when(F.col("name").isin("(", "["), 1).otherwise(-1), [*key])


def _dollars(marks: DataFrame, key: Sequence[str]) -> DataFrame:
    """Dollar delimiters toggle within their own group, so mathematics inside a text argument pairs by itself."""
    w = Window.partitionBy(*key, "gid", "depth").orderBy("pos")
    d = _in_groups(marks, key).where("kind = 'dollar'").withColumns({
        "_i": F.row_number().over(w), "c_off": F.lead("off").over(w), "c_size": F.lead("size").over(w),
    })
    return d.where("_i % 2 = 1").select(*key, "pos", "off", "size", "c_off", "c_size")


def structure_errors(docs: DataFrame, key: Sequence[str] = KEY, text: str = "text", marks: DataFrame | None = None) -> DataFrame:
    """``key, off, code`` of every unmatched, mismatched or unclosed brace, environment and math delimiter.

    The delimiters have several readers, so they are stored once.
    """
    marks = stored(delimiters(lex_tex(docs, key, text), key)) if marks is None else marks
    brace = _pairs(marks.where("kind IN ('open', 'close')"), key, F.when(F.col("kind") == "open", 1).otherwise(-1), [*key])

    def errors(d: DataFrame, code: Column) -> DataFrame:
        # A mismatch is noticed at the closer, everything else at the delimiter itself.
        at = F.when(F.startswith("code", F.lit("mismatched")) & F.col("c_off").isNotNull(), F.col("c_off")).otherwise(F.col("off"))
        return d.withColumn("code", code).where(F.col("code").isNotNull()).select(*key, at.alias("off"), "code")

    env = _environments(marks, key)
    sym = _symbols(marks, key)
    closer = F.when(F.col("name") == "(", ")").otherwise("]")
    count = marks.where("kind = 'end' AND name = 'document'").groupBy(*key).agg(F.count("*").alias("_n"))
    out = errors(brace, F.when(F.col("_s") == -1, "unmatched_closing_brace").when(F.col("c_pos").isNull(), "unclosed_brace"))
    out = out.unionByName(errors(env, F.when(F.col("_s") == -1, "unmatched_environment_end").when(F.col("c_pos").isNull(), "unclosed_environment")
                                 .when(F.col("name") != F.col("c_name"), "mismatched_environment_end")))
    out = out.unionByName(errors(sym, F.when(F.col("_s") == -1, "mismatched_math_delimiter").when(F.col("c_pos").isNull(), "unclosed_math")
                                 .when(F.col("c_name") != closer, "mismatched_math_delimiter")))
    out = out.unionByName(errors(_dollars(marks, key), F.when(F.col("c_off").isNull(), "unclosed_math")
                                 .when(F.col("size") != F.col("c_size"), "mismatched_dollar_delimiter")))
    none = docs.select(*key).join(count, list(key), "left").where(F.coalesce("_n", F.lit(0)) != 1)
    return out.unionByName(none.select(*key, F.lit(0).cast("bigint").alias("off"), F.lit("document_environment_count").alias("code")))


def _read_arguments(args: DataFrame, maths: DataFrame, key: Sequence[str]) -> DataFrame:
    """Arguments that are read as such: not those inside a raw one, and inside mathematics only text and foreign ones."""
    text_args = args.where("role = 'math_text'").select(
        *key, (F.col("start") + 1).alias("start"), (F.col("end") - 1).alias("end"), F.lit("text").alias("_what")
    )
    raws = args.where("raw").select(*key, "start", "end", F.lit("raw").alias("_what"))
    around = maths.select(*key, "start", "end", F.lit("math").alias("_what")).unionByName(text_args).unionByName(raws)
    hit = spans.overlaps(args.select(*key, "start", "end"), around.where("start < end"), key, ["_what"])
    hit = hit.where((F.col("r_start") < F.col("start")) & (F.col("end") <= F.col("r_end")))

    def innermost(what: str) -> Column:
        return F.max(F.when(F.col("_what") == what, F.col("r_start")))

    per = hit.groupBy(*key, "start").agg(
        innermost("math").alias("_m"), innermost("text").alias("_t"), F.bool_or(F.col("_what") == "raw").alias("_in_raw")
    )
    j = args.join(per, [*key, "start"], "left")
    in_math = F.col("_m").isNotNull() & F.coalesce(F.col("_t") <= F.col("_m"), F.lit(True))
    special = F.col("owner").isin(*r.MATH_TEXT_COMMANDS, *r.FOREIGN_COMMANDS, "\\") | (F.col("role") == "protected_foreign") | F.startswith("owner", F.lit("env:"))
    return j.where(~F.coalesce("_in_raw", F.lit(False)) & (~in_math | special)).drop("_m", "_t", "_in_raw")


def role_spans(marks: DataFrame, policy: DataFrame, key: Sequence[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """``key, start, end, paint, opaque`` of everything that sets a role, and the bound arguments."""
    groups = bind_groups(marks, policy, key)
    env = _environments(marks, key).where("c_pos IS NOT NULL AND _s = 1")
    end = F.col("c_off") + F.col("c_size")
    body = F.col("off") + F.col("size")

    def span(d: DataFrame, start: Column, stop: Column, paint: Column, opaque: bool) -> DataFrame:
        return d.select(*key, start.alias("start"), stop.alias("end"), paint.alias("paint"), F.lit(opaque).alias("opaque"))

    doc = env.where("name = 'document'").select(*key, F.col("off").alias("_from"), end.alias("_to"), "total")
    preamble = span(doc, F.lit(0).cast("bigint"), F.col("_from"), F.lit("protected_preamble"), False)
    after = span(doc, F.col("_to"), F.col("total"), F.lit("protected_preamble"), True)
    # Before the document only theorem declarations are read; everything else there stays as it is.
    args = groups.where("role IS NOT NULL").join(doc.select(*key, "_from"), list(key))
    args = args.where((F.col("start") > F.col("_from")) | F.col("owner").isin("newtheorem", "newtheorem*"))
    raw = F.startswith("role", F.lit("protected")) | ((F.col("role") == "ambiguous_command_arg") & (F.col("kind") == "left"))
    sym = span(_symbols(marks, key).where("c_pos IS NOT NULL AND _s = 1"), F.col("off"), end, F.lit("protected_math"), False)
    dol = _dollars(marks, key).where("c_off IS NOT NULL")
    dol = span(dol, F.col("off"), F.col("c_off") + F.col("c_size"), F.lit("protected_math"), False)
    maths = span(env.where(F.col("name").isin(*r.MATH_ENVIRONMENTS)), body, F.col("c_off"), F.lit("protected_math"), False)
    maths = maths.unionByName(sym).unionByName(dol)
    args = _read_arguments(args.withColumn("raw", raw), maths, key)
    opaque = span(args.where("raw"), F.col("start"), F.col("end"), F.col("role"), True)
    painted = args.where("NOT raw AND role <> 'inherit'")
    painted = span(painted, F.col("start") + 1, F.col("end") - 1, F.col("role"), False)
    foreign = span(env.where(F.col("name").isin(*r.FOREIGN_ENVIRONMENTS)), body, F.col("c_off"), F.lit("protected_foreign"), True)
    code = span(env.where(F.col("name").isin(*r.CODE_ENVIRONMENTS)), body, F.col("c_off"), F.lit("protected_code"), True)
    out = preamble
    for d in (after, opaque, painted, maths, foreign, code):
        out = out.unionByName(d)
    return out.where("start < end"), args


#: What a mark does to the lexemes inside it: gives them a role, decides over all inside it, shows text of mathematics, or is an edge.
BASE, OPAQUE, MATH_TEXT, EDGE = range(4)


def stretches(low: Sequence[int], high: Sequence[int], what: Sequence[int]) -> list[tuple[int, int, int, bool, bool]]:
    """Where the marks that count change: ``at, raw, base, text, edge``, from marks in order of their start.

    ``raw`` is the first opaque mark around the stretch and ``base`` the one that starts last (-1: none); ``text``: a mark of shown
    text starts after the base.  A mark that has ended never counts again, so each is taken up and dropped once.
    """
    out, taken, first, i = [], ([], [], [], []), 0, 0
    base, raws, text, edges = taken
    for at in sorted({*low, *high}):
        while i < len(low) and low[i] <= at:
            taken[what[i]].append(i)
            i += 1
        for stack in (base, text, edges):
            while stack and high[stack[-1]] <= at:
                stack.pop()
        while first < len(raws) and high[raws[first]] <= at:
            first += 1
        shown = bool(base and text) and low[text[-1]] > low[base[-1]]
        out.append((at, raws[first] if first < len(raws) else -1, base[-1] if base else -1, shown, bool(edges)))
    return out


_STRETCH = {"at": (T.LongType(), np.int64), "raw": (T.IntegerType(), np.int32), "base": (T.IntegerType(), np.int32), "text": (T.BooleanType(), bool), "edge": (T.BooleanType(), bool)}


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(k, v[0]) for k, v in _STRETCH.items()])))
def _stretches(low: pa.Array, high: pa.Array, what: pa.Array) -> pa.Array:
    lo, first, n = numbers(low)
    (hi, *_), (sort, *_) = numbers(high), numbers(what)
    columns, sizes = {k: [np.zeros(0, v[1])] for k, v in _STRETCH.items()}, []
    for a, k in zip(first, n, strict=True):
        rows = stretches(*(x[a : a + k].tolist() for x in (lo, hi, sort)))
        for (name, (_, kind)), values in zip(_STRETCH.items(), zip(*rows, strict=True), strict=False):
            columns[name].append(np.array(values, kind))
        sizes.append(len(rows))
    return lists(pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in columns.values()], list(columns)), sizes)


def paint_roles(lexemes: DataFrame, policy: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``key, runs, kinds, at, roles``: an opaque span decides over all inside it, else the innermost span does;
    a text argument is visible prose of mathematics only where mathematics surrounds it."""
    return paint(lexemes, *role_spans(delimiters(lexemes, key), policy, key), key)


def marks_by_text(spans_: DataFrame, args: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``key, _marks``: the ordered list of what sets a role in a text."""
    what = F.when(F.col("opaque"), OPAQUE).when(F.col("paint") == "math_text", MATH_TEXT).otherwise(BASE)
    rows = spans_.select(*key, F.struct("start", "paint", "end", what.alias("what")).alias("_m"))
    ends = args.where("kind = 'left' AND role IN ('inherit', 'math_text')").select(*key, F.explode(F.array("start", F.col("end") - 1)).alias("start"))
    edge = F.struct("start", F.lit("").alias("paint"), (F.col("start") + 1).alias("end"), F.lit(EDGE).alias("what"))
    rows = rows.unionByName(ends.select(*key, edge.alias("_m")))
    return rows.groupBy(*key).agg(F.array_sort(F.collect_list("_m")).alias("_marks"))


def paint(lexemes: DataFrame, spans_: DataFrame, args: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """:func:`paint_roles` from role spans and arguments at hand."""
    return paint_marked(lexemes.join(marks_by_text(spans_, args, key), list(key), "left"), key)


def paint_marked(d: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """:func:`paint_roles` of lexemes with their ``_marks``; no lexeme leaves its row."""
    none = F.array().cast("array<struct<start:bigint,paint:string,end:bigint,what:int>>")
    d = d.withColumn("_marks", F.coalesce("_marks", none))
    field = lambda name: F.transform("_marks", lambda m: m[name])
    d = d.withColumn("_st", _stretches(field("start"), field("end"), field("what")))
    d = d.withColumn("_in", place_of("at", F.transform("_st", lambda x: x["at"])))
    paint_of = lambda i: F.get("_marks", i)["paint"]

    # An index of -1 gives null.
    def role(kind: Column, place: Column) -> Column:
        s = F.get("_st", place)
        raw, base = paint_of(s["raw"]), paint_of(s["base"])
        ctx = F.coalesce(raw, F.when((base == "protected_math") & s["text"], "visible_math_text").otherwise(base), F.lit("visible_prose"))
        return (
            F.when((kind == "comment") & raw.isNull(), "protected_comment")
            .when(~ctx.isin(*t.VISIBLE_ROLES, "ambiguous_command_arg"), ctx)
            .when(kind.isin("verb", "verbatim"), "protected_verbatim")
            .when(kind.isin("word", "symbol"), "protected_control")
            .when(kind.isin("begin", "end", "open", "close") | s["edge"], "protected_structure")
            .when(kind == "literal", "protected_identity_literal")
            .otherwise(ctx)
        )

    return d.select(*key, "runs", "kinds", "at", F.zip_with("kinds", "_in", role).alias("roles"))


def _segments(painted: DataFrame, key: Sequence[str]) -> DataFrame:
    first = F.transform("roles", lambda x, i: F.when((i == 0) | (x != F.get("roles", i - 1)), i))
    d = painted.withColumn("_first", F.array_compact(first))

    def segment(i: Column, n: Column) -> Column:
        stop = F.coalesce(F.get("_first", n + 1), F.size("runs"))
        surface = F.array_join(F.slice("runs", i + 1, stop - i), "")
        return F.struct(F.get("roles", i).alias("role"), F.get("at", i).alias("start"), (F.get("at", i) + F.length(surface)).alias("end"), surface.alias("surface"))

    return d.select(*key, F.transform("_first", segment).alias("_segments"))


def text_segments(painted: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Adjacent lexemes of one role as one segment with its text, so that no word is cut where the lexer paused."""
    return _segments(painted, key).select(*key, F.inline("_segments"))


def _shown(role: Column, surface: Column) -> Column:
    return F.when(role.isin(*t.VISIBLE_ROLES), fx.project_text(surface)).otherwise(surface)


def project_painted(painted: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Whole documents with visible segments projected in their row."""
    return _segments(painted, key).select(*key, F.array_join(F.transform("_segments", lambda s: _shown(s["role"], s["surface"])), "").alias(text))


def project_tex(segments: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """:func:`project_painted` from a table of segments."""
    d = segments.select(*key, F.struct("start", _shown(F.col("role"), F.col("surface")).alias("out")).alias("_s"))
    return d.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("_s")).getField("out"), "").alias(text))


def unknown_commands(lexemes: DataFrame, policy: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Commands with arguments that no policy covers; they are held, not guessed."""
    return unknown_arguments(role_spans(delimiters(lexemes, key), policy, key)[1], key)


def unknown_arguments(args: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return args.where("unknown").select(*key, F.col("owner").alias("command")).distinct()


def policy_table(spark, extra: Sequence[tuple[str, int, str]] = ()) -> DataFrame:
    """The built-in policy and the rows an edition adds for commands of its own (argument 0 is the bracket)."""
    added = {c for c, _, _ in extra}
    rows = [row for row in r.argument_policy() if row[0] not in added]
    return spark.createDataFrame([*rows, *extra], "command string, arg_no int, role string")
