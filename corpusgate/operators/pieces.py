"""The piece table of marked-up texts: one row a text, from which output, trace and protected ranges are all read.

One regex cuts a page into markup and the pieces its words are judged by: names, literals, units, words, and what stands
between.  Which element encloses a piece needs a stack, which no built-in function keeps; two small Arrow functions
walk the tags of a page and lay out offsets, both in time linear in its pieces and without a shuffle, however deep elements nest
and however they cross.  Everything else is expressions over the arrays of a row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tables as t
from ..functions import text as fx
from ..functions.arrays import cut_at, lists, starts_of
from . import inventory, markup, matches, spans

KEY = ("page_id",)
LITERAL = "(?:" + "|".join(x.replace(".", r"\.") for x in t.IDENTITY_LITERALS) + ")"
_MARKUP = r"(?is:<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]+>)"
_NOT_IN_WORD = rf"(?<![{t.LETTER}])"
_UNIT = rf"(?:(?iu)(?<=[0-9])(?:true[ \t]*)?(?:{t.UNIT_ALTERNATION})(?![{t.LETTER}\p{{Nd}}_]))"
_HERE = rf"{LITERAL}(?!\p{{L}})"
# A literal may begin right behind a number sign, which else is part of a word.
_WORD = rf"(?=[{t.LETTER}])(?:\p{{L}}++|[{t.LETTER}](?!{_HERE}))*+[{t.LETTER}]?+"


def _of_words(name: str) -> str:
    return name.replace(f"[{t.LETTER}]+", _WORD)


#: A literal's capitals and points could begin a name; the literal comes first, and what is left of the name follows it.
PIECE = (
    rf"{_MARKUP}|(?<!\p{{L}}){_HERE}|(?<=Q\. E\. D\.|Q\.E\.D\.){_of_words(matches.AFTER_INITIAL)}|{_NOT_IN_WORD}{_of_words(matches.INITIAL_NAME)}|{_UNIT}"
    rf"|{_WORD}|[^<{t.LETTER}]+|<"
)
#: Pieces on either side that a lone letter is judged by.
NEIGHBOURS, CONTEXT = 12, 120
HELD = ("name", "literal", "unit", "blocked", "held_letter")


# ---- walks ----------------------------------------------------------------------------------------------------------


def enclosing(tags: Sequence[tuple[int, str, int]], size: int, protected: dict[str, bool]) -> list[tuple[int, str | None, bool]]:
    """Stretches of pieces ``(first piece, element, under)``: the element opened last of those that enclose them.

    ``tags`` are (piece, name, sign) in order.  A closing tag closes the last open element of its name; elements that are never
    closed enclose nothing.  ``under`` tells whether any enclosing element is protected.
    """
    opened: dict[str, list[int]] = {}
    closes: dict[int, int] = {}
    for n, (_, name, sign) in enumerate(tags):
        if sign > 0:
            opened.setdefault(name, []).append(n)
        elif opened.get(name):
            closes[n] = opened[name].pop()
    paired = set(closes.values())
    stretches, stack, gone, deep = [(0, None, False)], [], set(), 0
    for n, (piece, name, sign) in enumerate(tags):
        if n in paired:
            stack.append(n)
            deep += protected[name]
        elif n in closes:
            gone.add(closes[n])
            deep -= protected[name]
            while stack and stack[-1] in gone:
                gone.remove(stack.pop())
        else:
            continue
        # An opening tag encloses what follows it, a closing one is itself no longer enclosed.
        at = piece + 1 if sign > 0 else piece
        now = (at, tags[stack[-1]][1] if stack else None, deep > 0)
        if stretches[-1][0] == at:
            stretches[-1] = now
        else:
            stretches.append(now)
    return [s for s in stretches if s[0] < size] or [(0, None, False)]


def enclosing_codes(protected: dict[str, bool]):
    """``codes(tags, size)``: for each piece twice the number of its element in ``protected`` (from 1; 0: none), plus ``under``."""
    number = {None: 0, **{name: i + 1 for i, name in enumerate(protected)}}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def codes(tags: pa.Array, sizes: pa.Array) -> pa.Array:
        out, lengths = [np.zeros(0, np.int32)], []
        # One page's tags are objects at a time; a batch of pages is not.
        for row, size in zip(tags, sizes.to_pylist(), strict=True):
            size = size or 0
            found = enclosing([(x["i"], x["tag"], x["sign"]) for x in row.as_py() or []], size, protected)
            first = np.array([s[0] for s in found])
            values = np.array([2 * number[s[1]] + s[2] for s in found], np.int32)
            out.append(np.repeat(values, np.diff(np.append(first, size))))
            lengths.append(size)
        return lists(pa.array(np.concatenate(out), pa.int32()), np.array(lengths, np.int64))

    return codes


# ---- lexing -----------------------------------------------------------------------------------------------------------


def _is_tag(run: Column) -> Column:
    return F.startswith(run, F.lit("<")) & (F.length(run) > 1)


def _tag_name(run: Column) -> Column:
    return F.lower(F.regexp_extract(run, "^</?([A-Za-z][A-Za-z0-9]*)", 1))


def _tag_sign(run: Column, name: Column) -> Column:
    idle = (name == "") | name.isin(*markup.VOID_TAGS) | F.endswith(run, F.lit("/>"))
    return F.when(idle, 0).when(F.startswith(run, F.lit("</")), -1).otherwise(1)


def _markup_kind(run: Column) -> Column:
    """comment, script, style or tag; null for everything else.  The lexer alone makes runs of these forms."""
    return F.when(~_is_tag(run), None).when(run.rlike(r"(?s)^<!--.*-->\z"), "comment").when(
        run.rlike(r"(?is)^<script\b.*</script>\z"), "script").when(run.rlike(r"(?is)^<style\b.*</style>\z"), "style").otherwise("tag")


def walked(pages: DataFrame, roles: markup.Roles, pattern: str, key: Sequence[str], html: str) -> DataFrame:
    """``key, _runs, _marks, _codes``: the runs of a page, what markup each is, and the code of its enclosing element."""
    d = pages.select(*key, F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), F.lit(0)).alias("_runs"))
    d = d.withColumn("_marks", F.transform("_runs", _markup_kind))
    tags = F.transform("_runs", lambda r, i: F.when(
        F.get("_marks", i) == "tag",
        F.struct(i.alias("i"), _tag_name(r).alias("tag"), _tag_sign(r, _tag_name(r)).alias("sign"))))
    wanted = F.filter(tags, lambda x: x.isNotNull() & x["tag"].isin(*roles) & (x["sign"] != 0))
    codes = enclosing_codes({k: v.startswith("protected") for k, v in roles.items()})
    return d.withColumn("_codes", codes(wanted, F.size("_runs")))


def _role(mark: Column, code: Column, roles: markup.Roles, default: str) -> Column:
    painted = F.get(F.array(*[F.lit(v) for v in roles.values()]), F.floor(code / 2).cast("int") - 1)
    return F.when(mark.isNull(), F.coalesce(painted, F.lit(default))).when(mark == "comment", "protected_comment").when(
        mark.isin("script", "style"), "protected_code").otherwise("protected_structure")


def paint_pages(pages: DataFrame, roles: markup.Roles, key: Sequence[str] = KEY, html: str = "html", default: str = "visible_prose") -> DataFrame:
    """Lexemes with ``start, end, run, kind, role, detail, under``: text takes the role of the innermost element around it."""
    d = walked(pages, roles, markup.HTML_LEXEME, key, html)
    d = d.withColumn("_at", starts_of(F.transform("_runs", lambda r: F.length(r))))
    d = d.select(*key, F.inline(F.arrays_zip("_at", "_runs", "_marks", "_codes")))
    names = F.get(F.array(*[F.lit(k) for k in roles]), F.floor(F.col("_codes") / 2).cast("int") - 1)
    text = F.col("_marks").isNull()
    kind = F.coalesce(F.col("_marks"), F.lit("text"))
    return d.select(
        *key, F.col("_at").alias("start"), (F.col("_at") + F.length("_runs")).alias("end"), F.col("_runs").alias("run"), kind.alias("kind"),
        _role(F.col("_marks"), F.col("_codes"), roles, default).alias("role"),
        F.coalesce(F.when(text, names), F.when(F.col("_marks") == "tag", _tag_name(F.col("_runs"))), kind).alias("detail"),
        (text & (F.col("_codes") % 2 == 1)).alias("under"),
    )


# ---- piece table -------------------------------------------------------------------------------------------------------


def _kind(i: Column, letters: Sequence[str], rules: Sequence[inventory.NeighbourRule]) -> Column:
    """What a piece that is not markup is; only a lone letter looks at its neighbours."""
    run, before = F.get("_runs", i), F.get("_runs", i - 1)
    left = F.array_join(F.slice("_runs", F.greatest(i - NEIGHBOURS, F.lit(0)) + 1, F.least(i, F.lit(NEIGHBOURS))), "")
    right = F.array_join(F.slice("_runs", i + 2, F.lit(NEIGHBOURS)), "")
    label = inventory.first_rule(run, F.right(left, F.lit(CONTEXT)), F.left(right, F.lit(CONTEXT)), rules, inventory.LEXICAL)
    held = F.when(F.startswith(label, F.lit("PRESERVE")), "held_letter")
    word = run.rlike(f"^[{t.LETTER}]")
    unit = before.rlike("[0-9]\\z") & run.rlike(rf"(?iu)^(?:true[ \t]*)?(?:{t.UNIT_ALTERNATION})\z")
    unit = unit & ~F.coalesce(F.get("_runs", i + 1), F.lit("")).rlike(r"^[\p{Nd}_]")
    return (
        F.when(~word, F.when(run.rlike(f"[{t.LETTER}]"), "name").otherwise("other")).when(run.isin(*t.IDENTITY_LITERALS), "literal").when(F.contains(run, F.lit(".")), "name")
        .when(unit, "unit").when(~fx.is_projectable(run), F.coalesce(F.when(run.isin(*letters), held), F.lit("blocked")))
        .otherwise(F.coalesce(F.when(run.isin(*letters), held), F.lit("word")))
    )


def piece_table(
    pages: DataFrame, roles: markup.Roles, reviewed: DataFrame | None = None, *, letters: Sequence[str] = ("I", "V", "M"),
    rules: Sequence[inventory.NeighbourRule] = (), hold_blocked: bool = True, key: Sequence[str] = KEY, html: str = "html",
) -> DataFrame:
    """``key, pieces``: for each text the array of ``start, run, kind, role, held, out``, gap-free and in order.

    ``kind`` is markup, name, literal, unit, word, blocked, held_letter or other.  Visible words are projected; a piece is ``held``
    if it is visible and stays as it is by its kind or because a ``reviewed`` range (``key, start, end``) covers it.
    Pieces are cut at the edges of reviewed ranges; a part of a word is judged as a word of its own, a part of an identity stays held.
    """
    d = walked(pages, roles, PIECE, key, html)
    d = d.withColumn("_len", F.transform("_runs", lambda r: F.length(r)))
    d = d.withColumn("_at", starts_of("_len"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    ranges = none
    if reviewed is not None:
        merged = spans.merge_ranges(reviewed, key).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_ranges"))
        d, ranges = d.join(merged, list(key), "left"), F.coalesce("_ranges", none)
    d = d.withColumn("_cut", cut_at("_at", "_len", F.transform(ranges, lambda r: r["start"]), F.transform(ranges, lambda r: r["end"])))
    own = [k for k in HELD if hold_blocked or k != "blocked"]

    # The loop reads arrays made below the walks only; one made beside it would be written into it and made for every piece.
    def part(c: Column) -> Column:
        i, whole, mark = c["i"], F.get("_runs", c["i"]), F.get("_marks", c["i"])
        uncut = c["n"] == F.length(whole)
        run = F.when(uncut, whole).otherwise(F.substring(whole, c["a"] + 1, c["n"]))
        # A part of a word is judged anew; what is an identity as a whole stays one in its parts.
        kind = _kind(i, letters, rules)
        kind = F.when(mark.isNotNull(), "markup").when(uncut, kind).when((kind == "word") & ~fx.is_projectable(run), "blocked").otherwise(kind)
        role = _role(mark, F.get("_codes", i), roles, "visible_prose")
        return F.struct((F.get("_at", i) + c["a"]).alias("start"), run.alias("run"), kind.alias("kind"), role.alias("role"), c["held"].alias("held"))

    def judged(p: Column) -> Column:
        visible = p["role"].isin(*t.VISIBLE_ROLES)
        stays = p["held"] | ~visible | (p["kind"] != "word")
        return F.struct(
            p["start"].alias("start"), p["run"].alias("run"), p["kind"].alias("kind"), p["role"].alias("role"),
            (visible & (p["held"] | p["kind"].isin(*own))).alias("held"), F.when(stays, p["run"]).otherwise(fx.project_word(p["run"])).alias("out"))

    return d.select(*key, F.transform(F.transform("_cut", part), judged).alias("pieces"))


# ---- what is read from it -------------------------------------------------------------------------------------------------


def output_of(table: DataFrame, key: Sequence[str] = KEY, html: str = "html") -> DataFrame:
    return table.select(*key, F.array_join("pieces.out", "").alias(html))


def source_of(table: DataFrame, key: Sequence[str] = KEY, html: str = "html") -> DataFrame:
    return table.select(*key, F.array_join("pieces.run", "").alias(html))


def held_trace(table: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Held pieces with their spans in both texts and the hash of what stands there."""
    d = table.withColumn("_o", starts_of(F.transform("pieces", lambda p: F.length(p["out"]))))
    d = d.select(*key, F.inline(F.filter(F.zip_with("pieces", "_o", lambda p, o: p.withField("out_start", o)), lambda p: p["held"])))
    return d.select(
        *key, "kind", F.col("start").alias("in_start"), (F.col("start") + F.length("run")).alias("in_end"),
        F.col("out_start"), (F.col("out_start") + F.length("out")).alias("out_end"), fx.sha256_upper(F.col("out")).alias("surface_sha256"))


def piece_census(table: DataFrame) -> DataFrame:
    """Pieces and characters by kind and role: counted in the row first, so no piece is shuffled."""
    d = table.select(F.inline(F.transform("pieces", lambda p: F.struct(p["kind"].alias("kind"), p["role"].alias("role"), p["held"].alias("held"), F.length(p["run"]).alias("n")))))
    return d.groupBy("kind", "role", "held").agg(F.count("*").alias("pieces"), F.sum("n").alias("scalars"))
