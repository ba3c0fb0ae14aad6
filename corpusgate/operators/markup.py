"""Markup as a table: lexing, pairing, validation and role painting for HTML pages.

Lexing is one regex alternation with running offsets, pairing and depth are windows over one page's tags, and painting
is an interval join.  A page is one text cell, so its tags are no more than its characters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as fx
from ..functions.prefix import explode_runs
from . import spans

KEY = ("page_id",)
# Comments, scripts and styles are matched whole, so nothing inside them is ever read as markup.
HTML_LEXEME = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]+>|[^<]+|<"
# --- fixed values: elements that never close ---
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

Roles = Mapping[str, str]


def lex_html(pages: DataFrame, key: Sequence[str] = KEY, html: str = "html") -> DataFrame:
    """``key, pos, off, run, kind, tag, sign``: sign is 1 for an opening tag, -1 for a closing one, else 0."""
    d = explode_runs(pages, F.regexp_extract_all(F.col(html), F.lit(HTML_LEXEME), F.lit(0)), key)
    run = F.col("run")
    kind = (
        F.when(~F.startswith(run, F.lit("<")) | (run == "<"), "text")
        .when(run.rlike(r"(?s)^<!--.*-->\z"), "comment")
        .when(run.rlike(r"(?is)^<script\b.*</script>\z"), "script")
        .when(run.rlike(r"(?is)^<style\b.*</style>\z"), "style")
        .otherwise("tag")
    )
    tag = F.when(F.col("kind") == "tag", F.lower(F.regexp_extract(run, "^</?([A-Za-z][A-Za-z0-9]*)", 1)))
    sign = (
        F.when((F.col("kind") != "tag") | (F.col("tag") == "") | F.col("tag").isin(*VOID_TAGS) | F.endswith(run, F.lit("/>")), 0)
        .when(F.startswith(run, F.lit("</")), -1)
        .otherwise(1)
    )
    d = d.withColumn("kind", kind)
    d = d.withColumn("tag", tag)
    return d.withColumn("sign", sign)


def nesting(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Tags with the depth reached after each of them, over all names."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return lexemes.where("sign <> 0").withColumn("depth", F.sum("sign").over(w))


def depth_report(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per text: deepest and lowest depth, final depth; a negative low or a non-zero end is a structure error."""
    return nesting(lexemes, key).groupBy(*key).agg(
        F.max("depth").alias("max_depth"), F.min("depth").alias("min_depth"), F.max_by("depth", "pos").alias("final_depth")
    ).withColumn("pass", (F.col("min_depth") >= 0) & (F.col("final_depth") == 0))


def pair_tags(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Openers with their closers, per name, and what stays without one: ``state`` PAIRED, UNCLOSED or UNMATCHED.

    At one level of one name, openers and closers alternate, since depth moves in steps of one; so an opener's closer
    is simply the next row of its level.
    """
    t = nesting(lexemes, key)
    w = Window.partitionBy(*key, "tag").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = F.sum("sign").over(w)
    t = t.withColumn("level", F.when(F.col("sign") == 1, own).otherwise(own + 1))
    lw = Window.partitionBy(*key, "tag", "level").orderBy("pos")
    inside = F.col("depth") + F.when(F.col("sign") == -1, 1).otherwise(0)
    t = t.withColumns({
        "_next": F.lead(F.struct("pos", "off", F.length("run").alias("n"), inside.alias("d"))).over(lw),
        "_prev": F.lag("sign").over(lw),
    })
    opens = F.col("sign") == 1
    d = t.where(opens | F.col("_prev").isNull()).select(
        *key, "tag", "level", F.col("pos").alias("open_pos"), F.col("off").alias("start"),
        (F.col("off") + F.length("run")).alias("inner_start"), F.col("_next.off").alias("inner_end"),
        (F.col("_next.off") + F.col("_next.n")).alias("end"), F.col("_next.pos").alias("close_pos"),
        F.col("depth").alias("open_depth"), F.col("_next.d").alias("close_depth"),
        F.when(~opens, "UNMATCHED").when(F.col("_next").isNull(), "UNCLOSED").otherwise("PAIRED").alias("state"),
    )
    return d


def structure_errors(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``key, off, tag, code``: unclosed, unmatched, and pairs whose content is not balanced."""
    p = pair_tags(lexemes, key)
    code = (
        F.when(F.col("state") == "UNCLOSED", "unclosed_element")
        .when(F.col("state") == "UNMATCHED", "unmatched_end_tag")
        .when(F.col("open_depth") != F.col("close_depth"), "mismatched_nesting")
    )
    return p.select(*key, F.col("start").alias("off"), "tag", code.alias("code")).where(F.col("code").isNotNull())


def previous_lexeme(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Each lexeme with the last one before it that is not white space: the owner of what follows."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    solid = F.when(~F.col("run").rlike(f"^[{fx.t.SPACE}]*\\z"), F.col("pos"))
    return lexemes.withColumn("owner_pos", F.last(solid, ignorenulls=True).over(w))


def bind_arguments(lexemes: DataFrame, policy: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The k-th attribute of a tag takes that tag's k-th role; an unlisted one is held as ambiguous."""
    attrs = F.regexp_extract_all("run", F.lit(r'[A-Za-z-]+="[^"]*"'), F.lit(0))
    a = lexemes.where("kind = 'tag'").select(*key, "off", "tag", F.posexplode(attrs).alias("_k", "argument"))
    a = a.withColumn("arg_no", F.col("_k") + 1).drop("_k")
    p = policy.select("tag", "arg_no", F.col("role").alias("_role"))
    return a.join(p, ["tag", "arg_no"], "left").select(
        *key, "off", "tag", "arg_no", "argument", F.coalesce("_role", F.lit("ambiguous_command_arg")).alias("role")
    )


def unknown_commands(lexemes: DataFrame, known: DataFrame) -> DataFrame:
    """Census of tag names that the policy does not list."""
    tags = lexemes.where("kind = 'tag' AND tag <> ''").groupBy("tag").agg(F.count("*").alias("n"))
    return tags.join(known.select("tag"), "tag", "left_anti")


def _base_role(kind: Column, default: str) -> Column:
    return (
        F.when(kind == "comment", "protected_comment").when(kind.isin("script", "style"), "protected_code")
        .when(kind == "tag", "protected_structure").otherwise(default)
    )


def role_spans(lexemes: DataFrame, roles: Roles, key: Sequence[str] = KEY) -> DataFrame:
    """Content spans of the elements that carry a role."""
    p = pair_tags(lexemes, key).where((F.col("state") == "PAIRED") & F.col("tag").isin(*roles))
    role = F.lit(None).cast("string")
    for tag, value in roles.items():
        role = F.when(F.col("tag") == tag, value).otherwise(role)
    return p.where("inner_start < inner_end").select(
        *key, F.col("inner_start").alias("start"), F.col("inner_end").alias("end"), role.alias("paint"), "tag"
    )


def paint_roles(lexemes: DataFrame, roles: Roles, key: Sequence[str] = KEY, default: str = "visible_prose") -> DataFrame:
    """Lexemes with ``start, end, role, detail, under``: text takes the role of the innermost span that covers it.

    ``under`` tells whether any covering span is a protected one, so visible text inside a protected context shows.
    """
    runs = lexemes.select(
        *key, F.col("off").alias("start"), (F.col("off") + F.length("run")).alias("end"), "run", "kind", "tag"
    )
    painted = role_spans(lexemes, roles, key).withColumnRenamed("tag", "_by")
    text = runs.where("kind = 'text'").select(*key, "start", "end")
    hit = spans.overlaps(text, painted, key, ["paint", "_by"])
    hit = hit.where((F.col("r_start") <= F.col("start")) & (F.col("end") <= F.col("r_end")))
    inner = hit.groupBy(*key, "start").agg(
        F.max_by(F.struct("paint", "_by"), "r_start").alias("_in"),
        F.bool_or(F.startswith("paint", F.lit("protected"))).alias("_under"),
    )
    j = runs.join(inner, [*key, "start"], "left")
    return j.select(
        *key, "start", "end", "run", "kind",
        F.coalesce("_in.paint", _base_role(F.col("kind"), default)).alias("role"),
        F.coalesce("_in._by", F.when(F.col("kind") == "tag", F.col("tag")), F.col("kind")).alias("detail"),
        F.coalesce("_under", F.lit(False)).alias("under"),
    )


def segments(painted: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Gap-free segments; adjacent equals are joined."""
    return spans.coalesce_segments(painted.select(*key, "start", "end", "role", "detail"), key)


def lexeme_counters(lexemes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Comments, controls, raw blocks and completed pairs per text, in one pass and one pairing."""
    kinds = lexemes.groupBy(*key).agg(
        F.count_if(F.col("kind") == "comment").alias("comments"), F.count_if(F.col("kind") == "tag").alias("controls"),
        F.count_if(F.col("kind").isin("script", "style")).alias("raw_blocks"), F.count_if(F.col("kind") == "text").alias("texts"),
    )
    pairs = pair_tags(lexemes, key).where("state = 'PAIRED'").groupBy(*key).agg(F.count("*").alias("pairs"))
    return kinds.join(pairs, list(key), "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))


def protected_stream(painted: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per text: bytes and SHA-256 of everything protected, in source order."""
    d = painted.where(~F.col("role").isin(*fx.t.VISIBLE_ROLES))
    d = d.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "run"))).alias("_p"))
    stream = F.array_join("_p.run", "")
    return d.select(*key, *fx.identity(stream))


def role_census(segs: DataFrame) -> DataFrame:
    """Segments and characters per role."""
    return segs.groupBy("role").agg(F.count("*").alias("segments"), F.sum(F.col("end") - F.col("start")).alias("scalars"))


def style_payloads(pages: DataFrame, lexemes: DataFrame, tags: Sequence[str], key: Sequence[str] = KEY, html: str = "html") -> DataFrame:
    """Content of emphasis elements: ``key, start, end, tag, surface``."""
    p = pair_tags(lexemes, key).where((F.col("state") == "PAIRED") & F.col("tag").isin(*tags))
    ranges = p.select(*key, F.col("inner_start").alias("start"), F.col("inner_end").alias("end"), "tag")
    return spans.surfaces(pages, ranges, key, html, ["tag"])
