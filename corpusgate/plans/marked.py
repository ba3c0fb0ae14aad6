"""The projection job on marked-up text: one stored piece table, and every proof read from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..operators import gates, inventory, markup, matches, pieces, projection, spans
from ..operators.tokens import tokenise
from ..session import stored_by_text
from ..sources import sinks

KEY = ("page_id",)


@dataclass(frozen=True)
class MarkedProjection:
    """The stored pieces, the output and the held spans, all of one pass over the texts."""

    table: DataFrame
    output: DataFrame
    trace: DataFrame


def project_marked(
    pages: DataFrame, roles: markup.Roles, reviewed: DataFrame | None = None, key: Sequence[str] = KEY, html: str = "html", **how,
) -> MarkedProjection:
    """Project the visible words of marked-up texts; ``how`` goes to ``pieces.piece_table``."""
    table = stored_by_text(pieces.piece_table(pages, roles, reviewed, key=key, html=html, **how))
    return MarkedProjection(table, pieces.output_of(table, key, html), pieces.held_trace(table, key))


def second_derivation(
    pages: DataFrame, roles: markup.Roles, reviewed: DataFrame | None = None, key: Sequence[str] = KEY, html: str = "html", *,
    letters: Sequence[str] = ("I", "V", "M"), rules: Sequence[inventory.NeighbourRule] = (),
) -> DataFrame:
    """The output once more and by other means: each visible stretch is a document, its spans are found one kind at a time and
    merged, and words are cut at span edges by a join."""
    painted = pieces.paint_pages(pages, roles, key, html)
    painted = stored_by_text(painted.select(*key, "start", "run", "kind", "role"))
    shown = painted.where((F.col("kind") == "text") & F.col("role").isin(*t.VISIBLE_ROLES))
    part = [*key, "_from"]
    docs = stored_by_text(shown.select(*key, F.col("start").alias("_from"), F.col("run").alias("text")))
    names = matches.name_spans(docs, part, *matches.NAME_SUBTYPES[0]).select(*part, "start", "end")
    literal = rf"(?<!\p{{L}}){pieces.LITERAL}(?!\p{{L}})"
    cut = docs.select(*part, F.regexp_extract_all("text", F.lit(rf"{literal}|[^qQ]+|(?s:.)"), F.lit(0)).alias("r"))
    cut = cut.select(*part, F.posexplode(F.arrays_zip("r", pieces.starts_of(F.transform("r", lambda r: F.length(r))).alias("at"))).alias("_", "z"))
    literals = cut.where(F.col("z.r").isin(*t.IDENTITY_LITERALS)).select(
        *part, F.col("z.at").alias("start"), (F.col("z.at") + F.length("z.r")).alias("end"))
    covered = names.unionByName(literals)
    lone = inventory.one_letter_inventory(docs, covered, rules, letters=letters, key=part)
    lone = lone.where(F.startswith("disposition", F.lit("PRESERVE"))).select(*part, F.col("off").alias("start"), "end")
    blocked = tokenise(docs, part).where(F.col("is_word") & ~fx.is_projectable(F.col("run"))).select(
        *part, F.col("off").alias("start"), (F.col("off") + F.length("run")).alias("end"))
    ranges = covered.unionByName(lone).unionByName(blocked).unionByName(matches.unit_spans(docs, part).select(*part, "start", "end"))
    if reviewed is not None:
        whole = docs.select(*key, "_from", F.col("_from").alias("start"), (F.col("_from") + F.length("text")).alias("end"))
        hit = spans.overlaps(whole, reviewed, key)
        ranges = ranges.unionByName(hit.select(
            *part, (F.greatest("start", "r_start") - F.col("_from")).alias("start"), (F.least("end", "r_end") - F.col("_from")).alias("end")))
    out = projection.project_by_tokens(docs, spans.merge_ranges(ranges, part), part)
    j = painted.join(out.select(*key, F.col("_from").alias("start"), F.col("text").alias("_new")), [*key, "start"], "left")
    piece = F.struct("start", F.coalesce("_new", "run").alias("out"))
    return j.groupBy(*key).agg(F.array_sort(F.collect_list(piece)).alias("_p")).select(*key, F.array_join("_p.out", "").alias(html))


def latin_left(output: DataFrame, trace: DataFrame, roles: markup.Roles, key: Sequence[str] = KEY, html: str = "html") -> DataFrame:
    """Visible words of the output that hold a Latin letter, with ``covered``: inside a held span of the output or not.

    The output is lexed and painted anew, so text that the projection never saw is found as well.
    """
    painted = pieces.paint_pages(output, roles, key, html).where((F.col("kind") == "text") & F.col("role").isin(*t.VISIBLE_ROLES))
    words = tokenise(painted.select(*key, "start", "run"), [*key, "start"], "run").where(F.col("is_word") & F.col("run").rlike(r"\p{IsLatin}"))
    words = words.select(*key, (F.col("start") + F.col("off")).alias("off"), (F.col("start") + F.col("off") + F.length("run")).alias("stop"), F.col("run").alias("word"))
    held = spans.merge_ranges(trace.select(*key, F.col("out_start").alias("start"), F.col("out_end").alias("end")), key)
    return spans.flag_covered(words, held, key, start="off", end="stop")


def gate_rows(
    pages: DataFrame, done: MarkedProjection, again: DataFrame, roles: markup.Roles, key: Sequence[str] = KEY, html: str = "html",
) -> DataFrame:
    """``code, failures, pass`` for each proof on its own: two derivations agree, the input is rebuilt from the pieces of the very
    output, no Latin word is left without a held span, units are as many as before, and no unit was projected."""
    out, src = done.output, pages.select(*key, F.coalesce(F.col(html), F.lit("")).alias(html))
    intact = out.select(*key, fx.sha256_upper(F.col(html)).alias("_seen")).join(
        done.table.select(*key, fx.sha256_upper(F.array_join("pieces.out", "")).alias("_told"), F.array_join("pieces.run", "").alias("_back")), list(key), "full_outer")
    back = intact.select(*key, F.when(F.col("_seen") == F.col("_told"), F.col("_back")).alias(html))
    units = gates.census_gate(projection.unit_census(out, key, html), projection.unit_census(src, key, html), [*key, "unit"])
    checks = {
        "two_derivations_agree": projection.derivations_agree(out, again, key, html),
        "inverse_replay": projection.derivations_agree(src, back, key, html),
        "no_unprotected_latin": latin_left(out, done.trace, roles, key, html).withColumnRenamed("covered", "pass"),
        "units_survive": units,
        "no_projected_unit": out.select(*key, (~fx.has_projected_units(F.col(html))).alias("pass")),
    }
    rows = None
    for code, d in checks.items():
        one = d.agg(F.count_if(~F.col("pass")).alias("failures")).select(F.lit(code).alias("code"), "failures", (F.col("failures") == 0).alias("pass"))
        rows = one if rows is None else rows.unionByName(one)
    return stored_by_text(rows)


def publish(pages: DataFrame, done: MarkedProjection, again: DataFrame, roles: markup.Roles, path: str, key: Sequence[str] = KEY, html: str = "html") -> str:
    """Write the output once, and only if every gate passes."""
    return sinks.publish_if_passed(done.output, gate_rows(pages, done, again, roles, key, html), path)
