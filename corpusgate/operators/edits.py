"""Edits: token maps, locator maps, prefix rules and the gates that prove them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables as t
from ..functions import text as fx
from ..functions.arrays import line_starts, looked_up, reached_before, slices_of, starts_of
from . import spans
from .lines import line_table
from .projection import replace_spans
from .tokens import words

KEY = ("doc_id",)


def _as_map(mapping: Mapping[str, str]):
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def substitute_tokens(docs: DataFrame, mapping: Mapping[str, str] | DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Replace whole words by an exact, case-sensitive map.

    A map written by hand is applied inside the row, however long.  One that is data comes as a table ``old, new``: each text asks
    for its distinct words only, so a word that makes up most of a text is one row of it, and a map that is measured to be
    small needs no shuffle of them; what is found travels back to the text once, and its words are replaced in the row.
    """
    if isinstance(mapping, DataFrame):
        one = mapping.groupBy("old").agg(F.min("new").alias("new"))
        runs = F.regexp_extract_all(F.col(text), F.lit(t.LETTER_RUN), F.lit(0))
        asked = docs.select(*key, F.explode(F.array_distinct(runs)).alias("old"))
        found = asked.join(one, "old").groupBy(*key).agg(F.collect_set(F.struct("old", "new")).alias("_m"))
        d = docs.select(*key, text).join(found, list(key), "left")
        every = F.regexp_extract_all(F.col(text), F.lit(t.ANY_RUN), F.lit(0))
        return d.select(*key, F.array_join(looked_up(every, F.col("_m.old"), F.col("_m.new")), "").alias(text))
    if not mapping:
        return docs.select(*key, text)
    table = _as_map(mapping)
    keys = list(mapping)
    out = fx.rewrite_words(F.col(text), lambda r: F.element_at(table, r), allowed=lambda r: r.isin(keys))
    return docs.select(*key, out.alias(text))


def substitution_gate(before: DataFrame, after: DataFrame, mapping: Mapping[str, str], text: str = "text") -> DataFrame:
    """Per target: its sources' count falls to zero and its own rises by exactly that much."""
    surfaces = sorted({*mapping, *mapping.values()})

    def census(d: DataFrame, name: str) -> DataFrame:
        return words(d, [], text).where(F.col("word").isin(surfaces)).groupBy("word").agg(F.count("*").alias(name))

    j = census(before, "b").join(census(after, "a"), "word", "full_outer")
    j = j.select("word", F.coalesce("b", F.lit(0)).alias("b"), F.coalesce("a", F.lit(0)).alias("a"))
    roles = F.array_compact(F.array(
        F.when(F.col("word").isin(list(mapping)), F.struct(F.element_at(_as_map(mapping), F.col("word")).alias("target"), F.lit("source").alias("role"))),
        F.when(F.col("word").isin(list(mapping.values())), F.struct(F.col("word").alias("target"), F.lit("target").alias("role"))),
    ))
    long = j.select("b", "a", F.inline(roles))

    def total(col: str, role: str):
        return F.sum(F.when(F.col("role") == role, F.col(col)).otherwise(0))

    d = long.groupBy("target").agg(
        total("b", "source").alias("source_before"), total("a", "source").alias("source_after"),
        total("b", "target").alias("target_before"), total("a", "target").alias("target_after"),
    )
    rise = F.col("target_after") - F.col("target_before")
    return d.withColumn("pass", (F.col("source_after") == 0) & (rise == F.col("source_before")))


def structure_gate(before: DataFrame, after: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Per document: what is not a letter is unchanged, and so is the number of lines."""
    def side(d: DataFrame, p: str) -> DataFrame:
        n = F.length(F.regexp_replace(text, f"[^{t.BREAK}]+", ""))
        return d.select(*key, fx.nonletter_signature(F.col(text)).alias(f"{p}_sig"), n.alias(f"{p}_breaks"))

    j = side(before, "b").join(side(after, "a"), list(key), "full_outer")
    same = (F.col("b_sig") == F.col("a_sig")) & (F.col("b_breaks") == F.col("a_breaks"))
    return j.select(*key, F.coalesce(same, F.lit(False)).alias("pass"))


_EDITS = "array<struct<start:bigint,end:bigint,line_no:bigint,col_no:bigint,old:string,new:string,state:string>>"


def edit_sets(docs: DataFrame, edits: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """``key, text, edits, given``: every document with its locator edits ``line_no, col_no, old, new`` as one ordered value.

    Each edit has its scalar span and ``state``: APPLIES, or why it is refused: NO_LINE, DRIFT (the line holds something else
    there), DUPLICATE (the locator is edited twice) or OVERLAP (an earlier edit reaches into it).  Texts meet their edits
    once; lines are measured in the row.  ``given`` is false for edits of a document that is not there.
    """
    one = edits.groupBy(*key, F.col("line_no").cast("bigint").alias("line_no"), F.col("col_no").cast("bigint").alias("col_no")).agg(
        F.count("*").alias("n"), F.min("old").alias("old"), F.min("new").alias("new"))
    per = one.groupBy(*key).agg(F.collect_list(F.struct("line_no", "col_no", "n", "old", "new")).alias("_e"))
    d = docs.select(*key, F.col(text).alias("_text"), F.lit(True).alias("_given")).join(per, list(key), "full_outer")
    d = d.withColumn("_e", F.coalesce("_e", F.array().cast("array<struct<line_no:bigint,col_no:bigint,n:bigint,old:string,new:string>>")))
    sizes = F.transform(F.regexp_extract_all("_text", F.lit(t.PHYSICAL_LINE), F.lit(0)), lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("b")))
    d = d.withColumns({"_starts": line_starts(sizes), "_size": F.length("_text").cast("bigint")})

    def begin(line: Column) -> Column:
        return F.when(line >= 1, F.get("_starts", (line - 1).cast("int"))["at"])

    def low(e: Column) -> Column:
        return begin(e["line_no"]) + e["col_no"] - 1

    here = slices_of("_text", F.transform("_e", low), F.transform("_e", lambda e: low(e) + F.length(e["old"])))
    d = d.withColumn("_here", here)

    def judged(e: Column, i: Column) -> Column:
        start, end = low(e), low(e) + F.length(e["old"])
        # What stands there lies in one line if it holds no break and ends with the line at the latest.
        line = (e["col_no"] >= 1) & (end <= F.coalesce(begin(e["line_no"] + 1), F.col("_size"))) & ~e["old"].rlike(f"[{t.BREAK}]")
        state = F.when(start.isNull(), "NO_LINE").when(e["n"] > 1, "DUPLICATE").when(~(line & (F.get("_here", i) == e["old"])), "DRIFT").otherwise("APPLIES")
        fields = {"start": start, "end": end, "line_no": e["line_no"], "col_no": e["col_no"], "old": e["old"], "new": e["new"], "state": state}
        return F.struct(*(v.alias(k) for k, v in fields.items()))

    d = d.select(*key, "_text", "_given", F.array_sort(F.transform("_e", judged)).alias("_r"))
    d = d.withColumn("_reach", reached_before(F.transform("_r", lambda r: F.when(r["state"] == "APPLIES", r["end"]).otherwise(0).cast("bigint"))))
    late = F.zip_with("_r", "_reach", lambda r, reach: r.withField("state", F.when((r["state"] == "APPLIES") & (reach > r["start"]), "OVERLAP").otherwise(r["state"])))
    return d.select(*key, F.col("_text").alias(text), late.cast(_EDITS).alias("edits"), F.coalesce("_given", F.lit(False)).alias("given"))


def _applied() -> Column:
    return F.filter("edits", lambda e: e["state"] == "APPLIES")


def _with_gaps(sets: DataFrame, text: str) -> tuple[DataFrame, Column]:
    """The documents with the stretches between their edits, and the expression of the edited text."""
    zero, size = F.array(F.lit(0).cast("bigint")), F.array(F.length(text).cast("bigint"))
    ends, starts = F.transform(_applied(), lambda e: e["end"]), F.transform(_applied(), lambda e: e["start"])
    d = sets.where("given").withColumn("_gaps", slices_of(text, F.concat(zero, ends), F.concat(starts, size)))
    parts = F.transform(_applied(), lambda e, i: F.concat(e["new"], F.get("_gaps", i + 1)))
    return d, F.when(F.col(text).isNotNull(), F.concat(F.get("_gaps", F.lit(0)), F.array_join(parts, "")))


def apply_sets(sets: DataFrame, key: Sequence[str] = KEY, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``key, text`` (and ``keep``) of the documents with every applicable edit made; refused edits leave their place untouched."""
    d, after = _with_gaps(sets, text)
    return d.select(*key, after.alias(text), *keep)


def invert_sets(sets: DataFrame, key: Sequence[str] = KEY, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The edited documents with the edits that undo what was done: spans moved by what stands before them, old and new swapped."""
    d, after = _with_gaps(sets, text)
    d = d.withColumn("_shift", starts_of(F.transform(_applied(), lambda e: (F.length(e["new"]) - (e["end"] - e["start"])).cast("bigint"))))

    def turned(e: Column, i: Column) -> Column:
        at = e["start"] + F.get("_shift", i)
        fields = {"start": at, "end": at + F.length(e["new"]), "line_no": e["line_no"], "col_no": e["col_no"], "old": e["new"], "new": e["old"], "state": F.lit("APPLIES")}
        return F.struct(*(v.alias(k) for k, v in fields.items()))

    return d.select(*key, after.alias(text), F.transform(_applied(), turned).cast(_EDITS).alias("edits"), "given", *keep)


def resolve_locators(docs: DataFrame, edits: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Locator edits ``key, line_no, col_no, old, new`` as rows with span and ``state``, as in :func:`edit_sets`."""
    d = edit_sets(docs, edits, key, text).select(*key, F.inline("edits"))
    return d.select(*key, "line_no", "col_no", "start", "end", "old", "new", "state")


def apply_locator_edits(docs: DataFrame, resolved: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Documents with every applicable edit made; refused edits leave their place untouched."""
    return replace_spans(docs, resolved.where("state = 'APPLIES'"), key, text)


def declared_counts_gate(resolved: DataFrame, declared: DataFrame) -> DataFrame:
    """One source may go to several targets; each pair's applied count must equal the declared one."""
    done = resolved.where("state = 'APPLIES'").groupBy("old", "new").agg(F.count("*").alias("applied"))
    j = done.join(declared.select("old", "new", F.col("n").alias("declared")), ["old", "new"], "full_outer")
    j = j.withColumns({"applied": F.coalesce("applied", F.lit(0)), "declared": F.coalesce("declared", F.lit(0))})
    return j.withColumn("pass", F.col("applied") == F.col("declared"))


def rewrite_prefixes(docs: DataFrame, rules: Sequence[tuple[str, str]], key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Replace a word-initial prefix and keep every suffix byte for byte; the longest prefix is tried first."""
    out = F.col(text)
    for old, new in sorted(rules, key=lambda r: -len(r[0])):
        out = F.regexp_replace(out, rf"(?<![{t.LETTER}])\Q{old}\E", new.replace("\\", "\\\\").replace("$", "\\$"))
    return docs.select(*key, out.alias(text))


def mirror_check(units: DataFrame, cumulative: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> DataFrame:
    """Does each unit ``key, unit_no, line_from, line_to, body`` equal its lines inside the cumulative text?"""
    table = line_table(cumulative, key, text).select(*key, "line_no", "physical")
    ranges = units.select(
        *key, F.col("line_from").alias("start"), (F.col("line_to") + 1).alias("end"), "unit_no"
    )
    inside = spans.locate(table, ranges, key, ["unit_no"], at="line_no", how="inner")
    section = inside.groupBy(*key, "unit_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "physical"))).alias("_l"))
    section = section.select(*key, "unit_no", fx.sha256_upper(F.array_join("_l.physical", "")).alias("section_sha256"))
    mine = units.select(*key, "unit_no", fx.sha256_upper(F.col("body")).alias("unit_sha256"))
    state = (
        F.when(F.col("section_sha256").isNull(), "MISSING")
        .when(F.col("section_sha256") == F.col("unit_sha256"), "MIRRORED")
        .otherwise("DIFFERS")
    )
    return mine.join(section, [*key, "unit_no"], "left").select(*key, "unit_no", state.alias("state"))
