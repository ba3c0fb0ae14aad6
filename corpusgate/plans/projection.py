"""The projection job: protect, project, and prove the result before anything is published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates, projection
from ..session import stored, stored_by_text
from ..sources import sinks

KEY = ("doc_id",)


materialise = stored


@dataclass(frozen=True)
class Projection:
    """One stored row a text, from which output, trace, spans and every proof are read: ``key, _source, _spans, text, _t``."""

    table: DataFrame
    key: Sequence[str] = KEY

    @property
    def protected(self) -> DataFrame:
        return self.table.select(*self.key, F.inline("_spans"))

    @property
    def output(self) -> DataFrame:
        return self.table.select(*self.key, "text")

    @property
    def trace(self) -> DataFrame:
        return self.table.select(*self.key, F.inline("_t"))


def projection_of(cut: DataFrame, key: Sequence[str] = KEY, *, words: bool = False) -> Projection:
    """The projection of texts cut at their protected spans, made once and kept."""
    told = projection.told_texts(cut, key, keep=[F.col("text").alias("_source"), "_spans"], words=words)
    return Projection(stored_by_text(told), key)


def project_corpus(
    docs: DataFrame, inventory: DataFrame, identities: DataFrame, key: Sequence[str] = KEY, *, units: bool = True
) -> Projection:
    """Protected spans are computed once and kept; output and trace are read from one cut at them."""
    held = materialise(projection.protected_spans(docs, inventory, identities, key, units=units))
    return projection_of(projection.cut_at_spans(docs, held, key), key, words=True)


def projection_gates(docs: DataFrame, done: Projection, key: Sequence[str] = KEY) -> DataFrame:
    """``code, failures, pass`` of every proof: agreement of two derivations, inverse replay, residue, units.

    Each reads the stored texts in place; only hashes and unit counts are shuffled.
    """
    told, out = done.table, done.output
    again = projection.project_by_tokens(told.select(*key, F.col("_source").alias("text"), "_spans"), key=key)
    back = projection.replay_told(told.select(*key, "text", "_t"), key)
    residue = projection.latin_residuals_told(told, key).withColumnRenamed("covered", "pass")
    units = gates.census_gate(projection.unit_census(out, key), projection.unit_census(docs, key), [*key, "unit"])
    rows = {
        "two_derivations_agree": projection.derivations_agree(out, again, key),
        "inverse_replay": projection.derivations_agree(docs, back, key),
        "no_unprotected_latin": residue,
        "units_survive": units,
    }
    out = None
    for code, d in rows.items():
        g = d.agg(F.count_if(~F.col("pass")).alias("failures")).select(
            F.lit(code).alias("code"), "failures", (F.col("failures") == 0).alias("pass")
        )
        out = g if out is None else out.unionByName(g)
    return stored_by_text(out)


def publish(docs: DataFrame, done: Projection, path: str, key: Sequence[str] = KEY) -> str:
    """Write the output once, and only if every gate passes."""
    return sinks.publish_if_passed(done.output, projection_gates(docs, done, key), path)
