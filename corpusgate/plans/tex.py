"""The TeX job: lex, validate, bind arguments once, paint and project."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import tex
from .projection import materialise

KEY = ("doc_id",)


@dataclass(frozen=True)
class TexProjection:
    output: DataFrame
    segments: DataFrame
    errors: DataFrame
    unknown: DataFrame


def project_tex_corpus(docs: DataFrame, policy: DataFrame, key: Sequence[str] = KEY, text: str = "text") -> TexProjection:
    """Structurally sound documents projected; the others only reported.

    Delimiters, arguments and the marks of each text have several readers and hold no text, so each is written once to the scratch folder.
    Texts are lexed twice, for their delimiters and where they are painted, instead of being stored.
    """
    marks = materialise(tex.delimiters(tex.lex_tex(docs, key, text), key))
    errors = materialise(tex.structure_errors(docs, key, text, marks))
    broken = errors.select(*key).distinct()
    spans, args = tex.role_spans(marks.join(broken, list(key), "left_anti"), policy, key)
    args = materialise(args)
    by_text = materialise(tex.marks_by_text(spans, args, key))
    sound = docs.select(*key, text).join(broken, list(key), "left_anti").join(by_text, list(key), "left")
    lexed = tex.lex_tex(sound, key, text, keep=["_marks"])
    painted = tex.paint_marked(lexed, key)
    return TexProjection(tex.project_painted(painted, key, text), tex.text_segments(painted, key), errors, tex.unknown_arguments(args, key))
