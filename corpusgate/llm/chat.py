"""Chat formatting with typed content parts.

``flatten_parts`` is the visitor: it walks the parts of one turn in order and writes text as it is (escaped) and every
image, audio or document part as a numbered placeholder, recording the attachment and the tokens it will expand to.
``format_turns`` wraps each turn in marks; ``read_back`` undoes it.

Template of a turn: ``### <role>: <body> </turn>\\n``.  A backslash goes before every backslash, ``###``, ``</turn>``
and ``<|`` of a text (and before ``:`` of a role), so that no text can open or close a turn or fake a placeholder, and
removing one backslash before each of these restores it.

Order is by turn, then role, then body; null roles and texts are empty, null turns come first, and rows with a null
conversation form one conversation of their own.  Repeated rows stay.  Formatting happens before the only shuffle; a conversation
is then streamed turn by turn, so that even one with a third of all rows needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, PLACE = "###", "</turn>", "<|"
ESCAPES = r"(\\|###|</turn>|<\|)"
ROLE_ESCAPES = r"(\\|###|</turn>|<\||:)"
UNESCAPE = re.compile(r"\\(\\|###|</turn>|<\||:)")
END = f" {CLOSE}\n"

PART_TYPE = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column, pattern: str = ESCAPES) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), pattern, r"\\$1")


def expanded_tokens(part: Column, *, tile: int = 512, per_tile: int = 170, per_second: int = 25, per_page: int = 600) -> Column:
    """Tokens that an attachment stands for: image tiles, audio frames or document pages; one at least."""

    def count(c):
        return F.greatest(F.coalesce(c, F.lit(0)), F.lit(1)).cast("long")

    tiles = count(F.ceil(part["width"] / F.lit(tile))) * count(F.ceil(part["height"] / F.lit(tile)))
    return (
        F.when(part["type"] == "image", tiles * per_tile)
        .when(part["type"] == "audio", count(F.ceil(part["seconds"] * F.lit(per_second))))
        .when(part["type"] == "document", count(part["pages"]) * per_page)
        .otherwise(F.lit(0).cast("long"))
    )


def flatten_parts(parts: Column) -> Column:
    """One turn's parts as ``struct<body, attachments: array<struct<slot, type, uri, tokens>>, expanded_tokens>``.

    Slots count the attachments of the turn from 1, in order.  A part of an unknown type is kept as text; null parts
    are skipped.
    """
    media = ("image", "audio", "document")
    start = F.struct(
        F.lit("").alias("body"),
        F.array().cast("array<struct<slot:int,type:string,uri:string,tokens:bigint>>").alias("attachments"),
        F.lit(0).cast("long").alias("expanded_tokens"),
    )

    def visit(acc, part):
        slot = F.size(acc["attachments"]) + 1
        tokens = expanded_tokens(part)
        is_media = F.coalesce(part["type"].isin(*media), F.lit(False))
        mark = F.concat(F.lit(PLACE), part["type"], F.lit(" "), slot.cast("string"), F.lit("|>"))
        record = F.struct(slot.alias("slot"), part["type"].alias("type"), part["uri"].alias("uri"), tokens.alias("tokens"))
        return F.struct(
            F.concat(acc["body"], F.when(is_media, mark).otherwise(escape(part["text"]))).alias("body"),
            F.when(is_media, F.concat(acc["attachments"], F.array(record))).otherwise(acc["attachments"]).alias("attachments"),
            (acc["expanded_tokens"] + F.when(is_media, tokens).otherwise(0)).alias("expanded_tokens"),
        )

    return F.aggregate(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")), lambda p: p.isNotNull()), start, visit)


def text_part(text: Column) -> Column:
    """A plain text as the one part of its turn."""
    none = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in none.items())))


def format_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """``conv_id, turn, formatted, attachments, expanded_tokens``: a conversation's text is its rows joined in order."""
    flat = turns.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), flatten_parts(F.col(parts)).alias("flat"),
    )
    formatted = F.concat(F.lit(OPEN + " "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "), F.col("flat.body"), F.lit(END))
    return flat.select("conv_id", "turn", formatted.alias("formatted"), "flat.attachments", "flat.expanded_tokens")


def parse_turns(formatted: str):
    """``(role, text)`` of each turn of a formatted text; placeholders stay as they are."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN + " ", at):
            raise ValueError(f"no turn starts at {at}")
        colon = at + len(OPEN) + 1
        while formatted[colon] != ":":
            colon += 2 if formatted[colon] == "\\" else 1
        end = formatted.index(END, colon)
        yield UNESCAPE.sub(r"\1", formatted[at + len(OPEN) + 1 : colon]), UNESCAPE.sub(r"\1", formatted[colon + 2 : end])
        at = end + len(END)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation, read from the formatted text: turns, loss mask (the texts of ``loss_role``) and sizes."""

    def digest(batches):
        conv, state = None, None

        def row(c, s):
            turns, turn_sha, chars, loss_sha, size = s
            return c, turns, turn_sha.hexdigest(), chars, loss_sha.hexdigest(), size

        def table(rows):
            columns = zip(*rows, strict=True)
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for b in batches:
            done = []
            for c, text in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        done.append(row(conv, state))
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(text)
                for role, body in parse_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                    if role == loss_role:
                        state[2] += len(body)
                        state[3].update(body.encode())
            if done:
                yield table(done)
        if state is not None:
            yield table([row(conv, state)])

    ordered = formatted.select("conv_id", "turn", "formatted").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "formatted").mapInArrow(digest, DIGESTS)
