"""Registry, table access and the SQL fragments the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.functions import tables as t
from corpusgate.sources.scan import read_corpus

#: Session setting of the bench: how many partitions one small text file is dealt to.  Unset, scans stay as they are.
SCAN_PARTITIONS = "corpusgate.scan.partitions"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Words of the test languages that announce a numbered label; a star ends a stem.
ANNOUNCING = ("chapter", "part", "volume*", "Kapitel", "Abschnitt*", "capítulo", "tomo", "chapitre", "partie*")

TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    wanted = spark.conf.get(SCAN_PARTITIONS, None) if name in TEXT_TABLES else None
    return read_corpus(spark, f"{sf_dir}/{name}.parquet", partitions=wanted and int(wanted))


# A second form of each text, made from its key, that holds what the tables lack: numerals, names, units, labels,
# etymological letters, foreign script and literals.  The same expression runs in both engines.
VARIANT = """CASE doc_id % 6
 WHEN 0 THEN concat(text, ' Kapitel V in volumes I. Cena 12pt, tom XII, 3true em ili 7EM, I-II. ')
 WHEN 1 THEN concat('Đak ľjubi DŽep dŽ Ľjerka nJ ', text, ' A. B. Novak von Berg i C. Kraus-Meyer. V ') 
 WHEN 2 THEN concat(text, ' слово mešaнo q. e. d. V. I) teorem X (I) M. Karl Weber')
 WHEN 3 THEN concat('V ', text, ' vidi IX. Stopnja \u212a, VI, 5 pt ne 5pt; ſtara A. Novak, tomo I ')
 WHEN 4 THEN text
 ELSE concat(text, ' przęd śẃiat II X, 9em5 I', chr(92), ';-V tu I;-V ')
END"""

# A later edition of each text, for everything that compares versions.
LATER = """CASE doc_id % 4
 WHEN 0 THEN replace(replace(text, ' de ', ' des '), ' the ', ' q ')
 WHEN 1 THEN concat(text, '\nnova crta')
 WHEN 2 THEN replace(text, ' der ', ' die ')
 ELSE text
END"""


def as_sql(text: str) -> Column:
    """An expression of both engines; the SQL's ``concat`` passes over nulls, as ``concat_ws`` does."""
    return F.expr(text.replace("concat(", "concat_ws('', "))


def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts that have a run at all; SQL that gathers a text from its runs has no row for an empty or null one."""
    return df.where(F.length(text) > 0)


def variant_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", as_sql(VARIANT).alias("text"))


def later_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", as_sql(LATER).alias("text"))


# ---- oracle fragments -------------------------------------------------------------------------------------------

L = t.LETTER
V_DOCS = f"(SELECT doc_id, lang, {VARIANT} AS text FROM documents)"
LATER_DOCS = f"(SELECT doc_id, lang, {LATER} AS text FROM documents)"
TEX_SPACE_RE2 = t.TEX_SPACE


def runs_sql(src: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return f"""(SELECT {key}, pos - 1 AS pos, run,
      (sum(length(run)) OVER (PARTITION BY {key} ORDER BY pos) - length(run))::BIGINT AS off,
      regexp_matches(run, '^[{L}]') AS is_word
    FROM (SELECT {key}, unnest(r) AS run, generate_subscripts(r, 1) AS pos
          FROM (SELECT {key}, regexp_extract_all({text}, '[{L}]+|[^{L}]+') AS r FROM {src})))"""


def words_sql(src: str = "documents", keep: str = "doc_id", text: str = "text") -> str:
    return f"(SELECT {keep}, unnest(regexp_extract_all({text}, '[{L}]+')) AS word FROM {src})"


def roman_sql(w: str) -> str:
    return f"(length({w}) >= 2 AND regexp_full_match({w}, '{t.ROMAN}'))"


def unmapped_sql(w: str) -> str:
    return f"regexp_matches({w}, '[^{t.SUPPORTED}\\p{{Cyrillic}}]')"


def script_sql(w: str) -> str:
    return f"regexp_matches({w}, '\\p{{Cyrillic}}')"


def blocked_sql(w: str) -> str:
    return f"({roman_sql(w)} OR {unmapped_sql(w)} OR {script_sql(w)})"


def reasons_sql(w: str) -> str:
    return (
        f"concat_ws(',', CASE WHEN {roman_sql(w)} THEN '{t.REASON_ROMAN}' END, "
        f"CASE WHEN {unmapped_sql(w)} THEN '{t.REASON_UNMAPPED}' END, "
        f"CASE WHEN {script_sql(w)} THEN '{t.REASON_SCRIPT}' END)"
    )


def simplify_sql(w: str) -> str:
    keys, values = "".join(t.ONE_TO_ONE_REDUCTIONS), "".join(t.ONE_TO_ONE_REDUCTIONS.values())
    return f"replace(replace(translate({w}, '{keys}', '{values}'), 'đ', 'dž'), 'Đ', 'DŽ')"


def project_sql(w: str) -> str:
    """Digraphs first, then single letters: the other order from the library's."""
    out = simplify_sql(w)
    for src, dst in t.STANDARD_DIGRAPHS.items():
        a, b = src
        title = dst[0].upper() + dst[1:]
        for s, d in ((src, dst), (a.upper() + b, title), (src.upper(), dst.upper()), (a + b.upper(), dst)):
            out = f"replace({out}, '{s}', '{d}')"
    keys, values = "".join(t.LATIN_TO_CYRILLIC), "".join(t.LATIN_TO_CYRILLIC.values())
    return f"translate({out}, '{keys}', '{values}')"


def project_text_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '[{L}]+|[^{L}]+'), lambda r: "
        f"CASE WHEN regexp_matches(r, '^[{L}]') AND NOT {blocked_sql('r')} THEN {project_sql('r')} ELSE r END), '')"
    )


def lines_sql(src: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """Line table: number, offsets, physical line and line without its break."""
    nb = f"[^{t.BREAK}]"
    return f"""(SELECT {key}, line_no, physical,
      (sum(length(physical)) OVER w - length(physical))::BIGINT AS line_off,
      (sum(strlen(physical)) OVER w - strlen(physical))::BIGINT AS line_byte_off,
      regexp_replace(physical, '[{t.BREAK}]+\\z', '') AS line
    FROM (SELECT {key}, unnest(r) AS physical, generate_subscripts(r, 1)::BIGINT AS line_no
          FROM (SELECT {key}, regexp_extract_all({text}, '{nb}*(?:\\r\\n|[{t.BREAK}])|{nb}+') AS r FROM {src}))
    WINDOW w AS (PARTITION BY {key} ORDER BY line_no))"""
