"""The projection job on marked-up pages, and its gates."""

from pyspark.sql import functions as F

from corpusgate.functions import tables as t
from corpusgate.operators import inventory, matches, pieces
from corpusgate.plans import marked
from corpusgate.session import stored_by_text

from .markup import LEX_SQL, PAINT_SQL, ROLES, VISIBLE
from .registry import ANNOUNCING, V_DOCS, blocked_sql, check, runs_sql, table
from .rewriting import PROTECTED_SQL, TRACE_SQL, UNITS_SQL
from .scalars import CYR_UNITS_RE2, ONE_LETTER_SQL, UNITS_RE2
from .windows import names_sql

# Pages with what the given ones lack, by key; a unit after a digit that markup sets apart is no unit.
MARKED = """CASE page_id % 5
 WHEN 0 THEN replace(html, '</h1>', ' 12pt A. Novak i Kapitel V. q.e.d. 3true em Đak IX 4<b>pt</b></h1>')
 WHEN 1 THEN replace(html, '<p>', '<p>VI 5 pt ne 5pt B. Kraus-Meyer <b>I</b>) slovo mešano 7EM ')
 WHEN 2 THEN replace(html, '</p>', ' ſtara ľjubi <i>dŽep <nav>C. van Bergh <a>V i I</a> 2cm</nav> Lj</i>erka 9mm5 Q. E. D. </p>')
 WHEN 3 THEN replace(html, '</a>', ' A I, V! M <b>lj</b>ubav volumes I</a></b>')
 ELSE html END"""
M_PAGES = f"(SELECT page_id, {MARKED} AS html FROM pages)"
LETTERS = ("A", "I", "V", "M")

# ---- the same in SQL: every visible stretch is a document of the earlier checks ---------------------------------------

M_PAINT = PAINT_SQL.replace(LEX_SQL, LEX_SQL.replace("FROM pages)", f"FROM {M_PAGES})"))
_SIZE = 100_000_000
SEGMENTS = f"(SELECT page_id * {_SIZE} + start AS doc_id, run AS text FROM painted WHERE kind = 'text' AND role IN ({VISIBLE}))"
_LITERALS = f"""(SELECT doc_id, e - n AS start, e AS "end" FROM (SELECT doc_id, hit, n, next, sum(n) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e FROM (
    SELECT doc_id, i, piece LIKE chr(1) || '%' AND NOT regexp_matches(coalesce(lag(piece) OVER w, ''), '\\p{{L}}$')
        AND NOT regexp_matches(coalesce(lead(piece) OVER w, ''), '^\\x01?\\p{{L}}') AS hit, lead(piece) OVER w AS next, length(piece) - 2 * (piece LIKE chr(1) || '%')::INT AS n FROM (
      SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, regexp_extract_all(
        regexp_replace(text, '(q\\. e\\. d\\.|q\\.e\\.d\\.|Q\\. E\\. D\\.|Q\\.E\\.D\\.)', chr(1) || '\\1' || chr(2), 'g'), '\\x01[^\\x02]*\\x02|[^\\x01]+') AS p FROM {SEGMENTS}))
      WINDOW w AS (PARTITION BY doc_id ORDER BY i))) WHERE hit)"""
REVIEWED = f"""(SELECT page_id, off - 1 AS start, off + length(run) - 3 * (page_id % 2) AS "end" FROM {runs_sql('pages', 'page_id', 'html').replace('FROM pages', f'FROM {M_PAGES}')}
  WHERE is_word AND length(run) >= 12)"""
_REVIEWED_IN = f"""(SELECT s.doc_id, greatest(r.start - s.doc_id % {_SIZE}, 0) AS start, least(r."end" - s.doc_id % {_SIZE}, length(text)) AS "end"
  FROM {SEGMENTS} s JOIN reviewed r ON s.doc_id // {_SIZE} = r.page_id AND r.start < s.doc_id % {_SIZE} + length(text) AND r."end" > s.doc_id % {_SIZE})"""


def _of_segments(sql: str) -> str:
    return sql.replace(V_DOCS, SEGMENTS)


_HELD_ALL = _of_segments(PROTECTED_SQL)
_MORE = f"UNION ALL SELECT * FROM {_LITERALS} UNION ALL SELECT * FROM {_REVIEWED_IN}"
_TRACE = _of_segments(TRACE_SQL)
_WITH_MORE = _HELD_ALL.replace("UNION ALL SELECT doc_id, off, off + 1", f"{_MORE} UNION ALL SELECT doc_id, off, off + 1")
M_TRACE = _TRACE.replace(_HELD_ALL, _WITH_MORE)
assert M_TRACE != _TRACE and _HELD_ALL != PROTECTED_SQL
_GIVEN = f"WITH painted AS MATERIALIZED {M_PAINT}, reviewed AS MATERIALIZED {REVIEWED}, trace AS MATERIALIZED {M_TRACE}"
_WHOLE = _GIVEN.replace(REVIEWED, f"(SELECT * FROM {REVIEWED} WHERE page_id % 2 = 0)")
_LEXED_OUT = f"""(SELECT page_id, start, coalesce(o.text, run) AS out FROM painted
  LEFT JOIN (SELECT doc_id, string_agg(out_text, '' ORDER BY in_start) AS text FROM trace GROUP BY doc_id) o ON o.doc_id = page_id * {_SIZE} + start AND kind = 'text')"""
M_OUTPUT = f"(SELECT page_id, string_agg(out, '' ORDER BY start) AS html FROM {_LEXED_OUT} GROUP BY page_id)"


def pages_of(spark, sf):
    """Pages with anything in them: one without a lexeme has no pieces and no row."""
    return table(spark, sf, "pages").select("page_id", F.expr(MARKED).alias("html")).where("html <> ''")


def reviewed_of(pages):
    """A range for each long word and the character before it; on every other page without its last three letters."""
    from corpusgate.operators import tokens

    tok = tokens.tokenise(pages, ["page_id"], "html").where(F.col("is_word") & (F.length("run") >= 12))
    return tok.select("page_id", (F.col("off") - 1).alias("start"), (F.col("off") + F.length("run") - 3 * (F.col("page_id") % 2)).alias("end"))


def _how():
    return {"letters": LETTERS, "rules": inventory.label_rules(ANNOUNCING)}


def projected(spark, sf):
    pages = pages_of(spark, sf)
    return pages, marked.project_marked(pages, ROLES, reviewed_of(pages), **_how())


@check("p1_project_marked", f"{_GIVEN} SELECT page_id, html FROM {M_OUTPUT}")
def p1(spark, sf):
    return stored_by_text(projected(spark, sf)[1].output)


# Held pieces one kind at a time; what two kinds claim goes to the first of literal, name, unit.
_TAKEN = """NOT EXISTS (SELECT 1 FROM {by} x WHERE x.doc_id = {of}.doc_id AND x.start < {of}."end" AND x."end" > {of}.start)"""
_KINDS_SQL = f"""lit AS MATERIALIZED {_LITERALS},
nam AS MATERIALIZED (SELECT doc_id, start, "end" FROM {_of_segments(names_sql(matches.INITIAL_NAME, 0, 'x'))} n WHERE {_TAKEN.format(by='lit', of='n')}),
uni AS MATERIALIZED (SELECT doc_id, start, "end" FROM {_of_segments(UNITS_SQL)} n),
first AS MATERIALIZED (SELECT *, 'literal' AS kind FROM lit UNION ALL SELECT *, 'name' FROM nam UNION ALL SELECT *, 'unit' FROM uni),
lone AS (SELECT doc_id, off AS start, off + 1 AS "end" FROM ({_of_segments(ONE_LETTER_SQL)}) WHERE disposition LIKE 'PRESERVE%'),
blo AS (SELECT doc_id, off AS start, off + length(run) AS "end" FROM {runs_sql(SEGMENTS)} WHERE is_word AND {blocked_sql('run')}),
held AS (SELECT * FROM first UNION ALL SELECT *, 'held_letter' FROM lone n WHERE {_TAKEN.format(by='first', of='n')}
  UNION ALL SELECT *, 'blocked' FROM blo n WHERE {_TAKEN.format(by='first', of='n')})"""


@check(
    "p1_held_trace",
    f"""WITH painted AS MATERIALIZED {M_PAINT}, reviewed AS (SELECT * FROM {REVIEWED} WHERE false), trace AS MATERIALIZED {M_TRACE},
    {_KINDS_SQL},
    laid AS (SELECT page_id, start, (sum(length(out)) OVER (PARTITION BY page_id ORDER BY start) - length(out))::BIGINT AS place FROM {_LEXED_OUT})
    SELECT o.page_id, kind, h.start + o.start AS in_start, h."end" + o.start AS in_end, o.place + tr.o + h.start - tr.a AS out_start, o.place + tr.o + h."end" - tr.a AS out_end,
      upper(sha256(substring(tr.in_text, (h.start - tr.a + 1)::BIGINT, (h."end" - h.start)::BIGINT))) AS surface_sha256
    FROM held h JOIN (SELECT doc_id, in_start AS a, in_end AS b, out_start AS o, in_text FROM trace WHERE protected) tr ON tr.doc_id = h.doc_id AND tr.a <= h.start AND h."end" <= tr.b
    JOIN laid o ON o.page_id = h.doc_id // {_SIZE} AND o.start = h.doc_id % {_SIZE}""",
)
def p1_trace(spark, sf):
    return stored_by_text(marked.project_marked(pages_of(spark, sf), ROLES, **_how()).trace)


_UNIT_COUNT = f"list_transform(regexp_extract_all(html, '{UNITS_RE2}', 1), lambda u: lower(u))"
_GATES = ("two_derivations_agree", "inverse_replay", "no_unprotected_latin", "units_survive", "no_projected_unit")


def whole_words(pages):
    return reviewed_of(pages).where("page_id % 2 = 0")


@check("p1_gates", " UNION ALL ".join(f"SELECT '{g}' AS code, 0::BIGINT AS failures, true AS pass" for g in _GATES))
def p1_gates(spark, sf):
    pages = pages_of(spark, sf)
    done = marked.project_marked(pages, ROLES, whole_words(pages), **_how())
    again = marked.second_derivation(pages, ROLES, whole_words(pages), **_how())
    return marked.gate_rows(pages, done, again, ROLES)


# Outputs that every gate must refuse: text put in, units written in the other script, units written another way.
SPOILT = """CASE page_id % 4 WHEN 1 THEN concat(html, '<p>latinski</p>') WHEN 2 THEN replace(html, '12pt', '12пт') WHEN 3 THEN replace(html, '7EM', '7xM') ELSE html END"""
_SPOILT_SQL = f"(SELECT page_id, html AS good, {SPOILT} AS html FROM output)"


@check(
    "p1_gate_failures",
    f"""{_WHOLE}, output AS MATERIALIZED {M_OUTPUT}, s AS MATERIALIZED {_SPOILT_SQL},
    census AS (SELECT page_id, unit, sum(n) AS n FROM (SELECT page_id, unnest({_UNIT_COUNT}) AS unit, 1 AS n FROM s
      UNION ALL SELECT page_id, unnest({_UNIT_COUNT}), -1 FROM {M_PAGES}) GROUP BY ALL)
    SELECT code, failures, failures = 0 AS pass FROM (
      SELECT 'two_derivations_agree' AS code, count(*) FILTER (html <> good) AS failures FROM s UNION ALL SELECT 'inverse_replay', count(*) FILTER (html <> good) FROM s
      UNION ALL SELECT 'no_unprotected_latin', count(*) FILTER (page_id % 4 = 1) FROM s
      UNION ALL SELECT 'units_survive', count(*) FILTER (n <> 0) FROM census
      UNION ALL SELECT 'no_projected_unit', count(*) FILTER (regexp_matches(html, '{CYR_UNITS_RE2}')) FROM s)""",
)
def p1_gate_failures(spark, sf):
    pages = pages_of(spark, sf)
    done = marked.project_marked(pages, ROLES, whole_words(pages), **_how())
    again = marked.second_derivation(pages, ROLES, whole_words(pages), **_how())
    spoilt = done.output.select("page_id", F.expr(SPOILT).alias("html"))
    return marked.gate_rows(pages, marked.MarkedProjection(done.table, spoilt, done.trace), again, ROLES)


@check(
    "p1_piece_census",
    f"""WITH painted AS MATERIALIZED {M_PAINT}, {_KINDS_SQL},
    w AS (SELECT doc_id, off AS start, off + length(run) AS "end" FROM {runs_sql(SEGMENTS)} WHERE is_word),
    seg AS (SELECT page_id * {_SIZE} + start AS doc_id, role FROM painted)
    SELECT kind, role, held, count(*) AS pieces, sum("end" - start)::BIGINT AS scalars FROM (SELECT doc_id, start, "end", kind, true AS held FROM held
      UNION ALL SELECT *, 'word', false FROM w WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.doc_id = w.doc_id AND h.start < w."end" AND h."end" > w.start)) JOIN seg USING (doc_id) GROUP BY ALL
    UNION ALL SELECT 'markup', role, false, count(*), sum("end" - start)::BIGINT FROM painted WHERE kind <> 'text' GROUP BY ALL""",
)
def p1_census(spark, sf):
    """Pieces that have a kind of their own; what stands between words is left out, and so are words in protected text."""
    done = marked.project_marked(pages_of(spark, sf), ROLES, **_how())
    d = pieces.piece_census(done.table)
    return stored_by_text(d.where((F.col("kind") == "markup") | (F.col("role").isin(*t.VISIBLE_ROLES) & (F.col("kind") != "other"))))

