"""The blocker scan of marked-up pages: issue table, report by page, report of the corpus."""

from corpusgate.plans import blockers

from .marked import M_PAGES, M_PAINT, SEGMENTS, pages_of
from .markup import KNOWN, LEX_SQL, PAIR_SQL, ROLES, VISIBLE
from .registry import check, reasons_sql, roman_sql, runs_sql, script_sql, unmapped_sql

_ISSUES = f"""issues AS MATERIALIZED (SELECT page_id, w.off + start AS off, role, w.run AS word FROM {runs_sql(SEGMENTS)} w JOIN painted p ON w.doc_id // 100000000 = p.page_id AND w.doc_id % 100000000 = p.start
  WHERE w.is_word AND ({roman_sql('w.run')} OR {unmapped_sql('w.run')} OR {script_sql('w.run')}))"""
_MAPPING, _ROMAN = f"({unmapped_sql('word')} OR {script_sql('word')})", roman_sql("word")


def _counts():
    out = []
    for name, flag in (("blocked", "true"), ("unsupported", _MAPPING), ("roman_identity_hold", _ROMAN)):
        out += [f"count(*) FILTER ({flag}) AS {name}_occurrences", f"count(DISTINCT word) FILTER ({flag}) AS unique_{name}_surfaces",
                f"count(DISTINCT lower(word)) FILTER ({flag}) AS unique_{name}_lower"]
    return ", ".join(out)


_NAMES = [f"{p}{n}{s}" for n in ("blocked", "unsupported", "roman_identity_hold") for p, s in (("", "_occurrences"), ("unique_", "_surfaces"), ("unique_", "_lower"))]
_LEX = LEX_SQL.replace("FROM pages)", f"FROM {M_PAGES})")
_PAIR = PAIR_SQL.replace(LEX_SQL, _LEX)
_FILES = f"""files AS MATERIALIZED (SELECT *, CASE WHEN blocked_occurrences > 0 OR unknown_elements > 0 OR structure_errors > 0 OR NOT gap_free THEN '{blockers.BLOCKED}' ELSE '{blockers.READY}' END AS status FROM (
  SELECT m.page_id, upper(sha256(html)) AS sha256, strlen(html)::BIGINT AS bytes, length(html)::BIGINT AS length, coalesce(protected_bytes, 0) AS protected_bytes,
    {', '.join(f'coalesce({n}, 0) AS {n}' for n in _NAMES)}, coalesce(u.n, 0) AS unknown_elements, coalesce(e.n, 0) AS structure_errors, covered = length(html) AND scalars = length(html) AS gap_free
  FROM {M_PAGES} m LEFT JOIN (SELECT page_id, {_counts()} FROM issues GROUP BY page_id) c USING (page_id)
  LEFT JOIN (SELECT page_id, max("end") AS covered, sum(length(run)) AS scalars, coalesce(sum(strlen(run)) FILTER (role NOT IN ({VISIBLE})), 0)::BIGINT AS protected_bytes FROM painted GROUP BY page_id) s USING (page_id)
  LEFT JOIN (SELECT page_id, count(DISTINCT tag) AS n FROM {_LEX} WHERE kind = 'tag' AND tag <> '' AND tag NOT IN ({', '.join(repr(k) for k in KNOWN)}) GROUP BY page_id) u USING (page_id)
  LEFT JOIN (SELECT page_id, count(*) AS n FROM {_PAIR} WHERE state <> 'PAIRED' OR open_depth <> close_depth GROUP BY page_id) e USING (page_id)))"""
_GIVEN = f"WITH painted AS MATERIALIZED {M_PAINT}, {_ISSUES}"


def _scan(spark, sf):
    known = spark.createDataFrame([(k,) for k in KNOWN], "tag string")
    return blockers.scan(pages_of(spark, sf), ROLES, known)


@check("p2_blocker_issues", f"{_GIVEN} SELECT page_id, off, role, word, {reasons_sql('word')} AS reasons FROM issues")
def p2_issues(spark, sf):
    return _scan(spark, sf).issues


@check("p2_blocker_files", f"{_GIVEN}, {_FILES} SELECT * FROM files")
def p2_files(spark, sf):
    return _scan(spark, sf).files


@check(
    "p2_blocker_corpus",
    f"""{_GIVEN}, {_FILES} SELECT c.*, f.*, CASE WHEN blocked_files > 0 THEN '{blockers.BLOCKED}' ELSE '{blockers.READY}' END AS status FROM (SELECT {_counts()} FROM issues) c,
    (SELECT count(*) AS files, sum(bytes)::BIGINT AS bytes, sum(unknown_elements)::BIGINT AS unknown_elements, sum(structure_errors)::BIGINT AS structure_errors,
      count(*) FILTER (NOT gap_free) AS coverage_failures, count(*) FILTER (status = '{blockers.BLOCKED}') AS blocked_files FROM files) f""",
)
def p2_corpus(spark, sf):
    return _scan(spark, sf).corpus
