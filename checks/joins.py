"""Joins, range joins, semi and anti joins."""

from pyspark.sql import functions as F

from corpusgate.functions import text as fx
from corpusgate.operators import gates, identity, inventory, lines, matches, spans, textqa, tokens
from corpusgate.session import stored, stored_by_text

from .registry import (
    L, LATER, LATER_DOCS, V_DOCS, as_sql, blocked_sql, check, later_docs, lines_sql, reasons_sql, roman_sql, runs_sql,
    script_sql, table, unmapped_sql, variant_docs, words_sql,
)

DRIFTED = "CASE WHEN doc_id % 7 = 0 THEN concat(text, '!') ELSE text END"
OBSERVED = "(SELECT concat('doc/', CAST(doc_id AS VARCHAR)) AS path, strlen(text)::BIGINT AS bytes, upper(sha256(text)) AS sha256 FROM documents WHERE doc_id % 11 <> 0)"
EXPECTED = f"(SELECT concat('doc/', CAST(doc_id AS VARCHAR)) AS path, strlen({DRIFTED})::BIGINT AS bytes, upper(sha256({DRIFTED})) AS sha256 FROM documents WHERE doc_id % 13 <> 0)"


def _pins(spark, sf):
    docs = table(spark, sf, "documents")
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    observed = identity.identity_table(docs.where("doc_id % 11 <> 0"), path, F.col("text"))
    expected = identity.identity_table(docs.where("doc_id % 13 <> 0"), path, F.expr(DRIFTED))
    return observed, expected


@check(
    "j1_verify_pins",
    f"""SELECT coalesce(o.path, e.path) AS path, CASE WHEN o.path IS NULL THEN 'MISSING' WHEN e.path IS NULL THEN 'UNEXPECTED'
      WHEN o.bytes = e.bytes AND o.sha256 = e.sha256 THEN 'MATCH' ELSE 'DRIFT' END AS status,
      e.bytes AS expected_bytes, o.bytes AS observed_bytes, e.sha256 AS expected_sha256, o.sha256 AS observed_sha256
    FROM {OBSERVED} o FULL OUTER JOIN {EXPECTED} e ON o.path = e.path""",
)
def j1(spark, sf):
    return identity.verify_pins(*_pins(spark, sf))


@check(
    "j2_topology",
    f"""SELECT path, 'missing' AS side FROM {EXPECTED} WHERE path NOT IN (SELECT path FROM {OBSERVED})
    UNION ALL SELECT path, 'unexpected' AS side FROM {OBSERVED} WHERE path NOT IN (SELECT path FROM {EXPECTED})""",
)
def j2(spark, sf):
    return identity.topology_difference(*_pins(spark, sf))


# Ranges for the span checks: every word of ten or more letters with three characters on either side.
RANGES_SQL = f"""(SELECT doc_id, greatest(off - 3, 0) AS start, off + length(run) + 3 AS "end" FROM {runs_sql()}
  WHERE is_word AND length(run) >= 10)"""
MERGED_SQL = f"""(SELECT doc_id, min(start) AS start, max("end") AS "end" FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start, "end"
    ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY doc_id ORDER BY start, "end"
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM {RANGES_SQL})) GROUP BY doc_id, g)"""


def long_word_ranges(tok):
    long = tok.where(F.col("is_word") & (F.length("run") >= 10))
    return long.select(
        "doc_id", F.greatest(F.col("off") - 3, F.lit(0)).alias("start"), (F.col("off") + F.length("run") + 3).alias("end")
    )


@check(
    "j3_containment",
    f"""SELECT t.doc_id, m.start IS NOT NULL AS covered, count(*) AS n, sum(off)::BIGINT AS offsets
    FROM {runs_sql()} t LEFT JOIN {MERGED_SQL} m ON t.doc_id = m.doc_id AND m.start <= t.off AND t.off + length(t.run) <= m."end"
    WHERE t.is_word GROUP BY ALL""",
)
def j3(spark, sf):
    docs = table(spark, sf, "documents")
    flagged = spans.words_covered(docs, long_word_ranges(tokens.tokenise(docs)))
    return flagged.groupBy("doc_id", "covered").agg(F.count("*").alias("n"), F.sum("off").alias("offsets"))


@check(
    "j4_token_locators",
    f"""WITH l AS {lines_sql()}, t AS (SELECT *, (sum(length(run)) OVER w - length(run))::BIGINT AS o,
        (sum(strlen(run)) OVER w - strlen(run))::BIGINT AS b
      FROM (SELECT doc_id, line_no, line_off, line_byte_off, unnest(r) AS run, generate_subscripts(r, 1) AS pos
        FROM (SELECT doc_id, line_no, line_off, line_byte_off, regexp_extract_all(line, '[{L}]+|[^{L}]+') AS r FROM l))
      WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos))
    SELECT doc_id, line_no, o + 1 AS col_no, line_off + o AS off, line_byte_off + b AS byte_off, run AS word
    FROM t WHERE regexp_matches(run, '^[{L}]')""",
)
def j4(spark, sf):
    return lines.token_locators(table(spark, sf, "documents"), keep_line=False)


_POLICY_WORDS = f"(SELECT DISTINCT word FROM {words_sql('benchmark', 'item_id')} WHERE length(word) >= 4)"


@check(
    "j8_surface_disposition",
    f"""SELECT doc_id, CASE WHEN p.word IS NOT NULL THEN 'PROTECT_ATTESTED' ELSE 'KEEP_PROJECTABLE' END AS disposition, count(*) AS n
    FROM {words_sql()} w LEFT JOIN {_POLICY_WORDS} p ON w.word = p.word GROUP BY ALL""",
)
def j8(spark, sf):
    policy = tokens.words(table(spark, sf, "benchmark"), []).where(F.length("word") >= 4).select(
        F.col("word").alias("surface"), F.lit("PROTECT_ATTESTED").alias("disposition")
    )
    rows = tokens.surface_counts(table(spark, sf, "documents"), ["doc_id"]).withColumnRenamed("word", "surface")
    d = inventory.surface_disposition(rows, policy, default="KEEP_PROJECTABLE")
    return d.groupBy("doc_id", "disposition").agg(F.sum("n").alias("n"))


# Structural issues of the variant texts, and a reviewed copy of them with gaps, drift, extras and one duplicate key.
ISSUES_SQL = f"""(SELECT doc_id, off, run AS word, {reasons_sql('run')} AS reasons FROM {runs_sql(V_DOCS)}
  WHERE is_word AND ({blocked_sql('run')} OR run = 'X'))"""
APPROVALS_SQL = f"""(SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN off + 1 ELSE off END AS off, word,
    CASE WHEN off % 5 = 0 THEN concat(reasons, '?') ELSE reasons END AS reasons FROM {ISSUES_SQL} WHERE doc_id % 10 <> 0
  UNION ALL SELECT doc_id, off, word, reasons FROM {ISSUES_SQL} WHERE doc_id % 12 = 2)"""


def structural_issues(spark, sf):
    """Blocked words; a lone X is one of them, since X has no correspondence."""
    d = tokens.locate_blocked_words(variant_docs(spark, sf))
    return d.withColumn("reasons", F.array_join(fx.block_reasons(F.col("word")), ","))


def reviewed(issues):
    one = issues.where("doc_id % 10 <> 0").select(
        "doc_id", F.expr("CASE WHEN doc_id % 9 = 0 THEN off + 1 ELSE off END").alias("off"), "word",
        F.expr("CASE WHEN off % 5 = 0 THEN concat(reasons, '?') ELSE reasons END").alias("reasons"),
    )
    return one.unionByName(issues.where("doc_id % 12 = 2"))


@check(
    "j9_match_approvals",
    f"""WITH i AS {ISSUES_SQL}, a AS (SELECT doc_id, off, word, count(*) AS n, min(reasons) AS reasons FROM {APPROVALS_SQL} GROUP BY ALL)
    SELECT doc_id, off, word, CASE WHEN a.n > 1 THEN 'DUPLICATE' WHEN a.n IS NULL THEN 'UNAPPROVED' WHEN i.reasons IS NULL THEN 'STALE'
      WHEN i.reasons <> a.reasons THEN 'FIELD_DRIFT' ELSE 'MATCH' END AS status,
      CASE WHEN a.n IS NOT NULL AND i.reasons IS NOT NULL THEN CASE WHEN i.reasons <> a.reasons THEN 'reasons' ELSE '' END END AS drift
    FROM i FULL OUTER JOIN a USING (doc_id, off, word)""".replace("GROUP BY ALL", "GROUP BY doc_id, off, word"),
)
def j9(spark, sf):
    issues = stored(structural_issues(spark, sf))  # read three times
    return identity.match_approvals(issues, reviewed(issues), ["doc_id", "off", "word"], ["reasons"])


@check(
    "j10_partition_issues",
    f"""SELECT doc_id, off, word, reasons, EXISTS (SELECT 1 FROM {APPROVALS_SQL} a WHERE a.doc_id = i.doc_id AND a.off = i.off
      AND a.word = i.word) AS approved FROM {ISSUES_SQL} i""",
)
def j10(spark, sf):
    issues = stored(structural_issues(spark, sf))  # read three times
    return identity.partition_issues(issues, reviewed(issues), ["doc_id", "off", "word"])


V_LATER = f"(SELECT doc_id, lang, {LATER} AS text FROM {V_DOCS})"


def _locate_sql(rows, docs):
    return f"""(SELECT r.doc_id, r.start, r."end", substring(d.text, r.start + 1, r."end" - r.start) AS surface,
      l.line_no, r.start - l.line_off + 1 AS col_no,
      l.line_byte_off + strlen(substring(l.line, 1, r.start - l.line_off)) AS byte_off,
      upper(sha256(l.line)) AS line_sha256,
      upper(sha256(substring(d.text, greatest(r.start - 80, 0) + 1, r.start + 160 - greatest(r.start - 80, 0)))) AS context_sha256
    FROM {rows} r JOIN {docs} d ON r.doc_id = d.doc_id
      LEFT JOIN {lines_sql(docs)} l ON l.doc_id = r.doc_id AND l.line_off <= r.start AND r.start < l.line_off + length(l.physical))"""


_LONG = "CASE WHEN off % 37 = 5 THEN 1500 ELSE length(word) END"
_SPANS_SQL = f'(SELECT doc_id, off AS start, off + {_LONG} AS "end" FROM {ISSUES_SQL})'


@check(
    "j11_stale_locators",
    f"""SELECT doc_id, start, "end", a.surface, concat_ws(',',
      CASE WHEN a.surface IS DISTINCT FROM b.surface OR b.line_no IS NULL THEN 'surface' END,
      CASE WHEN a.surface IS DISTINCT FROM b.surface OR b.line_no IS NULL THEN 'surface_sha256' END,
      CASE WHEN a.line_no IS DISTINCT FROM b.line_no THEN 'line_no' END,
      CASE WHEN b.line_no IS NULL OR a.col_no IS DISTINCT FROM b.col_no THEN 'col_no' END,
      CASE WHEN b.line_no IS NULL OR a.byte_off IS DISTINCT FROM b.byte_off THEN 'byte_off' END,
      CASE WHEN b.line_no IS NULL OR a.line_sha256 IS DISTINCT FROM b.line_sha256 THEN 'line_sha256' END,
      CASE WHEN b.line_no IS NULL OR a.context_sha256 IS DISTINCT FROM b.context_sha256 THEN 'context_sha256' END) AS drift
    FROM {_locate_sql(_SPANS_SQL, V_DOCS)} a JOIN {_locate_sql(_SPANS_SQL, V_LATER)} b USING (doc_id, start, "end")""",
)
def j11(spark, sf):
    docs = variant_docs(spark, sf)
    rows = structural_issues(spark, sf).select(
        "doc_id", F.col("off").alias("start"), (F.col("off") + F.expr(_LONG)).alias("end")
    )
    told = identity.manifests(rows, docs)
    return stored_by_text(identity.stale_in_text(told, docs.select("doc_id", as_sql(LATER).alias("text"))))


@check(
    "j12_companions",
    """SELECT o_orderkey AS l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS companion_1,
      max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS companion_2,
      (count(DISTINCT CASE WHEN l_linenumber IN (1, 2) THEN l_linenumber END))::BIGINT AS companion_count,
      count(*) FILTER (l_linenumber NOT IN (1, 2)) AS unlisted
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
)
def j12(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return identity.companions(orders, table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", (1, 2), F.col("l_partkey"))


@check(
    "j13_reconcile_censuses",
    f"""WITH b AS (SELECT word, count(*) AS n FROM {words_sql()} GROUP BY word),
    a AS (SELECT word, count(*) AS n FROM {words_sql(LATER_DOCS)} GROUP BY word)
    SELECT word, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS "after", greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS added,
      greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS removed, coalesce(a.n, 0) - coalesce(b.n, 0) AS net
    FROM b FULL OUTER JOIN a USING (word)""",
)
def j13(spark, sf):
    held = lambda d: tokens.surface_counts(d, [])
    return identity.reconcile_counts(held(table(spark, sf, "documents")), held(later_docs(spark, sf)), ["word"])


@check(
    "j14_published_manifest",
    """WITH o AS (SELECT url AS path, strlen(html)::BIGINT AS bytes, upper(sha256(html)) AS sha256 FROM pages),
    e AS (SELECT CASE WHEN page_id % 8 = 0 THEN url || '.bak' ELSE url END AS path, strlen(html)::BIGINT AS bytes,
      upper(sha256(CASE WHEN page_id % 5 = 0 THEN replace(html, '<p>', '<q>') ELSE html END)) AS sha256 FROM pages)
    SELECT coalesce(o.path, e.path) AS path, CASE WHEN o.path IS NULL THEN 'MISSING' WHEN e.path IS NULL THEN 'UNEXPECTED'
      WHEN o.bytes = e.bytes AND o.sha256 = e.sha256 THEN 'MATCH' ELSE 'DRIFT' END AS status,
      e.bytes AS expected_bytes, o.bytes AS observed_bytes, e.sha256 AS expected_sha256, o.sha256 AS observed_sha256
    FROM o FULL OUTER JOIN e ON o.path = e.path""",
)
def j14(spark, sf):
    pages = table(spark, sf, "pages")
    local = identity.identity_table(pages, F.col("url"), F.col("html"))
    published = identity.identity_table(
        pages, F.expr("CASE WHEN page_id % 8 = 0 THEN concat(url, '.bak') ELSE url END"),
        F.expr("CASE WHEN page_id % 5 = 0 THEN replace(html, '<p>', '<q>') ELSE html END"),
    )
    return identity.verify_pins(local, published)


@check(
    "j15_component_boundaries",
    rf"""WITH p AS (SELECT conv_id, turn, length(regexp_replace(text, '[{textqa.t.SPACE}]', '', 'g'))::BIGINT AS m FROM conversations),
    c AS (SELECT conv_id, count(*) AS pages, arg_min(m, turn) AS first_page_non_whitespace, arg_max(m, turn) AS last_page_non_whitespace FROM p GROUP BY conv_id)
    SELECT conv_id, pages, (sum(pages) OVER (ORDER BY conv_id) - pages + 1)::BIGINT AS first_page, (sum(pages) OVER (ORDER BY conv_id))::BIGINT AS last_page,
      first_page_non_whitespace, last_page_non_whitespace, first_page_non_whitespace > 20 AND last_page_non_whitespace > 20 AS pass FROM c""",
)
def j15(spark, sf):
    return textqa.component_boundaries(table(spark, sf, "conversations"), "conv_id", "turn")
