"""Running totals, range unions and ledger windows."""

from pyspark.sql import functions as F

from corpusgate.operators import ledger, lines, matches, spans, tokens

from .joins import MERGED_SQL, long_word_ranges
from .registry import L, V_DOCS, check, lines_sql, table, variant_docs


@check("w1_running_offsets", f"SELECT doc_id, line_no, line_off, line_byte_off, physical, line FROM {lines_sql(V_DOCS)}")
def w1(spark, sf):
    return lines.line_table(variant_docs(spark, sf))


@check("w4_range_union", f"SELECT * FROM {MERGED_SQL}")
def w4(spark, sf):
    return spans.merge_ranges(long_word_ranges(tokens.tokenise(table(spark, sf, "documents"))))


@check(
    "w7_ordinal_check",
    """SELECT l_orderkey, count(*) AS rows, count(DISTINCT l_linenumber) AS distinct_ordinals, min(l_linenumber)::BIGINT AS first,
      max(l_linenumber)::BIGINT AS last, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS pass
    FROM lineitem GROUP BY l_orderkey""",
)
def w7(spark, sf):
    return ledger.ordinal_check(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


@check(
    "w8_head_rows",
    """SELECT user_id, count(*) AS rows, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
      arg_max(props, event_id) AS props FROM events GROUP BY user_id""",
)
def w8(spark, sf):
    return ledger.head_rows(table(spark, sf, "events"), ["user_id"], "event_id", ["event_type", "props"])


_NAMED = "CASE WHEN turn = 0 THEN NULL WHEN conv_id % 5 = 0 AND turn = 2 THEN 0 ELSE turn - 1 END"


@check(
    "w9_predecessor_links",
    f"""WITH c AS (SELECT conv_id, turn, {_NAMED} AS named FROM conversations WHERE NOT (conv_id % 7 = 0 AND turn = 1)),
    p AS (SELECT c.*, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM c)
    SELECT conv_id, turn, named, CASE WHEN named IS NULL AND prev IS DISTINCT FROM turn - 1 THEN 'FIRST' WHEN prev IS DISTINCT FROM turn - 1 THEN 'ORPHAN'
      WHEN named = turn - 1 THEN 'LINKED' ELSE 'BROKEN' END AS link FROM p""",
)
def w9(spark, sf):
    rows = table(spark, sf, "conversations").where("NOT (conv_id % 7 = 0 AND turn = 1)")
    rows = rows.select("conv_id", "turn", F.expr(_NAMED).alias("named"))
    return ledger.predecessor_links(rows, ["conv_id"], "turn", "named")


def names_sql(pattern, rank, subtype, docs=V_DOCS):
    p = pattern.replace("'", "''")
    return f"""(SELECT doc_id, e - n AS start, e AS "end", surface, '{subtype}' AS subtype, {rank} AS rank FROM (
      SELECT doc_id, hit, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e, substring(piece, 2, n) AS surface FROM (
        SELECT doc_id, piece, i, piece LIKE chr(1) || '%' AS hit, length(piece) - 2 * (piece LIKE chr(1) || '%')::INT AS n FROM (
          SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, regexp_extract_all(
            regexp_replace(text, '(^|[^{L}])({p})', '\\1' || chr(1) || '\\2' || chr(2), 'g'),
            '\\x01[^\\x02]*\\x02|[^\\x01]+') AS p FROM {docs})))) WHERE hit)"""


def name_candidates(docs):
    """Both name patterns over the same texts, ranked."""
    out = None
    for rank, (subtype, pattern) in enumerate(matches.NAME_SUBTYPES):
        d = matches.name_spans(docs, ["doc_id"], subtype, pattern).withColumn("rank", F.lit(rank))
        out = d if out is None else out.unionByName(d)
    return out


BOTH_NAMES_SQL = "(" + " UNION ALL ".join(
    f"SELECT * FROM {names_sql(p, i, s)}" for i, (s, p) in enumerate(matches.NAME_SUBTYPES)
) + ")"


@check(
    "w10_first_pattern_wins",
    f"""SELECT doc_id, start, "end", surface, subtype FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, start, "end" ORDER BY rank) AS rn
      FROM (SELECT * FROM {BOTH_NAMES_SQL} UNION ALL SELECT doc_id, start, "end", surface, 'repeat', 7 FROM {BOTH_NAMES_SQL})) WHERE rn = 1""",
)
def w10(spark, sf):
    names = name_candidates(variant_docs(spark, sf))
    again = names.withColumns({"subtype": F.lit("repeat"), "rank": F.lit(7)})
    return ledger.first_pattern_wins(names.unionByName(again), ["doc_id"], "rank", ["surface", "subtype"])


@check(
    "w11_stage_counters",
    """SELECT event_type, day, n, lag(n) OVER w AS previous, n - lag(n) OVER w AS delta FROM (
      SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL) WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
)
def w11(spark, sf):
    per = table(spark, sf, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return ledger.stage_counters(per.agg(F.count("*").alias("n")), ["event_type"], "day")
