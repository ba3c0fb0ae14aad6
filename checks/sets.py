"""Orders, extremes and set operations."""

from pyspark.sql import functions as F

from corpusgate.operators import digests, gates, identity, inventory, spans, tokens
from corpusgate.session import stored

from .joins import APPROVALS_SQL, ISSUES_SQL, MERGED_SQL, long_word_ranges, reviewed, structural_issues
from .registry import ANNOUNCING, LATER_DOCS, V_DOCS, check, later_docs, table, variant_docs, words_sql
from .windows import BOTH_NAMES_SQL, name_candidates
from .scalars import ONE_LETTER_SQL


@check("o1_inventory_order", f"SELECT * FROM {ISSUES_SQL} ORDER BY doc_id, off")
def o1(spark, sf):
    # A sort reads its input twice: once to choose the ranges.
    return stored(structural_issues(spark, sf)).orderBy("doc_id", "off")


@check(
    "o2_member_order",
    """SELECT path, upper(sha256(text)) || chr(9) || strlen(text) || chr(9) || path AS line
    FROM (SELECT lang || '/' || source || '/' || doc_id || '.txt' AS path, text FROM documents) ORDER BY path""",
)
def o2(spark, sf):
    path = F.concat_ws("/", "lang", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return digests.member_manifest(identity.identity_table(table(spark, sf, "documents"), path, F.col("text")))


@check(
    "o3_extreme_records",
    """SELECT l_returnflag, arg_min({'p': l_extendedprice, 'k': l_orderkey, 'n': l_linenumber}, (l_extendedprice, l_orderkey, l_linenumber)).k AS least_order,
      arg_max({'p': l_extendedprice, 'k': l_orderkey, 'n': l_linenumber}, (l_extendedprice, -l_orderkey, -l_linenumber)).k AS most_order
    FROM lineitem GROUP BY l_returnflag""",
)
def o3(spark, sf):
    least = F.struct("l_extendedprice", "l_orderkey", "l_linenumber")
    most = F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_linenumber"))
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.min_by("l_orderkey", least).alias("least_order"), F.max_by("l_orderkey", most).alias("most_order")
    )


@check(
    "u1_union_inventories",
    f"""SELECT doc_id, start, "end", surface, 'name_candidate' AS kind, subtype, NULL AS disposition FROM {BOTH_NAMES_SQL}
    UNION ALL SELECT doc_id, off, off + 1, surface, 'one_letter', NULL, disposition FROM ({ONE_LETTER_SQL})""",
)
def u1(spark, sf):
    docs = variant_docs(spark, sf)
    names = name_candidates(docs).drop("rank").withColumn("kind", F.lit("name_candidate"))
    guard = names.where("subtype = 'initial_plus_surname'").select("doc_id", "start", "end")
    letters = inventory.one_letter_inventory(docs, guard, inventory.label_rules(ANNOUNCING), letters=("A", "I", "V", "M"))
    letters = letters.withColumnRenamed("off", "start").withColumn("kind", F.lit("one_letter"))
    return names.unionByName(letters, allowMissingColumns=True)


@check("u2_distinct_lexicon", f"SELECT DISTINCT lower(word) AS word FROM {words_sql('benchmark', 'item_id')} WHERE length(word) >= 2")
def u2(spark, sf):
    w = tokens.words(table(spark, sf, "benchmark"), [])
    return w.where(F.length("word") >= 2).select(F.lower("word").alias("word")).distinct()


@check(
    "u3_set_equality",
    f"""WITH l AS (SELECT DISTINCT doc_id, off, word FROM {ISSUES_SQL}), r AS (SELECT DISTINCT doc_id, off, word FROM {APPROVALS_SQL})
    SELECT *, 'left_only' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r) UNION ALL SELECT *, 'right_only' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)""",
)
def u3(spark, sf):
    issues = stored(structural_issues(spark, sf))  # read three times
    return gates.key_differences(issues, reviewed(issues), ["doc_id", "off", "word"])


@check(
    "u4_multiset_equality",
    f"""WITH l AS (SELECT doc_id, word, count(*) AS n FROM {words_sql()} GROUP BY ALL), r AS (SELECT doc_id, word, count(*) AS n FROM {words_sql(LATER_DOCS)} GROUP BY ALL)
    SELECT doc_id, word, coalesce(l.n, 0) AS left_n, coalesce(r.n, 0) AS right_n FROM l FULL OUTER JOIN r USING (doc_id, word)
    WHERE coalesce(l.n, 0) <> coalesce(r.n, 0)""",
)
def u4(spark, sf):
    return gates.word_differences(table(spark, sf, "documents"), later_docs(spark, sf), ["doc_id"])


@check(
    "u5_range_complement",
    f"""WITH m AS (SELECT doc_id, start, least("end", n) AS "end" FROM {MERGED_SQL} JOIN (SELECT doc_id, length(text) AS n FROM documents) USING (doc_id)),
    e AS (SELECT doc_id, start, "end" FROM m UNION ALL SELECT doc_id, length(text), length(text) FROM documents),
    g AS (SELECT doc_id, coalesce(max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, start AS b FROM e)
    SELECT doc_id, a::BIGINT AS start, b::BIGINT AS "end" FROM g WHERE a < b""",
)
def u5(spark, sf):
    docs = table(spark, sf, "documents")
    lengths = docs.select("doc_id", F.length("text").alias("length"))
    merged = spans.merge_ranges(long_word_ranges(tokens.tokenise(docs)))
    merged = merged.join(lengths, "doc_id").select("doc_id", "start", F.least("end", "length").alias("end"))
    return spans.complement(merged, lengths)
