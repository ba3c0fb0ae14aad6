"""Censuses, multisets, digests and gates."""

from pyspark.sql import functions as F

from corpusgate.functions import text as fx
from corpusgate.operators import digests, gates, identity, inventory, matches, textqa, tokens

from .registry import (
    ANNOUNCING,
    LATER_DOCS, V_DOCS, blocked_sql, check, later_docs, reasons_sql, roman_sql, script_sql, simplify_sql, table,
    unmapped_sql, variant_docs, words_sql,
)
from .joins import ISSUES_SQL, structural_issues
from .scalars import ONE_LETTER_SQL


@check(
    "blocked_word_census",
    f"""SELECT lang, count(*) AS words, count(DISTINCT word) AS distinct_surfaces, count(DISTINCT lower(word)) AS distinct_lower,
      count(*) FILTER ({unmapped_sql('word')} OR {script_sql('word')}) AS unsupported, count(*) FILTER ({roman_sql('word')}) AS roman,
      count(*) FILTER ({blocked_sql('word')}) AS blocked FROM {words_sql(keep='lang')} GROUP BY lang""",
)
def flagship(spark, sf):
    return tokens.blocked_word_census(table(spark, sf, "documents"), ["lang"])


_CLASS = f"""CASE WHEN {blocked_sql('word')} THEN 'blocked' WHEN {simplify_sql('word')} <> word THEN 'converted_after_simplification'
  ELSE 'converted_standard' END"""


@check(
    "a2_conversion_census",
    f"""SELECT lang, class, count(*) AS n FROM (SELECT lang, {_CLASS} AS class FROM {words_sql(V_DOCS, 'lang')})
    GROUP BY GROUPING SETS ((lang, class), (class))""",
)
def a2(spark, sf):
    return tokens.conversion_census(variant_docs(spark, sf), ["lang"])


@check(
    "a3_issue_types",
    f"""SELECT lang, reason, count(*) AS n FROM (SELECT lang, unnest(string_split({reasons_sql('word')}, ',')) AS reason
      FROM {words_sql(V_DOCS, 'lang')}) WHERE reason <> '' GROUP BY ALL""",
)
def a3(spark, sf):
    return tokens.issue_type_counts(variant_docs(spark, sf), ["lang"])


@check(
    "a4_distinct_surfaces",
    f"""SELECT source, count(*) AS words, count(DISTINCT word) AS distinct_surfaces, count(DISTINCT lower(word)) AS distinct_lower,
      count(*) FILTER ({unmapped_sql('word')} OR {script_sql('word')}) AS unsupported, count(*) FILTER ({roman_sql('word')}) AS roman,
      count(*) FILTER ({blocked_sql('word')}) AS blocked FROM {words_sql(keep='source')} GROUP BY source""",
)
def a4(spark, sf):
    return tokens.blocked_word_census(table(spark, sf, "documents"), ["source"])


@check(
    "a5_overlapping_inventories",
    f"""SELECT doc_id, count(*) FILTER (u) AS unsupported, count(*) FILTER (r) AS roman, count(*) FILTER (u AND r) AS "both",
      count(*) FILTER (u OR r) AS blocked,
      count(*) FILTER (u OR r) = count(*) FILTER (u) + count(*) FILTER (r) - count(*) FILTER (u AND r) AS pass FROM (SELECT doc_id, {unmapped_sql('word')} OR {script_sql('word')} AS u,
      {roman_sql('word')} AS r FROM {words_sql(V_DOCS)}) GROUP BY doc_id""",
)
def a5(spark, sf):
    return tokens.overlapping_inventories(variant_docs(spark, sf), ["doc_id"])


@check(
    "a6_inventory_summary",
    f"""SELECT doc_id, surface, disposition, count(*) AS n FROM ({ONE_LETTER_SQL})
    GROUP BY GROUPING SETS ((doc_id), (surface), (disposition), ())""",
)
def a6(spark, sf):
    docs = variant_docs(spark, sf)
    names = matches.name_spans(docs, ["doc_id"], *matches.NAME_SUBTYPES[0])
    return inventory.summarise(inventory.one_letter_inventory(docs, names, inventory.label_rules(ANNOUNCING), letters=("A", "I", "V", "M")))


_SIGNATURE = f"""SELECT lang, word, reasons, count(*) AS n FROM (SELECT lang, word, {reasons_sql('word')} AS reasons
  FROM {words_sql('{src}', 'lang')}) WHERE reasons <> '' GROUP BY ALL"""


@check("a7_signature_multiset", _SIGNATURE.replace("{src}", V_DOCS))
def a7(spark, sf):
    return tokens.signature_multiset(tokens.words(variant_docs(spark, sf), ["lang"]), ["lang"], "word")


@check(
    "a8_multiset_subset",
    f"""WITH o AS ({_SIGNATURE.replace('{src}', V_DOCS)}), p AS (SELECT lang, word, reasons, CASE WHEN n % 5 = 0 THEN n - 1 ELSE n END AS permitted
      FROM ({_SIGNATURE.replace('{src}', 'documents')}))
    SELECT lang, word, reasons, n AS observed, permitted, CASE WHEN permitted IS NULL THEN 'UNREVIEWED' ELSE 'EXCESS' END AS violation
    FROM o LEFT JOIN p USING (lang, word, reasons) WHERE permitted IS NULL OR n > permitted""",
)
def a8(spark, sf):
    observed = tokens.signature_multiset(tokens.blocked_words(variant_docs(spark, sf), ["lang"]), ["lang"], "word")
    permitted = tokens.signature_multiset(tokens.blocked_words(table(spark, sf, "documents"), ["lang"]), ["lang"], "word")
    permitted = permitted.withColumn("n", F.expr("CASE WHEN n % 5 = 0 THEN n - 1 ELSE n END"))
    return gates.multiset_violations(observed, permitted, ["lang", "word", "reasons"])


_DOC_DIGEST = f"""SELECT doc_id, count(*) AS rows, upper(sha256(string_agg(off || ' ' || word || ' ' || reasons, chr(10) ORDER BY off))) AS digest
  FROM {ISSUES_SQL} GROUP BY doc_id"""


def _issue_digests(spark, sf):
    line = F.concat_ws(" ", F.col("off").cast("string"), "word", "reasons")
    return digests.row_digest(structural_issues(spark, sf), ["doc_id"], "off", line)


@check("a9_inventory_digest", _DOC_DIGEST)
def a9(spark, sf):
    return _issue_digests(spark, sf)


def _levels(inner, n):
    for _ in range(n):
        inner = f"""(SELECT id >> 12 AS id, upper(sha256(string_agg(d, chr(10) ORDER BY id))) AS d, sum(m)::BIGINT AS m FROM {inner} GROUP BY 1)"""
    return inner


@check(
    "a9_corpus_digest",
    f"SELECT m AS members, d AS digest FROM {_levels('(SELECT doc_id AS id, digest AS d, 1 AS m FROM (' + _DOC_DIGEST + '))', 6)}",
)
def a9_corpus(spark, sf):
    return digests.corpus_digest(_issue_digests(spark, sf), "doc_id")


@check(
    "a12_page_characters",
    rf"""SELECT conv_id, turn, list_sort(string_split(a, '')) = list_sort(string_split(b, '')) AS same FROM (SELECT conv_id, turn,
      regexp_replace(text, '[{textqa.t.SPACE}]', '', 'g') AS a,
      regexp_replace(CASE WHEN turn = 3 THEN text || 'z' ELSE ' ' || reverse(text) END, '[{textqa.t.SPACE}]', '', 'g') AS b FROM conversations)""",
)
def a12(spark, sf):
    left = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    right = left.select("conv_id", "turn", F.expr("CASE WHEN turn = 3 THEN concat(text, 'z') ELSE concat(' ', reverse(text)) END").alias("text"))
    return textqa.same_characters(left, right, ["conv_id", "turn"])


@check(
    "a13_census_gate",
    f"""WITH o AS (SELECT lang, {_CLASS} AS class, count(*) AS n FROM {words_sql('documents', 'lang')} GROUP BY ALL),
    e AS (SELECT lang, {_CLASS} AS class, count(*) AS n FROM {words_sql(LATER_DOCS, 'lang')} GROUP BY ALL)
    SELECT lang, class, coalesce(o.n, 0) AS observed, coalesce(e.n, 0) AS expected, coalesce(o.n, 0) = coalesce(e.n, 0) AS pass
    FROM o FULL OUTER JOIN e USING (lang, class)""",
)
def a13(spark, sf):
    per = lambda d: tokens.conversion_census(d, ["lang"]).where("lang IS NOT NULL")
    return gates.census_gate(per(table(spark, sf, "documents")), per(later_docs(spark, sf)), ["lang", "class"])


@check(
    "a15_readiness",
    f"""SELECT d.doc_id, coalesce(i.n, 0) AS issues, coalesce(u.n, 0) AS unknown,
      CASE WHEN coalesce(i.n, 0) = 0 AND coalesce(u.n, 0) = 0 THEN 'READY_IN_MEMORY_ONLY' ELSE 'BLOCKED_FAIL_CLOSED' END AS status
    FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM {ISSUES_SQL} GROUP BY doc_id) i USING (doc_id)
    LEFT JOIN (SELECT doc_id, sum(toxic)::BIGINT AS n FROM labels GROUP BY doc_id) u USING (doc_id)""",
)
def a15(spark, sf):
    issues = structural_issues(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n"))
    unknown = table(spark, sf, "labels").groupBy("doc_id").agg(F.sum("toxic").alias("n"))
    return gates.readiness(table(spark, sf, "documents"), issues, unknown, ["doc_id"])


@check(
    "a16_corpus_rollup",
    f"""SELECT lang, source, count(*) AS words, count(*) FILTER ({unmapped_sql('word')} OR {script_sql('word')}) AS unsupported,
      count(*) FILTER ({roman_sql('word')}) AS roman, count(*) FILTER ({blocked_sql('word')}) AS blocked
    FROM {words_sql('documents', 'lang, source')} GROUP BY ROLLUP (lang, source)""",
)
def a16(spark, sf):
    return tokens.blocked_rollup(table(spark, sf, "documents"), ["lang", "source"])


@check("a17_archive_totals", "SELECT count(*) AS members, sum(strlen(text))::BIGINT AS bytes FROM documents")
def a17(spark, sf):
    return table(spark, sf, "documents").agg(
        F.count("*").alias("members"), F.sum(F.octet_length("text")).alias("bytes")
    )


@check(
    "a19_duplicates",
    "SELECT upper(sha256(text)) AS sha256, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def a19(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", fx.sha256_upper(F.col("text")).alias("sha256"))
    return gates.duplicates(docs, ["sha256"], "doc_id")


@check(
    "a20_class_transition",
    """WITH m AS (SELECT 'q' || quality || 't' || toxic AS b, CASE WHEN n_chars > 2000 THEN 'long' ELSE 'q' || quality || 't' || toxic END AS a
      FROM labels LEFT JOIN documents USING (doc_id)), c AS (SELECT DISTINCT unnest([a, b]) AS class FROM m)
    SELECT class, count(*) FILTER (b = class) AS before, count(*) FILTER (a = class) AS "after", count(*) FILTER (a = class AND b <> class) AS entered,
      count(*) FILTER (b = class AND a <> class) AS "left", count(*) FILTER (a = class) - count(*) FILTER (b = class) AS delta,
      count(*) FILTER (b = class) + count(*) FILTER (a = class AND b <> class) - count(*) FILTER (b = class AND a <> class) = count(*) FILTER (a = class) AS pass
    FROM m, c GROUP BY class""",
)
def a20(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.expr("concat('q', quality, 't', toxic)").alias("class"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    later = labels.join(docs, "doc_id", "left").select(
        "doc_id", F.when(F.col("n_chars") > 2000, "long").otherwise(F.col("class")).alias("class")
    )
    return gates.class_transition(labels, later, ["doc_id"])
