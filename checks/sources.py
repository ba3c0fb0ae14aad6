"""Scans, transport, strict JSON, canonical rows, sinks."""

from pyspark.sql import functions as F

from corpusgate.functions import text as fx
from corpusgate.sources.scan import parse_jsonl, read_corpus, read_tree
from corpusgate.sources.transport import strict_json_code, transport_code

from .registry import check, table


@check("s1_read_corpus", "SELECT doc_id, text FROM documents")
def s1(spark, sf):
    return read_corpus(spark, f"{sf}/documents.parquet", "doc_id", "text")


@check("s2_file_identity", "SELECT doc_id, strlen(text)::BIGINT AS bytes, upper(sha256(text)) AS sha256 FROM documents")
def s2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *fx.identity(F.col("text")))


@check(
    "s3_transport_check",
    """WITH v AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '\ufeff' || text WHEN 1 THEN text || chr(13) || chr(10)
        WHEN 2 THEN text WHEN 3 THEN text || 'é' || chr(10) WHEN 5 THEN text || chr(10) || 'x' ELSE text || chr(10) END AS text
      FROM documents)
    SELECT doc_id, CASE WHEN text LIKE '\ufeff%' THEN 'utf8_bom' WHEN contains(text, chr(13)) THEN 'non_lf_newline'
      WHEN NOT suffix(text, chr(10)) THEN 'missing_terminal_lf' WHEN doc_id % 7 = 4 THEN 'invalid_utf8'
      WHEN nfc_normalize(text) <> text THEN 'non_nfc' ELSE 'ok' END AS code FROM v""",
)
def s3(spark, sf):
    raw = F.expr(
        """CASE doc_id % 7 WHEN 0 THEN concat(unhex('EFBBBF'), encode(text, 'UTF-8'))
        WHEN 1 THEN encode(concat(text, '\\r\\n'), 'UTF-8') WHEN 2 THEN encode(text, 'UTF-8')
        WHEN 3 THEN encode(concat(text, 'é\\n'), 'UTF-8')
        WHEN 4 THEN concat(unhex('FF'), encode(text, 'UTF-8'), unhex('0A'))
        WHEN 5 THEN encode(concat(text, '\\nx'), 'UTF-8') ELSE encode(concat(text, '\\n'), 'UTF-8') END"""
    )
    docs = table(spark, sf, "documents").select("doc_id", raw.alias("content"))
    return docs.select("doc_id", transport_code(F.col("content")).alias("code"))


_JSON_VARIANTS = """CASE event_id % 6 WHEN 0 THEN concat(props, '\n')
  WHEN 1 THEN concat('{"k": ', CAST(event_id AS STRING), ', "k": 1}\n') WHEN 2 THEN concat('\ufeff', props, '\n')
  WHEN 3 THEN concat(props, '\r\n') WHEN 4 THEN props ELSE concat(props, '\n\n') END"""


@check(
    "s4_strict_json",
    f"""WITH v AS (SELECT event_id, {_JSON_VARIANTS} AS j FROM events)
    SELECT event_id, CASE WHEN j LIKE '\ufeff%' OR contains(j, chr(13)) THEN 'non_canonical_transport'
      WHEN NOT suffix(j, chr(10)) OR suffix(j, chr(10) || chr(10)) THEN 'terminal_lf'
      WHEN NOT json_valid(j) OR len(json_keys(j)) <> len(list_distinct(json_keys(j))) THEN 'invalid_json'
      ELSE 'ok' END AS code FROM v""",
)
def s4(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.expr(_JSON_VARIANTS).alias("j"))
    return ev.select("event_id", strict_json_code(F.col("j")).alias("code"))


@check(
    "s5_read_jsonl",
    """SELECT event_id AS decision_id, event_type AS kind, (props ->> '$.k')::BIGINT AS k FROM events WHERE event_id % 9 <> 0""",
)
def s5(spark, sf):
    line = F.when(F.col("event_id") % 9 == 0, "  ").otherwise(
        F.concat(
            F.lit('{"decision_id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"),
            F.lit('","props":'), F.col("props"), F.lit("}"),
        )
    )
    rows = parse_jsonl(table(spark, sf, "events").select(line.alias("value")))
    return rows.select(
        F.variant_get("row", "$.decision_id", "bigint").alias("decision_id"),
        F.variant_get("row", "$.kind", "string").alias("kind"),
        F.variant_get("row", "$.props.k", "bigint").alias("k"),
    )


@check("s6_read_tree")
def s6(spark, sf):
    tree = read_tree(spark, sf, exclude_names=("region.parquet",), pattern="*.parquet")
    return tree.orderBy("path")


@check(
    "s10_canonical_json",
    """SELECT o_orderkey, '{"cust":' || o_custkey || ',"key":' || o_orderkey || ',"note":'
      || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END
      || ',"status":"' || o_orderstatus || '"}' || chr(10) AS line FROM orders""",
)
def s10(spark, sf):
    o = table(spark, sf, "orders")
    note = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    line = fx.canonical_json(key=F.col("o_orderkey"), cust=F.col("o_custkey"), status=F.col("o_orderstatus"), note=note)
    return o.select("o_orderkey", line.alias("line"))
