"""Ledger JSON, receipts, manifests and sinks."""

from pyspark.sql import functions as F

from corpusgate.functions import text as fx
from corpusgate.operators import identity, ledger
from corpusgate.session import scratch_dir
from corpusgate.sources import sinks

from .registry import check, table

LEDGER = """CASE event_id % 11
 WHEN 5 THEN '{"source_change":"0"}' WHEN 6 THEN '{"source_change":"false"}' WHEN 7 THEN '{"source_change":0.0,"claims":{"source_changes":{}}}'
 WHEN 8 THEN '{"source_change":null,"claims":{"source_changes":"[]"}}' WHEN 9 THEN '{"a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":{"i":{"j":{"rejected":[]}}}}}}}}}}}'
 WHEN 10 THEN '{"source_change":[]}'
 WHEN 0 THEN concat('{"alternatives_rejected":["a",{"rejected":1}],"k":', event_id, ',"n":{"Rejection":{"alternative":2,"x":1}},"source_change":""}')
 WHEN 1 THEN concat('{"claims":{"source_changes":[1]},"k":', event_id, ',"list":[{"alternative":"v"},{"deep":[{"reject_reason":"w"},7]}]}')
 WHEN 2 THEN props
 WHEN 3 THEN concat('{"a":{"b":{"c":{"d":{"alternative_x":', event_id, '}}}},"result":{"Source_bytes":3},"source_change":false}')
 ELSE concat('{"pins":[{"bytes":', event_id, ',"path":"p/', event_type, '","sha256":"AB"},{"in":{"bytes":1,"path":"q","sha256":"CD"}}],"source_change":"yes"}') END"""
LEDGER_SQL = f"(SELECT event_id, event_type, {LEDGER} AS j FROM events)"


def ledger_rows(spark, sf):
    expr = LEDGER.replace("event_id, '", "CAST(event_id AS STRING), '")
    return table(spark, sf, "events").select("event_id", "event_type", F.parse_json(F.expr(expr)).alias("row"))


ALTERNATIVES_SQL = f"""(SELECT event_id, replace(t.fullkey, '$', '$.ledger_row') AS path, t.atom AS atom, CAST(t.value AS VARCHAR) AS value FROM {LEDGER_SQL}, json_tree(j) t
  WHERE regexp_matches(lower(t.key), 'alternative|reject') AND NOT regexp_matches(lower(t.path), 'alternative|reject'))"""


@check("k1_alternative_fields", f"SELECT event_id, path, value FROM {ALTERNATIVES_SQL}")
def k1(spark, sf):
    return ledger.alternative_fields(ledger_rows(spark, sf), ["event_id"], "row", root="$.ledger_row")


@check(
    "k2_key_profile",
    f"""SELECT key, CASE type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'NULL' THEN 'VOID' ELSE type END AS kind, count(*) AS n
    FROM {LEDGER_SQL}, json_each(j) GROUP BY ALL""",
)
def k2(spark, sf):
    return ledger.key_profile(ledger_rows(spark, sf), "row")


_BODY = """'{"cust":' || o_custkey || ',"head":{"id":' || o_orderkey || '},"status":"' || o_orderstatus || '"}' || chr(10)"""


@check(
    "k3_receipt_check",
    f"""SELECT o_orderkey, keys_ok, observed, claimed, keys_ok AND observed = claimed AS pass FROM (SELECT o_orderkey, o_orderkey % 7 <> 0 AS keys_ok,
      upper(sha256({_BODY})) AS observed, upper(sha256(CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE {_BODY} END)) AS claimed FROM orders)""",
)
def k3(spark, sf):
    body = F.concat(
        F.lit('{"cust":'), F.col("o_custkey").cast("string"), F.lit(',"head":{"id":'), F.col("o_orderkey").cast("string"),
        F.lit('},"status":"'), F.col("o_orderstatus"), F.lit('"}\n'),
    )
    claim = F.upper(F.sha2(F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")).otherwise(body), 256))
    extra = F.when(F.col("o_orderkey") % 7 == 0, F.lit(',"stray":1')).otherwise("")
    text = F.concat(
        F.lit('{"status":"'), F.col("o_orderstatus"), F.lit('","head":{"sha256":"'), claim, F.lit('","id":'),
        F.col("o_orderkey").cast("string"), F.lit('},"cust":'), F.col("o_custkey").cast("string"), extra, F.lit("}"),
    )
    receipts = table(spark, sf, "orders").select("o_orderkey", F.parse_json(text).alias("receipt"))
    shape = {"cust": None, "head": {"id": None, "sha256": None}, "status": None}
    return ledger.receipt_check(receipts, "receipt", shape, "$.head.sha256").drop("receipt")


@check(
    "k5_append_only",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 501 = 0 THEN 'REMOVED' ELSE 'CHANGED' END AS violation FROM orders WHERE o_orderkey % 501 = 0 OR o_orderkey % 500 = 0
    UNION ALL SELECT -o_orderkey - 1, 'INSERTED' FROM orders WHERE o_orderkey % 997 = 0""",
)
def k5(spark, sf):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    o = table(spark, sf, "orders").select(*cols)
    digest = fx.sha256_upper(F.to_json(F.struct(*cols)))
    old = o.withColumn("digest", digest)
    new = o.where("o_orderkey % 501 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 500 == 0, "?").otherwise(F.col("o_orderstatus"))
    )
    appended = o.withColumn("o_orderkey", F.col("o_orderkey") + 10**12)
    inserted = o.where("o_orderkey % 997 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    new = new.unionByName(appended).unionByName(inserted).withColumn("digest", digest)
    return ledger.append_only_violations(old, new, "o_orderkey", "digest")


@check(
    "k6_member_manifest",
    """SELECT url AS path, upper(sha256(html)) || chr(9) || strlen(html) || chr(9) || url AS line FROM pages""",
)
def k6(spark, sf):
    from corpusgate.operators.digests import member_manifest

    return member_manifest(identity.identity_table(table(spark, sf, "pages"), F.col("url"), F.col("html")))


@check(
    "k7_pin_records",
    f"""SELECT event_id, '$.pins[0]' AS at, 'p/' || event_type AS path, event_id AS bytes, 'AB' AS sha256 FROM events WHERE event_id % 11 = 4
    UNION ALL SELECT event_id, '$.pins[1].in', 'q', 1, 'CD' FROM events WHERE event_id % 11 = 4""",
)
def k7(spark, sf):
    return ledger.pin_records(ledger_rows(spark, sf), ["event_id"], "row")


@check(
    "a18_ledger_summary",
    f"""SELECT count(*) AS decisions, count(f) AS decisions_with_fields, coalesce(sum(f), 0)::BIGINT AS fields,
      count(*) FILTER (event_id % 2 > 0) AS decisions_with_companions
    FROM events LEFT JOIN (SELECT event_id, count(*) AS f FROM {ALTERNATIVES_SQL} GROUP BY event_id) USING (event_id)""",
)
def a18(spark, sf):
    rows = ledger_rows(spark, sf).withColumn("companions", F.col("event_id") % 2)
    return ledger.ledger_summary(rows, "event_id", "row", "companions")


@check(
    "f27_source_change_declared",
    f"""SELECT event_id, event_id % 11 IN (1, 4, 5, 6, 8)
      OR (event_id % 11 = 2 AND coalesce(j ->> '$.source_change', '') <> '')
      OR coalesce(len(list_filter(json_keys(j, '$.result'), lambda k: contains(lower(k), 'source'))) > 0, false) AS declared FROM {LEDGER_SQL}""",
)
def f27(spark, sf):
    return ledger_rows(spark, sf).select("event_id", ledger.source_change_declared(F.col("row")).alias("declared"))


@check(
    "s7_sinks",
    """SELECT unnest(['json', 'jsonl', 'tsv']) AS sink, count(*) AS rows, true AS pass FROM orders""",
)
def s7(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    root = scratch_dir(spark)
    sinks.write_json(d, f"{root}/json")
    sinks.write_jsonl(d, f"{root}/jsonl")
    sinks.write_tsv(d, f"{root}/tsv")
    schema = d.schema
    back = {
        "json": spark.read.schema(schema).json(f"{root}/json"),
        "jsonl": spark.read.schema(schema).json(f"{root}/jsonl"),
        "tsv": spark.read.schema(schema).option("header", "true").csv(f"{root}/tsv", sep="\t"),
    }
    out = None
    for name, b in back.items():
        g = sinks.verify_written(d, b).select(F.lit(name).alias("sink"), F.col("written_rows").alias("rows"), "pass")
        out = g if out is None else out.unionByName(g)
    return out


@check(
    "s8_write_once",
    "SELECT unnest([1, 2, 3]) AS step, unnest(['WRITTEN', 'IDENTICAL', 'REFUSED']) AS outcome, count(*) AS rows FROM orders",
)
def s8(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    target = scratch_dir(spark)
    outcomes = [sinks.write_once(d, target), sinks.write_once(d.repartition(3), target)]
    try:
        outcomes.append(sinks.write_once(d.withColumn("o_orderstatus", F.lit("?")), target))
    except sinks.OverwriteRefused:
        outcomes.append("REFUSED")
    written = spark.read.parquet(target)
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(o).alias("outcome")) for i, o in enumerate(outcomes, 1)])
    return written.agg(F.count("*").alias("rows")).select(F.inline(steps), "rows")


@check(
    "s9_read_back",
    """SELECT count(*) AS expected_rows, count(*) AS written_rows, true AS pass FROM documents
    UNION ALL SELECT count(*), count(*) FILTER (doc_id % 3 <> 0), false FROM documents""",
)
def s9(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    target = scratch_dir(spark)
    d.write.parquet(target)
    back = spark.read.parquet(target)
    return sinks.verify_written(d, back).unionByName(sinks.verify_written(d, back.where("doc_id % 3 <> 0")))
