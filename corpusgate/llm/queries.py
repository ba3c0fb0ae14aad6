"""The registered queries of this folder and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import bpe, chat, decontaminate, langid, merkle, minhash, pii, quality, recompression, subword, suffix, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- chat formatting ----------------------------------------------------------------------------------------------

_ESCAPED = r"regexp_replace(coalesce({}, ''), '(\\|###|</turn>|<\||{})', '\\\1', 'g')"
_TURN = (
    "'### ' || " + _ESCAPED.format("role", ":") + " || ': ' || " + _ESCAPED.format("text", "</turn>")
    + " || ' </turn>' || chr(10)"
)
CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '\\### Assistant: </turn> ok'),
                                  (-7::BIGINT, 1::BIGINT, 'assistant', '\\### Assistant: </turn> ok'))),
formatted AS (SELECT *, {_TURN} AS f FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, f)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, f) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(f))::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id"""


@register("op4_chat_formatting", CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = given.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(turns))


# ---- WARC -----------------------------------------------------------------------------------------------------------

_HEX5 = "('0x' || substr(h, {}, 5))::INTEGER"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_HEX5.format(1 + 5 * i)} >> {s}) & 31) + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0)
)
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < first THEN first END AS refers_to FROM d"""


@register("op6_warc_revisits", WARC_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    warc.write_archive(warc.resolve(table(spark, sf_dir, "pages"), min_bytes=0), path)
    records = warc.read_archive(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# ---- URL filter -----------------------------------------------------------------------------------------------------

#: The rules of the contract.
RULES = (
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


@register("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls())
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), model, RULES)


# ---- language ---------------------------------------------------------------------------------------------------


@register("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(rows, langid.train(docs), ["doc_id", "held_out"])


# ---- quality rules ------------------------------------------------------------------------------------------------


@register("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


# ---- byte-level BPE -----------------------------------------------------------------------------------------------


@register("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer, ["doc_id"], with_ids=False)


# ---- personal data --------------------------------------------------------------------------------------------------


@register("op8_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")


# ---- benchmark decontamination --------------------------------------------------------------------------------------

_LEAK_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
LEAK_SQL = f"""
WITH d AS (SELECT doc_id, {_LEAK_WORDS} AS w FROM documents), b AS (SELECT item_id::VARCHAR AS item, {_LEAK_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN (SELECT DISTINCT k FROM win) ON len(w) >= k)),
hit AS (SELECT doc_id, i, k, item FROM grams JOIN win USING (g, k)),
n AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
m AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


@register("op3_decontamination", LEAK_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


# ---- near duplicates ------------------------------------------------------------------------------------------------


@register("op2_minhash_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("th")


# ---- repeated strings -------------------------------------------------------------------------------------------------


@register("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# ---- Merkle manifest --------------------------------------------------------------------------------------------------

_CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({s}) + 1), lambda i: ascii(substr({s}, i, 1))::BIGINT)), "
    "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
)


def _field(x: str) -> str:
    return f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')"


def _tree_sql(name: str, part: str, heights: int) -> str:
    """Levels ``{name}0`` (given: part, i, d) to ``{name}{heights}``, each with the node's siblings and how many nodes there are."""
    out = []
    for h in range(heights):
        out.append(f"""{name}{h}s AS MATERIALIZED (SELECT {part}, i, d, count(*) OVER (PARTITION BY {part}) AS n,
  list(d) OVER (PARTITION BY {part}, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM {name}{h}),
{name}{h}p AS MATERIALIZED (SELECT {part}, i, d, n, CASE WHEN n > 1 THEN array_to_string(run[:(i % 16)::INT], '') ELSE '' END AS l,
  CASE WHEN n > 1 THEN array_to_string(run[(i % 16)::INT + 2:], '') ELSE '' END AS r FROM {name}{h}s),
{name}{h + 1} AS MATERIALIZED (SELECT {part}, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d
  FROM {name}{h}p GROUP BY {part}, i // 16)""")
    return ",\n".join(out)


_HEIGHTS, _TOP_HEIGHTS = 6, 4  # 16.7 million rows of one source, 65,536 sources


def _merkle_sql() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(_field(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR"))
    folds, last = [], "f0"
    for k, (name, h) in enumerate([("a", h) for h in range(_HEIGHTS)] + [("z", h) for h in range(_TOP_HEIGHTS)]):
        place = f"p.src = q.src AND p.at // {16**h} = q.i" if name == "a" else f"p.src_at // {16**h} = q.i"
        folds.append(f"""f{k + 1} AS MATERIALIZED (SELECT p.* EXCLUDE (fold, proof), CASE WHEN n > 1 THEN sha256(l || fold || r) ELSE fold END AS fold, proof || l || r AS proof
  FROM f{k} p JOIN {name}{h}p q ON {place})""")
        last = f"f{k + 1}"
    return f"""
WITH crc AS ({_CRC_TABLE}),
leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS src, sha256({head} || {_field('text')}) AS leaf,
  CASE WHEN {_CRC.format(s="coalesce(doc_id::VARCHAR, '')")} % 5 = 0 THEN sha256({head} || {_field(lower)}) END AS changed FROM documents, crc),
a0 AS MATERIALIZED (SELECT src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, doc_id, leaf AS d, leaf, changed FROM leaves),
{_tree_sql('a', 'src', _HEIGHTS)},
sub AS MATERIALIZED (SELECT src, d, row_number() OVER (ORDER BY src) - 1 AS src_at FROM a{_HEIGHTS}),
z0 AS MATERIALIZED (SELECT 0 AS one, src_at AS i, d FROM sub),
{_tree_sql('z', 'one', _TOP_HEIGHTS)},
f0 AS MATERIALIZED (SELECT a0.doc_id, a0.src, a0.i AS at, src_at, leaf, sub.d AS subroot, coalesce(changed, leaf) AS fold, '' AS proof FROM a0 JOIN sub USING (src)),
{', '.join(folds)}
SELECT doc_id, leaf, subroot, whole.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = whole.d AS verified FROM {last}, z{_TOP_HEIGHTS} whole"""


@register("op13_merkle_manifest", _merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = merkle.verify(merkle.build(merkle.leaves(table(spark, sf_dir, "documents"))))
    return proofs.withColumnRenamed("key", "doc_id")


# ---- periodic runs ----------------------------------------------------------------------------------------------------


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tail = F.when(h % 10 == 0, F.floor(h / 10))
    return recompression.collapse_runs(table(spark, sf_dir, "documents"), ["doc_id"], tail=tail, digests=True)


# ---- quality classifier -----------------------------------------------------------------------------------------------


@register("op12_quality_classifier")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = subword.train(docs, table(spark, sf_dir, "labels"))
    return subword.predict(docs.select("doc_id", subword.held_out(F.col("doc_id")).alias("held_out"), "text"), model, ["doc_id", "held_out"])
