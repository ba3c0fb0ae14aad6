"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

The test items are cut into windows of consecutive words.  Each window is looked up by its rarest terms: postings
(term, document, position) of those terms are stored for the whole corpus, every posting is moved back by the term's offset in
the window, and a start that all of the window's lists agree on is a candidate, which is then compared word by word.
``phrase_matches`` returns the exact occurrences, ``proximity_matches`` the places where a window's rarest terms stand
close together in any order, and ``mark_documents`` the words that any occurrence covers.

What is shuffled: counts of the items' terms, postings of rare terms, candidates.  Texts are joined to candidates only where
Spark finds the list of their keys small; the hot side of each join has one row per occurrence and the other side one per
term or document, so that skew handling can split it.  Windows that use a word the corpus lacks are dropped before.

A null text or item has no words.  A document is a pair of key and text: rows that repeat both get the same result; rows with a
null key are told apart by their text.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.projection import materialise
from .columns import ascii_lower

#: Fixed value of the contract: what stands between words, after A-Z have been lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["_doc", "_text_hash"]


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN), lambda w: w != "")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` and the pair of columns that names a document."""
    body = F.col(text).cast("string")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"), body.alias("text"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("_doc"),
        F.xxhash64(name, F.coalesce(body, F.lit(""))).alias("_text_hash"),
    )


def item_windows(items: DataFrame, size: int = 10, *, key: str = "item_id", text: str = "text") -> DataFrame:
    """``gram`` (array of words) and ``items`` (the keys that hold it): one row per distinct window."""
    cut = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("w")).where("item IS NOT NULL AND size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    grams = cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items"))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "term"))


def rarest_terms(docs: DataFrame, windows: DataFrame, lists: int = 3) -> DataFrame:
    """``gram, items, anchors``: the offsets and terms of the ``lists`` rarest places of each window that can occur at all."""
    places = windows.select("gram", "items", F.posexplode("gram").alias("offset", "term"))
    terms = materialise(places.select("term").distinct())
    counts = materialise(docs.select(F.explode(words(F.col("text"))).alias("term")).join(terms, "term", "left_semi").groupBy("term").count())
    known = places.join(counts, "term").groupBy("gram").agg(
        F.first("items").alias("items"), F.array_sort(F.collect_list(F.struct("count", "offset", "term"))).alias("all"))
    able = known.where(F.size("all") == F.size("gram"))
    return able.select(F.xxhash64("gram").alias("_w"), "gram", "items", F.slice("all", 1, lists).alias("anchors"))


def postings(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """The stored index: positions in every document of every term that some window is looked up by."""
    terms = materialise(anchors.select(F.explode("anchors.term").alias("term")).distinct())
    return materialise(_tokens(docs).join(terms, "term", "left_semi").select(*KEY, "pos", "term"))


def _offsets(anchors: DataFrame) -> DataFrame:
    return anchors.select("_w", F.size("anchors").alias("lists"), F.posexplode("anchors").alias("n", "a")).select(
        "_w", "lists", "n", F.col("a.offset").alias("offset"), F.col("a.term").alias("term"))


def phrase_matches(docs: DataFrame, windows: DataFrame, lists: int = 3) -> DataFrame:
    """``_doc, _text_hash, hits``: starts, lengths and items of every exact occurrence, documents without any left out.

    ``docs`` as from ``keyed``.
    """
    anchors = materialise(rarest_terms(docs, windows, lists))
    # Dealt by document before each posting meets its windows: the starts of a document then agree where they are made.
    index = postings(docs, anchors).repartition(*KEY)
    moved = index.join(_offsets(anchors), "term").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
    agreed = moved.groupBy(*KEY, "start", "_w").agg(
        F.bit_or(F.expr("shiftleft(1, n)")).alias("seen"), F.first("lists").alias("lists"),
    ).where(F.col("seen") == F.expr("shiftleft(1, lists) - 1"))
    found = materialise(agreed.select(*KEY, "start", "_w"))
    keys = materialise(found.select(*KEY).distinct())
    texts = docs.join(keys, KEY, "left_semi").select(*KEY, words(F.col("text")).alias("words")).dropDuplicates(KEY)
    per_doc = found.join(anchors.select("_w", "gram", "items"), "_w").groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "gram", "items")).alias("found"))
    exact = F.filter("found", lambda c: F.slice("words", c["start"] + 1, F.size(c["gram"])) == c["gram"])
    hits = F.transform(exact, lambda c: F.struct(c["start"].alias("start"), F.size(c["gram"]).alias("length"), c["items"].alias("items")))
    return texts.join(per_doc, KEY).select(*KEY, hits.alias("hits")).where(F.size("hits") > 0)


def proximity_matches(docs: DataFrame, windows: DataFrame, within: int = 20, lists: int = 3) -> DataFrame:
    """``_doc, _text_hash, items, first, last``: a window's rarest terms all within so many words, in any order.

    The postings of a document are gathered in overlapping bins of twice the reach, so no list grows with the corpus.
    """
    anchors = materialise(rarest_terms(docs, windows, lists))
    index = postings(docs, anchors)
    lookup = _offsets(anchors).groupBy("_w", "lists", "term").agg(F.count("*").alias("needed"))
    near = index.join(lookup, "term").withColumn("bin", F.explode(F.array(F.floor(F.col("pos") / within), F.floor(F.col("pos") / within) - 1)))
    binned = near.groupBy(*KEY, "_w", "bin").agg(
        F.array_sort(F.collect_set(F.struct("pos", "term", "needed"))).alias("places"), F.first("lists").alias("lists"))
    # From each place on: the places in reach, and how many of each needed term they hold.
    def reach(p):
        return F.filter("places", lambda q: (q["pos"] >= p["pos"]) & (q["pos"] < p["pos"] + within))

    def complete(p):
        seen = reach(p)
        terms = F.array_distinct(F.transform(seen, lambda q: F.struct(q["term"], q["needed"])))
        enough = F.forall(terms, lambda t: F.size(F.filter(seen, lambda q: q["term"] == t["term"])) >= t["needed"])
        total = F.aggregate(terms, F.lit(0).cast("long"), lambda s, t: s + t["needed"])
        return enough & (total == F.col("lists"))

    full = F.filter("places", complete)
    spans = binned.select(*KEY, "_w", F.explode(F.transform(full, lambda p: F.struct(p["pos"].alias("first"), F.element_at(reach(p), -1)["pos"].alias("last")))).alias("s"))
    return spans.select(*KEY, "_w", "s.first", "s.last").distinct().join(anchors.select("_w", "items"), "_w").drop("_w")


def mark_documents(docs: DataFrame, items: DataFrame, *, size: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted keys of items that occur), ``contaminated``, for every document."""
    named = keyed(docs, key, text)
    hits = phrase_matches(named, item_windows(items, size))
    ordered = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"], h["length"]))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(acc, h):
        end = h["start"] + h["length"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(h["start"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    marked = hits.select(
        *KEY, F.aggregate(ordered, zero, cover, lambda acc: acc["n"]).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("items"),
    )
    count = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    out = named.select("doc_id", *KEY, count.alias("n_words")).join(materialise(marked), KEY, "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, *, size: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same columns, without the documents in which any window of an item occurs."""
    hits = materialise(phrase_matches(keyed(docs, key, text), item_windows(items, size)).select(*KEY))
    body = docs[text].cast("string")
    name = F.coalesce(docs[key].cast("string"), F.lit(""))
    doc, text_hash = F.coalesce(docs[key].cast("long"), F.lit(0)), F.xxhash64(name, F.coalesce(body, F.lit("")))
    return docs.join(hits, (doc == hits["_doc"]) & (text_hash == hits["_text_hash"]), "left_anti")
