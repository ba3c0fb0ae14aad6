"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from corpusgate.llm import bpe, chat, columns, decontaminate, langid, minhash, pii, quality, suffix, url_filter, warc
from corpusgate.session import scratch_dir

from . import plain

BENCH = "item_id long, text string, kept string"


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


# ---- suffix arrays ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("symbols", [1, 2, 4, 300])
def test_suffix_array_orders_all_suffixes(symbols):
    rng = random.Random(symbols)
    for n in (0, 1, 2, 3, 4, 5, 6, 7, 50, 200):
        s = np.array([rng.randint(1, symbols) for _ in range(n)], np.int64)
        assert suffix.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_packed_keeps_the_order_of_large_numbers():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 1 << 40, 500) for _ in range(3))
    a[:250] = a[250:]
    rows = list(zip(a.tolist(), b.tolist(), c.tolist(), strict=True))
    assert np.argsort(suffix._packed(a, b, c)).tolist() == sorted(range(500), key=lambda i: rows[i])


def test_repeats_on_hard_texts(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcd ") for _ in range(120))
    texts = [passage, passage[10:70], "zz" + passage[30:] + "q", "a" * 400, "b" + "a" * 60, "ab" * 90, passage + passage, "", "short", "\u00e9" * 40, "x\u00e9" * 20 + "\u00e9" * 30]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) + texts[rng.randrange(7)][: rng.randint(0, 130)] for _ in range(60)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("start", F.lit("?")).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, plain.sha(bytes(r.kept))) for r in suffix.remove_repeats(df).collect()}
    assert got == plain.repeats(docs)


def test_a_common_phrase_is_in_no_task_whole(spark, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_BYTES", 1500)
    largest, whole = [], suffix.smallest_keys

    def watched(distinct, length):
        largest.append(distinct.groupBy("m").agg(F.sum(F.octet_length("frag")).alias("n")).agg(F.max("n")).first()[0] or 0)
        return whole(distinct, length)

    monkeypatch.setattr(suffix, "smallest_keys", watched)
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, tails = some(45), [some(40) for _ in range(5)]
    docs = [(i, some(60) + phrase + rng.choice([*tails, some(30)])) for i in range(80)] + [(80, "a" * 300), (81, "ba" * 90 + "a" * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, plain.sha(bytes(r.kept))) for r in suffix.remove_repeats(df).collect()}
    assert got == plain.repeats(docs) and sum(x[1] for x in got.values()) > 1000
    assert max(largest) <= 1500


def test_repeats_on_odd_rows(odd_docs, no_docs):
    got = by_id(suffix.remove_repeats(odd_docs))
    assert sum(map(len, got.values())) == odd_docs.count()
    assert got[1][0].n_bytes == got[2][0].n_bytes == 0 and not got[4][0].n_removed
    assert [r.n_removed for r in got[5]] == [got[5][0].n_bytes] * 2
    assert {r.n_removed == r.n_bytes for r in got[None]} == {True}  # a null key is the largest
    assert suffix.remove_repeats(no_docs).count() == 0


# ---- near duplicates ----------------------------------------------------------------------------------------------


def test_every_coordinate_fills_and_estimates():
    texts = [b"one", b"a b c d e f", " ".join(map(str, range(40))).encode(), " ".join(map(str, range(3000))).encode()]
    h, sizes = minhash.shingle_sets(texts)
    assert sizes.tolist() == [1, 2, 36, 2996]
    s = minhash.sketches(h, sizes)
    assert not (s == np.uint64(0xFFFFFFFFFFFFFFFF)).any() and (s[3] >> np.uint64(32)).max() <= 3
    x, y = " ".join(map(str, range(1000))), " ".join(map(str, range(100, 1100)))
    h, sizes = minhash.shingle_sets([x.encode(), y.encode()])
    s = minhash.sketches(h, sizes)
    assert abs((s[0] == s[1]).mean() - 896 / 1096) < 0.15


def test_near_components_with_chains_and_large_groups(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    docs, chain = [], list(words)
    for i in range(40):  # each a small step from the last: linked in a chain, the ends far apart
        docs.append((i, " ".join(chain)))
        chain[rng.randrange(120)] = f"c{i}"
    for i in range(40, 120):  # variants of one base
        v = list(words[::-1])
        v[rng.randrange(120)] = f"v{i}"
        docs.append((i, " ".join(v)))
    docs += [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 30)))) for i in range(120, 180)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == plain.near_components(docs)


def test_a_link_without_a_common_band_is_found(spark):
    x = " ".join(f"w502x{j}" for j in range(7))
    docs = [(1, x), (2, x + " w502x7"), (3, "something else entirely")]  # similarity 3/4, and no band in common
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_signatures_decide_nothing(spark, monkeypatch):
    monkeypatch.setattr(minhash, "alike", lambda least: "false")
    monkeypatch.setattr(minhash, "BUCKET_SHINGLES", 50)
    rng, docs = random.Random(3), []
    for g in range(30):
        words = [f"w{g}x{rng.randrange(40)}" for _ in range(rng.choice([3, 7, 8, 20, 60, 300]))]
        for _ in range(6):
            v = list(words)
            for _ in range(rng.randrange(1 + len(v) // 20)):
                v[rng.randrange(len(v))] = f"v{rng.randrange(3)}"
            docs.append((len(docs), " ".join(v[rng.randrange(2) :] + ["end"] * rng.randrange(2))))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got == plain.near_components(docs) and len({c for _, c in got.values()}) < 120


def test_strays_of_a_group_are_not_all_verified_against_it(spark, monkeypatch):
    rng, verified, whole = random.Random(11), [], minhash.verify

    def watched(pairs, sets, least):
        verified.append(pairs.count())
        return whole(pairs, sets, least)

    monkeypatch.setattr(minhash, "verify", watched)
    base, docs = [f"w{i}" for i in range(60)], []
    for i in range(240):  # each shares two thirds to nine tenths of its shingles with the base, and less with most others
        v = list(base)
        for at in rng.sample(range(12), rng.choice([1, 1, 2, 3])):
            v[at * 5] = f"v{i}x{at}"
        docs.append((i, " ".join(v)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert got == plain.near_components(docs) and len({c for _, c in got.values()}) > 10
    assert sum(verified) < 10 * len(docs)


def test_a_set_is_named_once_where_its_shingles_are_counted(spark, monkeypatch):
    """The rows of the last turn: one pair of alike sets meets in few of the buckets that it shares."""
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[: 100 + i] + [f"v{i}"] + words[101 + i :])) for i in range(6)]
    named = spark.createDataFrame(docs, "doc_id long, text string")
    h, sizes = minhash.shingle_sets([t.encode() for _, t in docs])
    names = minhash._names(*minhash._digests(h, sizes), sizes).tolist()
    t = np.bincount(minhash._short(h, sizes)[1]).tolist()
    sets = spark.createDataFrame([(names[i], i, int(sizes[i]), t[i]) for i in range(6)], "name long, node long, n long, t long")
    rows = {r.node: r.rare for r in minhash.rare_shingles(named, sets, int(sizes.sum()), (75, 100)).collect()}
    assert set(rows) == set(range(6))
    for x in rows:
        for y in rows:
            if x < y:
                shared = {r.bucket for r in rows[x]} & {r.bucket for r in rows[y]}
                mine, theirs = ({r.bucket: r for r in rows[d]} for d in (x, y))
                first = [b for b in shared if mine[b].before is None or mine[b].before != theirs[b].before]
                assert shared and 1 <= len(first) < len(shared) / 2
                assert min(shared, key=lambda b: mine[b].at) in first


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100}


def test_near_duplicates_on_odd_rows(odd_docs, no_docs):
    got = by_id(minhash.near_duplicates(odd_docs))
    assert sum(map(len, got.values())) == odd_docs.count()
    assert [(r.component_id, r.kept) for r in got[5]] == [(4, False)] * 2 and got[4][0].kept and got[6][0].component_id == 4
    assert all(r.kept and r.component_id is None for r in got[None])
    assert got[1][0].n_shingles == 0 and got[1][0].kept and got[13][0].component_id == 12
    assert minhash.near_duplicates(no_docs).count() == 0


# ---- decontamination ----------------------------------------------------------------------------------------------


def test_leaks_against_plain(spark):
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "caf\u00e9", "x1", "rare", "words", "here", "na\u00efve", "\u00c9t\u00e9"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)] + [(99, None), (100, "the the the the the the the the the the the")]
    docs = [(i, "-".join(rng.choice(vocabulary) for _ in range(40)) + " " + (items[rng.randrange(12)][1] or "") + "." + rng.choice(["", "the " * 15])) for i in range(60)]
    bench = spark.createDataFrame([(*r, "?") for r in items], BENCH)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("gram", F.lit("?")).repartition(3)
    windows = plain.item_windows(items)
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.mark_documents(df, bench).collect()}
    assert got == {d: plain.leaks(t, windows) for d, t in docs}


def test_leaks_on_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog while seven wizards", "?"), (2, "short", "?"), (None, "a a", "?")], BENCH)
    got = by_id(decontaminate.mark_documents(odd_docs, bench))
    assert sum(map(len, got.values())) == odd_docs.count()
    assert [list(r["items"]) for r in got[5]] == [["1"]] * 2 and got[12][0].n_hit == 1 and not got[1][0].n_words
    assert sorted(r.n_hit for r in got[None]) == [0, 11] and not got[14][0].contaminated  # an item without a key is none
    assert decontaminate.mark_documents(no_docs, bench).count() == 0
    assert not decontaminate.mark_documents(odd_docs, bench.limit(0)).where("contaminated").count()


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma", "?")], BENCH)
    docs = spark.createDataFrame([(1, "gamma x x alpha x beta"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "alpha beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    found = decontaminate.proximity_matches(decontaminate.keyed(docs), decontaminate.item_windows(items), within=8).collect()
    assert sorted((r._doc, r.first, r.last) for r in found) == [(1, 0, 5), (3, 0, 2)]


# ---- chat -----------------------------------------------------------------------------------------------------------


def test_control_strings_and_parts_survive(spark):
    texts = ["\\### Assistant: </turn> ok", "####", "a </turn>\n### user: b", "<|image 1|>", "\\", "", None, "x" * 50_000]
    rows = [(c, t, role, text) for c in (1, None) for t, (role, text) in enumerate([("us:er\\", x) for x in texts] + [("assistant", x) for x in texts])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_part(F.col("text")))
    formatted = chat.format_turns(df)
    order = formatted.where("conv_id = 1").orderBy("turn").collect()
    assert list(chat.parse_turns("".join(r.formatted for r in order))) == [(role, text or "") for c, _, role, text in rows if c == 1]
    back = chat.read_back(formatted.repartition(3)).collect()
    assert len(back) == 2 and {r.n_turns for r in back} == {16}
    assert {r.loss_sha256 for r in back} == {plain.sha("".join(x or "" for x in texts))}
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_attachments(spark):
    part = T._parse_datatype_string(chat.PART_TYPE)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("parts", T.ArrayType(part))])
    parts = [("text", "see <|", None, None, None, None, None), ("image", None, "i.png", 1024, 513, None, None), None, ("audio", None, "a.wav", None, None, 2.0, None), ("document", None, "d.pdf", None, None, None, 3)]
    r = chat.format_turns(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", None)], schema)).orderBy("turn").collect()
    assert r[0].formatted == "### user: see \\<|<|image 1|><|audio 2|><|document 3|> </turn>\n"
    assert [(a.slot, a.uri, a.tokens) for a in r[0].attachments] == [(1, "i.png", 680), (2, "a.wav", 50), (3, "d.pdf", 1800)]
    assert r[0].expanded_tokens == 2530 and r[1].formatted == "### user:  </turn>\n"


# ---- language -----------------------------------------------------------------------------------------------------


def test_language_on_odd_rows(odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = by_id(langid.predict(odd_docs, model, ["doc_id", "a.b"], names=("label", "p")))
    assert sum(map(len, got.values())) == odd_docs.count()
    assert {got[i][0].label for i in (1, 2, 3, 9)} == {langid.UNKNOWN} and got[4][0].label in model.labels
    assert langid.train(no_docs) is None
    assert {r.lang_pred for r in langid.predict(odd_docs, None, ["doc_id"]).collect()} == {langid.UNKNOWN}
    assert langid.predict(no_docs, model, ["doc_id"]).count() == 0


def test_windows_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 1000):
        text = bytes(1 + i % 255 for i in range(n))
        w = langid.windows_of(text)
        assert w.tobytes().rstrip(b"\0") == text and len(w) == max(1, -(-n // 256))


# ---- WARC -----------------------------------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\nabc"
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", tricky), (6, "u", "\u00e9" * 70_000), (7, "u", tricky), (None, "u", "same"), (8, "u", "one"), (8, "u", "one")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("?"))
    path = scratch_dir(spark)
    warc.write_archive(warc.resolve(pages), path)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    body = {r.page_id: bytes(r.payload).decode() for r in got if r.payload is not None}
    assert body == {2: "same", 4: "", 6: "\u00e9" * 70_000, 7: tricky, 8: "one"}
    assert {(r.page_id, r.refers_to) for r in got if r.record_type == "revisit"} == {(1, 2), (None, 2), (3, 4), (5, 7)}
    large = warc.resolve(pages, min_bytes=5).where("refers_to IS NOT NULL").collect()
    assert [r.page_id for r in large] == [5]
    empty = scratch_dir(spark)
    warc.write_archive(warc.resolve(pages.limit(0)), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_broken_archives_are_refused():
    whole = "WARC/1.1\r\nContent-Length: 4\r\n\r\nabcd".encode()
    assert list(warc.whole_records(whole.split(b"\r\n\r\n"))) == [whole]
    for pieces in ([b"junk"], [b"WARC/1.1\r\nContent-Length: 9", b"abc"], [b"WARC/1.1\r\nContent-Length: 1", b"abc"]):
        with pytest.raises(ValueError):
            list(warc.whole_records(pieces))


# ---- BPE ------------------------------------------------------------------------------------------------------------


def test_encoder_against_the_reference_library():
    own, encoding = plain.tokenizer()
    rng = random.Random(5)
    alphabet = "ab'stre \t\n\x0b\x1c\x1f\x85\xa0\u180e\u200b\u3000\u00e9\u00c0\u00d7\u00f7\u00df\u00ff\u540d\u524d0\u0663\u00bd\u00b2\u00aa\u00ba!#\r\U0001f600\u0301lvdm"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += ["a" * 5000, "xq" * 2000, "".join(rng.choice("abcdefgh") for _ in range(900)), "\u540d\u524d" * 200, " ".join(["the"] * 500)]
    known = bpe.WordTable(own)
    for t in texts:
        words = own.split(t)
        known.learn(set(words))
        assert " ".join(known.ids[w] for w in words) == " ".join(map(str, encoding.encode_ordinary(t)))
        assert b"".join(known.bytes[w] for w in words) == t.encode()


def test_vocabulary_allows_equal_pairs_to_be_contracted_together():
    """Every token is built by contractions of rising rank, the last being its own."""
    own, _ = plain.tokenizer()
    rng = random.Random(2)
    for token, rank in rng.sample(sorted(own.ranks.items()), 3000):
        parts, last = [bytes([b]) for b in token], -1
        while len(parts) > 1:
            best, i = min((own.ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
            assert last <= best < 1 << 30
            parts[i : i + 2], last = [parts[i] + parts[i + 1]], best
        assert len(token) == 1 or last == rank


def test_bpe_on_odd_rows(odd_docs, no_docs):
    own, encoding = plain.tokenizer()
    for r in bpe.encode(odd_docs, own, ["doc_id", "text", "a.b"]).collect():
        assert r.ids == " ".join(map(str, encoding.encode_ordinary(r.text or ""))) and bytes(r.decoded) == (r.text or "").encode()
        assert r.n_tokens == len(r.ids.split())
    assert bpe.encode(no_docs, own, ["doc_id"]).count() == 0


# ---- personal data ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("alphabet", ["ab.@-_ 1", "0123456789.- +()", "+1 2.()-9", "12a@.\u00e9"])
def test_base_spans_against_plain(alphabet):
    rng = random.Random(alphabet)
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
        assert pii.base_spans(t) == plain.base_spans(t)


def test_span_model_on_made_clusters():
    model = pii.trained_model()
    rows = pii.training_clusters(300, seed=99)
    assert np.mean([model.decode(c, q) == gold for c, q, gold in rows]) > 0.95


def test_decoding_finds_the_best_segmentation():
    """Against every segmentation of small clusters."""
    rng = np.random.default_rng(3)
    model = pii.SpanModel(rng.normal(0, 2, (len(pii.KINDS), pii.N_FEATURES)))
    for text in ("(269) 555-3296", "+1 (269) 555-3296 4524", "a@b.c.d", "1234567-7654321"):
        n, found = pii.candidates(text)
        scores = [float(s.max()) for s in model.scores(text, None, found)]

        def best(i, found=found, scores=scores, n=n):
            return 0.0 if i == n else max([best(i + 1), *(s + best(c.last) for c, s in zip(found, scores, strict=True) if c.first == i)])

        total = sum(float(model.weights[pii.KINDS.index(k), pii._held(text, c, None)].sum()) for a, b, k in model.decode(text, None) for c in found if (c.start, c.end) == (a, b))
        assert total == pytest.approx(best(0))


def test_scans_are_linear():
    model = pii.trained_model()
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 50_000, "+1 " * 50_000, "." * 100_000 + "@"):
        pii.find_spans(text, model)


def test_redaction_on_odd_rows(odd_docs, no_docs):
    got = by_id(pii.redact(odd_docs))
    assert got[1][0].text is None and got[2][0].text == "" and got[11][0].text == "[EMAIL] and [PHONE] [CARD] on [IP]"
    assert got[7][0].text == by_id(odd_docs)[7][0].text and pii.redact(no_docs).count() == 0
    found = by_id(pii.personal_data(odd_docs, ["doc_id", "a.b"]))
    assert found[1][0].spans == "" and found[11][0].n_phone == 0 and "phone:25:42" in found[11][0].spans


# ---- URLs -----------------------------------------------------------------------------------------------------------


def test_urls(spark):
    model = url_filter.train(url_filter.labelled_urls())
    rules = (url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"))
    urls = [None, "", "no scheme", "HTTP://WWW.Example.ORG/es/1?q#f", "http://example.org", "http://notexample.org?x=/es/", "a://b://c/d", "x" * 100_000 + "://h/p", "http://casino-win.example.com/en/3", "http://\u00c9.org#/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("?"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, model, rules).collect()}
    assert {got[i] for i in (0, 1, 2)} == {("", "", None, "allow")}
    assert got[3] == ("www.example.org", "/es/1", "example.org/es/", "block") and got[4][:3] == ("example.org", "", None)
    assert got[5][:2] == ("notexample.org", "") and got[6][:2] == ("b:", "//c/d") and got[7][:2] == ("h", "/p")
    assert got[8][3] == "block" and got[9][:2] == ("\u00c9.org", "")
    assert url_filter.judge_urls(df.limit(0), model, rules).count() == 0


# ---- quality --------------------------------------------------------------------------------------------------------


def test_quality_on_odd_rows(odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    got = by_id(quality.judge(odd_docs, ["doc_id"]))
    assert sum(map(len, got.values())) == odd_docs.count()
    for d, t in texts.items():
        assert {(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got[d]} == {plain.measures(t)}
    assert got[1][0].base_failed and got[14][0].base_failed and got[4][0].kept
    assert quality.judge(no_docs, ["doc_id"]).count() == 0


def test_votes_recover_planted_accuracies(spark):
    """Texts whose class is known: rules that find a fifth to three fifths of the bad ones, and err on few good ones."""
    rng = random.Random(1)
    rates = {"a": (0.02, 0.6), "b": (0.01, 0.5), "c": (0.05, 0.4), "d": (0.02, 0.5)}
    rows = []
    for _ in range(4000):
        bad = rng.random() < 0.2
        rows.append((bad, *(-1 if rng.random() < p[bad] else 1 for p in rates.values())))
    rules = [quality.VotingRule(n, "false", "true") for n in rates]
    df = spark.createDataFrame(rows, ["bad", *(f"_v_{n}" for n in rates)])
    model = quality.estimate(df.groupBy(*(f"_v_{n}" for n in rates)).count().withColumnRenamed("count", "n"), rules)
    assert abs(model.good - 0.8) < 0.06
    for n, (alarm, found) in rates.items():
        assert abs(model.given[n][-1][0] - alarm) < 0.04 and abs(model.given[n][-1][1] - found) < 0.12


# ---- shared -----------------------------------------------------------------------------------------------------------


def test_columns(spark):
    import base64
    import hashlib

    texts = ["", "abc", "\u00c9T\u00c9 ABC", "I\u0130"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", columns.base32_sha1(F.col("t").cast("binary")).alias("d"), columns.ascii_lower(F.col("t")).alias("low")).collect()
    for r in rows:
        assert r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode() and r.low == r.t.translate(plain.LOWER)


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.count() >= 0


def test_the_language_stage_sends_no_column_back_from_python(spark):
    """Only the verdict comes back; texts without a letter and null texts go, as in the prediction."""
    from corpusgate.llm import langid

    docs = spark.createDataFrame(
        [(i, "the house is old and the water is cold" if i % 2 else "das Haus ist alt und das Wasser kalt", "en" if i % 2 else "de") for i in range(60)]
        + [(60, None, "en"), (61, "12 !", "de")], "doc_id bigint, text string, lang string")
    model = langid.train(docs)
    kept = langid.keep_known(docs, model)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    want = langid.predict(docs, model, ["doc_id"]).where(f"lang_pred <> '{langid.UNKNOWN}'")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in want.collect()} == set(range(60))
    assert kept.columns == docs.columns and langid.keep_known(docs, None).count() == 0
