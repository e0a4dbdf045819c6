"""The corpus operators against plain versions, SQL, round trips and held-out labels."""

from __future__ import annotations

import base64
import itertools
import random
import zlib
from collections import Counter
from hashlib import sha256

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from oracle_compare import compare
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vellumflow.llm import (
    byte_bpe, components, line_rules, parity_join, phrase_index, preference, queries, sharding, site_bayes, suffix_dedup,
    textbytes, token_records, url_filter,
)
from vellumflow.session import scratch

DOCS = "doc_id long, text string"
ODD_TEXTS = [
    None, "", " ", "\n", "a", "A a\n", "  two  blanks\n\nand lines \t ", "x\x1cy !!\x1c z", "don't I'LL\r\n", "日本語 テスト", "ß É é Ü ÿ ª² ×",
    "é 　 \x85 \xa0", "<|endoftext|> <|startoftext|>x", "a" * 5000, "ab " * 3000, "🎉 🎉‍",
]


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def small(spark):
    """Documents of the smallest tables and their (id, text) pairs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()]


@pytest.fixture(scope="module")
def planted():
    """Random prose with exact and near copies, shared passages and odd texts."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    bases = [[word() for _ in range(rng.choice([3, 5, 8, 12, 30, 90, 250]))] for _ in range(40)]
    passage = [word() for _ in range(120)]
    texts = []
    for b in bases:
        texts.append(b)
        for _ in range(rng.randint(0, 6)):
            c = list(b)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(c))
                c[k : k + 1] = rng.choice([[], [word()], [c[k], word()]])
            texts.append(c)
        if rng.random() < 0.5:
            texts.append(b[: len(b) // 2] + passage + b[len(b) // 2 :])
    rows = [" ".join(t) for t in texts] + ODD_TEXTS
    rng.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


# --- names and SQL ------------------------------------------------------------------------


def test_a_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in queries.QUERIES) for k in range(1, 11)] == [1] * 10
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_passages", "decontaminated", "tokens"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, sf, con, name):
    count, difference = compare(queries.QUERIES[name](spark, sf), con, queries.ORACLE[name])
    assert difference is None and count > 0


# --- 1: benchmark decontamination -----------------------------------------------------------


def test_contamination(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = tuples(queries.op1_phrase_index(spark, SF))
    assert got == brute.contamination(small[1], items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_contamination_of_odd_texts(spark, planted):
    items = [(1, "One TWO three"), (2, "two three"), (2, None), (None, "three four"), (10, ""), (3, "a"), (3, "a"), (4, " ".join("abcdefghijklmnop"))]
    docs = [*planted, (None, "x one two, three four"), (900, "one two three one two three"), (900, "a b c d e f g h i j k l m n o p a")]
    got = phrase_index.decontaminate(frame(spark, docs), frame(spark, items, "item_id long, text string"), scratch(spark, "index"))
    assert tuples(got) == brute.contamination(docs, items)


def test_blocks_of_phrases_and_whole_index_agree(spark, planted, monkeypatch):
    items = frame(spark, [(k, t) for k, t in planted[:60]], "item_id long, text string")
    docs = frame(spark, planted)
    want = tuples(phrase_index.decontaminate(docs, items, scratch(spark, "index")))
    monkeypatch.setattr(phrase_index, "BLOCK_PHRASES", 40)
    monkeypatch.setattr(phrase_index, "MAX_VOCABULARY", 10)
    assert tuples(phrase_index.decontaminate(docs, items, scratch(spark, "index"))) == want


def test_proximity(spark):
    docs = [(1, "red green blue"), (2, "red x green blue"), (3, "green red blue"), (4, "red x x x green blue"), (5, "red green")]
    index = phrase_index.build(frame(spark, docs), scratch(spark, "index"))
    phrases = phrase_index.phrases_of(frame(spark, [(9, "red green blue")], "item_id long, text string"))
    assert tuples(phrase_index.matches(index, phrases)) == [(1, 9, 0, 3)]
    assert {r[0] for r in tuples(phrase_index.matches(index, phrases, slop=1))} == {1, 2, 3}


@pytest.mark.parametrize("rarest", [0, 1, 2])
def test_proximity_at_the_edges(spark, rarest):
    phrase = ["red", "green", "blue"]
    orders = [" ".join(p) for n in (3, 4, 5) for p in set(itertools.permutations([*phrase, "x", "x"], n)) if {*phrase} <= {*p}]
    docs = list(enumerate(orders)) + [(1000 + k, w) for k, w in enumerate(phrase) if k != rarest for _ in range(9)]
    index = phrase_index.build(frame(spark, docs), scratch(spark, "index"))
    phrases = phrase_index.phrases_of(frame(spark, [(9, " ".join(phrase))], "item_id long, text string"))
    for slop in (0, 1, 2):
        want = {
            i for i, t in docs for at, w in enumerate(t.split()) if w == phrase[rarest]
            and all(any(v == p and abs(j - (at - rarest + k)) <= slop for j, v in enumerate(t.split())) for k, p in enumerate(phrase))
        }
        assert {r[0] for r in tuples(phrase_index.matches(index, phrases, slop=slop))} == want


def test_empty_tables(spark):
    docs, items = frame(spark, []), frame(spark, [], "item_id long, text string")
    assert tuples(phrase_index.decontaminate(docs, frame(spark, [(1, "a")], "item_id long, text string"), scratch(spark, "index"))) == []
    assert tuples(phrase_index.decontaminate(frame(spark, [(1, "a b")]), items, scratch(spark, "index"))) == [(1, 2, 0, 0, sha256(b"").hexdigest(), False)]
    assert tuples(parity_join.join(docs)) == [] and tuples(suffix_dedup.digests(docs)) == [] and tuples(line_rules.clean(docs)) == []
    assert tuples(byte_bpe.round_trip(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN)) == []
    assert tuples(sharding.shuffle_into_shards(docs, 4, scratch(spark, "shards"), "doc_id")) == []
    folder = scratch(spark, "records")
    assert tuples(token_records.digests(token_records.write(docs, queries.WORD_TOKENIZER, 2, folder), folder)) == []
    labels = frame(spark, [], "doc_id long, quality int, toxic int")
    sited = frame(spark, [], "doc_id long, text string, source string, lang string")
    assert tuples(site_bayes.classify(sited, labels, scratch(spark, "sites"))) == []
    turns, pairs = frame(spark, [], "conv_id long, turn long, role string, text string"), frame(spark, [], "chosen_id long, rejected_id long")
    assert tuples(preference.format_pairs(turns, pairs)) == []
    pages = frame(spark, [], "page_id long, url string")
    assert tuples(url_filter.judge(pages, pages.select("url"))) == []


# --- 2: sharding ----------------------------------------------------------------------------


def _laws(rows, shards):
    """rows: (shard, slot)"""
    slots = {s: sorted(x for t, x in rows if t == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_sharding(spark, small):
    got = [r.asDict() for r in queries.op2_sharding(spark, SF).collect()]
    _laws([(r["shard"], r["slot"]) for r in got], 24)
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in small[1])
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_sharding_moves_the_texts_in_buckets_of_bytes(spark, small, monkeypatch):
    folders, shuffle = [], sharding.shuffle_into_shards

    def spied(df, shards, folder, *args, **named):
        folders.append(folder)
        return shuffle(df, shards, folder, *args, **named, bucket_bytes=40_000)

    monkeypatch.setattr(sharding, "shuffle_into_shards", spied)
    got = queries.op2_sharding(spark, SF)
    written = spark.read.parquet(f"{folders[0]}/shuffled")
    assert tuples(written, f"{sharding.RECORD}.doc_id", f"{sharding.RECORD}.text") == sorted(small[1], key=repr)
    total = sum(len((t or "").encode()) + 8 for _, t in small[1])
    assert written.select(sharding.BUCKET).distinct().count() == -(-total // 40_000) > 5
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in small[1])
    assert tuples(got, "doc_id", "size", "text_crc32") == sorted(want, key=repr)


def test_sharding_spreads_equal_rows_over_small_buckets(spark):
    rows = [(1, "same")] * 400 + [(None, None)] * 50 + [(k, str(k)) for k in range(150)]
    df = frame(spark, rows).withColumn("shard", F.lit("old")).withColumn("extra", F.lit(3))
    out = sharding.shuffle_into_shards(df, 7, scratch(spark, "shards"), "doc_id", seed=5, bucket_rows=50)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "extra", "shard", "slot"]
    _laws([(r["shard"], r["slot"]) for r in got], 7)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    folder = scratch(spark, "written")
    sharding.write_shards(out, folder)
    assert spark.read.parquet(folder).count() == 600
    # A permutation, not the input's order.
    numbers = [r["doc_id"] for r in sorted(got, key=lambda r: (r["slot"], r["shard"])) if r["text"] not in ("same", None)]
    assert numbers != sorted(numbers) and sorted(numbers) == list(range(150))


# --- 3: byte-level BPE ----------------------------------------------------------------------


def _encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, planted):
    docs = [*planted, (None, "no id"), (1, "a"), (1, "a")]
    coder = _encoding()
    want = []
    for i, t in docs:
        ids = coder.encode_ordinary(t or "")
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    df = frame(spark, docs).withColumn("ids_sha256", F.lit("old"))
    got = byte_bpe.round_trip(df, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert tuples(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    both = byte_bpe.decode(byte_bpe.encode(df, queries.BYTE_RANKS, public_tokenizers.PATTERN), queries.BYTE_RANKS, public_tokenizers.PATTERN)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in both.collect())


def test_byte_bpe_on_documents(spark, small):
    coder = _encoding()
    want = sorted((i, sha256(",".join(map(str, coder.encode_ordinary(t or ""))).encode()).hexdigest()) for i, t in small[1])
    assert sorted(tuples(queries.op3_byte_bpe(spark, SF), "doc_id", "ids_sha256")) == want


# --- 4: token records -----------------------------------------------------------------------


def _records(docs):
    tokenizer = Tokenizer.from_file(queries.WORD_TOKENIZER)
    out, start = [], 0
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_records(spark, small):
    assert tuples(queries.op4_token_records(spark, SF)) == sorted(_records(sorted(small[1], key=lambda r: r[0])), key=repr)


def test_token_records_of_odd_texts(spark, planted):
    docs = sorted(planted, key=lambda r: r[0])
    folder = scratch(spark, "records")
    parts = token_records.write(frame(spark, docs).withColumn("offset", F.lit(1)), queries.WORD_TOKENIZER, 2, folder, partitions=3)
    assert tuples(token_records.digests(parts, folder)) == sorted(_records(docs), key=repr)
    ids = {r["doc_id"]: r["ids"] for r in token_records.read(parts, folder).collect()}
    assert all(i[-1] == 2 for i in ids.values()) and ids[docs[0][0]][:-1] == Tokenizer.from_file(queries.WORD_TOKENIZER).encode(docs[0][1] or "", add_special_tokens=False).ids
    part = parts.orderBy("part").first()
    order = np.arange(part["rows"])[::-1]
    shuffled = [x for entries, payloads in token_records.frames_of(folder, part["name"], order) for x in zip(entries["doc_id"].tolist(), payloads)]
    assert all(token_records.ids_of(p).tolist() == ids[d] for d, p in shuffled) and len(shuffled) == part["rows"]


def test_null_ids_come_first_and_damage_is_seen(spark):
    folder = scratch(spark, "records")
    parts = token_records.write(frame(spark, [(5, "b"), (None, "a"), (5, "b")]), queries.WORD_TOKENIZER, 2, folder, partitions=1)
    assert [r[:2] for r in sorted(map(tuple, token_records.digests(parts, folder).collect()), key=lambda r: r[1])] == [(None, 0), (5, 2), (5, 4)]
    frame_ = token_records.frames([b"payload"])[0]
    assert token_records.payloads_of([frame_]) == [b"payload"]
    assert token_records.crc32c([b"123456789"]) == [0xE3069283]
    with pytest.raises(ValueError):
        token_records.payloads_of([frame_[:14] + b"x" + frame_[15:]])


# --- 5: n-gram Jaccard join -----------------------------------------------------------------


def test_near_components(spark, small):
    assert tuples(queries.op5_parity_join(spark, SF)) == sorted(brute.near_components(small[1]), key=repr)


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (2, 60)])
def test_near_components_of_odd_texts(spark, planted, words, percent):
    got = parity_join.join(frame(spark, planted).withColumn("n", F.lit("old")), parity_join.Rule(words, percent))
    assert tuples(got) == sorted(brute.near_components(planted, words, percent), key=repr)


def test_near_components_need_more_than_one_centre(spark):
    """Short sets that share keys but link only through others."""
    rng = random.Random(3)
    rows = []
    for g in range(25):
        base = [f"w{g}_{k}" for k in range(24)]
        for _ in range(8):
            c = list(base)
            for _ in range(rng.randint(0, 3)):
                c[rng.randrange(len(c))] = f"x{rng.randrange(9)}"
            rows.append(" ".join(c))
    rng.shuffle(rows)
    docs = list(enumerate(rows))
    for rule in ((1, 70),):
        got = parity_join.join(frame(spark, docs), parity_join.Rule(*rule))
        assert tuples(got) == sorted(brute.near_components(docs, *rule), key=repr)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    rule = parity_join.Rule()
    for size in (6, 9, 40, 300):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for change in range(0, int(rule.most_different(size, size)) // 2 + 1):
            b = np.concatenate([a[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)])
            doc = np.repeat([0, 1], size)
            hashes = np.concatenate([np.sort(a), np.sort(b)])
            s = parity_join.sketches(doc, hashes, 2)
            hamming = int(np.unpackbits((s[0] ^ s[1]).view(np.uint8)).sum())
            assert hamming <= 2 * change
            owner, keys, _ = parity_join.block_keys(doc, hashes, np.array([size, size]), rule)
            if 100 * (size - change) >= 85 * (size + change) and change:
                assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 130)] + [(1, k) for k in range(2, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = components.components(frame(spark, edges, "a long, b long"))
    assert dict(tuples(got)) == {n: root[n] for n in linked}


# --- 6: suffix dedup ------------------------------------------------------------------------


def test_repeats(spark, small):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert tuples(queries.op6_suffix_dedup(spark, SF), *columns) == brute.without_repeats(small[1])


@pytest.mark.parametrize(("length", "gram"), [(400, 64), (60, 16), (24, 8)])
def test_repeats_of_odd_texts(spark, planted, length, gram):
    docs = [*planted, (801, "ab" * 600), (802, "ü" * 300 + "end"), (803, "x" * 399), (804, "x" * 399), (None, "ü" * 300), (801, "ab" * 600)]
    want = brute.without_repeats(docs, length)
    assert tuples(suffix_dedup.digests(frame(spark, docs).withColumn("h1", F.lit("old")), length, gram)) == want
    cleaned = suffix_dedup.clean(frame(spark, docs).withColumn("spans", F.lit("old")), length, gram).collect()
    assert sorted((r["doc_id"], sum(s["end"] - s["start"] for s in r["spans"])) for r in cleaned if r["doc_id"]) == sorted((w[0], w[2]) for w in want if w[0])


@pytest.mark.parametrize(("length", "gram"), [(51, 10), (24, 4)])
def test_repeated_words_of_odd_texts(spark, planted, length, gram):
    docs = [*planted, (801, "ab " * 600), (802, "x\ty\n" * 30 + "end"), (803, "x y " * 25), (803, "x y " * 25), (None, " \n" + "ü v  " * 30 + "\n"), (801, "ab " * 600)]
    got = suffix_dedup.clean(frame(spark, docs), length, gram, words=True).collect()
    assert sorted(((r["doc_id"], r["text"] or "") for r in got), key=repr) == brute.without_passages(docs, length)


# --- 7: URL filter --------------------------------------------------------------------------


def test_bloom_filter_passes_all_listed_and_few_others(spark):
    pages = frame(spark, [(k, f"http://h{k % 7}.example/{k}") for k in range(4000)] * 2 + [(None, None), (1, "no url"), (2, "://")], "page_id long, url string")
    listed = pages.where("page_id % 3 = 0").select("url")
    sent = url_filter.judge(pages, listed)
    assert sent.where("listed AND NOT possible").count() == 0
    assert sent.where("listed").count() == sent.where("page_id % 3 = 0").count()
    assert sent.where("possible AND NOT listed").count() < 80
    joined = url_filter.judge(pages, listed, broadcast_bytes=0)
    assert tuples(joined) == tuples(sent)
    assert tuples(url_filter.judge(pages, listed.limit(0)), "verdict") == [("allow",)] * pages.count()


def test_rules_and_canonical_urls(spark):
    rules = queries.RULES
    urls = {
        "http://a.org/x": ("org/", "allow"), "http://A.Example.ORG/es/1": ("example.org/es/", "block"), "http://example.org/en/12": ("example.org/en/1", "block"),
        "http://badexample.org/es/": ("org/", "allow"), "https://x.com/fr/?a": ("com/fr/", "allow"), "https://x.com/de": (None, "allow"), "http://org": (None, "allow"),
        "https://x.com/de/#f": ("com/de/", "block"), "nothing": (None, "allow"),
    }
    pages = frame(spark, [(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("rule", F.lit("old"))
    got = url_filter.judge(pages, pages.select("url").limit(0), rules)
    assert {r["url"]: (r["rule"], r["verdict"]) for r in got.collect()} == urls
    same = ["http://a.b/c", "https://A.b:443/c/", "http://a.b./c#x", "http://a.b/c?utm_source=1&ref=2"]
    one = frame(spark, [(u,) for u in same], "url string").select(url_filter.canonical(F.col("url")).alias("c")).distinct().collect()
    assert [r["c"] for r in one] == ["a.b/c"]


# --- 8: preference formatting ---------------------------------------------------------------


def test_preference_pairs(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "good"), (1, 3, "user", "q2"), (1, 4, "assistant", "more"),
        (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "bad"), (3, 0, None, None), (3, None, "user", "first"), (None, 0, "user", "x"),
    ]
    pairs = frame(spark, [(1, 2, "a"), (2, 1, "b"), (1, 1, "c"), (1, 3, "d"), (1, 99, "e"), (None, 1, "f")], "chosen_id long, rejected_id long, prompt string")
    pairs = pairs.withColumn("note", F.col("prompt"))
    got = {r["note"]: r for r in preference.format_pairs(frame(spark, turns, "conv_id long, turn long, role string, text string"), pairs).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    a = got["a"]
    assert (a["n_common"], a["prompt"]) == (2, "<|system|>\ns\n<|user|>\nq\n")
    assert a["chosen"] == "<|assistant|>\ngood\n<|user|>\nq2\n<|assistant|>\nmore\n" and a["rejected"] == "<|assistant|>\nbad\n"
    assert [a["chosen"][s["start"] : s["end"]] for s in a["chosen_mask"]] == ["good\n", "more\n"]
    assert [a["rejected"][s["start"] : s["end"]] for s in a["rejected_mask"]] == ["bad\n"]
    assert (got["b"]["chosen"], got["b"]["rejected"]) == (a["rejected"], a["chosen"])
    assert (got["c"]["n_common"], got["c"]["chosen"], got["c"]["rejected"], got["c"]["chosen_mask"]) == (5, "", "", [])
    assert got["d"]["n_common"] == 0 and got["d"]["rejected"] == "<|user|>\nfirst\n<||>\n\n"


# --- 9: quality classifier ------------------------------------------------------------------


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    judged = site_bayes.classify(docs, labels.where(~held), scratch(spark, "sites"), rows=20_000)
    told = judged.join(labels.where(held), "doc_id").select("accepted", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    counts = {(r["good"], r["accepted"]): r["count"] for r in told.groupBy("good", "accepted").count().collect()}
    good = counts.get((True, True), 0) / sum(v for k, v in counts.items() if k[0])
    bad = counts.get((False, False), 0) / sum(v for k, v in counts.items() if not k[0])
    assert good > 0.99 and bad > 0.9, counts


def test_sites_shrink_towards_the_prior(spark):
    rows = [("big", "en", 2.0)] * 300 + [("big", "de", -2.0)] * 300 + [("clean", "en", -4.0)] * 500 + [("one", "en", 2.0)] + [("", "", -4.0)] * 30
    scored = frame(spark, rows, "_host string, _path string, bad_log_odds double")
    got = {(r["_host"], r["_path"]): r["site_log_odds"] for r in site_bayes.site_posteriors(scored, scratch(spark, "sites")).collect()}
    assert got["clean", "en"] < 0 < got["big", "en"]
    assert 0 < got["one", "en"] < got["big", "en"]  # one document moves its site less


def test_classifier_on_odd_rows(spark):
    docs = [(k, t, None if k % 2 else "s", "en", "old") for k, t in enumerate(ODD_TEXTS)] + [(1, "a", None, None, "old"), (None, None, None, None, None)]
    df = frame(spark, docs, "doc_id long, text string, source string, lang string, accepted string")
    labels = frame(spark, [(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    got = site_bayes.classify(df, labels, scratch(spark, "sites"))
    assert got.count() == len(docs) and got.columns[:4] == ["doc_id", "text", "source", "lang"]
    assert got.where("accepted IS NULL OR isnan(bad_log_odds)").count() == 0


# --- 10: quality rules ----------------------------------------------------------------------

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(spark, small, planted):
    assert tuples(queries.op10_line_rules(spark, SF), *BASE) == brute.base_counts(small[1])
    docs = [*planted, (None, "a b c d e f a b c d e f g\nx\nx\n x\n\n|"), (5, "one " * 40)]
    assert tuples(line_rules.clean(frame(spark, docs).withColumn("kept", F.lit("old"))), *BASE) == brute.base_counts(docs)


def test_lines_and_verdicts(spark):
    prose = "This is a line of plain prose that ends as a sentence should end.\nAnd here is a second one of much the same kind, also fine."
    menu = "Home | News | About | Contact | Help"
    docs = [(1, prose), (2, f"{menu}\n{prose}\nAll rights reserved by nobody."), (3, "\n".join([menu, "Start | Next | Last | More", "Up | Down | Left | Right"] * 1 + ["End of it."])), (4, "### $$$ ***\n" + prose)]
    got = {r["doc_id"]: r for r in line_rules.clean(frame(spark, docs)).collect()}
    assert got[1]["cleaned"] == got[2]["cleaned"] == got[4]["cleaned"] == prose
    assert [got[k]["kept"] for k in (1, 2, 3, 4)] == [True, True, False, True]


# --- the pipeline ---------------------------------------------------------------------------


def test_pipeline(spark, small):
    out = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        folder = scratch(spark, "stage")
        stage(spark, docs, SF).write.parquet(folder)
        before, docs = docs, spark.read.parquet(folder)
        steps.append((before.select("*").collect(), docs.collect()))
    assert {r["doc_id"] for r in steps[-1][1]} == out and len(out) > 50
    pairs = [(r["doc_id"], r["text"]) for r in steps[1][0]]
    assert {r["doc_id"] for r in steps[1][1]} == {c for d, _, c in brute.near_components(pairs, 5, 80)}
    left = [r for r in brute.without_both([(r["doc_id"], r["text"]) for r in steps[2][0]]) if r[1]]
    assert sorted(((r["doc_id"], r["text"]) for r in steps[2][1]), key=repr) == left
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {r[0] for r in brute.contamination([(r["doc_id"], r["text"]) for r in steps[3][0]], items) if r[5]}
    assert {r["doc_id"] for r in steps[3][1]} == {r["doc_id"] for r in steps[3][0]} - dirty


def test_pipeline_cuts_shared_passages_of_over_50_words(spark):
    """Passages of fewer than 400 bytes, each copy in surroundings of its own."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, n)))
    docs, want = [], []
    for count in (50, 51, 55, 60, 70):
        passage = " ".join(word(4) for _ in range(count))
        assert len(passage) < 400
        for k in range(20):
            before, after = (" ".join([f"{k}{side}", *(word(9) for _ in range(40)), f"{k}{side}"]) for side in "ab")
            docs.append((1000 * count + k, f"{before} {passage} {after}", 0))
            want.append((docs[-1][0], f"{before} {after}" if count > 50 else docs[-1][1]))
    got = corpus_pipeline.repeated_passages(spark, frame(spark, docs, "doc_id long, text string, n_chars long"), SF)
    assert tuples(got, "doc_id", "text") == sorted(want, key=repr)


def test_pipeline_cuts_all_repeated_windows_of_words_and_bytes(spark, small):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = [r for r in brute.without_both(small[1]) if r[1]]
    assert want != [r for r in brute.without_passages(small[1]) if r[1]]
    got = corpus_pipeline.repeated_passages(spark, docs, SF).where("text <> ''")
    assert tuples(got, "doc_id", "text") == want


def test_stages_on_repeated_rows_and_null_ids(spark):
    """Of equal and near rows one stays, whatever their ids; rows without an id are judged like others."""
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    item = max((r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=lambda t: len(t.split()))
    twice, nulled, near, nulls, shared, alone = (prose(200) for _ in range(6))
    docs = [
        (1, twice), (1, twice), (None, nulled), (2, nulled), (None, near + " end"), (3, near), (None, nulls), (None, nulls),
        (None, nulls + " end"), (4, shared), (4, alone), (5, None), (None, ""), (None, item), (6, item), (7, prose(60)), (7, item),
    ]
    table = frame(spark, [(i, t, "s", "en", len(t or "")) for i, t in docs], "doc_id long, text string, source string, lang string, n_chars long")
    assert corpus_pipeline.quality(spark, table, SF).count() <= len(docs)
    # What the classifier says of random letters is not at issue: all rows go on.
    steps = [table]
    for _, stage in corpus_pipeline.STAGES[1:]:
        folder = scratch(spark, "stage")
        stage(spark, steps[-1], SF).write.parquet(folder)
        steps.append(spark.read.parquet(folder))
    kept = [(1, twice), (2, nulled), (3, near), (4, shared), (4, alone), (5, None), (None, ""), (7, docs[15][1])]
    found = tuples(steps[1], "doc_id", "text")
    assert [r for r in found if r[1] not in (nulls, nulls + " end")] == sorted([*kept, (6, item)], key=repr)
    assert sum(r[1] in (nulls, nulls + " end") for r in found) == 1
    assert tuples(steps[2], "doc_id", "text") == found
    assert tuples(steps[3], "doc_id", "text") == [r for r in found if r[1] != item]
    assert tuples(steps[4], "doc_id") == tuples(steps[3], "doc_id")


def test_decontaminated_judges_rows(spark):
    item = max((r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=lambda t: len(t.split()))
    docs = frame(spark, [(None, item), (7, item), (7, "plain words"), (None, "plain words")])
    assert tuples(corpus_pipeline.decontaminated(spark, docs, SF)) == sorted([(7, "plain words"), (None, "plain words")], key=repr)


def test_hashes_do_not_depend_on_the_place():
    texts = [b"abc def", b"", b"xx abc def", b"abc"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, first = textbytes.words(data, offsets, textbytes.NOT_SPACE)
    assert first.tolist() == [0, 2, 2, 5, 6]
    assert hashes[0] == hashes[3] == hashes[5] and hashes[1] == hashes[4] != hashes[0]


# --- texts that collide modulo a power of two, names that clash, packages that are missing -------------------


def thue_morse(a, b, n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - x for x in bits]
    return "".join(b if x else a for x in bits[:n])


def test_regular_words_do_not_collide(spark):
    for n in (512, 1024, 4096):
        one, other = thue_morse("e", "t", n), thue_morse("t", "e", n)
        docs = frame(spark, [(1, one), (2, other), (3, " ".join([one] * 60)), (4, " ".join([other] * 60))])
        assert tuples(parity_join.join(docs), "doc_id", "component_id") == [(k, k) for k in (1, 2, 3, 4)]
        found = phrase_index.decontaminate(docs, frame(spark, [(9, other)], "item_id long, text string"), scratch(spark, "index"))
        assert tuples(found.where("contaminated"), "doc_id") == [(2,), (4,)]
        data = np.frombuffer((one + other).encode(), np.uint8)
        offsets = np.array([0, n, 2 * n])
        hashes, _ = textbytes.words(data, offsets, textbytes.LETTER_DIGIT)
        assert hashes[0] != hashes[1]  # as the classifier reads them
        rng = random.Random(n)
        filler = [" ".join("".join(rng.choice("xyz") for _ in range(9)) for _ in range(8)) for _ in range(2)]
        texts = [(k, f"{f} {w} {f[:20]}") for k, (f, w) in enumerate(zip(filler, (one, other)))]
        kept = suffix_dedup.clean(frame(spark, texts), 3, 2, words=True)
        assert tuples(kept, "doc_id", "text") == brute.without_passages(texts, 3)


def test_shared_passage_does_not_pair_all(spark):
    """Many unlinked documents around one passage: few pairs come to the exact check."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    passage = [word() for _ in range(60)]
    docs = frame(spark, [(k, " ".join([word() for _ in range(12)] + passage + [word() for _ in range(12)])) for k in range(1500)]).repartition(4)
    rule = parity_join.Rule()
    signed = parity_join.Tables(spark).keep(parity_join.sign(docs, rule, 4), "signed")
    classes = signed.where("bucket IS NULL").select(
        F.col("f1").alias("cls"), "n", F.col("doc_id").alias("rep"), "allowed", *[F.get("sketch", F.lit(i)).alias(w) for i, w in enumerate(parity_join.WORDS)]
    )
    kept = parity_join.rarest(parity_join.shared_keys(signed, 4), classes).join(classes.drop("allowed"), "cls").withColumn("label", F.col("cls"))
    assert parity_join._near(kept, 0, 1 << 30, rule).count() < 1500
    assert parity_join.join(docs).where("doc_id <> component_id").count() == 0


def test_stages_keep_columns_of_any_name(spark):
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    shared = prose()
    rows = [(k, f"{prose()} {shared if k < 2 else ''}", "s", "en", 1, f"w{k}", k, "h", -k, [1], "r", "d", True) for k in range(4)]
    names = "doc_id long, text string, source string, lang string, n_chars long, whole string, h1 long, h2 string, _row long, spans array<int>, row string, doc string, accepted boolean"
    table = frame(spark, rows, names)
    extra = [c.split()[0] for c in names.split(", ")][5:]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, table, SF)
        assert got.columns == table.columns
        left = {r["doc_id"] for r in got.collect()}
        assert tuples(got, "doc_id", *extra) == tuples(table.where(F.col("doc_id").isin(list(left))), "doc_id", *extra)
    cut = corpus_pipeline.repeated_passages(spark, table, SF)
    assert all(shared not in r["text"] for r in cut.collect()) and cut.count() == 4


def test_broadcasts_name_no_class_of_the_package(spark):
    import pickle

    phrases = phrase_index.Phrases([(1, [3, 4]), (2, [4])], {3: 1, 4: 2})
    shipped = phrase_index._shipped(spark, phrases)
    assert b"vellumflow" not in pickle.dumps(shipped.value) and shipped.value.length.tolist() == [2, 1]
    model = site_bayes.Model(np.zeros(1), np.zeros((1, 2)), np.zeros(2))
    assert b"vellumflow" not in pickle.dumps(tuple(model))


def test_preference_query_pairs_every_answered_conversation(spark, tmp_path):
    turns = [(c, k, r, f"{c} {r}") for c in (-70, -1, 3, 4, 90, 2**61) for k, r in enumerate(["user", "assistant"])]
    turns += [(5, 0, "user", "no answer"), (None, 0, "assistant", "nobody"), (90, 1, "assistant", "90 assistant")]
    frame(spark, turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op8_preference(spark, str(tmp_path))
    assert tuples(got, "conv_id") == sorted([(c,) for c in (-70, -1, 3, 4, 90, 2**61)], key=repr)
    assert {r["n_common"] for r in got.where("conv_id <> 90").collect()} == {1}


def test_passage_columns_of_the_digest(spark, small):
    docs, texts = small
    got = suffix_dedup.digests(docs, passage=(51, 10))
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.without_repeats(texts)
    left = {d: t for d, t in brute.without_passages(texts)}
    assert tuples(got, "doc_id", "passage_kept_sha256") == sorted(((d, sha256(t.encode()).hexdigest()) for d, t in left.items()), key=repr)
    size = {d: len((t or "").encode()) for d, t in texts}
    assert all(r["n_passage_removed"] == size[r["doc_id"]] - len(left[r["doc_id"]].encode()) for r in got.collect())


def test_classifier_counts_words_outside_the_driver(spark):
    """Words that tell nothing do not come to the driver, however many the sample has."""
    import tracemalloc

    rng = np.random.default_rng(9)
    texts = [(k, " ".join(f"w{x}" for x in rng.integers(0, 10**9, 2000)) + (" spam" if k % 3 == 0 else " ham")) for k in range(600)]
    docs, labels = frame(spark, texts), frame(spark, [(k, int(k % 3 > 0), 0) for k in range(600)], "doc_id long, quality int, toxic int")
    tracemalloc.start()
    model = site_bayes.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6 and 2 <= len(model.features) < 50
    scored = site_bayes.evidence(docs, model).select((F.col("doc_id") % 3 == 0).alias("bad"), (F.col("junk_evidence") > 0).alias("told")).distinct()
    assert tuples(scored) == [(False, False), (True, True)]


def test_rounds_without_links_close_no_components(spark, monkeypatch):
    """Pairs that the exact check drops leave the components as they are."""
    calls = []
    monkeypatch.setattr(parity_join, "components", lambda links: calls.append(1) or components.components(links))
    texts = [" ".join(f"v{k}w{j}" if j % 60 < 3 * (k > 0) else f"w{j}" for j in range(180)) for k in range(4)]
    docs = frame(spark, [(k, t) for k, t in enumerate([*texts, "b c d e f g h", "b c d e f g h"])])
    want = brute.near_components([tuple(r) for r in docs.collect()])
    assert tuples(parity_join.join(docs), "doc_id", "n_shingles", "component_id") == want
    assert len({c for _, _, c in want}) == 5 and not calls


def test_labels_are_folded(spark):
    schema = "node long, label long"
    labels, merged = frame(spark, [(1, 1), (5, 1), (7, 7), (9, 7), (20, 20), (21, 20)], schema), frame(spark, [(1, 1), (7, 1), (3, 1)], schema)
    assert tuples(components.folded(labels, merged)) == [(1, 1), (20, 20), (21, 20), (3, 1), (5, 1), (7, 1), (9, 1)]
    assert tuples(components.folded(None, merged)) == tuples(merged)


def test_short_hashes_choose_the_same_places():
    """Sampling hashes every gram once, by a short hash, and the full hash is of the sampled places alone."""
    rng = np.random.default_rng(11)
    text = rng.integers(97, 105, 3000).astype(np.uint8)
    data = np.concatenate([rng.integers(97, 105, 777).astype(np.uint8), text, text])
    prefix = textbytes.prefix_hash(data)
    sums = [[0], [0]]
    for i, c in enumerate(data[:500].tolist()):
        for k in range(2):
            sums[k].append((sums[k][-1] + int(textbytes._TABLES[k][c]) * pow(textbytes.BASES[k], i, textbytes.PRIME)) % textbytes.PRIME)
    assert prefix[:501].tolist() == [a << 32 | b for a, b in zip(*sums)]
    short = textbytes.span_order(prefix, 64)
    assert np.array_equal(short[777 : 777 + 2937], short[3777 : 3777 + 2937]) and len(np.unique(short[777 : 777 + 2937])) > 2900
    place, first, last, grams = suffix_dedup.sample(prefix, np.array([0, 777, 3777, 6777]), 400, 64)
    one, other = (place >= 777) & (place < 3777), place >= 3777
    assert np.array_equal(place[one] + 3000, place[other]) and np.array_equal(grams[one], grams[other])
    assert np.array_equal(grams, textbytes.span_hash(prefix, place, place + 64))
    assert all(np.all((place >= a) & (place <= a + 336)) for a in (first, last))
