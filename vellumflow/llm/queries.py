"""The operators as named queries over one directory of raw parquet, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumflow.llm import (
    byte_bpe, line_rules, mixing, parity_join, phrase_index, preference, prefix_trie, sharding, site_bayes, suffix_dedup, token_records,
    url_filter, whitening,
)
from vellumflow.llm.tables import Tables
from vellumflow.session import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SHARDS, SEED = 24, 20240101
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def query(build: Query) -> Query:
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), scratch(spark, "index"))


ORACLE["op1_phrase_index"] = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS n, array_to_string(words[k : k + 12], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS k FROM items WHERE len(words) > 0)),
starts AS (
  SELECT id, n, k, array_to_string(words[k : k + n - 1], ' ') AS phrase
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM docs, (SELECT DISTINCT n FROM windows))),
found AS (SELECT id, n, k, item_id FROM starts JOIN windows USING (n, phrase)),
hit AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(k, k + n)) AS place FROM found) GROUP BY id),
named AS (SELECT id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS names FROM found GROUP BY id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(names), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (id) LEFT JOIN named USING (id)"""


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    records = table(spark, sf_dir, "documents").select("doc_id", "text", size.alias("size"))
    out = sharding.shuffle_into_shards(records, SHARDS, scratch(spark, "shards"), "doc_id", SEED, size="size")
    # Digests of the texts as they stand in the written buckets.
    return out.select(
        "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "slot",
        F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN)


@query
def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "records")
    parts = token_records.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID, folder)
    return token_records.digests(parts, folder)


@query
def op5_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The further columns judge by passages of over 50 words, however many bytes they have.
    return suffix_dedup.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=(51, 10))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # The list: URLs of pages that the labels call toxic.
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    listed = pages.join(toxic, "page_id", "left_semi").select("url")
    return url_filter.judge(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


ORACLE["op7_url_filter"] = r"""
WITH read AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         array_to_string(list_sort(list_filter(
           string_split(regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*[^?#]*\?([^#]*)', 1, 's'), '&'),
           lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND NOT starts_with(p, 'ref='))), '&') AS query
  FROM pages),
named AS (
  SELECT page_id, host, path,
         CASE WHEN host <> '' THEN concat(regexp_replace(regexp_replace(host, ':(80|443)$', ''), '\.$', ''), regexp_replace(path, '/+$', ''),
                                          CASE WHEN query <> '' THEN concat('?', query) ELSE '' END) END AS canonical
  FROM read),
listed AS (SELECT DISTINCT canonical FROM named WHERE page_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
ruled AS (
  SELECT *,
         CASE WHEN host LIKE '%.example.org' OR host = 'example.org' THEN
                CASE WHEN starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN starts_with(path, '/') THEN 'org/' END
              WHEN host LIKE '%.org' OR host = 'org' THEN CASE WHEN starts_with(path, '/') THEN 'org/' END
              WHEN host LIKE '%.com' OR host = 'com' THEN
                CASE WHEN starts_with(path, '/fr/') THEN 'com/fr/' WHEN starts_with(path, '/de/') THEN 'com/de/' END END AS rule,
         coalesce(canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL), false) AS listed
  FROM named)
SELECT page_id, host, path, rule, canonical, listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


@query
def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # The rejected side of an answered conversation has the last reply of the next one, by id, in place of its
    # own; the last one takes that of the first. Pairs go by the number of the conversation.
    last = turns.where("role = 'assistant' AND conv_id IS NOT NULL").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    tables = Tables(spark)
    answered = mixing.before(last.withColumn("one", F.lit(1).cast("long")), [F.col("conv_id")], ["one"], tables)
    answered = tables.keep(answered.select("conv_id", F.col("before_one").alias("k"), F.col("last.turn").alias("at"), F.col("last.text").alias("own")), "answered")
    n = answered.count()
    replies = answered.select(F.pmod(F.col("k") - 1, F.lit(n) if n else F.lit(1)).alias("k"), F.col("own").alias("reply"))
    pairs = answered.drop("own").join(replies, "k")
    mine = turns.join(pairs, "conv_id")
    chosen = mine.select((2 * F.col("k")).alias("conv_id"), "turn", "role", "text")
    swapped = mine.where("turn <= at OR turn IS NULL").select(
        (2 * F.col("k") + 1).alias("conv_id"), "turn", "role", F.when(F.col("turn") == F.col("at"), F.col("reply")).otherwise(F.col("text")).alias("text")
    )
    wanted = pairs.select((2 * F.col("k")).alias("chosen_id"), (2 * F.col("k") + 1).alias("rejected_id"), "conv_id")
    formatted = preference.format_pairs(chosen.unionByName(swapped), wanted)
    trained = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return formatted.select(
        "conv_id", "n_common", *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
        *[trained(F.col(f"{c}_mask")).alias(f"{c}_trained") for c in ("chosen", "rejected")],
    )


ORACLE["op8_preference"] = """
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
last AS (SELECT conv_id, turn AS final, text AS reply FROM turns WHERE role = 'assistant'
         QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1),
pairs AS (SELECT conv_id, final, CASE WHEN n = count(*) OVER () THEN first_value(reply) OVER w ELSE lead(reply) OVER w END AS reply
          FROM (SELECT *, row_number() OVER (ORDER BY conv_id) AS n FROM last WHERE conv_id IS NOT NULL) WINDOW w AS (ORDER BY conv_id)),
a AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM turns JOIN pairs USING (conv_id)),
b AS (SELECT conv_id, role, said AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, said) AS k
      FROM (SELECT *, CASE WHEN turn = final THEN reply ELSE text END AS said FROM turns JOIN pairs USING (conv_id) WHERE turn <= final OR turn IS NULL)),
common AS (SELECT a.conv_id, coalesce(min(a.k) FILTER (a.role <> b.role OR a.text <> b.text) - 1, count(*)) AS n_common
           FROM a JOIN b ON a.conv_id = b.conv_id AND a.k = b.k GROUP BY a.conv_id),
sides AS (SELECT *, 'chosen' AS side, concat('<|', role, '|>', chr(10), text, chr(10)) AS shown FROM a
          UNION ALL SELECT *, 'rejected', concat('<|', role, '|>', chr(10), text, chr(10)) FROM b)
SELECT conv_id, n_common,
       sha256(coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 'chosen' AND k <= n_common), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 'chosen' AND k > n_common), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 'rejected' AND k > n_common), '')) AS rejected_sha256,
       CAST(coalesce(sum(length(text) + 1) FILTER (side = 'chosen' AND k > n_common AND role = 'assistant'), 0) AS BIGINT) AS chosen_trained,
       CAST(coalesce(sum(length(text) + 1) FILTER (side = 'rejected' AND k > n_common AND role = 'assistant'), 0) AS BIGINT) AS rejected_trained
FROM sides JOIN common USING (conv_id) GROUP BY conv_id, n_common"""


@query
def op9_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    judged = site_bayes.classify(docs, table(spark, sf_dir, "labels"), scratch(spark, "sites"), keep_text=False)
    return judged.select("doc_id", "junk_evidence", "toxic_evidence", "site_log_odds", "bad_log_odds", "accepted")


@query
def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rules.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


_FURNITURE = " OR ".join(f"contains(lower(line), '{p}')" for p in line_rules.BOILERPLATE)
ORACLE["op10_line_rules"] = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
grams AS (
  SELECT id, k, array_to_string(words[k : k + 4], ' ') AS gram FROM (SELECT id, words, unnest(range(1, len(words) - 3)) AS k FROM docs)),
repeated AS (SELECT id, k FROM grams QUALIFY count(*) OVER (PARTITION BY id, gram) > 1),
covered AS (SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(k, k + 5)) AS place FROM repeated) GROUP BY id),
lines AS (
  SELECT id, line, regexp_replace(line, '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM docs)),
judged AS (
  SELECT id, line, length(bare) AS chars,
         100 * (length(bare) - length(regexp_replace(bare, '[#*$%&|<>]', '', 'g'))) > {line_rules.MAX_SYMBOL_PERCENT} * length(bare)
         OR (length(line) - length(regexp_replace(line, '[|>»]', '', 'g')) >= {line_rules.MIN_LINKS}
             AND NOT regexp_matches(line, '[.!?:;"''”’)…]\s*$'))
         OR {_FURNITURE} AS fails
  FROM lines WHERE bare <> ''),
by_doc AS (
  SELECT id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost, sum(chars) AS chars
  FROM judged GROUP BY id),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
  FROM docs LEFT JOIN covered USING (id) LEFT JOIN by_doc USING (id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= {line_rules.MAX_LOST_PERCENT} * word_chars AS kept
FROM counted"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Tables(spark).keep(prefix_trie.sequences(table(spark, sf_dir, "conversations")), "sequences")
    base = F.col("conv") - F.col("conv") % 5
    heads = own.where("conv % 5 = 0").select(F.col("conv").alias("base"), F.slice("ids", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).cast("int")
    rebuilt = own.withColumn("base", base).join(heads, "base", "left").select(
        "conv", F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h), F.slice("ids", h + 1, F.greatest(F.size("ids"), F.lit(1)))).alias("ids")
    )
    return prefix_trie.nodes(prefix_trie.keyed(rebuilt))


ORACLE["op11_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
-- Unsigned CRC-32, a bit at a time: each digit is added, then eight steps.
heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, (c & 1) * 3988292384) END, 4294967295::BIGINT), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT h.conv_id, t.k, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.base AND t.k <= h.h
  UNION ALL SELECT h.conv_id, t.k + 10, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.k > h.h),
steps AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS depth, octet_length(encode(text)) AS size,
         md5(concat(length(role), ':', role, text)) AS turn
  FROM rebuilt),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, NULL AS parent, 0 AS size FROM heads
  UNION ALL
  SELECT conv_id, depth, string_agg(turn, '') OVER w, coalesce(string_agg(turn, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), size
  FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
own AS (
  SELECT path, any_value(parent) AS parent, min(p.conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM paths p JOIN lengths l ON p.conv_id = l.conv_id GROUP BY path),
kids AS (SELECT parent AS path, count(*) AS n FROM own WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.path, count(*) FILTER (k.n IS NULL) AS n_leaves, CAST(sum((o.n_convs - 1) * o.size) AS BIGINT) AS saved_tokens
  FROM own o LEFT JOIN kids k ON k.path = o.path JOIN paths a ON a.conv_id = o.conv_id AND a.depth <= o.depth GROUP BY a.path)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves, b.saved_tokens, o.ends_sha256
FROM own o JOIN below b ON b.path = o.path LEFT JOIN kids k ON k.path = o.path LEFT JOIN own p ON p.path = o.parent"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
    each = white.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "epochs")


ORACLE["op13_mixing"] = rf"""
WITH docs AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda w: w <> '')) AS size,
         CAST(concat('0x', substr(md5(concat('{mixing.SEED}:', doc_id, ':', text)), 1, {mixing.KEY_DIGITS})) AS BIGINT) AS key
  FROM documents),
sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size, [1, 5, 2][row_number() OVER (ORDER BY source NULLS LAST) % 3 + 1] AS weight
  FROM docs GROUP BY source),
swept AS (
  SELECT *, sum(size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM sized WINDOW w AS (ORDER BY size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, 3 * size * (weights - weight_before) <= (total - 3 * size_before) * weight AS stops FROM swept),
shared AS (
  SELECT *, total - 3 * coalesce(sum(size) FILTER (stops) OVER (), 0) AS words, weights - coalesce(sum(weight) FILTER (stops) OVER (), 0) AS shares
  FROM marked),
goals AS (
  SELECT source, size AS source_size, CASE WHEN stops THEN CAST(3 * size AS DOUBLE) ELSE CAST(words * weight AS DOUBLE) / CAST(shares AS DOUBLE) END AS target,
         CAST(CASE WHEN stops THEN 3 * size ELSE words * weight // shares END AS BIGINT) AS budget
  FROM shared),
placed AS (
  SELECT doc_id, d.source, size, source_size, target, budget // greatest(source_size, 1) AS epochs, budget % greatest(source_size, 1) AS further,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + least(greatest(further - start, 0), size) AS BIGINT) AS taken, CAST(epochs AS INTEGER) AS epochs
FROM placed"""
