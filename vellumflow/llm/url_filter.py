"""URL filter: a blocked Bloom filter in front of an exact join, DataFrame operations only.

The list of URLs is kept in canonical form: host and path without scheme, default port,
trailing slash, fragment and tracking parameters, the other parameters sorted. The
filter is a table with one row per block of eight 64-bit words; a URL's hash names its
block, and a second one sets one bit in each word. A page whose bits are not all set is
not listed; the others are possible hits, and a join with the list removes the false
ones. Rules by host and path come before the list.

The filter has about 18 bits per listed URL. It is sent to all tasks when that is at
most ``BROADCAST_BYTES``, else it is joined by block. Pages of one URL may be a third of
all: the exact join splits such keys, and only possible hits carry a key.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is not listed. Repeated pages get equal verdicts; equal URLs on the list count
once. All columns are kept; the added ones replace columns of their names. Empty tables
give empty results; an empty list blocks nothing.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow.operators.joins import lookup

WORDS, WORD_BITS, BITS_PER_URL = 8, 64, 16
BROADCAST_BYTES = 64 << 20
ROW_BYTES = (WORDS + 1) * 8
TRACKING = ("utm_", "ref=")
Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling for URLs that name the same page; null without a host."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.greatest(*[p.startswith(t) for t in TRACKING])))
    joined = F.array_join(kept, "&")
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(80|443)$", ""), r"\.$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    whole = F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit("")))
    return F.when(host != "", whole)


def _bits(key: Column) -> list[Column]:
    """The bit of each word, from a hash of its own."""
    spread = F.xxhash64(F.lit(1), key)
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w7): the filter of the keys of ``listed``."""
    rows = listed.select(F.pmod(F.xxhash64(F.lit(0), F.col(key)), F.lit(blocks)).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def mark_listed(pages: DataFrame, listed: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with ``possible`` (the filter lets the key through) and ``listed`` (it is on the list)."""
    urls = listed.select(key).where(F.col(key).isNotNull()).distinct()
    blocks = max(1, -(-urls.count() * BITS_PER_URL // (WORDS * WORD_BITS)))
    filters = bloom(urls, key, blocks)
    if blocks * ROW_BYTES <= broadcast_bytes:
        filters = F.broadcast(filters)
    kept = [c for c in pages.columns if c not in ("possible", "listed")]
    keyed = pages.select(*kept, F.pmod(F.xxhash64(F.lit(0), F.coalesce(F.col(key), F.lit(""))), F.lit(blocks)).alias("block"))
    probed = keyed.join(filters, "block", "left")
    hit = F.lit(True)
    for i, b in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(b) == b)
    probed = probed.select(*kept, F.coalesce(hit, F.lit(False)).alias("possible"), F.monotonically_increasing_id().alias("_row"))
    probed = probed.withColumn("_key", F.when(F.col("possible"), F.col(key)))
    exact = lookup(probed, urls.select(F.col(key).alias("_key"), F.lit(True).alias("listed")), ["_key"], spread_by="_row")
    return exact.select(*kept, "possible", F.coalesce("listed", F.lit(False)).alias("listed"))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls: its host or a subdomain,
    and a path that starts with the rule's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own_host, own_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        name = F.when(fits, F.lit(own_host + own_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with host, path, canonical, possible, listed, rule and verdict; ``listed`` has
    URLs in a column of the same name. Listed pages are blocked where no rule fits."""
    added = ("host", "path", "canonical", "possible", "listed", "rule", "verdict")
    kept = [c for c in pages.columns if c == url or c not in added]
    read = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("canonical"))
    marked = mark_listed(read, listed.select(canonical(F.col(url)).alias("canonical")), "canonical", broadcast_bytes)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, own))
