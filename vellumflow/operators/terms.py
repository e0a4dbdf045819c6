"""Listed terms in texts, for lists of any length: the list is a table, never part of the plan.

The list is joined: each term is filed under its first characters, texts are cut
into pieces that overlap by the longest term, the characters at every place of a piece are looked up
in the file by an equi-join, and only the terms found there are compared in full. The join stays in
the JVM, but a row per place costs about 3 microseconds a character. A list of bounded size becomes one
regular expression instead, a tree of the terms by their characters that finds the longest term at each
place; the value of a subquery, it is no part of the plan either. With ``search_bytes`` such a list goes
to the tasks, which search each text once for all terms together, in Python.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Lengths of the filed beginnings; a term goes under the longest that it has.
PREFIXES = (8, 4, 2, 1)
#: Characters of a piece, or the longest term's if that is longer; short, since each place is found by counting from its start.
PIECE = 128
#: A list up to this many bytes may be searched for in the tasks (an automaton takes some forty times its bytes).
SEARCH_BYTES = 4 << 20
#: A list up to this many bytes, with no more terms that begin each other than this, is one expression, in texts cut into pieces of this many characters.
SCAN_BYTES, SCAN_DEPTH, SCAN_PIECE = 1 << 20, 100, 1 << 16
#: A list up to this size is joined by a broadcast, beyond it by shuffles.
BROADCAST_BYTES = 32 << 20


def _filed_under(term: str) -> Column:
    n = F.char_length(term)
    return F.coalesce(*[F.when(n >= p, F.lit(p)) for p in PREFIXES])


def _pieces(text: Column, size: int, longest: int) -> Column:
    """Pieces of ``size`` characters, each with the ``longest - 1`` characters after it."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size + longest - 1}}})).{{1,{size}}}"), 1)


def _beginnings(piece: Column, size: int, lengths: list[int]) -> Column:
    """The different runs of each length that begin within the first ``size`` places of a piece."""
    def runs(n: int) -> Column:
        last = F.least(F.char_length(piece) - (n - 1), F.lit(size))
        return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(piece, i, F.lit(n)))))

    return F.concat(*[F.coalesce(runs(n), F.array().cast("array<string>")) for n in lengths])


def _starts(piece: Column, term: Column, size: int) -> Column:
    """At how many of the first ``size`` places of a piece the term begins."""
    within = F.left(piece, F.lit(size - 1) + F.char_length(term))
    literal = F.concat(F.lit(r"(?=\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    return F.when(F.contains(within, term), F.regexp_count(within, literal)).otherwise(0)


def _searched(rows: DataFrame, listed: list[str]) -> DataFrame:
    """(_key, _term, _n) of lower-cased ``_text``, searched within the tasks."""
    sent = rows.sparkSession.sparkContext.broadcast(listed)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in sent.value:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for batch in batches:
            found = [(k, t, n) for k, text in zip(batch["_key"], batch["_text"]) for t, n in Counter(t for _, t in automaton.iter(text)).items()]
            yield pd.DataFrame(found, columns=["_key", "_term", "_n"])

    schema = T.StructType([T.StructField("_key", rows.schema["_key"].dataType), T.StructField("_term", T.StringType()), T.StructField("_n", T.LongType())])
    return rows.where("_text IS NOT NULL AND _key IS NOT NULL").mapInPandas(search, schema)


def _tree(listed: list[str]) -> str | None:
    """An expression for the longest of the sorted ``listed`` terms at a place; None if too many of them begin each other."""
    def literal(text: str) -> str:
        return "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)

    def halved(found: list[tuple[int, str]]) -> str:
        """Alternatives by their first character; many are not tried one by one, but halved by it."""
        if len(found) <= 4:
            return "|".join(text for _, text in found)
        halves = found[: len(found) // 2], found[len(found) // 2 :]
        return "|".join(f"(?=[\\x{{{h[0][0]:x}}}-\\x{{{h[-1][0]:x}}}])(?:{halved(h)})" for h in halves)

    def branches(low: int, high: int, at: int, depth: int) -> str:
        """Of the terms from ``low`` to ``high``, which agree in their first ``at`` characters, what follows these."""
        if depth > SCAN_DEPTH:
            raise RecursionError
        ends = len(listed[low]) == at
        low += ends
        found = []
        while low < high:
            first = listed[low][at]
            until = bisect_left(listed, True, low, high, key=lambda t: t[at] != first)
            a, b = listed[low], listed[until - 1]
            same = next((i for i in range(at, min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            found.append((ord(first), literal(a[at:same]) + branches(low, until, same, depth + 1)))
            low = until
        if not found:
            return ""
        either = halved(found)
        return f"(?:{either}){'?' if ends else ''}" if ends or len(found) > 1 else either

    try:
        return branches(0, len(listed), 0, 0)
    except RecursionError:
        return None


def _scanned(rows: DataFrame, listed: list[str], tree: str, longest: int) -> DataFrame:
    """(_key, _term, _n) of lower-cased ``_text``, one row per place and term that begins there."""
    spark, size = rows.sparkSession, max(SCAN_PIECE, longest)
    pattern = spark.createDataFrame([(f"(?=({tree}))",)], "pattern string").scalar()
    text = F.col("_text")
    cut = F.when(F.char_length(text) <= size, F.array(text)).otherwise(_pieces(text, size, longest))
    # What follows the places of a piece is the beginning of the next; it is taken off again.
    after = F.transform(cut, lambda p: F.struct(F.substring(p, size + 1, longest).alias("text"), F.lit(-1).alias("n")))
    parts = F.concat(F.transform(cut, lambda p: F.struct(p.alias("text"), F.lit(1).alias("n"))), F.filter(after, lambda p: p["text"] != ""))
    pieces = rows.where("_key IS NOT NULL").select("_key", F.explode(parts).alias("_piece"))
    found = pieces.select("_key", F.col("_piece.n").cast("long").alias("_n"), F.explode(F.regexp_extract_all("_piece.text", pattern, 1)).alias("_term"))
    # Whatever else begins at a place begins the longest term there.
    known = set(listed)
    begun = [(t, t[:n]) for t in listed for n in range(1, len(t) + 1) if t[:n] in known]
    if len(begun) > len(listed):
        pairs = spark.createDataFrame(begun, "_term string, _begun string")
        found = found.join(F.broadcast(pairs), "_term").select("_key", F.col("_begun").alias("_term"), "_n")
    return found


def _joined(rows: DataFrame, listed: DataFrame, longest: int, lengths: list[int], small: bool) -> DataFrame:
    """(_key, _term, _n) of lower-cased ``_text``, one row per piece with the term, by an equi-join."""
    size = max(PIECE, longest)
    filed = listed.withColumn("_prefix", F.left("_term", _filed_under("_term")))
    pieces = rows.where("_key IS NOT NULL").select("_key", F.explode(_pieces(F.col("_text"), size, longest)).alias("_piece"))
    probes = pieces.select("_key", "_piece", F.explode(_beginnings(F.col("_piece"), size, lengths)).alias("_prefix"))
    found = probes.join(F.broadcast(filed) if small else filed, "_prefix")
    return found.select("_key", "_term", _starts(F.col("_piece"), F.col("_term"), size).alias("_n")).where("_n > 0")


def term_matches(df: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term", search_bytes: int = 0, broadcast_bytes: int = BROADCAST_BYTES, scan_bytes: int = SCAN_BYTES) -> DataFrame:
    """(key, term, n): at how many places of the text each listed term begins, ignoring case.

    Every place counts, also where occurrences overlap: ``aa`` begins at two places of ``aaa``. Terms are
    lower-cased and listed once; empty and missing terms, and rows without key or text, match nothing. Rows
    with one key are counted together. A term that does not occur has no row.
    """
    listed = terms.select(F.lower(term).alias("_term")).where("_term <> ''").distinct()
    facts = listed.agg(
        F.max(F.char_length("_term")).alias("longest"), F.sum(F.octet_length("_term") + 32).alias("bytes"),
        F.sort_array(F.collect_set(_filed_under("_term"))).alias("lengths"),
    ).first()
    rows = df.select(F.col(key).alias("_key"), F.lower(text).alias("_text"))
    few = sorted(r[0] for r in listed.collect()) if search_bytes < (facts["bytes"] or 0) <= min(scan_bytes, broadcast_bytes) else []
    tree = _tree(few) if few else None
    if not facts["bytes"]:
        found = rows.select("_key", F.col("_text").alias("_term"), F.lit(0).cast("long").alias("_n")).limit(0)
    elif facts["bytes"] <= search_bytes:
        found = _searched(rows, [r[0] for r in listed.collect()])
    elif tree:
        found = _scanned(rows, few, tree, facts["longest"])
    else:
        found = _joined(rows, listed, facts["longest"], facts["lengths"], facts["bytes"] <= broadcast_bytes)
    counts = found.groupBy("_key", "_term").agg(F.sum("_n").alias("n"))
    return counts.select(F.col("_key").alias(key), F.col("_term").alias("term"), "n")
