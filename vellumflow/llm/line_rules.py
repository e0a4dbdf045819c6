"""Line-first cleaning of documents, DataFrame operations only.

Every line with a word is judged by itself: it fails when too many of its characters
are symbols (punctuation rule), when it is a bar or list of links (navigation rule),
or when it has a phrase of site furniture (boilerplate rule). Failing lines are taken
out, and a document that loses too large a share of its word characters is rejected.
Base counts of the whole text (words, symbols, repeated lines, repeated 5-word windows)
reject documents that are too short or too repetitive.

All work of a document is in its own row: no shuffle, and a very long text is one row.
Repeated windows are found by sorting their hashes, only in documents that have any.

Defined results: null and empty texts have no words and fail the base rules. Repeated
rows give repeated results. All columns are kept; the added ones replace columns of
their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE_CHARS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_SYMBOL_PERCENT = 15
MIN_LINKS = 3
MAX_LOST_PERCENT = 50
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service", "terms of use",
    "click here", "subscribe to our newsletter", "sign up now", "log in to continue", "javascript is disabled",
)
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned", "lost_chars", "kept")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def window_hashes(words: Column) -> Column:
    """A hash for each window of words."""
    n = F.size(words)
    parts = lambda i: [F.get(words, i + k) for k in range(WINDOW)]
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*parts(i)))).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that are found twice or more, each counted once."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    repeated = _let(ordered, lambda s: F.filter(s, lambda e, j: same(e, F.get(s, j - 1)) | same(e, F.get(s, j + 1))))
    starts = F.sort_array(F.transform(repeated, lambda e: e["i"]))
    gaps = _let(starts, lambda s: F.transform(s, lambda e, j: F.least(F.lit(WINDOW), F.coalesce(e - F.get(s, j - 1), F.lit(WINDOW)))))
    count = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count).otherwise(F.lit(0).cast("long"))


def line_fails(line: Column) -> Column:
    """Whether a line is symbols, navigation or site furniture rather than prose."""
    bare = without(line, SPACE_CHARS)
    symbols = F.length(bare) - F.length(without(bare, SYMBOLS))
    links = F.length(line) - F.length(without(line, "|>»"))
    prose = F.rtrim(line).rlike(r"[.!?:;\"'”’)…]\s*$")
    furniture = F.lit(False)
    low = F.lower(line)
    for phrase in BOILERPLATE:
        furniture = furniture | low.contains(phrase)
    return (100 * symbols > MAX_SYMBOL_PERCENT * F.length(bare)) | ((links >= MIN_LINKS) & ~prose) | furniture


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts, ``cleaned`` (the text without failing lines), ``lost_chars``
    (word characters on those lines) and ``kept``."""
    kept = [F.col(f"`{c}`") for c in df.columns if c == text or c not in ADDED]
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(*kept, F.filter(F.split(whole, SPACES), lambda w: w != "").alias("_words"), F.split(whole, "\n").alias("_lines"))
    rows = rows.select("*", window_hashes(F.col("_words")).alias("_hashes"), F.filter("_lines", lambda x: without(x, SPACE_CHARS) != "").alias("_full"))
    rows = rows.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(whole, SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(without(whole, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_hashes")).alias("n_repeat_words"),
        F.filter("_lines", lambda x: ~line_fails(x) | (without(x, SPACE_CHARS) == "")).alias("_good"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("cleaned", F.array_join("_good", "\n"))
    lost = F.col("word_chars") - F.length(without(F.col("cleaned"), SPACE_CHARS))
    rows = rows.withColumn("lost_chars", lost.cast("long"))
    verdict = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))
    return rows.withColumn("kept", verdict).drop("_words", "_lines", "_hashes", "_full", "_good")
