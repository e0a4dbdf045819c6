"""Removal of repeated byte strings by sorting the suffixes of a content-defined cover.

A byte is removed when a string of ``length`` bytes that covers it also starts anywhere
else. Sorting every suffix of a corpus costs many times its size on disk (a difference
cover modulo 3 alone sorts two thirds of all positions as triples), so positions are
covered by content instead of by residue, which keeps the property the method rests on:
two equal strings have a sampled position at the same distance from their starts.

* Sample: in every window of ``length`` bytes the position with the smallest short hash of its
  next ``GRAM`` bytes, leftmost on ties, is sampled. Equal windows sample the same place,
  and each position serves a run of consecutive starts (about half a window).
* Sort the samples as triples (hash of the gram, reach to the left and right of it, name
  of the bytes its windows cover). Equal triples next to each other in the order get
  one name; a gram that occurs once, as most do, leaves the sort.
* Recurse on what is still open: a run whose triple is unique, though its gram is not, is
  cut into pieces of ``PIECE`` starts at fixed distances from the sample, which are named
  and sorted again, then into single starts: the remaining suffixes, each with its
  distance to a sample and the name of its next ``length`` bytes.
* Compare neighbours: suffixes with equal prefixes carry equal names. Resolved runs take
  part in the finer sorts through one representative per name, and only where another
  run of the same gram is open, so every equal pair is seen at some level. A piece stays
  open only if the bytes that all its windows share occur twice.

With ``words`` the units are words between blanks instead of bytes: a passage of ``length``
words is repeated if the same words, blanks aside, stand anywhere else. What goes is from
the first of its words to the word after it, and blanks at the text's begin go with the
first word. A text without blanks is one word.

All sorts are aggregations and joins by hashed names, whose hot values (a passage in a
third of the documents) Spark adds up before the shuffle and splits in the join. Equal
texts are one class and enter once per batch; a class of two rows or more is removed whole.

Defined results: null and empty texts have no bytes. Texts shorter than ``length`` are kept,
also repeated ones. Matches never cross texts. Repeated rows are repeated texts. All
columns are kept, the added ones replace columns of their names; empty tables stay empty.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vellumflow.llm import textbytes as B
from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
GRAM = 64
PIECE = 16
U64 = np.uint64
CLASS = ["h1", "h2"]
RUN = "gram long, coord long, name long, h1 long, h2 long, at int, low int, high int"
RUN_NAMES = [f.split()[0] for f in RUN.split(", ")]


def _batch(gram, coord, name, h1, h2, at, low, high) -> pa.RecordBatch:
    signed = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (gram, coord, name)]
    small = [pa.array(x.astype(np.int32)) for x in (at, low, high)]
    return pa.RecordBatch.from_arrays([*signed, pa.array(h1), pa.array(h2), *small], names=RUN_NAMES)


def unit_sums(data: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the units of a block of documents, and the documents' offsets in units."""
    if not words:
        return B.prefix_hash(data), offsets
    start, end, first = B.word_spans(data, offsets, B.NOT_SPACE)
    return B.prefix_sums(B.span_hash(B.prefix_hash(data), start, end)), first


def sample(prefix: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(sampled place, first start, last start, hash of its gram): the runs of starts served by
    each sampled place of a block of documents; places count from the block's begin."""
    window = length - gram + 1
    n = len(prefix) - gram
    starts = [np.arange(i, j - length + 1) for i, j in zip(offsets[:-1], offsets[1:]) if j - i >= length]
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U64)
    start = np.concatenate(starts)
    order = B.span_order(prefix, gram) | np.arange(n).astype(U64)
    # Smallest of every window: from its begin to a block's end, and from there on.
    blocks = -(-n // window)
    padded = np.full(blocks * window, U64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = order
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    best = (np.minimum(behind[start], ahead[start + window - 1]) & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    place = best[first]
    return place, start[first], start[last], B.span_hash(prefix, place, place + gram)


def named(prefix: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, base: int) -> np.ndarray:
    """Name of the bytes that the windows starting ``high`` to ``low`` before a place cover."""
    reach = ((low % base) * (1 << 31) + high - low).astype(U64)
    return B.mix(B.span_hash(prefix, place - high, place - low + length) ^ B.mix(reach + U64(base)))


def runs(docs: DataFrame, length: int, gram: int, words: bool) -> DataFrame:
    """The sampled runs of all distinct texts (h1, h2, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            data, offsets = B.flat(batch.column(2))
            h1, h2 = (batch.column(k).to_numpy() for k in (0, 1))
            for i, j in B.blocks(offsets):
                fresh = np.zeros(j - i, bool)
                for k in range(i, j):
                    key = (int(h1[k]), int(h2[k]))
                    if offsets[k + 1] - offsets[k] >= length and key not in seen:
                        seen.add(key)
                        fresh[k - i] = True
                if not fresh.any():
                    continue
                prefix, own = unit_sums(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                place, first, last, grams = sample(prefix, own, length, gram)
                doc = np.searchsorted(own, first, side="right") - 1
                chosen = fresh[doc]
                place, first, last, grams, doc = place[chosen], first[chosen], last[chosen], grams[chosen], doc[chosen]
                low, high = place - last, place - first
                names = named(prefix, place, low, high, length, 1 << 30)
                yield _batch(grams, grams, names, h1[i + doc], h2[i + doc], place - own[doc], low, high)

    return docs.select("h1", "h2", "text").mapInArrow(task, RUN)


def pieces(texts: DataFrame, length: int, size: int, words: bool) -> DataFrame:
    """The runs of each text (h1, h2, text, runs) cut into pieces of ``size`` starts at fixed
    distances from the sampled place."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.flat(batch.column(2))
            for k in range(batch.num_rows):
                prefix, _ = unit_sums(data[offsets[k] : offsets[k + 1]], offsets[k : k + 2] - offsets[k], words)
                table = batch.column(3)[k].values
                gram, at, low, high = (table.field(x).to_numpy().astype(np.int64) for x in ("gram", "at", "low", "high"))
                from_, to = low // size, high // size
                count = to - from_ + 1
                which = np.repeat(np.arange(len(at)), count)
                number = from_[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                low, high = np.maximum(low[which], number * size), np.minimum(high[which], number * size + size - 1)
                g, latest = gram[which].view(U64), at[which] - number * size
                # What all windows of a piece share: pieces without it in common share no window.
                core = B.span_hash(prefix, latest, latest - size + 1 + length)
                coord = B.mix(g ^ core ^ B.mix((number * (1 << 31) + size).astype(U64)))
                names = named(prefix, at[which], low, high, length, size)
                h1, h2 = (np.full(len(which), batch.column(c)[k].as_py()) for c in (0, 1))
                yield _batch(g, coord, names, h1, h2, at[which], low, high)

    return texts.select("h1", "h2", "text", "runs").mapInArrow(task, RUN)


def resolve(level: DataFrame) -> DataFrame:
    """Runs of a level that are repeated (``repeated``) or to be cut finer (``open``)."""
    occurrence = F.xxhash64("h1", "h2", "at", "low")
    names = level.groupBy("coord", "name").agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last"))
    names = names.withColumn("repeated", F.col("first") != F.col("last"))
    coords = names.groupBy("coord").agg(F.min("first").alias("low_one"), F.max("last").alias("high_one"), F.bool_or(~F.col("repeated")).alias("some_open"))
    coords = coords.where("low_one <> high_one").select("coord", "some_open")
    names = names.join(coords, "coord").where("repeated OR some_open").select("coord", "name", "first", "repeated", "some_open")
    told = lookup(level.withColumn("occurrence", occurrence), names, ["coord", "name"], "inner")
    still = F.col("some_open") & (~F.col("repeated") | (F.col("occurrence") == F.col("first")))
    return told.select(*RUN_NAMES, "repeated", still.alias("open"))


def with_class(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the class of each text: two hashes of its bytes (null is empty)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"h1": F.xxhash64(whole), "h2": F.xxhash64(F.lit(1), whole)})


def has_units(text: str, length: int, words: bool) -> Column:
    """Whether a text has ``length`` units."""
    if not words:
        return F.octet_length(text) >= length
    blank, other = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    return (F.octet_length(text) >= 2 * length - 1) & F.col(text).rlike(rf"^{blank}*+(?:{other}++{blank}++){{{length - 1}}}{other}")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", words: bool = False,
) -> DataFrame:
    """(h1, h2, whole, spans): classes with bytes to remove: the whole text, or maximal runs of
    units as sorted (start, end), ends excluded."""
    rows = with_class(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    long = has_units("text", length, words)
    # One row per class fetches its text again; a null id is no key, so a class prefers others.
    classes = rows.select(*CLASS, F.coalesce("doc_id", F.lit(-(1 << 62))).alias("doc_id"), long.alias("long")).where("long")
    lasting, tables, level_ = Tables(docs.sparkSession), Tables(docs.sparkSession), Tables(docs.sparkSession)
    classes = tables.keep(classes.groupBy(*CLASS).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "classes")
    keyed = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 62))))

    def fetched(spans: DataFrame, column: str) -> DataFrame:
        """The text of each class in ``spans``."""
        wanted = spans.join(classes.drop("copies"), CLASS)
        return keyed.join(wanted, [*CLASS, "doc_id"]).select(*CLASS, "text", column)

    level = level_.keep(runs(rows.where(long), length, gram, words), "runs")
    covered = None
    for size in (PIECE, 1, 0):
        told = tables.keep(resolve(level), "told")
        level_.discard()
        found = told.where("repeated").select(*CLASS, (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"))
        covered = found if covered is None else covered.unionByName(found)
        if size:
            per_class = told.where("open").groupBy(*CLASS).agg(F.collect_list(F.struct("gram", "at", "low", "high")).alias("runs"))
            level = level_.keep(pieces(fetched(per_class, "runs"), length, size, words), "pieces")
    spans = merged(covered.groupBy(*CLASS).agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    both = classes.where("copies > 1").select(*CLASS, F.lit(True).alias("whole")).join(spans, CLASS, "full")
    found = lasting.keep(both.select(*CLASS, F.coalesce("whole", F.lit(False)).alias("whole"), "spans"), "spans")
    tables.discard()
    return found


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def merged(per_class: DataFrame) -> DataFrame:
    """Spans of each class sorted, and joined where they overlap or touch."""

    def joined(spans: pa.StructArray) -> list[dict[str, int]]:
        start, end = (spans.field(x).to_numpy() for x in ("start", "end"))
        order = np.argsort(start, kind="stable")
        start, reach = start[order], np.maximum.accumulate(end[order])
        new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
        return [{"start": int(a), "end": int(b)} for a, b in zip(start[new], reach[np.append(new[1:], len(start)) - 1])]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [joined(batch.column(2)[k].values) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], names=[*CLASS, "spans"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in CLASS] + [T.StructField("spans", SPANS)])
    return per_class.select(*CLASS, "spans").mapInArrow(task, schema)


def cut(text: bytes, spans: list[dict[str, int]]) -> bytes:
    """What is left of a text without the spans."""
    edges = [0, *[x for s in spans for x in (s["start"], s["end"])], len(text)]
    return b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2]))


def byte_spans(text: bytes, spans: list[dict[str, int]]) -> list[dict[str, int]]:
    """Spans of words as spans of bytes."""
    start, _, _ = B.word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]), B.NOT_SPACE)
    edges = np.append(start, len(text))
    edges[0] = 0
    return [{"start": int(edges[s["start"]]), "end": int(edges[s["end"]])} for s in spans]


def united(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    """Spans of bytes sorted, and joined where they overlap or touch."""
    out: list[dict[str, int]] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def _cut_classes(rows: DataFrame, found: DataFrame, words: bool) -> DataFrame:
    """(h1, h2, removed, spans, left): bytes and spans removed and the digest of what is left, of each class
    in ``found``; removed is null for a class removed whole. ``rows``: (h1, h2, key, text)."""
    partly = found.where("NOT whole")
    # The text of one row of each class that is cut.
    first = lookup(rows.select(*CLASS, "key"), partly.select(*CLASS), CLASS, "left_semi").groupBy(*CLASS).agg(F.min("key").alias("key"))
    texts = rows.join(first.join(partly, CLASS), [*CLASS, "key"]).dropDuplicates(CLASS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, left = [], [], []
            for text, own in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
                own = byte_spans(text, own) if words else own
                removed.append(sum(s["end"] - s["start"] for s in own))
                spans.append(len(own))
                left.append(sha256(cut(text, own)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(left)], names=["h1", "h2", "removed", "spans", "left"])

    part = texts.select(*CLASS, "text", "spans").mapInArrow(task, "h1 long, h2 long, removed long, spans long, left string")
    whole = found.where("whole").select(*CLASS, F.lit(None).cast("long").alias("removed"), F.lit(1).cast("long").alias("spans"), F.sha2(F.lit(b""), 256).alias("left"))
    return part.unionByName(whole)


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes left) per row.

    With ``passage`` (words, words of a gram) also n_passage_removed and passage_kept_sha256: what the rule for
    passages of words removes, judged on the input as well.
    """
    rows = with_class(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    keyed = rows.select(*CLASS, F.coalesce("doc_id", F.lit(-(1 << 62))).alias("key"), "text")
    told = rows.select("doc_id", *CLASS, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    told = lookup(told, _cut_classes(keyed, repeated_spans(docs, length, gram), False), CLASS)

    def removed() -> Column:
        return F.when(F.col("left").isNull(), F.lit(0)).otherwise(F.coalesce("removed", "n_bytes"))

    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    own = [F.coalesce("spans", F.lit(0)).alias("n_spans"), F.coalesce("left", "sha").alias("kept_sha256")]
    told = told.select("doc_id", *CLASS, "n_bytes", "sha", removed().alias("n_removed"), *own)
    if passage:
        cut_words = _cut_classes(keyed, repeated_spans(docs, *passage, words=True), True)
        told = lookup(told, cut_words, CLASS).withColumns({"n_passage_removed": removed(), "passage_kept_sha256": F.coalesce("left", "sha")})
        columns += ["n_passage_removed", "passage_kept_sha256"]
    return told.select(*columns)


def clean(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: bool = False, also: tuple[tuple[int, int, bool], ...] = (),
) -> DataFrame:
    """``docs`` with ``text`` without its repeated bytes and ``spans`` (what was removed, as bytes
    of the text before). Bytes left of a character that was cut through go too.

    ``also`` are further rules (length, gram, words); all are judged on the input, and what any of them finds goes.
    """
    rules = [(length, gram, words), *also]
    others = [c for c in docs.columns if c not in ("text", "spans")]
    # The other columns travel as one, whatever their names.
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None).alias("none"))
    told = with_class(docs.select("text", row.alias("row")))
    for k, (n, g, w) in enumerate(rules):
        found = repeated_spans(docs, n, g, words=w)
        told = lookup(told, found.select(*CLASS, F.col("whole").alias(f"whole{k}"), F.col("spans").alias(f"spans{k}")), CLASS)
    told = told.drop(*CLASS)
    schema = T.StructType([told.schema["row"], T.StructField("text", T.StringType()), T.StructField("spans", SPANS)])
    in_words = [w for _, _, w in rules]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            texts = column["text"].cast(pa.binary()).to_pylist()
            spans: list[list[dict[str, int]]] = [[] for _ in texts]
            for k, by_words in enumerate(in_words):
                for i, (t, w, s) in enumerate(zip(texts, column[f"whole{k}"].to_pylist(), column[f"spans{k}"].to_pylist())):
                    spans[i] += [{"start": 0, "end": len(t)}] if w else byte_spans(t, s) if s and by_words else (s or [])
            spans = [united(s) for s in spans]
            left = [cut(t, s).decode("utf-8", "ignore") if s else None if t is None else t.decode("utf-8", "replace") for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([column["row"], pa.array(left, pa.string()), pa.array(spans, kind)], names=["row", "text", "spans"])

    out = told.mapInArrow(task, schema)
    shown = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c != "spans"]
    return out.select(*shown, "spans")
