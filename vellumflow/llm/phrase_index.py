"""Benchmark decontamination by a positional inverted index.

``build`` stores the index: documents are cut into segments of bounded size, and each
segment keeps, for every indexed term, the sorted positions of the term in the
segment's word sequence. ``search`` runs a stated set of phrases against every
segment: a phrase begins at the postings of its rarest term (by counts over the whole
index), and the offset-adjusted postings of its other terms are intersected with them
from the next rarest on. With a slop of 0 all terms stand at their places (an exact
phrase); with a slop of s each may stand up to s words from its place (a proximity match).

A segment holds whole documents, so all postings that can meet are in one row of
the index: nothing is shuffled by term, and a term or passage in a third of the
documents is work for their own segments only. Phrases reach the tasks in blocks of
at most ``BLOCK_PHRASES``, one pass over the index each; only terms of the phrases are
indexed when they are fewer than ``MAX_VOCABULARY``, else all terms.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: null and empty texts have no words and no hits, items without words
no phrase. Every input row is a document of its own, so repeated rows give repeated
results; items that share a phrase both count; items of equal id are one item. Columns
other than the id and text are not read. Empty tables give no rows, and documents
against an empty benchmark no hits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vellumflow.llm import textbytes as B
from vellumflow.llm.tables import Tables

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PHRASE_WORDS = 13
BLOCK_PHRASES = 200_000
MAX_VOCABULARY = 2_000_000
SEGMENT = T.StructType([T.StructField(n, T.BinaryType()) for n in ("docs", "first", "terms", "ends", "places")])
LONG = pa.int64()


# --- the index ---------------------------------------------------------------------------


def segment(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None) -> dict[str, bytes]:
    """Postings of a block of documents: ``terms`` sorted by hash, the ``places`` of term k
    from ``ends[k - 1]`` to ``ends[k]``, ``first`` the first word of each document."""
    hashes, first = B.words(data, offsets, B.LETTER_DIGIT)
    places = np.arange(len(hashes))
    if vocabulary is not None:
        known = np.searchsorted(vocabulary, hashes)
        known[known == len(vocabulary)] = 0
        places = np.flatnonzero(vocabulary[known] == hashes) if len(vocabulary) else places[:0]
        order = np.argsort(known[places], kind="stable")  # terms as small numbers sort faster
    else:
        order = np.argsort(hashes, kind="stable")
    places = places[order]
    sorted_hashes = hashes[places]
    start = np.flatnonzero(np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])) if len(places) else places
    ends = np.append(start[1:], len(places)) if len(places) else places
    return {
        "docs": ids.astype("<i8").tobytes(),
        "first": first.astype("<i4").tobytes(),
        "terms": sorted_hashes[start].astype("<u8").tobytes(),
        "ends": ends.astype("<i4").tobytes(),
        "places": places.astype("<i4").tobytes(),
    }


def build(docs: DataFrame, folder: str, vocabulary: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index of ``docs`` under ``folder`` and read it back."""
    schema = T.StructType([*SEGMENT.fields, T.StructField("no_id", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.flat(batch.column(1))
            column = batch.column(0)
            ids, missing = column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
            for i, j in B.blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                row = segment(ids[i:j], part, offsets[i : j + 1] - offsets[i], vocabulary)
                row["no_id"] = np.packbits(missing[i:j]).tobytes()
                yield pa.RecordBatch.from_pylist([row], pa.schema([(f.name, pa.binary()) for f in schema.fields]))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A segment is a page of its own: pages of many would be as large as all of them.
    rows.mapInArrow(task, schema).write.option("parquet.page.row.count.limit", "1").parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): occurrences of every indexed term, added up per task before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.frombuffer(row["ends"], "<i4").astype(np.int64)
                terms = np.frombuffer(row["terms"], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.diff(ends, prepend=0))], names=["term", "n"])

    return index.select("terms", "ends").mapInArrow(task, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


# --- phrases -----------------------------------------------------------------------------


def phrases_of(items: DataFrame, length: int = PHRASE_WORDS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): the distinct windows of ``length`` words of every item; an item of
    fewer words, but not none, is one window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.flat(batch.column(1))
            hashes, first = B.words(data[offsets[0] : offsets[-1]], offsets - offsets[0], B.LETTER_DIGIT)
            signed = hashes.view(np.int64)
            ids, found = [], []
            for item, i, j in zip(batch.column(0).to_pylist(), first[:-1], first[1:]):
                for k in range(i, max(j - length, i) + 1 if j > i else i):
                    ids.append(item)
                    found.append(signed[k : min(k + length, j)].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, LONG), pa.array(found, pa.list_(LONG))], names=["item_id", "terms"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(task, "item_id long, terms array<long>").distinct()


class Phrases:
    """A block of phrases as the tasks use it: for each, its terms from the rarest on."""

    def __init__(self, rows: list[tuple[int | None, list[int]]], counts: dict[int, int]):
        own: dict[tuple[int, ...], int] = {}
        pairs = sorted({(own.setdefault(tuple(terms), len(own)), item) for item, terms in rows}, key=lambda p: (p[0], p[1] is not None, p[1] or 0))
        self.phrase = np.array([p for p, _ in pairs], np.int64)  # phrase and item, sorted by phrase
        self.items = [i for _, i in pairs]
        longest = max(map(len, own), default=0)
        self.length = np.array([len(p) for p in own], np.int64)
        self.terms = np.zeros((len(own), longest), np.int64)
        self.offsets = np.full((len(own), longest), -1, np.int64)  # -1: no such term
        for k, p in enumerate(own):
            order = sorted(range(len(p)), key=lambda i: (counts.get(p[i], 0), i))
            self.terms[k, : len(p)] = [p[i] for i in order]
            self.offsets[k, : len(p)] = order
        self.rarest, self.by_rarest = np.unique(self.terms[:, 0].view(np.uint64), return_inverse=True) if len(own) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def occurrences(row: dict[str, bytes], phrases: Phrases, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place of its first word, document) of every match in a segment."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    terms = np.frombuffer(row["terms"], "<u8")
    ends = np.frombuffer(row["ends"], "<i4").astype(np.int64)
    places = np.frombuffer(row["places"], "<i4").astype(np.int64)
    first = np.frombuffer(row["first"], "<i4").astype(np.int64)
    if not len(terms) or not len(phrases.length):
        return none
    starts = np.append(0, ends[:-1])

    def number(hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
        return np.where(terms[at] == hashes, at, -1)

    rare = number(phrases.rarest)[phrases.by_rarest]
    phrase = np.flatnonzero(rare >= 0)
    count = ends[rare[phrase]] - starts[rare[phrase]]
    total = int(count.sum())
    if not total:
        return none
    which = np.repeat(phrase, count)
    within = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    start = places[starts[rare[which]] + within] - phrases.offsets[which, 0]
    doc = np.searchsorted(first, start + phrases.offsets[which, 0], side="right") - 1
    if not slop:  # the whole phrase must lie in one document; with a slop, each term found
        fits = (start >= first[doc]) & (start + phrases.length[which] <= first[doc + 1])
        which, start, doc = which[fits], start[fits], doc[fits]
    width = np.int64(1 << 32)
    keys = np.repeat(np.arange(len(terms)), ends - starts) * width + places  # ascending
    for k in range(1, phrases.terms.shape[1]):
        offset = phrases.offsets[which, k]
        on = offset >= 0
        if not on.any():
            break
        term = number(phrases.terms[which, k].view(np.uint64))
        low = np.maximum(start + offset - slop, first[doc])
        high = np.minimum(start + offset + slop, first[doc + 1] - 1)
        at = np.minimum(np.searchsorted(keys, term * width + low), len(keys) - 1)
        kept = ~on | ((term >= 0) & (keys[at] >= term * width + low) & (keys[at] <= term * width + high))
        which, start, doc = which[kept], start[kept], doc[kept]
    return which, start, doc


def _blocks(phrases: DataFrame, index: DataFrame) -> list[Phrases]:
    """The phrases with the counts of their terms, in blocks of bounded size."""
    n = phrases.count()
    size = max(1, -(-n // BLOCK_PHRASES))
    wanted = phrases.select(F.explode("terms").alias("term")).distinct()
    counts = {r["term"]: r["n"] for r in term_counts(index).join(wanted, "term", "left_semi").toLocalIterator()}
    if size == 1:
        return [Phrases([(r[0], r[1]) for r in phrases.collect()], counts)] if n else []
    # All windows of an item stay in one block, so that its hits are counted there.
    block = F.pmod(F.xxhash64("item_id"), F.lit(size))
    return [Phrases([(r[0], r[1]) for r in phrases.where(block == k).collect()], counts) for k in range(size)]


def _shipped(spark: SparkSession, phrases: Phrases) -> Broadcast[SimpleNamespace]:
    """A block for the tasks; as a plain object, since a broadcast names classes by their module."""
    return spark.sparkContext.broadcast(SimpleNamespace(**vars(phrases)))


def _rows(row: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["docs"], "<i8")
    missing = np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=len(ids)).astype(bool)
    return ids, missing, np.frombuffer(row["first"], "<i4").astype(np.int64)


def matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """(doc_id, item_id, first_word, n_words): every place where a phrase of an item occurs,
    exactly (slop 0) or with each word at most ``slop`` words from its place as the rarest
    word tells it; the first word's place may then lie outside the document."""

    def task_of(shipped):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shipped.value
            for batch in batches:
                for row in batch.to_pylist():
                    ids, missing, first = _rows(row)
                    which, start, doc = occurrences(row, own, slop)
                    low = np.searchsorted(own.phrase, which)
                    count = np.searchsorted(own.phrase, which, side="right") - low
                    pair = np.repeat(low, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    start, doc, length = np.repeat(start, count), np.repeat(doc, count), np.repeat(own.length[which], count)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[doc], mask=missing[doc]), pa.array([own.items[p] for p in pair], LONG), pa.array(start - first[doc]), pa.array(length)],
                        names=["doc_id", "item_id", "first_word", "n_words"],
                    )

        return task

    spark = index.sparkSession
    schema = "doc_id long, item_id long, first_word long, n_words long"
    found = [index.mapInArrow(task_of(_shipped(spark, p)), schema) for p in _blocks(phrases, index)]
    out = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def contamination(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """One row per indexed document: doc_id, n_words, n_hit (words inside an occurrence of a
    phrase), n_items, items_sha256 (of the ids of items that occur, sorted as strings and
    joined by commas) and contaminated (n_hit > 0 and 20 * n_hit >= n_words)."""
    spark = index.sparkSession
    shipped = [_shipped(spark, p) for p in _blocks(phrases, index)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, missing, first = _rows(row)
                words = np.diff(first)
                covered = np.zeros(int(first[-1]), bool)
                found: list[set[str]] = [set() for _ in ids]
                for block in shipped:
                    own = block.value
                    which, start, doc = occurrences(row, own)
                    edge = np.zeros(len(covered) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + own.length[which], -1)
                    covered |= np.cumsum(edge)[:-1] > 0
                    for p, d in set(zip(which.tolist(), doc.tolist())):
                        i, j = np.searchsorted(own.phrase, [p, p + 1])
                        found[d].update(str(x) for x in own.items[i:j] if x is not None)
                upto = np.append(0, np.cumsum(covered))
                hit = upto[first[1:]] - upto[first[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, mask=missing), pa.array(words), pa.array(hit), pa.array([len(f) for f in found], LONG),
                        pa.array([sha256(",".join(sorted(f)).encode()).hexdigest() for f in found], pa.string()),
                        pa.array((hit > 0) & (20 * hit >= words)),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return index.mapInArrow(task, schema)


def decontaminate(docs: DataFrame, items: DataFrame, folder: str, length: int = PHRASE_WORDS) -> DataFrame:
    """Index ``docs``, search all phrases of ``items``, drop the index; see ``contamination``.
    The result is kept under ``folder``."""
    phrases = phrases_of(items, length)
    terms = phrases.select(F.explode("terms").alias("term")).distinct()
    few = terms.limit(MAX_VOCABULARY + 1).collect()
    vocabulary = np.sort(np.array([r[0] for r in few], np.int64).view(np.uint64)) if len(few) <= MAX_VOCABULARY else None
    index = build(docs, f"{folder}/index", vocabulary)
    index_only = Tables(docs.sparkSession)
    index_only.paths.append(f"{folder}/index")
    found = contamination(index, phrases)
    found.write.parquet(f"{folder}/found")
    index_only.discard()
    return docs.sparkSession.read.schema(found.schema).parquet(f"{folder}/found")
