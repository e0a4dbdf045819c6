"""N-gram Jaccard join by parity sketches.

A text's set is its distinct shingles of four words. A parity sketch flips one bit per
shingle, so the Hamming distance of two sketches is at most the symmetric difference of
the sets. The join uses it twice:

* Sets within a size band share a scheme: shingles are dealt over m blocks, and a block's
  sketch is the XOR of its shingles' 64-bit hashes. Sets that link differ in at most
  d shingles, d known from the band, hence in at most d blocks; with m > d blocks, two
  linked sets agree on m - d blocks (pigeonhole). A set with fewer than m - d empty
  blocks agrees with any partner on a block that is not empty, so only such blocks are
  join keys. Sets with more empty blocks (rare, short texts) are dealt again under other
  seeds; under the last one their empty blocks are keys too. A set near its band's upper
  end also joins under the next band's scheme. No link can be missed.
* Of its m keys a set needs only the d + 1 rarest (prefix filter): with the keys of all sets in
  one order, by the number of sets that have them and empty blocks last, two sets that agree on
  m - d blocks share one of the first d + 1 of each. A text that shares a common passage, or lies
  far out in a cloud of near copies, has rare keys enough of its own and leaves the common ones out.
* Pairs of a key are dropped within the join when their sizes, or the Hamming distance of their
  1024-bit sketches, exceed what a link allows; the rest are verified on the sets.

Equal sets are one class, and classes, not documents, are joined. Sets that share a key
are not paired with each other: the class of a key that has most keys in common with
others is its centre and is paired with the others. After the links found so far are closed into components, keys whose
classes are still in several components take their next 8, 64, 512, ... classes as
centres, and only pairs in different components are verified, until every class has been
a centre. What a round links are the components that there were before it; a round without
pairs or links ends there. So copies and near copies, however many, cost a star, and no link between
different components is left out.

Keys travel in packed blobs by bucket, deduplicated per batch before the shuffle; equal
texts add nothing after their first in a batch.

Defined results: null texts and texts without words have an empty set, link with nothing
and are their own component. Repeated rows are copies. A row without a doc_id has the
component of the documents with an equal set, or null. Columns other than id and text are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from vellumflow.llm import textbytes as B
from vellumflow.llm.components import components, folded
from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
SKETCH_BITS = 1024
SEEDS = 4
TAGS = 2 * SEEDS  # a set's two schemes, each with its seeds
BAND_GROWTH = 1.5
KEY_ROWS = 4_000_000  # keys a reducing task sorts at once
BLOB_KEYS = 4096  # keys of a bucket that a task packs together, on average
CENTRE_GROWTH = 8


class Rule:
    """Shingle length, the share of the union that links, and the size bands that follow."""

    def __init__(self, words: int = 4, percent: int = 85):
        self.words, self.percent = words, percent
        smallest = 1
        while self.most_different(smallest, smallest + 1) < 1 and self.most_different(smallest, smallest) < 1:
            smallest += 1
        edges = [smallest]
        while edges[-1] < 1 << 31:
            edges.append(int(np.ceil(edges[-1] * BAND_GROWTH)))
        self.edges = np.array(edges, np.int64)
        tops = self.edges[1:] - 1
        self.different = self.most_different(tops, tops)  # d of each band
        self.blocks = self.different + 1 + np.maximum(2, self.different // 8)  # m of each band

    def most_different(self, a, b):
        """Largest symmetric difference with which sets of these sizes link."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)


# --- sets --------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of a block of documents, sorted, and set sizes.
    A text of fewer words is one shingle."""
    hashes, first = B.words(data, offsets, B.NOT_SPACE)
    n = len(first) - 1
    counts = np.diff(first)
    doc = B.documents_of(first)
    place = np.arange(len(hashes)) - first[doc]
    rolled = np.zeros(len(hashes), U64)
    for k in range(words):  # a polynomial of the word hashes; short texts have fewer terms
        there = np.append(hashes[k:], np.zeros(min(k, len(hashes)), U64))[: len(hashes)]
        inside = place + k < counts[doc]
        rolled = rolled * U64(0xD6E8FEB86659FD93) + np.where(inside, there | U64(1), U64(k + 1))
    starts = (place + words <= counts[doc]) | (place == 0)
    doc, rolled = doc[starts], B.mix(rolled[starts])
    order = np.lexsort((rolled, doc))
    doc, rolled = doc[order], rolled[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (rolled[1:] != rolled[:-1])) if len(doc) else np.zeros(0, bool)
    doc, rolled = doc[new], rolled[new]
    return doc, rolled, np.bincount(doc, minlength=n).astype(np.int64)


def fingerprints(doc: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    starts = np.cumsum(sizes) - sizes
    full = sizes > 0
    for salt in (0x1B873593CC9E2D51, 0x2127599BF4325C37):
        part = np.zeros(len(sizes), U64)
        if len(hashes):
            part[full] = np.add.reduceat(B.mix(hashes ^ U64(salt)), starts[full])
        out.append(part.view(np.int64))
    return out[0], out[1]


def sketches(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The parity sketch of each set as 64-bit integers."""
    bit = (hashes >> U64(54)).astype(np.int64)
    parity = (np.bincount(doc * SKETCH_BITS + bit, minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(n, SKETCH_BITS), axis=1, bitorder="little").view("<i8")


def block_keys(doc: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, join key, allowances): the sketches of the blocks of every set under its schemes.

    The last bits of a key tell scheme and seed apart. The allowance of a set for each of them is d + 1 less its
    keys: with s of its keys shared, it needs the s + allowance rarest of these.
    """
    out_doc, out_key = [], []
    allowed = np.zeros((len(sizes), TAGS), np.int32)
    band = np.searchsorted(rule.edges, sizes, side="right") - 1
    upper = np.where((band >= 0) & (100 * sizes >= rule.percent * rule.edges[band + 1]), band + 1, -1)
    upper = np.where((band < 0) & (sizes > 0) & (100 * sizes >= rule.percent * rule.edges[0]), 0, upper)
    for scheme in (band, upper):
        wanted = scheme >= 0
        for seed in range(SEEDS):
            if not wanted.any():
                break
            chosen = wanted[doc]
            d, h = doc[chosen], hashes[chosen]
            m = rule.blocks[scheme[d]]
            spread = B.mix(h ^ U64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1))
            block = ((spread >> U64(32)) * m.astype(U64) >> U64(32)).astype(np.int64)
            group = d * (1 << 34) + block
            order = np.argsort(group, kind="stable")
            group, h = group[order], h[order]
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            found = np.bitwise_xor.reduceat(B.mix(h ^ U64(0xA0761D6478BD642F)), start)
            owner, number = group[start] >> 34, group[start] & ((1 << 34) - 1)
            name = B.mix((scheme[owner] * SEEDS + seed).astype(U64) << U64(34) | number.astype(U64))
            tag = ((scheme & 1) * SEEDS + seed).astype(U64)
            out_doc.append(owner)
            out_key.append(B.mix(found ^ name) & ~U64(TAGS - 1) | tag[owner])
            filled = np.bincount(owner, minlength=len(sizes))
            need = np.where(wanted, rule.blocks[np.maximum(scheme, 0)] - rule.different[np.maximum(scheme, 0)], 0)
            empty = np.where(wanted, rule.blocks[np.maximum(scheme, 0)] - filled, -1)
            own = np.flatnonzero(wanted)
            allowed[own, tag[own].astype(np.int64)] = rule.different[scheme[own]] + 1 - filled[own]
            wanted = wanted & (empty >= need)
            if seed == SEEDS - 1:
                for d in np.flatnonzero(wanted):  # next to never: empty blocks as keys
                    free = np.setdiff1d(np.arange(rule.blocks[scheme[d]]), number[owner == d])
                    name = B.mix(U64(int(scheme[d]) * SEEDS + seed) << U64(34) | free.astype(U64))
                    out_doc.append(np.full(len(free), d))
                    out_key.append(B.mix(name ^ U64(0x5851F42D4C957F2D)) & ~U64(TAGS - 1) | tag[d])
                    allowed[d, int(tag[d])] = rule.blocks[scheme[d]]  # all of them
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_doc]), np.concatenate([none.astype(U64), *out_key]), allowed


# --- passes over the texts ---------------------------------------------------------------

SIGNED = "doc_id long, n long, f1 long, f2 long, sketch array<long>, allowed array<int>, bucket int, keys binary, classes binary"


def sign(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """A row per document (doc_id, n, f1, f2, sketch), and rows of packed keys by bucket
    (``bucket`` not null) for the classes that a batch has."""
    names = [f.split()[0] for f in SIGNED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary()]

    def packed(keys: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
        bucket = ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, classes, bucket = keys[order], classes[order], bucket[order]
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.zeros(0, np.int64)
        ends = np.append(start[1:], len(keys))
        blobs = [[a[i:j].tobytes() for i, j in zip(start, ends)] for a in (keys, classes)]
        nulls = [pa.nulls(len(start), t) for t in types[:6]]
        return pa.RecordBatch.from_arrays([*nulls, pa.array(bucket[start]), *[pa.array(b, pa.binary()) for b in blobs]], names=names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            data, offsets = B.flat(batch.column(1))
            for i, j in B.blocks(offsets):
                doc, hashes, sizes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], rule.words)
                f1, f2 = fingerprints(doc, hashes, sizes)
                sketch = pa.FixedSizeListArray.from_arrays(pa.array(sketches(doc, hashes, j - i).reshape(-1)), SKETCH_BITS // 64).cast(types[4])
                ids = batch.column(0).slice(i, j - i)
                # One set of each class is enough.
                fresh = np.zeros(j - i, bool)
                fresh[np.unique(f1, return_index=True)[1]] = True
                fresh &= ~np.isin(f1, seen)
                seen = np.concatenate([seen, f1[fresh]])
                chosen = fresh[doc]
                owner, keys, allowed = block_keys(doc[chosen], hashes[chosen], np.where(fresh, sizes, 0), rule)
                needs = pa.FixedSizeListArray.from_arrays(pa.array(allowed.reshape(-1)), TAGS).cast(types[5])
                told = pa.compute.if_else(pa.array(fresh), needs, pa.nulls(j - i, types[5]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(f1), pa.array(f2), sketch, told, *[pa.nulls(j - i, t) for t in types[6:]]], names=names)
                kept.append((keys, f1[owner]))
                if sum(len(k) for k, _ in kept) > min(KEY_ROWS // 4, BLOB_KEYS * buckets):
                    yield packed(np.concatenate([k for k, _ in kept]), np.concatenate([c for _, c in kept]))
                    kept.clear()
        if kept:
            yield packed(np.concatenate([k for k, _ in kept]), np.concatenate([c for _, c in kept]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, SIGNED)


def shared_keys(signed: DataFrame, buckets: int) -> DataFrame:
    """(key, cls, freq) of keys that at least two classes have, and how many have them."""

    def repeated(keys: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(keys, kind="stable")
        keys, classes = keys[order], classes[order]
        # Drop keys of one row before the finer sort.
        same = keys[1:] == keys[:-1]
        many = np.append(same, False) | np.append(False, same)
        keys, classes = keys[many], classes[many]
        order = np.lexsort((classes, keys))
        keys, classes = keys[order], classes[order]
        if len(keys):
            new = np.append(True, (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1]))
            keys, classes = keys[new], classes[new]
            same = keys[1:] == keys[:-1]
            many = np.append(same, False) | np.append(False, same)
            keys, classes = keys[many], classes[many]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(classes), pa.array(np.repeat(size, size))], names=["key", "cls", "freq"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, classes = [], []
        for batch in batches:
            keys += [np.frombuffer(b, U64) for b in batch.column(0).to_pylist()]
            classes += [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
        if keys:
            k, c = np.concatenate(keys), np.concatenate(classes)
            # Equal keys share their leading bits: a large partition is sorted in ranges of keys.
            parts = -(-len(k) // KEY_ROWS)
            part = (B.mix(k) >> U64(32)) * U64(parts) >> U64(32)
            for p in range(parts):
                yield repeated(k[part == p], c[part == p])

    blobs = signed.where("bucket IS NOT NULL").select("bucket", "keys", "classes").repartition(buckets, "bucket")
    return blobs.select("keys", "classes").mapInArrow(task, "key long, cls long, freq long")


def rarest(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, cls, rank) of the keys that the prefix filter keeps, where two classes keep them. Ranks of a key
    count from 0, classes with most kept keys first."""
    tagged = shared.withColumn("tag", F.col("key").bitwiseAND(TAGS - 1))
    of_class = Window.partitionBy("cls", "tag")
    placed = tagged.withColumns({"place": F.row_number().over(of_class.orderBy("freq", "key")), "n_shared": F.count(F.lit(1)).over(of_class)})
    needs = placed.join(classes.select("cls", "allowed"), "cls").withColumn("kept", F.col("n_shared") + F.get("allowed", F.col("tag").cast("int")))
    needs = needs.where("place <= kept")
    of_key = Window.partitionBy("key")
    ranked = needs.withColumns({"rank": F.row_number().over(of_key.orderBy(F.desc("kept"), "cls")) - 1, "n_kept": F.count(F.lit(1)).over(of_key)})
    return ranked.where("n_kept > 1").select("key", "cls", F.col("rank").cast("long").alias("rank"))


def sets_of(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(f1, f2, n, shingles) of the sets of the documents whose ids are ``wanted``."""
    schema = "f1 long, f2 long, n long, shingles array<long>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.flat(batch.column(0))
            for i, j in B.blocks(offsets):
                doc, hashes, sizes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], rule.words)
                f1, f2 = fingerprints(doc, hashes, sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(f1), pa.array(f2), pa.array(sizes), lists], names=["f1", "f2", "n", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(task, schema).dropDuplicates(["f1", "f2", "n"])


# --- the join ----------------------------------------------------------------------------


WORDS = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def _near(named: DataFrame, low: int, high: int, rule: Rule) -> DataFrame:
    """(a, b, r_a, r_b, l_a, l_b): classes in different components that share a key, ``a`` one of its centres, and whose
    sizes and sketches allow a link, their representatives and labels. Both stand beside the key, so the join itself drops the others."""
    now = named.where((F.col("rank") >= low) & (F.col("rank") < high)).select("key", *[F.col(c).alias(f"{c}_a") for c in named.columns if c != "key"])
    n, n_a = F.col("n"), F.col("n_a")
    sizes = 100 * F.least(n, n_a) >= rule.percent * F.greatest(n, n_a)
    hamming = reduce(lambda x, y: x + y, [F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_a"))) for w in WORDS])
    allowed = hamming * (100 + rule.percent) <= (100 - rule.percent) * (n + n_a)
    found = lookup(named, now, ["key"], "inner").where((F.col("rank") > F.col("rank_a")) & (F.col("label") != F.col("label_a")) & sizes & allowed)
    ends = [F.col(f"{c}{side}").alias(f"{c[0]}_{x}") for c in ("rep", "label") for side, x in (("_a", "a"), ("", "b"))]
    return found.select(F.col("cls_a").alias("a"), F.col("cls").alias("b"), *ends).distinct()


def _links(near: DataFrame, docs: DataFrame, rule: Rule, tables: Tables) -> DataFrame:
    """(a, b): the labels of the pairs whose sets link."""
    reps = near.select(F.explode(F.array("r_a", "r_b")).alias("doc_id")).distinct()
    sets = tables.keep(sets_of(docs, reps, rule), "sets")
    own = lambda s: sets.select(F.col("f1").alias(s), F.col("n").alias(f"n_{s}"), F.col("shingles").alias(f"s_{s}"))
    both = near.select("a", "b", "l_a", "l_b").join(own("a"), "a").join(own("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    linked = both.where(100 * common >= rule.percent * (F.col("n_a") + F.col("n_b") - common))
    return tables.keep(linked.select(F.col("l_a").alias("a"), F.col("l_b").alias("b")).distinct(), "links")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the label of each class: its own where it has no links."""
    if labels is None:
        return rows.withColumn("label", F.col("cls"))
    return rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def join(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) per row of ``docs``."""
    rule = rule or Rule()
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lasting, tables, round_ = Tables(spark), Tables(spark), Tables(spark)
    signed = round_.keep(sign(docs, rule, buckets), "signed")
    described = signed.where("bucket IS NULL")
    rows = lasting.keep(described.select("doc_id", "n", "f1", "f2"), "rows")
    # A batch describes the keys of a class once.
    told = [F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("allowed", ignorenulls=True).alias("allowed")]
    classes = described.where("n > 0").groupBy(F.col("f1").alias("cls"), "f2", "n").agg(*told)
    classes = tables.keep(classes.where("rep IS NOT NULL"), "classes")
    shared = round_.keep(shared_keys(signed, buckets), "shared")
    about = classes.select("cls", "n", "rep", *[F.get("sketch", F.lit(i)).alias(w) for i, w in enumerate(WORDS)])
    # Rounds carry (key, cls, rank, label); sizes and sketches join them where pairs are made.
    members = tables.keep(rarest(shared, classes), "members")
    round_.discard()

    labels, low, high = None, 0, 1
    named = members.withColumn("label", F.col("cls"))
    while True:
        # Ranks from low up to high are this round's centres.
        near = round_.keep(_near(named.join(about, "cls"), low, high, rule), "near")
        links = None if near.isEmpty() else _links(near, docs, rule, round_)
        told = named
        if links is not None and not links.isEmpty():
            labels = tables.keep(folded(labels, components(links)), "labels")
            told = round_.keep(_labelled(named.drop("label"), labels), "told")
        low, high = high, high + CENTRE_GROWTH * (high - low)
        # Keys go on while their classes are in several components and some have not been centres.
        state = told.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("rank").alias("last"))
        state = state.where((F.col("least") < F.col("most")) & (F.col("last") > low)).select("key")
        named = tables.keep(lookup(told, state, ["key"], "inner"), "named")
        round_.discard()
        if named.isEmpty():
            break
    named = _labelled(classes, labels)
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    answer = lasting.keep(lookup(named, smallest, ["label"], "inner").select(F.col("cls").alias("f1"), "f2", "n", "component_id"), "answer")
    tables.discard()
    return lookup(rows, answer, ["f1", "f2", "n"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
