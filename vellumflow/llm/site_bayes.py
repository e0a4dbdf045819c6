"""Quality classifier: document evidence combined with the posteriors of its site.

Evidence: two linear classifiers over the distinct words of a text and its shape (shares
of symbols, capitals, digits, bars, distinct words; mean word length) give the log odds
that it is junk, and that it is toxic. They are fitted on at most ``SAMPLE_ROWS`` labelled
documents, chosen by a hash of the id; words are those whose count among the classes no
chance explains (likelihood ratio over ``MIN_RATIO``), weights come from logistic
regression on them. Everything below covers all documents.

Sites: a document's host is its source, its path the source and language. A document
counts as bad with the probability its evidence gives. Bad shares of paths are shrunk to
their host's posterior, those of hosts to the global share; how strongly follows from how
much hosts (paths) differ beyond what their sizes explain, so a sparse site has the prior
and a large one its own share. All of it is grouped aggregation, added up before the
shuffle, so a source with a third of the documents is a few rows.

The verdict adds the site's log odds, relative to the global ones, to the evidence.

Defined results: null and empty texts have no words; their shape is fitted like any
other. Null sources and languages are sites of their own, spelled empty. Documents
without label are only judged. Labels that are null are not used, repeated labels of a
document count once, the worst one. Without usable labels of both kinds a classifier has
no evidence. All columns are kept; the added ones replace columns of their names. Empty tables stay empty.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from vellumflow.llm import textbytes as B
from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 12_000
PART_ROWS = 1_000  # of the sample, whose words are counted at a time
MIN_RATIO = 20.0
STEPS = 800
PENALTY = 1e-5
MAX_LOG_ODDS = 30.0
BROADCAST_SITES = 500_000
U64 = np.uint64
KINDS = ("junk", "toxic")
ADDED = ("junk_evidence", "toxic_evidence", "site_log_odds", "bad_log_odds", "accepted")
SITE = ["_host", "_path"]

_SYMBOL, _UPPER, _DIGIT, _BAR = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[[ord(c) for c in "!#$%&*<>|^~@=+"]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_BAR[ord("|")] = True
SHAPES = 7
BINS = 16


class Model(NamedTuple):
    """Features in ascending order, a weight for each and kind, and an intercept per kind."""

    features: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray


# --- features ----------------------------------------------------------------------------


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of a block of documents: distinct words, and a bin of each shape."""
    hashes, first = B.words(data, offsets, B.LETTER_DIGIT)
    doc = B.documents_of(first)
    n = len(offsets) - 1
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])) if len(doc) else np.zeros(0, bool)
    doc, hashes = doc[new], hashes[new]
    size = np.maximum(1, np.diff(offsets))
    words = np.diff(first)
    sums = lambda table: np.diff(np.append(0, np.cumsum(table[data]))[offsets]) / size
    distinct = np.bincount(doc, minlength=n) / np.maximum(1, words)
    shapes = [sums(_SYMBOL), sums(_UPPER), sums(_DIGIT), sums(_BAR), distinct, np.minimum(1, words / size * 4), np.minimum(1, np.log1p(words) / 10)]
    bins = [np.minimum(BINS - 1, np.sqrt(s) * BINS).astype(np.int64) for s in shapes]
    shape = [B.mix((np.full(n, (k + 1) << 32) + b).astype(U64)) for k, b in enumerate(bins)]
    return np.concatenate([doc, np.tile(np.arange(n), SHAPES)]), np.concatenate([hashes, *shape])


def _sampled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(junk, toxic, features) of a bounded number of distinct labelled texts."""
    worst = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    worst = worst.agg((F.min("quality") == 0).alias("junk"), (F.max("toxic") == 1).alias("toxic"))
    chosen = worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col("text")).join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.flat(batch.column(2))
            for i, j in B.blocks(offsets):
                doc, found = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                order = np.argsort(doc, kind="stable")
                found, ends = found[order], np.cumsum(np.bincount(doc, minlength=j - i))
                packed = [f.tobytes() for f in np.split(found, ends[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(packed, pa.binary())], names=["junk", "toxic", "features"])

    return texts.select("junk", "toxic", "text").mapInArrow(task, "junk boolean, toxic boolean, features binary").distinct()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows of the sample at a time: (rows, features of all of them, number of each row's features)."""
    for batch in batches:
        for i in range(0, batch.num_rows, PART_ROWS):
            part = batch.slice(i, PART_ROWS)
            data, offsets = B.flat(part.column(2))
            yield part, np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), U64), np.diff(offsets) // 8


def _telling(sample: DataFrame, n: int, bad: dict[str, int], min_ratio: float) -> np.ndarray:
    """The features whose count among the texts of a kind no chance explains, in ascending order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, sizes in _parts(batches):
            every, at = np.unique(found, return_inverse=True)
            flags = [np.repeat(part.column(k).to_numpy(zero_copy_only=False).astype(float), sizes) for k in range(2)]
            counts = [np.bincount(at, weights=w, minlength=len(every)).astype(np.int64) for w in (None, *flags)]
            yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), *map(pa.array, counts)], names=["feature", "n", *KINDS])

    names = ["n", *KINDS]
    counts = sample.select(*KINDS, "features").mapInArrow(task, "feature long, n long, junk long, toxic long").groupBy("feature").agg(*[F.sum(c).alias(c) for c in names])
    told = F.lit(False)
    for k in KINDS:
        if 0 < bad[k] < n:
            ratio = F.lit(0.0)
            for seen, share in ((F.col(k), bad[k] / n), (F.col("n") - F.col(k), (n - bad[k]) / n)):
                ratio = ratio + F.when(seen > 0, 2 * seen * F.log(seen / (F.col("n") * share))).otherwise(0.0)
            told = told | (ratio > min_ratio)
    return np.sort(np.array([r["feature"] for r in counts.where(told).select("feature").collect()], np.int64).view(U64))


def _matrix(sample: DataFrame, features: np.ndarray) -> list:
    """(junk, toxic, columns): of each text of the sample the numbers of those of ``features`` that it has."""
    shipped = sample.sparkSession.sparkContext.broadcast(features)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for part, found, sizes in _parts(batches):
            at = np.minimum(np.searchsorted(own, found), max(0, len(own) - 1)).astype(np.int32)
            known = own[at] == found if len(own) else np.zeros(len(found), bool)
            ends = np.append(0, np.cumsum(known))[np.cumsum(sizes)]
            packed = [x.tobytes() for x in np.split(at[known], ends[:-1])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], names=[*KINDS, "columns"])

    return sample.select(*KINDS, "features").mapInArrow(task, "junk boolean, toxic boolean, columns binary").collect()


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, min_ratio: float = MIN_RATIO) -> Model:
    """The two classifiers, from at most ``rows`` labelled documents. Words are counted in Spark; the driver
    gets those that tell the classes apart, and which of them each text has."""
    tables = Tables(docs.sparkSession)
    sample = tables.keep(_sampled(docs, labels, rows), "sample")
    whole = sample.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(k).alias(k) for k in KINDS]).first()
    every = _telling(sample, whole["n"], whole.asDict(), min_ratio)
    texts = _matrix(sample, every)
    tables.discard()
    flags = np.array([[r["junk"], r["toxic"]] for r in texts], float).reshape(-1, 2)
    sizes = [len(r["columns"]) // 4 for r in texts]
    column = np.frombuffer(b"".join(r["columns"] for r in texts), np.int32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    weights, intercepts = np.zeros((len(every), 2)), np.zeros(2)
    for k in range(2):
        if 0 < flags[:, k].sum() < len(texts):
            weights[:, k], intercepts[k] = _logistic(row, column, flags[:, k], len(every))
    return Model(every, weights, intercepts)


def _logistic(row: np.ndarray, column: np.ndarray, target: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient steps scaled per weight, with a quadratic penalty."""
    w, b = np.zeros(size), float(np.log(target.mean() / (1 - target.mean())))
    square, square_b = np.full(size, 1e-8), 1e-8
    n = len(target)
    for _ in range(STEPS):
        score = b + np.bincount(row, weights=w[column], minlength=n)
        miss = 1 / (1 + np.exp(-np.clip(score, -MAX_LOG_ODDS, MAX_LOG_ODDS))) - target
        slope = np.bincount(column, weights=miss[row], minlength=size) + PENALTY * n * w
        square += slope**2
        square_b += miss.sum() ** 2
        w -= 0.5 * slope / np.sqrt(square)
        b -= 0.5 * miss.sum() / np.sqrt(square_b)
    return w, b


# --- evidence and sites ------------------------------------------------------------------


def evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with junk_evidence and toxic_evidence, the log odds of each kind."""
    names = [f"{k}_evidence" for k in KINDS]
    # Bounded by the sample; as plain arrays, since a broadcast names classes by their module.
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(model))
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names] + [T.StructField(n, T.DoubleType()) for n in names])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shipped.value)
        for batch in batches:
            data, offsets = B.flat(batch.column(batch.schema.get_field_index(text)))
            scores = np.tile(own.intercepts, (batch.num_rows, 1))
            for i, j in B.blocks(offsets):
                if not len(own.features):
                    break
                doc, found = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                at = np.minimum(np.searchsorted(own.features, found), len(own.features) - 1)
                known = own.features[at] == found
                for k in range(len(KINDS)):
                    scores[i:j, k] += np.bincount(doc[known], weights=own.weights[at[known], k], minlength=j - i)
            kept = [n for n in batch.schema.names if n not in names]
            scores = np.clip(scores, -MAX_LOG_ODDS, MAX_LOG_ODDS)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(scores[:, k]) for k in range(len(KINDS))], names=[*kept, *names])

    return docs.mapInArrow(task, schema)


def _chance(log_odds):
    return 1 / (1 + F.exp(-log_odds))


def bad_log_odds():
    """Log odds that a document is junk or toxic, from its two evidences."""
    good = (1 - _chance(F.col("junk_evidence"))) * (1 - _chance(F.col("toxic_evidence")))
    good = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), good))
    return F.log((1 - good) / good)


def _strength(groups: DataFrame, share: float) -> float:
    """How many documents the prior of a group is worth: the fewer, the more groups differ
    beyond what their sizes explain (moments of a beta-binomial)."""
    got = groups.agg(
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - share) ** 2).alias("spread"), F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    noise = share * (1 - share)
    if not got["n"] or noise <= 0 or got["groups"] < 2:
        return 1e6
    between = (got["spread"] - (got["groups"] - 1) * noise) / max(1e-9, got["n"] - got["squares"] / got["n"])
    return float(np.clip(noise / between - 1, 1, 1e6)) if between > 0 else 1e6


def site_posteriors(scored: DataFrame, folder: str) -> DataFrame:
    """(_host, _path, site_log_odds): log odds of the posterior bad share of every path,
    relative to those of the global share."""
    bad = _chance(F.col("bad_log_odds"))
    scored.groupBy(*SITE).agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad")).write.parquet(f"{folder}/paths")
    paths = scored.sparkSession.read.parquet(f"{folder}/paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    share = min(max((whole["bad"] or 0.0) / (whole["n"] or 1), 1e-6), 1 - 1e-6)
    k_host, k_path = _strength(hosts, share), _strength(paths, share)
    hosts = hosts.select("_host", ((F.col("bad") + k_host * share) / (F.col("n") + k_host)).alias("prior"))
    posterior = (F.col("bad") + k_path * F.col("prior")) / (F.col("n") + k_path)
    rows = lookup(paths, hosts, ["_host"], "inner").withColumn("p", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), posterior)))
    return rows.select(*SITE, (F.log(F.col("p") / (1 - F.col("p"))) - float(np.log(share / (1 - share)))).alias("site_log_odds"))


def classify(
    docs: DataFrame, labels: DataFrame, folder: str, host: str = "source", path: str = "lang", rows: int = SAMPLE_ROWS, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the evidences, site_log_odds, bad_log_odds and accepted; without ``text`` unless it is to be
    kept. The scored rows and the site table are written under ``folder``: every text is scored once."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (*ADDED, *SITE)])
    model = fit(kept, labels, rows)
    site = {"_host": F.coalesce(F.col(host), F.lit("")), "_path": F.coalesce(F.col(path), F.lit(""))}
    scored = evidence(kept, model).withColumns(site)
    if not keep_text:
        scored = scored.drop("text")
    scored.write.parquet(f"{folder}/scored")
    scored = docs.sparkSession.read.schema(scored.schema).parquet(f"{folder}/scored")
    site_posteriors(scored.select(*SITE, bad_log_odds().alias("bad_log_odds")), folder).write.parquet(f"{folder}/sites")
    sites = docs.sparkSession.read.parquet(f"{folder}/sites")
    if sites.count() <= BROADCAST_SITES:
        judged = scored.join(F.broadcast(sites), SITE, "left")
    else:
        judged = lookup(scored, sites, SITE)
    log_odds = F.coalesce("site_log_odds", F.lit(0.0)) + bad_log_odds()
    judged = judged.withColumn("site_log_odds", F.coalesce("site_log_odds", F.lit(0.0))).withColumn("bad_log_odds", log_odds)
    shown = [c for c in kept.columns if keep_text or c != "text"]
    return judged.withColumn("accepted", F.col("bad_log_odds") < 0).select(*[F.col(f"`{c}`") for c in shown], *ADDED)
