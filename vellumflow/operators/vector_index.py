"""A vector index: rows stored by list, a query meets the lists whose centres are nearest.

Centres are fitted by k-means on the unit sphere, on a sample of at most ``SAMPLE_ROWS`` rows and
``SAMPLE_BYTES``; every row is then given to the list of its nearest centre and written to that
list's folder. A search ranks the centres for each query, takes the nearest lists and meets their rows
through an equi-join of list ids; only the folders of probed lists are opened. A list with very many
rows, or one that very many queries probe, is dealt into blocks of bounded size, each pair of blocks
one group. Scores are exact cosines, ties go to the smaller id.

``search`` finds the nearest rows within the probed lists, and ``probes_for`` says how many lists it takes for a
wanted recall, measured on a bounded sample of queries. ``search_exact`` finds all: it reads further those lists
that can hold a row nearer than the k-th found, by the angle between query and centre less
the widest angle within the list.

Vectors that are null or hold a null, NaN or infinite entry are left out; another width is an error. A vector of
zeros has the cosine 0 with all and lies in the first list, whose angle is then the widest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumflow.operators.search import _best, _candidate_schema, _ranked, _unit, _usable, topk
from vellumflow.sources.staging import staged

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the sample that centres are fitted on.
SAMPLE_ROWS, SAMPLE_BYTES = 50_000, 256 << 20
#: Bound of the number of lists; the centres are shipped to tasks.
MAX_LISTS = 4096
ROUNDS = 12
#: Queries of the sample that recall is measured on.
SAMPLE_QUERIES = 256
#: Rows of one block of a list or of its queries.
BLOCK_ROWS = 20_000
#: Room for the rounding of angles.
SLACK = 1e-6


@dataclass(frozen=True)
class VectorIndex:
    """Where the rows are, and of each list the centre, the widest angle and the number of rows."""

    path: str
    columns: str
    centres: np.ndarray
    widest: np.ndarray
    sizes: np.ndarray

    @property
    def width(self) -> int:
        return self.centres.shape[1]

    def rows(self, spark: SparkSession) -> DataFrame:
        """(vec_id, embedding, angle, list)."""
        return spark.read.schema(self.columns).parquet(self.path)


# --- fitting and writing -----------------------------------------------------------------------


def _centres(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Centres of a sample of unit vectors; one that loses all its rows starts again elsewhere."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[rng.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([np.argmax(sample[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        empty = np.bincount(nearest, minlength=len(centres)) == 0
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        centres = _unit(sums)
    return centres


def _sample(vectors: DataFrame, width: int, rows: int) -> np.ndarray:
    """At most ``rows`` vectors, and no more bytes than the bound, chosen by a hash of the id."""
    most = max(1, min(rows, SAMPLE_BYTES // (8 * width)))
    found = vectors.select("embedding", F.xxhash64("vec_id").alias("at")).orderBy("at").limit(most).toPandas()
    return _unit(found["embedding"]) if len(found) else np.zeros((0, width))


def build(vectors: DataFrame, path: str, lists: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 20240101) -> VectorIndex:
    """Fit centres and write every row (vec_id, embedding) to the folder of its list below ``path``.

    ``lists`` is the square root of the number of rows unless given, at most ``MAX_LISTS``.
    """
    first = vectors.filter(F.size("embedding") >= 0).select(F.size("embedding").alias("width")).first()
    width = first["width"] if first else 1
    rows = _usable(vectors.select("vec_id", "embedding"), width)
    if lists is None:
        lists = max(1, int(np.sqrt(rows.count())))
    sample = _sample(rows, width, sample_rows)
    centres = _centres(sample, min(lists, MAX_LISTS), seed) if len(sample) else np.ones((1, width)) / np.sqrt(width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _unit(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                scores = unit @ centres.T
                nearest = np.argmax(scores, axis=1)
                angle = np.arccos(np.clip(scores[np.arange(len(nearest)), nearest], -1, 1))
                # Zeros have no direction: any query may be as near to them.
                angle[~unit.any(axis=1)] = np.pi
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int32)), pa.array(angle)], names=["vec_id", "embedding", "list", "angle"]
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    element = rows.schema["embedding"].dataType.simpleString()
    listed = rows.mapInArrow(assign, f"vec_id {kind}, embedding {element}, list int, angle double")
    # Rebalancing splits a large list over several files and keeps small ones whole.
    listed.hint("rebalance", "list").write.partitionBy("list").parquet(path)
    index = VectorIndex(path, f"vec_id {kind}, embedding {element}, angle double, list int", centres, np.zeros(len(centres)), np.zeros(len(centres), np.int64))
    for r in index.rows(vectors.sparkSession).groupBy("list").agg(F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n")).collect():  # one row per list
        index.widest[r["list"]], index.sizes[r["list"]] = r["angle"], r["n"]
    return index


# --- searching ----------------------------------------------------------------------------------------


def _probed(index: VectorIndex, queries: DataFrame, probes: int, reach: bool = False) -> DataFrame:
    """(query_id, embedding, list): the lists that each query reads.

    The nearest ``probes`` that hold rows; with ``reach``, the others that can hold a row at least as near as ``score``.
    """
    centres, widest, filled = index.centres, index.widest, index.sizes > 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                unit = _unit(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                scores = np.where(filled, unit @ centres.T, -np.inf)
                order = np.argsort(-scores, axis=1, kind="stable")
                taken = np.zeros(scores.shape, bool)
                np.put_along_axis(taken, order[:, :probes], True, axis=1)
                if reach:
                    angle = np.arccos(np.clip(scores, -1, 1)) - widest
                    best = np.cos(np.maximum(angle, 0)) + SLACK
                    wanted = part.column(2).to_numpy(zero_copy_only=False)
                    # A query with fewer than k rows so far needs all lists, and one of zeros is as near to all.
                    near = (best >= wanted[:, None]) | np.isnan(wanted)[:, None] | ~unit.any(axis=1)[:, None]
                    taken = near & ~taken
                q, lists = np.nonzero(taken & filled)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(q)), part.column(1).take(pa.array(q)), pa.array(lists.astype(np.int32))], names=["query_id", "embedding", "list"])

    kind, element = (queries.schema[c].dataType.simpleString() for c in ("query_id", "embedding"))
    return queries.select("query_id", "embedding", *(["score"] if reach else [])).mapInArrow(task, f"query_id {kind}, embedding {element}, list int")


def _scored(index: VectorIndex, probed: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query in each block of the lists it reads."""
    spark, schema = probed.sparkSession, _candidate_schema(probed, corpus)
    probed = staged(probed, "probed")
    # At most MAX_LISTS rows: blocks of rows and of queries of every list that is read.
    asked = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("qbs")).collect()
    blocks = F.broadcast(spark.createDataFrame([(r["list"], r["qbs"], int(-(-index.sizes[r["list"]] // BLOCK_ROWS))) for r in asked], "list int, qbs int, cbs int"))
    corpus = corpus.where(F.col("list").isin([r["list"] for r in asked]))  # opens these folders only

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row in one block of its own side, met by every block of the other."""
        return df.join(blocks, "list").withColumns({own: F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int")}).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
        ).drop("qbs", "cbs")

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({f.name: [] for f in schema.fields})
        return _best(q["query_id"].to_numpy(), _unit(q["q"]), c["vec_id"].to_numpy(), _unit(c["embedding"]), k)

    left = dealt(probed.withColumnRenamed("embedding", "q"), "query_id", "qb", "cb")
    right = dealt(corpus.select("vec_id", "embedding", "list"), "vec_id", "cb", "qb")
    keys = ["list", "qb", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema)


def search(index: VectorIndex, queries: DataFrame, k: int = 3, probes: int = 8) -> DataFrame:
    """The nearest ``k`` rows in the ``probes`` nearest lists of each query (query_id, embedding):
    query_id, rank, vec_id, score."""
    rows = index.rows(queries.sparkSession)
    queries = _usable(queries.select("query_id", "embedding"), index.width)
    return _ranked(_scored(index, _probed(index, queries, probes), rows, k), k)


def search_exact(index: VectorIndex, queries: DataFrame, k: int = 3, probes: int = 4) -> DataFrame:
    """As ``search``, but the nearest ``k`` rows of all: lists that can hold one of them are read too."""
    rows = index.rows(queries.sparkSession)
    queries = staged(_usable(queries.select("query_id", "embedding"), index.width), "queries")
    near = staged(_scored(index, _probed(index, queries, probes), rows, k), "near")
    reach = _ranked(near, k).where(F.col("rank") == k).select("query_id", "score")
    further = _probed(index, queries.join(reach, "query_id", "left"), probes, reach=True)
    return _ranked(near.unionByName(_scored(index, further, rows, k)), k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact hits (query_id, vec_id) that were found."""
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    row = both.agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("n")).first()
    return row["hits"] / row["n"] if row["n"] else 1.0


def probes_for(index: VectorIndex, queries: DataFrame, target: float = 0.95, k: int = 3) -> int:
    """How many lists a query must read so that at least ``target`` of its exact hits are found,
    measured on at most ``SAMPLE_QUERIES`` queries: each hit needs as many as there are nearer centres."""
    rows = index.rows(queries.sparkSession)
    usable = _usable(queries.select("query_id", "embedding"), index.width)
    sample = usable.orderBy(F.xxhash64("query_id")).limit(SAMPLE_QUERIES)
    sample = staged(sample, "sample")
    hits = topk(rows, sample, k).join(rows.select("vec_id", "list"), "vec_id").select("query_id", "list").join(sample, "query_id").toPandas()
    if not len(hits):
        return 1
    scores = np.where(index.sizes > 0, _unit(hits["embedding"]) @ index.centres.T, -np.inf)
    own = scores[np.arange(len(hits)), hits["list"].to_numpy()]
    needed = np.sort((scores > own[:, None]).sum(axis=1) + 1)
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])
