"""Exact cosine top-k of query vectors against a corpus.

Each corpus partition keeps k candidates per query; only those are shuffled,
and the final pick is an aggregation. Query vectors reach the corpus in one of
two ways: a set within a checked bound is shipped to the tasks as a matrix; a
larger one meets the corpus block by block through an equi-join of block ids.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from vellumflow import vocabulary as V
from vellumflow.functions.text import fill, preview

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_SHIPPED_QUERIES = 4096
MAX_SHIPPED_BYTES = 256 << 20
MAX_SCORES = 4_000_000  # scores a task holds at once
TIE_PLACES = 9  # scores equal to this many places are a tie


def _unit(rows) -> np.ndarray:
    m = (rows if isinstance(rows, np.ndarray) and rows.ndim == 2 else np.stack(list(rows))).astype(np.float64)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _best(query_ids: np.ndarray, unit_queries: np.ndarray, ids: np.ndarray, unit_vectors: np.ndarray, k: int) -> pd.DataFrame:
    """k best ids per query, a bounded number of scores at a time."""
    step = max(1, MAX_SCORES // len(ids))
    blocks = range(0, len(query_ids), step)
    return pd.concat(
        [_best_of(query_ids[i : i + step], unit_queries[i : i + step], ids, unit_vectors, k) for i in blocks],
        ignore_index=True,
    )


def _best_of(query_ids: np.ndarray, unit_queries: np.ndarray, ids: np.ndarray, unit_vectors: np.ndarray, k: int) -> pd.DataFrame:
    """k best ids per query; ties prefer the smaller id."""
    scores = np.round(unit_queries @ unit_vectors.T, TIE_PLACES)
    k = min(k, scores.shape[1])
    cut = np.partition(scores, -k, axis=1)[:, -k]
    q, c = np.nonzero(scores >= cut[:, None])
    order = np.lexsort((ids[c], -scores[q, c], q))
    q, c = q[order], c[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    q, c = q[keep], c[keep]
    return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[c], "score": scores[q, c]})


def _trimmed(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of each query."""
    order = np.lexsort((found["vec_id"].to_numpy(), -found["score"].to_numpy(), found["query_id"].to_numpy()))
    found = found.iloc[order]
    return found[found.groupby("query_id").cumcount() < k].reset_index(drop=True)


def _usable(vectors: DataFrame, width: int) -> DataFrame:
    """Rows with a vector of finite numbers; a NULL vector, and one with a NULL, NaN or
    infinite element, is left out, and one of another width is an error."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above all numbers
    wrong = F.raise_error(F.concat(F.lit(f"a vector has not {width} elements but "), F.size(v).cast("string")))
    checked = vectors.filter(v.isNotNull()).withColumn("embedding", F.when(F.size(v) == width, v).otherwise(wrong))
    return checked.filter(finite)


def _candidate_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("vec_id", corpus.schema["vec_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _shipped(corpus: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int, schema: T.StructType) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast((ids, _unit(matrix)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries = shared.value
        best = None
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = _best(query_ids, unit_queries, batch.column(0).to_numpy(), _unit(vectors), k)
                best = found if best is None else _trimmed(pd.concat([best, found], ignore_index=True), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return corpus.select("vec_id", "embedding").mapInArrow(score, schema)


def _blocked(corpus: DataFrame, queries: DataFrame, k: int, schema: T.StructType, query_blocks: int, corpus_blocks: int) -> DataFrame:
    """Every (query block, corpus block) pair is one bounded cogroup."""
    def spread(df: DataFrame, key: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        )

    left = spread(queries.select("query_id", F.col("embedding").alias("q")), "query_id", "qb", query_blocks, "cb", corpus_blocks)
    right = spread(corpus.select("vec_id", "embedding"), "vec_id", "cb", corpus_blocks, "qb", query_blocks)

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({f.name: [] for f in schema.fields})
        return _best(q["query_id"].to_numpy(), _unit(q["q"]), c["vec_id"].to_numpy(), _unit(c["embedding"]), k)

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(score, schema)


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    """Rank candidates per query; the group limit trims each task first."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", F.round("score", 6).alias("score"))


def topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    max_shipped: int = MAX_SHIPPED_QUERIES,
    block_rows: int = 50_000,
) -> DataFrame:
    """The ``k`` nearest corpus rows (vec_id, embedding) of each query
    (query_id, embedding): query_id, rank, vec_id, score."""
    schema = _candidate_schema(queries, corpus)
    queries = queries.select("query_id", "embedding")
    first = queries.filter(F.size("embedding") >= 0).select(F.size("embedding").alias("width")).first()
    width = first["width"] if first else 0
    queries, corpus = _usable(queries, width), _usable(corpus, width)
    # The bytes that may be fetched are known from the width before anything is.
    fetched = min(max_shipped, MAX_SHIPPED_BYTES // max(1, 8 * width))
    rows = queries.limit(fetched + 1).toPandas()
    if not len(rows):
        candidates = corpus.sparkSession.createDataFrame([], schema)
    elif len(rows) <= fetched:
        candidates = _shipped(corpus, rows["query_id"].to_numpy(), np.stack(rows["embedding"]), k, schema)
    else:
        n_queries, n_corpus = queries.count(), corpus.count()
        candidates = _blocked(
            corpus, queries, k, schema,
            query_blocks=max(1, -(-n_queries // block_rows)), corpus_blocks=max(1, -(-n_corpus // block_rows)),
        )
    return _ranked(candidates, k)


def label_centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector of each label, as a query set."""
    parts = vectors.select(label, F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(F.col(label).alias("query_id")).agg(
        F.transform(ordered, lambda e: e["x"]).alias("embedding")
    )


def knowledge_topk(knowledge: DataFrame, queries: DataFrame, k: int = 3, chars: int = 200) -> DataFrame:
    """Top literature hits with title and the start of their text; the text is
    cut before it meets the hits."""
    hits = topk(knowledge, queries, k)
    shown = knowledge.select("vec_id", "title", preview(F.col("content"), chars).alias("preview"), "source")
    return shown.join(hits, "vec_id").select("query_id", "rank", "vec_id", "score", "title", "preview", "source")


def knowledge_replies(hits: DataFrame) -> DataFrame:
    """One formatted reply per query from its k hits."""
    line = fill(V.KNOWLEDGE_HIT, title=F.col("title"), preview=F.col("preview"), source=F.col("source"))
    lines = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    joined = F.array_join(F.transform(lines, lambda e: e["line"]), "\n\n")
    return hits.groupBy("query_id").agg(joined.alias("results")).select(
        "query_id", fill(V.KNOWLEDGE_REPLY, results=F.col("results")).alias("reply")
    )


def product_line(name: str = "product_name", category: str = "category", price: str = "price"):
    """``• **name** (category) - $1,234.50`` with defaults for missing values."""
    return fill(
        V.PRODUCT_HIT,
        name=F.coalesce(name, F.lit("Unknown")),
        category=F.coalesce(category, F.lit("Unknown")),
        price=F.format_number(F.coalesce(price, F.lit(0.0)), 2),
    )


def product_topk(products: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """Top products as lines; where ``products`` has a ``content``, the page's content stands below
    its line. Pages meet the hits only, not the search."""
    hits = topk(products, queries, k)
    shown, line = ["product_name", "category", "price"], product_line()
    if "content" in products.columns:
        shown, line = [*shown, "content"], F.concat(line, F.lit("\n  "), F.coalesce("content", F.lit("")))
    return products.select("vec_id", *shown).join(hits, "vec_id").select("query_id", "rank", "vec_id", line.alias("line"))


def product_replies(lines: DataFrame) -> DataFrame:
    """One reply per query: header, then each product followed by a blank line."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "line")))
    body = F.array_join(F.transform(ordered, lambda e: F.concat(e["line"], F.lit("\n"))), "\n")
    return lines.groupBy("query_id").agg(F.concat(F.lit(V.PRODUCT_HEADER + "\n"), body).alias("reply"))
