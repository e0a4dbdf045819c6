"""The vector index: recall against exact search, exact search by angles, hot lists, odd vectors."""

from __future__ import annotations

import re

import numpy as np
import pytest
from test_search import brute, data, got, vectors

from vellumflow.operators import search, vector_index
from vellumflow.registry import queries as registry
from vellumflow.session import scratch


def index_of(spark, corpus, lists=None, **more):
    return vector_index.build(vectors(spark, "vec_id", corpus).repartition(4), scratch(spark, "index"), lists, **more)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = search.topk(rows, rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), 3)
    found = registry.QUERIES["indexed_topk"](spark, sf_dir)
    assert vector_index.recall(found, exact) >= 0.9
    assert exact.count() == found.count() == 3 * rows.where("vec_id % 50 = 0").count()


def test_recall_on_clusters_with_few_lists(spark):
    """Rows around 30 centres: a twentieth of the lists finds nearly all."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    corpus = [(i, centres[i % 30] + 0.15 * rng.normal(size=16)) for i in range(3000)]
    queries = vectors(spark, "query_id", [(i, v) for i, v in corpus if i % 50 == 0])
    index = index_of(spark, corpus, 60, sample_rows=500)
    exact = search.topk(vectors(spark, "vec_id", corpus), queries, 3)
    probes = vector_index.probes_for(index, queries, 0.95)
    assert probes <= 6 and vector_index.recall(vector_index.search(index, queries, 3, probes), exact) >= 0.9
    assert index.sizes.sum() == 3000 and len(index.centres) == 60


@pytest.mark.parametrize("k,probes,block", [(1, 1, 20_000), (3, 2, 7), (50, 1, 20_000)])
def test_exact_equals_brute_force(spark, monkeypatch, k, probes, block):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", block)
    corpus, queries = data(60), data(9, seed=2)
    corpus += [(1000 + i, corpus[0][1]) for i in range(30)]  # a third of all rows at one place, all of them ties
    corpus.append((2000, np.zeros(8)))
    queries += [(100, corpus[0][1]), (101, np.zeros(8))]
    found = vector_index.search_exact(index_of(spark, corpus, 9), vectors(spark, "query_id", queries), k, probes)
    assert got(found) == brute(corpus, queries, k)


def test_all_lists_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 3)
    corpus, queries = data(50), data(8, seed=5)
    assert got(vector_index.search(index_of(spark, corpus, 7), vectors(spark, "query_id", queries), 4, 7)) == brute(corpus, queries, 4)


def test_only_probed_folders_are_opened(spark):
    corpus, queries = data(200), vectors(spark, "query_id", [(1, data(1, seed=9)[0][1])])
    index = index_of(spark, corpus, 20)
    plan = vector_index.search(index, queries, 3, 2)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[[^]]*list#\d+ IN \(([\d,]+)\)", plan)
    assert filters and all(len(f.split(",")) == 2 for f in filters)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [float("inf"), 0.0]), (6, [0.0, 1.0]), (7, [1.0, 0.0])]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vector_index.build(corpus, scratch(spark, "index"))
    queries = corpus.withColumnRenamed("vec_id", "query_id")
    found = vector_index.search_exact(index, queries, 2)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect()) == [(1, 1, 1), (1, 2, 7), (6, 1, 6), (6, 2, 1), (7, 1, 1), (7, 2, 7)]
    with pytest.raises(Exception, match="elements"):
        vector_index.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], corpus.schema).coalesce(1), scratch(spark, "index"))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index = vector_index.build(none, scratch(spark, "index"))
    queries = vectors(spark, "query_id", data(3))
    one_wide = spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<float>")
    assert vector_index.search_exact(index, one_wide).count() == vector_index.search(index, one_wide).count() == 0
    assert vector_index.probes_for(index, one_wide) == 1
    full = index_of(spark, data(20), 4)
    assert vector_index.search_exact(full, queries.limit(0)).count() == 0
