"""Top-k against brute force, on both ways to meet the corpus."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows

from vellumflow.operators import search


def vectors(spark, key, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data], f"{key} long, embedding array<float>")


def brute(corpus, queries, k):
    out = []
    for q, qv in queries:
        scored = []
        for i, v in corpus:
            a, b = np.float32(qv).astype(float), np.float32(v).astype(float)
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((round(float(a @ b / norm) if norm else 0.0, 9), i))
        for rank, (score, i) in enumerate(sorted(scored, key=lambda t: (-t[0], t[1]))[:k], 1):
            out.append((q, rank, i, pytest.approx(score, abs=1e-6)))
    return sorted(out, key=lambda t: t[:3])


def data(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), v) for i, v in enumerate(rng.normal(size=(n, dim)))]


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("max_shipped", [100, 0], ids=["shipped", "blocked"])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_equals_brute_force(spark, max_shipped, k):
    corpus, queries = data(40), data(7, seed=2)
    df = search.topk(vectors(spark, "vec_id", corpus).repartition(5), vectors(spark, "query_id", queries), k, max_shipped, block_rows=9)
    assert got(df) == brute(corpus, queries, k)


@pytest.mark.parametrize("max_shipped", [100, 0], ids=["shipped", "blocked"])
def test_scores_in_small_portions(spark, monkeypatch, max_shipped):
    monkeypatch.setattr(search, "MAX_SCORES", 20)
    corpus, queries = data(40), data(7, seed=2)
    df = search.topk(vectors(spark, "vec_id", corpus), vectors(spark, "query_id", queries), 3, max_shipped, block_rows=9)
    assert got(df) == brute(corpus, queries, 3)


@pytest.mark.parametrize("max_shipped", [100, 0], ids=["shipped", "blocked"])
def test_copies_tie_by_id_and_zero_vectors_score_zero(spark, max_shipped):
    corpus = [(i, [1, 2, 3, 4]) for i in (9, 4, 7, 1, 8)] + [(2, [0, 0, 0, 0]), (3, [4, 3, 2, 1])]
    queries = [(0, [1, 2, 3, 4]), (1, [0, 0, 0, 0])]
    df = search.topk(vectors(spark, "vec_id", corpus).repartition(3), vectors(spark, "query_id", queries), 3, max_shipped, block_rows=2)
    assert got(df) == brute(corpus, queries, 3)


def test_no_queries(spark):
    assert search.topk(vectors(spark, "vec_id", data(5)), vectors(spark, "query_id", [])).count() == 0


def test_replies(spark):
    hits = spark.createDataFrame(
        [(1, 2, "B", "b text", "s2"), (1, 1, "A", "a text", "s1")],
        "query_id long, rank int, title string, preview string, source string",
    )
    assert search.knowledge_replies(hits).first().reply == (
        "📚 **Knowledge Base Results:**\n\n**A**\na text...\nSource: s1\n\n**B**\nb text...\nSource: s2\n\n"
        "💡 This information is from our medical literature database."
    )
    items = spark.createDataFrame([(1, 1, "Laptop", "PC", 1234.5), (1, 2, None, None, None)], "query_id long, rank int, product_name string, category string, price double")
    lines = items.select("query_id", "rank", search.product_line().alias("line"))
    assert search.product_replies(lines).first().reply == (
        "Here are the relevant products:\n\n• **Laptop** (PC) - $1,234.50\n\n• **Unknown** (Unknown) - $0.00\n"
    )


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0]), (2, [0.0, 1.0])], "label int, embedding array<float>")
    assert rows(search.label_centroids(df), "query_id", "embedding") == [(1, [2.0, 4.0]), (2, [0.0, 1.0])]


@pytest.mark.parametrize("max_shipped", [100, 0], ids=["shipped", "blocked"])
def test_vectors_that_are_not_finite_are_left_out(spark, max_shipped):
    corpus = data(6)
    bad = [(20, [float("nan")] * 8), (21, None), (22, [None] + [1.0] * 7), (23, [float("inf")] * 8)]
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in [*corpus, *bad]], "vec_id long, embedding array<float>")
    queries = data(2, seed=3)
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in queries] + [(9, None), (10, [float("nan")] * 8)], "query_id long, embedding array<float>")
    assert got(search.topk(frame.repartition(3), asked, 3, max_shipped, block_rows=2)) == brute(corpus, queries, 3)


@pytest.mark.parametrize("max_shipped", [100, 0], ids=["shipped", "blocked"])
def test_vectors_of_another_width_are_an_error(spark, max_shipped):
    corpus = vectors(spark, "vec_id", [(1, [1, 0, 0]), (2, [0.5])])
    with pytest.raises(Exception, match="not 3 elements"):
        search.topk(corpus, vectors(spark, "query_id", [(1, [1, 0, 0])]), 3, max_shipped, block_rows=2).collect()
