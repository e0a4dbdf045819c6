"""Listed terms on all three ways, sketches against exact ranks."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vellumflow.operators import sketches, terms
from vellumflow.streaming import streams

WAYS = {"search": {"search_bytes": terms.SEARCH_BYTES}, "broadcast": {}, "shuffle": {"broadcast_bytes": 0}}


def plain(rows, listed):
    counts = Counter()
    for key, text in rows:
        low = (text or "").lower()
        for term in {t.lower() for t in listed if t}:
            n = sum(low.startswith(term, i) for i in range(len(low)))
            if n and key is not None:
                counts[key, term] += n
    return dict(counts)


@pytest.mark.parametrize("way", WAYS)
def test_terms(spark, way):
    rng = random.Random(5)
    listed = ["aa", "A", "aba", r"\E.*", "(x", "é", "\U0001F600b", "b\U0001F600", "", None, "aa", "abababababab", "ba" * 80]
    rows = [(i, "".join(rng.choice(["a", "b", "A", "é", "\U0001F600", r"\E.*", "(x", "\n"]) for _ in range(rng.choice([0, 1, 7, 900])))) for i in range(40)]
    rows += [(1, "aaa"), (2, None), (None, "aa"), (50, "ba" * 500), (51, "a" * 20_000)]
    # A third of all rows holds the same term.
    rows += [(100 + i, "aa") for i in range(40)]
    docs = spark.createDataFrame(rows, "id int, body string").repartition(4)
    table = spark.createDataFrame([(t,) for t in listed], "term string")
    got = {(r["id"], r["term"]): r["n"] for r in terms.term_matches(docs, "id", "body", table, **WAYS[way]).collect()}
    assert got == plain(rows, listed)


def test_no_terms_no_texts(spark):
    docs = spark.createDataFrame([(1, "a")], "id int, body string")
    assert terms.term_matches(docs, "id", "body", spark.createDataFrame([("",)], "term string")).count() == 0
    one = spark.createDataFrame([("a",)], "term string")
    for options in WAYS.values():
        assert terms.term_matches(docs.limit(0), "id", "body", one, **options).count() == 0


def test_the_list_is_not_in_the_plan(spark):
    docs = spark.range(10).select("id", F.lit("x").alias("body"))
    many = spark.range(20_000).select(F.concat(F.lit("needle"), F.col("id").cast("string")).alias("term"))
    for options in WAYS.values():
        plan = terms.term_matches(docs, "id", "body", many, **options)._jdf.queryExecution().toString()
        assert len(plan) < 40_000 and "needle19999" not in plan


def test_rank_error_of_merged_sketches(spark):
    rng = random.Random(7)
    # One agent has most of the values, and of these many are equal.
    rows = [("hot" if i % 4 else "cold", i, rng.choice([int(rng.lognormvariate(5, 1)), 77])) for i in range(60_000)]
    frame = spark.createDataFrame(rows, "agent string, s int, ms int").repartition(16)
    frame = frame.select("agent", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s"))).alias("ts"), "ms")
    exact = defaultdict(list)
    for agent, s, ms in rows:
        exact[agent, s // 86400].append(ms)
    points = (0.5, 0.95, 0.99)
    days = sketches.merged(sketches.hourly(frame, "agent", "ts", "ms"), "agent", "day").select("agent", "day", *sketches.quantiles("sketch", points))
    seen = days.collect()
    assert len(seen) == len(exact)
    for r in seen:
        values = sorted(exact[r["agent"], r["day"].day - 1])
        assert r["requests"] == len(values)
        for p in points:
            low, high = bisect_left(values, r[f"p{round(p * 100)}"]) / len(values), bisect_right(values, r[f"p{round(p * 100)}"]) / len(values)
            assert low - 0.015 <= p <= high + 0.015


def test_sketches_of_a_stream_in_parts(spark, tmp_path):
    rows = spark.range(900).select(
        F.concat(F.lit("a"), F.col("id") % 3).alias("agent"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.pmod(F.col("id") * 37, F.lit(180)))).alias("ts"),
        F.when(F.col("id") % 50 > 0, F.col("id") % 211).alias("ms"),
    )
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(3):  # late rows: each part holds all hours
        rows.where(F.pmod(F.xxhash64("ms"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(source)
        stream = streams.event_stream(spark, source, rows.schema, files_per_batch=1)
        sketches.keep(stream, "agent", "ts", "ms", target, str(tmp_path / "cp")).awaitTermination()
    kept = sketches.over_time(sketches.kept(spark, target), "agent")
    batch = sketches.over_time(sketches.hourly(rows, "agent", "ts", "ms"), "agent")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, batch.collect())) and kept.count() == 12


@pytest.mark.parametrize("options", [{}, {"scan_bytes": 0}])
def test_terms_of_any_signs_in_cut_texts(spark, monkeypatch, options):
    monkeypatch.setattr(terms, "SCAN_PIECE", 40)
    rng = random.Random(8)
    signs = [*map(chr, range(32, 127)), "\n", "\t", "\r", "\x00", "ß", "é", "é", " ", "\U0001F600", "\U0001F601", "￿"]
    listed = ["".join(rng.choice(signs) for _ in range(rng.choice([1, 2, 2, 3]))) for _ in range(400)] + ["ab" * n for n in range(1, 15)]
    rows = [(i, "".join(rng.choice([*signs, "ab", "abab"]) for _ in range(rng.choice([39, 40, 41, 80, 700])))) for i in range(30)] + [(99, "ab" * 500)]
    docs, table = spark.createDataFrame(rows, "id int, body string"), spark.createDataFrame([(t,) for t in listed], "term string")
    got = {(r["id"], r["term"]): r["n"] for r in terms.term_matches(docs, "id", "body", table, **options).collect()}
    assert got == plain(rows, listed)


def test_a_small_list_makes_no_row_per_place(spark):
    docs, one = spark.createDataFrame([(1, "a")], "id int, body string"), spark.createDataFrame([("needle",)], "term string")
    assert "sequence(" not in terms.term_matches(docs, "id", "body", one)._jdf.queryExecution().optimizedPlan().toString()


def test_very_many_terms_that_begin_each_other(spark):
    rows, listed = [(1, "a" * 1500 + "b"), (2, "ab")], ["a" * n for n in range(1, 1200)] + ["b"]
    assert terms._tree(sorted(listed)) is None
    docs, table = spark.createDataFrame(rows, "id int, body string"), spark.createDataFrame([(t,) for t in listed[::100] + ["b"]], "term string")
    assert {(r["id"], r["term"]): r["n"] for r in terms.term_matches(docs, "id", "body", table).collect()} == plain(rows, listed[::100] + ["b"])
