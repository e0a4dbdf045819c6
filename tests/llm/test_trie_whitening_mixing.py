"""Conversation trie, whitening and mixing against plain versions, on odd and skewed input."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from oracle_compare import compare
from pyspark.sql import functions as F

from vellumflow.llm import mixing, prefix_trie, queries, whitening

TURNS = "conv_id long, turn long, role string, text string"


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_registered():
    assert [sum(n.startswith(f"op{k}_") for n in queries.QUERIES) for k in (11, 12, 13)] == [1] * 3


# --- 11: prefix trie ---------------------------------------------------------------------------


def plain_id(role, text):
    role, text = role or "", text or ""
    return "%08X" % len(text.encode()) + sha256(f"{len(role)}:{role}{text}".encode()).hexdigest().upper()[:24]


def plain_sequences(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv[conv].append((turn is not None, turn or 0, plain_id(role, text), (role or "", text or "")))
    return {c: [t[3] for t in sorted(at)] for c, at in by_conv.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(who) - 1) * (len(path[-1][1].encode()) if path else 0)
    out = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(sequences[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), kids[path], leaves[path], saved[path], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_turns(seed=3, n=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = rng.randint(-12, 60)
        for turn in range(rng.choice([1, 2, 5, 11])):
            rows.append((conv, rng.choice([turn, turn, None, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "é" * 40, "", None, "long " * 300])))
    rows += rows[:20]  # repeated rows
    rows += [(None, 1, "user", "lost"), (None, None, None, None), (1000, None, None, None), (2**62, 1, "user", "a")]
    return rows


@pytest.mark.parametrize("turns,piece", [(100_000, 1 << 16), (7, 3), (1, 1)])
def test_trie_against_plain(spark, monkeypatch, turns, piece):
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "BATCH", 13)
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit("x")).withColumn("conv", F.lit(1)).withColumn("path", F.lit("y"))
    got = prefix_trie.nodes(prefix_trie.keyed(prefix_trie.sequences(df)))
    assert tuples(got) == plain_trie(plain_sequences(rows))


def test_trie_query_rebuilds(spark, tmp_path):
    rows = odd_turns(5, 90)
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert tuples(queries.op11_prefix_trie(spark, str(tmp_path))) == plain_trie(plain_rebuilt(plain_sequences(rows)))


def test_trie_of_hot_conversations(spark, monkeypatch):
    """A third of all conversations equal, a third with the same first turns: ranges stay even, nothing is lost."""
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", 150)
    monkeypatch.setattr(prefix_trie, "PIECE", 64)
    rng = random.Random(1)
    rows = []
    for c in range(900):
        common = [("user", "hello"), ("assistant", "hi")]
        own = common if c % 3 == 0 else [*common, ("user", f"q{c}"), ("assistant", f"a{c % 7}")] if c % 3 == 1 else [("user", f"x{rng.randint(0, 99)}")] * rng.randint(1, 4)
        rows += [(c, k, *t) for k, t in enumerate(own)]
    got = prefix_trie.nodes(prefix_trie.keyed(prefix_trie.sequences(spark.createDataFrame(rows, TURNS).repartition(4))))
    assert tuples(got) == plain_trie(plain_sequences(rows))


def test_trie_of_long_and_no_conversations(spark):
    rows = [(c, k, "user", f"t{k}") for c in (4, 7) for k in range(4000)] + [(9, 0, "user", "t0")]
    got = prefix_trie.nodes(prefix_trie.keyed(prefix_trie.sequences(spark.createDataFrame(rows, TURNS))))
    sums = got.agg(F.count("*"), F.max("depth"), F.max("n_leaves"), F.sum("n_convs")).first()
    assert tuple(sums) == (4001, 4000, 1, 3 + 3 + 2 * 3999)
    for schema_rows in ([], [(None, 1, "user", "a")]):
        assert prefix_trie.nodes(prefix_trie.keyed(prefix_trie.sequences(spark.createDataFrame(schema_rows, TURNS)))).count() == 0


def test_tree_layouts_grow():
    rng = random.Random(2)
    seen = set()
    for n in (3, 4, 5, 16, 17, 48, 49, 200, 256):
        node = prefix_trie.Node(b"", b"")
        order = rng.sample(range(256), n)
        for b in order:
            node.put(b, prefix_trie.Node(bytes([b]), bytes([b])))
        seen.add(node.layout)
        assert [k.path[0] for k in node.children()] == sorted(order)
        assert all((node.find(b) is not None) == (b in set(order)) for b in range(256))
    assert seen == {4, 16, 48, 256}


def test_tree_keeps_every_key():
    rng = random.Random(4)
    keys = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(300)}
    root = prefix_trie.Node(b"", b"")
    for k in rng.sample(sorted(keys), len(keys)):
        prefix_trie.insert(root, k, (k,))
    found, stack = set(), [(root, b"")]
    while stack:
        node, at = stack.pop()
        assert node is root or node.end or len(list(node.children())) > 1  # paths without branches are one piece
        if node.end:
            assert node.end == (at + node.path,)
            found.add(at + node.path)
        stack += [(k, at + node.path) for k in node.children()]
    assert found == keys


# --- 12: whitening --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>"


def plain_whitening(vectors):
    """n, exact deviations and covariance of the rounded vectors."""
    xs = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    fit = [list(x) for x in {tuple(x) for x in xs}]
    n, d = len(fit), len(xs[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    y = [[n * x[i] - s[i] for i in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    return n, [sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs], v, [[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in xs]


def check_whitening(rows, vectors, most):
    n, deviations, v, centred = plain_whitening(vectors)
    values = np.sort(np.linalg.eigvalsh(v))[::-1][:most]
    assert {r["n"] for r in rows} == {n}
    assert sorted(r["deviation"] for r in rows) == sorted(d for d in deviations)
    assert np.allclose(rows[0]["explained"], values / np.trace(v), rtol=1e-9)
    white = np.array([r["whitened"] for r in sorted(rows, key=lambda r: r["vec_id"])])
    values_all, basis = np.linalg.eigh(v)
    expected = np.array(centred) @ basis[:, ::-1][:, :most] / np.sqrt(values_all[::-1][:most])
    signs = np.sign((white * expected).sum(axis=0))
    assert np.allclose(white, expected * signs, atol=1e-7)
    assert rows[0]["identity_error"] < 1e-9


def test_whitening_against_plain(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + rng.normal(size=5) * 30).round(2).tolist()
    vectors += vectors[:100]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], VECTORS).withColumn("n", F.lit(1)).withColumn("x", F.lit("x"))
    check_whitening(whitening.whiten(df.repartition(5), most=16).collect(), vectors, 5)
    check_whitening(whitening.whiten(df, most=3).collect(), vectors, 3)


def test_whitening_of_large_numbers(spark):
    """Centred values of 2 and 3 limbs, and beyond 62 bits."""
    rng = np.random.default_rng(2)
    for scale in (1e6, 1e11, 1e15):
        vectors = (rng.normal(size=(40, 3)) * scale).tolist()
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], VECTORS)
        rows = whitening.whiten(df).collect()
        n, deviations, v, _ = plain_whitening(vectors)
        assert sorted(map(repr, (r["deviation"] for r in rows))) == sorted(repr(d if d < 1 << 63 else None) for d in deviations)
        values = np.sort(np.linalg.eigvalsh(v))[::-1]
        assert np.allclose(rows[0]["explained"], values / np.trace(v), rtol=1e-9) and rows[0]["identity_error"] < 1e-9
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], VECTORS)).collect()


@pytest.mark.parametrize("bits", [5, 23, 24, 25, 47, 48, 61])
def test_square_sums_are_exact(bits):
    rng = random.Random(bits)
    z = np.array([[rng.choice([-1, 1]) * rng.getrandbits(bits) for _ in range(3)] for _ in range(50)] + [[(1 << bits) - 1] * 3], np.int64)
    assert whitening.square_sum(z, 1 << bits) == [sum(int(v) ** 2 for v in c) for c in z.T]


def test_whitening_of_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (None, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, []), (8, [1.0]), (9, [1.0, 2.0, 3.0]),
    ]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(repr(r["vec_id"]) for r in got) == ["1", "2", "2", "None"] and {r["n"] for r in got} == {3}
    # One distinct vector, or dimensions that never differ: no variance to whiten.
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS)).collect()
    assert all(tuple(r)[1:] == (1, 0, [None, None], [0.0, 0.0], None) for r in flat)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 7.0]) for i in range(5)], VECTORS)).collect()
    assert all(r["whitened"][1] is None and r["explained"] == [1.0, 0.0] and r["identity_error"] < 1e-12 for r in line)
    for empty in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(empty, VECTORS)).count() == 0


def test_whitening_query(spark, sf):
    rows = queries.op12_whitening(spark, sf).collect()
    source = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    assert len(rows) == 16 * len(source) and {r["component"] for r in rows} == set(range(1, 17))
    n, deviations, v, _ = plain_whitening([r["embedding"] for r in source])
    assert {r["n"] for r in rows} == {n}
    assert sorted(r["deviation"] for r in rows) == sorted(deviations * 16)
    values = np.sort(np.linalg.eigvalsh(v))[::-1][:16] / np.trace(v)
    assert all(abs(r["explained"] / values[r["component"] - 1] - 1) < 1e-6 and r["identity_error"] < 1e-6 for r in rows)


# --- 13: mixing --------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string"


def plain_targets(sizes):
    """Targets by rounds of sharing what is over, as fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, heavy = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if Fraction(left * weight[s], heavy) > 3 * sizes[s]]
        if not over:
            return {**fixed, **{s: Fraction(left * weight[s], heavy) for s in free}}
        fixed |= {s: Fraction(3 * sizes[s]) for s in over}


def check_mix(rows, docs):
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(d[0]) for d in docs)
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len((text or "").split(" ")) if text else 0
    goal = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - goal[r["source"]]) <= 1e-9 * goal[r["source"]]
        assert r["epochs"] * r["size"] <= r["taken"] <= min(3, r["epochs"] + 1) * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(goal[s]) for s in sizes)
    # The order of the mix has no gaps: each document begins where the one before ends.
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["start"], r["size"]))
    for spans in by_source.values():
        at = 0
        for start, size in sorted(spans):
            assert start == at
            at += size


def mixed_docs(seed, sources):
    rng = random.Random(seed)
    docs = [(rng.choice([i, i, None, 5]), " ".join("w" * rng.randint(1, 6) for _ in range(rng.choice([1, 3, 40, 300]))), rng.choice(sources)) for i in range(160)]
    docs += [docs[0]] * 40 + [(None, None, None), (7, "", "empty"), (8, None, "empty")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("rows_of_range,piece", [(100_000, 10_000), (7, 3)])
@pytest.mark.parametrize("sources", [["a", "b", "é", "z", None], ["only"], [f"s{k}" for k in range(40)] + ["big"] * 80])
def test_mix_against_plain(spark, monkeypatch, rows_of_range, piece, sources):
    monkeypatch.setattr(mixing, "RANGE_ROWS", rows_of_range)
    monkeypatch.setattr(mixing, "PIECE", piece)
    docs = mixed_docs(len(sources), sources)
    df = spark.createDataFrame(docs, DOCS).withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).withColumn("copies", F.lit(9))
    check_mix(mixing.mix(df.repartition(3)).collect(), docs)


def test_mix_agrees_between_runs(spark):
    docs = mixed_docs(9, ["a", "b", None])
    runs = [tuples(mixing.mix(spark.createDataFrame(docs, DOCS).repartition(n))) for n in (1, 4)]
    assert runs[0] == runs[1]
    other = tuples(mixing.mix(spark.createDataFrame(docs, DOCS), seed=1))
    assert other != runs[0]


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], DOCS))
    assert tuples(got, "size", "target", "taken") == [(0, 0.0, 0)] * 2


def test_mix_starves_small_sources_first(spark):
    """Sources whose share is over three times their size stop there, round by round."""
    docs = [(i, "w " * 4 + "w", "a") for i in range(2)] + [(i, "w", "b") for i in range(3)] + [(i, "w " * 99 + "w", "c") for i in range(30)]
    rows = mixing.mix(spark.createDataFrame(docs, DOCS)).collect()
    check_mix(rows, docs)
    assert {r["source"]: r["target"] for r in rows} == {"a": 30.0, "b": 9.0, "c": 2974.0}


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_mixing"])
def test_sql_of_small_tables(spark, sf, con, name):
    count, difference = compare(queries.QUERIES[name](spark, sf), con, queries.ORACLE[name])
    assert difference is None and count > 0
