"""Mixing of sources to target weights, cut at exact budgets.

Every document gets a random key, a digest of a seed, its id and its text. Within a source the
documents are sorted by key, in ranges of keys that hold about ``RANGE_ROWS`` rows however large
the source is; sizes are summed per range, the sums of the ranges before give each range its
start, and a running sum within the range gives each document its own. A source with
budget B and size T is read B div T times whole, and then up to B mod T further words in key
order: the document at the cut gives its first words only, so a source gives exactly its budget.

Targets: sources in the order of their names by code point, null last, have the weights 5, 2, 1,
5, ... and share the words of all documents. A target stops at ``MOST`` times its source's size,
and the others share what is over by weight, until none is above. With the sources sorted by
size over weight this needs no rounds: the sources that stop are the first ones, and the level of
the others is what is left over their weights.

Results for odd input. A null text has no words and is taken with 0; a null source is a source
of its own. Ids may be null or repeated. Rows equal in source, id and text are one group with a
count, so that a run of copies never fills a range; their takes are dealt to them one after the
other. Sources without words have the target 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup

WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
SEED = 20240101
#: Rows of one range of keys, on average; no more of a source lie in it.
RANGE_ROWS = 100_000
#: Copies of one row that a task writes.
PIECE = 10_000
#: Keys are below 2 ** KEY_BITS, as the first hexadecimal digits of a digest.
KEY_DIGITS, KEY_BITS = 12, 48
#: [^\x20\x09-\x0D]+
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: int, id: str, text: str) -> Column:
    """A random number of ``KEY_BITS`` bits that any engine computes alike."""
    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, KEY_DIGITS), 16, 10).cast("long")


def before(rows: DataFrame, order: list[Column], values: list[str], tables: Tables) -> DataFrame:
    """``rows`` with the sums of ``values`` over all rows before in ``order``, as ``before_<value>``.

    Ranges of the order are written, summed one by one, and the sums of earlier ranges added.
    """
    placed = tables.keep(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = placed.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])  # one row per range
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_start_{v}") for v in values])
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(starts, "_part").select(
        *rows.columns, *[(F.col(f"_start_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(f"before_{v}") for v in values]
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(name, source, source_size, target, budget) from (name, source, source_size), one row per source.

    ``target`` is exact up to one rounding; ``budget`` is its whole part.
    """
    tables = Tables(sources.sparkSession)
    ones = sources.withColumn("one", F.lit(1).cast("long"))
    order = [F.col("source").isNull(), F.col("source"), F.col("name")]
    ranked = before(ones, order, ["one"], tables)
    at = F.pmod(F.col("before_one"), F.lit(len(weights)))
    weight = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = ranked.select("name", "source", "source_size", F.get(weight, at.cast("int")).alias("weight"))
    weighed = tables.keep(weighed, "weights")
    sums = weighed.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("weights")).first()
    total, heavy = sums["all"] or 0, sums["weights"] or 0
    # Sources by the level at which they stop; those that stop are the first in this order.
    stop = F.col("source_size") / F.col("weight")
    swept = before(weighed, [stop, F.col("name")], ["source_size", "weight"], tables)
    wide = lambda c: c.cast("decimal(20,0)")
    left, rest = F.lit(total) - most * F.col("before_source_size"), F.lit(heavy) - F.col("before_weight")
    # A source stops if the level that it and all later ones would share is above its own.
    stops = wide(most * F.col("source_size")) * wide(rest) <= wide(left) * wide(F.col("weight"))
    swept = tables.keep(swept.withColumn("stops", stops), "levels")
    full = swept.where("stops").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    words, shares = total - most * (full["size"] or 0), heavy - (full["weight"] or 0)
    share = F.lit(words).cast("decimal(38,0)") * F.col("weight")
    target = F.when(F.col("stops"), (most * F.col("source_size")).cast("double")).otherwise(share.cast("double") / F.lit(float(max(shares, 1))))
    budget = F.when(F.col("stops"), most * F.col("source_size")).otherwise(F.expr(f"CAST({words} AS DECIMAL(20,0)) * weight div {max(shares, 1)}"))
    return swept.select("name", "source", "source_size", target.alias("target"), budget.cast("long").alias("budget"))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """One row per document: (id, source, size, source_size, target, taken, epochs, start).

    ``taken`` are the words the mix takes, ``epochs`` of them whole readings; ``start`` is the number
    of the source's words before the document in the order of the mix.
    """
    tables = Tables(docs.sparkSession)
    read = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), _key(seed, id, text).alias("key"))
    # Texts are read once; what follows sorts and sums these narrow rows. Copies become one row with a count.
    groups = read.groupBy("source", "key", "id", "size").agg(F.count(F.lit(1)).alias("copies"))
    # A source can be null; joins go by a name in its place.
    name = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))
    groups = tables.keep(groups.withColumn("name", name), "keys")
    n_rows = groups.count()
    ranges = max(1, -(-n_rows // RANGE_ROWS))
    groups = groups.withColumns({"range": F.floor(F.col("key") / F.lit(float(1 << KEY_BITS)) * ranges).cast("long"), "words": F.col("size") * F.col("copies")})
    sums = tables.keep(groups.groupBy("name", "source", "range").agg(F.sum("words").alias("words")), "sums")
    goal = targets(sums.groupBy("name", "source").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("name", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("range_start"))
    starts = lookup(starts, goal.drop("source"), ["name"], "inner")
    within = Window.partitionBy("name", "range").orderBy("key", F.col("id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("inner", F.coalesce(F.sum("words").over(within), F.lit(0))).join(starts, ["name", "range"])
    placed = tables.keep(placed.withColumn("start", F.col("range_start") + F.col("inner")).drop("inner", "range_start", "key", "words"), "placed")
    # Copies one after the other; very many of them are dealt over tasks in pieces first.
    pieces = placed.where(F.col("copies") > PIECE).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(PIECE).cast("long"))))
    pieces = pieces.repartition("name", "range", "start", "first").withColumn("last", F.least(F.col("first") + PIECE, F.col("copies")) - 1)
    zero = F.lit(0).cast("long")
    parts = placed.where(F.col("copies") <= PIECE).withColumns({"first": zero, "last": F.col("copies") - 1}).unionByName(pieces)
    each = parts.withColumn("copy", F.explode(F.sequence("first", "last"))).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    epochs, further = F.expr("budget div greatest(source_size, 1)"), F.pmod(F.col("budget"), F.greatest(F.col("source_size"), F.lit(1)))
    cut = F.least(F.greatest(further - F.col("start"), F.lit(0)), F.col("size"))
    return each.select(
        F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target",
        (epochs * F.col("size") + cut).cast("long").alias("taken"), epochs.cast("int").alias("epochs"), "start",
    )
